"""What the operators share: shared folders, chunked byte buffers and rolling hashes."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are hashed at once; one longer text makes a chunk of its own.
CHUNK_BYTES = 1 << 20


def on_workers(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it, if they don't find it anyway."""
    root, there = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in there.get("PYTHONPATH", "").split(os.pathsep):
        there["PYTHONPATH"] = os.pathsep.join(filter(None, [there.get("PYTHONPATH", ""), root]))
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share.

    The base is ``spark.checkpoint.dir``; where a session has none, the warehouse holds it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later stages survive lost executors without its lineage."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, column: str) -> DataFrame:
    """``docs`` with a number for each row that stays the same however often and with whatever columns it is computed.

    Rows of plain scans are numbered by their places in the files.  Anything that moves rows is stored first: the order
    of its rows may change from run to run.
    """
    plan = docs._jdf.queryExecution().optimizedPlan().toString().strip().split("\n")
    steps = ("Project ", "Filter ", "Relation ", "RelationV2", "Union ")
    if not all(step.lstrip(" +-:").startswith(steps) for step in plan):
        docs = stored(docs, "numbered")
    return docs.withColumn(column, F.monotonically_increasing_id())


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_text(column: str = "text") -> "F.Column":
    return F.coalesce(F.col(column), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: what Python makes of a batch stays small."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in one array, and the offsets of the texts in it (one more than texts)."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)), out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any span of a byte array in constant time: a polynomial over random byte values, modulo 2**64."""

    def __init__(self, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = (int(rng.integers(1, 2**62)) * 8 + 5) % 2**64
        self.inverse = pow(self.base, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, CHUNK_BYTES + 4096)
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._powers(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=sums[1:])
        return sums

    def spans(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        lengths = (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix((sums[end] - sums[start]) * self.down[start] + lengths)


def exploded(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of consecutive ranges: starts[i], starts[i] + 1, ... for every i."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class WordMemo:
    """Codes texts word by word and keeps what it has coded.

    A word runs from a space that follows no white space (or from the start of the text) to the byte before the next
    such space; ``cut`` may part words further: it gets the bytes of several texts and marks those that start a word.
    ``code`` gets a list of distinct words and returns their codes, one array each, or all of them and how many
    each word has; the codes of a text are those of its words, one after another.  A word is known by its 64-bit hash and length.  Once more than
    ``limit`` words are kept, those that were met again after the batch that brought them stay, if they are few enough.
    """

    def __init__(self, code, limit: int = 1 << 20, cut=None) -> None:
        self.code, self.limit, self.rolling, self.cut = code, limit, Rolling(3), cut
        self._clear()

    def _clear(self) -> None:
        self.bits = 12
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.keys, self.start, self.length = (np.zeros(1 << 11, t) for t in (np.uint64, np.int64, np.int32))
        self.again = np.zeros(1 << 11, bool)
        self.flat, self.n, self.filled = np.zeros(1 << 12, np.int32), 0, 0

    def _shrink(self) -> None:
        """Lets go of words that were met in one batch only, or of all if that leaves more than half of the limit."""
        keep = np.flatnonzero(self.again[: self.n])
        keys, start, length, flat = self.keys[keep], self.start[keep], self.length[keep].astype(np.int64), self.flat
        self._clear()
        if len(keep) * 2 <= self.limit:
            self._put(keys, flat[exploded(start, length)], length)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for new ones."""
        mask = (1 << self.bits) - 1
        at = (keys & np.uint64(mask)).astype(np.int64)
        found = self.slots[at]
        # Most are found at once; the others go on to the next slot until they meet their own or a free one.
        open_ = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        at = at[open_]
        while len(open_):
            at = (at + 1) & mask
            number = self.slots[at]
            found[open_] = number
            on = (number >= 0) & (self.keys[number] != keys[open_])
            open_, at = open_[on], at[on]
        return found

    def _insert(self, numbers: np.ndarray) -> None:
        mask = (1 << self.bits) - 1
        at = (self.keys[numbers] & np.uint64(mask)).astype(np.int64)
        while len(numbers):
            free = self.slots[at] < 0
            self.slots[at[free]] = numbers[free]
            on = self.slots[at] != numbers
            numbers, at = numbers[on], (at[on] + 1) & mask

    def _add(self, keys: np.ndarray, words: list[bytes]) -> None:
        coded = self.code(words)
        if isinstance(coded, list):
            coded = np.concatenate(coded) if coded else np.zeros(0, np.int32), np.fromiter(map(len, coded), np.int64, len(coded))
        self._put(keys, *coded)

    def _put(self, keys: np.ndarray, coded: np.ndarray, lengths: np.ndarray) -> None:
        total = len(coded)
        while self.filled + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.filled : self.filled + total] = coded
        first, end = self.n, self.n + len(keys)
        while end > len(self.keys):  # room grows by doubling: a batch with a few new words copies nothing
            for name in ("keys", "start", "length", "again"):
                setattr(self, name, np.concatenate([getattr(self, name), np.zeros_like(getattr(self, name))]))
        self.start[first:end] = self.filled + np.cumsum(lengths, dtype=np.int64) - lengths
        self.length[first:end], self.keys[first:end] = lengths, keys
        self.filled, self.n = self.filled + total, end
        if self.n * 2 > 1 << self.bits:
            while self.n * 3 > 1 << self.bits:
                self.bits += 1
            self.slots = np.full(1 << self.bits, -1, np.int32)
            first = 0
        self._insert(np.arange(first, self.n, dtype=np.int32))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The codes of all texts, and how many each has."""
        if self.n > self.limit:
            self._shrink()
        data, offsets = joined(texts)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        cut = data == 0x20
        at = np.flatnonzero(cut)
        one, two, three = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
        # After other white space, or what may end a white-space character beyond ASCII, a space belongs to it.
        other = ((one >= 0x80) & ((two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3)))) | (one == 0x20)
        cut[at[other | ((one >= 0x09) & (one <= 0x0D)) | ((one >= 0x1C) & (one <= 0x1F))]] = False
        if self.cut:
            cut |= self.cut(data)
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        keys = self.rolling.spans(self.rolling.prefix(data), starts, ends)
        numbers = self._find(keys)
        fresh = np.flatnonzero(numbers < 0)
        known = self.n
        if len(fresh):
            new, at = np.unique(keys[fresh], return_index=True)
            at = fresh[at]
            # Those that begin with a space or a line end come last, so that ``code`` may take them together.
            lead = data[starts[at]]
            order = np.argsort((lead == 0x20) | (lead == 0x0A), kind="stable")
            new, at = new[order], at[order]
            raw = data.tobytes()
            self._add(new, [raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            numbers[fresh] = self._find(keys[fresh])
        self.again[numbers] = True
        self.again[known : self.n] = False
        lengths = self.length[numbers].astype(np.int64)
        codes = self.flat[exploded(self.start[numbers], lengths)]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        bounds = upto[np.searchsorted(starts, offsets)]
        return codes, np.diff(bounds)
