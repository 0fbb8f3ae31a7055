"""Token-ID output: documents as Parquet lists of token ids, in order of their ids, for selective reads.

The files are plain Parquet of version 2: ids are dictionary-coded while the dictionary is small and delta-coded beyond
it, row groups and pages have set sizes, and Parquet's column and page indexes let a reader that filters on ``doc_id``
or asks for the counts alone skip token pages.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelens.llm.common import WordMemo, chunks, partitions, scratch, slices, whole_text

STORED = "doc_id bigint, part int, start_in_part bigint, n_tokens bigint, ids array<int>"
_coders: dict[str, WordMemo] = {}

_LETTER = np.array([chr(b).isascii() and chr(b).isalpha() for b in range(256)])
#: The second bytes of Latin letters that begin with 0xC3.
_LATIN = np.array([0x80 <= b <= 0xBF and b not in (0x97, 0xB7) for b in range(256)])
_VISIBLE = np.array([0x21 <= b <= 0x7E for b in range(256)])


def _cuts(data: np.ndarray, sign: np.ndarray, line: bool) -> np.ndarray:
    """Marks every ``sign`` behind a letter and, with ``line``, every line end behind a letter or visible ASCII character."""
    cut = np.zeros(len(data), bool)
    at = np.flatnonzero(sign[data[1:]]) + 1
    ends = np.flatnonzero(data[1:] == 0x0A) + 1 if line else at[:0]
    for places, before in ((at, _LETTER), (ends, _VISIBLE)):
        one, two = data[places - 1], data[np.maximum(places - 2, 0)]
        cut[places[before[one] | (_LATIN[one] & (two == 0xC3) & (places > 1))]] = True
    return cut


def coder(path: str):
    """A function from texts to (ids of all, ids per text); one for each worker process, which keeps coded words.

    The byte-level scheme cuts a text before every space that follows a character other than white space, and special
    tokens hold no space, so the words of ``WordMemo`` can be coded apart.  It also cuts between a letter and a sign, and
    between either and a line end: with these cuts a word is coded once whatever stands behind it.
    """
    if path not in _coders:
        # One thread a task: the words of a batch are too short to be dealt over threads.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)

        # The bytes of each id: in the byte-level alphabet a character is a byte; added tokens stand for themselves.
        vocabulary = library.get_vocab(with_added_tokens=True)
        width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            width[i] = len(token)
        for i, token in library.get_added_tokens_decoder().items():
            width[i] = len(token.content.encode("utf-8"))

        # A cut before what a special token holds behind its first character might fall into the token.
        inside = {b for token in library.get_added_tokens_decoder().values() for b in token.content.encode("utf-8")[1:]}
        cut = partial(_cuts, sign=np.array([33 <= b < 127 and not chr(b).isalnum() and b not in inside for b in range(256)]), line=10 not in inside)

        def apart(new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            ids = [e.ids for e in library.encode_batch_fast([w.decode("utf-8") for w in new], add_special_tokens=False)]
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            return np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum())), lengths

        def words(new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            """Words that begin with a space or a line end are coded in one text; the widths of its ids tell where each word ends."""
            if not new:
                return np.zeros(0, np.int32), np.zeros(0, np.int64)
            flat, lengths = [], []
            for k in range(0, len(new), 1000):
                some = new[k : k + 1000]
                if all(w[:1] in (b" ", b"\n") for w in some):
                    text = library.encode_batch_fast([b"".join(some).decode("utf-8")], add_special_tokens=False)[0]
                    ids = np.array(text.ids, np.int32)
                    ends = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)))
                    upto = np.cumsum(width[ids])
                    at = np.searchsorted(upto, ends)
                    if len(upto) and upto[-1] == ends[-1] and (upto[at] == ends).all():
                        flat.append(ids)
                        lengths.append(np.diff(np.concatenate([[0], at + 1])))
                        continue
                ids, counts = apart(some)  # an id may not reach over the end of a word
                flat.append(ids)
                lengths.append(counts)
            return np.concatenate(flat), np.concatenate(lengths)

        _coders[path] = WordMemo(words, cut=cut)
    memo = _coders[path]

    def encode(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        raw = [t.encode("utf-8") for t in texts]
        for a, b in chunks(raw):
            yield a, *memo.encode(raw[a:b])

    return encode


def _encoded(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, upto = coder(path), TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            doc_ids, texts = batch.column(0), batch.column(1).to_pylist()
            for first, ids, counts in encode(texts):
                n = len(counts)
                whole = np.insert(ids, np.cumsum(counts), end_id)
                counts = counts + 1
                ends = np.cumsum(counts)
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.slice(first, n),
                        pa.array(np.full(n, part, np.int32)),
                        pa.array(upto + ends - counts),
                        pa.array(counts),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(whole.astype(np.int32))),
                    ],
                    names=["doc_id", "part", "start_in_part", "n_tokens", "ids"],
                )
                upto += int(ends[-1])

    return run


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, row_group_bytes: int = 32 << 20, page_rows: int = 20_000
) -> None:
    """Encode ``docs`` (doc_id, text) and write them in ascending order of doc_id, one sorted range of ids to a file.

    A NULL text is empty: it has the end id alone.  Rows that repeat a doc_id are all kept; NULL ids come first.
    Other columns are left out.  An empty table gives a folder without rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    # Rows of one doc_id stay together, in a fixed order.
    ordered = rows.repartitionByRange(partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    (
        ordered.mapInArrow(_encoded(tokenizer, end_id), STORED)
        .write.option("parquet.writer.version", "v2")
        .option("compression", "zstd")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.row.count.limit", page_rows)
        .option("parquet.enable.dictionary", "true")
        .parquet(path)
    )


def starts(stored: DataFrame) -> DataFrame:
    """(part, before): the ids in all parts before; a row per file, so it is small and may be broadcast."""
    sizes = stored.groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("before"))


def read_tokens(spark, path: str) -> DataFrame:
    """What was written, with ``start``: the ids of all documents before, counted over the files' parts."""
    stored = spark.read.schema(STORED).parquet(path)
    start = (F.col("before") + F.col("start_in_part")).alias("start")
    return stored.join(F.broadcast(starts(stored)), "part").select("doc_id", start, "n_tokens", "ids")


def with_checksums(tokens: DataFrame) -> DataFrame:
    """Replaces ``ids`` by the CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lists = batch.column(3)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            offsets = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets, offsets[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def token_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the files, read them back, and give a row per document from what was read."""
    spark = docs.sparkSession
    path = scratch(spark, "tokens")
    write_tokens(docs, path, tokenizer)
    return with_checksums(read_tokens(spark, path))
