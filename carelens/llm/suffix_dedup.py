"""Removes every byte covered by a string of a set length that also starts elsewhere, by merging sorted shards.

1. Every window of ``width`` bytes picks the least hash of its grams of half that length as its anchor.  Equal windows
   pick equal anchors at equal offsets, so repeats meet by anchor; windows in a row with one anchor are a segment.
   Anchors that occur once leave nothing to compare.
2. Equal segments fold into one with a multiplicity.  The distinct segments of an anchor are the suffixes to sort, and
   they are cut into shards.  Each shard sorts its own; their orders are merged by refining an interleave: within a block
   of equal prefixes the next bytes of each shard part the block, blocks of one shard are left alone, and where a block
   parts is the common prefix of the neighbours.  From the anchor the merged order steps left column by column as a
   Burrows-Wheeler transform does: the order of a column is the stable deal of the one to its right by the bytes before it.
   Neighbours with equal left bytes and a common prefix for the rest of the width are a repeated interval.
3. An anchor with very many distinct segments is cut into narrower blocks of offsets, keyed by what all windows of a
   block share, until its groups are small; at one offset the key is the window itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import Rolling, chunks, joined, numbered, partitions, slices, stored, whole_text

#: Distinct segments that one task merges for an anchor; beyond, the anchor is cut into blocks of offsets.
GROUP = 20_000
#: Segments of one shard.
SHARD = 256
#: Bytes of segments merged at once.
BULK = 6 << 20
BLOCKS = (32, 1)
_rolling = Rolling(11)
SEGMENT = "key bigint, seg bigint, rid bigint, at int, left int, n int, many boolean, data binary"


def anchors(texts: list[bytes], width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Segments of each chunk of texts: text, anchor hash, segment hash, first byte, bytes before the anchor, windows."""
    gram = width // 2
    span = width - gram + 1
    for a, b in chunks(texts):
        data, offsets = joined(texts[a:b])
        sizes = np.diff(offsets)
        if not (sizes >= width).any():
            continue
        sums = _rolling.prefix(data)
        at = np.arange(len(data) - gram + 1)
        hashes = _rolling.spans(sums, at, at + gram)
        # The hash decides; of equal ones the last place.
        key = (hashes & np.uint64(0xFFFFFFFFF0000000)) | (np.uint64(0x0FFFFFFF) - at.astype(np.uint64))
        least, step = key, 1
        while step * 2 <= span:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        least = np.minimum(least[: len(least) - (span - step)], least[span - step :])
        place = (np.uint64(0x0FFFFFFF) - (least & np.uint64(0x0FFFFFFF))).astype(np.int64)
        long = np.flatnonzero(sizes >= width)
        n = sizes[long] - width + 1
        owner = np.repeat(long, n)
        starts = np.repeat(offsets[long] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        place = place[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (np.diff(place) != 0) | (np.diff(owner) != 0)
        first = np.flatnonzero(new)
        windows = np.diff(np.append(first, len(starts)))
        begin, anchor, owner = starts[first], place[first], owner[first]
        whole = _rolling.spans(sums, begin, begin + windows + width - 1)
        yield owner + a, hashes[anchor].view(np.int64), whole.view(np.int64), begin - offsets[owner], anchor - begin, windows


def _segments(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rid = batch.column(0).to_numpy()
            texts = [t.encode("utf-8") for t in batch.column(1).to_pylist()]
            for owner, anchor, seg, at, left, n in anchors(texts, width):
                columns = [anchor, seg, rid[owner], at.astype(np.int32), left.astype(np.int32), n.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "seg", "rid", "at", "left", "n"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes: they are moved twice."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in slices(batches):
        texts = [press.compress(t.encode("utf-8")) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["rid", "packed"])


def _cut_out(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in slices(batches, 200):
            rows = []
            for packed, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = open_.decompress(packed)
                rows += [(*(p[c] for c in ("key", "seg", "rid", "at", "left", "n", "many")), text[p["at"] : p["at"] + p["n"] + width - 1]) for p in parts]
            if not rows:
                continue
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["key", "seg", "rid", "at", "left", "n", "many", "data"]
            )

    return run


def _parted(block: np.ndarray) -> np.ndarray:
    new = np.ones(len(block), bool)
    new[1:] = block[1:] != block[:-1]
    return new


def _common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Equal leading bytes of big-endian words that differ."""
    differ = (x ^ y).astype(">u8").view(np.uint8).reshape(-1, 8)
    return (differ != 0).argmax(axis=1)


def sort_shards(words: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every shard's own order of its strings (rows of ``words``), and the common prefix with the string before (bytes).

    ``shard`` must not fall from row to row.
    """
    order = np.arange(len(words))
    lcp = np.zeros(len(words), np.int64)
    block = np.cumsum(_parted(shard))
    lcp[~_parted(block)] = words.shape[1] * 8
    live = np.arange(len(words))
    for depth in range(words.shape[1]):
        sizes = np.bincount(block)
        live = live[sizes[block[live]] > 1]
        if not len(live):
            break
        word = words[order[live], depth]
        by = np.lexsort((word, block[live]))
        order[live] = order[live][by]
        word = word[by]
        parts = np.zeros(len(order), bool)
        inner = np.flatnonzero((word[1:] != word[:-1]) & (block[live[1:]] == block[live[:-1]])) + 1
        parts[live[inner]] = True
        lcp[live[inner]] = depth * 8 + _common(word[inner], word[inner - 1])
        block = np.cumsum(_parted(block) | parts)
    return order, lcp


def merge_shards(words: np.ndarray, group: np.ndarray, shard: np.ndarray, order: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of each group's strings, from the orders of its shards, and the common prefix with the string before.

    ``order`` holds the shards of a group one after another.  Only blocks that hold strings of two shards are refined.
    """
    own = np.empty(len(order), np.int64)
    own[order] = lcp  # of each string: with the one before it in its shard
    order = order.copy()
    merged = np.zeros(len(order), np.int64)
    block = np.cumsum(_parted(group[order]))
    live = np.arange(len(order))
    for depth in range(words.shape[1]):
        top = block[-1] + 1
        low, high = np.full(top, len(order)), np.full(top, -1)
        np.minimum.at(low, block[live], shard[order[live]])
        np.maximum.at(high, block[live], shard[order[live]])
        live = live[low[block[live]] < high[block[live]]]
        if not len(live):
            break
        word = words[order[live], depth]
        by = np.lexsort((word, block[live]))  # stable: each shard's strings keep their order
        order[live] = order[live][by]
        word = word[by]
        inner = np.flatnonzero((word[1:] != word[:-1]) & (block[live[1:]] == block[live[:-1]])) + 1
        parts = np.zeros(len(order), bool)
        parts[live[inner]] = True
        merged[live[inner]] = depth * 8 + _common(word[inner], word[inner - 1])
        block = np.cumsum(_parted(block) | parts)
    # Neighbours in one block: the whole width if the block stayed mixed, else what their shard knows.
    inside = ~_parted(block)
    merged[inside] = own[order[inside]]
    mixed = np.zeros(block[-1] + 1, bool)
    mixed[block[live]] = True
    merged[inside & mixed[block]] = words.shape[1] * 8
    return order, merged


def repeated_windows(group: np.ndarray, left: np.ndarray, n: np.ndarray, data: list[bytes], width: int) -> list[np.ndarray]:
    """For each segment which of its windows another segment of its group holds too.  ``group`` must not fall."""
    count = len(data)
    flat, begin = joined(data)
    sizes = np.diff(begin)
    right = sizes - left
    padded = -(-width // 8) * 8
    column = np.arange(padded)
    at = (begin[:-1] + left)[:, None] + column
    held = np.where(column < right[:, None], flat[np.minimum(at, len(flat) - 1)], 0).astype(np.uint8)
    words = held.view(">u8").astype(np.uint64)
    # Shards: runs of segments of one group.
    new = _parted(group)
    place = np.arange(count) - np.repeat(np.flatnonzero(new), np.diff(np.append(np.flatnonzero(new), count)))
    shard = np.cumsum(new | (place % SHARD == 0))
    order, lcp = sort_shards(words, shard)
    order, lcp = merge_shards(words, group, shard, order, lcp)
    rank = np.empty(count, np.int64)
    rank[order] = np.arange(count)
    found = np.zeros((count, int(n.max())), bool)
    starts = begin[:-1]
    number = np.cumsum(new) - 1
    kind = number.copy()  # equal for segments of a group with equal bytes before the anchor so far
    low = left - n + 1
    for o in range(int(left.max()) + 1):
        if o:
            order = order[left[order] >= o]
            byte = flat[starts[order] + left[order] - o].astype(np.int64)
            by = np.argsort(number[order] * 256 + byte, kind="stable")
            order, byte = order[by], byte[by]
            parts = _parted(number[order] * 256 + byte) | _parted(kind[order])
            kind[order] = np.cumsum(parts)
        sizes = np.bincount(kind[order])
        order = order[sizes[kind[order]] > 1]
        if not len(order):
            break
        fit = order[(low[order] <= o)]
        same = np.cumsum(lcp < width - o)[rank[fit]]
        equal = (kind[fit][1:] == kind[fit][:-1]) & (same[1:] == same[:-1])
        hit = np.zeros(len(fit), bool)
        hit[1:] |= equal
        hit[:-1] |= equal
        hit = fit[hit]
        found[hit, left[hit] - o] = True
    return [found[i, : n[i]] for i in range(count)]


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _merged(width: int):
    """Spans of the windows that repeat.  Rows come ordered by key; several keys are merged at once."""

    def worked(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not rows:
            return
        key, rid, at, left, n, many, data = zip(*rows, strict=True)
        group = np.cumsum(_parted(np.array(key)))
        found = repeated_windows(group, np.array(left, np.int64), np.array(n, np.int64), list(data), width)
        out: list[tuple[int, int, int]] = []
        for i, mask in enumerate(found):
            if not many[i] and mask.any():
                out += [(rid[i], at[i] + s, at[i] + e - 1 + width) for s, e in zip(*_runs(mask), strict=True)]
        if out:
            columns = list(zip(*out, strict=True))
            types = (pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["rid", "start", "end"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for batch in slices(batches, 1000):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > BULK and row[0] != rows[-1][0]:
                    yield from worked(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[-1])
        yield from worked(rows)

    return run


def _narrowed(width: int, block: int):
    """Segments cut into blocks of offsets; the new key is the old one with what all windows of a full block share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            rows = []
            for key, seg, rid, at, left, n, many, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for q in range((left - n + 1) // block, left // block + 1):
                    high, low = min(left, q * block + block - 1), max(left - n + 1, q * block)
                    first = left - high
                    core = data[left - q * block : left + width - q * block - block + 1]
                    name = hashlib.blake2b(core + key.to_bytes(8, "little", signed=True) + q.to_bytes(4, "little"), digest_size=8)
                    part = data[first : first + high - low + width]
                    content = hashlib.blake2b(part, digest_size=8)
                    rows.append((*(int.from_bytes(x.digest(), "little", signed=True) for x in (name, content)), rid, at + first, high, high - low + 1, many, part))
            if not rows:
                continue
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["key", "seg", "rid", "at", "left", "n", "many", "data"]
            )

    return run


def _spans(rows: DataFrame, width: int) -> DataFrame:
    return rows.select("rid", F.col("at").alias("start"), (F.col("at") + F.col("n") + (width - 1)).alias("end"))


def _merge(rows: DataFrame, width: int) -> DataFrame:
    met = rows.select("key", "rid", "at", "left", "n", "many", "data").repartition(partitions(rows.sparkSession), "key")
    return met.sortWithinPartitions("key").mapInArrow(_merged(width), "rid bigint, start int, end int")


def repeated_spans(texts: DataFrame, width: int = 400, group: int = GROUP) -> DataFrame:
    """(rid, start, end): the windows of ``width`` bytes of ``texts`` (rid, text) that start elsewhere too, in runs.

    Positions count bytes.  The scan of ``texts`` is repeated, so ``rid`` must be the same each time.
    """
    found = stored(texts.mapInArrow(_segments(width), "key bigint, seg bigint, rid bigint, at int, left int, n int"), "segments")
    one = F.min(F.struct("rid", "at", "left", "n")).alias("one")
    distinct = found.groupBy("key", "seg").agg(F.count("*").alias("times"), one)
    keys = distinct.groupBy("key").agg(F.sum("times").alias("all"), F.count("*").alias("kinds")).where("`all` > 1")
    repeated = stored(distinct.join(keys, "key").select("key", "seg", "times", "kinds", "one.*"), "repeated")
    spans = [_spans(found.join(repeated.where("times > 1").select("key", "seg"), ["key", "seg"]), width)]

    # The texts of the segments that stand for their copies.
    compared = repeated.where("kinds > 1").withColumn("many", F.col("times") > 1)
    of_text = compared.groupBy("rid").agg(F.collect_list(F.struct("key", "seg", "rid", "at", "left", "n", "many", "kinds")).alias("parts"))
    packed = texts.select("rid", "text").mapInArrow(_packed, "rid bigint, packed binary")
    cold = F.filter("parts", lambda p: p["kinds"] <= group)
    hot = F.filter("parts", lambda p: p["kinds"] > group)
    with_text = packed.join(of_text, "rid")
    is_hot = not compared.where(F.col("kinds") > group).isEmpty()
    rows = with_text.select("packed", (cold if is_hot else F.col("parts")).alias("parts")).mapInArrow(_cut_out(width), SEGMENT)
    spans.append(_merge(rows, width))
    if is_hot:
        rows = stored(with_text.select("packed", hot.alias("parts")).where("size(parts) > 0").mapInArrow(_cut_out(width), SEGMENT), "hot")
    for block in BLOCKS if is_hot else ():
        cut = stored(rows.mapInArrow(_narrowed(width, block), SEGMENT), "cut")
        folded = cut.groupBy("key", "seg").agg(F.count("*").alias("times"), F.min(F.struct("rid", "at")).alias("one"))
        spans.append(_spans(cut.join(folded.where("times > 1").select("key", "seg"), ["key", "seg"]), width))
        kinds = folded.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1")
        left = folded.join(kinds, "key").select("key", "seg", "one.rid", "one.at", "kinds", (F.col("times") > 1).alias("folded"))
        rows = cut.join(left, ["key", "seg", "rid", "at"]).withColumn("many", F.col("many") | F.col("folded")).dropDuplicates(["key", "seg"])
        rows = stored(rows.select("key", "seg", "rid", "at", "left", "n", "many", "data", "kinds"), "open")
        names = [x.split()[0] for x in SEGMENT.split(", ")]
        spans.append(_merge(rows.where(F.col("kinds") <= group), width))
        rows = rows.where(F.col("kinds") > group).select(*names)
    out = spans[0]
    for more in spans[1:]:
        out = out.union(more)
    return out


def _kept(text: bytes, spans: list | None) -> tuple[int, int, list[tuple[int, int]]]:
    """Removed bytes, maximal removed runs, and the runs that stay."""
    stay, upto, removed, runs = [], 0, 0, 0
    for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
        if end <= upto:
            continue
        if start > upto or not runs:
            if start > upto:
                stay.append((upto, start))
            runs += 1
        removed += end - max(start, upto)
        upto = end
    stay.append((upto, len(text)))
    return removed, runs, stay


def _readable(text: bytes, stay: list[tuple[int, int]]) -> str:
    """The runs that stay as text, without characters of which only a part is left."""
    return "".join(text[a:b].decode("utf-8", "ignore") for a, b in stay)


def _with_spans(docs: DataFrame, width: int, group: int) -> tuple[DataFrame, DataFrame]:
    rows = numbered(docs, "rid")
    texts = rows.select("rid", whole_text().alias("text"))
    spans = repeated_spans(texts, width, group)
    # Runs of one document, as many as it has room for.
    return rows, spans.groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def removal_digest(docs: DataFrame, width: int = 400, group: int = GROUP, texts: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (what stays, concatenated).

    With ``texts`` also ``kept_text``, what stays as text: a character of which a part went is left out of it.  Passages of fewer bytes than
    ``width`` stay, as 400 bytes are about 65 words; ``without_repeats`` takes a smaller width.

    A NULL text is empty.  Rows that repeat a doc_id are documents of their own; so are rows with a NULL one.  Other
    columns are ignored; an empty table gives no rows.
    """
    found, spans = _with_spans(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), width, group)
    packed = found.select("rid", whole_text().alias("text")).mapInArrow(_packed, "rid bigint, packed binary")
    rows = packed.join(found.select("rid", "doc_id"), "rid").join(spans, "rid", "left").select("doc_id", "packed", "spans")
    columns = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()}
    columns |= {"kept_text": pa.string()} if texts else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in slices(batches):
            out = []
            for doc_id, text, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = open_.decompress(text)
                removed, runs, stay = _kept(text, own)
                digest = hashlib.sha256(b"".join(text[a:b] for a, b in stay)).hexdigest()
                out.append((doc_id, len(text), removed, runs, digest, *([_readable(text, stay)] if texts else [])))
            values = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, columns.values(), strict=True)], names=list(columns))

    return rows.mapInArrow(run, ", ".join(f"{c} {'bigint' if t == pa.int64() else 'string'}" for c, t in columns.items()))


def without_repeats(docs: DataFrame, width: int = 400, group: int = GROUP) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``; a character of which a part went goes whole.

    NULL texts stay NULL, other columns stay as they are (one called rid is left out).
    """
    docs = docs.drop("rid")
    names = docs.columns
    place = names.index("text")
    found, spans = _with_spans(docs, width, group)
    rows = found.join(spans, "rid", "left").select(*names, "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(place).to_pylist()
            for i, own in enumerate(batch.column(len(names)).to_pylist()):
                if own and texts[i] is not None:
                    raw = texts[i].encode("utf-8")
                    texts[i] = _readable(raw, _kept(raw, own)[2])
            columns = [pa.array(texts, pa.string()) if k == place else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, docs.schema)
