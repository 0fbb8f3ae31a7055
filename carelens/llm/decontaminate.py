"""Finds benchmark questions in documents, also with other numbers, names and units.

Texts become templates: numbers, units behind numbers and names inside sentences turn into typed placeholders, whose
values are kept as slots.  Windows of template words meet by hash.  Along one alignment of item and document every value
of the item must stand for one value in the document; what meets consistently counts towards the item's cover.

A capital that opens a sentence does not tell a name from another word, so texts have two templates: in one such words are
literals, in the other they are names.  Either finds an item.  Items too short or too dense in placeholders for a window
are looked for as a whole, word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import Rolling, chunks, joined, mix, numbered, partitions, slices, stored, whole_text

#: Words that are units behind a number.
UNITS = (
    "%", "percent", "mm", "cm", "m", "km", "metre", "metres", "meter", "meters", "kilometre", "kilometres", "kilometer", "kilometers",
    "inch", "inches", "foot", "feet", "ft", "yard", "yards", "mile", "miles", "mg", "g", "kg", "gram", "grams", "kilogram", "kilograms",
    "tonne", "tonnes", "ton", "tons", "ounce", "ounces", "oz", "pound", "pounds", "lb", "lbs", "ml", "cl", "l", "litre", "litres",
    "liter", "liters", "gallon", "gallons", "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hour", "hours", "day",
    "days", "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "euro", "euros", "cent", "cents", "usd", "eur",
)
#: Bits of the map of the benchmark's windows that tasks are sent: a fixed size, whatever the benchmark.
MAP_BITS = 22
_rolling = Rolling(23)
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = 1
_KIND[48:58] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".!?\n:"]] = True
_LITERAL, _NUMBER, _UNIT, _NAME = range(4)


def _hashes(words: list[str]) -> np.ndarray:
    data, offsets = joined([w.encode() for w in words])
    return _rolling.spans(_rolling.prefix(data), offsets[:-1], offsets[1:])


_UNIT_HASHES = np.unique(_hashes([u for u in UNITS if u.isalpha()]))


def templates(texts: list[bytes], openers: bool = False, whole: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the template words of all texts: the text, the kind, the hash of the word or placeholder, the value's hash.

    With ``openers`` capitals that open sentences make names too; without ``whole`` names in a row stay words of their own.
    """
    data, offsets = joined(texts)
    empty = np.zeros(0, np.int64)
    if not len(data):
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    kind = _KIND[data]
    mark = np.flatnonzero((data == 0x2E) | (data == 0x2C))
    mark = mark[(mark > 0) & (mark < len(data) - 1)]
    kind[mark[(kind[mark - 1] == 2) & (kind[mark + 1] == 2)]] = 2
    low = _LOWER[data]
    accent = np.flatnonzero(data[:-1] == 0xC3) + 1
    upper = accent[(data[accent] >= 0x80) & (data[accent] <= 0x9E) & (data[accent] != 0x97)]
    low[upper] += 0x20
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[0], kind[:-1]])
    after = np.append(kind[1:], 0)
    starts = np.flatnonzero((kind > 0) & (edge[:-1] | (before != kind)))
    ends = np.flatnonzero((kind > 0) & (edge[1:] | (after != kind))) + 1
    of = np.searchsorted(offsets, starts, "right") - 1
    value = _rolling.spans(_rolling.prefix(low), starts, ends)
    first = np.ones(len(starts), bool)
    first[1:] = of[1:] != of[:-1]
    breaks = np.concatenate([[0], np.cumsum(_BREAK[data])])
    opens = first.copy()
    opens[1:] |= breaks[starts[1:]] > breaks[ends[:-1]]
    capital = (data[starts] >= 65) & (data[starts] <= 90)
    capital |= np.isin(starts + 1, upper) & (data[starts] == 0xC3)
    sort = np.full(len(starts), _LITERAL)
    sort[capital if openers else capital & ~opens] = _NAME
    sort[kind[starts] == 2] = _NUMBER
    behind = np.zeros(len(starts), bool)
    behind[1:] = (sort[:-1] == _NUMBER) & ~opens[1:]
    sort[behind & np.isin(value, _UNIT_HASHES)] = _UNIT
    # Names in a row are one name.
    more = np.zeros(len(starts), bool)
    more[1:] = (sort[1:] == _NAME) & (sort[:-1] == _NAME) & ~opens[1:] & whole
    keep = np.flatnonzero(~more)
    if more.any():
        value = np.add.reduceat(value, keep) if len(keep) else value
    else:
        value = value[keep]
    of, sort = of[keep], sort[keep]
    word = np.where(sort == _LITERAL, value, mix(sort.astype(np.uint64) + np.uint64(0xC0FFEE)))
    return of, sort, word, value


def _runs(of: np.ndarray, word: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows of ``size`` words begin, and their hashes."""
    n = len(of) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    weights = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    at = np.flatnonzero(of[:n] == of[size - 1 :])
    return at, mix(sum(word[k + at] * weights[k] for k in range(size)))


def windows(texts: list[bytes], size: int, literals: int, openers: bool = False) -> tuple[np.ndarray, ...]:
    """Windows of ``size`` template words with ``literals`` words that are no placeholders at least.

    Gives text, place in the text, hash, words' kinds and values (a row of ``size``), and the windows of each text.
    """
    of, sort, word, value = templates(texts, openers)
    if len(of) < size:
        none = np.zeros(0, np.int64)
        return none, none, none, none.reshape(0, size), none.reshape(0, size).astype(np.uint64), np.zeros(len(texts), np.int64)
    at, hashes = _runs(of, word, size)
    plain = np.concatenate([[0], np.cumsum(sort == _LITERAL)])
    enough = plain[at + size] - plain[at] >= literals
    at, hashes = at[enough], hashes[enough]
    counts = np.bincount(of, minlength=len(texts))
    first = np.cumsum(counts) - counts
    rows = at[:, None] + np.arange(size)
    return of[at], at - first[of[at]], hashes.view(np.int64), sort[rows], value[rows], np.bincount(of[at], minlength=len(texts))


def _window_rows(size: int, literals: int, seen):
    """Rows (id, place, hash, slots, windows of the text); with a map, of windows that may be in the benchmark only."""
    names = ["id", "openers", "place", "hash", "slots", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(np.frombuffer(seen.value, np.uint8)).astype(bool) if seen is not None else None
        for batch in slices(batches):
            ids = batch.column(0).to_numpy()
            texts = [t.encode("utf-8") for t in batch.column(1).to_pylist()]
            for (a, b), openers in product(chunks(texts), (False, True)):
                of, place, hashes, sort, value, counts = windows(texts[a:b], size, literals, openers)
                if known is not None:
                    hit = known[hashes.view(np.uint64) >> np.uint64(64 - MAP_BITS)]
                    of, place, hashes, sort, value = of[hit], place[hit], hashes[hit], sort[hit], value[hit]
                if not len(of):
                    continue
                # Slots: the values of the placeholders, in order.
                is_slot = sort != _LITERAL
                offsets = np.concatenate([[0], np.cumsum(is_slot.sum(axis=1))]).astype(np.int32)
                slots = pa.ListArray.from_arrays(pa.array(offsets), pa.array(value[is_slot].view(np.int64)))
                flag = pa.array(np.full(len(of), openers))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a + of]), flag, pa.array(place.astype(np.int32)), pa.array(hashes), slots, pa.array(counts[of].astype(np.int32))], names=names
                )

    return run


def _whole_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, size, hash) of all words of each text that has any."""
    for batch in slices(batches):
        texts = [t.encode("utf-8") for t in batch.column(1).to_pylist()]
        of, _, _, value = templates(texts, whole=False)
        counts = np.bincount(of, minlength=len(texts))
        first = np.cumsum(counts) - counts
        rows = []
        for i in np.flatnonzero(counts).tolist():
            own = value[first[i] : first[i] + counts[i]]
            rows.append((i, int(counts[i]), int(_runs(np.zeros(len(own), np.int64), own, len(own))[1].view(np.int64)[0])))
        if rows:
            at, size, found = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(size, pa.int32()), pa.array(found, pa.int64())], names=["id", "size", "hash"])


def _exact_rows(sizes: list[int], seen):
    """(id, size, hash) of the runs of so many words that may be whole items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(np.frombuffer(seen.value, np.uint8)).astype(bool)
        for batch in slices(batches):
            ids = batch.column(0).to_numpy()
            texts = [t.encode("utf-8") for t in batch.column(1).to_pylist()]
            for a, b in chunks(texts):
                of, _, _, value = templates(texts[a:b], whole=False)
                for size in sizes:
                    at, hashes = _runs(of, value, size)
                    hit = known[hashes >> np.uint64(64 - MAP_BITS)]
                    at, hashes = at[hit], hashes[hit].view(np.int64)
                    if len(at):
                        yield pa.RecordBatch.from_arrays([pa.array(ids[a + of[at]]), pa.array(np.full(len(at), size, np.int32)), pa.array(hashes)], names=["id", "size", "hash"])

    return run


def _map_of(hashes: DataFrame):
    """A broadcast map of fixed size of the leading bits of ``hash``; tasks make parts of it, which are joined."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, any_ = np.zeros(1 << MAP_BITS, bool), False
        for batch in batches:
            bits[batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - MAP_BITS)] = any_ = True
        if any_:
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["bits"])

    bits = np.zeros(1 << MAP_BITS, bool)
    parts = hashes.select("hash").repartition(min(8, partitions(hashes.sparkSession)), "hash").mapInArrow(part, "bits binary")
    for row in parts.toLocalIterator():  # eight parts of half a megabyte at most
        bits |= np.unpackbits(np.frombuffer(row["bits"], np.uint8)).astype(bool)
    return hashes.sparkSession.sparkContext.broadcast(np.packbits(bits).tobytes())


def leaks(texts: DataFrame, benchmark: DataFrame, size: int = 5, literals: int = 3, cover: float = 0.5) -> DataFrame:
    """(id, item_id, cover) for every item of ``benchmark`` (item_id, text) found in a text of ``texts`` (id, text).

    ``cover`` is the share of the item's windows that meet the document consistently.  Items without a window of ``size``
    template words, ``literals`` of them literal, are found where all their words follow one another (cover 1).
    """
    schema = "id bigint, openers boolean, place int, hash bigint, slots array<bigint>, n int"
    asked = benchmark.where("item_id is not null").select(F.col("item_id").cast("bigint").alias("id"), whole_text().alias("text"))
    items = stored(asked.mapInArrow(_window_rows(size, literals, None), schema), "benchmark")
    seen = _map_of(items)
    found = texts.mapInArrow(_window_rows(size, literals, seen), schema)
    items = items.select("hash", "openers", F.col("id").alias("item_id"), F.col("place").alias("item_place"), F.col("slots").alias("item_slots"), F.col("n").alias("item_n"))
    met = found.join(items, ["hash", "openers"]).select(
        "id", "item_id", "openers", "item_n", "item_place", (F.col("place") - F.col("item_place")).alias("shift"), F.arrays_zip("item_slots", "slots").alias("pairs")
    )
    one = met.groupBy("id", "item_id", "openers", "item_n", "shift").agg(
        F.collect_set("item_place").alias("places"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs")
    )  # no more of either than the item has windows and slots
    consistent = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["item_slots"])))
    places = one.where(consistent).select("id", "item_id", "openers", "item_n", F.explode("places").alias("place"))
    share = (F.count_distinct("place") / F.first("item_n")).alias("cover")
    either = places.groupBy("id", "item_id", "openers").agg(share).groupBy("id", "item_id").agg(F.max("cover").alias("cover")).where(F.col("cover") >= cover)

    without = asked.join(items.select(F.col("item_id").alias("id")).distinct(), "id", "left_anti")
    short = stored(without.mapInArrow(_whole_items, "id bigint, size int, hash bigint"), "short-items")
    sizes = sorted(r["size"] for r in short.select("size").distinct().collect())  # lengths, not items
    if not sizes:
        return either
    whole = texts.mapInArrow(_exact_rows(sizes, _map_of(short)), "id bigint, size int, hash bigint")
    exact = whole.join(short.withColumnRenamed("id", "item_id"), ["size", "hash"]).select("id", "item_id").distinct()
    return either.unionByName(exact.withColumn("cover", F.lit(1.0)))


def leak_digest(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, contaminated, item_ids (ascending), cover (the largest; 0 without items).

    A NULL text is empty and holds nothing; rows that repeat a doc_id, or have none, are documents of their own.  Other
    columns are ignored.  Without documents there are no rows, without items nothing is contaminated.
    """
    rows = numbered(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")), "id")
    found = stored(leaks(rows.select("id", "text"), benchmark, **options), "leaks")
    per = found.groupBy("id").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("cover").alias("cover"))
    rows = rows.select("id", "doc_id").join(per, "id", "left")
    none = F.array().cast("array<bigint>")
    return rows.select("doc_id", F.col("cover").isNotNull().alias("contaminated"), F.coalesce("item_ids", none).alias("item_ids"), F.coalesce("cover", F.lit(0.0)).alias("cover"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no item is found, as they are (a column called _leak_row is left out)."""
    docs = docs.drop("_leak_row")
    rows = numbered(docs, "_leak_row")
    texts = rows.select(F.col("_leak_row").alias("id"), whole_text().alias("text"))
    found = stored(leaks(texts, benchmark, **options).select(F.col("id").alias("_leak_row")).distinct(), "leaks")
    return rows.join(found, "_leak_row", "left_anti").drop("_leak_row")
