"""Jaccard join on word shingles by vertical partitioning of the global n-gram order.

1. One pass gives each document the size and fingerprint of its set; equal sets become one node.  The same pass counts
   all shingles in a sketch of fixed size, which orders them from rare to frequent (ties by hash).
2. Two sets of the wanted similarity share one of their first ``n - ceil(t n) + 1`` shingles in that order.  Those rows
   meet by shingle; pairs that sizes and places in the order rule out are dropped.  Short lists give all their pairs,
   long ones a few that connect them; members of long lists that are still unconnected at the end are all compared, block
   of members by block, each pair of blocks a group of its own.
3. Candidates whose sizes and parity sketches rule the similarity out are dropped.  The others are counted over fragments:
   the order is cut by shingle hash, each fragment of a group of candidates is counted apart, and a pair's partial overlaps
   are summed.  A group is a set with some of those it is paired with, so it stays small however candidates hang together.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import Rolling, chunks, exploded, joined, mix, numbered, partitions, slices, stored, whole_text
from carelens.llm.components import components

#: The sketch has 2**SKETCH_BITS counters, whatever the input; it is cut into SLICES rows.
SKETCH_BITS, SLICES = 20, 64
#: Lists of up to this many nodes give all their pairs at once.
SHORT_LIST = 8
#: Shingles of one set in one fragment, and of the sets that one group pairs with its first; and how many these are.
FRAGMENT, GROUP = 500_000, 256
#: Bytes of fragments that are handed on at once.
HANDED = 8 << 20
#: Bits of a set's parity sketch: the bits in which two sketches differ are no more than the shingles in which the sets do.
PARITY_BITS = 1024
#: In a long list each node is paired with so many that follow it.
NEXT = 4
#: Members of a long list that are compared at once with as many others.
BLOCK = 2048
#: Pairs of blocks with so few pairs of members are compared many at once, up to AT_ONCE pairs of members.
FEW, AT_ONCE = 4096, 1 << 19
#: Lists of a shingle this much above the mean count are dealt over SALTS tasks.
HOT, SALTS = 8, 16
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_rolling = Rolling(5)


def shingle_sets(texts: list[bytes], size: int = 5) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For chunks of texts: the first one's place, the sorted distinct shingle hashes of all, and how many each has.

    A-Z count as a-z; words are what white space parts.  A text of fewer words has their whole sequence as one shingle;
    without words it has none.
    """
    for a, b in chunks(texts):
        data, offsets = joined(texts[a:b])
        if not len(data):
            yield a, np.zeros(0, np.uint64), np.zeros(b - a, np.int64)
            continue
        data = _LOWER[data]
        inside = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
        ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
        words = _rolling.spans(_rolling.prefix(data), starts, ends)
        of = np.searchsorted(offsets, starts, "right") - 1
        weights = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        found, owner = [], []
        n = len(words) - size + 1
        if n > 0:
            full = of[:n] == of[size - 1 :]
            sums = sum(words[k : k + n] * weights[k] for k in range(size))
            found.append(mix(sums[full]))
            owner.append(of[:n][full])
        counts = np.bincount(of, minlength=b - a)
        few = np.flatnonzero((counts > 0) & (counts < size))
        if len(few):
            first = np.cumsum(counts) - counts
            sums = np.zeros(len(few), np.uint64)
            for k in range(size - 1):
                has = counts[few] > k
                sums[has] += words[first[few[has]] + k] * weights[k]
            found.append(mix(sums + counts[few].astype(np.uint64)))
            owner.append(few)
        shingles = np.concatenate(found) if found else np.zeros(0, np.uint64)
        owners = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        order = np.argsort(shingles)
        order = order[np.argsort(owners[order].astype(np.uint16 if b - a < 65536 else np.int64), kind="stable")]
        shingles, owners = shingles[order], owners[order]
        new = np.ones(len(shingles), bool)
        new[1:] = (np.diff(shingles) != 0) | (np.diff(owners) != 0)
        shingles, owners = shingles[new], owners[new]
        yield a, shingles, np.bincount(owners, minlength=b - a)


def _fingerprints(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set (sum of mixed hashes), as signed numbers."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingles + np.uint64(0xA5A5)), dtype=np.uint64)])
    ends = np.concatenate([[0], np.cumsum(counts)])
    return mix((sums[ends[1:]] - sums[ends[:-1]]) + counts.astype(np.uint64)).view(np.int64)


def _parities(shingles: np.ndarray, counts: np.ndarray) -> list[bytes]:
    of = np.repeat(np.arange(len(counts)), counts)
    bits = np.bincount(of * PARITY_BITS + (shingles & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=len(counts) * PARITY_BITS)
    rows = np.packbits((bits & 1).astype(bool).reshape(len(counts), PARITY_BITS), axis=1)
    return [r.tobytes() for r in rows]


def _profile(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen = np.zeros(1 << SKETCH_BITS, np.int64), False
        for batch in slices(batches):
            texts = [t.encode("utf-8") for t in batch.column(1).to_pylist()]
            for a, shingles, counts in shingle_sets(texts, size):
                sketch += np.bincount((shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(sketch))
                n, seen = len(counts), True
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, n), batch.column(2).slice(a, n), pa.array(counts), pa.array(_fingerprints(shingles, counts)),
                        pa.array(_parities(shingles, counts), pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                    ],
                    names=["doc_id", "row", "n", "node", "parity", "slice", "counts"],
                )
        if seen:
            parts = [x.astype("<u4").tobytes() for x in np.split(sketch, SLICES)]
            none = pa.nulls(SLICES, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, none, pa.nulls(SLICES, pa.binary()), pa.array(np.arange(SLICES, dtype=np.int32)), pa.array(parts, pa.binary())],
                names=["doc_id", "row", "n", "node", "parity", "slice", "counts"],
            )

    return run


def _summed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, "<u4").astype(np.int64) for x in rows["counts"])
    return pd.DataFrame({"slice": [key[0]], "counts": [total.astype("<i8").tobytes()]})


def _levels(sketch: DataFrame) -> np.ndarray:
    """Of every counter of the sketch how far it lies above the mean, in doublings; 2**SKETCH_BITS bytes in all."""
    # A row per slice; summed in two steps, so that no task meets the counts of all.
    halves = sketch.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(16)))
    one = lambda key, rows: _summed(key[:1], rows)
    summed = halves.groupBy("slice", "part").applyInPandas(one, "slice int, counts binary")
    wide = lambda key, rows: pd.DataFrame(
        {"slice": [key[0]], "counts": [sum(np.frombuffer(x, "<i8") for x in rows["counts"]).tobytes()]}
    )
    rows = summed.groupBy("slice").applyInPandas(wide, "slice int, counts binary").collect()
    total = np.zeros(1 << SKETCH_BITS, np.int64)
    width = len(total) // SLICES
    for r in rows:
        total[r["slice"] * width : (r["slice"] + 1) * width] = np.frombuffer(r["counts"], "<i8")
    mean = max(1.0, total.sum() / len(total))
    return np.clip(np.floor(np.log2(np.maximum(total, 1) / mean + 1) * 2), 0, 31).astype(np.uint8)


def _prefixes(size: int, percent: int, levels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level_of = levels.value
        hot = 2 * math.log2(HOT + 1)
        for batch in slices(batches):
            texts = [t.encode("utf-8") for t in batch.column(0).to_pylist()]
            for _, shingles, counts in shingle_sets(texts, size):
                if not len(shingles):
                    continue
                nodes = _fingerprints(shingles, counts)
                of = np.repeat(np.arange(len(counts)), counts)
                level = level_of[(shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                order = np.argsort(of * 32 + level, kind="stable")  # by document, level and hash
                first = np.cumsum(counts) - counts
                place = np.arange(len(of)) - np.repeat(first, counts)
                n = np.repeat(counts, counts)
                keep = place < n - -(-n * percent // 100) + 1
                shingles, level, of, place, n = shingles[order][keep], level[order][keep], of[keep], place[keep], n[keep]
                node = nodes[of]
                # Salts from 1 on: whatever bucket of a hot shingle's list a row lies in, it is known as a part of it.
                salt = (mix(shingles ^ node.view(np.uint64)) % np.uint64(SALTS)).astype(np.int16) + np.int16(1)
                salt[level < hot] = 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingles.view(np.int64)), pa.array(salt), pa.array(node), pa.array(n.astype(np.int32)), pa.array(place.astype(np.int32))],
                    names=["shingle", "salt", "node", "n", "place"],
                )

    return run


def _possible(n1, p1, n2, p2, percent: int) -> np.ndarray:
    """Whether sets of these sizes that share the shingle at these places, and none before, can reach the similarity."""
    least = -(-percent * (n1 + n2) // (100 + percent))  # the overlap that it takes
    return np.minimum(n1 - p1, n2 - p2) >= least


def _lists(percent: int):
    """Candidate pairs of each list of a shingle, and the members of long lists.  Rows come ordered by list and node."""

    def pairs_of(key, node, n, place) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.diff(np.append(key, len(node)))
        xs, ys = [], []
        short = sizes <= SHORT_LIST
        for k in range(1, SHORT_LIST):  # pairs k apart in one short list
            s, z = key[short & (sizes > k)], sizes[short & (sizes > k)]
            if len(s):
                x = np.repeat(s - np.cumsum(z - k) + (z - k), z - k) + np.arange(int((z - k).sum()))
                xs.append(x)
                ys.append(x + k)
        for s, z in zip(key[~short], sizes[~short], strict=True):
            x = np.arange(s + 1, s + z)
            xs += [np.full(z - 1, s), *(x[: z - k] - 1 for k in range(1, NEXT + 1))]  # with the first, and with the next ones
            ys += [x, *(x[k - 1 :] for k in range(1, NEXT + 1))]
        if not xs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        x, y = np.concatenate(xs), np.concatenate(ys)
        return x, y

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "shingle", "n", "place"]

        def worked(rows: list[np.ndarray], parts: np.ndarray) -> Iterator[pa.RecordBatch]:
            """``parts`` tells whether the first list began before these rows, and whether the last one goes on."""
            shingle, salt, node, n, place = rows
            if not len(node):
                return
            new = np.ones(len(node), bool)
            new[1:] = (np.diff(shingle) != 0) | (np.diff(salt) != 0)
            key = np.flatnonzero(new)
            x, y = pairs_of(key, node, n, place)
            ok = _possible(n[x], place[x], n[y], place[y], percent)
            a, b = node[x[ok]], node[y[ok]]
            a, b = np.minimum(a, b), np.maximum(a, b)
            ok = a != b
            pairs = np.unique(np.stack([a[ok], b[ok]]), axis=1) if ok.any() else np.zeros((2, 0), np.int64)
            if pairs.shape[1]:
                m = pairs.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[0]), pa.array(pairs[1]), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int32())], names=names
                )
            sizes = np.diff(np.append(key, len(node)))
            listed = (sizes > SHORT_LIST) | (salt[key] > 0)
            listed[0] |= parts[0]
            listed[-1] |= parts[1]
            long = np.repeat(listed, sizes)
            if long.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[long]), pa.nulls(int(long.sum()), pa.int64()), pa.array(shingle[long]), pa.array(n[long]), pa.array(place[long])],
                    names=names,
                )

        held: list[np.ndarray] | None = None
        begun = False
        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            # The last list may go on in the next batch; a very long one is worked in runs that share a node.
            ends = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0))
            long_run = not len(ends) and len(rows[0]) > 200_000
            cut = len(rows[0]) - 1 if long_run else (int(ends[-1]) + 1 if len(ends) else 0)
            if cut:
                yield from worked([x[: cut + long_run] for x in rows], (begun, long_run))
                held, begun = [x[cut:] for x in rows], long_run
            else:
                held = rows
        if held is not None:
            yield from worked(held, (begun, False))

    return run


def _near(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Pairs of (node, n, place, component, parity) rows in different components that can reach the similarity."""
    (u, n1, p1, c1, s1), (v, n2, p2, c2, s2) = left, right
    few = len(u) * len(v) <= FEW
    if not few:
        # Parity bits as 1 and -1: a matrix product counts those that agree.
        s1, s2 = (np.unpackbits(x, axis=1).astype(np.float32) * 2 - 1 for x in (s1, s2))
    out = [np.zeros((2, 0), np.int64)]
    for i in range(0, len(u), 256):
        x = slice(i, i + 256)
        both = n1[x, None].astype(np.int64) + n2[None, :]
        least = -(-percent * both // (100 + percent))
        ok = (np.minimum((n1 - p1)[x, None], (n2 - p2)[None, :]) >= least) & (c1[x, None] != c2[None, :])
        if not ok.any():
            continue
        differ = np.bitwise_count(s1[x, None] ^ s2[None, :]).sum(axis=2, dtype=np.int64) if few else (PARITY_BITS - s1[x] @ s2.T) / 2
        j, k = np.nonzero(ok & (differ <= both - 2 * least + 0.25))
        out.append(np.stack([u[x][j], v[k]]))
    return np.unique(np.sort(np.concatenate(out, axis=1), axis=0), axis=1)


def _near_in_runs(rows: list[np.ndarray], left: tuple, right: tuple, same: np.ndarray, percent: int) -> Iterator[np.ndarray]:
    """The same for many short runs: ``left`` and ``right`` are the first rows and the lengths of what meets in each."""
    (i0, ni), (j0, nj) = left, right
    node, n, place, component = (x.astype(np.int64) for x in rows[:4])
    parity = np.ascontiguousarray(rows[4]).view(np.uint64)
    upto = np.concatenate([[0], np.cumsum(ni * nj)])
    a = 0
    while a < len(i0):
        b = max(a + 1, int(np.searchsorted(upto, upto[a] + AT_ONCE, "right")) - 1)
        x = exploded(i0[a:b], ni[a:b])  # each left row as often as it has right ones
        width = np.repeat(nj[a:b], ni[a:b])
        i, j = np.repeat(x, width), exploded(np.repeat(j0[a:b], ni[a:b]), width)
        least = -(-percent * (n[i] + n[j]) // (100 + percent))
        ok = (component[i] != component[j]) & (np.minimum(n[i] - place[i], n[j] - place[j]) >= least)
        ok &= (i < j) | ~np.repeat(np.repeat(same[a:b], ni[a:b]), width)
        i, j, least = i[ok], j[ok], least[ok]
        differ = np.bitwise_count(parity[i] ^ parity[j]).sum(axis=1, dtype=np.int64)
        ok = differ <= n[i] + n[j] - 2 * least
        u, v = node[i[ok]], node[j[ok]]
        yield np.stack([np.minimum(u, v), np.maximum(u, v)])
        a = b


def _unconnected(percent: int):
    """The pairs of two blocks of one list as a frame; the last part of the key tells a block that meets itself."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        def taken(part: pd.DataFrame) -> list[np.ndarray]:
            parity = np.frombuffer(b"".join(part["parity"]), np.uint8).reshape(len(part), -1)
            return [*(part[c].to_numpy() for c in ("a", "n", "place", "component")), parity]

        left, right = (rows, rows) if key[-1] else (rows[rows["side"] == k] for k in (0, 1))
        both = _near(taken(left), taken(right), percent)
        return pd.DataFrame({"a": both[0], "b": both[1]})

    return run


def _unconnected_runs(percent: int):
    """The same for rows that come ordered by list, pair of blocks and side: each run of them is such a pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def worked(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            new = np.zeros(max(0, len(rows[0]) - 1), bool)
            for k in range(5):
                new |= rows[k][1:] != rows[k][:-1]
            bounds = np.concatenate([[0], np.flatnonzero(new) + 1, [len(rows[0])]])
            first, sizes, same = bounds[:-1], np.diff(bounds), rows[5][bounds[:-1]].astype(bool)
            lefts = np.add.reduceat(rows[6] == 0, first, dtype=np.int64)
            i0, ni, j0, nj = first, np.where(same, sizes, lefts), np.where(same, first, first + lefts), np.where(same, sizes, sizes - lefts)
            many, few = ni * nj > FEW, (ni * nj > 0) & (ni * nj <= FEW)

            def found() -> Iterator[np.ndarray]:
                for i, k, j, m in zip(i0[many], ni[many], j0[many], nj[many], strict=True):
                    yield _near([x[i : i + k] for x in rows[7:]], [x[j : j + m] for x in rows[7:]], percent)
                yield from _near_in_runs(rows[7:], (i0[few], ni[few]), (j0[few], nj[few]), same[few], percent)

            for pairs in found():
                if pairs.shape[1]:
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

        held: list[np.ndarray] | None = None
        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:-1]]
            rows.append(np.frombuffer(b"".join(batch.column(batch.num_columns - 1).to_pylist()), np.uint8).reshape(batch.num_rows, -1))
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            ends = np.zeros(max(0, len(rows[0]) - 1), bool)
            for k in range(5):
                ends |= rows[k][1:] != rows[k][:-1]
            ends = np.flatnonzero(ends)
            cut = int(ends[-1]) + 1 if len(ends) else 0  # the last pair of blocks may go on in the next batch
            if cut:
                yield from worked([x[:cut] for x in rows])
            held = [x[cut:] for x in rows]
        if held is not None and len(held[0]):
            yield from worked(held)

    return run


def _block_pairs(rest: DataFrame, percent: int) -> DataFrame:
    """Rows of open lists, each sent to the pairs of blocks that it is to be compared in: (shingle, x, y, same, side, ...).

    A list is cut by classes of sizes, of which only neighbours can reach the similarity, and each class by hash into
    blocks of about ``BLOCK`` members.
    """
    step = math.log(100 / percent) if percent < 100 else 1.0
    rest = rest.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / F.lit(step) + F.lit(1e-9)).cast("int"))
    rest = rest.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALTS)))
    counts = rest.groupBy("shingle", "class").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
    # Numbers of blocks of the class and of its neighbours; salted, as a long list is many rows of one key.
    near = counts.select("shingle", F.explode(F.array(*(F.struct((F.col("class") + d).alias("class"), F.lit(-d).alias("d")) for d in (-1, 0, 1)))).alias("x"), "blocks")
    near = near.select("shingle", "x.class", "x.d", "blocks").groupBy("shingle", "class").agg(
        *(F.coalesce(F.max(F.when(F.col("d") == d, F.col("blocks"))), F.lit(0)).alias(name) for d, name in ((-1, "below"), (0, "own"), (1, "above")))
    )
    near = near.where("own > 0").withColumn("salt", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")))
    rows = rest.join(near, ["shingle", "class", "salt"]).withColumn("block", F.pmod(F.xxhash64("a", F.lit("block")), F.col("own")))
    place = "named_struct('c', class, 'k', block)"
    upto = lambda n: f"CASE WHEN {n} > 0 THEN sequence(0L, {n} - 1) ELSE array() END"
    as_left = f"transform(sequence(block, own - 1), j -> named_struct('x', {place}, 'y', named_struct('c', class, 'k', j), 'side', 0))"
    as_left_up = f"transform({upto('above')}, j -> named_struct('x', {place}, 'y', named_struct('c', class + 1, 'k', j), 'side', 0))"
    as_right = f"transform({upto('block')}, j -> named_struct('x', named_struct('c', class, 'k', j), 'y', {place}, 'side', 1))"
    as_right_up = f"transform({upto('below')}, j -> named_struct('x', named_struct('c', class - 1, 'k', j), 'y', {place}, 'side', 1))"
    sent = rows.select("shingle", "a", "n", "place", "component", "parity", F.explode(F.expr(f"concat({as_left}, {as_left_up}, {as_right}, {as_right_up})")).alias("to"))
    return sent.select("shingle", "to.x", "to.y", F.expr("to.x = to.y").alias("same"), "to.side", "a", "n", "place", "component", "parity")


def _alike(percent: int):
    """Of pairs with the sizes and parity sketches of both sets those that can reach the similarity, with the sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column(2).to_numpy().astype(np.int64) + batch.column(3).to_numpy()
            least = -(-percent * both // (100 + percent))
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint64).reshape(batch.num_rows, PARITY_BITS // 64) for k in (4, 5))
            differ = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
            ok = (np.minimum(batch.column(2).to_numpy(), batch.column(3).to_numpy()) >= least) & (differ <= both - 2 * least)
            yield batch.select([0, 1, 2, 3]).filter(pa.array(ok))

    return run


def _groups(found: DataFrame) -> DataFrame:
    """(node, g, block, cuts) for candidate pairs (a, b, na, nb): the sets that meet in each group.

    A group is the set of its ``g`` and, of the larger nodes paired with it, those of one ``block``, about ``FRAGMENT``
    shingles or ``GROUP`` sets; it is counted in ``cuts`` fragments.
    """
    hubs = found.groupBy("a").agg(
        F.ceil(F.greatest(F.sum("nb") / F.lit(FRAGMENT), F.count("*") / F.lit(GROUP))).cast("int").alias("blocks"),
        F.ceil(F.max(F.greatest("na", "nb")) / F.lit(FRAGMENT)).cast("int").alias("cuts"),
    )
    first = hubs.select(F.col("a").alias("node"), F.col("a").alias("g"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "cuts")
    others = found.join(hubs, "a").select(
        F.col("b").alias("node"), F.col("a").alias("g"), F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"), "cuts"
    )
    return first.union(others)


def _fragments(size: int):
    """The fragments of each set, once for each group it is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["g", "block", "fragment", "node", "n", "own"]
            )

        for batch in slices(batches):
            texts = [t.encode("utf-8") for t in batch.column(0).to_pylist()]
            node, groups = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            rows, held = [], 0
            for first, shingles, counts in shingle_sets(texts, size):
                ends = np.concatenate([[0], np.cumsum(counts)]).tolist()
                for i in range(len(counts)):
                    own, k = shingles[ends[i] : ends[i + 1]], first + i
                    parts: dict[int, list[bytes]] = {}
                    for to in groups[k]:
                        if (f := to["cuts"]) not in parts:
                            # Hashes are sorted: each fragment is a run of them.
                            at = [0, *np.searchsorted(own, np.array([(j << 64) // f for j in range(1, f)], np.uint64)).tolist(), len(own)]
                            parts[f] = [own[x:y].tobytes() for x, y in zip(at, at[1:], strict=False)]
                        rows += [(to["g"], to["block"], j, node[k], len(own), part) for j, part in enumerate(parts[f])]
                        held += own.nbytes
                        if held > HANDED:
                            yield handed(rows)
                            rows, held = [], 0
            if rows:
                yield handed(rows)

    return run


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial overlaps of a group's first set with its others.  Rows come ordered by group and fragment, the first set first."""
    nx, x = 0, np.zeros(0, np.uint64)
    for batch in batches:
        g, node, n, own = (batch.column(k).to_pylist() for k in (0, 3, 4, 5))
        rows = []
        for i in range(len(g)):
            y = np.frombuffer(own[i], np.uint64)
            if node[i] == g[i]:
                nx, x = n[i], y
                continue
            both = np.concatenate([x, y])
            both.sort()
            rows.append((g[i], node[i], nx, n[i], int((both[1:] == both[:-1]).sum())))
        if rows:
            columns = list(zip(*rows, strict=True))
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["a", "b", "na", "nb", "part"]
            )


def _verified(texts: DataFrame, nodes: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The candidate pairs (a < b) that reach the similarity."""
    n_parts = partitions(texts.sparkSession)
    one, other = (nodes.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("parity").alias(f"parity_{k}")) for k in "ab")
    asked = pairs.join(one, "a").join(other, "b").select("a", "b", "na", "nb", "parity_a", "parity_b")
    found = stored(asked.mapInArrow(_alike(percent), "a bigint, b bigint, na int, nb int"), "candidates")
    groups = _groups(found).groupBy("node").agg(F.collect_list(F.struct("g", "block", "cuts")).alias("groups"))
    wanted = groups.join(nodes.select("node", "row"), "node")
    chosen = texts.join(wanted, "row").select("text", "node", "groups")
    sets = chosen.mapInArrow(_fragments(size), "g bigint, block int, fragment int, node bigint, n int, own binary")
    rows = sets.repartition(n_parts, "g", "block", "fragment").sortWithinPartitions("g", "block", "fragment", F.col("node") != F.col("g"))
    partial = rows.mapInArrow(_overlaps, "a bigint, b bigint, na int, nb int, part int")
    summed = partial.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("both"))
    return summed.where(f"100 * both >= {percent} * (na + nb - both)").select("a", "b")


def shingle_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    Documents link when their shingle sets have a Jaccard similarity of ``percent`` / 100 at least; the component is the
    least doc_id that links reach.  A NULL or blank text has no shingles and no link.  Every row counts with its own text,
    also where rows repeat a doc_id; rows with a NULL doc_id link with nothing and have no component.  Other columns are
    ignored, an empty table gives no rows.
    """
    spark = docs.sparkSession
    n_parts = partitions(spark)
    texts = numbered(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")), "row")
    seen = stored(texts.mapInArrow(_profile(size), "doc_id bigint, row bigint, n bigint, node bigint, parity binary, slice int, counts binary"), "profile")
    profile = seen.where("slice is null").select("doc_id", "row", "n", "node")
    levels = spark.sparkContext.broadcast(_levels(seen.where("slice is not null").select("slice", "counts")))
    nodes = seen.where("slice is null and n > 0 and doc_id is not null").groupBy("node").agg(
        F.min("row").alias("row"), F.first("n").cast("int").alias("n"), F.first("parity").alias("parity")
    )
    nodes = stored(nodes, "nodes")

    rows = texts.where("doc_id is not null").select("text").mapInArrow(
        _prefixes(size, percent, levels), "shingle bigint, salt smallint, node bigint, n int, place int"
    )
    met = rows.repartition(n_parts, "shingle", "salt").sortWithinPartitions("shingle", "salt", "node")
    found = stored(met.mapInArrow(_lists(percent), "a bigint, b bigint, shingle bigint, n int, place int"), "lists")
    pairs = stored(found.where("b is not null").select("a", "b").distinct(), "pairs")
    long = found.where("b is null").select("shingle", "a", "n", "place").distinct()

    links = stored(_verified(texts, nodes, pairs, size, percent), "verified")
    label = components(links)
    named = label.select(F.col("id").alias("a"), "component")
    members = stored(long.join(named, "a", "left").withColumn("component", F.coalesce("component", "a")), "members")
    open_ = members.groupBy("shingle").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    rest = members.join(open_.select("shingle"), "shingle", "left_semi")
    rest = rest.join(nodes.select(F.col("node").alias("a"), "parity"), "a")
    sent = _block_pairs(rest, percent)
    names = ["shingle", "xc", "xk", "yc", "yk", "same", "side", "a", "n", "place", "component", "parity"]
    sent = sent.selectExpr("shingle", "x.c AS xc", "x.k AS xk", "y.c AS yc", "y.k AS yk", *names[5:])
    sent = sent.repartition(n_parts, *names[:5]).sortWithinPartitions(*names[:5], "side")
    more = sent.mapInArrow(_unconnected_runs(percent), "a bigint, b bigint").distinct()
    more = stored(more.join(pairs, ["a", "b"], "left_anti"), "more-pairs")
    if not more.isEmpty():
        label = components(links.union(_verified(texts, nodes, more, size, percent)))
    label = stored(label, "labels")

    named = profile.join(label.select(F.col("id").alias("node"), "component"), "node", "left")
    named = named.withColumn("component", F.when(F.col("n") > 0, F.coalesce("component", "node")))
    least = named.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    out = named.join(least, "component", "left")
    least_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), least_id.alias("component_id"))
