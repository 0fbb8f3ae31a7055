"""Best-fit packing of documents into token sequences by a grouping genetic algorithm on islands.

Documents are dealt at random to blocks of bounded size.  A block is packed by several islands, each a population of
packings.  A child takes whole well-filled bins of one parent into a copy of the other; bins of the copy that hold a
document twice are taken apart, and what loses its place goes best-fit into the bins that are left.  The elite of each
island migrates to the next one.  A packing that needs no more bins than its tokens fill is proven best and ends its block.
Bins that are not well filled are taken apart in the end, and the documents of all blocks' such bins are packed anew.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import numbered, partitions, slices, stored, whole_text
from carelens.llm.token_store import coder

#: Documents of a block, islands of a block, packings of an island.
BLOCK, ISLANDS, POPULATION = 4096, 2, 5
#: Evolutions (migration lies between them), children of each evolution, packings that migrate.
ROUNDS, CHILDREN, ELITE = 4, 48, 2
#: A bin that lacks no more than this share of its room is well filled: it is injected first, and stays in the end.
SLACK = 1 / 256


class Packings:
    """The packings of one set of documents, whose sizes come in descending order; bins are numbered from 0."""

    def __init__(self, sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> None:
        self.sizes, self.capacity, self.rng = sizes, capacity, rng
        self.list = sizes.tolist()
        self.least = -(-int(sizes.sum()) // capacity)

    def fills(self, genome: np.ndarray) -> np.ndarray:
        return np.bincount(genome, self.sizes).astype(np.int64)

    def worth(self, genome: np.ndarray) -> tuple[int, float]:
        """Bins, then how unevenly they are filled: full ones beside empty ones leave room for more."""
        fills = self.fills(genome)
        return len(fills), -float((fills.astype(float) ** 2).sum())

    def best_fit(self, genome: np.ndarray, items: list[int], room: list[int]) -> np.ndarray:
        """Put ``items`` in turn into the open bin that they fill best; ``room`` is the room left in each bin."""
        by_room: dict[int, list[int]] = {}
        for b, r in enumerate(room):
            if r:
                by_room.setdefault(r, []).append(b)
        open_ = sum(1 << r for r in by_room)  # a bit for each room that some bin has
        count, sizes = len(room), self.list
        for i in items:
            size = sizes[i]
            fitting = open_ >> size
            if fitting:
                r = size + (fitting & -fitting).bit_length() - 1
                bins = by_room[r]
                b = bins.pop()
                if not bins:
                    open_ ^= 1 << r
            else:
                b, r, count = count, self.capacity, count + 1
            genome[i] = b
            r -= size
            if r:
                bins = by_room.setdefault(r, [])
                if not bins:
                    open_ |= 1 << r
                bins.append(b)
        return genome

    def first(self) -> np.ndarray:
        """Best fit in descending order of sizes."""
        return self.best_fit(np.zeros(len(self.sizes), np.int64), range(len(self.list)), [])

    def varied(self) -> np.ndarray:
        """Best fit in an order that is descending but for some noise."""
        order = np.argsort(-self.sizes * self.rng.uniform(0.7, 1.0, len(self.sizes)), kind="stable")
        return self.best_fit(np.zeros(len(self.sizes), np.int64), order.tolist(), [])

    def child(self, host: np.ndarray, donor: np.ndarray) -> np.ndarray:
        """Whole bins of ``donor``, well-filled ones first, in a copy of ``host``."""
        fills = self.fills(donor)
        rank = np.argsort(-(fills * self.rng.uniform(1 - 8 * SLACK, 1.0, len(fills))), kind="stable")
        taken = np.zeros(len(fills), bool)
        taken[rank[: max(1, int(len(fills) * self.rng.uniform(0.1, 0.5)))]] = True
        injected = taken[donor]
        apart = np.zeros(int(host.max()) + 1, bool)
        apart[host[injected]] = True  # they would hold a document twice
        weak = self.fills(host)
        apart |= weak <= np.quantile(weak, self.rng.uniform(0.0, 0.1))
        displaced = apart[host] & ~injected
        names, more = np.cumsum(~apart) - 1, np.cumsum(taken) - 1
        left = int((~apart).sum())
        genome = np.where(injected, left + more[donor], names[host])
        placed = ~displaced
        room = self.capacity - np.bincount(genome[placed], self.sizes[placed], left + int(taken.sum())).astype(np.int64)
        return self.best_fit(genome, np.flatnonzero(displaced).tolist(), room.tolist())

    def evolve(self, population: list[np.ndarray], children: int) -> list[np.ndarray]:
        """The best ``POPULATION`` packings, best first, after so many children; ends when one is proven best."""
        ranked = sorted(((self.worth(g), k, g) for k, g in enumerate(population)), key=lambda x: x[:2])
        for k in range(children):
            if ranked[0][0][0] <= self.least:
                return [ranked[0][2]]
            host, donor = self.rng.choice(len(ranked), 2, replace=len(ranked) < 2)
            genome = self.child(ranked[int(host)][2], ranked[int(donor)][2])
            ranked.append((self.worth(genome), len(population) + k, genome))
            ranked.sort(key=lambda x: x[:2])
            del ranked[POPULATION:]
        return [g for _, _, g in ranked]


def _evolved(capacity: int, seed: int, turn: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One evolution of every (block, island): rows (block, island, rows, sizes, genomes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8):
            block, island, _, sizes, genomes = (c.to_pylist() if k != 2 else c for k, c in enumerate(batch.columns))
            out = []
            for b, i, s, known in zip(block, island, sizes, genomes, strict=True):
                work = Packings(np.array(s, np.int64), capacity, np.random.default_rng([seed, turn, b, i]))
                population = [np.frombuffer(g, "<u2").astype(np.int64) for g in known or ()]
                if not population:
                    population = [work.first()]
                    if work.worth(population[0])[0] > work.least:
                        population += [work.varied() for _ in range(POPULATION - 1)]
                out.append([g.astype("<u2").tobytes() for g in work.evolve(population, CHILDREN)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.list_(pa.binary()))], names=["block", "island", "rows", "sizes", "genomes"])

    return run


def _placed(capacity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of each block's packing: (row, size, block, bin, offset, fill); a bin's documents follow their sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8):
            for block, rows, sizes, genome in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sizes, bins = np.array(sizes, np.int64), np.frombuffer(genome, "<u2").astype(np.int64)
                order = np.argsort(bins, kind="stable")
                own, size = bins[order], sizes[order]
                ends, fills = np.cumsum(size), np.bincount(bins, sizes).astype(np.int64)
                assert fills.max(initial=0) <= capacity
                offset = ends - size - (np.cumsum(fills) - fills)[own]
                columns = [np.array(rows, np.int64)[order], size, np.full(len(own), block), own, offset, fills[own]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "size", "block", "bin", "offset", "fill"])

    return run


def pack_sizes(items: DataFrame, capacity: int, seed: int = 11) -> DataFrame:
    """(row, sequence_id, offset) for every row of ``items`` (row: a number for each, size: from 1 to ``capacity``).

    Rows of one sequence lie behind one another from offset 0.  Sequence ids are numbers that tell sequences apart.  An
    empty table gives no rows.
    """
    spark = items.sparkSession
    done, level, before = [], 0, None
    items = items.select("row", F.col("size").cast("int").alias("size"))
    n = items.count()
    sequence = lambda k: (F.lit(k << 48) + F.shiftleft("block", 16) + F.col("bin")).alias("sequence_id")
    while True:
        n_blocks = max(1, math.ceil(n / BLOCK))
        placed = _packed(items, n_blocks, capacity, seed + level)
        bins = placed.where("offset = 0").count()
        if before is not None and bins >= before[1]:  # packed anew they need no fewer bins: the packing before holds
            done.append(before[0])
            break
        whole = placed.where(F.col("fill") >= capacity * (1 - SLACK)).select("row", sequence(level), "offset")
        rest = placed.where(F.col("fill") < capacity * (1 - SLACK))
        left = rest.count()
        if n_blocks == 1 or left * 2 > n:
            done.append(placed.select("row", sequence(level), "offset"))
            break
        done.append(whole)
        before = rest.select("row", sequence(level), "offset"), rest.where("offset = 0").count()
        items, n, level = rest.select("row", F.col("size").cast("int").alias("size")), left, level + 1
        if not n:
            break
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out if done else spark.createDataFrame([], "row bigint, sequence_id bigint, offset bigint")


def _packed(items: DataFrame, n_blocks: int, capacity: int, seed: int) -> DataFrame:
    n_parts = min(n_blocks * ISLANDS, 4 * partitions(items.sparkSession))
    dealt = items.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(n_blocks).cast("bigint")))
    # Blocks hold about BLOCK documents, as the hash deals them evenly whatever repeats.
    blocks = dealt.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("size", "row")), asc=False).alias("x"))
    blocks = blocks.select("block", F.expr(f"explode(sequence(0, {ISLANDS - 1}))").alias("island"), F.col("x.row").alias("rows"), F.col("x.size").alias("sizes"))
    schema = "block bigint, island int, rows array<bigint>, sizes array<int>, genomes array<binary>"
    islands = blocks.withColumn("genomes", F.lit(None).cast("array<binary>"))
    for turn in range(ROUNDS):
        if turn:
            # Each island gets the elite of the one before it; its own weakest give way.
            elite = islands.select("block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.slice("genomes", 1, ELITE).alias("elite"))
            islands = islands.join(elite, ["block", "island"]).withColumn("genomes", F.array_distinct(F.concat("elite", "genomes"))).drop("elite")
        islands = islands.repartition(n_parts, "block", "island").select("block", "island", "rows", "sizes", "genomes")
        islands = stored(islands.mapInArrow(_evolved(capacity, seed, turn), schema), "islands")
    # Islands rank by the number of bins of their first packing, which is the highest bin and one.
    best = islands.mapInArrow(_ranked, "block bigint, bins int, island int, genome binary").groupBy("block").agg(F.min_by("genome", F.struct("bins", "island")).alias("genome"))
    whole = islands.where("island = 0").select("block", "rows", "sizes").join(best, "block")
    return stored(whole.mapInArrow(_placed(capacity), "row bigint, size bigint, block bigint, bin bigint, offset bigint, fill bigint"), "packed")


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        first = [g[0] for g in batch.column(4).to_pylist()]
        bins = [int(np.frombuffer(g, "<u2").max()) + 1 for g in first]
        columns = [batch.column(0), pa.array(bins, pa.int32()), batch.column(1), pa.array(first, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "bins", "island", "genome"])


def _pieces(tokenizer: str, capacity: int, end_id: int, with_ids: bool):
    """Pieces of each document from (row, doc_id, text): the first may be shorter, all others fill a sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = coder(tokenizer)
        for batch in slices(batches):
            rows, doc_ids = batch.column(0), batch.column(1)
            for first, ids, counts in encode(batch.column(2).to_pylist()):
                whole = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
                counts = counts + 1
                n = -(-counts // capacity)
                of = np.repeat(np.arange(len(n)), n)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                head = counts - (n - 1) * capacity
                start = np.where(piece == 0, 0, head[of] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[of], capacity)
                ends = np.cumsum(length)
                values = [whole[a:b] for a, b in zip((ends - length).tolist(), ends.tolist(), strict=True)]
                last = pa.array([v.astype(np.int32) for v in values], pa.list_(pa.int32())) if with_ids else pa.array([zlib.crc32(v.tobytes()) for v in values], pa.int64())
                taken = pa.array(of + first)
                yield pa.RecordBatch.from_arrays(
                    [rows.take(taken), doc_ids.take(taken), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), last],
                    names=["row", "doc_id", "piece", "start", "length", "last"],
                )

    return run


def packed_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 (``with_ids``: ids), sequence_id, offset.

    A NULL text is empty and has the end id alone.  Only documents of more than ``capacity`` ids are cut.  Each row is a
    document of its own, whether it repeats a doc_id or has none.  Other columns are ignored; an empty table gives no rows.
    """
    rows = numbered(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")), "row")
    last = "ids array<int>" if with_ids else "ids_crc32 bigint"
    cut = rows.select("row", "doc_id", "text").mapInArrow(
        _pieces(tokenizer, capacity, end_id, with_ids), f"row bigint, doc_id bigint, piece int, start bigint, length bigint, {last}"
    )
    pieces = stored(cut, "pieces")
    # A full piece is a sequence; of each document at most the first piece is left to be packed.
    full = pieces.where(F.col("length") == capacity).withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint")})
    part = pieces.where(F.col("length") < capacity)
    packed = part.join(pack_sizes(part.select("row", F.col("length").alias("size")), capacity), "row")
    return full.drop("row").unionByName(packed.drop("row"))


def packed_sequences(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """(sequence_id, doc_ids, lengths, ids): the sequences themselves, at most ``capacity`` ids each, ready to be written."""
    pieces = packed_pieces(docs, tokenizer, capacity, end_id, with_ids=True)
    held = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids"))).alias("x")
    whole = pieces.groupBy("sequence_id").agg(held)
    return whole.select("sequence_id", F.col("x.doc_id").alias("doc_ids"), F.col("x.length").alias("lengths"), F.flatten("x.ids").alias("ids"))
