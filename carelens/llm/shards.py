"""Two-pass external shuffle: rows in random order, dealt to shards whose row counts differ by one at most.

Pass one scatters rows by a seeded hash into buckets of bounded bytes; pass two shuffles each bucket in memory
(Fisher-Yates) and writes it.  The buckets one after another are the shuffled order, which the shards cut into equal
runs; a bucket therefore writes into one or two shards.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.llm.common import numbered, scratch

BUCKET_BYTES = 16 << 20
#: The table of bucket sizes is broadcast up to this many buckets (24 bytes each), else joined by a shuffle.
BROADCAST_BUCKETS = 500_000


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform permutation by exchanges from the end; all draws are made at once."""
    order = list(range(n))
    draws = (rng.random(n) * np.arange(1, n + 1)).astype(np.int64).tolist()
    for i in range(n - 1, 0, -1):
        j = draws[i]
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def _shuffled(seed: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_row"], kind="stable")  # a fixed order to start from, so a retry gives the same
        order = fisher_yates(len(rows), np.random.default_rng([seed, int(key[0])]))
        rows = rows.iloc[order].copy()
        rows["_place"] = np.arange(len(rows), dtype=np.int64)
        return rows.drop(columns="_row")

    return run


def row_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (NULL: none) plus 8."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 8


def write_shards(
    docs: DataFrame, path: str, n_shards: int = 24, seed: int = 17, bucket_bytes: int = BUCKET_BYTES
) -> None:
    """Shuffle all rows and write ``path/shard=.../`` with ``slot``, the gapless place in the shard.

    Every row of ``docs`` is kept as it is, NULLs, repeated rows and ids included.  Rows scatter by id and by their
    place in the scan, so neither a repeated id nor NULL ids fill one bucket; the order is the same for the same files
    and splits.  Shards differ by one row at most.  An empty table gives an empty folder.  Columns of ``docs`` called
    ``slot``, ``shard``, ``_row``, ``_bucket`` or ``_place`` are left out.
    """
    docs = docs.drop("slot", "shard", "_row", "_bucket", "_place")
    seen = docs.agg(F.sum(row_bytes(F.col("text"))).alias("b")).first()["b"] or 0
    n_buckets = max(1, math.ceil(seen / bucket_bytes))
    scattered = numbered(docs, "_row").withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "_row"), F.lit(n_buckets)))
    # Counts need no text, so the scan of this small job reads the ids alone; one row per bucket.
    sizes = scattered.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "_bucket",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"),
        F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"),
    )
    if n_buckets <= BROADCAST_BUCKETS:
        sizes = F.broadcast(sizes)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    schema = ", ".join([*fields, "_bucket bigint", "_place bigint"])
    shuffled = scattered.groupBy("_bucket").applyInPandas(_shuffled(seed), schema)
    rank = F.col("_first") + F.col("_place")
    # The shard whose run [ceil(s * all / n), ceil((s + 1) * all / n)) holds the rank.
    placed = shuffled.join(sizes, "_bucket").withColumn("shard", F.expr(f"int((_first + _place) * {n_shards} div _all)"))
    placed = placed.withColumn("slot", rank - F.expr(f"(shard * _all + {n_shards - 1}) div {n_shards}"))
    placed.select(*docs.columns, "slot", "shard").write.partitionBy("shard").parquet(path)


def shard_digest(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """Write the shards of (doc_id, text), read them back, and give a row per document from what was read."""
    spark = docs.sparkSession
    path = scratch(spark, "shards")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    write_shards(rows, path, n_shards)
    back = spark.read.schema("doc_id bigint, text string, slot bigint, shard int").parquet(path)
    return back.select(
        "doc_id",
        row_bytes(F.col("text")).alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "utf-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
