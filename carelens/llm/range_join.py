"""Exact metric range join: vectors of one label whose cosine reaches a bound, and their connected components.

On the unit sphere the cosine bound is a bound ``r`` on the chord.  Pivots part each label into cells of nearest pivots.
A vector goes to every other cell that could hold a partner: by the triangle inequality none is nearer to the cell's
bisector than ``r`` and none farther from its pivot than the cell's radius plus ``r``.  So a vector of a cell meets all
its partners there, and cells are joined apart from each other; large ones in pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import partitions, slices, stored
from carelens.llm.components import components

#: Vectors of a block, and of a cell that is not cut further.
BLOCK = 2048
#: Pivots of one label and of all labels: what tasks are sent is bounded.
LABEL_PIVOTS, ALL_PIVOTS = 64, 50_000


def _nearest(batches: Iterator[pa.RecordBatch], pivots: dict, radius: dict | None, r: float) -> Iterator[pa.RecordBatch]:
    """Rows (node, label, dims, times, vector, cell, core); copies for other cells only with their radii known."""
    for batch in slices(batches, 2000):
        node, label, dims, times = (batch.column(k).to_numpy() for k in range(4))
        vectors = batch.column(4).to_pylist()
        kinds = pd.DataFrame({"label": label, "dims": dims}).groupby(["label", "dims"]).indices
        for kind, rows in kinds.items():
            x = np.array([vectors[i] for i in rows], np.float64)
            x = x / np.linalg.norm(x / np.abs(x).max(axis=1)[:, None], axis=1)[:, None] / np.abs(x).max(axis=1)[:, None]
            p = pivots.get(kind)
            if p is None:
                own, far, to = np.zeros(len(x), np.int64), np.zeros((len(x), 1)), np.zeros((len(x), 1), bool)
            else:
                far = np.sqrt(np.maximum(0, 2 - 2 * (x @ p.T)))
                own = far.argmin(axis=1)
            every = np.arange(len(x))
            if radius is None:
                # Labels without pivots have one cell and no use for a radius.
                reach = far[every, own] if p is not None else np.full(len(x), -1.0)
                cells = pd.DataFrame({"label": label[rows], "dims": dims[rows], "cell": own, "far": reach})
                out = cells.groupby(["label", "dims", "cell"], as_index=False).agg(far=("far", "max"), n=("far", "size"))
                yield pa.RecordBatch.from_pandas(out.astype({"label": "int64", "dims": "int32", "cell": "int32", "n": "int64"}), preserve_index=False)
                continue
            if p is not None:
                reach = np.array([radius.get((*kind, c), -9.0) for c in range(len(p))])
                apart = np.sqrt(np.maximum(0, 2 - 2 * (p @ p.T)))[own]
                bisector = (far**2 - (far[every, own] ** 2)[:, None]) / np.maximum(2 * apart, 1e-12)
                to = (bisector <= r + 1e-9) & (far <= reach + r + 1e-9)  # the margin covers rounding
                to[every, own] = False
            u, c = np.nonzero(to)
            rows_ = np.concatenate([rows, rows[u]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(node[rows_]), pa.array(label[rows_]), pa.array(dims[rows_]), pa.array(times[rows_]),
                    batch.column(4).take(pa.array(rows_)), pa.array(np.concatenate([own, c]).astype(np.int32)),
                    pa.array(np.arange(len(rows_)) < len(rows)),
                ],
                names=["node", "label", "dims", "times", "vector", "cell", "core"],
            )


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of every id to the least of its component in this list of links."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    x, y = at[: len(u)], at[len(u) :]
    least = np.arange(len(ids))
    while True:
        low = np.minimum(least[x], least[y])
        after = least.copy()
        for side in (x, y, least[x], least[y]):
            np.minimum.at(after, side, low)
        after = after[after]
        if (after == least).all():
            break
        least = after
    far = least != np.arange(len(ids))
    return ids[far], ids[least[far]]


def _joined_block(cosine: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = rows[rows["side"] == 0]
        other = rows[rows["side"] == 1]
        names = {"a": "int64", "b": "int64", "n": "int64"}
        if not len(own) or not len(other):
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in names.items()})
        x, y = (np.array(part["vector"].tolist(), np.float64) for part in (own, other))
        # Scaled by the largest component first: squares neither overflow nor vanish.
        x, y = (z / np.abs(z).max(axis=1)[:, None] for z in (x, y))
        norms = [np.sqrt((z * z).sum(axis=1)) for z in (x, y)]
        hit = (x @ y.T) / (norms[0][:, None] * norms[1][None, :]) >= cosine
        a, b, times = own["node"].to_numpy(), other["node"].to_numpy(), other["times"].to_numpy()
        hit &= a[:, None] != b[None, :]
        counts = hit @ times
        u, v = np.nonzero(hit)
        down, up = _forest(a[u], b[v]) if len(u) else (a[:0], a[:0])
        some = counts > 0
        return pd.DataFrame(
            {
                "a": np.concatenate([a[some], down]),
                "b": np.concatenate([np.zeros(int(some.sum()), np.int64), up]),
                "n": np.concatenate([counts[some], np.zeros(len(down), np.int64)]),
            }
        )

    return run


def cosine_links(vectors: DataFrame, cosine: float = 0.93) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Rows link when their labels are equal and the cosine in double precision reaches ``cosine``.  Vectors that are NULL,
    empty or zero or hold NULL or non-finite components link with nothing, as do rows without a label or a vec_id, and
    vectors of different lengths.  Rows that repeat a vec_id count as vectors of their own.  Equal vectors are compared
    once, with their number.  Other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    part = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    good = "vec_id is not null and label is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
    good += " and exists(vector, x -> x <> 0)"
    rows = part.withColumn("node", F.when(F.expr(f"coalesce({good}, false)"), F.xxhash64("label", "vector")))
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("times"), F.min("vec_id").alias("least")
    )
    nodes = stored(nodes.select("node", "label", F.size("vector").alias("dims"), "times", "vector", "least"), "vectors")

    sizes = nodes.groupBy("label", "dims").agg(F.count("*").alias("n")).where(f"n > {BLOCK}")
    sizes = sizes.withColumn("p", F.least(F.lit(LABEL_PIVOTS), F.ceil(F.col("n") / BLOCK)))
    all_pivots = sizes.agg(F.sum("p")).first()[0] or 0
    share = min(1.0, ALL_PIVOTS / max(1, all_pivots))
    draw = F.pmod(F.xxhash64("node", F.lit("pivot")), F.lit(1 << 30)) < F.col("p") / F.col("n") * share * (1 << 30)
    pivots: dict[tuple, list] = {}
    for row in nodes.join(sizes, ["label", "dims"]).where(draw).select("label", "dims", "vector").limit(2 * ALL_PIVOTS).collect():
        pivots.setdefault((row["label"], row["dims"]), []).append(row["vector"])
    known = {}
    for kind, found in pivots.items():
        p = np.array(found, np.float64)
        p = p / np.abs(p).max(axis=1)[:, None]
        known[kind] = p / np.linalg.norm(p, axis=1)[:, None]
    r = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    sent = spark.sparkContext.broadcast(known)
    plain = nodes.select("node", "label", "dims", "times", "vector")
    cells = plain.mapInArrow(lambda b: _nearest(b, sent.value, None, r), "label bigint, dims int, cell int, far double, n bigint")
    cells = stored(cells.groupBy("label", "dims", "cell").agg(F.max("far").alias("far"), F.sum("n").alias("n")), "cells")
    # One row for each pivot.
    reach = {(c["label"], c["dims"], c["cell"]): c["far"] for c in cells.where("far >= 0").collect()} if known else {}
    radius = spark.sparkContext.broadcast(reach)
    placed = plain.mapInArrow(
        lambda b: _nearest(b, sent.value, radius.value, r),
        "node bigint, label bigint, dims int, times bigint, vector array<double>, cell int, core boolean",
    )
    placed = stored(placed, "cells")
    shape = placed.groupBy("label", "dims", "cell").agg(F.count_if("core").alias("n_own"), F.count("*").alias("n_all"))
    shape = shape.select("label", "dims", "cell", F.ceil(F.col("n_own") / BLOCK).cast("int").alias("own"), F.ceil(F.col("n_all") / BLOCK).cast("int").alias("every"))
    placed = placed.join(shape, ["label", "dims", "cell"])
    spread = F.xxhash64("node", F.lit("block"))
    common = ("label", "dims", "cell", "node", "times", "vector")
    own = placed.where("core").select(*common, F.pmod(spread, "own").alias("i"), F.explode(F.sequence(F.lit(0), F.col("every") - 1)).alias("j"), F.lit(0).alias("side"))
    other = placed.where("own > 0").select(*common, F.explode(F.sequence(F.lit(0), F.col("own") - 1)).alias("i"), F.pmod(spread, "every").alias("j"), F.lit(1).alias("side"))
    blocks = own.withColumn("i", F.col("i").cast("int")).unionByName(other.withColumn("j", F.col("j").cast("int")))
    met = blocks.groupBy("label", "dims", "cell", "i", "j").applyInPandas(_joined_block(cosine), "a bigint, b bigint, n bigint")
    met = stored(met, "links")
    counts = met.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    label = components(met.where("n = 0")).select(F.col("id").alias("node"), "component")
    named = nodes.select("node", "times", "least").join(label, "node", "left").join(counts, "node", "left")
    named = named.select("node", F.coalesce("component", "node").alias("component"), (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), "least")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(smallest, "component").select("node", "n_links", "component_id")
    out = rows.select("vec_id", "node").join(named, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept")
    )
