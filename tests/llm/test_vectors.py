"""The metric range join against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelens.llm import range_join

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors():
    rng = np.random.default_rng(8)
    rows = []
    for label in (0, 1, 2):
        centres = rng.normal(size=(6, 8))
        for k in range(70):  # similarities lie on both sides of the bound
            v = centres[k % 6] + rng.normal(size=8) * 0.22
            rows.append((1000 * label + k, [float(np.float32(x)) for x in v], label))
    rows += [(5000 + k, rows[3][1], 0) for k in range(40)]  # one vector many times
    rows += [(6000, None, 0), (6001, [0.0] * 8, 0), (6002, [float("nan")] * 8, 0), (6003, [None, *[1.0] * 7], 0), (6004, [], 0)]
    rows += [(6005, rows[3][1], None), (None, rows[3][1], 0), (6006, rows[3][1][:4], 0), (6007, [float("inf")] + [1.0] * 7, 1)]
    rows += [(6008, [x * 2.0**-100 for x in rows[3][1]], 0), (6009, rows[75][1], 1), (6009, rows[75][1], 1)]
    random.Random(1).shuffle(rows)
    return rows


def by_all_pairs(rows):
    good = [i for i, (v, e, x) in enumerate(rows) if v is not None and x is not None and e and all(c is not None and np.isfinite(c) for c in e) and any(e)]
    part, links = {i: i for i in good}, dict.fromkeys(range(len(rows)), 0)
    for i in good:
        for j in good:
            if i < j and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.93:
                    links[i] += 1
                    links[j] += 1
                    x, y = part[i], part[j]
                    part = {k: x if v == y else v for k, v in part.items()}
    least = {}
    for i, c in part.items():
        least[c] = min(least.get(c, rows[i][0]), rows[i][0])
    return sorted(
        ((v, links[i], least[part[i]] if i in part else v, None if v is None else v == (least[part[i]] if i in part else v)) for i, (v, *_) in enumerate(rows)), key=repr
    )


@pytest.mark.parametrize("block, pivots", [(2048, 64), (9, 64), (9, 2)])
def test_range_join(spark, monkeypatch, block, pivots):
    monkeypatch.setattr(range_join, "BLOCK", block)
    monkeypatch.setattr(range_join, "LABEL_PIVOTS", pivots)
    rows = vectors()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumn("node", F.lit("clash"))
    got = range_join.cosine_links(docs).collect()
    assert sorted(map(tuple, got), key=repr) == by_all_pairs(rows)


def test_range_join_without_rows(spark):
    assert range_join.cosine_links(spark.createDataFrame([], SCHEMA)).count() == 0
