"""Keyed joins give the same rows whether or not keys are treated as heavy."""

from collections import Counter
from functools import partial

import pytest

from carelens.operators import joins as J
from carelens.operators import skew
from carelens.plans import reports as R
from carelens.testbed.views import report_tables


def bag(df):
    return Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


@pytest.fixture(scope="module")
def frames(spark):
    fact = [("hot", i % 2) for i in range(40)] + [(None, i) for i in range(20)] + [(f"k{i}", i) for i in range(30)]
    dup = [("hot", 1)] * 30 + [("k1", 2), ("k1", 3), ("k2", 4), (None, 5), ("only", 6)]
    far = [("k3", 1)] * 25 + [(None, 0)] * 25 + [("k4", 2)]
    agg = [("hot", 7), ("k5", 8)]
    return (
        spark.createDataFrame(fact, "finess string, v int"),
        {"dup": spark.createDataFrame(dup, "finess string, d int"), "far": spark.createDataFrame(far, "finess string, f int")},
        {"agg": spark.createDataFrame(agg, "finess string, a int")},
    )


def test_heavy_keys_are_found_with_their_counts(frames):
    fact, sources, _ = frames
    heavy = skew.heavy_keys([fact, sources["dup"], sources["far"]], "finess", min_rows=10)
    assert {r["__key"]: (r["n0"], r["n1"], r["n2"]) for r in heavy.collect()} == {"hot": (40, 30, 0), None: (20, 1, 25), "k3": (1, 0, 25)}


@pytest.mark.parametrize("min_rows", [3, 7, 24])
def test_grid_join_equals_plain_join(frames, min_rows):
    fact, sources, aggregates = frames
    plain = skew.enrich_by_key(fact, sources, aggregates, "finess", [], "never")
    balanced = skew.enrich_by_key(fact, sources, aggregates, "finess", [], "always", min_rows)
    assert sorted(plain.columns) == sorted(balanced.columns)
    assert bag(plain) == bag(balanced)


def test_repeated_rows(spark):
    counts = [("a", 1), ("b", 999), ("c", 1000), ("d", 1001), ("e", 2500)]
    df = skew.repeat_rows(spark.createDataFrame(counts, "k string, n bigint"), "n", ["k"])
    assert df.select("__row").distinct().count() == df.count()
    assert {r["k"]: r["count"] for r in df.groupBy("k").count().collect()} == dict(counts)


def test_report_is_the_same_with_every_key_heavy(spark, monkeypatch):
    tables = report_tables(spark, "/root/testdata/sf0.001")
    plain = bag(R.build_report(tables, R.TARGETING, [1, 2], [], "never"))
    monkeypatch.setattr(R, "enrich_by_key", partial(skew.enrich_by_key, min_rows=1))
    assert bag(R.build_report(tables, R.TARGETING, [1, 2], [], "always")) == plain


def test_joins_with_one_key_on_half_of_both_sides(spark):
    fact = spark.createDataFrame([("hot" if i % 2 else f"k{i % 9}", i) for i in range(300)] + [(None, -1)] * 40, "finess string, v int")
    side = spark.createDataFrame([("hot" if i % 2 else f"k{i % 13}", i) for i in range(200)] + [(None, -2)] * 30, "own string, w int")
    for min_rows in (10, 60):
        star = [J.star_enrich(fact, {"side": (side, "own", ["w"])}, "finess", check, min_rows) for check in ("never", "always")]
        keyed = [J.expr_key_join(fact, side, "upper(lower(own))", "finess", check, min_rows) for check in ("never", "always")]
        assert bag(star[0]) == bag(star[1]) and sum(bag(star[1]).values()) > 15_000
        assert star[0].columns == ["finess", "v", "w"] == star[1].columns
        assert keyed[0].columns == keyed[1].columns
    plain = J.expr_key_join(fact, side, "own", "finess", "never")
    assert bag(plain) == bag(J.expr_key_join(fact, side, "own", "finess", "always", 20))


def test_heavy_keys_stay_in_a_table(spark, monkeypatch):
    """Whatever their number, keys are not brought to the driver."""
    fact = spark.createDataFrame([(f"k{i % 50}", i) for i in range(1000)], "finess string, v int")
    side = spark.createDataFrame([(f"k{i}", i) for i in range(50)], "finess string, w int")
    plain = bag(fact.join(side, "finess", "left"))
    monkeypatch.setattr(skew, "BROADCAST_KEYS", 3)  # more of them are shuffled
    joined = skew.enrich_by_key(fact, {"side": side}, {}, "finess", [fact], "always", 5)
    assert bag(joined) == plain
    assert "collect(" not in open(skew.__file__).read()
