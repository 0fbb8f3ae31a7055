"""Landed tables by key, published exports, regions as data."""

import datetime as dt

import pytest

from carelens.operators import joins as J
from carelens.plans import reports as R
from carelens.scratch import scratch_dir
from carelens.sources import regions, sinks
from carelens.testbed.views import report_tables

DAY = dt.date(2024, 1, 31)
SF_DIR = "/root/testdata/sf0.001"


def bag(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def test_landed_by_key_joins_where_it_lies(spark):
    path = scratch_dir(spark, "landed")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        frames = {}
        for name in ("fact", "left", "right"):
            rows = spark.range(400).selectExpr(f"CAST(id % {dict(fact=90, left=70, right=110)[name]} AS STRING) AS finess", f"id AS {name}")
            frames[name] = sinks.land_keyed(rows, f"landed_{name}", "finess", f"{path}/{name}", 8)
            assert bag(frames[name]) == bag(rows)
        joined = frames["fact"].join(frames["left"], "finess", "left").join(frames["right"], "finess", "left")
        counted = joined.groupBy("finess").count()
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert counted.count() == 90
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("fact", "left", "right"):
            spark.sql(f"DROP TABLE IF EXISTS landed_{name}")


@pytest.fixture(scope="module")
def both(spark):
    tables = report_tables(spark, SF_DIR)
    df = R.all_regions_report(tables, R.BOTH, range(5), (3,))
    path = scratch_dir(spark, "both")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_regions_may_be_a_frame(spark, both):
    codes = spark.createDataFrame([(c,) for c in (0, 1, 2, 3, 4, 99)], "code int")
    report = R.all_regions_report(report_tables(spark, SF_DIR), R.BOTH, codes, (3,))
    assert report.columns == both.columns and bag(report) == bag(both)
    t = report_tables(spark, SF_DIR)
    places = J.geography(t["commune_2022"], t["departement_2022"], t["region_2022"], codes.where("code = 2"))
    assert {r["region_code"] for r in places.collect()} == {2}


def test_a_run_counts_when_it_is_published(spark, both, monkeypatch):
    names, path = regions.configured_regions(spark), scratch_dir(spark, "published")
    first = sinks.publish_report(both, path, names, DAY)
    before = {s: bag(sinks.published(spark, path, DAY, s)) for s in sinks.SHEETS.values()}
    for kind, name in sinks.SHEETS.items():
        assert len(before[name]) == sinks.sheet(both, kind).count() > 0

    # A run that dies after its rows, before its manifest, is not seen.
    with monkeypatch.context() as m:
        m.setattr(sinks, "_region_lines", lambda rows, name: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            sinks.publish_report(both.where("region_code = 1").limit(3), path, names, DAY)
    assert {s: bag(sinks.published(spark, path, DAY, s)) for s in sinks.SHEETS.values()} == before
    assert sinks.damaged(spark, path, DAY).count() == 0

    # A later run replaces its regions, also one that has no rows any more; others stay.
    fewer = both.where("region_code = 1").limit(3)
    second = sinks.publish_report(fewer, path, names, DAY, spark.createDataFrame([(1,), (2,)], "code int"))
    now = sinks.published(spark, path, DAY, "controle")
    assert {r["region_code"]: r["count"] for r in now.groupBy("region_code").count().collect() if r["region_code"] in (1, 2)} == {1: 3}
    rest = "region_code NOT IN (1, 2)"
    assert bag(now.where(rest)) == bag(spark.read.parquet(f"{path}/31012024/controle/run={first}").where(rest))
    lines = {(r["sheet"], r["region_code"]): (r["run"], r["n_rows"], r["nom"]) for r in sinks.manifest(spark, path, DAY).collect()}
    assert lines["ciblage", 2] == (second, 0, "MART") and lines["ciblage", 1][0] == second and lines["ciblage", 4][0] == first


def test_damage_is_found(spark, both):
    names, path = regions.configured_regions(spark), scratch_dir(spark, "damaged")
    run = sinks.publish_report(both, path, names, DAY)
    extra = spark.read.parquet(f"{path}/31012024/ciblage/run={run}").where("region_code = 4").limit(1)
    extra.drop("region_code", "nom").write.mode("append").parquet(f"{path}/31012024/ciblage/run={run}/region_code=4/nom=REU")
    found = sinks.damaged(spark, path, DAY).collect()
    assert [(r["sheet"], r["region_code"], r["found"] - r["n_rows"]) for r in found] == [("ciblage", 4, 1)]
