"""What the physical plans must look like, over tables stored as files."""

import re

import pytest

from carelens import tables as T
from carelens.plans import reports as R
from carelens.testbed.views import report_tables


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    found = {}
    for name, df in report_tables(spark, "/root/testdata/sf0.001").items():
        df.write.parquet(f"{folder}/{name}")
        found[name] = spark.read.parquet(f"{folder}/{name}")
    return found


@pytest.fixture
def shuffled(spark):
    """Plans as for tables too large to broadcast, without adaptive wrapping."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text, column):
    """Number of file scans reading a column."""
    return sum(f"{column}:" in line.split("ReadSchema:")[1] for line in text.splitlines() if "ReadSchema:" in line)


@pytest.mark.parametrize("variant", [R.INCIDENTS, R.COMPLAINTS])
def test_each_table_is_read_once(stored, shuffled, variant):
    text = plan(R.control_report(stored, 2, variant))
    assert scans(text, "ndeg_finessrpps") == 1
    assert scans(text, "identifiant_de_la_mission") == 1
    assert scans(text, "categ_lib") == 1
    assert scans(text, "finess_geographique") == len(T.DASHBOARDS)
    assert scans(text, "declarant_organismendeg_finess") == (1 if variant == R.INCIDENTS else 0)


def test_register_and_every_side_are_shuffled_once(stored, shuffled):
    text = plan(R.build_report(stored, R.CONTROL, [2], []))
    by_establishment = re.findall(r"Exchange hashpartitioning\(finess#\d+, \d+\)", text)
    # Register, 11 plain sides, class rows, finance, and the three facts (complaints, incidents, missions).
    assert len(by_establishment) == 1 + 11 + 1 + 1 + 3
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_no_python_in_any_plan(stored):
    for text in (plan(R.control_report(stored, 2)), plan(R.all_regions_report(stored, R.TARGETING, range(5), (3,)))):
        assert not re.search("BatchEvalPython|ArrowEvalPython|MapInPandas|PythonUDF", text)


def test_duplicates_are_removed_by_an_anti_join_after_counting(stored, shuffled):
    text = plan(R.facility_finance(stored))
    anti = next(line for line in text.splitlines() if "LeftAnti" in line)
    counted = next(line for line in text.splitlines() if "functions=[count(1)]" in line)
    assert len(counted) and text.index(anti) < text.index(counted)


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(R.targeting_report(stored, 2))
    register = next(line for line in text.splitlines() if "FileScan" in line and f"/{T.FACILITIES}]" in line)
    assert "In(categ_code" in register.split("PushedFilters: ")[1].split("ReadSchema")[0]
    occupation = next(line for line in text.splitlines() if "FileScan" in line and f"/{T.OCCUPATION_2022}]" in line)
    schema = occupation.split("ReadSchema: ")[1]
    assert "nb_lits_occ_2022" in schema and "taux_occ_2022" not in schema


def test_small_geography_is_broadcast_and_large_is_not(stored, monkeypatch):
    from carelens.operators import joins

    small = plan(R.geo_enrich(stored[T.FACILITIES], stored[T.COMMUNES], stored[T.DEPARTMENTS], stored[T.REGIONS_TABLE]))
    assert "BroadcastHashJoin" in small
    assert joins.plan_bytes(stored[T.COMMUNES]) > 0
    hinted = joins.broadcast_when_small(stored[T.COMMUNES], [stored[T.COMMUNES]], limit=1)
    assert hinted is stored[T.COMMUNES]
