"""Work that must not grow faster than the tables: tasks, methods, rows made once."""

import datetime as dt
from threading import Barrier
from types import SimpleNamespace

from carelens import tables as T
from carelens.fixed_values import INCIDENT_NATURES
from carelens.operators import aggregates as A
from carelens.sources import delimited, sinks
from carelens.testbed import queries as Q


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sums_of_many_tables_are_one_aggregate(spark, monkeypatch):
    rows = [("10000001 - A", 1.5), ("010000001 - A", 2.0), (None, 4.0), ("110000002 - B", None)]
    tables = {}
    for i, (name, _, _, value) in enumerate(T.FINANCE_SOURCES):
        own = [(k, v if v is None else v + i) for k, v in rows] + [("110000002 - B", 7.0)] * (i % 2)
        tables[name] = spark.createDataFrame(own, "label string, value double").selectExpr(
            f"label AS `{T.FINANCE_LABEL}`", f"CAST(value AS DECIMAL(18,2)) AS {value}"
        )
    monkeypatch.setattr(Q, "report_tables", lambda *_: tables)
    got = Q.grouped_sum(spark, "")
    want = {(name, k): v for i, (name, *_) in enumerate(T.FINANCE_SOURCES)
            for k, v in (("010000001", 3.5 + 2 * i), (None, 4.0 + i), ("110000002", 7.0 if i % 2 else None))}
    assert {(r["table_name"], r["finess"]): r["total"] for r in got.collect()} == want
    # The sums themselves are not appended: tables that are dealt alike would be read by the same few tasks.
    assert optimized(got).count("Aggregate ") == 1


def test_incidents_compare_numbers_of_natures(spark):
    schema = "declarant_organismendeg_finess string, survenue_du_cas_en_collectivitendeg_finess string, reclamation string, ceci_est_un_eigs string, famille_principale string, nature_principale string"
    rows = [(None, "110000002", "Non", "Oui", "x", n) for n in (INCIDENT_NATURES[0], INCIDENT_NATURES[-1], None, "other", INCIDENT_NATURES[0])]
    rows += [(None, "110000002", "Non", "Non", "x", INCIDENT_NATURES[0]), (None, "110000002", "Oui", "Oui", "x", INCIDENT_NATURES[0])]
    profile = A.incident_profile(spark.createDataFrame(rows, schema))
    (got,) = profile.collect()
    assert (got["nb_signa"], got["nb_eigs"], got["nb_events"], got[INCIDENT_NATURES[0]], got[INCIDENT_NATURES[-1]]) == (6, 5, 5, 2, 1)
    assert got[INCIDENT_NATURES[1]] == 0 and A.incident_counts(spark.createDataFrame(rows, schema)).collect()[0]["nb_eigs"] == 5
    grouped = next(line for line in optimized(profile).splitlines() if "Aggregate" in line)
    assert "nature" in grouped and f"= {INCIDENT_NATURES[0]}" not in grouped


def test_reports_are_joined_once_to_be_written(spark, monkeypatch, tmp_path):
    seen, arrange = [], sinks.arrange_by_region
    monkeypatch.setattr(sinks, "arrange_by_region", lambda df, *a: seen.append(optimized(df)) or arrange(df.withColumnRenamed("k", Q.LABELS["finess"]), *a))
    monkeypatch.setattr(sinks, "sheet", lambda df, kind: df)
    names = spark.createDataFrame([(1, "one", "one")], "code int, ncc string, nom string")
    both = spark.createDataFrame([("a", 1)], "k string, region_code int").join(spark.createDataFrame([("a", 2)], "k string, v int"), "k", "left")
    sinks.export_report(both, str(tmp_path / "e"), names, dt.date(2024, 1, 31))
    sinks.publish_report(both, str(tmp_path / "p"), names, dt.date(2024, 1, 31))
    assert len(seen) == 2 and not any("Join" in plan for plan in seen)
    held = sinks.published(spark, str(tmp_path / "p"), dt.date(2024, 1, 31), "ciblage").collect()
    assert [(r["region_code"], r["nom"], r["v"]) for r in held] == [(1, "one", 2)]


def test_rows_published_twice_are_made_once(spark, monkeypatch):
    seen = []
    both = spark.createDataFrame([("a", 1)], "k string, region_code int").join(spark.createDataFrame([("a",)], "k string"), "k", "left")
    monkeypatch.setattr(Q, "report_tables", lambda *_: {})
    monkeypatch.setattr(Q.R, "all_regions_report", lambda *_: both)
    monkeypatch.setattr(Q.sinks, "publish_report", lambda df, *_: seen.append((optimized(df), df.count())))
    monkeypatch.setattr(Q.sinks, "published", lambda *_: both)
    Q.published_report(spark, "")
    assert [n for _, n in seen] == [1, 1] and not any("Join" in plan for plan, _ in seen)


def test_raw_files_are_written_side_by_side(spark, monkeypatch):
    barrier, paths = Barrier(3), []

    class Rows:
        columns = ["a"]
        where = selectExpr = lambda self, *_: self
        write = property(lambda self: SimpleNamespace(options=lambda **_: SimpleNamespace(csv=lambda path: (barrier.wait(20), paths.append(path)))))

    names = ["t1", "t2", "t3", T.INCIDENTS]
    monkeypatch.setattr(Q, "report_tables", lambda _s, _d, *n: dict.fromkeys(n or names, Rows()))
    folder = Q._raw_folder(spark, "", "side-by-side")
    assert sorted(p.removeprefix(folder) for p in paths) == ["/demo.csv", "/sivss/nord.csv", "/sivss/sud.csv", "/tables/t1.csv", "/tables/t2.csv", "/tables/t3.csv"]
    lines = delimited.first_lines(spark, folder).collect()
    assert [r["line"] for r in lines] == ["dep;reg;ncc"]
