"""Files in, files out."""

import datetime as dt
import json

import pytest
from hypothesis import given
from hypothesis import strategies as st

from carelens.fixed_values import LABELS, REGIONS
from carelens.functions.keys import ref
from carelens.plans import reports as R
from carelens.sources import delimited, headers, regions, sinks
from carelens.testbed.views import report_tables


def write(folder, name, content, encoding="utf-8"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content.encode(encoding))
    return str(path)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_header_rules():
    assert headers.complete_headers(["a", "", "a", None, "a"]) == ["a", "Unnamed: 1", "a.1", "Unnamed: 3", "a.2"]
    assert headers.column_names(["N° FINESS/RPPS", "", "dont AMP", "dont AMP"]) == [
        "ndeg_finessrpps", "unnamed_1", "dont_amp", "dont_amp1",
    ]


@given(st.lists(st.text(max_size=6), max_size=8))
def test_headers_are_always_distinct(raw):
    completed = headers.complete_headers(raw)
    assert len(set(completed)) == len(raw)
    assert len(set(headers.complete_headers(completed))) == len(raw)


def test_scan_with_quotes_bom_and_missing_values(spark, tmp_path):
    path = write(tmp_path, "x.csv", '﻿Clé;;Note\n0123;"a;""b""";NA\n4;;12,5\n')
    df = delimited.read_delimited(spark, path)
    assert df.columns == ["cle", "unnamed_1", "note"]
    assert rows(df) == [("0123", 'a;"b"', None), ("4", None, "12,5")]
    kinds = dict(delimited.read_delimited(spark, path, infer=True).dtypes)
    assert kinds == {"cle": "string", "unnamed_1": "string", "note": "double"}


def test_multiline_field(spark, tmp_path):
    path = write(tmp_path, "m.csv", 'a;b\n1;"two\nlines"\n')
    assert rows(delimited.read_delimited(spark, path, multiline=True)) == [("1", "two\nlines")]


def test_latin1(spark, tmp_path):
    path = write(tmp_path, "l.csv", "Libellé\nété\n", "latin-1")
    df = delimited.read_delimited(spark, path, encoding="ISO-8859-1")
    assert (df.columns, rows(df)) == (["libelle"], [("été",)])


def test_folder_of_tables(spark, tmp_path):
    write(tmp_path, "geo/region_2022.csv", "reg;ncc\n84;ARA\n")
    write(tmp_path, "t-finess.v2.csv", "finess;categ_code\n10001234.0;500\n")
    write(tmp_path, "occupation_2021.csv/part-0.csv", "finess;taux_occ_2021\n1;97,5\n")
    write(tmp_path, "occupation_2021.csv/part-1.csv", "finess;taux_occ_2021\n2;\n")
    write(tmp_path, "demo.csv", "a\n1\n")
    write(tmp_path, "notes.txt", "not a table")
    tables = delimited.read_folder(spark, str(tmp_path))
    assert sorted(tables) == ["occupation_2021", "region_2022", "t-finess"]
    assert rows(tables["region_2022"]) == [(84, "ARA")]
    assert sorted(rows(tables["occupation_2021"])) == [("1", 97.5), ("2", None)]
    assert rows(spark.sql("SELECT * FROM `t-finess`")) == [("10001234.0", 500)]


def test_appended_files_align_by_name(spark, tmp_path):
    write(tmp_path, "r1.csv", "a;b\n1;x\n")
    write(tmp_path, "r2.csv", "b;c\ny;2\n")
    write(tmp_path, "r3.csv", "a;b\n3;z\n")
    df = delimited.read_appended(spark, str(tmp_path)).select("a", "b", "c")
    assert sorted(rows(df), key=str) == [("1", "x", None), ("3", "z", None), (None, "y", "2")]


def test_region_configuration(spark, tmp_path):
    entry = {"code": [1, 32], "ncc": ["GUADELOUPE", "HAUTS DE FRANCE"], "nom": ["GUAD", "HDF"]}
    path = write(tmp_path, "settings.json", json.dumps({"db": [{"name": "x"}], "region": [entry]}))
    config = regions.read_region_config(spark, path)
    assert rows(config) == [(1, "GUADELOUPE", "GUAD"), (32, "HAUTS DE FRANCE", "HDF")]
    coded = spark.createDataFrame([(32,), (7,)], "code_reg int")
    assert sorted(rows(regions.label_region(coded, config, "code_reg")), key=str) == [
        (32, "HAUTS DE FRANCE", "HDF"), (7, None, None),
    ]
    assert rows(regions.configured_regions(spark)) == list(REGIONS)


@pytest.fixture(scope="module")
def exported(spark, tmp_path_factory):
    both = R.all_regions_report(report_tables(spark, "/root/testdata/sf0.001"), R.BOTH, range(5), (3,))
    names, day = regions.configured_regions(spark), dt.date(2024, 1, 31)
    folder = str(tmp_path_factory.mktemp("export"))
    return {
        **sinks.export_report(both, folder, names, day, "parquet", (3,)),
        **sinks.export_report(both, folder, names, day, "csv", (3,)),
    }


def test_export_holds_every_row_of_every_region(spark, exported):
    tables = report_tables(spark, "/root/testdata/sf0.001")
    for kind, name in sinks.SHEETS.items():
        report = R.all_regions_report(tables, kind, range(5), (3,))
        stored = spark.read.parquet(exported[name])
        assert set(stored.columns) == {*report.columns, "nom"}
        assert sorted(map(repr, stored.select(*map(ref, report.columns)).collect())) == sorted(map(repr, report.collect()))
        assert "/31012024/" in exported[name]
        own = spark.read.parquet(f"{exported[name]}/region_code=1/nom=GUAD")
        assert own.count() == report.where("region_code = 1").count() > 0


def test_exported_files_are_sorted(spark, exported):
    numbers = spark.read.parquet(exported["ciblage"]).selectExpr(
        "input_file_name() AS file", "monotonically_increasing_id() AS i", f"{ref(LABELS['finess'])} AS finess"
    )
    by_file = {}
    for r in numbers.orderBy("i").collect():
        by_file.setdefault(r["file"], []).append(r["finess"])
    assert by_file and all(v == sorted(v) for v in by_file.values())


def test_csv_of_each_variant_has_its_own_columns(spark, exported):
    for variant, width in ((R.INCIDENTS, 127), (R.COMPLAINTS, 107)):
        df = spark.read.csv(exported[f"controle_{variant}"], header=True, sep=";")
        assert len(df.columns) == width + 2 and df.count() > 0
        assert {r[0] for r in df.select("region_code").distinct().collect()} <= (
            {3} if variant == R.COMPLAINTS else {0, 1, 2, 4}
        )


LINES = 'a;b;c\n1;x;2\n3;y\n4;"p;q;""r""";5\n6;z;7;8\n\n9;;\n"only\n'


def test_rejected_lines(spark, tmp_path):
    path = write(tmp_path, "x.csv", LINES)
    good, bad = delimited.read_checked(spark, path)
    assert sorted(rows(good), key=str) == [("1", "x", "2"), ("4", 'p;q;"r"', "5"), ("9", None, None)]
    found = {r["line"]: (r["fields"], r["expected"], r["reason"]) for r in bad.collect()}
    assert found["3;y"] == (2, 3, "too few fields") and found["6;z;7;8"] == (4, 3, "too many fields")
    assert good.count() + bad.count() == len([x for x in LINES.split("\n")[1:] if x])
    assert all(r["file"].endswith("x.csv") for r in bad.collect())
    assert delimited.read_checked(spark, write(tmp_path, "fine.csv", "a;b\n1;2\n"))[1].count() == 0


def test_headers_in_one_scan(spark, tmp_path):
    for k in range(30):
        write(tmp_path, f"t{k % 3}.csv/part-{k}.csv", f"Clé;col{k % 2}\n{k};x\n", "latin-1" if k % 3 == 1 else "utf-8")
    write(tmp_path, "big.csv", "\ufeff\"A b\";;\"c;d\"\n" + "1;2;3\n" * 50_000)
    write(tmp_path, "empty.csv", "")
    write(tmp_path, "notes.txt", "no;table\n")
    found = {p.rsplit("/", 1)[1]: delimited.header_of(line) for p, line, _ in delimited.scan_headers(spark, str(tmp_path))}
    assert found["big.csv"] == ("a_b", "unnamed_1", "cd") and len(found) == 31 and found["part-3.csv"] == ("cle", "col1")
    tables = delimited.read_folder(spark, str(tmp_path), encoding={"t1": "ISO-8859-1"}, views=False)
    assert sorted(tables) == ["big", "t0", "t1", "t2"]
    assert tables["t1"].columns == ["cle", "col1", "col0"] and tables["t1"].count() == 10 and tables["big"].count() == 50_000


def test_regional_files_make_one_table(spark, tmp_path):
    write(tmp_path, "sivss/north.csv", "reclamation;nature_principale;x\nNon;a;1\n")
    write(tmp_path, "sivss/south.csv", "nature_principale;reclamation\nb;Oui\nc\n")
    write(tmp_path, "geo/region_2022.csv", "reg;ncc\n84;ARA\n85\n")
    tables = delimited.read_folder(spark, str(tmp_path), views=False, appended={"all_sivss": "sivss"}, checked=True)
    assert sorted(tables) == ["all_sivss", "region_2022", "rejects"]
    got = tables["all_sivss"].select("reclamation", "nature_principale", "x")
    assert sorted(rows(got), key=str) == [("Non", "a", "1"), ("Oui", "b", None)]
    assert sorted((r["table_name"], r["line"]) for r in tables["rejects"].collect()) == [("all_sivss", "c"), ("region_2022", "85")]
