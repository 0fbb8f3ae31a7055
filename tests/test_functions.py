"""Column functions on the values that make them necessary."""

import datetime as dt

import pytest

from carelens.functions import dates, keys, numbers, text


def evaluate(spark, expr, kind, *values):
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
    kinds = kind.split(",")
    schema = "i int, " + ", ".join(f"{chr(97 + n)} {k}" for n, k in enumerate(kinds))
    return [r["x"] for r in spark.createDataFrame(rows, schema).selectExpr("i", f"{expr} AS x").orderBy("i").collect()]


CASES = [
    (keys.establishment_key("a"), "string",
     ["010001234", "10001234", "10001234.0", "2A0001234", None, "1234567", "", "1000123456"],
     ["010001234", "010001234", "010001234", "2A0001234", None, "1234567", "", "1000123456"]),
    (keys.establishment_key("a", "double"), "double", [10001234.0, 750001234.0, None, float("nan")],
     ["010001234", "750001234", None, None]),
    (keys.canonical_key("a"), "string", ["75001.0", "75001", ".0", "1.05"], ["75001", "75001", "", "1.05"]),
    (keys.pad_code("a", 4), "string", ["1004", "75001", "2A04", None, "104"], ["01004", "75001", "02A04", None, "104"]),
    (keys.prefix_key("a"), "string", ["010001234 - NAME", "short"], ["010001234", "short"]),
    (keys.suffix_key("a"), "string", ["ORG - 010001234", "short", None], ["010001234", "short", None]),
    (keys.resolve_incident_key("a", "b"), "string,string",
     [("ORG 010001234", "010001234 - X"), ("ORG 010001234", None), ("ORG 010001234", "10005678.0"), (None, None),
      ("010001234.0", None), ("10001234", None), ("ORG 10001234", None), (None, "10001234 - NAME"), ("ORG 2A0001234 ", None)],
     ["010001234", "010001234", "010005678", None, "010001234", "010001234", "010001234", "010001234", "2A0001234"]),
    (keys.label_key("a"), "string", ["10001234 - NAME", "010001234 - NAME", "10001234.0", "2A0001234", None, "10001234-NAME"],
     ["010001234", "010001234", "010001234", "2A0001234", None, "010001234"]),
    (keys.label_key("a"), "string", ["10001234_NOM", " (010001234) X", "- 10001234.0 - Y", "", " - "], ["010001234", "010001234", "010001234", "", ""]),
    (keys.closing_key("a"), "string", ["ETAB (010001234)", "NAME-10001234", "ORG 10001234.0", "ORG 2A0001234 .", "", None, "x"],
     ["010001234", "010001234", "010001234", "2A0001234", "", None, "x"]),
    (keys.resolve_incident_key("a", "b", "bigint", "double"), "bigint,double",
     [(10001234, None), (10001234, 10005678.0), (None, None)], ["010001234", "010005678", None]),
    (keys.resolve_incident_key("a", "b", "bigint"), "bigint,string",
     [(10001234, None), (10001234, "10005678 - X"), (None, "2A0001234")], ["010001234", "010005678", "2A0001234"]),
    (keys.label_key("a", "double"), "double", [10001234.0, None], ["010001234", None]),
    (text.address_line("a", "b", "c"), "string,string,string",
     [("12.0", "BIS", "RUE"), (None, "BIS", None), ("1.0", None, None), (None, None, None), ("12", None, "RUE"),
      ("12B", None, "RUE"), ("7", None, None)],
     ["12 BIS RUE", "BIS ", "1 ", "", "12 RUE", "12B RUE", "7 "]),
    (text.contains_text("a", "d?esthétique_"), "string",
     ["x D?ESTHÉTIQUE_ y", "d'esthétique_", "d?esthétiqueX", None], [True, False, False, None]),
    (text.slugify("a"), "string", ["N° FINESS/RPPS", "Cœur  d’été - 2", "plain TEXT", None, "Привет Αθήνα", "Ψυχή щи ё", "Straße æß œœ", "漢字 x", ""],
     ["ndeg_finessrpps", "coeur_dete_-_2", "plain_text", None, "privet_athena", "psukhe_shchi_io", "strasse_aess_oeoe", "_x", ""]),
    (numbers.lenient_int("a"), "string", ["12.7", " 12", "-3x", "abc", "", None], [12, 12, -3, None, None, None]),
    (numbers.lenient_int("a", "double"), "double", [12.7, -1.5, None], [12, -1, None]),
    (numbers.decimal_comma("a"), "string", ["12,5", " 7.25 ", "", "abc", "12d", "NaN", "1e3", None],
     [12.5, 7.25, None, None, None, None, 1000.0, None]),
    (numbers.safe_ratio("a", "b"), "int,int", [(1, 2), (1, 0), (None, 2)], [0.5, None, None]),
    (numbers.mean_ignore_null("a", "b", "c"), "string,string,string",
     [("12,5", None, "7.5"), (None, None, None), ("x", "3", None)], [10.0, None, 3.0]),
    (numbers.null_strict_sum("a", "b"), "double,double", [(1.0, 2.0), (1.0, None)], [3.0, None]),
    (numbers.null_to_zero("a"), "int", [None, 4], [0, 4]),
    (numbers.complaint_rate("a", "b"), "bigint,double", [(3, 40.0), (None, 40.0), (3, 0.0)], [7.5, 0.0, 0.0]),
    (numbers.capacity_by_category("a", ["b", "c"], "d", 500), "int,bigint,bigint,bigint",
     [(500, 3, None, 99), (159, 3, None, 99), (159, 3, 4, None), (None, 1, 1, 5)], [3, 99, None, 5]),
    (dates.parse_dmy("a"), "string",
     ["31/12/2023", "31/12/2023 10:00:00", "31/02/2023", "2023-12-31", "1/2/2023", "à fixer", None],
     [dt.date(2023, 12, 31)] * 2 + [None] * 5),
]


@pytest.mark.parametrize("expr,kind,values,expected", CASES, ids=[str(i) for i in range(len(CASES))])
def test_values(spark, expr, kind, values, expected):
    assert evaluate(spark, expr, kind, *values) == expected


def test_literals_survive_quoting(spark):
    odd = "l'été \\ d\"x"
    assert spark.sql(f"SELECT {keys.lit(odd)}").first()[0] == odd


def test_names_agree_with_values(spark):
    names = ["Привет, Αθήνα!", "ЩИ Ёж їжак ЉЊ", "ΨΥΧΉ ΰ Ώ", "Taux d'absentéisme  2019", "ÀÉÎõü ßæ°", "a_b-c 9", "Ÿ – €", "ếǆﬁ ½ĳ①Ⅳ", "x\u00a0y"]
    lowered = [text.normalise_name(n).lower() for n in names]
    assert [v.lower() for v in evaluate(spark, text.slugify("a"), "string", *names)] == lowered


def test_run_stamp():
    assert dates.run_stamp(dt.date(2024, 1, 31)) == "31012024"


def test_a_key_names_its_column_few_times():
    """Common parts of a key are computed once; its text stays short."""
    assert keys.label_key("x_y").count("x_y") <= 3 and keys.closing_key("x_y").count("x_y") <= 3
    key = keys.resolve_incident_key("decl", "loc")
    assert key.count("decl") <= 4 and len(key) < 1500
