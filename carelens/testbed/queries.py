"""One registered query per operator, over the test tables."""

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens import tables as T
from carelens.fixed_values import CATEGORY_CODES, COMPLAINT_MOTIFS, LABELS
from carelens.functions import dates, keys, numbers, text
from carelens.functions.keys import named, ref
from carelens.operators import aggregates as A
from carelens.operators import clean as C
from carelens.operators import joins as J
from carelens.plans import reports as R
from carelens.scratch import scratch_dir, written
from carelens.sources import delimited, headers, regions, sinks
from carelens.testbed.views import base_tables, report_tables

Query = Callable[[SparkSession, str], DataFrame]

REPORT_REGION = 2
ALL_REGIONS = (0, 1, 2, 3, 4)
COMPLAINT_REGIONS = (3,)
DOCUMENT_NEEDLES = ("the", "And", "le ", "ñ", "100%", "e-mail")
RUN_DAY = dt.date(2024, 1, 31)

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return report_tables(spark, sf_dir, name)[name]


# --- column functions -------------------------------------------------------------------------------------------


@query
def pad_code(spark, sf_dir):
    rows = table(spark, sf_dir, T.FACILITIES)
    return rows.selectExpr(
        "rs", named(keys.pad_code("finess", 8), "finess_padded"), named(keys.pad_code("com_code", 4), "commune_padded")
    )


@query
def canonical_key(spark, sf_dir):
    rows = table(spark, sf_dir, T.FACILITIES).selectExpr("rs", "finess", "CAST(finess AS DOUBLE) AS as_double")
    return rows.selectExpr(
        "rs",
        named(keys.canonical_key("finess"), "from_text"),
        named(keys.canonical_key("as_double", "double"), "from_double"),
    )


@query
def prefix_key(spark, sf_dir):
    rows = table(spark, sf_dir, T.CLASSES)
    return rows.selectExpr(named(ref(T.CLASS_LABEL), "label"), named(keys.prefix_key(ref(T.CLASS_LABEL)), "finess"))


@query
def suffix_key(spark, sf_dir):
    rows = base_tables(spark, sf_dir)["customer"]
    return rows.selectExpr(
        "c_custkey", named(keys.suffix_key("c_name"), "suffix"), named(keys.suffix_key("c_mktsegment", 12), "whole")
    )


@query
def resolve_incident_key(spark, sf_dir):
    rows = table(spark, sf_dir, T.INCIDENTS)
    declarant, location = "declarant_organismendeg_finess", "survenue_du_cas_en_collectivitendeg_finess"
    return rows.selectExpr(declarant, location, named(keys.resolve_incident_key(declarant, location), "finess"))


@query
def address_line(spark, sf_dir):
    rows = table(spark, sf_dir, T.FACILITIES)
    parts = [c for c in rows.columns if c.startswith("adresse_") and c != "adresse_code_postal"]
    return rows.selectExpr("rs", named(text.address_line(*parts), "adresse"))


@query
def lenient_int(spark, sf_dir):
    rows = table(spark, sf_dir, T.CAPACITIES)
    raw = "total_heberg_comp_inter_places_autorisees"
    return rows.selectExpr(ref("et-ndegfiness") + " AS finess", raw, named(numbers.lenient_int(raw), "places"))


@query
def decimal_comma(spark, sf_dir):
    rows = table(spark, sf_dir, T.INDICATORS)
    return rows.selectExpr(
        "et_finess",
        named(numbers.decimal_comma("taux_plus_10_medics_cip13"), "many_drugs"),
        named(numbers.decimal_comma("taux_hospit_mco"), "mco"),
    )


@query
def safe_ratio(spark, sf_dir):
    rows = base_tables(spark, sf_dir)["lineitem"]
    return rows.selectExpr(
        "l_orderkey",
        "l_linenumber",
        named(numbers.safe_ratio("l_extendedprice", "l_discount"), "price_per_discount"),
        named(numbers.safe_ratio("l_orderkey", "l_linenumber"), "order_per_line"),
    )


@query
def null_to_zero(spark, sf_dir):
    rows = table(spark, sf_dir, T.OCCUPATION_2022)
    return rows.selectExpr("finess", named(numbers.null_to_zero("taux_occ_trimestre3"), "rate"))


@query
def mean_ignore_null(spark, sf_dir):
    t = report_tables(spark, sf_dir, T.DASHBOARDS[2020])[T.DASHBOARDS[2020]]
    rates = list(R.DASHBOARD_RATES.values())
    return t.selectExpr(
        "finess_geographique",
        named(numbers.mean_ignore_null(*rates[:3]), "mean_of_three"),
        named(numbers.mean_ignore_null(*rates), "mean_of_four"),
    )


@query
def null_strict_sum(spark, sf_dir):
    rows = table(spark, sf_dir, T.DASHBOARDS[2022])
    staff = [ref(c) for c in R.DASHBOARD_FTE.values()]
    return rows.selectExpr("finess_geographique", named(numbers.null_strict_sum(*staff), "fte_total"))


@query
def parse_dmy(spark, sf_dir):
    rows = table(spark, sf_dir, T.MISSIONS)
    return rows.selectExpr(
        "identifiant_de_la_mission",
        "date_reelle_visite",
        named(dates.parse_dmy("date_reelle_visite"), "real_day"),
        named(dates.parse_dmy("date_provisoire_visite"), "planned_day"),
    )


@query
def slugify(spark, sf_dir):
    rows = base_tables(spark, sf_dir)["documents"]
    return rows.selectExpr("doc_id", named(text.slugify("text"), "slug"))


@query
def complaint_rate(spark, sf_dir):
    t = report_tables(spark, sf_dir, T.COMPLAINTS, T.TOTAL_CAPACITY)
    capacity = C.clean_keyed(
        t[T.TOTAL_CAPACITY], "etiquettes_de_lignes", {"capacity": "somme_de_capacite_autorisee_totale_"}
    )
    joined = capacity.join(A.complaint_counts(t[T.COMPLAINTS]), "finess", "left")
    return joined.selectExpr("finess", named(numbers.complaint_rate("nb_recla", "capacity"), "rate"))


@query
def capacity_by_category(spark, sf_dir):
    t = report_tables(spark, sf_dir, T.FACILITIES, T.CAPACITIES, T.TOTAL_CAPACITY)
    parts = t[T.CAPACITIES].columns[1:]
    capacities = C.clean_keyed(t[T.CAPACITIES], "et-ndegfiness", {c: numbers.lenient_int(c) for c in parts})
    total = C.clean_keyed(
        t[T.TOTAL_CAPACITY],
        "etiquettes_de_lignes",
        {"total": numbers.lenient_int("somme_de_capacite_autorisee_totale_", "double")},
    )
    facility = C.clean_facility(t[T.FACILITIES]).select("finess", "categ_code")
    joined = facility.join(capacities, "finess", "left").join(total, "finess", "left")
    capacity = numbers.capacity_by_category("categ_code", parts, "total", R.SUMMED_CAPACITY_CATEGORY)
    return joined.selectExpr("finess", "categ_code", named(capacity, "capacity"))


# --- cleaning and filters ---------------------------------------------------------------------------------------


@query
def clean_facility(spark, sf_dir):
    return C.clean_facility(table(spark, sf_dir, T.FACILITIES))


@query
def clean_keyed(spark, sf_dir):
    t = report_tables(
        spark, sf_dir, T.OCCUPATION_2022, T.TOTAL_CAPACITY, T.LODGING, *T.DASHBOARDS.values()
    )
    sides = {
        "occupation": (T.OCCUPATION_2022, "finess", "taux_occ_2022"),
        "capacity": (T.TOTAL_CAPACITY, "etiquettes_de_lignes", "somme_de_capacite_autorisee_totale_"),
        "lodging": (T.LODGING, "finesset", "prixhebpermcs"),
        **{
            f"dashboard_{year}": (name, "finess_geographique", R.DASHBOARD_FTE["fte_ash"])
            for year, name in T.DASHBOARDS.items()
        },
    }
    parts = [
        C.clean_keyed(t[name], key, {"value": value}).selectExpr(f"'{side}' AS side", "finess", "value")
        for side, (name, key, value) in sides.items()
    ]
    return delimited.concat_sources(parts)


@query
def clean_dashboard(spark, sf_dir):
    return C.clean_dashboard(table(spark, sf_dir, T.DASHBOARDS[2022]), detail=True)


@query
def filter_in_list(spark, sf_dir):
    rows = base_tables(spark, sf_dir)["part"]
    return C.filter_in_list(rows, "p_size", CATEGORY_CODES).select("p_partkey", "p_size")


# --- aggregates -------------------------------------------------------------------------------------------------


@query
def complaint_counts(spark, sf_dir):
    return A.complaint_counts(table(spark, sf_dir, T.COMPLAINTS))


@query
def flagged_counts(spark, sf_dir):
    return A.flagged_counts(table(spark, sf_dir, T.COMPLAINTS))


@query
def motif_flag_counts(spark, sf_dir):
    rows = base_tables(spark, sf_dir)["documents"]
    return A.motif_flag_counts(rows, "source", "text", DOCUMENT_NEEDLES)


@query
def complaint_profile(spark, sf_dir):
    return A.complaint_profile(table(spark, sf_dir, T.COMPLAINTS), COMPLAINT_MOTIFS)


@query
def incident_counts(spark, sf_dir):
    return A.incident_counts(table(spark, sf_dir, T.INCIDENTS))


@query
def incident_by_nature(spark, sf_dir):
    return A.incident_by_nature(table(spark, sf_dir, T.INCIDENTS))


@query
def grouped_sum(spark, sf_dir):
    tables = report_tables(spark, sf_dir, *[s[0] for s in T.FINANCE_SOURCES])
    rows = delimited.concat_sources([
        tables[name].selectExpr(f"'{name}' AS table_name", ref(T.FINANCE_LABEL), f"{value} AS value")
        for name, _, _, value in T.FINANCE_SOURCES
    ])
    sums = A.grouped_sum(rows, T.FINANCE_LABEL, "value", per=["table_name"])
    return sums.selectExpr("table_name", "finess", "CAST(total AS DOUBLE) AS total")


@query
def grouped_sum_pivot(spark, sf_dir):
    sums = A.grouped_sum_pivot(report_tables(spark, sf_dir, *[s[0] for s in T.FINANCE_SOURCES]))
    return sums.selectExpr("finess", "cadre", *[f"CAST({m} AS DOUBLE) AS {m}" for m in A.MEASURES])


@query
def route_by_class(spark, sf_dir):
    t = report_tables(spark, sf_dir, T.CLASSES, *[s[0] for s in T.FINANCE_SOURCES])
    classes = t[T.CLASSES].selectExpr(named(keys.label_key(ref(T.CLASS_LABEL)), "finess"), "cadre")
    routed = A.route_by_class(classes, A.finance_by_establishment(t))
    return routed.selectExpr("finess", "cadre", *[f"CAST({m} AS DOUBLE) AS {m}" for m in A.MEASURES])


@query
def distinct_missions(spark, sf_dir):
    return A.distinct_missions(table(spark, sf_dir, T.MISSIONS))


@query
def inspection_counts(spark, sf_dir):
    return A.inspection_counts(table(spark, sf_dir, T.MISSIONS))


# --- joins ------------------------------------------------------------------------------------------------------


@query
def geo_enrich(spark, sf_dir):
    t = report_tables(spark, sf_dir, T.FACILITIES, T.COMMUNES, T.DEPARTMENTS, T.REGIONS_TABLE)
    facility = C.clean_facility(t[T.FACILITIES]).select("finess", "com_code")
    every = J.geo_enrich(facility, t[T.COMMUNES], t[T.DEPARTMENTS], t[T.REGIONS_TABLE])
    some = J.geo_enrich(facility, t[T.COMMUNES], t[T.DEPARTMENTS], t[T.REGIONS_TABLE], codes=[1, REPORT_REGION])
    return every.selectExpr("'left' AS how", *every.columns).unionByName(some.selectExpr("'inner' AS how", *some.columns))


@query
def hierarchy_fallback(spark, sf_dir):
    return J.hierarchy_fallback(table(spark, sf_dir, T.COMMUNES))


@query
def star_enrich(spark, sf_dir):
    t = report_tables(spark, sf_dir, T.FACILITIES, T.OCCUPATION_2022, T.LODGING, T.DEPENDENCY)
    facility = C.clean_facility(t[T.FACILITIES]).select("finess", "rs")
    sides = {
        "occupation": (C.clean_keyed(t[T.OCCUPATION_2022], "finess"), "finess", ["taux_occ_2022", "nb_lits_occ_2022"]),
        "lodging": (C.clean_keyed(t[T.LODGING], "finesset"), "finess", ["prixhebpermcs"]),
        "dependency": (C.clean_keyed(t[T.DEPENDENCY], "finess_et"), "finess", ["gmp", "pmp"]),
    }
    return J.star_enrich(facility, sides)


@query
def expr_key_join(spark, sf_dir):
    t = report_tables(spark, sf_dir, T.FACILITIES, T.DEPENDENCY)
    facility = C.clean_facility(t[T.FACILITIES]).select("finess", "rs")
    return J.expr_key_join(facility, t[T.DEPENDENCY], keys.establishment_key("finess_et")).select("finess", "rs", "gmp")


@query
def anti_join_when(spark, sf_dir):
    t = report_tables(spark, sf_dir, T.CLASSES, T.CLASS_DUPLICATES)
    classes = t[T.CLASSES].selectExpr(named(keys.label_key(ref(T.CLASS_LABEL)), "finess"), "cadre")
    listed = t[T.CLASS_DUPLICATES].selectExpr(named(keys.label_key("finess"), "finess"))
    return J.anti_join_when(classes, listed, "finess", "cadre <> 'ERRD'")


@query
def attach_signals(spark, sf_dir):
    t = report_tables(spark, sf_dir, T.FACILITIES, T.COMPLAINTS, T.INCIDENTS)
    facility = C.clean_facility(t[T.FACILITIES]).select("finess", "rs")
    complaints = A.complaint_profile(t[T.COMPLAINTS]).withColumnRenamed("nb_signa", "nb_flagged")
    return J.attach_signals(facility, complaints, A.incident_counts(t[T.INCIDENTS]))


@query
def fanout_audit(spark, sf_dir):
    t = report_tables(spark, sf_dir, T.OCCUPATION_2022, T.LODGING)
    lines = base_tables(spark, sf_dir)["lineitem"].selectExpr(
        "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS line"
    )
    return J.fanout_audit({
        "occupation": (C.clean_keyed(t[T.OCCUPATION_2022], "finess"), "finess"),
        "lodging": (C.clean_keyed(t[T.LODGING], "finesset"), "finess"),
        "lines": (lines, "line"),
    })


@query
def facility_finance(spark, sf_dir):
    t = report_tables(spark, sf_dir, T.CLASSES, T.CLASS_DUPLICATES, *[s[0] for s in T.FINANCE_SOURCES])
    return R.facility_finance(t).drop("__row")


# --- reports ----------------------------------------------------------------------------------------------------


def _report(spark, sf_dir, build, variant):
    return build(report_tables(spark, sf_dir), REPORT_REGION, variant)


@query
def targeting_report(spark, sf_dir):
    return _report(spark, sf_dir, R.targeting_report, R.INCIDENTS)


@query
def control_report(spark, sf_dir):
    return _report(spark, sf_dir, R.control_report, R.INCIDENTS)


@query
def targeting_report_complaints(spark, sf_dir):
    return _report(spark, sf_dir, R.targeting_report, R.COMPLAINTS)


@query
def control_report_complaints(spark, sf_dir):
    return _report(spark, sf_dir, R.control_report, R.COMPLAINTS)


@query
def all_regions_report(spark, sf_dir):
    return R.all_regions_report(report_tables(spark, sf_dir), R.CONTROL, ALL_REGIONS, COMPLAINT_REGIONS)


@query
def variant_by_region(spark, sf_dir):
    return R.all_regions_report(report_tables(spark, sf_dir), R.TARGETING, ALL_REGIONS, COMPLAINT_REGIONS)


@query
def sorted_report(spark, sf_dir):
    rows = C.clean_facility(table(spark, sf_dir, T.FACILITIES)).selectExpr(f"finess AS {ref(LABELS['finess'])}", "rs")
    return R.sorted_report(rows)


# --- sources and sinks ------------------------------------------------------------------------------------------

# A header line as it comes: special characters, a blank header, a repeated one, double spaces, an apostrophe.
_RAW_HEADER = "N° FINESS/RPPS;;Dont AMP;Dont AMP;Libellé  d'étape;Cœur d’activité"
_RAW_HEADER_LATIN = "N° FINESS/RPPS;;Dont AMP;Dont AMP;Libellé  d'étape;Activité"


def _write_lines(rows: DataFrame, path: str, header: str, encoding: str = "UTF-8") -> None:
    """Ready-made delimited lines under a raw header line, one copy of it per part file."""
    rows.toDF(header).write.options(header=True, sep="\t", quote="", encoding=encoding).csv(path)


def _customer_lines(spark: SparkSession, sf_dir: str, path: str, header: str, encoding: str) -> None:
    lines = base_tables(spark, sf_dir)["customer"].selectExpr(
        "concat_ws(';', CAST(c_custkey AS STRING), c_mktsegment, CAST(c_nationkey AS STRING),"
        " CASE WHEN c_custkey % 7 = 0 THEN 'NA' ELSE CAST(c_custkey % 11 AS STRING) END,"
        " concat('Été n°', CAST(c_custkey % 5 AS STRING)), concat('\"', c_name, ' ; \"\"cité\"\"\"')) AS line"
    )
    _write_lines(lines, path, header, encoding)


@query
def delimited_scan(spark, sf_dir):
    path = f"{scratch_dir(spark, 'scan')}/customers.csv"
    _customer_lines(spark, sf_dir, path, _RAW_HEADER, "UTF-8")
    return delimited.read_delimited(spark, path)


@query
def delimited_scan_latin1(spark, sf_dir):
    path = f"{scratch_dir(spark, 'latin')}/customers.csv"
    _customer_lines(spark, sf_dir, path, _RAW_HEADER_LATIN, "ISO-8859-1")
    return delimited.read_delimited(spark, path, encoding="ISO-8859-1", infer=True)


@query
def normalise_headers(spark, sf_dir):
    rows = base_tables(spark, sf_dir)["nation"]
    return headers.normalise_columns(rows.toDF("N° FINESS/RPPS", "Libellé  de l'étape", "Cœur d’activité - 2022"))


# Tables that come in ISO-8859-1; the incidents come as one file for each region, with columns of their own.
LATIN_TABLES = (T.FACILITIES, T.MISSIONS, T.COMMUNES)
REGIONAL_FILES = {"nord": ("famille_principale < 'B'", "1 AS numero"), "sud": ("NOT famille_principale < 'B'", "'x' AS saisi_par")}
_BAD_LINES = ("seul", "a;b;c;d;e;f;g;h;i;j;k;l;m;n;o;p;q;r;s;t;u;v;w;x;y;z;0;1;2;3;4;5;6;7;8;9;10;11;12;13;14")


def _raw_folder(spark: SparkSession, sf_dir: str, purpose: str) -> str:
    """All report tables as raw files below one folder, as a region delivers them, with some lines that are not tables'."""
    folder = scratch_dir(spark, purpose)
    options = {"header": True, "sep": ";", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    files = []
    for name, df in report_tables(spark, sf_dir).items():
        if name == T.INCIDENTS:
            for region, (rows, extra) in REGIONAL_FILES.items():
                part = df.where(rows).selectExpr(extra, *map(ref, reversed(df.columns)))
                files.append((part, "UTF-8", f"{folder}/sivss/{region}.csv"))
        else:
            files.append((df, "ISO-8859-1" if name in LATIN_TABLES else "UTF-8", f"{folder}/tables/{name}.csv"))
    files.append((report_tables(spark, sf_dir, T.COMMUNES)[T.COMMUNES], "UTF-8", f"{folder}/demo.csv"))
    # Tables are written side by side: most have too few tasks to take the cluster on their own.
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda f: f[0].write.options(encoding=f[1], **options).csv(f[2]), files))
    bad = spark.createDataFrame([("dep;reg;ncc",), *((x,) for x in _BAD_LINES)], "line string").coalesce(1)
    bad.write.text(f"{folder}/tables/{T.DEPARTMENTS}.csv/faulty.csv")
    return folder


def _read_raw(spark: SparkSession, folder: str, schemas: dict | None = None) -> dict[str, DataFrame]:
    latin = dict.fromkeys(LATIN_TABLES, "ISO-8859-1")
    return delimited.read_folder(
        spark, folder, encoding=latin, schemas=schemas, views=False, appended={T.INCIDENTS: "sivss"}, checked=True
    )


@query
def folder_tables(spark, sf_dir):
    """Every table and column of a raw folder as read: values and characters."""
    found = []
    for name, df in _read_raw(spark, _raw_folder(spark, sf_dir, "folder"), {}).items():
        if name == "rejects":
            found.append(df.selectExpr("table_name", "reason AS column_name", "line").groupBy("table_name", "column_name").agg(
                F.expr("count(1) AS n_values"), F.expr("sum(length(line)) AS n_chars")
            ))
            continue
        figures = [x for c in df.columns for x in (f"count({ref(c)}) AS {ref('n ' + c)}", f"coalesce(sum(length({ref(c)})), 0) AS {ref('l ' + c)}")]
        entries = ", ".join(f"{keys.lit(c)}, {ref('n ' + c)}, {ref('l ' + c)}" for c in df.columns)
        seen = df.selectExpr(*figures).selectExpr(f"stack({len(df.columns)}, {entries}) AS (column_name, n_values, n_chars)")
        found.append(seen.selectExpr(f"{keys.lit(name)} AS table_name", "*"))
    return delimited.concat_sources(found)


@query
def rejected_lines(spark, sf_dir):
    """Accepted and rejected lines of each table of a raw folder; together they are the lines of its files."""
    tables = _read_raw(spark, _raw_folder(spark, sf_dir, "lines"))
    rejects = tables.pop("rejects").groupBy("table_name").agg(F.expr("count(1) AS rejected"))
    accepted = delimited.concat_sources([df.selectExpr(f"{keys.lit(n)} AS table_name", "count(1) AS accepted") for n, df in tables.items()])
    return accepted.join(rejects, "table_name", "left").selectExpr("table_name", "accepted", "coalesce(rejected, 0) AS rejected")


def _sheets(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """Every column of the written sheets, as one frame."""
    parts = [spark.read.parquet(path).selectExpr(f"'{sheet}' AS sheet", "*") for sheet, path in folders.items()]
    return delimited.concat_sources(parts)


@query
def folder_to_report(spark, sf_dir):
    """Raw files of all tables to tables, reports of all configured regions, and their export, read back."""
    tables = _read_raw(spark, _raw_folder(spark, sf_dir, "input"))
    names = regions.configured_regions(spark)
    wanted = spark.createDataFrame([(0,)], "code int").union(names.select("code"))
    both = R.all_regions_report(tables, R.BOTH, wanted, COMPLAINT_REGIONS)
    sheets = sinks.export_report(both, scratch_dir(spark, "output"), names, RUN_DAY, complaint_regions=COMPLAINT_REGIONS)
    return _sheets(spark, sheets)


@query
def published_report(spark, sf_dir):
    """Reports published twice on one day; the second run covers two regions, of which one has lost its rows."""
    t = report_tables(spark, sf_dir)
    names, path = regions.configured_regions(spark), scratch_dir(spark, "published")
    # Both runs publish the same rows, which are made once.
    both = written(R.all_regions_report(t, R.BOTH, ALL_REGIONS, COMPLAINT_REGIONS), "both")
    sinks.publish_report(both, path, names, RUN_DAY)
    covered = spark.createDataFrame([(1,), (4,)], "code int")
    sinks.publish_report(both.where("region_code = 1"), path, names, RUN_DAY, covered)
    return delimited.concat_sources([
        sinks.published(spark, path, RUN_DAY, name).selectExpr(f"'{name}' AS sheet", "*") for name in sinks.SHEETS.values()
    ])


# The key columns of the tables that are joined or counted by establishment, in the types of two register systems.
KEY_COLUMNS = {
    T.FACILITIES: "finess", T.COMPLAINTS: "ndeg_finessrpps", T.MISSIONS: "code_finess", T.CAPACITIES: "et-ndegfiness",
    T.TOTAL_CAPACITY: "etiquettes_de_lignes", T.OCCUPATION_2020: "finess_19", T.OCCUPATION_2021: "finess",
    T.OCCUPATION_2022: "finess", T.LODGING: "finesset", T.DEPENDENCY: "finess_et", T.INDICATORS: "et_finess",
    **{name: "finess_geographique" for name in T.DASHBOARDS.values()},
}


@query
def numeric_keys(spark, sf_dir):
    """The targeting report where keys came out of a database as numbers: register and facts in each other's types."""
    reports = []
    for register, facts in (("double", "bigint"), ("bigint", "double"), ("string", "double")):
        tables = dict(report_tables(spark, sf_dir))
        for i, (name, column) in enumerate(KEY_COLUMNS.items()):
            kind = register if name == T.FACILITIES else facts if i % 3 else "double"
            if kind != "string":
                typed = f"CAST(CAST({ref(column)} AS DOUBLE) AS {kind})"
                tables[name] = tables[name].selectExpr(*[named(typed if c == column else ref(c), c) for c in tables[name].columns])
        report = R.build_report(tables, R.TARGETING, [REPORT_REGION], ()).drop("region_code")
        reports.append(report.selectExpr(f"'{register}' AS register", *map(ref, report.columns)))
    return delimited.concat_sources(reports)


@query
def concat_sources(spark, sf_dir):
    orders = base_tables(spark, sf_dir)["orders"]
    return delimited.concat_sources([
        orders.where("o_orderstatus = 'F'").drop("o_orderpriority"),
        orders.where("o_orderstatus = 'O'"),
        orders.where("o_orderstatus = 'P'").select("o_orderpriority", "o_orderkey"),
    ]).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@query
def landed_roundtrip(spark, sf_dir):
    path = f"{scratch_dir(spark, 'landed')}/t-finess"
    facility = C.clean_facility(table(spark, sf_dir, T.FACILITIES))
    sinks.land_table(facility.limit(0), path)
    sinks.land_table(facility, path)
    return spark.read.parquet(path)


@query
def label_region(spark, sf_dir):
    supplier = base_tables(spark, sf_dir)["supplier"]
    labelled = regions.label_region(supplier, regions.configured_regions(spark), "s_nationkey")
    return labelled.select("s_suppkey", "s_nationkey", "ncc", "nom")


@query
def region_partitioned_export(spark, sf_dir):
    t = report_tables(spark, sf_dir)
    both = R.all_regions_report(t, R.BOTH, ALL_REGIONS, COMPLAINT_REGIONS)
    sheets = sinks.export_report(
        both, scratch_dir(spark, "export"), regions.configured_regions(spark), RUN_DAY, complaint_regions=COMPLAINT_REGIONS
    )
    return _sheets(spark, sheets)
