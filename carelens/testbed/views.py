"""Report tables derived from the test tables, as SQL both engines read.

Spark runs these over the parquet files; the reference SQL carries the same texts as CTEs.  ``{name}`` stands for a
test table.  Keys come in every form the reports must cope with: 9 characters, 8 (zero lost), with a ``.0`` tail, NULL.
"""

from pyspark.sql import DataFrame, SparkSession

from carelens import tables as T
from carelens.fixed_values import (
    COMPLAINT_MOTIFS,
    DASHBOARD_2022_ONLY,
    DASHBOARD_FTE,
    DASHBOARD_PERSONS,
    DASHBOARD_RATES,
    FAMILY_CARE,
    FAMILY_EVENT,
    INCIDENT_NATURES,
)

BASE_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "documents", "supplier")


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def bare_key(n: str) -> str:
    """8 characters for every fifth number (a zero was lost), 9 otherwise."""
    return f"CAST(10000000 + {n} + 90000000 * least({n} % 5, 1) AS STRING)"


def raw_key(n: str) -> str:
    """Identifier of number ``n`` as a source file might hold it: now and then with a ``.0`` tail."""
    return f"{bare_key(n)} || substr('.0', 1, CAST(2 * greatest(1 - abs({n} % 10 - 5), 0) AS INT))"


def full_key(n: str) -> str:
    """The canonical form of ``raw_key``."""
    return f"lpad({bare_key(n)}, 9, '0')"


def commune_code(n: str) -> str:
    return f"CAST(1000 + {n} AS STRING)"


def tenths(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE) / CAST(10 AS DOUBLE)"


def comma(expr: str) -> str:
    """Number of tenths as text with a decimal comma."""
    return f"replace(CAST({tenths(expr)} AS STRING), '.', ',')"


def one_of(number: str, texts: list[str | None]) -> str:
    cases = " ".join(f"WHEN {i} THEN {q(t) if t is not None else 'NULL'}" for i, t in enumerate(texts))
    return f"CASE {number} % {len(texts)} {cases} END"


_MOTIF_TEXTS: list[str | None] = [
    *COMPLAINT_MOTIFS,
    None,
    COMPLAINT_MOTIFS[0].upper() + " ; " + COMPLAINT_MOTIFS[6],
    "Autre motif",
]


def _dashboard(year: int, factor: int) -> str:
    rates = [
        f"CASE WHEN c_custkey % {11 + i} = 3 THEN NULL ELSE {expr} END AS {name}"
        for i, name in enumerate(DASHBOARD_RATES.values())
        for expr in [
            comma(f"(c_custkey * {factor + i}) % 400") if year == 2020 else tenths(f"(c_custkey * {factor + i}) % 400")
        ]
    ]
    staff = [
        f"CASE WHEN c_custkey % 53 = {i} THEN NULL ELSE {tenths(f'(c_custkey * {factor + i}) % 97')} END AS {qi(name)}"
        for i, name in enumerate(DASHBOARD_FTE.values())
    ]
    single = [
        f"{tenths(f'(c_custkey * {factor + i}) % 61')} AS {qi(name)}"
        for i, name in enumerate(DASHBOARD_2022_ONLY.values() if year == 2022 else ())
    ]
    persons = f"CAST((c_custkey * 7) % 90 AS DOUBLE) AS {DASHBOARD_PERSONS}"
    columns = ", ".join([f"{raw_key('c_custkey')} AS finess_geographique", *rates, *staff, *single, persons])
    return f"SELECT {columns} FROM {{customer}} WHERE c_custkey % 7 <> {year % 7}"


def qi(name: str) -> str:
    """Quoted name; Spark's SQL text gets its own quoting when it is run."""
    return '"' + name + '"'


def _finance(slot: int, value: str) -> str:
    return (
        f"SELECT {bare_key('l_partkey')} || ' - PART ' || CAST(l_partkey AS STRING) AS {qi(T.FINANCE_LABEL)},"
        f" CAST(l_extendedprice AS DECIMAL(18,2)) AS {value} FROM {{lineitem}} WHERE l_suppkey % 10 = {slot}"
    )


VIEWS: dict[str, str] = {
    T.FACILITIES: f"""
        SELECT {raw_key('c_custkey')} AS finess, c_mktsegment AS categ_lib,
               CAST(CASE c_custkey % 3 WHEN 0 THEN 500 WHEN 1 THEN 159 ELSE 999 END AS INT) AS categ_code,
               c_name AS rs, {raw_key('(c_custkey % 97)')} AS ej_finess, 'EJ ' || c_mktsegment AS ej_rs,
               {one_of('c_custkey', ['Public', 'Privé', None, 'Associatif'])} AS statut_jur_lib,
               CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN CAST(c_custkey % 100 AS STRING)
                    WHEN 2 THEN CAST(c_custkey % 100 AS STRING) || 'B'
                    ELSE CAST(c_custkey % 100 AS STRING) || '.0' END AS adresse_num_voie,
               CASE WHEN c_custkey % 4 = 0 THEN 'BIS' END AS adresse_comp_voie,
               CASE WHEN c_custkey % 9 = 4 THEN NULL ELSE 'RUE' END AS adresse_type_voie,
               c_mktsegment AS adresse_nom_voie,
               CASE WHEN c_custkey % 7 = 0 THEN 'LIEU' END AS adresse_lieuditbp,
               CASE WHEN c_custkey % 8 = 3 THEN NULL ELSE 'VILLE ' || CAST(c_nationkey AS STRING) END AS adresse_lib_routage,
               CAST(1000 + (c_custkey * 37) % 95000 AS STRING) || CASE WHEN c_custkey % 6 = 1 THEN ' CEDEX' ELSE '' END
                   AS adresse_code_postal,
               {commune_code('c_nationkey')} AS com_code
        FROM {{customer}}""",
    T.COMMUNES: f"""
        SELECT '0' || {commune_code('n_nationkey')} AS com,
               CASE WHEN n_nationkey < 20 THEN CAST(n_nationkey AS STRING) END AS dep,
               CASE WHEN n_nationkey < 20 THEN n_regionkey END AS reg, n_name AS ncc,
               CASE WHEN n_nationkey = 24 THEN '0' || {commune_code('n_nationkey')}
                    WHEN n_nationkey >= 20 THEN {commune_code('n_nationkey % 20')} END AS comparent
        FROM {{nation}}""",
    T.DEPARTMENTS: """
        SELECT CAST(n_nationkey AS STRING) AS dep, n_regionkey AS reg, 'DEP ' || n_name AS ncc
        FROM {nation} WHERE n_nationkey < 20""",
    T.REGIONS_TABLE: "SELECT r_regionkey AS reg, r_name AS ncc FROM {region}",
    T.COMPLAINTS: f"""
        SELECT CASE WHEN o_orderkey % 50 = 49 THEN NULL ELSE {raw_key('o_custkey')} END AS ndeg_finessrpps,
               CASE o_orderstatus WHEN 'F' THEN 'Non' WHEN 'O' THEN 'Oui' END AS signalement,
               {one_of('o_orderkey', _MOTIF_TEXTS)} AS motifs_igas
        FROM {{orders}}""",
    T.INCIDENTS: f"""
        SELECT CASE WHEN l_suppkey % 13 = 0 THEN NULL WHEN l_suppkey % 13 < 4 THEN {raw_key('l_partkey')}
                    WHEN l_suppkey % 13 < 7 THEN 'ORG ' || {bare_key('l_partkey')}
                    ELSE 'ORG ' || {full_key('l_partkey')} END
                   AS declarant_organismendeg_finess,
               CASE l_linenumber % 3 WHEN 0 THEN NULL
                    WHEN 1 THEN {bare_key('l_partkey')} || ' - SITE'
                    ELSE {raw_key('(l_partkey + 1)')} END AS survenue_du_cas_en_collectivitendeg_finess,
               {one_of('l_suppkey', ['Oui', None, 'Non', 'Non'])} AS reclamation,
               CASE l_linestatus WHEN 'F' THEN 'Oui' ELSE CASE WHEN l_suppkey % 17 = 1 THEN NULL ELSE 'Non' END END
                   AS ceci_est_un_eigs,
               CASE l_returnflag WHEN 'A' THEN {q(FAMILY_EVENT)} WHEN 'N' THEN {q(FAMILY_CARE)} ELSE 'Autre' END
                   AS famille_principale,
               {one_of('l_orderkey', [*INCIDENT_NATURES, None, 'Autre nature'])} AS nature_principale
        FROM {{lineitem}}""",
    T.MISSIONS: f"""
        SELECT CASE WHEN o_orderkey % 40 = 39 THEN NULL ELSE {raw_key('o_custkey')} END AS code_finess,
               'M' || CAST(o_orderkey % 3 AS STRING) AS identifiant_de_la_mission,
               CASE WHEN o_orderkey % 9 = 8 THEN 'à fixer'
                    ELSE '15/06/' || CAST(year(o_orderdate) + 25 AS STRING) END AS date_provisoire_visite,
               CASE WHEN o_orderkey % 11 = 10 THEN NULL
                    ELSE CAST(10 + o_orderkey % 19 AS STRING) || '/0' || CAST(1 + o_custkey % 9 AS STRING) || '/'
                         || CAST(year(o_orderdate) + 24 AS STRING) END AS date_reelle_visite,
               {one_of('o_orderkey', ['Sur site', 'Sur pièces', 'Autre'])} AS modalite_dinvestigation
        FROM {{orders}}""",
    T.CLASSES: f"""
        SELECT {full_key('c_custkey')} || ' - ' || c_name AS {qi(T.CLASS_LABEL)},
               {one_of('c_custkey', ['ERRD', 'CA PA', 'CA PH', 'ERRD', 'AUTRE', None, 'ERRD'])} AS cadre
        FROM {{customer}}
        UNION ALL
        SELECT {full_key('c_custkey')} || ' - ' || c_name, 'CA PA' FROM {{customer}} WHERE c_custkey % 31 = 0""",
    T.CLASS_DUPLICATES: f"SELECT {full_key('c_custkey')} || ' - ' || c_name AS finess FROM {{customer}} WHERE c_custkey % 6 = 0",
    T.CAPACITIES: f"""
        SELECT {raw_key('c_custkey')} AS {qi('et-ndegfiness')},
               {one_of('c_custkey', ['40', '12.7', 'abc', '', '8', None, '105'])} AS total_heberg_comp_inter_places_autorisees,
               CAST(c_custkey % 23 AS STRING) AS total_accueil_de_jour_places_autorisees,
               CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE CAST(c_custkey % 5 AS STRING) END
                   AS total_accueil_de_nuit_places_autorisees
        FROM {{customer}} WHERE c_custkey % 12 <> 11""",
    T.TOTAL_CAPACITY: f"""
        SELECT {raw_key('c_custkey')} AS etiquettes_de_lignes,
               {tenths('(c_custkey * 3) % 800')} AS somme_de_capacite_autorisee_totale_
        FROM {{customer}} WHERE c_custkey % 14 <> 13""",
    T.OCCUPATION_2020: f"""
        SELECT {raw_key('c_custkey')} AS finess_19, {tenths('(c_custkey * 11) % 1000')} AS taux_occ_2020
        FROM {{customer}} WHERE c_custkey % 8 <> 5""",
    T.OCCUPATION_2021: f"""
        SELECT {raw_key('c_custkey')} AS finess, {tenths('(c_custkey * 13) % 1000')} AS taux_occ_2021
        FROM {{customer}} WHERE c_custkey % 8 <> 6""",
    T.OCCUPATION_2022: f"""
        SELECT {raw_key('c_custkey')} AS finess, {tenths('(c_custkey * 17) % 1000')} AS taux_occ_2022,
               {tenths('(c_custkey * 19) % 1000')} AS taux_occ_trimestre3, CAST(c_custkey % 120 AS INT) AS nb_lits_occ_2022
        FROM {{customer}}
        UNION ALL
        SELECT {full_key('c_custkey')}, {tenths('(c_custkey * 23) % 1000')}, CAST(NULL AS DOUBLE), CAST(7 AS INT)
        FROM {{customer}} WHERE c_custkey % 29 = 0""",
    T.LODGING: f"""
        SELECT {raw_key('c_custkey')} AS finesset, {tenths('500 + (c_custkey * 29) % 600')} AS prixhebpermcs
        FROM {{customer}} WHERE c_custkey % 9 <> 2""",
    T.DEPENDENCY: f"""
        SELECT {raw_key('c_custkey')} AS finess_et, {tenths('(c_custkey * 31) % 9000')} AS gmp,
               {tenths('(c_custkey * 37) % 3000')} AS pmp
        FROM {{customer}} WHERE c_custkey % 10 <> 7""",
    T.INDICATORS: f"""
        SELECT {raw_key('c_custkey')} AS et_finess, {comma('(c_custkey * 41) % 1000')} AS taux_plus_10_medics_cip13,
               {one_of('c_custkey', ['12,5', 'abc', '', ' 7.25 ', None, '12d'])} AS taux_hospit_mco,
               {comma('(c_custkey * 43) % 1000')} AS taux_hospit_had
        FROM {{customer}} WHERE c_custkey % 13 <> 12""",
    T.DASHBOARDS[2020]: _dashboard(2020, 47),
    T.DASHBOARDS[2021]: _dashboard(2021, 59),
    T.DASHBOARDS[2022]: _dashboard(2022, 67),
    **{table: _finance(slot, value) for slot, (table, _, _, value) in enumerate(T.FINANCE_SOURCES)},
}


def base_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in BASE_TABLES}


_PLANS: dict[tuple[str, str, str], DataFrame] = {}


def report_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named report tables (all by default) over the test tables of a folder.

    The frames, which are plans and hold no data, are kept per session so that their texts are analysed once.
    """
    session = spark.sparkContext.applicationId
    missing = [name for name in names or VIEWS if (session, sf_dir, name) not in _PLANS]
    base = base_tables(spark, sf_dir) if missing else {}
    for name in missing:
        used = {table: df for table, df in base.items() if "{" + table + "}" in VIEWS[name]}
        _PLANS[session, sf_dir, name] = spark.sql(VIEWS[name].replace('"', "`"), **used)
    return {name: _PLANS[session, sf_dir, name] for name in names or VIEWS}


def cte(*names: str) -> str:
    """``WITH`` clause giving the reference SQL the same tables."""
    bound = {name: name for name in BASE_TABLES}
    return "WITH " + ",\n".join(f"{qi(name)} AS ({VIEWS[name].format(**bound)})" for name in names)
