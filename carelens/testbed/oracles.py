"""Reference SQL of the registered queries, in DuckDB's dialect, over the same test tables.

Written straight from the definitions: every figure is counted on its own, every finance table grouped on its own, the
geography joined step by step.  Nothing of the Spark plans is shared but the fixed values and the derived tables.
"""

from carelens import tables as T
from carelens.fixed_values import (
    CATEGORY_CODES,
    COMPLAINT_MOTIFS,
    DASHBOARD_2022_ONLY,
    DASHBOARD_FTE,
    DASHBOARD_PERSONS,
    DASHBOARD_RATES,
    FAMILY_CARE,
    FAMILY_EVENT,
    INCIDENT_NATURES,
    LABELS,
    REGIONS,
)
from carelens.plans.reports import COMPLAINTS, CONTROL, INCIDENTS, TARGETING, report_fields
from carelens.testbed.queries import (
    ALL_REGIONS,
    COMPLAINT_REGIONS,
    DOCUMENT_NEEDLES,
    REPORT_REGION,
)
from carelens.testbed.views import VIEWS, cte, q, qi

# --- expressions ------------------------------------------------------------------------------------------------


def canonical(x: str) -> str:
    return f"regexp_replace({x}, '\\.0$', '')"


def pad(x: str, short: int) -> str:
    return f"CASE WHEN length({x}) = {short} THEN '0' || {x} ELSE {x} END"


def key(x: str) -> str:
    return pad(canonical(x), 8)


def commune(x: str) -> str:
    return pad(canonical(x), 4)


def label(x: str) -> str:
    return f"substr({pad(f"regexp_extract({x}, '^\\s*([0-9A-Za-z]+)', 1)", 8)}, 1, 9)"


def integer(x: str) -> str:
    return f"TRY_CAST(regexp_extract({x}, '^\\s*([+-]?\\d+)', 1) AS BIGINT)"


def number(x: str) -> str:
    return f"TRY_CAST(replace(trim({x}), ',', '.') AS DOUBLE)"


def rounded(x: str, digits: int) -> str:
    """Half away from zero on the decimal digits of a double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def mean(*numbers: str) -> str:
    total = " + ".join(f"coalesce({n}, 0)" for n in numbers)
    present = " + ".join(f"CAST({n} IS NOT NULL AS INT)" for n in numbers)
    return f"(({total}) / nullif({present}, 0))"


def day(x: str) -> str:
    return f"CAST(try_strptime({x}, '%d/%m/%Y') AS DATE)"


def count_if(condition: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


def incident_key(declarant: str, location: str) -> str:
    own = f"right({pad(f"regexp_extract({canonical(declarant)}, '([0-9A-Za-z]+)\\s*$', 1)", 8)}, 9)"
    return f"CASE WHEN {location} IS NULL THEN {own} ELSE {label(location)} END"


ADDRESS_PARTS = ("num_voie", "comp_voie", "type_voie", "nom_voie", "lieuditbp", "lib_routage")


def address() -> str:
    number_, *middle, last = [f"adresse_{p}" for p in ADDRESS_PARTS]
    shown = [f"regexp_replace({number_}, '[.]0$', '')", *middle]
    return " || ".join([*[f"coalesce({p} || ' ', '')" for p in shown], f"coalesce({last}, '')"])


# --- common tables ----------------------------------------------------------------------------------------------

FACILITY = f"""
facility AS (
  SELECT {key('finess')} AS finess, categ_lib, categ_code, rs, {key('ej_finess')} AS ej_finess, ej_rs,
         statut_jur_lib, {address()} AS adresse,
         {pad(f"CAST({integer('adresse_code_postal')} AS VARCHAR)", 4)} AS adresse_code_postal,
         {commune('com_code')} AS com_code
  FROM {qi(T.FACILITIES)} WHERE categ_code IN ({', '.join(map(str, CATEGORY_CODES))}))"""

COMMUNE = f"""
coded AS (SELECT {commune('com')} AS com, dep, reg, ncc, {commune('comparent')} AS comparent FROM {T.COMMUNES}),
commune AS (
  SELECT com, dep, ncc FROM coded WHERE reg IS NOT NULL
  UNION ALL
  SELECT a.com, b.dep, a.ncc FROM coded a LEFT JOIN coded b ON a.comparent = b.com AND b.dep IS NOT NULL
  WHERE a.reg IS NULL AND a.com <> a.comparent)"""

_COUNTED = "ndeg_finessrpps IS NOT NULL AND (signalement = 'Non' OR signalement IS NULL)"
_REPORTED = "ndeg_finessrpps IS NOT NULL AND signalement = 'Oui'"

COMPLAINT = f"""
complaint AS (SELECT {key('ndeg_finessrpps')} AS finess, count(*) AS nb_recla
              FROM {T.COMPLAINTS} WHERE {_COUNTED} GROUP BY 1)"""
FLAGGED = f"""
flagged AS (SELECT {key('ndeg_finessrpps')} AS finess, count(*) AS nb_signa
            FROM {T.COMPLAINTS} WHERE {_REPORTED} GROUP BY 1)"""
MOTIF = f"""
motif AS (SELECT {key('ndeg_finessrpps')} AS finess,
          {', '.join(f'{count_if(f"contains(lower(motifs_igas), {q(m.lower())})")} AS {qi(m)}' for m in COMPLAINT_MOTIFS)}
          FROM {T.COMPLAINTS} WHERE {_COUNTED} GROUP BY 1)"""

_IS_EVENT = f"famille_principale = {q(FAMILY_EVENT)} AND ceci_est_un_eigs = 'Non'"
_IS_SERIOUS = "ceci_est_un_eigs = 'Oui'"
_IS_CARE = f"famille_principale = {q(FAMILY_CARE)} AND ceci_est_un_eigs = 'Non'"


def _nature(name: str) -> str:
    own = f"AND nature_principale = {q(name)}"
    return " + ".join(count_if(f"{kind} {own}") for kind in (_IS_EVENT, _IS_SERIOUS, _IS_CARE))


INCIDENT = f"""
incident AS (
  SELECT {incident_key('declarant_organismendeg_finess', 'survenue_du_cas_en_collectivitendeg_finess')} AS finess,
         count(*) AS nb_signa, {count_if(_IS_EVENT)} AS nb_ei, {count_if(_IS_SERIOUS)} AS nb_eigs,
         {count_if(_IS_CARE)} AS nb_eias,
         {count_if(_IS_EVENT)} + {count_if(_IS_SERIOUS)} + {count_if(_IS_CARE)} AS nb_events,
         {', '.join(f'{_nature(n)} AS {qi(n)}' for n in INCIDENT_NATURES)}
  FROM {T.INCIDENTS} WHERE reclamation <> 'Oui' GROUP BY 1)"""

MISSION = f"""
mission AS (
  SELECT DISTINCT {key('code_finess')} AS finess, identifiant_de_la_mission, date_provisoire_visite,
         date_reelle_visite, modalite_dinvestigation AS mode
  FROM {T.MISSIONS} WHERE code_finess IS NOT NULL AND {day('date_reelle_visite')} >= DATE '2021-01-01')"""
_DONE = f"{day('date_reelle_visite')} <= DATE '2023-12-31'"
_PLANNED = f"{day('date_reelle_visite')} > DATE '2023-12-31' AND {day('date_provisoire_visite')} > DATE '2023-12-31'"
INSPECTION = f"""
inspection AS (
  SELECT finess, {count_if(_DONE)} AS inspections_done,
         {count_if(f"{_DONE} AND mode = 'Sur site'")} AS inspections_on_site,
         {count_if(f"{_DONE} AND mode = 'Sur pièces'")} AS inspections_on_file,
         {count_if(_PLANNED)} AS inspections_planned
  FROM mission GROUP BY finess)"""

CLASS = f"""
class AS (
  SELECT c.finess, c.cadre FROM (SELECT {label(qi(T.CLASS_LABEL))} AS finess, cadre FROM {T.CLASSES}) c
  WHERE NOT coalesce(c.cadre <> 'ERRD' AND c.finess IN (
      SELECT {label('finess')} FROM {T.CLASS_DUPLICATES} WHERE finess IS NOT NULL), FALSE))"""

_FINANCE_TABLES = [source[0] for source in T.FINANCE_SOURCES]
SUMS = ",".join(
    f"\nsum_{table} AS (SELECT {label(qi(T.FINANCE_LABEL))} AS finess, sum({value}) AS total FROM {table} GROUP BY 1)"
    for table, _, _, value in T.FINANCE_SOURCES
)
_MEASURES = {
    "charges": ("sum_errd_charges.total", "sum_capa_charges.total", "sum_caph_charges.total"),
    "tariff_income": ("sum_errd_produitstarif.total", "sum_capa_produitstarif.total", "sum_caph_produitstarif.total"),
    "account70_income": ("sum_errd_produits70.total", "0", "sum_caph_produits70.total"),
    "total_income": ("sum_errd_produitsencaiss.total", "0", "sum_caph_produitsencaiss.total"),
}


def _routed(source: str, digits: int | None) -> str:
    def measure(name: str, sums: tuple[str, str, str]) -> str:
        errd, capa, caph = sums
        chosen = f"CASE cadre WHEN 'ERRD' THEN {errd} WHEN 'CA PA' THEN {capa} WHEN 'CA PH' THEN {caph} END"
        return f"CAST({chosen if digits is None else f'round({chosen}, {digits})'} AS DOUBLE) AS {name}"

    joins = "\n".join(f"  LEFT JOIN sum_{t} ON sum_{t}.finess = {source}.finess" for t in _FINANCE_TABLES)
    return (
        f"SELECT {source}.finess, cadre, {', '.join(measure(n, s) for n, s in _MEASURES.items())}\n"
        f"FROM {source}\n{joins}"
    )


FINANCE = f"\nfinance AS ({_routed('class', 0)})"


def _dashboard_columns(year: int) -> dict[str, str]:
    def value(source: str) -> str:
        return number(source) if year == 2020 and source in DASHBOARD_RATES.values() else qi(source)

    staff = " + ".join(qi(c) for c in DASHBOARD_FTE.values())
    care = f"({qi(DASHBOARD_FTE['fte_paramedical'])} + {qi(DASHBOARD_FTE['fte_medical'])})"
    columns = {f: value(c) for f, c in DASHBOARD_RATES.items()}
    if year == 2022:
        columns |= {f: qi(c) for f, c in {**DASHBOARD_FTE, **DASHBOARD_2022_ONLY}.items()}
        columns["persons"] = qi(DASHBOARD_PERSONS)
    columns["fte_total"] = f"({staff})"
    columns["fte_per_user"] = rounded(ratio(f"({staff})", qi(DASHBOARD_PERSONS)), 2)
    if year == 2022:
        columns["care_fte_per_user"] = rounded(ratio(care, qi(DASHBOARD_PERSONS)), 2)
    return columns


def _dashboard(year: int) -> str:
    columns = ", ".join(f"{expr} AS {name}" for name, expr in _dashboard_columns(year).items())
    return f"SELECT {key('finess_geographique')} AS finess, {columns} FROM {qi(T.DASHBOARDS[year])}"


DASHBOARD = ",".join(f"\ny{year} AS ({_dashboard(year)})" for year in T.DASHBOARDS)


# --- reports ----------------------------------------------------------------------------------------------------


def _fields(kind: str) -> dict[str, str]:
    fields = {
        "region": "r.ncc", "dep_code": "d.dep", "dep_name": "d.ncc", "category": "f.categ_lib", "finess": "f.finess",
        "name": "f.rs", "legal_finess": "f.ej_finess", "legal_name": "f.ej_rs", "legal_status": "f.statut_jur_lib",
        "address": "f.adresse", "postal_code": "f.adresse_code_postal", "commune": "c.ncc",
        "commune_code": "f.com_code",
        "capacity_hp": integer("cap.total_heberg_comp_inter_places_autorisees"),
        "capacity_aj": integer("cap.total_accueil_de_jour_places_autorisees"),
        "capacity_ht": integer("cap.total_accueil_de_nuit_places_autorisees"),
        "occupancy_2020": "o20.taux_occ_2020", "occupancy_2021": "o21.taux_occ_2021",
        "occupancy_2022": "o22.taux_occ_2022", "residents": "o22.nb_lits_occ_2022",
        "occupancy_q3": "o22.taux_occ_trimestre3", "day_price": "lodging.prixhebpermcs",
        "gmp": rounded("dep.gmp", 0), "pmp": rounded("dep.pmp", 0),
        "many_drugs": number("ind.taux_plus_10_medics_cip13"), "emergency_rate": "''",
        "mco_rate": number("ind.taux_hospit_mco"), "had_rate": number("ind.taux_hospit_had"),
        "dashboard_entry": "''",
        **{m: f"finance.{m}" for m in _MEASURES},
        "fte_per_user_2019": "y2020.fte_per_user", "fte_per_user_2020": "y2021.fte_per_user",
        "fte_per_user_2021": "y2022.fte_per_user",
        "fte_per_user_mean": mean("y2020.fte_per_user", "y2021.fte_per_user", "y2022.fte_per_user"),
        "care_fte_per_user": "y2022.care_fte_per_user",
        **{f: f"y2022.{f}" for f in (*DASHBOARD_FTE, *DASHBOARD_2022_ONLY)},
        "fte_coordinator": rounded("y2022.fte_coordinator", 2), "fte_total": rounded("y2022.fte_total", 2),
        "complaints": "coalesce(complaint.nb_recla, 0)",
        "events": "coalesce(incident.nb_ei, 0)", "serious_events": "coalesce(incident.nb_eigs, 0)",
        "care_events": "coalesce(incident.nb_eias, 0)", "flagged": "coalesce(flagged.nb_signa, 0)",
        "all_events": "coalesce(incident.nb_ei, 0) + coalesce(incident.nb_eigs, 0) + coalesce(incident.nb_eias, 0)",
        **{f"motif_{i + 1}": f"coalesce(motif.{qi(m)}, 0)" for i, m in enumerate(COMPLAINT_MOTIFS[:10])},
        **{f"nature_{i + 1}": f"coalesce(incident.{qi(n)}, 0)" for i, n in enumerate(INCIDENT_NATURES)},
        **{f: f"coalesce(inspection.{f}, 0)" for f in
           ("inspections_done", "inspections_on_site", "inspections_on_file", "inspections_planned")},
    }
    parts = " + ".join(f"coalesce({fields[f]}, 0)" for f in ("capacity_hp", "capacity_aj", "capacity_ht"))
    total = "total.somme_de_capacite_autorisee_totale_"
    fields["capacity"] = f"CASE WHEN f.categ_code = 500 THEN {parts} ELSE CAST(trunc({total}) AS BIGINT) END"
    fields["complaint_rate"] = f"coalesce({rounded(ratio('complaint.nb_recla', total), 4)} * 100, 0)"
    for rate in DASHBOARD_RATES:
        sources = [f"y{year}.{rate}" for year in T.DASHBOARDS]
        fields |= {f"{rate}_{2019 + i}": source for i, source in enumerate(sources)}
        fields[f"{rate}_mean"] = rounded(mean(*sources), 2)
        if rate == "external" and kind == TARGETING:
            fields["external_mean_finer"] = rounded(mean(*sources), 4)
    return fields


_EVENT_FIELDS = {"events", "serious_events", "care_events", "all_events"}


def _report(kind: str, regions: tuple[int, ...], special: tuple[int, ...]) -> str:
    """Report SQL; a region in ``special`` takes the complaints variant."""
    variants = {COMPLAINTS if r in special else INCIDENTS for r in regions}
    variant = next(iter(variants)) if len(variants) == 1 else None
    fields = _fields(kind)
    if "external_mean_finer" in fields:
        is_special = f"r.reg IN ({', '.join(map(str, special)) or 'NULL'})"
        fields["external_mean"] = (
            f"CASE WHEN {is_special} THEN {fields['external_mean_finer']} ELSE {fields['external_mean']} END"
        )
    if variant is None:
        inside = f"r.reg IN ({', '.join(map(str, special))})"
        for f in report_fields(kind):
            if f == "flagged":
                fields[f] = f"CASE WHEN {inside} THEN {fields[f]} END"
            elif f in _EVENT_FIELDS or f.startswith("nature_"):
                fields[f] = f"CASE WHEN NOT {inside} THEN {fields[f]} END"
    listed = report_fields(kind, variant)
    columns = [f"{fields[f]} AS {qi(LABELS[f])}" for f in listed]
    code = "r.reg AS region_code, " if len(regions) > 1 else ""

    def side(table: str, alias: str, own_key: str) -> str:
        return f"LEFT JOIN (SELECT *, {key(qi(own_key))} AS k FROM {qi(table)}) {alias} ON {alias}.k = f.finess"

    joins = [
        "LEFT JOIN commune c ON c.com = f.com_code",
        f"LEFT JOIN {T.DEPARTMENTS} d ON d.dep = c.dep",
        f"LEFT JOIN {T.REGIONS_TABLE} r ON r.reg = d.reg",
        side(T.CAPACITIES, "cap", "et-ndegfiness"),
        side(T.TOTAL_CAPACITY, "total", "etiquettes_de_lignes"),
        side(T.OCCUPATION_2020, "o20", "finess_19"),
        side(T.OCCUPATION_2021, "o21", "finess"),
        side(T.OCCUPATION_2022, "o22", "finess"),
        side(T.LODGING, "lodging", "finesset"),
        side(T.DEPENDENCY, "dep", "finess_et"),
        side(T.INDICATORS, "ind", "et_finess"),
        *[
            f"LEFT JOIN {t} ON {t}.finess = f.finess"
            for t in ("y2020", "y2021", "y2022", "finance", "complaint", "motif", "flagged", "incident", "inspection")
        ],
    ]
    tables = ",".join([
        FACILITY, COMMUNE, COMPLAINT, FLAGGED, MOTIF, INCIDENT, MISSION, INSPECTION, CLASS, SUMS, FINANCE, DASHBOARD
    ])
    return (
        f"{cte(*_ALL_VIEWS)},{tables}\nSELECT {code}{', '.join(columns)}\nFROM facility f\n"
        + "\n".join(joins)
        + f"\nWHERE r.reg IN ({', '.join(map(str, regions))})"
    )


_ALL_VIEWS = (
    T.FACILITIES, T.COMMUNES, T.DEPARTMENTS, T.REGIONS_TABLE, T.COMPLAINTS, T.INCIDENTS, T.MISSIONS, T.CLASSES,
    T.CLASS_DUPLICATES, T.CAPACITIES, T.TOTAL_CAPACITY, T.OCCUPATION_2020, T.OCCUPATION_2021, T.OCCUPATION_2022,
    T.LODGING, T.DEPENDENCY, T.INDICATORS, *T.DASHBOARDS.values(), *_FINANCE_TABLES,
)


# --- single operators -------------------------------------------------------------------------------------------


def _slug() -> str:
    """The documents hold accented letters and few others: those are listed here, the engine strips the accents."""
    text = "lower(text)"
    for char, spelling in (("ß", "ss"), ("œ", "oe"), ("æ", "ae"), ("ø", "o"), ("°", "deg"), ("€", "EUR"), ("–", "-"), ("—", "--")):
        text = f"replace({text}, {q(char)}, {q(spelling)})"
    text = f"strip_accents({text})"
    return f"regexp_replace(regexp_replace({text}, ' +', '_', 'g'), '[^0-9a-zA-Z_-]', '', 'g')"


def _geo(how: str, condition: str) -> str:
    return (
        f"SELECT '{how}' AS how, f.com_code, f.finess, c.ncc AS commune_name, d.dep AS dep_code, d.ncc AS dep_name,"
        " r.reg AS region_code, r.ncc AS region_name FROM facility f LEFT JOIN commune c ON c.com = f.com_code"
        f" LEFT JOIN {T.DEPARTMENTS} d ON d.dep = c.dep LEFT JOIN {T.REGIONS_TABLE} r ON r.reg = d.reg {condition}"
    )


def _keyed(side: str, table: str, own_key: str, value: str) -> str:
    return f"SELECT '{side}' AS side, {key(own_key)} AS finess, {qi(value)} AS value FROM {qi(table)}"


def _duplicates(side: str, keys: str) -> str:
    return f"SELECT '{side}' AS dimension, key, count(*) AS n_rows FROM ({keys}) GROUP BY key HAVING count(*) > 1"


_CSV_FIELDS = (
    "CAST(c_custkey AS {kind}) AS ndeg_finessrpps, c_mktsegment AS unnamed_1, CAST(c_nationkey AS {kind}) AS dont_amp,"
    " CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_custkey % 11 AS {kind}) END AS dont_amp1,"
    " 'Été n°' || CAST(c_custkey % 5 AS VARCHAR) AS libelle_detape, c_name || ' ; \"cité\"'"
)
_RATES = [number(c) for c in DASHBOARD_RATES.values()]
_FACILITY_CAPACITY = " + ".join(
    f"coalesce({integer(c)}, 0)"
    for c in (
        "total_heberg_comp_inter_places_autorisees",
        "total_accueil_de_jour_places_autorisees",
        "total_accueil_de_nuit_places_autorisees",
    )
)
_REGION_ROWS = ", ".join(f"({code}, {q(ncc)}, {q(nom)})" for code, ncc, nom in REGIONS)


#: The columns that each report table is defined with: declared ones that its definition holds.
_COLUMNS = {name: [c for c in T.SCHEMAS[name] if f"AS {c}" in sql or f"AS {qi(c)}" in sql] for name, sql in VIEWS.items()}
_INCIDENT_FILES = (("numero", "famille_principale < 'B'", 1), ("saisi_par", "NOT famille_principale < 'B'", 1))


def _folder_figures() -> str:
    """Values and characters of every column; empty texts count as no value, as on reading."""
    def figures(table: str, column: str) -> str:
        value = f"nullif(CAST({column} AS VARCHAR), '')"
        return f"count({value}) AS n_values, coalesce(sum(length({value})), 0)::BIGINT AS n_chars FROM {qi(table)}"

    parts = []
    for table, columns in _COLUMNS.items():
        parts += [f"SELECT {q(table)} AS table_name, {q(c)} AS column_name, {figures(table, qi(c))}" for c in columns]
    parts += [
        f"SELECT {q(T.INCIDENTS)}, {q(name)}, count(*), (count(*) * {chars})::BIGINT FROM {T.INCIDENTS} WHERE {rows}"
        for name, rows, chars in _INCIDENT_FILES
    ]
    parts += [f"SELECT {q(T.DEPARTMENTS)}, 'too few fields', 1, 4", f"SELECT {q(T.DEPARTMENTS)}, 'too many fields', 1, 86"]
    return f"{cte(*VIEWS)} " + " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    facility = f"{cte(T.FACILITIES)},{FACILITY}"
    geo = f"{cte(T.FACILITIES, T.COMMUNES, T.DEPARTMENTS, T.REGIONS_TABLE)},{FACILITY},{COMMUNE}"
    def exported(kept: str) -> str:
        return " UNION ALL BY NAME ".join(
            f"SELECT '{sheet}' AS sheet, x.*, names.nom FROM ({_report(kind, ALL_REGIONS, COMPLAINT_REGIONS)}) x"
            f" LEFT JOIN (VALUES {_REGION_ROWS}) names(code, ncc, nom) ON names.code = x.region_code WHERE {kept}"
            for sheet, kind in (("ciblage", TARGETING), ("controle", CONTROL))
        )

    typed_keys = f"SELECT register, x.* FROM ({_report(TARGETING, (REPORT_REGION,), ())}) x, (VALUES ('double'), ('bigint'), ('string')) k(register)"
    occupation_keys = f"SELECT {key('finess')} AS key FROM {T.OCCUPATION_2022}"
    lodging_keys = f"SELECT {key('finesset')} AS key FROM {T.LODGING}"
    line_keys = "SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS key FROM lineitem"
    incident_columns = "declarant_organismendeg_finess", "survenue_du_cas_en_collectivitendeg_finess"
    return {
        "pad_code": f"{cte(T.FACILITIES)} SELECT rs, {pad('finess', 8)} AS finess_padded,"
        f" {pad('com_code', 4)} AS commune_padded FROM {qi(T.FACILITIES)}",
        "canonical_key": f"{cte(T.FACILITIES)} SELECT rs, {canonical('finess')} AS from_text,"
        f" CAST(CAST(CAST(finess AS DOUBLE) AS BIGINT) AS VARCHAR) AS from_double FROM {qi(T.FACILITIES)}",
        "prefix_key": f"{cte(T.CLASSES)} SELECT {qi(T.CLASS_LABEL)} AS label, substr({qi(T.CLASS_LABEL)}, 1, 9)"
        f" AS finess FROM {T.CLASSES}",
        "suffix_key": "SELECT c_custkey, right(c_name, 9) AS suffix, right(c_mktsegment, 12) AS whole FROM customer",
        "resolve_incident_key": f"{cte(T.INCIDENTS)} SELECT {', '.join(incident_columns)},"
        f" {incident_key(*incident_columns)} AS finess FROM {T.INCIDENTS}",
        "address_line": f"{cte(T.FACILITIES)} SELECT rs, {address()} AS adresse FROM {qi(T.FACILITIES)}",
        "lenient_int": f"{cte(T.CAPACITIES)} SELECT {qi('et-ndegfiness')} AS finess,"
        " total_heberg_comp_inter_places_autorisees,"
        f" {integer('total_heberg_comp_inter_places_autorisees')} AS places FROM {T.CAPACITIES}",
        "decimal_comma": f"{cte(T.INDICATORS)} SELECT et_finess, {number('taux_plus_10_medics_cip13')} AS many_drugs,"
        f" {number('taux_hospit_mco')} AS mco FROM {T.INDICATORS}",
        "safe_ratio": f"SELECT l_orderkey, l_linenumber, {ratio('l_extendedprice', 'l_discount')}"
        f" AS price_per_discount, {ratio('l_orderkey', 'l_linenumber')} AS order_per_line FROM lineitem",
        "null_to_zero": f"{cte(T.OCCUPATION_2022)} SELECT finess, coalesce(taux_occ_trimestre3, 0) AS rate"
        f" FROM {T.OCCUPATION_2022}",
        "mean_ignore_null": f"{cte(T.DASHBOARDS[2020])} SELECT finess_geographique, {mean(*_RATES[:3])}"
        f" AS mean_of_three, {mean(*_RATES)} AS mean_of_four FROM {qi(T.DASHBOARDS[2020])}",
        "null_strict_sum": f"{cte(T.DASHBOARDS[2022])} SELECT finess_geographique,"
        f" {' + '.join(qi(c) for c in DASHBOARD_FTE.values())} AS fte_total FROM {qi(T.DASHBOARDS[2022])}",
        "parse_dmy": f"{cte(T.MISSIONS)} SELECT identifiant_de_la_mission, date_reelle_visite,"
        f" {day('date_reelle_visite')} AS real_day, {day('date_provisoire_visite')} AS planned_day FROM {T.MISSIONS}",
        "slugify": f"SELECT doc_id, {_slug()} AS slug FROM documents",
        "complaint_rate": f"{cte(T.COMPLAINTS, T.TOTAL_CAPACITY)},{COMPLAINT} SELECT t.finess,"
        f" coalesce({rounded(ratio('nb_recla', 'capacity'), 4)} * 100, 0) AS rate FROM"
        f" (SELECT {key('etiquettes_de_lignes')} AS finess, somme_de_capacite_autorisee_totale_ AS capacity"
        f" FROM {T.TOTAL_CAPACITY}) t LEFT JOIN complaint ON complaint.finess = t.finess",
        "capacity_by_category": f"{cte(T.FACILITIES, T.CAPACITIES, T.TOTAL_CAPACITY)},{FACILITY}"
        f" SELECT f.finess, f.categ_code, CASE WHEN f.categ_code = 500 THEN {_FACILITY_CAPACITY}"
        " ELSE CAST(trunc(t.somme_de_capacite_autorisee_totale_) AS BIGINT) END AS capacity FROM facility f"
        f" LEFT JOIN {T.CAPACITIES} c ON {key(qi('et-ndegfiness'))} = f.finess"
        f" LEFT JOIN {T.TOTAL_CAPACITY} t ON {key('etiquettes_de_lignes')} = f.finess",
        "clean_facility": f"{facility} SELECT * FROM facility",
        "clean_keyed": f"{cte(T.OCCUPATION_2022, T.TOTAL_CAPACITY, T.LODGING, *T.DASHBOARDS.values())} "
        + " UNION ALL ".join([
            _keyed("occupation", T.OCCUPATION_2022, "finess", "taux_occ_2022"),
            _keyed("capacity", T.TOTAL_CAPACITY, "etiquettes_de_lignes", "somme_de_capacite_autorisee_totale_"),
            _keyed("lodging", T.LODGING, "finesset", "prixhebpermcs"),
            *[_keyed(f"dashboard_{y}", t, "finess_geographique", "etp_ash") for y, t in T.DASHBOARDS.items()],
        ]),
        "clean_dashboard": f"{cte(T.DASHBOARDS[2022])} {_dashboard(2022)}",
        "filter_in_list": "SELECT p_partkey, p_size FROM part WHERE p_size IN"
        f" ({', '.join(str(c) for c in CATEGORY_CODES)})",
        "complaint_counts": f"{cte(T.COMPLAINTS)},{COMPLAINT} SELECT * FROM complaint",
        "flagged_counts": f"{cte(T.COMPLAINTS)},{FLAGGED} SELECT * FROM flagged",
        "motif_flag_counts": "SELECT source AS finess, "
        + ", ".join(f"{count_if(f'contains(lower(text), {q(n.lower())})')} AS {qi(n)}" for n in DOCUMENT_NEEDLES)
        + " FROM documents GROUP BY source",
        "complaint_profile": f"{cte(T.COMPLAINTS)},{COMPLAINT},{FLAGGED},{MOTIF} SELECT coalesce(complaint.finess,"
        " flagged.finess) AS finess, nb_recla, nb_signa, motif.* EXCLUDE (finess) FROM complaint FULL JOIN flagged"
        " ON flagged.finess = complaint.finess LEFT JOIN motif ON motif.finess = complaint.finess",
        "incident_counts": f"{cte(T.INCIDENTS)},{INCIDENT} SELECT finess, nb_signa, nb_ei, nb_eigs, nb_eias"
        " FROM incident",
        "incident_by_nature": f"{cte(T.INCIDENTS)},{INCIDENT} SELECT finess, nb_events,"
        f" {', '.join(qi(n) for n in INCIDENT_NATURES)} FROM incident",
        "grouped_sum": f"{cte(*_FINANCE_TABLES)},{SUMS} "
        + " UNION ALL ".join(f"SELECT '{t}' AS table_name, finess, CAST(total AS DOUBLE) AS total FROM sum_{t}" for t in _FINANCE_TABLES),
        "grouped_sum_pivot": f"{cte(*_FINANCE_TABLES)},{SUMS} SELECT finess, cadre, "
        + ", ".join(f"CAST(max(CASE WHEN measure = '{m}' THEN total END) AS DOUBLE) AS {m}" for m in _MEASURES)
        + " FROM ("
        + " UNION ALL ".join(
            f"SELECT finess, '{cadre}' AS cadre, '{measure}' AS measure, total FROM sum_{table}"
            for table, cadre, measure, _ in T.FINANCE_SOURCES
        )
        + ") GROUP BY finess, cadre",
        "route_by_class": f"{cte(T.CLASSES, *_FINANCE_TABLES)}, every AS (SELECT {label(qi(T.CLASS_LABEL))} AS finess,"
        f" cadre FROM {T.CLASSES}),{SUMS} {_routed('every', None)}",
        "distinct_missions": f"{cte(T.MISSIONS)},{MISSION} SELECT * FROM mission",
        "inspection_counts": f"{cte(T.MISSIONS)},{MISSION},{INSPECTION} SELECT * FROM inspection",
        "geo_enrich": f"{geo} {_geo('left', '')} UNION ALL {_geo('inner', f'WHERE r.reg IN (1, {REPORT_REGION})')}",
        "hierarchy_fallback": f"{cte(T.COMMUNES)},{COMMUNE} SELECT * FROM commune",
        "star_enrich": f"{cte(T.FACILITIES, T.OCCUPATION_2022, T.LODGING, T.DEPENDENCY)},{FACILITY} SELECT f.finess,"
        " f.rs, o.taux_occ_2022, o.nb_lits_occ_2022, l.prixhebpermcs, d.gmp, d.pmp FROM facility f"
        f" LEFT JOIN {T.OCCUPATION_2022} o ON {key('o.finess')} = f.finess"
        f" LEFT JOIN {T.LODGING} l ON {key('l.finesset')} = f.finess"
        f" LEFT JOIN {T.DEPENDENCY} d ON {key('d.finess_et')} = f.finess",
        "expr_key_join": f"{cte(T.FACILITIES, T.DEPENDENCY)},{FACILITY} SELECT f.finess, f.rs, d.gmp FROM facility f"
        f" LEFT JOIN {T.DEPENDENCY} d ON {key('d.finess_et')} = f.finess",
        "anti_join_when": f"{cte(T.CLASSES, T.CLASS_DUPLICATES)},{CLASS} SELECT * FROM class",
        "attach_signals": f"{cte(T.FACILITIES, T.COMPLAINTS, T.INCIDENTS)},{FACILITY},{COMPLAINT},{FLAGGED},{MOTIF},"
        f"{INCIDENT} SELECT f.finess, f.rs, nb_recla, flagged.nb_signa AS nb_flagged, motif.* EXCLUDE (finess),"
        " incident.nb_signa, nb_ei, nb_eigs, nb_eias FROM facility f"
        + "".join(f" LEFT JOIN {t} ON {t}.finess = f.finess" for t in ("complaint", "flagged", "motif", "incident")),
        "fanout_audit": f"{cte(T.OCCUPATION_2022, T.LODGING)} {_duplicates('occupation', occupation_keys)} UNION ALL"
        f" {_duplicates('lodging', lodging_keys)} UNION ALL {_duplicates('lines', line_keys)}",
        "facility_finance": f"{cte(T.CLASSES, T.CLASS_DUPLICATES, *_FINANCE_TABLES)},{CLASS},{SUMS},{FINANCE}"
        " SELECT * EXCLUDE (cadre) FROM finance",
        "targeting_report": _report(TARGETING, (REPORT_REGION,), ()),
        "control_report": _report(CONTROL, (REPORT_REGION,), ()),
        "targeting_report_complaints": _report(TARGETING, (REPORT_REGION,), (REPORT_REGION,)),
        "control_report_complaints": _report(CONTROL, (REPORT_REGION,), (REPORT_REGION,)),
        "all_regions_report": _report(CONTROL, ALL_REGIONS, COMPLAINT_REGIONS),
        "variant_by_region": _report(TARGETING, ALL_REGIONS, COMPLAINT_REGIONS),
        "sorted_report": f"{facility} SELECT finess AS {qi(LABELS['finess'])}, rs FROM facility",
        "delimited_scan": f"SELECT {_CSV_FIELDS.format(kind='VARCHAR')} AS coeur_dactivite FROM customer",
        "delimited_scan_latin1": f"SELECT {_CSV_FIELDS.format(kind='BIGINT')} AS activite FROM customer",
        "normalise_headers": "SELECT n_nationkey AS ndeg_finessrpps, n_name AS libelle_de_letape,"
        " n_regionkey AS \"coeur_dactivite_-_2022\" FROM nation",
        "folder_tables": _folder_figures(),
        "rejected_lines": f"{cte(*VIEWS)} "
        + " UNION ALL ".join(
            f"SELECT {q(t)} AS table_name, count(*) AS accepted, {2 if t == T.DEPARTMENTS else 0}::BIGINT AS rejected FROM {qi(t)}" for t in VIEWS
        ),
        "concat_sources": "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey,"
        " CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,"
        " CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders",
        "landed_roundtrip": f"{facility} SELECT * FROM facility",
        "label_region": "SELECT s_suppkey, s_nationkey, ncc, nom FROM supplier LEFT JOIN"
        f" (VALUES {_REGION_ROWS}) names(code, ncc, nom) ON names.code = s_nationkey",
        "region_partitioned_export": exported("true"),
        "folder_to_report": exported("true"),
        "published_report": exported("x.region_code <> 4"),
        "numeric_keys": typed_keys,
    }
