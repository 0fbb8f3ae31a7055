"""The targeting and control reports, for one region, several, or all of them in one plan.

One builder serves every report.  ``kind`` says how wide it is: targeting, control, or both at once (the control
report holds every targeting column but one, which is then added under its field id); the variant says where signals
come from: the incident table, or the flagged rows of the complaint table for the regions that report them there.
"""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens import tables as T
from carelens.fixed_values import (
    CLASS_ERRD,
    COMPLAINT_MOTIFS,
    COMPLAINT_VARIANT_REGIONS,
    DASHBOARD_2022_ONLY,
    DASHBOARD_FTE,
    DASHBOARD_RATES,
    INCIDENT_NATURES,
    LABELS,
    REPORTED_MOTIFS,
    SUMMED_CAPACITY_CATEGORY,
)
from carelens.functions.keys import label_key, lit, named, never_null, ref
from carelens.functions.numbers import (
    capacity_by_category,
    complaint_rate,
    decimal_comma,
    lenient_int,
    mean_present,
    null_to_zero,
)
from carelens.operators.aggregates import (
    MEASURES,
    aggregate,
    complaint_profile,
    finance_by_establishment,
    incident_profile,
    inspection_counts,
    route_by_class,
)
from carelens.operators.clean import clean_dashboard, clean_facility, clean_keyed, kinds_of
from carelens.operators.joins import anti_join_when, geo_enrich
from carelens.operators.skew import enrich_by_key, repeat_rows, with_row_id

TARGETING, CONTROL, BOTH = "targeting", "control", "both"
INCIDENTS, COMPLAINTS = "incidents", "complaints"

Tables = Mapping[str, DataFrame]

# Tables whose rows are joined key by key (facts are aggregated first and cannot be skewed here).
_KEYED_TABLES = (
    T.FACILITIES, T.CAPACITIES, T.TOTAL_CAPACITY, T.OCCUPATION_2020, T.OCCUPATION_2021, T.OCCUPATION_2022, T.LODGING,
    T.DEPENDENCY, T.INDICATORS, T.CLASSES,
    *T.DASHBOARDS.values(),
)

# Fields of a report, by where they appear: in control reports only, or in one variant only.
_CONTROL_ONLY = {
    "occupancy_2020", "occupancy_2021", "occupancy_2022", "occupancy_q3", "day_price", "gir_1", "gir_2", "gir_3",
    *DASHBOARD_FTE, *DASHBOARD_2022_ONLY, "events", *[f"nature_{i + 1}" for i in range(len(INCIDENT_NATURES))],
} - {"places_installed", "vacancy_care", "vacancy_education", "fte_coordinator"}
_INCIDENTS_ONLY = {
    "events", "serious_events", "care_events", "all_events",
    *[f"nature_{i + 1}" for i in range(len(INCIDENT_NATURES))],
}
_COMPLAINTS_ONLY = {"flagged"}


# The one figure on which the two reports may differ: targeting rounds it to four digits in the complaints variant.
_EXTERNAL_TARGETING = "external_mean_targeting"


def report_fields(kind: str, variant: str | None = None) -> list[str]:
    """Field ids of a report in report order; without a variant, the fields of both."""
    dropped = _CONTROL_ONLY if kind == TARGETING else set()
    if variant == INCIDENTS:
        dropped = dropped | _COMPLAINTS_ONLY
    elif variant == COMPLAINTS:
        dropped = dropped | _INCIDENTS_ONLY
    return [f for f in LABELS if f not in dropped]


def facility_finance(tables: Tables) -> DataFrame:
    """Finance measures per establishment, from the class it reports under once duplicates are settled.

    Equal class rows travel as one row with a count and are multiplied again after the joins.
    """
    labelled = tables[T.CLASSES].where(f"{ref(T.CLASS_LABEL)} IS NOT NULL")
    classes = labelled.selectExpr(named(never_null(label_key(ref(T.CLASS_LABEL))), "finess"), "cadre")
    counted = aggregate(classes, ["finess", "cadre"], {"n": "count(1)"})
    listed = tables[T.CLASS_DUPLICATES].where("finess IS NOT NULL")
    listed = listed.selectExpr(named(never_null(label_key("finess")), "finess"))
    # The count in the condition keeps the optimizer from joining before the rows are counted together.
    kept = anti_join_when(counted, listed, "finess", f"n > 0 AND cadre <> {lit(CLASS_ERRD)}")
    routed = route_by_class(kept, finance_by_establishment(tables), keep=["n"])
    copies = repeat_rows(routed, "n", ["finess", "cadre"])
    return copies.selectExpr("finess", *[f"CAST(round({m}) AS DOUBLE) AS {m}" for m in MEASURES], "__row")


def _dashboard(tables: Tables, year: int, kind: str) -> DataFrame:
    wide = clean_dashboard(tables[T.DASHBOARDS[year]], detail=year == 2022, present=True)
    unused = _CONTROL_ONLY - {*DASHBOARD_FTE} if kind == TARGETING else set()
    kept = [c for c in wide.columns if c != "finess" and c not in unused]
    return wide.selectExpr("finess", *[f"{c} AS y{year}_{c}" for c in kept])


def _source_sides(tables: Tables, kind: str) -> dict[str, DataFrame]:
    """Frames joined to the register as they are: one row per source row, so a repeated key repeats the report row."""
    kinds = {t: kinds_of(tables[t]) for t in (T.CAPACITIES, T.TOTAL_CAPACITY, T.INDICATORS)}
    capacities = {
        "capacity_hp": "total_heberg_comp_inter_places_autorisees",
        "capacity_aj": "total_accueil_de_jour_places_autorisees",
        "capacity_ht": "total_accueil_de_nuit_places_autorisees",
    }
    rates = {"many_drugs": "taux_plus_10_medics_cip13", "mco_rate": "taux_hospit_mco", "had_rate": "taux_hospit_had"}
    total = "somme_de_capacite_autorisee_totale_"
    occupation = {"residents": "nb_lits_occ_2022"}
    if kind != TARGETING:
        occupation |= {"occupancy_2022": "taux_occ_2022", "occupancy_q3": "taux_occ_trimestre3"}

    def keyed(table: str, key: str, columns: Mapping[str, str]) -> DataFrame:
        return clean_keyed(tables[table], key, columns, present=True)

    sides = {
        "capacities": keyed(
            T.CAPACITIES,
            "et-ndegfiness",
            {field: lenient_int(c, kinds[T.CAPACITIES][c]) for field, c in capacities.items()},
        ),
        "total_capacity": keyed(
            T.TOTAL_CAPACITY,
            "etiquettes_de_lignes",
            {"capacity_total": decimal_comma(total, kinds[T.TOTAL_CAPACITY][total])},
        ),
        "occupation_2022": keyed(T.OCCUPATION_2022, "finess", occupation),
        "dependency": keyed(T.DEPENDENCY, "finess_et", {"gmp": "round(gmp)", "pmp": "round(pmp)"}),
        "indicators": keyed(
            T.INDICATORS,
            "et_finess",
            {field: decimal_comma(c, kinds[T.INDICATORS][c]) for field, c in rates.items()},
        ),
        **{f"dashboard_{year}": _dashboard(tables, year, kind) for year in T.DASHBOARDS},
        "finance": facility_finance(tables),
    }
    if kind != TARGETING:
        sides |= {
            "occupation_2020": keyed(T.OCCUPATION_2020, "finess_19", {"occupancy_2020": "taux_occ_2020"}),
            "occupation_2021": keyed(T.OCCUPATION_2021, "finess", {"occupancy_2021": "taux_occ_2021"}),
            "lodging": keyed(T.LODGING, "finesset", {"day_price": "prixhebpermcs"}),
        }
    return sides


def _aggregate_sides(tables: Tables, kind: str, variants: set[str]) -> dict[str, DataFrame]:
    """Facts reduced to one row per establishment, each from one pass over its table."""
    motifs = COMPLAINT_MOTIFS[:REPORTED_MOTIFS]
    sides = {
        "complaints": complaint_profile(tables[T.COMPLAINTS], motifs).selectExpr(
            "finess",
            "nb_recla",
            "nb_signa AS flagged",
            *[f"{ref(m)} AS motif_{i + 1}" for i, m in enumerate(motifs)],
        ),
        "inspections": inspection_counts(tables[T.MISSIONS]),
    }
    if INCIDENTS in variants:
        natures = INCIDENT_NATURES if kind != TARGETING else ()
        sides["incidents"] = incident_profile(tables[T.INCIDENTS], natures, placed=True).selectExpr(
            "finess",
            "nb_ei AS events",
            "nb_eigs AS serious_events",
            "nb_eias AS care_events",
            "nb_events AS all_events",
            *[f"{ref(n)} AS nature_{i + 1}" for i, n in enumerate(natures)],
        )
    return sides


def _values(kind: str, variants: set[str], in_complaints_variant: str) -> dict[str, str]:
    """Expression of every field that is not simply a column of the same name."""
    years = {2019: "y2020", 2020: "y2021", 2021: "y2022"}  # a label names the year before its campaign
    values = {
        "region": "region_name",
        "commune": "commune_name",
        "category": "categ_lib",
        "name": "rs",
        "legal_finess": "ej_finess",
        "legal_name": "ej_rs",
        "legal_status": "statut_jur_lib",
        "address": "adresse",
        "postal_code": "adresse_code_postal",
        "commune_code": "com_code",
        "capacity": capacity_by_category(
            "categ_code",
            ["capacity_hp", "capacity_aj", "capacity_ht"],
            lenient_int("capacity_total", "double"),
            SUMMED_CAPACITY_CATEGORY,
        ),
        "emergency_rate": "''",
        "dashboard_entry": "''",
        "complaints": null_to_zero("nb_recla"),
        "complaint_rate": complaint_rate("nb_recla", "capacity_total"),
    }
    for rate in DASHBOARD_RATES:
        by_year = {label: f"{prefix}_{rate}" for label, prefix in years.items()}
        values |= {f"{rate}_{label}": column for label, column in by_year.items()}
        values[f"{rate}_mean"] = f"round({mean_present(*by_year.values())}, 2)"
    finer = f"round({mean_present(*[f'{prefix}_external' for prefix in years.values()])}, 4)"
    values[_EXTERNAL_TARGETING] = f"CASE WHEN {in_complaints_variant} THEN {finer} ELSE {values['external_mean']} END"
    if kind == TARGETING:
        values["external_mean"] = values.pop(_EXTERNAL_TARGETING)
    per_user = {label: f"{prefix}_fte_per_user" for label, prefix in years.items()}
    values |= {f"fte_per_user_{label}": column for label, column in per_user.items()}
    values["fte_per_user_mean"] = mean_present(*per_user.values())
    for field in ("care_fte_per_user", *DASHBOARD_FTE, *DASHBOARD_2022_ONLY):
        values[field] = f"y2022_{field}"
    for field in ("fte_total", "fte_coordinator"):
        values[field] = f"round(y2022_{field}, 2)"
    counted = [f"motif_{i + 1}" for i in range(REPORTED_MOTIFS)]
    counted += ["inspections_done", "inspections_on_site", "inspections_on_file", "inspections_planned"]
    values |= {field: null_to_zero(field) for field in (*counted, *_INCIDENTS_ONLY, *_COMPLAINTS_ONLY)}
    if len(variants) > 1:
        for fields, shown in (
            (_INCIDENTS_ONLY, f"NOT ({in_complaints_variant})"),
            (_COMPLAINTS_ONLY, in_complaints_variant),
        ):
            values |= {field: f"CASE WHEN {shown} THEN {values[field]} END" for field in fields}
    return values


def build_report(
    tables: Tables,
    kind: str,
    region_codes: Iterable[int] | DataFrame,
    complaint_regions: Iterable[int],
    skew_check: str = "auto",
) -> DataFrame:
    """Report rows of the given regions, unsorted, with ``region_code`` ahead of the labelled columns.

    ``complaint_regions`` take the complaints variant.  When the regions span both variants the columns of both are
    present and hold NULL where they do not apply.  Regions may be a frame with a column ``code``, such as the configured
    ones: which they are is then not known before the job runs, so the columns of both variants are present.
    """
    special = set(complaint_regions)
    if isinstance(region_codes, DataFrame):
        codes, variants = region_codes, {COMPLAINTS, INCIDENTS}
    else:
        codes = sorted(set(region_codes))
        variants = {COMPLAINTS if c in special else INCIDENTS for c in codes}
    facilities = geo_enrich(
        with_row_id(clean_facility(tables[T.FACILITIES])),
        tables[T.COMMUNES],
        tables[T.DEPARTMENTS],
        tables[T.REGIONS_TABLE],
        codes=codes,
    )
    wide = enrich_by_key(
        facilities,
        _source_sides(tables, kind),
        _aggregate_sides(tables, kind, variants),
        "finess",
        [tables[t] for t in _KEYED_TABLES],
        skew_check,
    )
    values = _values(kind, variants, f"region_code IN ({', '.join(map(str, sorted(special))) or 'NULL'})")
    fields = report_fields(kind, variants.pop() if len(variants) == 1 else None)
    shown = [named(values.get(f, f), LABELS[f]) for f in fields]
    if kind == BOTH:
        shown.append(named(values[_EXTERNAL_TARGETING], _EXTERNAL_TARGETING))
    return wide.selectExpr("region_code", *shown)


def sheet(both: DataFrame, kind: str) -> DataFrame:
    """One of the two reports out of rows built for both; columns beside the report's own are kept."""
    label = LABELS["external_mean"]
    dropped = {LABELS[f] for f in _CONTROL_ONLY} if kind == TARGETING else set()
    taken = _EXTERNAL_TARGETING if kind == TARGETING else label
    kept = [c for c in both.columns if c not in dropped and c != _EXTERNAL_TARGETING]
    return both.selectExpr(*[named(ref(taken if c == label else c), c) for c in kept])


def sorted_report(report: DataFrame) -> DataFrame:
    """Report in establishment order.

    The row hash orders rows of one establishment among themselves and lets the sort split them over tasks.
    """
    rest = ", ".join(ref(c) for c in report.columns if c != LABELS["finess"])
    return report.orderBy(F.col(ref(LABELS["finess"])), F.expr(f"xxhash64({rest})"))


def variant_of(region: int, complaint_regions: Iterable[int] = COMPLAINT_VARIANT_REGIONS) -> str:
    return COMPLAINTS if region in set(complaint_regions) else INCIDENTS


def _one_region(tables: Tables, kind: str, region: int, variant: str | None, skew_check: str) -> DataFrame:
    variant = variant or variant_of(region)
    special = (region,) if variant == COMPLAINTS else ()
    return sorted_report(build_report(tables, kind, [region], special, skew_check).drop("region_code"))


def targeting_report(tables: Tables, region: int, variant: str | None = None, skew_check: str = "auto") -> DataFrame:
    """Targeting report of one region, in establishment order; the variant follows from the region if not given."""
    return _one_region(tables, TARGETING, region, variant, skew_check)


def control_report(tables: Tables, region: int, variant: str | None = None, skew_check: str = "auto") -> DataFrame:
    """Control report of one region, in establishment order; the variant follows from the region if not given."""
    return _one_region(tables, CONTROL, region, variant, skew_check)


def all_regions_report(
    tables: Tables,
    kind: str,
    region_codes: Iterable[int] | DataFrame,
    complaint_regions: Iterable[int] = COMPLAINT_VARIANT_REGIONS,
    skew_check: str = "auto",
) -> DataFrame:
    """Every configured region in one plan: each source is read, aggregated and joined once.

    With kind ``both`` that holds for the two reports together; ``sheet`` takes each out.  ``region_codes`` may be the
    frame of configured regions itself.
    """
    return build_report(tables, kind, region_codes, complaint_regions, skew_check)


def region_layout(report: DataFrame, kind: str, variant: str) -> DataFrame:
    """The columns one region's report has, out of a report spanning both variants."""
    return report.select(*[ref(LABELS[f]) for f in report_fields(kind, variant)])
