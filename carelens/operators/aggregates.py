"""Aggregates per establishment.

Each fact table is read once: everything counted on it is one conditional sum of a single ``groupBy``, so partial
aggregation runs before the only shuffle and a key holding most of the rows costs no more than any other.
"""

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.fixed_values import (
    CLASS_CA_PA,
    CLASS_CA_PH,
    CLASS_ERRD,
    COMPLAINT_MOTIFS,
    FAMILY_CARE,
    FAMILY_EVENT,
    INCIDENT_NATURES,
    INSPECTIONS_CUTOFF,
    INSPECTIONS_FROM,
    MODE_ON_FILE,
    MODE_ON_SITE,
    NO,
    YES,
)
from carelens.functions.dates import parse_dmy
from carelens.functions.keys import establishment_key, label_key, lit, named, never_null, ref, resolve_incident_key
from carelens.functions.text import contains_lowered
from carelens.operators.clean import date_from, is_complaint, is_flagged, is_incident, kinds_of
from carelens.tables import FINANCE_LABEL, FINANCE_SOURCES

MEASURES = ("charges", "tariff_income", "account70_income", "total_income")


def count_where(condition: str) -> str:
    """Number of rows meeting a condition; 0 when a group has none."""
    return f"count(1) FILTER (WHERE {condition})"


def aggregate(rows: DataFrame, keys: Sequence[str], figures: Mapping[str, str]) -> DataFrame:
    """``GROUP BY`` with the figures given as expression texts."""
    return rows.groupBy(*keys).agg(*[F.expr(named(expr, name)) for name, expr in figures.items()])


def complaint_counts(complaints: DataFrame, key: str = "ndeg_finessrpps", flag: str = "signalement") -> DataFrame:
    finess = establishment_key(ref(key), kinds_of(complaints)[key])
    rows = complaints.where(is_complaint(ref(key), ref(flag))).selectExpr(named(finess, "finess"))
    return aggregate(rows, ["finess"], {"nb_recla": "count(1)"})


def flagged_counts(complaints: DataFrame, key: str = "ndeg_finessrpps", flag: str = "signalement") -> DataFrame:
    finess = establishment_key(ref(key), kinds_of(complaints)[key])
    rows = complaints.where(is_flagged(ref(key), ref(flag))).selectExpr(named(finess, "finess"))
    return aggregate(rows, ["finess"], {"nb_signa": "count(1)"})


def motif_flag_counts(rows: DataFrame, key: str, text: str, needles: Iterable[str]) -> DataFrame:
    """Per key, how many texts contain each needle (one output column per needle)."""
    searched = rows.selectExpr(named(key, "finess"), f"lower({text}) AS text")
    return aggregate(searched, ["finess"], {n: count_where(contains_lowered("text", n)) for n in needles})


def complaint_profile(
    complaints: DataFrame,
    motifs: Iterable[str] = COMPLAINT_MOTIFS,
    key: str = "ndeg_finessrpps",
    flag: str = "signalement",
    text: str = "motifs_igas",
) -> DataFrame:
    """Complaint count, motif counts and flagged count per establishment from one scan and one shuffle.

    A figure is NULL where the establishment has no row of its kind, as if each had been counted and joined alone.
    """
    counted, flagged = is_complaint(ref(key), ref(flag)), is_flagged(ref(key), ref(flag))
    rows = complaints.where(f"{counted} OR {flagged}").selectExpr(
        named(never_null(establishment_key(ref(key), kinds_of(complaints)[key])), "finess"), named(counted, "counted"), f"lower({ref(text)}) AS text"
    )
    figures = {
        "nb_recla": "sum(CASE WHEN counted THEN 1 END)",
        "nb_signa": "sum(CASE WHEN NOT counted THEN 1 END)",
    }
    for motif in motifs:
        found = contains_lowered("text", motif)
        figures[motif] = f"sum(CASE WHEN counted THEN CASE WHEN {found} THEN 1 ELSE 0 END END)"
    return aggregate(rows, ["finess"], figures)


def select_incidents(incidents: DataFrame, placed: bool = False) -> DataFrame:
    """Incidents (complaints left out) under the establishment they belong to, with the three event kinds marked.

    With ``placed`` those naming no establishment are left out too.
    """
    declarant, location = "declarant_organismendeg_finess", "survenue_du_cas_en_collectivitendeg_finess"
    kinds = kinds_of(incidents)
    key = resolve_incident_key(declarant, location, kinds[declarant], kinds[location])
    rows = incidents.where(is_incident("reclamation"))
    if placed:
        rows, key = rows.where(f"{declarant} IS NOT NULL OR {location} IS NOT NULL"), never_null(key)
    return rows.selectExpr(
        named(key, "finess"),
        f"(famille_principale = {lit(FAMILY_EVENT)} AND ceci_est_un_eigs = {lit(NO)}) AS is_event",
        f"(ceci_est_un_eigs = {lit(YES)}) AS is_serious",
        f"(famille_principale = {lit(FAMILY_CARE)} AND ceci_est_un_eigs = {lit(NO)}) AS is_care",
        "nature_principale AS nature",
    )


def incident_profile(
    incidents: DataFrame, natures: Iterable[str] = INCIDENT_NATURES, placed: bool = False
) -> DataFrame:
    """Incident counts per establishment, in total, by kind, and by nature among the three kinds.

    The kinds exclude each other, so the sum over kinds is the count of rows of any kind.
    """
    any_kind, natures = "(is_event OR is_serious OR is_care)", list(natures)
    # Natures are numbered once for a row: a comparison of texts in every figure made more code than the JVM compiles.
    numbers = " ".join(f"WHEN {lit(n)} THEN {i}" for i, n in enumerate(natures))
    place = {n: natures.index(n) for n in natures}
    rows = select_incidents(incidents, placed).selectExpr(
        "finess", "is_event", "is_serious", "is_care", f"{f'CASE nature {numbers} END' if natures else 'CAST(NULL AS INT)'} AS nature"
    )
    figures = {
        "nb_signa": "count(1)",
        "nb_ei": count_where("is_event"),
        "nb_eigs": count_where("is_serious"),
        "nb_eias": count_where("is_care"),
        "nb_events": count_where(any_kind),
        **{n: count_where(f"{any_kind} AND nature = {i}") for n, i in place.items()},
    }
    return aggregate(rows, ["finess"], figures)


def incident_counts(incidents: DataFrame) -> DataFrame:
    return incident_profile(incidents, ()).drop("nb_events")


def incident_by_nature(incidents: DataFrame, natures: Sequence[str] = INCIDENT_NATURES) -> DataFrame:
    return incident_profile(incidents, natures).select("finess", "nb_events", *[ref(n) for n in natures])


def grouped_sum(rows: DataFrame, label: str, value: str, alias: str = "total", per: Sequence[str] = ()) -> DataFrame:
    """Sum per establishment of a table keyed by a composite label, for each value of the columns ``per``.

    Many tables are best summed as one, with their names in a column: sums of each, appended, are dealt alike, and Spark
    then reads the same part of all of them in one task.
    """
    finess = named(label_key(ref(label), kinds_of(rows)[label]), "finess")
    keyed = rows.selectExpr(*map(ref, per), finess, named(ref(value), "value"))
    return aggregate(keyed, [*map(ref, per), "finess"], {alias: "sum(value)"})


def _finance_rows(tables: Mapping[str, DataFrame], labelled: bool = False) -> DataFrame:
    """All finance tables as one long frame: establishment, class, measure, value; ``labelled`` rows only, or all."""
    label = ref(FINANCE_LABEL)

    def key(table: str) -> str:
        found = label_key(label, kinds_of(tables[table])[FINANCE_LABEL])
        return never_null(found) if labelled else found

    parts = [
        tables[table].where(f"{label} IS NOT NULL" if labelled else "true").selectExpr(
            named(key(table), "finess"),
            f"{lit(cadre)} AS cadre",
            f"{lit(measure)} AS measure",
            f"{ref(value)} AS value",
        )
        for table, cadre, measure, value in FINANCE_SOURCES
    ]
    return reduce(DataFrame.unionByName, parts)


def grouped_sum_pivot(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The four measures per establishment and class."""
    sums = {m: f"sum(CASE WHEN measure = {lit(m)} THEN value END)" for m in MEASURES}
    return aggregate(_finance_rows(tables), ["finess", "cadre"], sums)


def _slot(cadre: str, measure: str) -> str:
    return f"{cadre}|{measure}"


def finance_by_establishment(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every class and measure side by side, one row per establishment.

    Grouping on the establishment alone leaves the result partitioned the way the later joins need it.
    """
    sums = {
        _slot(cadre, measure): f"sum(CASE WHEN cadre = {lit(cadre)} AND measure = {lit(measure)} THEN value END)"
        for _, cadre, measure, _ in FINANCE_SOURCES
    }
    return aggregate(_finance_rows(tables, labelled=True), ["finess"], sums)


def route_by_class(classes: DataFrame, finance: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The measures of the class each establishment reports under.

    One class has no account-70 and no total income and gets 0 there; an unknown or missing class gets NULL.
    """
    present = {(cadre, measure) for _, cadre, measure, _ in FINANCE_SOURCES}

    def chosen(measure: str) -> str:
        branches = " ".join(
            f"WHEN cadre = {lit(cadre)} THEN {ref(_slot(cadre, measure)) if (cadre, measure) in present else 0}"
            for cadre in (CLASS_ERRD, CLASS_CA_PA, CLASS_CA_PH)
        )
        return f"CASE {branches} END AS {measure}"

    return classes.join(finance, "finess", "left").selectExpr("finess", "cadre", *keep, *[chosen(m) for m in MEASURES])


def distinct_missions(missions: DataFrame, first: str = INSPECTIONS_FROM) -> DataFrame:
    """Missions with a real visit on or after ``first``, each kept once."""
    kept = missions.where(f"code_finess IS NOT NULL AND {date_from('date_reelle_visite', first)}").selectExpr(
        named(never_null(establishment_key("code_finess", kinds_of(missions)["code_finess"])), "finess"),
        "identifiant_de_la_mission",
        "date_provisoire_visite",
        "date_reelle_visite",
        "modalite_dinvestigation AS mode",
    )
    return kept.distinct()


def inspection_counts(
    missions: DataFrame, first: str = INSPECTIONS_FROM, cutoff: str = INSPECTIONS_CUTOFF
) -> DataFrame:
    """Inspections done by the cutoff (all, on site, on file) and those planned after it, per establishment."""
    dated = distinct_missions(missions, first).selectExpr(
        "finess",
        "mode",
        f"{parse_dmy('date_reelle_visite')} <= DATE {lit(cutoff)} AS done",
        f"{parse_dmy('date_provisoire_visite')} > DATE {lit(cutoff)} AS planned",
    )
    figures = {
        "inspections_done": count_where("done"),
        "inspections_on_site": count_where(f"done AND mode = {lit(MODE_ON_SITE)}"),
        "inspections_on_file": count_where(f"done AND mode = {lit(MODE_ON_FILE)}"),
        "inspections_planned": count_where("NOT done AND planned"),
    }
    return aggregate(dated, ["finess"], figures)
