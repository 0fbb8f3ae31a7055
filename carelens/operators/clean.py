"""Filters and cleaning projections."""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from carelens.fixed_values import (
    CATEGORY_CODES,
    DASHBOARD_2022_ONLY,
    DASHBOARD_FTE,
    DASHBOARD_PERSONS,
    DASHBOARD_RATES,
    NO,
    YES,
)
from carelens.functions.dates import parse_dmy
from carelens.functions.keys import commune_key, establishment_key, lit, named, never_null, pad_code, ref
from carelens.functions.numbers import decimal_comma, lenient_int, null_strict_sum, rounded_ratio
from carelens.functions.text import address_line


def is_complaint(key: str, flag: str) -> str:
    """Row of an establishment that is not flagged as an incident report (no flag counts as not flagged)."""
    return f"({key} IS NOT NULL AND ({flag} = {lit(NO)} OR {flag} IS NULL))"


def is_flagged(key: str, flag: str) -> str:
    return f"({key} IS NOT NULL AND {flag} = {lit(YES)})"


def is_incident(complaint_flag: str) -> str:
    """Row explicitly not a complaint; a missing flag does not qualify."""
    return f"{complaint_flag} <> {lit(YES)}"


def date_from(text: str, first: str) -> str:
    """A ``dd/MM/yyyy`` text on or after the day ``first`` (ISO)."""
    return f"{parse_dmy(text)} >= DATE {lit(first)}"


def filter_in_list(df: DataFrame, column: str, codes: Iterable[int]) -> DataFrame:
    return df.where(f"{ref(column)} IN ({', '.join(map(str, codes))})")


def kinds_of(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def clean_facility(register: DataFrame, codes: Iterable[int] = CATEGORY_CODES) -> DataFrame:
    """Register restricted to the reported categories, with canonical identifiers and a one-line address."""
    kinds = kinds_of(register)
    address = address_line(
        "CAST(adresse_num_voie AS STRING)",
        "adresse_comp_voie",
        "adresse_type_voie",
        "adresse_nom_voie",
        "adresse_lieuditbp",
        "adresse_lib_routage",
    )
    postal = lenient_int("adresse_code_postal", kinds["adresse_code_postal"])
    return filter_in_list(register, "categ_code", codes).selectExpr(
        named(establishment_key("finess", kinds["finess"]), "finess"),
        "categ_lib",
        "categ_code",
        "rs",
        named(establishment_key("ej_finess", kinds["ej_finess"]), "ej_finess"),
        "ej_rs",
        "statut_jur_lib",
        named(address, "adresse"),
        named(pad_code(f"CAST({postal} AS STRING)", 4), "adresse_code_postal"),
        named(commune_key("com_code", kinds["com_code"]), "com_code"),
    )


def clean_keyed(
    df: DataFrame, key: str, columns: Mapping[str, str] | None = None, present: bool = False
) -> DataFrame:
    """Canonical establishment key as ``finess`` plus the named expressions (all other columns if none is named).

    With ``present`` rows without a key, which no join can match, are left out.
    """
    kept = [named(e, n) for n, e in columns.items()] if columns else [ref(c) for c in df.columns if c != key]
    finess = establishment_key(ref(key), kinds_of(df)[key])
    if present:
        df, finess = df.where(f"{ref(key)} IS NOT NULL"), never_null(finess)
    return df.selectExpr(named(finess, "finess"), *kept)


def clean_dashboard(df: DataFrame, detail: bool = False, present: bool = False) -> DataFrame:
    """Yearly staffing dashboard: rates, staff total and staff per user; with ``detail`` every staffing column.

    Numbers are computed here, before any join, so a year without detail carries few columns through a shuffle.
    """
    sources = {**DASHBOARD_RATES, **DASHBOARD_FTE, **(DASHBOARD_2022_ONLY if detail else {}), "persons": DASHBOARD_PERSONS}
    kinds = kinds_of(df)
    numbers = {field: decimal_comma(ref(source), kinds[source]) for field, source in sources.items()}
    derived = {
        "fte_total": null_strict_sum(*DASHBOARD_FTE),
        "fte_per_user": rounded_ratio(null_strict_sum(*DASHBOARD_FTE), "persons"),
        "care_fte_per_user": rounded_ratio("(fte_paramedical + fte_medical)", "persons"),
    }
    kept = [*sources, *derived] if detail else [*DASHBOARD_RATES, "fte_total", "fte_per_user"]
    typed = clean_keyed(df, "finess_geographique", numbers, present)
    return typed.selectExpr("finess", *[named(derived[f], f) if f in derived else f for f in kept])
