"""Header rules of delimited files: names for blank and repeated headers, and their normal form."""

from collections.abc import Iterable

from pyspark.sql import DataFrame

from carelens.functions.text import normalise_name


def complete_headers(raw: Iterable[str | None]) -> list[str]:
    """Names for every column: a blank header becomes ``Unnamed: i``, a repeated one gets ``.1``, ``.2`` …"""
    names = [f"Unnamed: {i}" if h is None or h == "" else h for i, h in enumerate(raw)]
    taken: set[str] = set()
    repeats: dict[str, int] = {}
    result = []
    for name in names:
        candidate = name
        while candidate in taken:
            repeats[name] = repeats.get(name, 0) + 1
            candidate = f"{name}.{repeats[name]}"
        taken.add(candidate)
        result.append(candidate)
    return result


def normalise_names(names: Iterable[str]) -> list[str]:
    """Normal form of completed headers; two that fall together are told apart by a number."""
    return [n.replace(".", "") for n in complete_headers([normalise_name(n) for n in names])]


def column_names(raw: Iterable[str | None]) -> list[str]:
    return normalise_names(complete_headers(raw))


def normalise_columns(df: DataFrame) -> DataFrame:
    """Rename only; no data is touched."""
    return df.toDF(*normalise_names(df.columns))
