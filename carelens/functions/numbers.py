"""Numbers as they come in regulatory files: decimal commas, junk text, missing terms, zero denominators."""

_NUMBER = r"r'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'"
_LEADING_INT = r"r'^\s*([+-]?[0-9]+)'"
_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def lenient_int(value: str, kind: str = "string") -> str:
    """Whole number at the start of a text (``12.7`` → 12); text without one → NULL."""
    if kind.startswith(_NUMERIC):
        return f"try_cast({value} AS BIGINT)"
    return f"try_cast(regexp_extract({value}, {_LEADING_INT}, 1) AS BIGINT)"


def decimal_comma(value: str, kind: str = "string", to: str = "double") -> str:
    """Number written with ``,`` or ``.``; junk → NULL.  A value that is numeric already is only cast."""
    if kind.startswith(_NUMERIC):
        return value if kind == to else f"try_cast({value} AS {to})"
    text = f"replace(trim({value}), ',', '.')"
    return f"CASE WHEN {text} RLIKE {_NUMBER} THEN try_cast({text} AS {to}) END"


def safe_ratio(numerator: str, denominator: str) -> str:
    """True division; NULL when the denominator is zero or either side is NULL."""
    return f"try_divide(CAST({numerator} AS DOUBLE), CAST({denominator} AS DOUBLE))"


def rounded_ratio(numerator: str, denominator: str, digits: int = 2) -> str:
    return f"round({safe_ratio(numerator, denominator)}, {digits})"


def null_to_zero(value: str) -> str:
    return f"coalesce({value}, 0)"


def mean_present(*numbers: str) -> str:
    """Mean of the numbers that are present; NULL when none is."""
    total = " + ".join(f"coalesce({n}, 0D)" for n in numbers)
    present = " + ".join(f"CAST({n} IS NOT NULL AS INT)" for n in numbers)
    return f"try_divide({total}, CAST({present} AS DOUBLE))"


def mean_ignore_null(*texts: str) -> str:
    """Mean of the values that are present, decimal commas accepted; NULL when none is."""
    return mean_present(*[decimal_comma(t) for t in texts])


def null_strict_sum(*numbers: str) -> str:
    """Sum that is NULL as soon as one term is."""
    return "(" + " + ".join(numbers) + ")"


def complaint_rate(complaints: str, capacity: str) -> str:
    """Complaints per place, in percent with two digits; 0 when it cannot be computed."""
    return f"coalesce({rounded_ratio(complaints, capacity, 4)} * 100, 0D)"


def capacity_by_category(category: str, parts: list[str], total: str, summed_category: int) -> str:
    """Authorised capacity: the sum of the parts for one category, the registered total for all others.

    Parts and total are whole numbers already.
    """
    summed = " + ".join(null_to_zero(p) for p in parts)
    return f"CASE WHEN {category} = {summed_category} THEN {summed} ELSE {total} END"
