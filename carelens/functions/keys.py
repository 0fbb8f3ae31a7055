"""Names, literals, and establishment identifiers in one canonical text form."""

FRACTIONAL = ("float", "double", "decimal")


def ref(name: str) -> str:
    """Column by exact name, whatever characters (``-``, spaces) the name holds."""
    return "`" + name.replace("`", "``") + "`"


def named(expr: str, name: str) -> str:
    return f"{expr} AS {ref(name)}"


def lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Keys are made without CASE, of parts that are always evaluated: what occurs several times in a text is then computed once
# for a row (common subexpressions are not looked for inside the branches of a CASE).


def canonical_key(key: str, kind: str = "string") -> str:
    """Identifier as text.  Keys that passed through a float (``10001234.0``) lose the decimal part."""
    if kind.startswith(FRACTIONAL):
        return f"CAST(try_cast({key} AS BIGINT) AS STRING)"
    if kind != "string":
        return f"CAST({key} AS STRING)"
    return f"left({key}, length({key}) - 2 * CAST(endswith({key}, '.0') AS INT))"


def pad_code(code: str, short: int, fill: str = "0") -> str:
    """Give back the leading zero to codes of exactly ``short`` characters; leave every other text alone."""
    return f"concat(left({lit(fill)}, CAST(length({code}) = {short} AS INT)), {code})"


def establishment_key(key: str, kind: str = "string") -> str:
    """Canonical 9-character establishment number."""
    return pad_code(canonical_key(key, kind), 8)


def never_null(key: str) -> str:
    """A key made from columns known to be present, told to the optimizer as such.

    Joins then ask the scan for the raw column to be present, instead of evaluating the whole key to test it.
    """
    return f"coalesce({key}, '')"


def commune_key(key: str, kind: str = "string") -> str:
    """Canonical 5-character commune code."""
    return pad_code(canonical_key(key, kind), 4)


def prefix_key(label: str, n: int = 9) -> str:
    """Key at the start of a composite label such as ``010001234 - NAME``."""
    return f"substring({label}, 1, {n})"


def suffix_key(label: str, n: int = 9) -> str:
    """Key at the end of a composite label; a text shorter than ``n`` is returned whole."""
    return f"right({label}, {n})"


#: The run of letters and digits that a composite label begins with, and the last one of a label, ``.0`` left out.
_FIRST_RUN = r"^[^0-9A-Za-z]*([0-9A-Za-z]+)"
_LAST_RUN = r"(?<![0-9A-Za-z])([0-9A-Za-z]++)(?:[.]0)?[^0-9A-Za-z]*$"


def _run(label: str, pattern: str) -> str:
    return f"regexp_extract({label}, {lit(pattern)}, 1)"


def label_key(label: str, kind: str = "string") -> str:
    """Key of a composite label, or of a bare identifier that may have lost its zero or gained ``.0``.

    The key is the first run of letters and digits, whatever stands around it, its lost zero given back.
    """
    if kind != "string":
        return establishment_key(label, kind)
    return prefix_key(pad_code(_run(label, _FIRST_RUN), 8))


def closing_key(label: str, kind: str = "string") -> str:
    """Key at the end of a composite label: the last run of letters and digits, its lost zero given back."""
    if kind != "string":
        return establishment_key(label, kind)
    return suffix_key(pad_code(_run(label, _LAST_RUN), 8))


def resolve_incident_key(declarant: str, location: str, declarant_kind: str = "string", location_kind: str = "string") -> str:
    """Establishment an incident belongs to: where it happened, or who declared it if no place is given.

    When both name the same establishment the two branches are equal, so one NULL test decides.  The number is taken out
    of either column first and gets its zero once.
    """
    def number(column: str, kind: str, pattern: str) -> str:
        return _run(column, pattern) if kind == "string" else canonical_key(column, kind)

    taken = (
        f"CASE WHEN {location} IS NULL THEN {number(declarant, declarant_kind, _LAST_RUN)}"
        f" ELSE {number(location, location_kind, _FIRST_RUN)} END"
    )
    whole = pad_code(taken, 8)
    if declarant_kind != "string" and location_kind != "string":
        return whole
    return f"if({location} IS NULL, {suffix_key(whole)}, {prefix_key(whole)})"
