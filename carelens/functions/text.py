"""Text helpers: addresses, wording search, ASCII names."""

import re
import unicodedata
from functools import cache

from carelens.fixed_values import ASCII_SPELLINGS
from carelens.functions.keys import canonical_key, lit

_DROPPED = "[^0-9a-zA-Z_-]"
_SPELT = "[^0-9a-zA-Z_ -]"


def address_line(number: str, *parts: str) -> str:
    """Street number (without the ``.0`` tail of a number that passed through a float) and further parts in one line.

    Every part but the last is followed by a space; a missing part leaves nothing behind.
    """
    lead = canonical_key(number)
    spaced = [f"coalesce(concat({p}, ' '), '')" for p in (lead, *parts[:-1])]
    return f"concat({', '.join(spaced)}, coalesce({parts[-1]}, ''))"


def contains_text(text: str, needle: str) -> str:
    """Case-insensitive literal search: no character of the needle is a wildcard."""
    return contains_lowered(f"lower({text})", needle)


def contains_lowered(lowered: str, needle: str) -> str:
    """The search over a text lowered once for many needles."""
    return f"contains({lowered}, {lit(needle.lower())})"


def ascii_spelling(char: str) -> str:
    """ASCII spelling of one lower-case character; empty when there is none.

    Listed spellings (symbols, ligatures, Greek and Cyrillic letters) come first; of other characters it is what Unicode
    decomposition leaves: accents go, and letters that are left are spelt as listed.
    """
    if char in ASCII_SPELLINGS:
        return ASCII_SPELLINGS[char]
    parts = unicodedata.normalize("NFKD", char)
    return "".join(p if p.isascii() else ASCII_SPELLINGS.get(p, "") for p in parts)


def normalise_name(name: str) -> str:
    """Header → column name: lower case, ASCII, runs of spaces → ``_``, then only ``[0-9a-zA-Z_-]``."""
    ascii_name = "".join(c if c.isascii() else ascii_spelling(c) for c in name.lower())
    return re.sub(_DROPPED, "", re.sub(" +", "_", ascii_name))


@cache
def respelled_letters() -> dict[str, str]:
    """Every lower-case character beyond ASCII that has an ASCII spelling, with what of it a name keeps."""
    found = {c: re.sub(_SPELT, "", ascii_spelling(c)) for c in map(chr, range(0x00A0, 0x30000)) if c == c.lower()}
    return {c: s.lower() for c, s in found.items() if s}


@cache
def _translation() -> tuple[str, str]:
    """All characters that one letter stands for, of whatever script, and those letters."""
    pairs = [(c, s) for c, s in respelled_letters().items() if len(s) == 1 and ord(c) < 0x10000]
    return "".join(c for c, _ in pairs), "".join(s for _, s in pairs)


def slugify(text: str) -> str:
    """The rule of ``normalise_name`` on values.

    Values of ASCII characters are only lowered.  In others, characters with one-letter spellings are translated in one
    pass; of what is then left beyond ASCII, each distinct character of the value is looked up and replaced once, however
    often it occurs.
    """
    source, target = _translation()
    entries = ", ".join(f"{lit(c)}, {lit(s)}" for c, s in respelled_letters().items() if c not in source)
    left = "array_distinct(split(regexp_replace(t, '[\\\\x00-\\\\x7F]+', ''), ''))"
    spelt = f"aggregate({left}, t, (done, c) -> replace(done, c, coalesce(element_at(map({entries}), c), '')))"
    respelt = f"if(octet_length(t) = length(t), t, {spelt})"
    # Lambdas bind the text, so that it is computed once for all its uses.
    translated = f"transform(array(translate(l, {lit(source)}, {lit(target)})), t -> {respelt})[0]"
    ascii_text = f"transform(array(lower({text})), l -> if(octet_length(l) = length(l), l, {translated}))[0]"
    return f"regexp_replace(regexp_replace({ascii_text}, ' +', '_'), '{_DROPPED}', '')"
