"""Text cleaning as column expressions (JVM side, no Python in the data path)."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_array(values: Iterable[str]) -> Column:
    """Constant array of strings, parsed in one call instead of one call per value."""
    quoted = (v.replace("\\", "\\\\").replace("'", "\\'") for v in values)
    return F.expr("array(" + ", ".join(f"'{v}'" for v in quoted) + ")")


def trimmed_lower(c: Column) -> Column:
    return F.lower(F.trim(c))


def blank_to_null(c: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    t = F.trim(c)
    return F.when(t != "", t)


def _accent_table() -> tuple[str, str]:
    # Every letter that decomposes to one letter and any marks.
    source, target = [], []
    for code in range(0xC0, sys.maxunicode + 1):
        char = chr(code)
        if not unicodedata.decomposition(char) or unicodedata.category(char)[0] != "L":
            continue
        parts = unicodedata.normalize("NFD", char)
        if parts != char and all(unicodedata.category(c)[0] == "M" for c in parts[1:]):
            source.append(char)
            target.append(parts[0])
    return "".join(source), "".join(target)


_ACCENTED, _PLAIN = _accent_table()


def strip_accents(c: Column) -> Column:
    """Letters without their accents, composed or as marks of their own."""
    return F.regexp_replace(F.translate(c, _ACCENTED, _PLAIN), r"\p{M}+", "")


def collapse_spaces(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+", " ")


def entity_key(name: Column) -> Column:
    """Stable key of a named entity: no accents, lower case, single spaces."""
    return collapse_spaces(F.lower(strip_accents(F.trim(name))))


def canon_label(
    c: Column, mapping: Mapping[str, Iterable[str]], fallback: Column | None = None
) -> Column:
    """Closed mapping canonical -> aliases (lower case); unknown labels fall through.

    The fall-through is the trimmed original unless ``fallback`` says otherwise.
    """
    key = trimmed_lower(c)
    out = None
    for canonical, aliases in mapping.items():
        hit = key.isin(*aliases)
        out = F.when(hit, canonical) if out is None else out.when(hit, canonical)
    return out.otherwise(F.trim(c) if fallback is None else fallback)


def normalize_phone(raw: Column) -> Column:
    """+225 number from 10 local digits or 13 digits starting with 225; NULL otherwise."""
    digits = F.regexp_replace(F.trim(raw), "[^0-9]", "")
    size = F.length(digits)
    return F.when(size == 10, F.concat(F.lit("+225"), digits)).when(
        (size == 13) & digits.startswith("225"), F.concat(F.lit("+"), digits)
    )
