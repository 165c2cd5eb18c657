"""Text, JSON and array helpers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# From the start on, item by item: brackets that open or are empty; a whole string, or a number, true, false, null; brackets
# that close; and the comma after it.
_ITEM_AND_COMMA = r'\G([\[\]]*+(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^",\[\]]++)?+\]*+),'


def json_array(col: Column) -> Column:
    """An array, of arrays to any depth too, as JSON text: items parted by ', ', null items and non-ASCII text kept."""
    return F.regexp_replace(F.to_json(col), _ITEM_AND_COMMA, "$1, ")


def json_first(col: Column) -> Column:
    """First item of a JSON array, as text."""
    return F.get_json_object(col, "$[0]")


def prefix_before(col: Column, separator: str) -> Column:
    """Text before the separator; '' where there is none."""
    return F.substring(col, F.lit(1), F.instr(col, separator) - F.lit(1))


def contains_pattern(col: Column, pattern: str) -> Column:
    """Regex search without regard to case, Cyrillic letters included."""
    return col.rlike("(?iu)" + pattern)


def strip_leading_word(col: Column, words: Sequence[str]) -> Column:
    """Drop the first of ``words`` that the text starts with."""
    return F.regexp_replace(col, "^(?:" + "|".join(re.escape(w) for w in words) + ") ", "")


def last_token(col: Column, fallback: Column) -> Column:
    """Last whitespace-separated token, or the fallback for missing or blank text."""
    token = F.element_at(F.split(F.trim(col), r"\s+"), -1)
    return F.coalesce(F.when(token != "", token), fallback)


def path_text(names: Column, separator: str = " / ") -> Column:
    return F.array_join(names, separator)


def by_key(key: Column, table: dict[object, object]) -> Column:
    """Small lookup table; NULL for an unknown key."""
    expr = None
    for k, v in table.items():
        expr = (F.when if expr is None else expr.when)(key == F.lit(k), F.lit(v))
    return expr


# Latin stand-ins for Cyrillic letters; letters beyond the end of the second row are dropped.
_CYRILLIC = "абвгдеёжзийклмнопрстуфхцчшщыэюяьъ"
_LATIN = "abvgdeejziyklmnoprstufhccssyeuy"


def latin_word(word: str) -> str:
    """Transliteration of a pool word."""
    letters = {c: _LATIN[i] if i < len(_LATIN) else "" for i, c in enumerate(_CYRILLIC)}
    return "".join(letters.get(c, c) for c in word.lower())
