"""String helpers: null-safe positional access, splitting and blanking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from transitlake.functions._col import as_col


def piece(arr, i: int) -> Column:
    """0-based array element, NULL when out of range (ANSI-safe)."""
    return F.get(as_col(arr), i)


def split_fields(c, sep: str, limit: int = -1) -> Column:
    """Split on a literal one-character separator; keeps trailing empties."""
    return F.split(as_col(c), _literal_regex(sep), limit)


def after_first(c, sep: str) -> Column:
    """Text after the first ``sep``; NULL when ``sep`` does not occur."""
    c = as_col(c)
    at = F.instr(c, F.lit(sep))
    return F.when(at > 0, F.substr(c, at + len(sep)))


def blank_to_null(c) -> Column:
    """Exactly-empty text -> NULL; whitespace-only text is kept."""
    c = as_col(c)
    return F.nullif(c, F.lit(""))


def _literal_regex(sep: str) -> str:
    # split() takes a regex.  A character that stands for itself, bare or
    # behind one backslash, is split on without a regex engine.
    return "".join("\\" + ch if not ch.isalnum() and ch in ".$|()[{^?*+\\" else ch for ch in sep)
