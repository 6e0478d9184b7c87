"""Wall-clock parsing that is strict, zone-free and never raises.

Transit files stamp local wall-clock times.  Parsing them as
``TIMESTAMP`` ties the value to the session time zone, and a clock time
that falls into a daylight-saving gap gets moved by an hour.  These
helpers build ``TIMESTAMP_NTZ`` values instead, from fixed-width date
patterns: a regex guards the whole text (so ``6:00``, ``24:00`` or trailing
junk give NULL), its fields are put in ISO order, and one ``try_cast`` reads
them and rejects impossible dates such as 31/02.  The guard matters for speed
too: a ``try_cast`` that fails raises and catches inside, at some 50 us a row,
so none may see the texts that are usually malformed.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from transitlake.functions._col import as_col

_FIELDS = {
    "yyyy": r"[0-9]{4}",
    "MM": r"0[1-9]|1[0-2]",
    "dd": r"0[1-9]|[12][0-9]|3[01]",
    "HH": r"[01][0-9]|2[0-3]",
    "mm": r"[0-5][0-9]",
    "ss": r"[0-5][0-9]",
}
_TOKEN = re.compile("|".join(sorted(_FIELDS, key=len, reverse=True)))


def _layout(pattern: str) -> tuple[str, dict[str, tuple[int, int]]]:
    """Regex for the whole text, and the 1-based (pos, len) of each field.

    ``[...]`` marks an optional section at the end, so that no field moves.
    """
    rx, fields, pos, i = [], {}, 1, 0
    while i < len(pattern):
        m = _TOKEN.match(pattern, i)
        ch = pattern[i]
        if m:
            fields[m.group(0)] = (pos, len(m.group(0)))
            rx.append(f"(?:{_FIELDS[m.group(0)]})")
            pos += len(m.group(0))
            i = m.end()
            continue
        if ch == "]" and i != len(pattern) - 1:
            raise ValueError(f"an optional section may only end a pattern: {pattern!r}")
        if ch in "[]":
            rx.append({"[": "(?:", "]": ")?"}[ch])
        else:
            rx.append(ch if ch.isalnum() else f"[{ch}]")
            pos += 1
        i += 1
    return "^" + "".join(rx) + r"\z", fields


def _parsed(c: Column, pattern: str, type_name: str) -> Column:
    rx, fields = _layout(pattern)

    def field(tok: str, default: str) -> Column:
        return F.substring(c, *fields[tok]) if tok in fields else F.lit(default)

    text = [field("yyyy", "1970"), F.lit("-"), field("MM", "01"), F.lit("-"), field("dd", "01")]
    if type_name != "date":
        text.append(F.lit(" "))
        if re.search(r"HH:mm(\[?:ss\]?)?$", pattern):
            # in ISO order already, with or without seconds
            text.append(F.substring(c, fields["HH"][0], 8))
        else:
            text += [field("HH", "00"), F.lit(":"), field("mm", "00"), F.lit(":"), field("ss", "00")]
    return F.when(c.rlike(rx), F.concat(*text).try_cast(type_name))


def parse_wallclock(c, pattern: str = "yyyyMMddHHmmss") -> Column:
    """Text -> TIMESTAMP_NTZ following a fixed-width ``pattern``.

    Supported fields: ``yyyy MM dd HH mm ss``; any other character is a
    literal; ``[...]`` marks an optional section at the end (``HH:mm[:ss]``).
    Malformed or impossible values give NULL.
    """
    return _parsed(as_col(c), pattern, "timestamp_ntz")


def parse_day(c, pattern: str = "dd/MM/yyyy") -> Column:
    """Text -> DATE following a fixed-width ``pattern`` (NULL if invalid)."""
    return _parsed(as_col(c), pattern, "date")


def clock_minutes(clock) -> Column:
    """``HH:mm`` text -> minute of the day (INT), NULL when malformed."""
    c = as_col(clock)
    rx, _ = _layout("HH:mm")
    # read as the number HHmm, an hour of which is 40 more than its 60 minutes
    digits = F.when(c.rlike(rx), F.replace(c, F.lit(":"), F.lit(""))).cast("int")
    return digits - F.floor(digits / 100).cast("int") * 40
