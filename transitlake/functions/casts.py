"""Lenient text-to-number casts and portable rounding.

Raw transit files carry numbers as text.  The pipeline wants the old
"NULL on anything malformed" behaviour of a non-ANSI cast, but Spark 4
runs ANSI by default, and ``try_cast`` disagrees with the old cast on
fractions (``'12.7'``).  Every helper here is a built-in Column
expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from transitlake.functions._col import as_col

# The legacy integer text rule: surrounding whitespace/control characters
# are trimmed; then an optional sign, digits (possibly none), and an
# optional fraction that is checked but ignored ("12.7" -> 12, ".5" -> 0,
# "." -> 0); a bare sign or empty text is rejected, as are exponents and junk.
_INTEGER_TEXT = r"^[\x00-\x20]*([+-]?)(?=[0-9.])([0-9]*)(?:[.][0-9]*)?[\x00-\x20]*$"
# sign, a zero (for texts without a digit before the point) and the digits
_WHOLE_PART = "$10$2"


# Digits that every value of the type has room for.
_SAFE_DIGITS = {"int": 9, "bigint": 18}


def _by_rule(c: Column, type_name: str) -> Column:
    return F.when(c.rlike(_INTEGER_TEXT), _try_cast(F.regexp_replace(c, _INTEGER_TEXT, _WHOLE_PART), type_name))


def _lenient_integral(c, type_name: str, apart: bool) -> Column:
    # A failing try_cast costs some 50 us (it raises and catches inside), so
    # every cast is behind a regex: digits, with or without a fraction, pay for
    # one, other texts for three, and only long digit runs can still fail.
    c = as_col(c)
    plain = F.when(
        c.rlike(rf"^[+-]?[0-9]{{1,{_SAFE_DIGITS[type_name]}}}(?:[.][0-9]*)?\z"),
        F.substring_index(c, ".", 1).cast(type_name),
    )
    if apart:
        return plain.otherwise(F.get(F.transform(F.array(c), lambda x: _by_rule(x, type_name)), 0))
    return plain.otherwise(_by_rule(c, type_name))


def lenient_int(c, apart: bool = False) -> Column:
    """Text -> INT; malformed or out-of-range text -> NULL (never raises).

    ``apart``: for tables with many number columns.  The rule for texts that
    are neither plain integers nor plain decimals then goes into a higher-order function.  Such a
    projection is generated as many small methods beside the whole-stage code,
    which together with the rest would be one method too large for the JVM to
    compile (above 8000 bytes it stays interpreted, several times slower).
    """
    return _lenient_integral(c, "int", apart)


def lenient_long(c, apart: bool = False) -> Column:
    """Text -> BIGINT with the same rule as :func:`lenient_int`."""
    return _lenient_integral(c, "bigint", apart)


def lenient_double(c) -> Column:
    """Text -> DOUBLE, accepting a decimal comma (``'-19,95'`` -> -19.95)."""
    return _try_cast(F.replace(as_col(c), F.lit(","), F.lit(".")), "double")


def _try_cast(c: Column, type_name: str) -> Column:
    return c.try_cast(type_name)


def portable_round(c, scale: int = 2) -> Column:
    """HALF_UP rounding of a DOUBLE's decimal value, in one step.

    NaN and infinity stay as they are; nothing raises.
    """
    return F.round(as_col(c).cast("double"), scale)


def ratio_round(numerator, denominator, scale: int = 2) -> Column:
    """``numerator / denominator`` of two integers, rounded HALF_UP exactly.

    Means of integers at a tie (such as 0.125) come out the same in any
    engine: the division is one of whole numbers (of 38 digits, so no sum that
    fits a BIGINT overflows).  NULL if the denominator is 0 or NULL.
    """
    n = as_col(numerator).cast("decimal(20,0)") * F.lit(10**scale).cast("decimal(10,0)")
    d = F.nullif(as_col(denominator).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    two = F.lit(2).cast("decimal(1,0)")
    doubled = F.abs(n) * two + d
    half_up = ((doubled - doubled % (d * two)) / (d * two)).cast("decimal(30,0)")
    return (F.signum(n).cast("decimal(1,0)") * half_up * F.lit(Decimal(1).scaleb(-scale))).cast("double")
