"""Column-level building blocks (all built-in Spark expressions)."""

from transitlake.functions.casts import lenient_double, lenient_int, lenient_long, portable_round, ratio_round
from transitlake.functions.codes import map_codes, truthy_flag
from transitlake.functions.text import after_first, blank_to_null, piece, split_fields
from transitlake.functions.time import clock_minutes, parse_day, parse_wallclock

__all__ = [
    "after_first",
    "blank_to_null",
    "clock_minutes",
    "lenient_double",
    "lenient_int",
    "lenient_long",
    "map_codes",
    "parse_day",
    "parse_wallclock",
    "piece",
    "portable_round",
    "ratio_round",
    "split_fields",
    "truthy_flag",
]
