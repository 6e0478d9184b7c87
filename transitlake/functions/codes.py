"""Code-to-label mapping and flag parsing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from transitlake.functions._col import as_col

# ---------------------------------------------------------------------------
# The operator's published code tables.  The labels are data
# and must be reproduced exactly as published.
# ---------------------------------------------------------------------------
# GPS field SV (direction of travel).
DIRECTION_LABELS = {"1": "IDA", "2": "VOLTA"}
DIRECTION_DEFAULT = "INDEFINIDO"
# Trip-control field CONCESSIONARIA (operating consortium), compared as text.
CONSORTIUM_LABELS = {
    "801": "Consórcio Pampulha",
    "802": "Consórcio BHLeste",
    "803": "Consórcio Dez",
    "804": "Consórcio Dom Pedro II",
}
CONSORTIUM_DEFAULT = "Desconhecido"
# Trip-control field PC (control point the trip started from -> trip type).
TRIP_TYPE_LABELS = {0: "Ociosa", 1: "Normal", 2: "Normal", 3: "Transferencia"}
TRIP_TYPE_DEFAULT = "Outros"
# Route catalogue: itinerary without a third ("variation") piece.
NO_VARIATION = "NENHUMA"
# ---------------------------------------------------------------------------


def map_codes(c, mapping: Mapping, default: str | None = None) -> Column:
    """CASE chain ``code -> label``; NULL or unknown codes get ``default``.

    Keys are compared with the column's own type (text codes as text, so
    ``' 801'`` is not ``'801'``).  Small fixed tables stay a codegen'd CASE
    instead of a join.
    """
    c = as_col(c)
    out = None
    for code, label in mapping.items():
        cond = c == F.lit(code)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default))


# The integer 1 under the lenient rule: trimmed, signed, with leading zeros and an ignored fraction.
_ONE = r"^[\x00-\x20]*[+]?0*1(?:[.][0-9]*)?[\x00-\x20]*$"


def truthy_flag(c, labels: Iterable[str] = ()) -> Column:
    """Flag text -> BOOLEAN, never NULL.

    True when the text is the integer 1 under the lenient cast (``'1'``,
    ``' 1 '``, ``'1.0'``), or exactly one of ``labels`` (e.g. ``("S",)``
    for the published S/N coding).
    """
    c = as_col(c)
    # the two usual texts need no regex
    flag = F.when(c == "1", F.lit(True)).when(c == "0", F.lit(False)).otherwise(F.coalesce(c.rlike(_ONE), F.lit(False)))
    labels = list(labels)
    if labels:
        flag = flag | F.coalesce(c.isin(labels), F.lit(False))
    return flag
