"""Table-level DataFrame -> DataFrame operators."""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlake.functions._col import as_col


def quoted(name: str) -> Column:
    """Column reference that is safe for names with dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def normalized_name(name: str, strip_accents: bool = False) -> str:
    """Header text -> column name: trim, lower-case, inner spaces -> ``_``."""
    out = name.strip().lower().replace(" ", "_")
    if strip_accents:
        out = "".join(
            ch for ch in unicodedata.normalize("NFKD", out) if not unicodedata.combining(ch)
        )
    return out


def normalize_names(df: DataFrame, strip_accents: bool = False) -> DataFrame:
    """Rename every column with :func:`normalized_name`.

    ``toDF`` renames positionally, so dotted or spaced source names are
    safe.  Two headers that normalise to the same name (``"A"`` and
    ``"a "``) raise instead of producing an ambiguous table.
    """
    names = [normalized_name(c, strip_accents) for c in df.columns]
    seen: dict[str, str] = {}
    for src, dst in zip(df.columns, names):
        if dst in seen:
            raise ValueError(
                f"columns {seen[dst]!r} and {src!r} both normalise to {dst!r}"
            )
        seen[dst] = src
    return df.toDF(*names)


def project(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Fixed-order final projection."""
    return df.select(*[quoted(n) for n in names])


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop ``names`` (absent ones are ignored) and a blank-named column."""
    present = set(df.columns)
    doomed = [n for n in names if n in present]
    if "" in present:
        doomed.append("")
    keep = [c for c in df.columns if c not in set(doomed)]
    return df.select(*[quoted(c) for c in keep])


def in_range(c, low, high) -> Column:
    """Inclusive range test; NULL never passes a filter."""
    return as_col(c).between(low, high)


def fenced(df: DataFrame) -> DataFrame:
    """The same rows, with predicates on them kept above the columns they test.

    Catalyst pushes a predicate through projections by putting each column's
    whole expression in its place, as often as the column is named.  Over text
    parsing that grows into a filter that parses every row again and again, in
    a method too large for the JVM to compile.  It does not push through an
    observation.  Column pruning goes on below, and predicates on a table that
    is read back still reach its scan.
    """
    return df.observe(f"fenced_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def dedup_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None
) -> DataFrame:
    """One row per key with a deterministic survivor.

    The survivor is the row whose non-key columns (in ``order``, default
    the table's column order) are smallest, NULLs first.  Written as
    ``min(struct(...))`` so Spark runs a partial aggregate before the
    shuffle: a key that repeats millions of times is collapsed on the map
    side instead of landing whole in one task (a ``row_number`` window
    could not do that).  NULL keys form one group, as in a plain
    ``dropDuplicates``.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order) if order is not None else rest
    missing = set(rest) - set(order)
    if missing:
        order = order + [c for c in rest if c in missing]
    if not order:
        return df.select(*[quoted(k) for k in keys]).distinct()
    survivor = F.min(F.struct(*[quoted(c).alias(c) for c in order])).alias("_survivor")
    picked = df.groupBy(*[quoted(k) for k in keys]).agg(survivor)
    return picked.select(
        *[quoted(c) if c in keys else F.col("_survivor")[c].alias(c) for c in df.columns]
    )


def stamp_ingestion(df: DataFrame, source_name: str | None = None) -> DataFrame:
    """Add ``_ingestion_timestamp`` and ``_source_file``.

    With ``source_name`` the source is that literal label; without it, the
    real file each row came from (``_metadata.file_path``), which needs a
    file-based DataFrame.
    """
    source = F.lit(source_name) if source_name is not None else F.col("_metadata.file_path")
    return df.withColumns(
        {"_ingestion_timestamp": F.current_timestamp(), "_source_file": source}
    )
