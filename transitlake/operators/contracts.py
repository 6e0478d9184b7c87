"""Table contracts checked at plan time (no Spark job)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.operators.frames import quoted


class ContractError(ValueError):
    """A required column is missing."""


@dataclass(frozen=True)
class Contract:
    """Required column names of a table at one stage.

    ``open`` contracts allow extra columns (the trip table passes
    undeclared source columns through); closed ones are also the fixed
    output projection.
    """

    table: str
    stage: str
    columns: Sequence[str]
    open: bool = False
    partition_by: Sequence[str] = field(default_factory=tuple)
    # types by column, where the contract states them (DDL names such as ``int``)
    types: Mapping[str, str] = field(default_factory=dict)

    def missing(self, df: DataFrame) -> list[str]:
        present = set(df.columns)
        return [c for c in self.columns if c not in present]

    def check(self, df: DataFrame) -> DataFrame:
        return require_columns(df, self.columns, self.stage, self.table)


def require_columns(
    df: DataFrame, names: Sequence[str], stage: str = "input", table: str = "table"
) -> DataFrame:
    """Raise :class:`ContractError` naming every missing column."""
    present = set(df.columns)
    missing = [c for c in names if c not in present]
    if missing:
        raise ContractError(
            f"{table}: invalid {stage} structure, missing columns: {', '.join(missing)}"
        )
    return df


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per required column: ``(table_name, stage, column_name,
    present, non_null_rows)``.

    Presence comes from the schema; the non-NULL counts of all present
    columns come from one aggregate pass over the data.
    """
    have = set(df.columns)
    # one row of counts, then one row per column: no join
    counts = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.lit(c in have).alias("present"),
                    (F.count(quoted(c)) if c in have else F.lit(None).cast("bigint")).alias("non_null_rows"),
                )
                for c in contract.columns
            ]
        ).alias("counted")
    )
    return counts.select(
        F.lit(contract.table).alias("table_name"), F.lit(contract.stage).alias("stage"), F.inline("counted")
    )


def schema_drift(df: DataFrame, contract: Contract) -> list[tuple[str, str | None, str | None, str]]:
    """How the schema differs from the contract, at plan time: (column, expected type, type, status).

    Status is ``ok``, ``missing``, ``type`` (another type than stated) or ``extra``
    (not in the contract; for open contracts that is allowed, and still told).
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = []
    for c in contract.columns:
        wanted, found = contract.types.get(c), actual.get(c)
        out.append((c, wanted, found, "missing" if found is None else "type" if wanted not in (None, found) else "ok"))
    return out + [(c, None, t, "extra") for c, t in actual.items() if c not in set(contract.columns)]


def drift_report(df: DataFrame, contract: Contract) -> DataFrame:
    """:func:`schema_drift` as rows, with what the drift costs: ``(table_name, stage,
    column_name, expected_type, actual_type, status, unfit_rows)``.

    ``unfit_rows`` counts the values of a column of another type that the stated
    type cannot hold (non-NULL, but NULL after the cast); one aggregate for all.
    """
    drift = schema_drift(df, contract)

    def unfit(name, wanted, status):
        if status != "type":
            return F.lit(0).cast("bigint")
        return F.count_if(quoted(name).isNotNull() & quoted(name).try_cast(wanted).isNull())

    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(wanted).cast("string").alias("expected_type"),
            F.lit(found).cast("string").alias("actual_type"),
            F.lit(status).alias("status"),
            unfit(name, wanted, status).alias("unfit_rows"),
        )
        for name, wanted, found, status in drift
    ]
    counts = df.agg(F.count(F.lit(1)).alias("rows"), F.array(*entries).alias("entries"))
    return counts.select(F.lit(contract.table).alias("table_name"), F.lit(contract.stage).alias("stage"), F.inline("entries"))


def check_types(df: DataFrame, contract: Contract) -> DataFrame:
    """Raise :class:`ContractError` if a column lacks or has another type than stated (no job)."""
    wrong = [f"{c} ({found or 'missing'}, expected {wanted or 'any type'})" for c, wanted, found, status in schema_drift(df, contract) if status in ("missing", "type")]
    if wrong:
        raise ContractError(f"{contract.table}: schema drift at {contract.stage}: {', '.join(wrong)}")
    return df
