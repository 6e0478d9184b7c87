"""DataFrame -> DataFrame operators: framing, contracts, quality."""

from transitlake.operators.contracts import (
    Contract,
    ContractError,
    check_types,
    contract_report,
    drift_report,
    require_columns,
    schema_drift,
)
from transitlake.operators.frames import (
    dedup_by_key,
    drop_columns,
    fenced,
    in_range,
    normalize_names,
    normalized_name,
    project,
    quoted,
    stamp_ingestion,
)
from transitlake.operators.quality import (
    RuleViolation,
    duplicate_profile,
    enforce,
    null_profile,
    profile_table,
    rule_report,
)

__all__ = [
    "Contract",
    "ContractError",
    "RuleViolation",
    "check_types",
    "contract_report",
    "dedup_by_key",
    "drop_columns",
    "drift_report",
    "duplicate_profile",
    "enforce",
    "fenced",
    "in_range",
    "normalize_names",
    "normalized_name",
    "null_profile",
    "profile_table",
    "project",
    "quoted",
    "require_columns",
    "rule_report",
    "schema_drift",
    "stamp_ingestion",
]
