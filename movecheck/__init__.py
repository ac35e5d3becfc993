"""Move tables between storage systems with Spark and prove the move right."""

from movecheck.operators.audit import failure_message, failure_summary
from movecheck.operators.conform import cast_loss, conform, contract_losses, null_violations
from movecheck.operators.decimals import cast_elements, decimal_overflow, fit_decimals
from movecheck.operators.digest_tree import TreeReconciliation, reconcile_tree
from movecheck.operators.digit_table import digit_table, smallest_decimals
from movecheck.operators.drift import align_to, drift_report, schema_drift, union_aligned
from movecheck.operators.keys import unique_keys
from movecheck.operators.missing import copy_missing, missing_rows
from movecheck.operators.months import (
    missing_months,
    month_coverage,
    month_keys,
    months_between,
)
from movecheck.operators.nearness import reconcile_within
from movecheck.operators.pairing import pair_changed_rows
from movecheck.operators.profile import numeric_profile, profile_columns, text_digit_profile
from movecheck.operators.profile_store import (
    merged_profile,
    merged_quantiles,
    profile_states,
    read_profile_store,
    refresh_profile_store,
)
from movecheck.operators.reconcile import (
    KeyReconciliation,
    Reconciliation,
    reconcile,
    reconcile_by_key,
)
from movecheck.operators.rejects import RoutedLoad, load_with_rejects, reject_reasons, route_rows
from movecheck.operators.renames import apply_renames, column_sketches, renamed_columns
from movecheck.plans.migrate import (
    ContractViolation,
    Migration,
    align_partitions,
    compare_with_table,
    migrate,
)
from movecheck.sources.contract import Contract, ContractColumn, load_contract, read_contract
from movecheck.sources.footers import footer_profile, pushed_aggregates
from movecheck.sources.inference import infer_contract, type_states
from movecheck.sources.publish import SourceChanged, publish, published_versions, read_published
from movecheck.sources.sinks import write_table
from movecheck.sources.tables import read_table, scan_months

__all__ = [
    "Contract",
    "ContractColumn",
    "ContractViolation",
    "KeyReconciliation",
    "Migration",
    "Reconciliation",
    "RoutedLoad",
    "SourceChanged",
    "TreeReconciliation",
    "align_partitions",
    "align_to",
    "apply_renames",
    "cast_elements",
    "cast_loss",
    "column_sketches",
    "compare_with_table",
    "conform",
    "contract_losses",
    "copy_missing",
    "decimal_overflow",
    "digit_table",
    "drift_report",
    "failure_message",
    "failure_summary",
    "fit_decimals",
    "footer_profile",
    "infer_contract",
    "load_contract",
    "load_with_rejects",
    "merged_profile",
    "merged_quantiles",
    "migrate",
    "missing_months",
    "missing_rows",
    "month_coverage",
    "month_keys",
    "months_between",
    "null_violations",
    "numeric_profile",
    "pair_changed_rows",
    "profile_columns",
    "profile_states",
    "publish",
    "published_versions",
    "pushed_aggregates",
    "read_contract",
    "read_profile_store",
    "read_published",
    "read_table",
    "reconcile",
    "reconcile_by_key",
    "reconcile_tree",
    "reconcile_within",
    "refresh_profile_store",
    "reject_reasons",
    "renamed_columns",
    "route_rows",
    "scan_months",
    "schema_drift",
    "smallest_decimals",
    "text_digit_profile",
    "type_states",
    "union_aligned",
    "unique_keys",
    "write_table",
]
