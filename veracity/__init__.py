"""veracity — declarative data-quality checks compiled to a few Spark jobs."""

from veracity.functions.render import RESULT_COLUMNS, RESULTS_SCHEMA
from veracity.operators import extensions as _extensions  # noqa: F401  (registers format/castable)
from veracity.operators.checks import CheckError, register
from veracity.operators.clean import apply_rules, clean_transactions
from veracity.operators.dedup import keep_latest
from veracity.operators.drilldown import failing_rows, preview
from veracity.operators.extensions import gate_split, repair_audit
from veracity.plans.suite import Suite, compact, run_checks
from veracity.spec import CheckSpec, SpecError, check

__all__ = [
    "RESULT_COLUMNS",
    "RESULTS_SCHEMA",
    "CheckError",
    "CheckSpec",
    "SpecError",
    "Suite",
    "apply_rules",
    "check",
    "clean_transactions",
    "compact",
    "failing_rows",
    "gate_split",
    "keep_latest",
    "preview",
    "register",
    "repair_audit",
    "run_checks",
]
