"""Config-driven ingestion and row-level data quality on Spark."""

from rowsieve.config import PipelineConfig
from rowsieve.functions import RuleParameterError, register_rule
from rowsieve.operators import dedup, flatten, route_batch, standardize
from rowsieve.plans import (
    Rule,
    apply_rules,
    error_rows,
    rules_from_dict,
    rules_from_policies,
    split_verdict,
    valid_rows,
)
from rowsieve.session import tune_session
from rowsieve.sinks import RouteSink
from rowsieve.streaming import start_bronze, start_silver

__all__ = [
    "PipelineConfig",
    "RouteSink",
    "Rule",
    "RuleParameterError",
    "apply_rules",
    "dedup",
    "error_rows",
    "flatten",
    "register_rule",
    "route_batch",
    "rules_from_dict",
    "rules_from_policies",
    "split_verdict",
    "standardize",
    "start_bronze",
    "start_silver",
    "tune_session",
    "valid_rows",
]
