from rowsieve.plans.rules import Rule, rules_from_dict, rules_from_policies
from rowsieve.plans.schema import ColumnSpec, column_specs, key_columns, schema_from_json, source_schema
from rowsieve.plans.verdict import (
    apply_rules,
    bind_rules,
    error_ids,
    error_rows,
    split_verdict,
    valid_rows,
    with_verdict,
)

__all__ = [
    "ColumnSpec",
    "Rule",
    "apply_rules",
    "bind_rules",
    "column_specs",
    "error_ids",
    "error_rows",
    "key_columns",
    "rules_from_dict",
    "rules_from_policies",
    "schema_from_json",
    "source_schema",
    "split_verdict",
    "valid_rows",
    "with_verdict",
]
