"""Rule records and the two forms they come in: a dictionary and policy rows."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from rowsieve.functions.checks import type_rank

log = logging.getLogger(__name__)

EVERY_APPLICATION = "ALL"

# Rule ids and messages of the dictionary form.
DEFAULT_IDS = {
    "not_null": "ERR_NULL",
    "regex_pattern": "ERR_REGEX",
    "allowed_values": "ERR_INVALID_VALUE",
    "min_length": "ERR_LEN",
    "array_not_empty": "ERR_EMPTY_ARRAY",
}
MESSAGES = {
    "not_null": "Value is Null",
    "regex_pattern": "Pattern match failed: {pattern}",
    "allowed_values": "Value not in allowed list",
    "min_length": "Length < {length}",
    "array_not_empty": "Array is empty",
}


@dataclass(frozen=True)
class Rule:
    """One check on one column, for some or all applications.

    ``include`` is None when the rule covers every application.
    """

    rule_id: str
    rule_type: str
    column: str
    params: Mapping[str, Any] = field(default_factory=dict)
    message: str | None = None
    include: tuple[str | None, ...] | None = None
    exclude: tuple[str | None, ...] = ()


def rules_from_dict(document: Mapping[str, Any]) -> list[Rule]:
    """Rules from the dictionary form, ``{rule type: settings}``.

    Settings are one mapping with ``columns``, or a list of mappings with ``column``
    and the parameters. Both ``ruleId`` and ``rule_id`` are read. Errors come in the
    order of :data:`DEFAULT_IDS`, then further types as they stand.
    """
    sections = document.get("dataQualityRules", document)
    names = [n for n in DEFAULT_IDS if n in sections]
    names += [n for n in sections if n not in DEFAULT_IDS]
    return [rule for name in names for rule in _section_rules(name, sections[name])]


def _section_rules(name: str, section: Any) -> Iterable[Rule]:
    for entry in [section] if isinstance(section, Mapping) else section:
        settings = dict(entry)
        columns = settings.pop("columns", None) or []
        if "column" in settings:
            columns = [settings.pop("column"), *columns]
        spelled = settings.pop("ruleId", None)
        rule_id = settings.pop("rule_id", spelled) or DEFAULT_IDS.get(name, f"ERR_{name.upper()}")
        message = settings.pop("message", None)
        if message is None:
            message = _default_message(name, settings)
        for target in columns:
            yield Rule(rule_id, name, target, settings, message)


def _default_message(name: str, params: Mapping[str, Any]) -> str:
    template = MESSAGES.get(name, f"{name} failed")
    for key, value in params.items():
        template = template.replace("{" + key + "}", str(value))
    return template


def rules_from_policies(rows: Iterable[Any]) -> list[Rule]:
    """Rules from policy rows (mappings or Spark Rows), one rule per row.

    The result is sorted by (rule type, policy id), so the order of a row's errors
    does not depend on the order in which the rows were read.
    """
    rules = [_policy_rule(row if isinstance(row, Mapping) else row.asDict()) for row in rows]
    return sorted(rules, key=lambda r: (type_rank(r.rule_type), r.rule_id, r.column, r.message or ""))


def _policy_rule(row: Mapping[str, Any]) -> Rule:
    include = row.get("app_scope_inclusion")
    everyone = include is None or EVERY_APPLICATION in include
    return Rule(
        rule_id=row["policy_id"],
        rule_type=row["rule_type"],
        column=row["target_column"],
        params=dict(row.get("rule_params") or {}),
        message=row.get("error_message"),
        include=None if everyone else tuple(include),
        exclude=tuple(row.get("app_scope_exclusion") or ()),
    )
