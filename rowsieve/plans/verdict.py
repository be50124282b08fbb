"""Evaluate all rules of a row in one pass and give each row one verdict.

For a rule, ``fails = in scope AND NOT check`` in three-valued logic. A row is valid
when no rule fails. A rule whose outcome is NULL (a regex on a NULL value, say) makes
the row *undetermined*: it counts as invalid, so valid and error rows always add up to
the input, and it carries an entry only when no rule definitely failed.

The plan has three projections whatever the number of rules: one looks up what the row's
application has to pass, the next evaluates each of those checks once into an array of
outcomes, the last derives verdict and entries (see :mod:`rowsieve.plans.index`).
"""

from __future__ import annotations

import functools
import json
import logging
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from rowsieve.functions.checks import RuleParameterError, converted_texts, rule_type
from rowsieve.functions.naming import Names, column, quote
from rowsieve.plans.index import CHECKS_IN_WORD, ENTRY_TYPE, RuleIndex
from rowsieve.plans.rules import Rule

log = logging.getLogger(__name__)

ERRORS = "dq_errors"
VERDICT = "is_valid"
SCOPE_COLUMN = "applicationCode"
ERRORS_TYPE = "array<struct<rule_id:string,column:string,message:string>>"
UNDETERMINED = "undetermined: "

_SCOPE = "_rule_scope"
_OUTCOMES = "_rule_outcomes"
# Rules whose checks are put together by one filter.
RULES_TOGETHER = 100


@dataclass(frozen=True)
class BoundRule:
    """A rule resolved against one DataFrame; ``key`` tells rules with the same check."""

    rule: Rule
    key: tuple[str, str, str]
    check: Column
    scope_of: Callable[[], Column | None]

    @property
    def fails(self) -> Column:
        scope = self.scope_of()
        return ~self.check if scope is None else scope & ~self.check

    @property
    def passes(self) -> Column:
        scope = self.scope_of()
        return self.check if scope is None else ~scope | self.check


def bind_rules(
    df: DataFrame, rules: Iterable[Rule], scope_column: str = SCOPE_COLUMN
) -> list[BoundRule]:
    """Resolve rules against a DataFrame.

    Rules of an unknown type or on an absent column have no effect and are logged;
    a rule that lacks a parameter raises :class:`RuleParameterError`.
    """
    names = Names.of(df)
    scopes: dict[tuple, Column | None] = {}
    checks: dict[tuple[str, str, str], Column] = {}

    def scope_of(rule: Rule) -> Column | None:
        applications = (rule.include, rule.exclude)
        if applications not in scopes:
            scopes[applications] = _scope(names, rule, scope_column)
        return scopes[applications]

    bound = []
    for rule in rules:
        known = rule_type(rule.rule_type)
        if known is None:
            log.warning("rule %s: unknown type %r, skipped", rule.rule_id, rule.rule_type)
            continue
        target = names.find(rule.column)
        if target is None:
            log.warning("rule %s: no column %r, skipped", rule.rule_id, rule.column)
            continue
        if rule.include == ():
            log.warning("rule %s: included for no application, skipped", rule.rule_id)
            continue
        missing = [p for p in known.required if rule.params.get(p) is None]
        if missing:
            raise RuleParameterError(f"rule {rule.rule_id} ({rule.rule_type}): no {missing}")
        key = (rule.rule_type, target, json.dumps(rule.params, sort_keys=True, default=repr))
        try:
            if key not in checks:
                params = rule.params
                if known.prepare is not None:
                    params = known.prepare(df.sparkSession, df.schema[target].dataType, params)
                checks[key] = known.build(quote(target), params)
        except Exception as e:
            raise RuleParameterError(f"rule {rule.rule_id} ({rule.rule_type}): {e}") from e
        if (rule.include is not None or rule.exclude) and names.find(scope_column) is None:
            raise ValueError(f"rule {rule.rule_id} is scoped, but there is no column {scope_column!r}")
        bound.append(BoundRule(rule, key, checks[key], functools.partial(scope_of, rule)))
    return bound


def _scope(names: Names, rule: Rule, scope_column: str) -> Column | None:
    """Whether the rule covers the row's application; None when it covers all."""
    if rule.include is None and not rule.exclude:
        return None
    application = column(names.find(scope_column))
    parts = []
    if rule.include is not None:
        parts.append(application.isin(list(rule.include)))
    if rule.exclude:
        parts.append(~application.isin(list(rule.exclude)))
    return reduce(and_, parts)


def apply_rules(
    df: DataFrame, rules: Iterable[Rule], scope_column: str = SCOPE_COLUMN, filtered: bool = False
) -> DataFrame:
    """Add ``dq_errors`` (an array of entries) and ``is_valid`` (never NULL).

    Set ``filtered`` where the verdict is filtered on next without being stored before:
    the outcomes then come out of a generator, through which Spark pushes no filter, so
    that the rules are not evaluated once for the filter and again for the entries.
    """
    bound = bind_rules(df, rules, scope_column)
    kept = [column(c) for c in _data_columns(df)]
    none = F.array().cast(ERRORS_TYPE)
    if not bound:
        return df.select(*kept, none.alias(ERRORS), F.lit(True).alias(VERDICT))

    order = list(dict.fromkeys(b.key for b in sorted(bound, key=_scope_order)))
    number = {key: i for i, key in enumerate(order)}
    check_of = {b.key: b.check for b in bound}
    application, texts = _application(df, bound, scope_column)
    index = RuleIndex([_renamed(b.rule, texts) for b in bound], [number[b.key] for b in bound])

    rows, also = df, []
    if index.is_scoped:
        rows, also = df.select(*kept, _lookup(index, application).alias(_SCOPE)), [F.col(_SCOPE)]
    outcomes = F.concat(*[_outcomes(index, w, order, check_of) for w in range(index.words)])
    rows = rows.select(*kept, *also, outcomes.alias(_OUTCOMES))
    if filtered:
        rows = rows.select(*kept, *also, F.explode(F.array(_OUTCOMES)).alias(_OUTCOMES))
    return _judged(rows, kept, index, bound)


def _scope_order(b: BoundRule) -> tuple:
    """Checks of rules with the same scope stand together, those of all rows first."""
    include, exclude = b.rule.include, b.rule.exclude
    return (include is not None, repr(include), repr(exclude))


def _application(df: DataFrame, bound: Sequence[BoundRule], scope_column: str) -> tuple[Column | None, dict[str, str]]:
    """The row's application as text, and how that text spells the names in rules."""
    names = {n for b in bound for n in (*(b.rule.include or ()), *b.rule.exclude) if n is not None}
    have = Names.of(df).find(scope_column)
    if have is None:
        return None, {}
    kind: DataType = df.schema[have].dataType
    spelled = {n: n for n in names}
    if not isinstance(kind, StringType):
        ordered = tuple(sorted(names))
        spelled = dict(zip(ordered, converted_texts(df.sparkSession, kind, ordered), strict=True))
    return column(have).cast("string"), spelled


def _renamed(rule: Rule, texts: dict[str, str]) -> Rule:
    """Names that are no value of the scope column's type match nothing."""
    def spell(names):
        return tuple(None if n is None else texts[n] for n in names if n is None or texts[n] is not None)

    include = None if rule.include is None else spell(rule.include)
    return replace(rule, include=include, exclude=spell(rule.exclude))


def _lookup(index: RuleIndex, application: Column) -> Column:
    count, buckets = index.buckets()
    maps = F.from_json(F.lit(buckets), f"array<map<string,{ENTRY_TYPE}>>")
    bucket = F.get(maps, F.pmod(F.crc32(application.cast("binary")), F.lit(count)).cast("int"))
    base, null = (F.from_json(F.lit(json.dumps(e)), ENTRY_TYPE) for e in (index.base, index.null))
    return F.when(application.isNull(), null).otherwise(F.coalesce(F.try_element_at(bucket, application), base))


def _outcomes(index: RuleIndex, word: int, order: Sequence[tuple], check_of: dict[tuple, Column]) -> Column:
    """For each check of a word whether it fails a rule that covers the row: FALSE where
    none asks for it, NULL where that is unknown."""
    first = word * CHECKS_IN_WORD
    keys = order[first : first + CHECKS_IN_WORD]
    fails = [_asked(index, word, first + k, ~check_of[key]) for k, key in enumerate(keys)]
    if not index.is_scoped or index.asked_by_all & set(range(first, first + len(keys))):
        return F.array(*fails)
    mask = f"{_SCOPE}.covered[{word}] | {_SCOPE}.unsure[{word}]"
    return F.when(F.expr(f"{mask} = 0"), F.array_repeat(F.lit(False), len(keys))).otherwise(F.array(*fails))


def _asked(index: RuleIndex, word: int, i: int, failed: Column) -> Column:
    if i in index.asked_by_all:
        return failed
    bit = f"{1 << i % CHECKS_IN_WORD}L"
    covered, unsure = (f"{_SCOPE}.{name}[{word}] & {bit} <> 0" for name in ("covered", "unsure"))
    # AND looks at the check only where the rule may cover the row.
    return F.expr(f"if({covered}, true, if({unsure}, null, false))") & failed


def _judged(rows: DataFrame, kept: Sequence[Column], index: RuleIndex, bound: Sequence[BoundRule]) -> DataFrame:
    """Verdict and entries from the outcomes of all checks."""
    outcomes, scope = F.col(_OUTCOMES), F.col(_SCOPE)
    # TRUE, FALSE and NULL exactly as the conjunction of "does not fail".
    valid = ~F.array_contains(outcomes, F.lit(True))
    check_of, base = (F.from_json(F.lit(json.dumps(x)), "array<int>") for x in (index.checks, index.base_rules))
    mine, maybe = base, None
    if index.is_scoped:
        differs = (F.size(scope["added"]) > 0) | (F.size(scope["dropped"]) > 0)
        own = F.sort_array(F.concat(F.array_except(base, scope["dropped"]), scope["added"]))
        mine = F.when(differs, own).otherwise(base)
        maybe = F.sort_array(F.concat(mine, scope["maybe"]))

    def outcome(i: Column) -> Column:
        return F.get(outcomes, F.get(check_of, i))

    once = F.array_distinct if _entries_repeat(bound) else lambda entries: entries

    def told(which: Column, prefix: str = "") -> Column:
        entries = _entries(bound, prefix)
        return once(F.transform(which, lambda i: F.get(entries, i)))

    errors = (
        F.when(valid, F.array().cast(ERRORS_TYPE))
        .when(valid.isNull(), told(F.filter(mine if maybe is None else maybe, lambda i: outcome(i).isNull()), UNDETERMINED))
        .otherwise(told(F.filter(mine, outcome)))
    )
    return rows.select(*kept, errors.alias(ERRORS), F.coalesce(valid, F.lit(False)).alias(VERDICT))


def _entries(bound: Sequence[BoundRule], prefix: str = "") -> Column:
    """All rules' error entries as one constant, in rule order.

    It goes to Spark as a single text: a Column per field would make the planning of a
    few hundred rules take longer than most micro-batches.
    """
    entries = [
        {
            "rule_id": b.rule.rule_id,
            "column": b.rule.column,
            "message": prefix + (b.rule.message or "") if prefix else b.rule.message,
        }
        for b in bound
    ]
    return F.from_json(F.lit(json.dumps(entries)), ERRORS_TYPE)


def _entries_repeat(bound: Sequence[BoundRule]) -> bool:
    entries = {(b.rule.rule_id, b.rule.column, b.rule.message or "") for b in bound}
    return len(entries) < len(bound)


def valid_rows(
    df: DataFrame, rules: Iterable[Rule], scope_column: str = SCOPE_COLUMN
) -> DataFrame:
    """Only the valid rows, without verdict columns.

    The checks stay plain conjuncts, so those a file format understands are pushed
    into its scan, and no error entry is ever built.
    """
    bound = bind_rules(df, rules, scope_column)
    rows = df.select(*[column(c) for c in _data_columns(df)])
    for chunk in _chunks(bound):
        rows = rows.filter(_all([b.passes for b in chunk]))
    return rows


def error_rows(
    df: DataFrame, rules: Iterable[Rule], scope_column: str = SCOPE_COLUMN
) -> DataFrame:
    """Only the rows that are not valid, with their entries."""
    return apply_rules(df, rules, scope_column, filtered=True).filter(~F.col(VERDICT))


def _chunks(bound: Sequence[BoundRule]) -> Iterable[Sequence[BoundRule]]:
    for start in range(0, len(bound), RULES_TOGETHER):
        yield bound[start : start + RULES_TOGETHER]


def _all(parts: Sequence[Column]) -> Column:
    """The conjunction as a balanced tree, whose depth grows with the logarithm."""
    if len(parts) == 1:
        return parts[0]
    middle = len(parts) // 2
    return _all(parts[:middle]) & _all(parts[middle:])


def split_verdict(verdicts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a DataFrame that has verdict columns: (valid rows bare, error rows)."""
    return verdicts.filter(VERDICT).drop(ERRORS, VERDICT), verdicts.filter(~F.col(VERDICT))


def with_verdict(schema: StructType) -> StructType:
    """The schema of error rows: that of the data and the verdict columns."""
    added = StructType.fromDDL(f"{ERRORS} {ERRORS_TYPE}, {VERDICT} boolean")
    return StructType([*schema.fields, *added.fields])


def error_ids(errors: str = ERRORS, separator: str = ",") -> Column:
    """The rule ids of a row's entries as one text."""
    return F.array_join(F.transform(F.col(errors), lambda e: e["rule_id"]), separator)


def _data_columns(df: DataFrame) -> Sequence[str]:
    names = Names.of(df)
    verdict_columns = {names.find(ERRORS), names.find(VERDICT)}
    return [c for c in df.columns if c not in verdict_columns]
