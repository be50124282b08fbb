"""Row checks: each builds a Column that is TRUE when the value passes.

A check is a function ``(column_name, params) -> Column``. It may give NULL when
the value does not decide it (a regex on NULL, say); the verdict step turns that
into an "undetermined" error instead of losing the row. No check depends on the
ANSI setting of the session.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

Params = Mapping[str, Any]
CheckBuilder = Callable[[str, Params], Column]

# Fixed value: the strict ISO 8601 pattern with an offset.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"

# Any text that ISO_FORMAT accepts has one to three fraction digits followed by an
# offset. Testing that first spares the parser (and the exception it raises inside)
# on most malformed values; the parser still has the last word.
_ISO_FRACTION = r"\.[0-9]{1,3}[Zz+-]"


class RuleParameterError(ValueError):
    """A rule lacks a parameter or has an unusable one; raised while planning."""


def not_null(name: str, params: Params) -> Column:
    return F.col(name).isNotNull()


def regex_pattern(name: str, params: Params) -> Column:
    return F.col(name).rlike(params["pattern"])


def allowed_values(name: str, params: Params) -> Column:
    values = _value_list(params["values"])
    return F.col(name).isin(values) if values else F.lit(False)


def min_length(name: str, params: Params) -> Column:
    return F.length(F.col(name)) >= _whole_number(params["length"])


def array_not_empty(name: str, params: Params) -> Column:
    return F.coalesce(F.size(F.col(name)) > 0, F.lit(False))


def is_iso_timestamp(name: str, params: Params) -> Column:
    value = F.col(name)
    custom = params.get("format")
    parsed = F.try_to_timestamp(value, F.lit(custom or ISO_FORMAT)).isNotNull()
    if custom:
        return parsed
    # typeof() is constant, so for text only the fraction test remains in the plan,
    # and for a column that is already a timestamp nothing does.
    plausible = (F.typeof(value) != "string") | value.cast("string").rlike(_ISO_FRACTION)
    return plausible & parsed


def well_formed(name: str, params: Params) -> Column:
    """Passes when the corrupt-record column of a text source stayed empty."""
    return F.col(name).isNull()


def _value_list(values: Any) -> list[Any]:
    """A list as it is, or a JSON array in text (policy parameters are text only)."""
    if isinstance(values, str):
        try:
            values = json.loads(values)
        except ValueError as e:
            raise RuleParameterError(f"'values' is not a JSON array: {values!r}") from e
    if not isinstance(values, Sequence) or isinstance(values, str):
        raise RuleParameterError(f"'values' must be a list, not {values!r}")
    return list(values)


def _whole_number(value: Any) -> int:
    try:
        return int(value)
    except (TypeError, ValueError) as e:
        raise RuleParameterError(f"'length' is not a whole number: {value!r}") from e


@functools.lru_cache(maxsize=1)
def _pattern_class(spark: SparkSession) -> Any:
    return spark._jvm.java.util.regex.Pattern


def _compiled_pattern(spark: SparkSession, kind: DataType, params: Params) -> Params:
    """The pattern must be one that the JVM accepts."""
    try:
        _pattern_class(spark).compile(params["pattern"])
    except Exception as e:
        raise RuleParameterError(f"'pattern' cannot be used: {params['pattern']!r}") from e
    return params


def _known_format(spark: SparkSession, kind: DataType, params: Params) -> Params:
    if params.get("format"):
        try:
            spark._jvm.java.time.format.DateTimeFormatter.ofPattern(params["format"])
        except Exception as e:
            raise RuleParameterError(f"'format' cannot be used: {params['format']!r}") from e
    return params


def _typed_values(spark: SparkSession, kind: DataType, params: Params) -> Params:
    """Values in the column's own type. What cannot be converted is left out, as no value
    of the column can equal it; without that, ANSI sessions would fail on such a row and
    others would call its outcome NULL."""
    values = [v for v in _value_list(params["values"]) if v is not None]
    if isinstance(kind, StringType):
        return {**params, "values": [v if isinstance(v, str) else json.dumps(v) for v in values]}
    if not values:
        return {**params, "values": []}
    texts = tuple(v if isinstance(v, str) else json.dumps(v) for v in values)
    return {**params, "values": list(_converted(spark, kind, texts))}


@functools.lru_cache(maxsize=1_000)
def _converted(spark: SparkSession, kind: DataType, texts: tuple[str, ...]) -> tuple[Any, ...]:
    casts = [F.lit(t).try_cast(kind).alias(f"v{i}") for i, t in enumerate(texts)]
    # A projection of constants, which Spark evaluates while optimizing: no job.
    row = spark.sql("SELECT 1 AS one").select(*casts).first()
    return tuple(v for v in row if v is not None)


@functools.lru_cache(maxsize=1_000)
def converted_texts(spark: SparkSession, kind: DataType, texts: tuple[str, ...]) -> tuple[str | None, ...]:
    """How values of a type, given as text, are spelled as text again; None for those
    that are none."""
    if not texts:
        return ()
    spelled = F.transform(F.array(*[F.lit(t) for t in texts]), lambda t: t.try_cast(kind).cast("string"))
    return tuple(spark.sql("SELECT 1 AS one").select(spelled).first()[0])


@dataclass(frozen=True)
class RuleType:
    """``prepare`` sees session, column type and parameters once, while planning."""

    build: CheckBuilder
    required: tuple[str, ...] = field(default=())
    prepare: Callable[[SparkSession, DataType, Params], Params] | None = None


_RULE_TYPES: dict[str, RuleType] = {
    "not_null": RuleType(not_null),
    "min_length": RuleType(min_length, ("length",)),
    "regex_pattern": RuleType(regex_pattern, ("pattern",), _compiled_pattern),
    "allowed_values": RuleType(allowed_values, ("values",), _typed_values),
    "is_iso_timestamp": RuleType(is_iso_timestamp, (), _known_format),
    "array_not_empty": RuleType(array_not_empty),
    "well_formed": RuleType(well_formed),
}
BUILT_IN = tuple(_RULE_TYPES)


def register_rule(name: str, builder: CheckBuilder, required: Sequence[str] = ()) -> None:
    """Add a rule type of your own: ``builder(column_name, params) -> Column``.

    The builder returns a Column expression, so the check runs in the JVM like the
    built-in ones. ``required`` names parameters that must be present.
    """
    if name in BUILT_IN:
        raise ValueError(f"rule type {name!r} is built in")
    _RULE_TYPES[name] = RuleType(builder, tuple(required))


def rule_type(name: str) -> RuleType | None:
    return _RULE_TYPES.get(name)


def type_rank(name: str) -> int:
    """Position of a type in the error list: built-in order, then as registered."""
    names = list(_RULE_TYPES)
    return names.index(name) if name in _RULE_TYPES else len(names)
