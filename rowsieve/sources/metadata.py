"""The two metadata tables: schema registry and data-quality policies."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowsieve.plans.evolution import BREAKING, BreakingChange, compare
from rowsieve.plans.rules import Rule, rules_from_policies
from rowsieve.plans.schema import schema_from_json

# Names and layouts of the metadata tables.
REGISTRY_TABLE = "meta_schema_registry"
POLICY_TABLE = "meta_dq_policy"
REGISTRY_LAYOUT = (
    "schema_id string not null, dataset_name string not null, version int not null, "
    "schema_json string not null, is_active boolean not null, description string"
)
POLICY_LAYOUT = (
    "policy_id string not null, dataset_name string not null, rule_type string not null, "
    "target_column string not null, rule_params map<string,string>, "
    "app_scope_inclusion array<string>, app_scope_exclusion array<string>, error_message string"
)

# Policies are fetched and planned on the driver, one expression each. The default of
# ``limit`` is what a default session plans; more raise instead of being fetched.
MAX_POLICIES = 2_000
# Versions of one dataset's schema, which are compared on the driver.
MAX_VERSIONS = 10_000


def schema_registry(spark: SparkSession, entries: Iterable[Mapping[str, Any]]) -> DataFrame:
    """The schema registry; an entry's ``schema_json`` may be text, a dict or a StructType."""
    rows = [{**e, "schema_json": _schema_text(e["schema_json"])} for e in entries]
    return _literal_table(spark, rows, REGISTRY_LAYOUT)


def _schema_text(schema: Any) -> str:
    if isinstance(schema, StructType):
        return schema.json()
    return schema if isinstance(schema, str) else json.dumps(schema)


def dq_policies(spark: SparkSession, entries: Iterable[Mapping[str, Any]]) -> DataFrame:
    """The policy table. Parameters are text; other values are stored as JSON."""
    rows = [{**e, "rule_params": _text_params(e.get("rule_params"))} for e in entries]
    return _literal_table(spark, rows, POLICY_LAYOUT)


def _text_params(params: Mapping[str, Any] | None) -> dict[str, str] | None:
    if params is None:
        return None
    return {k: v if isinstance(v, str) else json.dumps(v) for k, v in params.items()}


def _literal_table(spark: SparkSession, rows: Iterable[Mapping[str, Any]], layout: str) -> DataFrame:
    schema = StructType.fromDDL(layout)
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def active_schema(
    spark: SparkSession, dataset: str, table: str | DataFrame = REGISTRY_TABLE
) -> StructType:
    """The active schema of a dataset; of several active versions the highest."""
    row = (
        _as_frame(spark, table)
        .filter((F.col("dataset_name") == dataset) & F.col("is_active"))
        .orderBy(F.desc("version"), F.desc("schema_id"))
        .select("schema_json")
        .limit(1)
        .head()
    )
    if row is None:
        raise LookupError(f"no active schema for dataset {dataset!r}")
    return schema_from_json(row["schema_json"])


def registered_schema(
    spark: SparkSession, dataset: str, table: str | DataFrame = REGISTRY_TABLE, since: int | None = None
) -> StructType:
    """The active schema of a dataset, for a job that takes its schema from the registry.

    Every version up to the active one, from version ``since`` on, is compared with the
    one before it. A step that rows written earlier would not fit raises
    :class:`~rowsieve.plans.evolution.BreakingChange`, which names the fields; pass the
    version after such a step as ``since`` to accept it.
    """
    sensitive = str(spark.conf.get("spark.sql.caseSensitive", "false")).lower() == "true"
    versions = schema_versions(spark, dataset, table)
    versions = [v for v in versions if since is None or v[0] >= since]
    if not versions:
        raise LookupError(f"no active schema for dataset {dataset!r} from version {since} on")
    for (before, old), (after, new) in zip(versions, versions[1:]):
        changes = compare(old, new, sensitive)
        if any(c.kind == BREAKING for c in changes):
            raise BreakingChange(f"dataset {dataset!r}, version {before} to {after}", changes)
    return versions[-1][1]


def schema_versions(
    spark: SparkSession, dataset: str, table: str | DataFrame = REGISTRY_TABLE
) -> list[tuple[int, StructType]]:
    """Versions of a dataset's schema in order, up to the highest active one."""
    rows = (
        _as_frame(spark, table)
        .filter(F.col("dataset_name") == dataset)
        .select("version", "schema_id", "schema_json", "is_active")
        .limit(MAX_VERSIONS + 1)
        .collect()
    )
    if len(rows) > MAX_VERSIONS:
        raise ValueError(f"dataset {dataset!r} has more than {MAX_VERSIONS} schema versions")
    order = lambda r: (r["version"], r["is_active"], r["schema_id"])
    active = max((r for r in rows if r["is_active"]), key=order, default=None)
    if active is None:
        raise LookupError(f"no active schema for dataset {dataset!r}")
    # Of rows with one version the active one counts, then the highest id, as in active_schema.
    last = {r["version"]: r for r in sorted(rows, key=order) if r["version"] <= active["version"]}
    return [(v, schema_from_json(r["schema_json"])) for v, r in sorted(last.items())]


def load_policies(
    spark: SparkSession, dataset: str, table: str | DataFrame = POLICY_TABLE, limit: int | None = None
) -> list[Row]:
    """The policy rows of a dataset; more than ``limit`` (:data:`MAX_POLICIES`) raise."""
    limit = MAX_POLICIES if limit is None else limit
    rows = (
        _as_frame(spark, table)
        .filter(F.col("dataset_name") == dataset)
        .limit(limit + 1)
        .collect()
    )
    if len(rows) > limit:
        raise ValueError(f"dataset {dataset!r} has more than {limit} policies")
    return rows


def load_rules(
    spark: SparkSession, dataset: str, table: str | DataFrame = POLICY_TABLE, limit: int | None = None
) -> list[Rule]:
    """The rules that the policy table holds for a dataset; more than ``limit`` raise."""
    return rules_from_policies(load_policies(spark, dataset, table, limit))


def _as_frame(spark: SparkSession, table: str | DataFrame) -> DataFrame:
    return spark.table(table) if isinstance(table, str) else table
