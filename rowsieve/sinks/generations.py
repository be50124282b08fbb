"""Routes whose batches have different schemas.

Parquet files are read under one schema, and a column that was written as another type
fails there. Batches with the same schema are one generation. Each generation is read
under its own schema, brought to a common one by casts and by name, and joined to the
others by a union; filters, columns and partition values reach the scan of each.

Which batches belong to a generation is known from the schemas that a sink with
``keep_schema=True`` writes beside its batches; for others, from one file's footer a batch.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowsieve.plans.evolution import conform_sql, widest_schema
from rowsieve.sinks.tables import BATCH_ID, SCHEMA, STREAM_ID, RouteSink, _with_batch_columns, batch_directories, register_route


@dataclass(frozen=True)
class Generation:
    """A schema and the batches written with it, as ``(stream, first, last)``."""

    schema: StructType
    runs: tuple[tuple[str, int, int], ...]

    def condition(self) -> Column:
        parts = [(F.col(STREAM_ID) == s) & F.col(BATCH_ID).between(first, last) for s, first, last in self.runs]
        return reduce(or_, parts)

    def condition_sql(self) -> str:
        parts = [f"({STREAM_ID} = {_text(s)} AND {BATCH_ID} BETWEEN {first} AND {last})" for s, first, last in self.runs]
        return " OR ".join(parts)


def generations(spark: SparkSession, sink: RouteSink) -> list[Generation]:
    """The generations of a route, in order of their first batch."""
    if sink.format == "delta":
        raise ValueError("format 'delta' keeps no batch directories")
    runs = _recorded(spark, sink)
    for stream, batch in sorted(set(batch_directories(spark, sink.path)) - set(batch_directories(spark, sink.path, SCHEMA))):
        try:
            found = spark.read.format(sink.format).options(**sink.options).load(replace(sink, stream_id=stream).batch_path(batch))
        except AnalysisException as e:
            # A batch without rows has no file that could tell.
            if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            continue
        runs.append((found.schema.json(), stream, batch, batch))
    by_schema: dict[str, list] = {}
    for text, *run in sorted(runs, key=lambda r: (r[2], r[1])):
        by_schema.setdefault(text, []).append(tuple(run))
    return [Generation(StructType.fromJson(json.loads(text)), tuple(r)) for text, r in by_schema.items()]


def _recorded(spark: SparkSession, sink: RouteSink) -> list[tuple[str, str, int, int]]:
    """Runs of consecutive recorded batches with one schema; as many as there were changes."""
    if not batch_directories(spark, sink.path, SCHEMA):
        return []
    records = spark.read.schema(f"value string, {STREAM_ID} string, {BATCH_ID} long").option("basePath", sink.path)
    rows = records.text(f"{sink.path}/{STREAM_ID}=*/{BATCH_ID}=*/{SCHEMA}")
    # Batches that lie between two others of a schema, but are not recorded, end its run.
    alike = Window.partitionBy(STREAM_ID, "value").orderBy(BATCH_ID)
    rows = rows.withColumn("step", F.col(BATCH_ID) - F.row_number().over(alike))
    runs = rows.groupBy("value", STREAM_ID, "step").agg(F.min(BATCH_ID).alias("first"), F.max(BATCH_ID).alias("last"))
    return [(r["value"], r[STREAM_ID], r["first"], r["last"]) for r in runs.collect()]


def read_widened(spark: SparkSession, sink: RouteSink, schema: StructType | None = None) -> DataFrame:
    """All rows of a route under one schema, by default the widest of its generations.

    With ``schema`` a value that its column's type does not take becomes NULL; the default
    takes every value, and raises where two generations have no such type.
    """
    found = generations(spark, sink)
    if not found and schema is None:
        raise ValueError(f"no batch under {sink.path}, so its schema has to be given")
    want = schema or widest_schema([g.schema for g in found])
    parts = [spark.createDataFrame([], want)]
    for g in found:
        rows = spark.read.format(sink.format).options(**sink.options).schema(_with_batch_columns(g.schema)).load(sink.path)
        parts.append(rows.filter(g.condition()).selectExpr(*conform_sql(g.schema, want)))
    return reduce(DataFrame.unionAll, parts[1:] or parts)


def register_widened(spark: SparkSession, name: str, sink: RouteSink, schema: StructType | None = None) -> None:
    """Make a route with several generations readable by name, or bring that up to date.

    Each generation is an external table of its own, ``name`` a view over them. A table of
    that name which only describes files elsewhere gives way to the view.
    """
    found = generations(spark, sink)
    if not found:
        raise ValueError(f"no batch under {sink.path} yet")
    want = schema or widest_schema([g.schema for g in found])
    selects = []
    for g in found:
        member = f"{name}__{hashlib.md5(g.schema.json().encode()).hexdigest()[:8]}"
        register_route(spark, member, sink, g.schema)
        selects.append(f"SELECT {', '.join(conform_sql(g.schema, want))} FROM {member} WHERE {g.condition_sql()}")
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "EXTERNAL":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {' UNION ALL '.join(selects)}")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
