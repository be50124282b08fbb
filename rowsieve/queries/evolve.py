"""Queries over schemas that change and rows that come late.

As in :mod:`rowsieve.queries.jobs`, each runs its job into a new scratch folder.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from rowsieve.plans.schema import ColumnSpec
from rowsieve.plans.verdict import with_verdict
from rowsieve.queries.common import SECONDS, SECONDS_SQL, scratch, table
from rowsieve.queries.jobs import SILVER_ROWS_SQL, config_in, land_events, side_by_side, silver_rules
from rowsieve.sinks.generations import read_widened, register_widened
from rowsieve.sinks.tables import RouteSink, ensure_database
from rowsieve.sources.metadata import registered_schema, schema_registry
from rowsieve.streaming.bronze import start_bronze
from rowsieve.streaming.late import SeenKeys, start_dedup_late
from rowsieve.streaming.silver import await_end, silver_schema, start_silver
from rowsieve.streaming.triggers import trigger_options

_DECLARED = (
    ColumnSpec("eventId", "event_id", "string", True),
    ColumnSpec("applicationCode", "event_type", "string"),
    ColumnSpec("eventTimestamp", "event_time", "timestamp", True),
)
_VERSIONS = (
    {"eventId": "integer", "applicationCode": "string", "eventTimestamp": "timestamp"},
    {"eventId": "long", "applicationCode": "string", "value": "double", "eventTimestamp": "timestamp"},
)


def _registry(spark, active: int):
    return schema_registry(
        spark,
        [
            {
                "schema_id": f"S{i}",
                "dataset_name": "event_log",
                "version": i,
                "schema_json": {"type": "struct", "fields": [{"name": n, "type": t} for n, t in fields.items()]},
                "is_active": i == active,
            }
            for i, fields in enumerate(_VERSIONS)
        ],
    )


def registry_evolution(spark, sf_dir):
    """Half of the events under the registry's first schema, the others under its second,
    which has a wider id and one column more; both halves read back as one table."""
    folder = scratch(spark, "evolution")
    declared = replace(config_in(folder, folder[-32:]), columns=_DECLARED, keep_schemas=True)
    for version in (0, 1):
        config = declared.with_schema(registered_schema(spark, "event_log", _registry(spark, version)))
        land_events(spark, sf_dir, config.landing_path, F.col("event_id") % 2 == version)
        await_end(start_bronze(spark, config, trigger_options(), multi_line=False))
        await_end(start_silver(spark, config, silver_rules()))
    schema = silver_schema(spark, config)
    valid = read_widened(spark, config.valid_sink(), schema)
    return side_by_side(valid, read_widened(spark, config.error_sink(), with_verdict(schema)))


def silver_widened(spark, sf_dir):
    """All events in three batches: users as integers, as longs, and as text beside a new
    column; read back by path and by name."""
    folder = scratch(spark, "widened")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value", "props")
    sink = RouteSink(f"{folder}/rows", ("event_type",), keep_schema=True)
    for batch, kind in enumerate(("int", "long", "string")):
        rows = events.where(F.col("event_id") % 3 == batch).withColumn("user_id", F.col("user_id").cast(kind))
        sink.write_batch(rows if batch == 2 else rows.drop("props"), batch)
    database = "widened_" + folder[-32:]
    ensure_database(spark, database)
    register_widened(spark, f"{database}.events", sink)
    found = read_widened(spark, sink).withColumn("how", F.lit("path"))
    return found.unionByName(spark.table(f"{database}.events").withColumn("how", F.lit("name")))


def stream_dedup_late(spark, sf_dir):
    """The later half of the events streamed first, then all events twice over: the first
    half comes weeks late and is kept, copies as late are not."""
    folder = scratch(spark, "late")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    sink = RouteSink(f"{folder}/out", ("event_type",))
    seen = SeenKeys("seen_" + folder[-32:], f"{folder}/seen", 16)
    for step, rows in enumerate((events.where(F.dayofmonth("ts") > 15), events.union(events), events)):
        rows.write.parquet(f"{folder}/in/step={step}")
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in").drop("step")
        await_end(start_dedup_late(stream, ["event_id"], sink, seen, f"{folder}/checkpoint"))
        seen.compact(spark, step)
    return sink.read(spark, events.schema).select(
        "event_id", F.date_format("ts", SECONDS).alias("ts"), "user_id", "event_type", "value", "props"
    )


QUERIES = {f.__name__: f for f in (registry_evolution, silver_widened, stream_dedup_late)}

ORACLES = {
    "registry_evolution": "SELECT * REPLACE (CASE WHEN eventId % 2 = 0 THEN -1 ELSE value END AS value) "
    f"FROM ({SILVER_ROWS_SQL})",
    "silver_widened": "SELECT event_id, event_type, cast(user_id AS varchar) AS user_id, value, "
    "CASE WHEN event_id % 3 = 2 THEN props END AS props, how FROM events CROSS JOIN (VALUES ('path'), ('name')) t(how)",
    "stream_dedup_late": f"SELECT event_id, strftime(ts, '{SECONDS_SQL}') AS ts, user_id, event_type, value, props FROM events",
}
