"""Queries that write, and the streaming jobs.

Each runs its job into a new scratch folder and returns what the sinks then hold.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve.config import PipelineConfig
from rowsieve.operators.dedup import dedup_stream
from rowsieve.operators.route import read_once, route_batch, route_once
from rowsieve.plans.rules import rules_from_policies
from rowsieve.plans.schema import CORRUPT_RECORD, ColumnSpec
from rowsieve.plans.verdict import error_ids, with_verdict
from rowsieve.queries.common import SECONDS, SECONDS_SQL, scratch, table, verdict_sql, verdict_view
from rowsieve.queries.rules import COMBINED_VERDICT_SQL, checked_events, combined_rules, policy
from rowsieve.sinks.files import start_append
from rowsieve.sinks.tables import RouteSink, compact_batches
from rowsieve.streaming.bronze import start_bronze, start_bronze_split
from rowsieve.streaming.silver import await_end, register_silver, silver_schema, start_silver
from rowsieve.streaming.triggers import trigger_options

STREAM_COLUMNS = (
    ColumnSpec("eventId", "event_id", "long", True),
    ColumnSpec("applicationCode", "event_type", "string"),
    ColumnSpec("value", "value", "double"),
    ColumnSpec("eventTimestamp", "event_time", "timestamp", True),
)


def _routed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All checked events routed to two sinks, partitioned by application."""
    folder = scratch(spark, "route")
    events = checked_events(spark, sf_dir)
    valid = RouteSink(f"{folder}/valid", ("applicationCode",))
    error = RouteSink(f"{folder}/error", ("applicationCode",))
    route_batch(events, combined_rules(), valid, error)
    return valid.read(spark, events.schema), error.read(spark, with_verdict(events.schema))


def route_valid(spark, sf_dir):
    valid, _ = _routed(spark, sf_dir)
    return valid.select("event_id", "applicationCode", "label", "props", "value", "time_text")


def route_error(spark, sf_dir):
    _, error = _routed(spark, sf_dir)
    return verdict_view(error, "event_id", "applicationCode", "value", "time_text")


def route_one_pass(spark, sf_dir):
    """Both routes written by one job and read back side by side."""
    events = checked_events(spark, sf_dir)
    sink = RouteSink(scratch(spark, "once"), ("applicationCode",))
    route_once(events, combined_rules(), sink)
    valid, error = read_once(spark, sink, events.schema)
    columns = ("event_id", "applicationCode", "label", "value")
    return valid.select(
        *columns, F.lit("valid").alias("route"), F.lit("").alias("rule_ids")
    ).unionByName(
        error.select(*columns, F.lit("error").alias("route"), error_ids().alias("rule_ids"))
    )


def land_events(spark: SparkSession, sf_dir: str, folder: str, which: Column | None = None) -> None:
    """Write events as JSON lines in nested folders; error events arrive broken."""
    event = F.struct(
        "event_id",
        "event_type",
        "value",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_time"),
    )
    broken = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(", oops"))
    events = table(spark, sf_dir, "events")
    lines = (events if which is None else events.where(which)).select(
        F.when(F.col("event_type") == "error", broken).otherwise(F.to_json(event)).alias("line"),
        F.date_format("ts", "dd").alias("day"),
    )
    lines.write.mode("append").partitionBy("day").text(folder)


def config_in(folder: str, suffix: str) -> PipelineConfig:
    return PipelineConfig(
        columns=STREAM_COLUMNS,
        landing_path=f"{folder}/landing",
        bronze_path=f"{folder}/bronze",
        bronze_checkpoint=f"{folder}/checkpoints/bronze",
        silver_path=f"{folder}/silver",
        error_path=f"{folder}/silver_error",
        silver_checkpoint=f"{folder}/checkpoints/silver",
        bronze_table=f"event_log_bronze_{suffix}",
        silver_table=f"event_log_silver_{suffix}",
        file_pattern="part-*.txt",
    )


def run_bronze(spark: SparkSession, sf_dir: str, purpose: str) -> PipelineConfig:
    folder = scratch(spark, purpose)
    config = config_in(folder, folder[-32:])
    land_events(spark, sf_dir, config.landing_path)
    # One object per line, so that Spark may split large files.
    await_end(start_bronze(spark, config, trigger_options(), multi_line=False))
    return config


def _or_minus_one(name: str) -> Column:
    """Malformed lines have no numbers."""
    return F.coalesce(F.col(name), F.lit(-1)).alias(name)


def stream_bronze(spark, sf_dir):
    config = run_bronze(spark, sf_dir, "bronze")
    bronze = spark.table(config.bronze_name)
    return bronze.select(
        _or_minus_one("event_id"),
        "event_type",
        _or_minus_one("value"),
        "event_time",
        F.col(CORRUPT_RECORD).alias("malformed"),
        F.col("source_filename").rlike("/day=[0-9]+/part-[^/]*[.]txt$").alias("from_landing"),
        (F.col("ingestion_date") == F.col("ingestion_timestamp").cast("date")).alias("dated"),
    )


def silver_rules():
    return rules_from_policies(
        [
            policy("B0", "well_formed", CORRUPT_RECORD, "malformed input"),
            policy("B1", "allowed_values", "applicationCode", "unknown type", {"values": '["click", "purchase", "view"]'}),
            policy("B2", "not_null", "eventTimestamp", "no time"),
            policy("B3", "regex_pattern", "event_time", "whole minute", {"pattern": ":[0-5][1-9][.]"}, exclude=["view"]),
        ]
    )


def stream_silver(spark, sf_dir):
    """Bronze to silver; the valid and the error route side by side."""
    config = run_bronze(spark, sf_dir, "silver")
    await_end(start_silver(spark, config, silver_rules()))
    return _silver_routes(spark, config)


def stream_restart(spark, sf_dir):
    """Half of the events run through bronze and silver, then the others, by jobs that
    start again from their checkpoints."""
    folder = scratch(spark, "restart")
    config = config_in(folder, folder[-32:])
    for half in (0, 1):
        land_events(spark, sf_dir, config.landing_path, F.col("event_id") % 2 == half)
        await_end(start_bronze(spark, config, trigger_options(), multi_line=False))
        await_end(start_silver(spark, config, silver_rules()))
    return _silver_routes(spark, config)


def stream_silver_tables(spark, sf_dir):
    """Both routes of the silver job by their names in a database of their own."""
    folder = scratch(spark, "tables")
    config = replace(config_in(folder, "main"), database="routed_" + folder[-32:])
    land_events(spark, sf_dir, config.landing_path)
    await_end(start_bronze(spark, config, trigger_options(), multi_line=False))
    register_silver(spark, config)  # before there is any row
    await_end(start_silver(spark, config, silver_rules()))
    register_silver(spark, config)
    return side_by_side(spark.table(config.silver_name), spark.table(config.error_name))


def _silver_routes(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    schema = silver_schema(spark, config)
    valid = config.valid_sink().read(spark, schema)
    return side_by_side(valid, config.error_sink().read(spark, with_verdict(schema)))


def side_by_side(valid: DataFrame, error: DataFrame) -> DataFrame:
    columns = (
        _or_minus_one("eventId"),
        "applicationCode",
        _or_minus_one("value"),
        F.date_format("eventTimestamp", SECONDS).alias("eventTimestamp"),
        F.col("eventDate").cast("string").alias("eventDate"),
        "platform_type",
        F.col(CORRUPT_RECORD).alias("malformed"),
    )
    return valid.select(
        *columns, F.lit("valid").alias("route"), F.lit("").alias("rule_ids")
    ).unionByName(
        error.select(
            *columns,
            F.lit("error").alias("route"),
            error_ids().alias("rule_ids"),
        )
    )


def _land_documents(spark: SparkSession, sf_dir: str, config: PipelineConfig, broken: str) -> None:
    """All events as pretty-printed arrays over many lines, a thousand a file, with a
    broken file among them and a file of another name beside them."""
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_time")
    events = table(spark, sf_dir, "events").select(
        (F.col("event_id") / 1000).cast("int").alias("file"), F.struct("event_id", "event_type", "value", time).alias("event")
    )
    files = events.groupBy("file").agg(F.to_json(F.collect_list("event"), {"pretty": "true"}).alias("text"))
    broken = spark.createDataFrame([(-1, broken)], "file int, text string")
    # A row is a file, without a folder of its own, which the commit would move one by one.
    files.union(broken).select("text").write.option("maxRecordsPerFile", 1).text(config.landing_path)
    files.select("text").write.json(f"{config.landing_path}/other")


def _documents(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        _or_minus_one("event_id"),
        "event_type",
        _or_minus_one("value"),
        "event_time",
        F.col(CORRUPT_RECORD).isNotNull().alias("malformed"),
    )


def stream_bronze_documents(spark, sf_dir):
    """Objects over many lines by the reader that takes a file as one document."""
    folder = scratch(spark, "documents")
    config = config_in(folder, folder[-32:])
    _land_documents(spark, sf_dir, config, '[\n  {"event_id": 1,\n    oops')
    await_end(start_bronze(spark, config, trigger_options()))
    return _documents(spark.table(config.bronze_name))


def stream_bronze_split(spark, sf_dir):
    """The same by splits of files; of a broken file the good objects are kept."""
    folder = scratch(spark, "split")
    config = config_in(folder, folder[-32:])
    good = '[ {"event_id": -7, "event_type": "a } b",\n "value": 1}, {\n"event_id": -8}'
    _land_documents(spark, sf_dir, config, good + ', oops\n {"event_id": 1,\n    oops')
    await_end(start_bronze_split(spark, config))
    return _documents(spark.table(config.bronze_name))


def route_replay(spark, sf_dir):
    """The same batch routed twice, by rules that change where most rows belong."""
    folder = scratch(spark, "replay")
    events = checked_events(spark, sf_dir)
    valid = RouteSink(f"{folder}/valid", ("applicationCode",))
    error = RouteSink(f"{folder}/error", ("applicationCode",))
    first = rules_from_policies([policy("F1", "regex_pattern", "props", "odd", {"pattern": "[13579]\\}$"})])
    for rules in (first, combined_rules()):
        route_batch(events, rules, valid, error, batch_id=7)
    valid = valid.read(spark, events.schema).select("event_id", F.lit("valid").alias("route"))
    return valid.union(error.read(spark, with_verdict(events.schema)).select("event_id", F.lit("error").alias("route")))


def route_metrics(spark, sf_dir):
    """Observed row counts beside those of what was written, also with no error row."""
    events = checked_events(spark, sf_dir)
    never = rules_from_policies([policy("N1", "not_null", "event_id", "never")])
    rows = []
    for name, rules in (("mixed", combined_rules()), ("valid only", never)):
        folder = scratch(spark, "metrics")
        valid = RouteSink(f"{folder}/valid", ("applicationCode",))
        error = RouteSink(f"{folder}/error", ("applicationCode",))
        seen = route_batch(events, rules, valid, error)
        found = valid.read(spark, events.schema).count(), error.read(spark, with_verdict(events.schema)).count()
        rows.append((name, seen.valid, seen.error, *found))
    return spark.createDataFrame(rows, "batch string, valid long, error long, valid_written long, error_written long")


def compact_twice(spark, sf_dir):
    """All events in six batches; four of them compacted in two steps, the second twice."""
    folder = scratch(spark, "compact")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    source = RouteSink(f"{folder}/batches", ("event_type",))
    target = RouteSink(f"{folder}/compacted", ("event_type",))
    for batch in range(6):
        source.write_batch(events.where(F.col("event_id") % 6 == batch), batch)
    for up_to in (1, 3, 3):
        compact_batches(spark, source, target, events.schema, up_to)
    return target.read(spark, events.schema).union(source.read(spark, events.schema, after_batch=3))


def stream_dedup(spark, sf_dir):
    """All events streamed twice over, each kept once."""
    folder = scratch(spark, "dedup")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for copy in ("first", "second"):
        events.write.parquet(f"{folder}/in/copy={copy}")
    stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
    once = dedup_stream(stream, ["event_id"], "ts", "40 days").drop("copy")
    query = start_append(
        once, f"{folder}/out", f"{folder}/checkpoint", ("event_type",), trigger=trigger_options()
    )
    await_end(query)
    return spark.read.parquet(f"{folder}/out").select(
        "event_id", F.date_format("ts", SECONDS).alias("ts"), "user_id", "event_type", "value", "props"
    )


QUERIES = {
    f.__name__: f
    for f in (
        route_valid,
        route_error,
        route_one_pass,
        route_replay,
        route_metrics,
        compact_twice,
        stream_bronze,
        stream_bronze_documents,
        stream_bronze_split,
        stream_silver,
        stream_silver_tables,
        stream_restart,
        stream_dedup,
    )
}

_LANDED_SQL = f"""
SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
  CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
  CASE WHEN event_type <> 'error' THEN value END AS value,
  CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END AS event_time,
  CASE WHEN event_type <> 'error' THEN strftime(ts, '{SECONDS_SQL}') END AS parsed,
  CASE WHEN event_type = 'error' THEN '{{"event_id": ' || event_id || ', oops' END AS malformed
FROM events
"""
_SILVER_SQL = verdict_sql(
    _LANDED_SQL,
    ["event_id", "event_type", "value", "parsed", "malformed"],
    [
        ("B2", "no time", "parsed IS NULL"),
        ("B3", "whole minute", "event_type NOT IN ('view') AND NOT regexp_matches(event_time, ':[0-5][1-9][.]')"),
        ("B1", "unknown type", "event_type NOT IN ('click', 'purchase', 'view')"),
        ("B0", "malformed input", "malformed IS NOT NULL"),
    ],
)

SILVER_ROWS_SQL = (
    "SELECT coalesce(event_id, -1) AS eventId, event_type AS applicationCode, "
    "coalesce(value, -1) AS value, "
    "parsed AS eventTimestamp, left(parsed, 10) AS eventDate, event_type AS platform_type, malformed, "
    f"CASE WHEN is_valid THEN 'valid' ELSE 'error' END AS route, rule_ids FROM ({_SILVER_SQL})"
)

_DOCUMENTS_SQL = (
    "SELECT event_id, event_type, value, "
    "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS event_time, false AS malformed FROM events "
)

ORACLES = {
    "route_replay": f"SELECT event_id, CASE WHEN is_valid THEN 'valid' ELSE 'error' END AS route FROM ({COMBINED_VERDICT_SQL})",
    "route_metrics": "SELECT 'mixed' AS batch, count(*) FILTER (is_valid) AS valid, count(*) FILTER (NOT is_valid) AS error, "
    "count(*) FILTER (is_valid) AS valid_written, count(*) FILTER (NOT is_valid) AS error_written "
    f"FROM ({COMBINED_VERDICT_SQL}) UNION ALL SELECT 'valid only', count(*), 0, count(*), 0 FROM events",
    "compact_twice": "SELECT event_id, event_type, value FROM events",
    "stream_bronze_documents": _DOCUMENTS_SQL + "UNION ALL SELECT -1, NULL, -1, NULL, true",
    "stream_bronze_split": _DOCUMENTS_SQL + "UNION ALL SELECT -7, 'a } b', 1, NULL, false "
    "UNION ALL SELECT -8, NULL, -1, NULL, false UNION ALL SELECT -1, NULL, -1, NULL, true UNION ALL SELECT -1, NULL, -1, NULL, true",
    "stream_silver_tables": SILVER_ROWS_SQL,
    "stream_restart": SILVER_ROWS_SQL,
    "route_valid": "SELECT event_id, applicationCode, label, props, value, time_text "
    f"FROM ({COMBINED_VERDICT_SQL}) WHERE is_valid",
    "route_error": "SELECT event_id, applicationCode, value, time_text, is_valid, rule_ids, messages "
    f"FROM ({COMBINED_VERDICT_SQL}) WHERE NOT is_valid",
    "route_one_pass": "SELECT event_id, applicationCode, label, value, "
    f"CASE WHEN is_valid THEN 'valid' ELSE 'error' END AS route, rule_ids FROM ({COMBINED_VERDICT_SQL})",
    "stream_bronze": "SELECT coalesce(event_id, -1) AS event_id, event_type, "
    "coalesce(value, -1) AS value, event_time, malformed, "
    f"true AS from_landing, true AS dated FROM ({_LANDED_SQL})",
    "stream_silver": SILVER_ROWS_SQL,
    "stream_dedup": f"SELECT event_id, strftime(ts, '{SECONDS_SQL}') AS ts, user_id, event_type, "
    "value, props FROM events",
}
