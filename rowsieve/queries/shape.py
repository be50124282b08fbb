"""Queries over mapping, flattening, registry and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsieve.operators.dedup import dedup
from rowsieve.operators.flatten import flatten
from rowsieve.operators.standardize import (
    add_event_date,
    add_platform,
    enrich_ingestion,
    parse_timestamp,
    rename_present,
    standardize,
)
from rowsieve.plans.schema import ColumnSpec, source_schema
from rowsieve.queries.common import SECONDS, SECONDS_SQL, scratch, table
from rowsieve.sinks.tables import overwrite_table
from rowsieve.sources.metadata import active_schema, schema_registry

EVENT_COLUMNS = [
    ColumnSpec("eventId", "event_id", "long", True),
    ColumnSpec("userId", "user_id", "long"),
    ColumnSpec("applicationCode", "event_type", "string"),
    ColumnSpec("value", "value", "double"),
    ColumnSpec("props", "props", "string"),
]


def bronze_enrich(spark, sf_dir):
    table(spark, sf_dir, "events")
    raw = spark.read.schema(source_schema(EVENT_COLUMNS)).parquet(f"{sf_dir}/events.parquet")
    bronze = enrich_ingestion(raw, F.lit("2024-02-01 12:30:00").cast("timestamp"))
    return bronze.select(
        *[c.source for c in EVENT_COLUMNS],
        F.date_format("ingestion_timestamp", SECONDS).alias("ingestion_timestamp"),
        F.substring_index("source_filename", "/", -1).alias("source_filename"),
        F.col("ingestion_date").cast("string").alias("ingestion_date"),
    )


def raw_events(spark, sf_dir):
    """Events as they would land: time as text, some of it malformed."""
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    time = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(text)
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", time.alias("event_time")
    )


def standardize_events(spark, sf_dir):
    specs = [*EVENT_COLUMNS[:3], ColumnSpec("eventTimestamp", "event_time", "timestamp")]
    return standardize(raw_events(spark, sf_dir), specs).select(
        "eventId",
        "userId",
        "applicationCode",
        "event_time",
        F.date_format("eventTimestamp", SECONDS).alias("eventTimestamp"),
        F.col("eventDate").cast("string").alias("eventDate"),
        "platform_type",
    )


def rename_present_only(spark, sf_dir):
    names = {"event_id": "eventId", "user_id": "userId", "no_such": "x", "event_time": "eventTimestamp"}
    df = add_event_date(parse_timestamp(rename_present(raw_events(spark, sf_dir), names)))
    return df.select(
        "eventId",
        "userId",
        "event_type",
        F.date_format("eventTimestamp", SECONDS).alias("eventTimestamp"),
        F.col("eventDate").cast("string").alias("eventDate"),
    )


def platform_token(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return add_platform(orders, "o_orderpriority").select("o_orderkey", "platform_type")


def registry_active_schema(spark, sf_dir):
    """The registered schema of the props document, used to read it from all events."""

    def version(number, active, *fields):
        return {
            "schema_id": f"SCH_{number}",
            "dataset_name": "event_props",
            "version": number,
            "schema_json": {"fields": [{"name": n, "type": t} for n, t in fields]},
            "is_active": active,
        }

    entries = [
        version(1, True, ("k", "string")),
        version(2, True, ("k", "integer"), ("tags", {"type": "array", "elementType": "string"})),
        version(3, False, ("other", "string")),
    ]
    folder = scratch(spark, "registry")
    name = "meta_schema_registry_" + folder[-32:]
    overwrite_table(schema_registry(spark, entries), name, folder)
    schema = active_schema(spark, "event_props", name)
    spark.sql(f"DROP TABLE {name}")
    events = table(spark, sf_dir, "events")
    parsed = events.select("event_id", F.from_json("props", schema).alias("props"))
    return parsed.select(
        "event_id", "props.k", F.coalesce(F.size("props.tags"), F.lit(-1)).alias("n_tags")
    )


def flatten_struct(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    nested = events.select("event_id", F.from_json("props", "k int").alias("props"))
    return flatten(nested)


def flatten_array(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return flatten(vectors).select("vec_id", F.col("embedding").cast("double").alias("embedding"))


def flatten_two_arrays(spark, sf_dir):
    """Per turn, the sentence lengths with each role letter: two arrays and a struct."""
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.transform(
            F.split("text", r"\. "), lambda s: F.struct(F.length(s).alias("chars"))
        ).alias("sentence"),
        F.split("role", "").alias("letter"),
    )
    return flatten(turns)


def dedup_pk(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    twice = documents.unionAll(documents)
    return dedup(twice, ["doc_id", "text", "lang", "source", "n_chars"])


def dedup_pk_first(spark, sf_dir):
    """The first event of each user and type, by time."""
    events = table(spark, sf_dir, "events")
    first = dedup(events, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")])
    return first.select("user_id", "event_type", "event_id", "value")


def dedup_unkeyed(spark, sf_dir):
    """All events twice over without a key, many differing in a map only."""
    entry = F.create_map(F.col("event_type"), F.col("event_id"))
    rows = table(spark, sf_dir, "events").select(F.lit(None).cast("long").alias("key"), "user_id", entry.alias("entry"))
    once = dedup(rows.unionAll(rows), ["key"])
    return once.select("user_id", F.explode("entry").alias("event_type", "event_id"))


QUERIES = {
    f.__name__: f
    for f in (
        bronze_enrich,
        standardize_events,
        rename_present_only,
        platform_token,
        registry_active_schema,
        flatten_struct,
        flatten_array,
        flatten_two_arrays,
        dedup_pk,
        dedup_pk_first,
        dedup_unkeyed,
    )
}

_TIME_SQL = (
    f"CASE WHEN event_type <> 'error' THEN strftime(ts, '{SECONDS_SQL}') END AS \"eventTimestamp\", "
    "CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END AS \"eventDate\""
)

ORACLES = {
    "bronze_enrich": "SELECT event_id, user_id, event_type, value, props, "
    "'2024-02-01 12:30:00.000000' AS ingestion_timestamp, 'events.parquet' AS source_filename, "
    "'2024-02-01' AS ingestion_date FROM events",
    "standardize_events": "SELECT event_id AS eventId, user_id AS userId, event_type AS applicationCode, "
    "CASE WHEN event_type = 'error' THEN 'not a time' "
    "ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END AS event_time, "
    f"{_TIME_SQL}, string_split(event_type, '-')[1] AS platform_type FROM events",
    "rename_present_only": f"SELECT event_id AS eventId, user_id AS userId, event_type, {_TIME_SQL} FROM events",
    "platform_token": "SELECT o_orderkey, string_split(o_orderpriority, '-')[1] AS platform_type FROM orders",
    "registry_active_schema": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, "
    "-1 AS n_tags FROM events",
    "flatten_struct": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS props_k FROM events",
    "flatten_array": "SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS embedding FROM embeddings",
    "flatten_two_arrays": "WITH s AS (SELECT conv_id, turn, role, unnest(string_split(text, '. ')) AS sentence "
    "FROM conversations), l AS (SELECT conv_id, turn, sentence, unnest(string_split(role, '')) AS letter FROM s) "
    "SELECT conv_id, turn, letter, CAST(length(sentence) AS INTEGER) AS sentence_chars FROM l",
    "dedup_pk": "SELECT DISTINCT doc_id, text, lang, source, n_chars FROM documents",
    "dedup_unkeyed": "SELECT user_id, event_type, event_id FROM events",
    "dedup_pk_first": "SELECT user_id, event_type, event_id, value FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1",
}
