"""The bronze and silver jobs, end to end on small landing folders."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from rowsieve.config import PipelineConfig
from rowsieve.operators import dedup_stream, read_once, standardize
from rowsieve.plans.rules import Rule
from rowsieve.plans.schema import CORRUPT_RECORD
from rowsieve.plans.schema import column_specs, source_schema
from rowsieve.sinks import start_append
from rowsieve.sources import dq_policies, load_rules, read_landing, stream_landing
from rowsieve.streaming import (
    await_end,
    register_silver,
    start_bronze,
    start_routing,
    start_routing_once,
    start_silver,
    trigger_options,
)

COLUMNS = column_specs(
    [
        {"targetName": "signInId", "sourceName": "signInID", "type": "string", "isPk": True},
        {"targetName": "applicationCode", "sourceName": "applicationID", "type": "string", "isPk": True},
        {"targetName": "eventTimestamp", "sourceName": "eventDateTimestamp", "type": "timestamp", "isPk": True},
        {"targetName": "viewedFieldNames", "sourceName": "viewedField", "type": "array<string>", "isPk": True},
    ]
)
RULES = [
    Rule("JSON", "well_formed", CORRUPT_RECORD, {}, "malformed"),
    Rule("ID", "not_null", "signInId", {}, "no id"),
    Rule("TIME", "not_null", "eventTimestamp", {}, "no time"),
    Rule("ATM", "regex_pattern", "signInId", {"pattern": "^[0-9]+$"}, "bad id", None, ("ATM-Interface",)),
]


def event(sign_in, app="Web-Portal", time="2024-01-02T03:04:05.123456+00:00", fields=("a",), **more):
    return {"signInID": sign_in, "applicationID": app, "eventDateTimestamp": time, "viewedField": list(fields), **more}


def land(config, name, content):
    path = os.path.join(config.landing_path, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path + ".tmp", "w") as f:
        f.write(content if isinstance(content, str) else json.dumps(content, indent=4))
    os.rename(path + ".tmp", path)


@pytest.fixture
def config(spark, tmp_path):
    name = "job_" + tmp_path.name.replace("-", "_")
    at = lambda p: f"{tmp_path}/{p}"
    os.makedirs(at("landing"))
    return PipelineConfig(
        tuple(COLUMNS), at("landing"), at("bronze"), at("ck/bronze"), at("silver"), at("error"), at("ck/silver"),
        "jobs_test", f"bronze_{name}", f"silver_{name}",
    )


def bronze(spark, config, **options):
    assert await_end(start_bronze(spark, config, trigger_options(), **options), 120)


def silver(spark, config, rules=RULES, **options):
    assert await_end(start_silver(spark, config, rules, **options), 120)


def held(spark, config):
    valid = config.valid_sink().read(spark).collect() if os.path.exists(config.silver_path) else []
    error = config.error_sink().read(spark).collect() if os.path.exists(config.error_path) else []
    return sorted(r.signInId for r in valid), sorted((r.signInId or "", [e.rule_id for e in r.dq_errors]) for r in error)


def test_bronze(spark, config):
    land(config, "2024/01/02/03/data_stream_1.json", [event("1"), event("2", extra=5)])
    land(config, "2024/01/02/04/data_stream_2.json", [{"signInID": "3"}])
    land(config, "2024/01/02/04/data_stream_3.json", '[{"signInID": "4", oops')
    land(config, "2024/01/02/04/data_stream_4.json", "[]")
    land(config, "2024/01/02/04/other_5.json", [event("no")])
    bronze(spark, config)
    rows = spark.table(config.bronze_name)
    assert set(rows.columns) == {
        "signInID", "applicationID", "eventDateTimestamp", "viewedField", CORRUPT_RECORD,
        "ingestion_timestamp", "source_filename", "ingestion_date",
    }
    got = {r.signInID: r for r in rows.collect()}
    assert set(got) == {"1", "2", "3", None}
    assert got["1"].viewedField == ["a"] and got["3"].applicationID is None
    assert got[None][CORRUPT_RECORD].startswith('[{"signInID": "4"')
    assert got["1"].source_filename.endswith("/2024/01/02/03/data_stream_1.json")
    assert got["1"].ingestion_date == dt.datetime.now(dt.timezone.utc).date()
    assert any(d.startswith("ingestion_date=") for d in os.listdir(config.bronze_path))

    bronze(spark, config)  # a restart adds nothing
    assert spark.table(config.bronze_name).count() == 4
    land(config, "2024/01/02/05/data_stream_6.json", [event("6")])
    bronze(spark, config)
    spark.catalog.refreshTable(config.bronze_name)
    assert spark.table(config.bronze_name).count() == 5


def test_silver(spark, config):
    land(config, "a/data_stream_1.json", [event("1"), event("x"), event("y", "ATM-Interface"), event(None), event("5", time="never")])
    land(config, "a/data_stream_2.json", "{ not json")
    bronze(spark, config)
    seen = []
    silver(spark, config, on_batch=lambda i, m: seen.append((i, m.valid, m.error)))
    assert seen == [(0, 2, 4)]
    expected = (
        ["1", "y"],
        [("", ["ID"]), ("", ["JSON", "ID", "TIME"]), ("5", ["TIME"]), ("x", ["ATM"])],
    )
    assert held(spark, config) == expected
    valid = config.valid_sink().read(spark)
    row = valid.filter("signInId = '1'").head()
    assert row.eventDate == dt.date(2024, 1, 2) and row.platform_type == "Web"
    assert "dq_errors" not in valid.columns and "source_filename" in valid.columns

    silver(spark, config)
    assert held(spark, config) == expected
    register_silver(spark, config)
    assert spark.table(config.silver_name).count() == 2
    assert spark.table(config.error_name).filter("not is_valid").count() == 4
    land(config, "b/data_stream_3.json", [event("7")])
    bronze(spark, config)
    silver(spark, config)
    register_silver(spark, config)
    assert spark.table(config.silver_name).count() == 3
    assert held(spark, config) == (["1", "7", "y"], expected[1])


def test_replayed_batch_is_not_written_twice(spark, config):
    """A crash after the writes but before the commit: the batch runs again."""
    land(config, "a/data_stream_1.json", [event("1"), event("x")])
    bronze(spark, config)
    silver(spark, config)
    commits = f"{config.silver_checkpoint}/commits"
    before = held(spark, config)
    for name in ("0", ".0.crc"):
        os.remove(f"{commits}/{name}")
    ran = []
    silver(spark, config, on_batch=lambda i, m: ran.append(i))
    assert ran == [0]
    assert held(spark, config) == before == (["1"], [("x", ["ATM"])])


def test_both_routes_in_one_dataset(spark, config):
    land(config, "a/data_stream_1.json", [event("1"), event("x"), event(None)])
    bronze(spark, config)
    stream = standardize(spark.readStream.table(config.bronze_name), COLUMNS)
    sink, seen = config.valid_sink(), []
    for _ in range(2):
        query = start_routing_once(
            stream, RULES, sink, config.silver_checkpoint, on_batch=lambda i, m: seen.append((i, m.valid, m.error))
        )
        assert await_end(query, 120)
    assert seen == [(0, 1, 2)]
    valid, error = read_once(spark, sink, stream.schema)
    assert [r.signInId for r in valid.collect()] == ["1"]
    assert sorted(e.rule_id for r in error.collect() for e in r.dq_errors) == ["ATM", "ID"]


def test_rules_reloaded_for_each_batch(spark, config):
    policies = [
        {"policy_id": "P", "dataset_name": "log", "rule_type": "min_length", "target_column": "signInId", "rule_params": {"length": n}}
        for n in (1, 5)
    ]
    tables = [dq_policies(spark, [p]) for p in policies]
    calls = []

    def current(session):
        calls.append(len(calls))
        return load_rules(session, "log", tables[min(calls[-1], 1)])

    land(config, "a/data_stream_1.json", [event("11")])
    land(config, "a/data_stream_2.json", [event("22")])
    bronze(spark, config, max_files_per_trigger=1)
    silver(spark, config, current, source_options={"maxFilesPerTrigger": "1"})
    assert len(calls) == 2
    valid, error = held(spark, config)
    assert len(valid) == 1 and [ids for _, ids in error] == [["P"]]


def test_continuous_trigger(spark, config):
    assert trigger_options() == {"availableNow": True}
    assert trigger_options("processingTime") == {"processingTime": "5 seconds"}
    land(config, "a/data_stream_1.json", [event("1")])
    bronze(spark, config)
    source = spark.readStream.table(config.bronze_name)
    query = start_routing(
        standardize(source, COLUMNS), RULES, config.valid_sink(), config.error_sink(), config.silver_checkpoint,
        trigger_options("always", "1 second"),
    )
    try:
        query.processAllAvailable()
        assert not await_end(query, 0.2)
        assert held(spark, config)[0] == ["1"]
    finally:
        query.stop()


def test_default_trigger_and_plain_path(spark, config):
    land(config, "data_stream_1.json", [event("1")])
    stream = stream_landing(spark, config.landing_path, source_schema(COLUMNS))
    query = start_append(stream.withColumn("day", F.lit("d")), config.bronze_path, config.bronze_checkpoint, ("day",))
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(config.bronze_path).count() == 1


def test_archive_consumed_files(spark, config, tmp_path):
    archive = f"{tmp_path}/archive"
    for i in range(3):
        land(config, f"2024/data_stream_{i}.json", [event(str(i))])
        stream = stream_landing(spark, config.landing_path, source_schema(COLUMNS), archive_path=archive)
        query = start_append(
            stream, config.bronze_path, config.bronze_checkpoint, (), trigger=trigger_options(),
            options={},
        )
        assert await_end(query, 120)
    assert spark.read.parquet(config.bronze_path).count() == 3
    moved = [f for _, _, names in os.walk(archive) for f in names if f.endswith(".json")]
    left = [f for _, _, names in os.walk(config.landing_path) for f in names if f.endswith(".json")]
    assert len(moved) >= 1 and sorted(moved + left) == [f"data_stream_{i}.json" for i in range(3)]


def test_batch_reader_reads_lines_and_documents(spark, config):
    land(config, "a/data_stream_1.json", [event("1"), event("2")])
    schema = source_schema(COLUMNS, CORRUPT_RECORD)
    rows = read_landing(spark, config.landing_path, schema, corrupt_column=CORRUPT_RECORD)
    assert [r[CORRUPT_RECORD] for r in rows.collect()] == [None, None]
    land(config, "b/lines_1.json", "\n".join(json.dumps(event(str(i))) for i in range(5)))
    lines = read_landing(spark, config.landing_path, schema, name_pattern="lines_*", multi_line=False)
    assert lines.count() == 5
    flat = read_landing(spark, config.landing_path, schema, recursive=False)
    assert flat.count() == 0


@pytest.mark.parametrize("salts", [1, 16])
def test_stream_dedup_keeps_one_row_per_key(spark, config, salts):
    land(config, "a/data_stream_1.json", [event("1"), event("1"), event("2"), event("3", time=None)])
    land(config, "a/data_stream_2.json", [event("1"), event("2", fields=("b",)), event("3", time="bad"), event("3", time=None)])
    land(config, "a/data_stream_3.json", "{ broken")
    land(config, "a/data_stream_4.json", "{ broken too")
    for i in range(5, 12):  # a hot key, delivered again and again
        land(config, f"b/data_stream_{i}.json", [event("1")] * 3)
    bronze(spark, config, max_files_per_trigger=4)
    keys = ["signInId", "applicationCode", "eventTimestamp", "viewedFieldNames"]
    once = lambda df: dedup_stream(standardize(df, COLUMNS), keys, "eventTimestamp", "1 hour", salts)
    silver(spark, config, [], transform=once, source_options={"maxFilesPerTrigger": "1"})
    rows = config.valid_sink().read(spark).collect()
    keyed = sorted((r.signInId, r.viewedFieldNames) for r in rows if r.eventTimestamp)
    assert keyed == [("1", ["a"]), ("2", ["a"]), ("2", ["b"])]
    # Without an event time there is no state: one row per micro-batch, and none lost.
    assert sum(r.signInId == "3" for r in rows) in (1, 2)
    assert sorted(r[CORRUPT_RECORD] for r in rows if not r.signInId) == ["{ broken", "{ broken too"]
