"""Routing, replay safety, schema growth, compaction and catalog tables."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowsieve.operators import read_once, route_batch, route_once
from rowsieve.plans.rules import Rule
from rowsieve.plans.verdict import with_verdict
from rowsieve.sinks import RouteSink, append_table, compact_batches, ensure_database, register_route

RULES = [Rule("N", "not_null", "v", {}, "missing"), Rule("L", "min_length", "v", {"length": 2}, "short")]
SCHEMA = StructType().add("id", "integer").add("v", "string").add("eventDate", "date")


def batch(spark, *rows):
    return spark.createDataFrame(rows, "id int, v string, d string").select(
        "id", "v", F.col("d").cast("date").alias("eventDate")
    )


@pytest.fixture
def sinks(tmp_path):
    return RouteSink(f"{tmp_path}/valid"), RouteSink(f"{tmp_path}/error")


def held(spark, sinks):
    valid = sinks[0].read(spark, SCHEMA).collect()
    error = sinks[1].read(spark, with_verdict(SCHEMA)).collect()
    return sorted(r.id for r in valid), sorted(r.id for r in error)


GOOD = ((1, "ok", "2024-01-01"), (2, "fine", "2024-01-02"))
BAD = ((3, None, "2024-01-01"), (4, "x", None))


@pytest.mark.parametrize("cached", [True, False])
def test_each_row_goes_to_one_route(spark, sinks, cached):
    options = {} if cached else {"storage": None}
    metrics = route_batch(batch(spark, *GOOD, *BAD), RULES, *sinks, batch_id=0, **options)
    assert (metrics.valid, metrics.error, metrics.total) == (2, 2, 4)
    assert held(spark, sinks) == ([1, 2], [3, 4])
    valid = sinks[0].read(spark)
    assert valid.columns == ["id", "v", "eventDate"]
    error = {r.id: r for r in sinks[1].read(spark).collect()}
    assert [e.rule_id for e in error[3].dq_errors] == ["N"] and error[3].is_valid is False
    assert error[4].eventDate is None
    assert os.path.isdir(f"{sinks[0].path}/_stream_id=main/_batch_id=0/eventDate=2024-01-02")


def test_both_routes_in_one_pass(spark, tmp_path):
    sink = RouteSink(f"{tmp_path}/both")
    for rows in ((*GOOD, *BAD), (*GOOD, BAD[0])):
        metrics = route_once(batch(spark, *rows), RULES, sink, batch_id=3)
        assert (metrics.valid, metrics.error) == (2, len(rows) - 2)
        valid, error = read_once(spark, sink, SCHEMA)
        assert valid.columns == SCHEMA.names
        assert sorted(tuple(r) for r in valid.collect()) == sorted(tuple(r) for r in batch(spark, *GOOD).collect())
        assert {r.id: [e.rule_id for e in r.dq_errors] for r in error.collect()} == {
            r[0]: ["N" if r[1] is None else "L"] for r in rows[2:]
        }
    assert "PartitionFilters: [isnotnull(is_valid" in valid._jdf.queryExecution().executedPlan().toString()


def test_nothing_stays_cached(spark, sinks):
    df = batch(spark, *GOOD)
    route_batch(df, RULES, *sinks)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
    with pytest.raises(Exception):
        route_batch(df.withColumn("v", F.raise_error(F.lit("boom"))), RULES, *sinks, batch_id=1)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_an_empty_error_route_is_not_written(spark, sinks):
    assert route_batch(batch(spark, *GOOD), RULES, *sinks).error == 0
    assert not os.path.exists(sinks[1].path)
    assert held(spark, sinks) == ([1, 2], [])


@pytest.mark.parametrize(
    "again",
    [
        (*GOOD, *BAD),
        GOOD,
        BAD,
        (GOOD[0],),
        ((1, None, "2024-01-05"), (3, "good now", "2024-01-06")),
        (),
    ],
    ids=["same", "no errors", "only errors", "fewer partitions", "rows change route", "empty"],
)
def test_replay_replaces_the_batch(spark, sinks, again):
    route_batch(batch(spark, (9, "other", "2024-01-01")), RULES, *sinks, batch_id=6)
    route_batch(batch(spark, *GOOD, *BAD), RULES, *sinks, batch_id=7)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        route_batch(batch(spark, *again), RULES, *sinks, batch_id=7)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    is_good = lambda r: r[1] is not None and len(r[1]) >= 2
    assert held(spark, sinks) == (
        sorted([9] + [r[0] for r in again if is_good(r)]),
        sorted(r[0] for r in again if not is_good(r)),
    )


def test_streams_do_not_overwrite_each_other(spark, tmp_path):
    for stream in ("a", "b"):
        RouteSink(f"{tmp_path}/t", stream_id=stream).write_batch(batch(spark, *GOOD), 0)
    assert RouteSink(f"{tmp_path}/t").read(spark, SCHEMA).count() == 4


def test_read_before_the_first_batch(spark, sinks):
    assert sinks[0].read(spark, SCHEMA).schema.names == ["id", "v", "eventDate"]
    assert sinks[0].read(spark, SCHEMA).count() == 0


def test_schema_grows(spark, sinks):
    sinks[0].write_batch(batch(spark, *GOOD), 0)
    sinks[0].write_batch(batch(spark, *GOOD).withColumn("more", F.lit("new")), 1)
    rows = sinks[0].read(spark)
    assert set(rows.columns) == {"id", "v", "eventDate", "more"}
    assert sorted(str(r.more) for r in rows.collect()) == ["None", "None", "new", "new"]


def files_under(path):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_rebalance_splits_a_hot_partition(spark, tmp_path):
    sink = RouteSink(f"{tmp_path}/hot", layout="rebalance")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        days = F.when(F.col("id") % 10 < 9, F.lit("2024-01-01")).otherwise(
            F.concat(F.lit("2024-02-"), F.lpad((F.col("id") / 10 % 20 + 1).cast("int").cast("string"), 2, "0"))
        )
        rows = spark.range(200_000).select(
            F.col("id").cast("int"), F.sha2(F.col("id").cast("string"), 256).alias("v"), days.cast("date").alias("eventDate")
        )
        sink.write_batch(rows, 0)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert sink.read(spark, SCHEMA).count() == 200_000
    scattered = RouteSink(f"{tmp_path}/scattered")
    scattered.write_batch(rows, 0)
    assert 2 * len(files_under(sink.path)) < len(files_under(scattered.path))
    hot = [f for f in os.listdir(f"{sink.batch_path(0)}/eventDate=2024-01-01") if f.endswith(".parquet")]
    assert len(hot) > 1
    with pytest.raises(ValueError):
        RouteSink("p", layout="other")


def test_compaction(spark, tmp_path):
    source, target = RouteSink(f"{tmp_path}/many"), RouteSink(f"{tmp_path}/few")
    for i in range(4):
        source.write_batch(batch(spark, (i, "ok", "2024-01-01"), (10 + i, "ok", None)), i)
    for _ in range(2):
        compact_batches(spark, source, target, SCHEMA, up_to_batch=2)
    settled = target.read(spark, SCHEMA)
    assert sorted(r.id for r in settled.collect()) == [0, 1, 2, 10, 11, 12]
    rest = source.read(spark, SCHEMA, after_batch=2)
    assert sorted(r.id for r in settled.unionByName(rest).collect()) == [0, 1, 2, 3, 10, 11, 12, 13]
    assert len(settled.inputFiles()) == 2 < len(source.read(spark, SCHEMA).inputFiles())
    with pytest.raises(ValueError):
        compact_batches(spark, source, source, SCHEMA, 2)


def test_growing_compactions_take_each_batch_once(spark, tmp_path):
    source, target = RouteSink(f"{tmp_path}/many"), RouteSink(f"{tmp_path}/few")
    for i in range(5):
        source.write_batch(batch(spark, (i, "ok", "2024-01-01")), i)
    for up_to in (1, 3, 3):
        compact_batches(spark, source, target, SCHEMA, up_to_batch=up_to)
    assert sorted(r.id for r in target.read(spark, SCHEMA).collect()) == [0, 1, 2, 3]
    with pytest.raises(ValueError, match="already holds"):
        compact_batches(spark, source, target, SCHEMA, up_to_batch=2)
    compact_batches(spark, source, target, SCHEMA, up_to_batch=4, after_batch=3)
    assert sorted(r.id for r in target.read(spark, SCHEMA).collect()) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError, match="delta"):
        compact_batches(spark, source, RouteSink("p", format="delta"), SCHEMA, 4)


def test_catalog_table_over_a_route(spark, sinks):
    ensure_database(spark, "route_test")
    sinks[0].write_batch(batch(spark, *GOOD), 0)
    register_route(spark, "route_test.valid", sinks[0], SCHEMA)
    assert spark.table("route_test.valid").count() == 2
    sinks[0].write_batch(batch(spark, *GOOD).withColumn("more", F.lit(1)), 1)
    register_route(spark, "route_test.valid", sinks[0], StructType.fromDDL(SCHEMA.toDDL() + ", more int"))
    rows = spark.table("route_test.valid")
    assert rows.count() == 4 and rows.filter("more = 1").count() == 2
    one_day = rows.filter("eventDate = date'2024-01-02'")
    assert one_day.count() == 2
    assert "PartitionFilters: [isnotnull(eventDate" in one_day._jdf.queryExecution().executedPlan().toString()


def test_append_table(spark, tmp_path):
    ensure_database(spark, "route_test")
    for _ in range(2):
        append_table(batch(spark, *GOOD), "route_test.plain", f"{tmp_path}/plain")
    assert spark.table("route_test.plain").count() == 4
    assert os.path.isdir(f"{tmp_path}/plain/eventDate=2024-01-01")
    append_table(batch(spark, *GOOD).withColumn("more", F.lit(1)), "route_test.plain", f"{tmp_path}/plain")
    append_table(batch(spark, *GOOD), "route_test.plain", f"{tmp_path}/plain")
    rows = spark.table("route_test.plain")
    assert rows.count() == 8 and rows.filter("more = 1").count() == 2
