"""Schemas, metadata tables, mapping, flattening and deduplication."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowsieve.config import PipelineConfig
from rowsieve.operators import (
    add_event_date,
    add_platform,
    dedup,
    flatten,
    map_columns,
    parse_timestamp,
    rename_present,
    standardize,
)
from rowsieve.plans.schema import ColumnSpec, column_specs, key_columns, schema_from_json, source_schema
from rowsieve.sinks import ensure_database, overwrite_table
from rowsieve.sources import active_schema, dq_policies, load_policies, load_rules, schema_registry

COLUMNS = column_specs(
    [
        {"targetName": "signInId", "sourceName": "signInID", "type": "string", "isPk": True},
        {"targetName": "applicationCode", "sourceName": "applicationID", "type": "string"},
        {"targetName": "eventTimestamp", "sourceName": "eventDateTimestamp", "type": "timestamp", "isPk": True},
        {"targetName": "viewedFieldNames", "sourceName": "viewedField", "type": "array<string>"},
        {"targetName": "n", "type": "integer"},
    ]
)


def test_source_schema(spark):
    schema = source_schema(COLUMNS, "_corrupt_record")
    assert schema.simpleString() == (
        "struct<signInID:string,applicationID:string,eventDateTimestamp:string,"
        "viewedField:array<string>,n:int,_corrupt_record:string>"
    )
    assert all(f.nullable for f in schema)
    assert key_columns(COLUMNS) == ["signInId", "eventTimestamp"]
    with pytest.raises(ValueError, match="colour"):
        source_schema([ColumnSpec("c", "c", "colour")])


def test_config_from_dictionary():
    document = {
        "storage": {"basePath": "store://box/"},
        "fileDetails": {"landingZonePath": "in", "archivePath": "old"},
        "rawZoneDeltaTableInformation": {"tableName": "b", "path": "bronze", "checkpoint": "ck/b"},
        "curatedDeltaTableInformation": {
            "tableName": "s", "path": "silver", "errorPath": "bad", "checkpoint": "ck/s", "partitionKeys": ["d"],
        },
        "columns": [{"targetName": "x", "type": "string", "isPk": True}],
    }
    config = PipelineConfig.from_dict(document, database="db")
    assert (config.landing_path, config.archive_path) == ("store://box/in", "store://box/old")
    assert (config.bronze_name, config.silver_name, config.error_name) == ("db.b", "db.s", "db.s_error")
    assert config.valid_sink("x").partition_keys == ("d",)
    assert config.trigger == "availableNow" and config.keys == ["x"]
    document["curatedDeltaTableInformation"]["writeMode"] = "overwrite"
    with pytest.raises(ValueError):
        PipelineConfig.from_dict(document)


RAW = "signInID string, applicationID string, eventDateTimestamp string, viewedField array<string>, n int, extra int"


def test_standardize(spark):
    df = spark.createDataFrame(
        [
            ("a", "Web-Banking-Portal", "2024-01-02T03:04:05.123456+00:00", ["x"], 1, 7),
            ("b", "ATM", "nonsense", None, None, 8),
            ("c", None, None, [], None, 9),
        ],
        RAW,
    )
    out = standardize(df, COLUMNS)
    assert out.columns == [
        "signInId", "applicationCode", "eventDateTimestamp", "viewedFieldNames", "n", "extra",
        "eventTimestamp", "eventDate", "platform_type",
    ]
    good, bad, empty = out.collect()
    assert good.eventTimestamp == dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    assert good.eventDate == dt.date(2024, 1, 2) and good.platform_type == "Web"
    assert bad.eventTimestamp is None and bad.eventDate is None and bad.platform_type == "ATM"
    assert empty.platform_type is None
    assert "eventDateTimestamp" not in map_columns(df, COLUMNS, keep_time_text=False).columns


def test_timestamp_under_its_own_name_is_replaced_in_place(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05", 1)], "t string, x int")
    out = map_columns(df, [ColumnSpec("t", "t", "timestamp")])
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [("t", "timestamp"), ("x", "int")]


def test_absent_columns_are_left_alone(spark):
    df = spark.createDataFrame([(1,)], "x int")
    for step in (parse_timestamp, add_event_date, add_platform):
        assert step(df).columns == ["x"]
    assert rename_present(df, {"x": "y", "no": "z"}).columns == ["y"]


def test_platform_equals_first_token(spark):
    texts = ["a-b-c", "-a", "a-", "-", "", "abc", None]
    df = spark.createDataFrame([(t,) for t in texts], "applicationCode string")
    rows = add_platform(df).withColumn("token", F.element_at(F.split("applicationCode", "-"), 1)).collect()
    assert [r.platform_type for r in rows] == [r.token for r in rows]


def test_registry(spark, tmp_path):
    def entry(schema_id, dataset, version, active, name):
        return {
            "schema_id": schema_id, "dataset_name": dataset, "version": version, "is_active": active,
            "schema_json": {"fields": [{"name": name, "type": {"type": "array", "elementType": "string"}}]},
        }

    rows = [
        entry("1", "one", 1, True, "a"), entry("2", "two", 1, True, "b"), entry("3", "two", 3, True, "c"),
        entry("4", "two", 4, False, "d"), entry("5", "off", 1, False, "e"),
    ]
    ensure_database(spark, "meta_test")
    overwrite_table(schema_registry(spark, rows), "meta_test.registry", f"{tmp_path}/registry")
    overwrite_table(schema_registry(spark, rows), "meta_test.registry", f"{tmp_path}/registry")
    assert spark.table("meta_test.registry").count() == 5
    assert active_schema(spark, "one", "meta_test.registry").simpleString() == "struct<a:array<string>>"
    assert active_schema(spark, "two", "meta_test.registry").names == ["c"]
    for dataset in ("off", "none"):
        with pytest.raises(LookupError, match=dataset):
            active_schema(spark, dataset, "meta_test.registry")


def test_schema_json_round_trip(spark):
    schema = StructType.fromDDL(
        "a int not null, b array<struct<c: map<string, array<int>>>>, d timestamp, e decimal(10,2)"
    )
    assert schema_from_json(schema.json()) == schema
    loose = '{"fields": [{"name": "m", "type": {"type": "map", "keyType": "string", "valueType": "long"}}]}'
    assert schema_from_json(loose) == StructType.fromDDL("m map<string, bigint>")


def test_policy_table(spark, monkeypatch):
    rows = [
        {
            "policy_id": f"P{i}", "dataset_name": name, "rule_type": "allowed_values", "target_column": "c",
            "rule_params": {"values": ["a", "b"]}, "app_scope_inclusion": scope,
        }
        for i, (name, scope) in enumerate([("one", ["ALL"]), ("two", None), ("one", ["web", "ALL"]), ("one", ["web"])])
    ]
    table = dq_policies(spark, rows)
    assert [r.policy_id for r in load_policies(spark, "one", table)] == ["P0", "P2", "P3"]
    rules = load_rules(spark, "one", table)
    assert [r.include for r in rules] == [None, None, ("web",)]
    assert rules[0].params == {"values": '["a", "b"]'}
    monkeypatch.setattr("rowsieve.sources.metadata.MAX_POLICIES", 2)
    assert len(load_policies(spark, "one", table, limit=3)) == 3
    with pytest.raises(ValueError, match="more than 2"):
        load_policies(spark, "one", table)


NESTED = "id int, a struct<b:int,c:struct<d:int>>, tags array<string>, items array<struct<sku:string,qty:array<int>>>, m map<string,int>"


def nested(spark, *rows):
    return spark.createDataFrame(rows, NESTED)


def test_flatten_everything(spark):
    df = nested(
        spark,
        (1, (10, (100,)), ["x", "y"], [("s", [1, 2]), ("t", [3])], {"k": 1}),
        (2, None, ["z"], [("u", [4])], None),
        (3, (11, None), [], [("v", [5])], None),
        (4, (12, None), None, [("w", [6])], None),
        (5, (13, None), ["q"], [("w", [])], None),
    )
    out = flatten(df)
    assert out.columns == ["id", "tags", "m", "a_b", "items_sku", "items_qty", "a_c_d"]
    assert out.schema["m"].dataType.simpleString() == "map<string,int>"
    got = sorted((r.id, r.a_b, r.a_c_d, r.tags, r.items_sku, r.items_qty) for r in out.filter("id = 1").collect())
    assert got == sorted((1, 10, 100, t, s, q) for t in "xy" for s, q in (("s", 1), ("s", 2), ("t", 3)))
    assert [tuple(r) for r in out.filter("id <> 1").select("id", "a_b", "items_qty").collect()] == [(2, None, 4)]


def test_flatten_outer_keeps_rows_without_elements(spark):
    df = nested(spark, (3, (1, None), [], None, None), (4, None, None, [("w", [])], None))
    rows = flatten(df, outer=True).collect()
    assert [(r.id, r.tags, r.items_sku, r.items_qty) for r in rows] == [(3, None, None, None), (4, None, "w", None)]


def test_flatten_chosen_columns_only(spark):
    df = nested(spark, (1, (10, (100,)), ["x", "y"], [("s", [1])], None))
    out = flatten(df, columns=["A", "tags"])
    assert out.columns == ["id", "tags", "items", "m", "a_b", "a_c_d"]
    assert out.count() == 2
    with pytest.raises(ValueError):
        flatten(df, columns=["nope"])


def test_flatten_name_clash(spark):
    df = spark.createDataFrame([(1, (2, 3))], "A_b int, a struct<b:int,c:int>")
    with pytest.raises(ValueError, match="a_b"):
        flatten(df)
    out = flatten(df, on_clash="overwrite")
    assert out.columns == ["a_b", "a_c"] and tuple(out.head()) == (2, 3)


def test_flatten_dotted_names_and_nested_arrays(spark):
    df = spark.createDataFrame(
        [((1, 2), [[1, 2], [], [3]])], "`x.y` struct<`p.q`:int,r:int>, `g.h` array<array<int>>"
    )
    out = flatten(df)
    assert out.columns == ["g.h", "x.y_p.q", "x.y_r"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1, 2), (2, 1, 2), (3, 1, 2)]


def test_flatten_flat_frame_is_unchanged(spark):
    df = spark.createDataFrame([(1, {"a": 1})], "id int, m map<string,int>")
    assert flatten(df) is df


def test_struct_flattening_is_one_projection(spark):
    df = spark.createDataFrame([(((((1,),),),),)], "a struct<b:struct<c:struct<d:struct<e:int>>>>")
    plan = flatten(df)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 1


def test_dedup(spark):
    df = spark.createDataFrame(
        [
            (1, ["a"], 5, "x"), (1, ["a"], 3, "y"), (1, ["b"], 1, "z"), (None, ["c"], 2, "u"), (None, ["c"], 1, "v"),
            (None, None, 7, "broken"), (None, None, 8, "broken too"), (None, None, 8, "broken too"),
        ],
        "k int, t array<string>, o int, v string",
    )
    assert dedup(df, ["K", "t"]).count() == 5
    first = dedup(df, ["k", "t"], [F.col("o")])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # once before the shuffle
    assert first.columns == df.columns
    assert sorted(r.v for r in first.collect()) == ["broken", "broken too", "v", "y", "z"]
    with_map = df.withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    assert dedup(with_map, ["k", "t"]).count() == 5
    with pytest.raises(ValueError, match="nope"):
        dedup(df, ["k", "nope"])


def test_dedup_tells_unkeyed_rows_apart_by_their_maps(spark):
    rows = [(None, "x", {"a": 1, "b": 2}), (None, "x", {"a": 2, "b": 2}), (None, "x", {"b": 2, "a": 1}), (1, "y", None), (1, "z", {})]
    df = spark.createDataFrame(rows, "k int, v string, m map<string,int>")
    assert dedup(df, ["k"]).count() == 3
    nested = df.select("k", F.struct("m").alias("s"), F.array(F.col("m")).alias("l"))
    assert dedup(nested.where("k IS NULL"), ["k"]).count() == 2
