"""Schemas that change between versions and batches, and keys remembered for good."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowsieve.operators import route, route_batch
from rowsieve.plans.evolution import BreakingChange, compare, widest, widest_schema
from rowsieve.plans.rules import Rule
from rowsieve.sinks import RouteSink, generations, read_widened, register_widened
from rowsieve.sinks.tables import follow_schema
from rowsieve.sources import registered_schema, schema_registry, schema_versions
from rowsieve.streaming import SeenKeys, write_unseen
from rowsieve.streaming.late import KEY, seen_copies

ddl = StructType.fromDDL
# Spark parses the schemas.
pytestmark = pytest.mark.usefixtures("spark")


def kind(text):
    return ddl(f"x {text}")[0].dataType


@pytest.mark.parametrize(
    "old, new, changes",
    [
        ("a int", "a int", []),
        ("a int", "a int, b string", ["b added"]),
        ("a int", "A bigint", ["A widened"]),
        ("a bigint", "a int", ["a breaking"]),
        ("a bigint", "a double", ["a breaking"]),
        ("a int, b int", "a int", ["b breaking"]),
        ("a int", "a int, b string not null", ["b breaking"]),
        ("a int not null", "a int", ["a widened"]),
        ("a int", "a int not null", ["a breaking"]),
        ("s struct<x:int,y:string>", "s struct<x:bigint,y:string,z:date>", ["s.x widened", "s.z added"]),
        ("s array<struct<x:int>>", "s array<struct<x:string>>", ["s[].x widened"]),
        ("m map<string,float>", "m map<string,double>", ["m{} widened"]),
        ("m map<string,int>", "m map<int,int>", ["m breaking"]),
        ("s struct<x:int>", "s string", ["s breaking"]),
    ],
)
def test_compare(old, new, changes):
    assert [f"{c.path} {c.kind}" for c in compare(ddl(old), ddl(new))] == changes


@pytest.mark.parametrize(
    "a, b, wide",
    [
        ("tinyint", "bigint", "bigint"),
        ("float", "double", "double"),
        ("float", "smallint", "float"),
        ("float", "int", "double"),
        ("double", "bigint", None),
        ("decimal(10,2)", "int", "decimal(12,2)"),
        ("decimal(38,0)", "decimal(38,10)", None),
        ("timestamp", "string", "string"),
        ("binary", "string", None),
        ("boolean", "int", None),
        ("array<int>", "array<bigint>", "array<bigint>"),
        ("struct<a:int>", "struct<b:int,a:string>", "struct<a:string,b:int>"),
    ],
)
def test_widest(a, b, wide):
    expected = None if wide is None else kind(wide)
    assert widest(kind(a), kind(b)) == expected
    if expected is None or not isinstance(expected, StructType):
        assert widest(kind(b), kind(a)) == expected


def test_no_common_type_names_the_column():
    with pytest.raises(ValueError, match="'a'.*bigint.*double"):
        widest_schema([ddl("a bigint"), ddl("a double")])


def registry(spark, *versions, active=None):
    active = len(versions) - 1 if active is None else active
    return schema_registry(
        spark,
        [
            {"schema_id": f"S{i}", "dataset_name": "d", "version": i, "schema_json": ddl(v), "is_active": i == active}
            for i, v in enumerate(versions)
        ],
    )


def test_registered_schema(spark):
    steps = registry(spark, "a int", "a bigint, b string", "a int", "a string")
    with pytest.raises(BreakingChange, match="version 1 to 2: a: bigint -> int .breaking.; b: string -> absent"):
        registered_schema(spark, "d", steps)
    # From the version after the breaking step on, and up to one before it.
    assert registered_schema(spark, "d", steps, since=2) == ddl("a string")
    early = registry(spark, "a int", "a bigint, b string", "a int", active=1)
    assert registered_schema(spark, "d", early) == ddl("a bigint, b string")
    assert [v for v, _ in schema_versions(spark, "d", early)] == [0, 1]
    for dataset, since in (("other", None), ("d", 9)):
        with pytest.raises(LookupError):
            registered_schema(spark, dataset, steps, since=since)


@pytest.mark.parametrize("keep", [True, False])
def test_read_widened(spark, tmp_path, keep):
    sink = RouteSink(str(tmp_path), ("k",), stream_id="a b", keep_schema=keep)
    batches = [
        ("k string, n int, s struct<x:int>", [("p", 1, (7,))]),
        ("k string, n int, s struct<x:int>", [("p", 2, None)]),
        ("k string, n bigint, s struct<y:string,x:bigint>", [("q", 1 << 40, ("y", 8))]),
        ("k string, n int, s struct<x:int>", [("q", 3, (None,))]),
        ("k string, n string, extra array<int>", [("p", "four", [1])]),
    ]
    for i, (schema, rows) in enumerate(batches):
        sink.write_batch(spark.createDataFrame(rows, schema), i)
    runs = {r for g in generations(spark, sink) for r in g.runs}
    assert ("a b", 3, 3) in runs and (("a b", 0, 1) in runs) == keep
    want = {
        ("p", "1", 7, None, None), ("p", "2", None, None, None), ("q", str(1 << 40), 8, "y", None),
        ("q", "3", None, None, None), ("p", "four", None, None, 1),
    }

    def rows(df):
        return {tuple(r) for r in df.select("k", "n", "s.x", "s.y", F.get("extra", F.lit(0))).collect()}

    assert rows(read_widened(spark, sink)) == want
    register_widened(spark, f"widened_{keep}", sink)
    assert rows(spark.table(f"widened_{keep}")) == want
    # A replay under another schema replaces the batch's record too.
    sink.write_batch(spark.createDataFrame([("p", 5)], "k string, n int"), 4)
    assert read_widened(spark, sink).schema["n"].dataType == kind("bigint")
    register_widened(spark, f"widened_{keep}", sink)
    assert spark.table(f"widened_{keep}").select(F.sum("n")).head()[0] == 1 + 2 + (1 << 40) + 3 + 5


def test_read_widened_into_a_given_schema(spark, tmp_path):
    sink = RouteSink(str(tmp_path), ("k",), keep_schema=True)
    with pytest.raises(ValueError, match="schema"):
        read_widened(spark, sink)
    wanted = ddl("k string, n double")
    assert read_widened(spark, sink, wanted).collect() == []
    sink.write_batch(spark.createDataFrame([("p", 1)], "k string, n bigint"), 0)
    sink.write_batch(spark.createDataFrame([("p", 0.5)], "k string, n double"), 1)
    with pytest.raises(ValueError, match="'n'"):
        read_widened(spark, sink)
    found = read_widened(spark, sink, wanted)
    assert sorted(r["n"] for r in found.collect()) == [0.5, 1.0]
    plan = found.filter("k = 'p'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters") >= 2 and "Exchange" not in plan
    # No cast leads there at all.
    sink.write_batch(spark.createDataFrame([("p", bytearray(b"x"))], "k string, n binary"), 2)
    with pytest.raises(AnalysisException, match='"TRY_CAST.n AS DOUBLE'):
        read_widened(spark, sink, wanted)


@pytest.fixture
def seen(spark, tmp_path):
    keys = SeenKeys("seen_" + tmp_path.name.replace("-", "_"), f"{tmp_path}/seen", 4)
    keys.create(spark)
    return keys


def test_late_copies(spark, tmp_path, seen):
    sink = RouteSink(f"{tmp_path}/out", ("kind",))
    day = dt.datetime(2024, 3, 9)
    schema = "id long, at timestamp, kind string, more map<string,int>"

    def batch(n, *rows):
        rows = [(i, day - dt.timedelta(days=d, microseconds=u), k, {"x": 1, "y": d}) for i, d, u, k in rows]
        write_unseen(spark.createDataFrame(rows, schema), ["id", "at"], sink, seen, n)

    def ids():
        return sorted(
            ((r["id"], (day - r["at"]).days, r["kind"]) for r in sink.read(spark, ddl(schema)).collect()), key=repr
        )

    batch(0, (1, 0, 0, "a"), (1, 0, 0, "a"), (2, 0, 0, ""), (None, 0, 0, "a"))
    assert len(ids()) == 3
    # Unique 62 days late, a copy as late, one that differs by a microsecond, a null key.
    batch(1, (3, 62, 0, "a"), (3, 62, 0, "a"), (1, 0, 0, "b"), (1, 0, 1, "a"), (None, 0, 0, "a"))
    batch(2, (3, 62, 0, "a"), (2, 0, 0, "c"))
    kept = ids()
    assert len(kept) == 5 and (3, 62, "a") in kept and all(k in ("a", None) for _, _, k in kept)
    # A replay finds its own keys, and does not lose its rows.
    batch(1, (3, 62, 0, "a"), (1, 0, 0, "b"))
    assert len(ids()) == 4 and spark.table(seen.table).count() == 4
    seen.compact(spark, 1)
    seen.compact(spark, 1)
    assert spark.table(seen.table).count() == 4
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {seen.table}").collect()][0] == "_batch_id=-2"
    batch(3, (3, 62, 0, "a"), (1, 0, 0, "b"), (9, 1, 0, "a"))
    assert len(ids()) == 5
    # A later session finds the keys in the files.
    spark.sql(f"DROP TABLE {seen.table}")
    seen.create(spark)
    assert spark.table(seen.table).count() == 5


def test_rows_without_any_key(spark, tmp_path, seen):
    """As in the batch operator, such rows are copies only when equal in every column."""
    sink = RouteSink(f"{tmp_path}/out", ("p",))
    schema = "p int, id long, text string, m map<string,int>"
    for n in range(2):
        rows = [(1, None, "x", {"a": 1, "b": 2}), (1, None, "x", {"b": 2, "a": 1}), (1, None, "y", None), (1, 5, "z", None), (1, 5, "w", None)]
        write_unseen(spark.createDataFrame(rows, schema), ["id"], sink, seen, n)
    kept = sink.read(spark, ddl(schema)).collect()
    assert len(kept) == 3 and sorted(r["text"] for r in kept if r["id"] is None) == ["x", "y"]


def test_history_is_not_shuffled(spark, tmp_path, seen):
    rows = spark.range(1000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias(KEY))
    seen.replace(rows, 0)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = seen_copies(rows.limit(10), seen, 1)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    join = plan[plan.index("ShuffledHashJoin"):]
    history = join[: join.index("Exchange")]
    assert "seen_" in history and "Bucketed: true" in history and "Sort " not in history


def test_committed_counts(spark, tmp_path, monkeypatch):
    """Observed counts that came out too high, as after a lost executor, are not reported."""
    rows = spark.createDataFrame([(1, "a"), (None, "a"), (3, "b")], "id int, applicationCode string")
    rules = [Rule("R", "not_null", "id", {}, "no id")]
    real = route._counts
    monkeypatch.setattr(route, "_counts", lambda: [(c * 2).alias(n) for c, n in zip(real(), ("valid", "error"))])
    sinks = [RouteSink(f"{tmp_path}/{n}", ("applicationCode",), layout="rebalance") for n in ("valid", "error")]
    assert route_batch(rows, rules, *sinks) == route.BatchMetrics(4, 2)
    assert route_batch(rows, rules, *sinks, committed_counts=True) == route.BatchMetrics(2, 1)
    fine = rows.where("id IS NOT NULL")
    assert route_batch(fine, rules, *sinks, batch_id=1, committed_counts=True) == route.BatchMetrics(2, 0)


def test_bronze_table_follows_the_schema(spark, tmp_path):
    """New columns and wider numbers are taken up; a change of kind is refused."""
    name, path = "bronze_" + tmp_path.name.replace("-", "_"), f"{tmp_path}/rows"
    spark.createDataFrame([(1, "d1")], "n int, d string").write.partitionBy("d").option("path", path).saveAsTable(name)

    def follow(schema):
        follow_schema(spark, name, ddl(schema), path, ("d",), "parquet")

    follow("n int, more string, d string")
    assert spark.table(name).collect() == [(1, None, "d1")]
    follow("n bigint, d string")
    assert spark.table(name).schema["n"].dataType == kind("bigint") and spark.table(name).select("n", "more", "d").collect() == [(1, None, "d1")]
    for schema in ("n string, d string", "n int, d string"):
        with pytest.raises(ValueError, match="'n' cannot turn"):
            follow(schema)
    follow_schema(spark, "no_such_table", ddl("n int"), path, (), "parquet")
