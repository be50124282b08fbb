"""Objects cut out of lines, whatever the splits."""

import json
import random

import pytest
from pyspark.sql.types import StructType

from rowsieve.sources.objects import FILE, cut_objects, object_lines, read_objects

LAYOUT = "id long, name string, inner struct<x:long>, list array<struct<y:long>>, bad string"


@pytest.fixture(scope="module")
def schema(spark):
    return StructType.fromDDL(LAYOUT)


def texts(objects):
    """The same as one walk through the whole text."""
    depth, out, text, stray, quoted, escaped = 0, [], "", "", False, False
    for line in objects.split("\n"):
        quoted = escaped = False
        for c in line:
            if quoted:
                quoted, escaped = escaped or c != '"', c == "\\" and not escaped
            elif c == '"':
                quoted = True
            elif c == "{":
                depth += 1
                if depth == 1:
                    out, stray, text = out + [stray] * bool(stray.strip(" ,[]\t")), "", ""
            elif c == "}" and depth:
                depth -= 1
                if depth == 0:
                    out.append(text + c)
                    text = ""
                    continue
            if depth:
                text += c
            else:
                stray += c
        out, stray = out + [stray] * bool(stray.strip(" ,[]\t")), ""
        text += "\n" * (depth > 0)
    return sorted(out + [text.removesuffix("\n")] * (depth > 0))


def cut(spark, folder):
    return sorted(r["text"] for r in cut_objects(object_lines(spark.read.text(str(folder)))).collect())


@pytest.mark.parametrize("seed", range(3))
def test_any_text(spark, tmp_path, seed):
    r = random.Random(seed)
    made = "".join(r.choice(['{', '}', '{"a": 1}', '"x{\\"y"', "\n", "\n", ", ", "[", "]", "word", '"open']) for _ in range(400))
    (tmp_path / "a.txt").write_text(made)
    assert cut(spark, tmp_path) == texts(made)


def test_splits_of_one_file(spark, tmp_path, schema):
    r = random.Random(5)
    rows = [
        {"id": k, "name": "".join(r.choice('ab{}"\\,é ') for _ in range(r.randrange(30))), "inner": {"x": k}, "list": [{"y": 1}] * (k % 3)}
        for k in range(4000)
    ]
    (tmp_path / "one.json").write_text(json.dumps(rows, indent=2, ensure_ascii=False))
    (tmp_path / "dense.json").write_text(json.dumps(rows[:50]).replace("}, {", "},{"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = object_lines(spark.read.text(str(tmp_path / "one.json")))
        assert lines.select("_object_split").distinct().count() > 10
        got = read_objects(spark, str(tmp_path), schema, "*.json", corrupt_column="bad").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    wanted = [(x["id"], x["name"], x["inner"]["x"], len(x["list"])) for x in rows + rows[:50]]
    assert sorted((x["id"], x["name"], x["inner"]["x"], len(x["list"])) for x in got) == sorted(wanted)
    assert all(x["bad"] is None for x in got)


def test_same_as_the_reader_of_whole_files(spark, tmp_path, schema):
    (tmp_path / "a.json").write_text('[\n{"id": 1, "name": "a"},\n{"id": 2,\n "inner": {"x": 3}, "list": [{"y": 4}, {"y": 5}]}\n]')
    (tmp_path / "b.json").write_text('{\n  "id": 9\n}')
    (tmp_path / "empty.json").write_text("")
    whole = spark.read.schema(schema).option("multiLine", True).json(str(tmp_path)).collect()
    assert sorted(map(str, read_objects(spark, str(tmp_path), schema).collect())) == sorted(map(str, whole))


def test_malformed_objects_cost_themselves_only(spark, tmp_path, schema):
    (tmp_path / "a.json").write_text('[{"id": 1}, {"id": oops}, stray\n, {"id": "text"}, {"id": 2}}, {"id": 3}\n{"id": 4, ')
    rows = read_objects(spark, str(tmp_path), schema, corrupt_column="bad").collect()
    assert sorted(r["id"] for r in rows if r["bad"] is None) == [1, 2, 3]
    bad = sorted(r["bad"] for r in rows if r["bad"] is not None)
    assert len(bad) == 5 and '{"id": 4, ' in bad and any("stray" in b for b in bad)


def test_file_is_known(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1}')
    assert cut_objects(object_lines(spark.read.text(str(tmp_path)))).head()[FILE].endswith("/a.json")


def test_lines_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1,\n"name": "a"}')
    plan = cut_objects(object_lines(spark.read.text(str(tmp_path))))._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically_increasing_id" not in plan and "_object_seq" not in plan


def test_an_object_over_many_splits(spark, tmp_path):
    big = json.dumps({"a": ["x" * 50] * 3000, "b": {"c": "} {"}}, indent=1)
    made = '[ {"k": 1},\n' + big + ',\n\n oops {"k": 2}, {"k":\n 3}\n' + ", " + big + ', {"k": 4\n' + "\n" * 30_000 + "5"
    (tmp_path / "a.txt").write_text(made)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert object_lines(spark.read.text(str(tmp_path))).select("_object_split").distinct().count() > 10
        assert cut(spark, tmp_path) == texts(made)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_bytes_that_are_no_text_do_not_end_the_job(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b'{"a": "\xff\xfe"}\n{"a":\n 1}')
    assert len(cut_objects(object_lines(spark.read.text(str(tmp_path)))).select("text").collect()) == 2
