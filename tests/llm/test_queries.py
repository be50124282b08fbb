"""The registered queries against SQL where there is some, and the pipeline."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from rowsieve.llm.queries import ORACLES, QUERIES
from tests.llm.texts import awkward, prose
from tests.test_oracle import SF_DIR, TABLES, comparable


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    sql = duckdb.connect()
    for table in TABLES:
        sql.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    ours, theirs = QUERIES[name](spark, SF_DIR).toPandas(), sql.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert comparable(ours) == comparable(theirs)


def test_all_operators_and_the_pipeline_are_registered():
    names = entry_points.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert names["pipeline"] is corpus_pipeline.run and set(QUERIES) <= set(names)


def small_tables(spark, tmp_path):
    good = [(100 + i, prose(90, 40 + i)) for i in range(60)]
    bad = [(300 + i, " ".join(f"{w}###" for w in prose(90, 400 + i).split())) for i in range(30)]
    item = prose(30, 7000)
    special = [(500, good[0][1] + " end"), (501, prose(20, 9) + " " + item), (502, good[1][1] + "\n" + prose(50, 77))]
    rows = [(*r, "en", "s", 7, r[0]) for r in awkward() + good + bad + special]
    folder = str(tmp_path / "tables")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score long")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(None, 1, 0), (500, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs


def test_stages_on_small_tables(spark, tmp_path):
    folder, docs = small_tables(spark, tmp_path)
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality_classifier"
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, folder)
        assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        seen = spark.read.parquet(str(tmp_path / name))
        ids = {r["doc_id"] for r in seen.select("doc_id").collect()}
        if name == "quality_classifier":
            assert set(range(100, 160)) <= ids and not ids & set(range(300, 330))
        if name == "line_dedup":
            row = {r["doc_id"]: r for r in seen.collect()}
            assert row[502]["text"] == prose(50, 77) and row[502]["n_chars"] == len(prose(50, 77))
            assert row[101]["n_chars"] == 7
        if name == "benchmark_decontamination":
            assert 501 not in ids and set(range(100, 160)) <= ids
    packed = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == ids
    assert packed.agg({"length": "max"}).first()[0] <= 2048


def test_stages_take_empty_tables(spark, tmp_path):
    folder, docs = small_tables(spark, tmp_path)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0


def test_driver_variables_are_not_needed():
    assert os.path.isfile(corpus_pipeline.__file__) and corpus_pipeline.ORACLE_SQL is None
