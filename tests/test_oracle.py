"""Every registered query against its SQL, over the whole tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
# Those of the training-data operators are tested beside them.
QUERIES, ORACLES = entry_points.QUERIES, entry_points.ORACLES


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted(frame.itertuples(index=False, name=None), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sql, name):
    ours = entry_points.queries()[name](spark, SF_DIR).toPandas()
    theirs = sql.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) == len(theirs) > 0
    assert comparable(ours) == comparable(theirs)
    kinds = lambda f: {c: f[c].dtype.kind for c in f.columns}
    assert kinds(ours) == kinds(theirs)


def test_entry(spark):
    rows = entry_points.entry(spark)
    assert rows.columns == ["event_id", "is_valid", "rule_ids", "messages"]
    assert rows.count() > 0
