"""Flattening against a plain row-by-row model, on generated documents."""

import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import ArrayType, IntegerType, StructType

from rowsieve.operators import flatten

LEAF = st.one_of(st.none(), st.integers(0, 3))


@st.composite
def kinds(draw, depth=2):
    if depth == 0 or draw(st.booleans()):
        return IntegerType()
    inner = draw(kinds(depth - 1))
    if draw(st.booleans()):
        return ArrayType(inner)
    other = draw(kinds(depth - 1))
    return StructType().add("x", inner).add("y", other)


def values(kind):
    if isinstance(kind, ArrayType):
        return st.one_of(st.none(), st.lists(values(kind.elementType), max_size=3))
    if isinstance(kind, StructType):
        return st.one_of(st.none(), st.tuples(*[values(f.dataType) for f in kind.fields]))
    return LEAF


def model(kind, name, value, outer):
    """The rows one column gives: a list of {flat name: value}."""
    if isinstance(kind, ArrayType):
        elements = value or ([None] if outer else [])
        return [row for e in elements for row in model(kind.elementType, name, e, outer)]
    if isinstance(kind, StructType):
        parts = value or (None,) * len(kind.fields)
        columns = [model(f.dataType, f"{name}_{f.name}", p, outer) for f, p in zip(kind.fields, parts)]
        return [{k: v for part in choice for k, v in part.items()} for choice in itertools.product(*columns)]
    return [{name: value}]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.data())
def test_flatten_equals_model(spark, data):
    schema = StructType().add("a", data.draw(kinds())).add("b", data.draw(kinds()))
    rows = data.draw(st.lists(st.tuples(*[values(f.dataType) for f in schema.fields]), min_size=1, max_size=4))
    df = spark.createDataFrame([(r[0], r[1]) for r in rows], schema).coalesce(1)
    for outer in (False, True):
        out = flatten(df, outer=outer)
        whole = [m for r in rows for m in model(schema, "", r, outer)]
        expected = [{k.lstrip("_"): v for k, v in m.items()} for m in whole]
        got = [r.asDict() for r in out.collect()]
        key = lambda m: repr(sorted(m.items()))
        assert sorted(got, key=key) == sorted(expected, key=key)
