"""Truth table of each rule type, with ANSI mode on and off."""

import pytest
from pyspark.sql import functions as F

from rowsieve.functions.checks import ISO_FORMAT, RuleParameterError, register_rule, rule_type
from rowsieve.plans.rules import Rule
from rowsieve.plans.verdict import apply_rules

TEXTS = {
    "not_null": ({}, {"a": True, "": True, None: False}),
    "regex_pattern": ({"pattern": "b+"}, {"abc": True, "bb": True, "ac": False, "": False, None: None}),
    "allowed_values": ({"values": ["a", "b"]}, {"a": True, "c": False, None: None}),
    "min_length": ({"length": "3"}, {"abc": True, "abcd": True, "ab": False, None: None}),
    "is_iso_timestamp": (
        {},
        {
            "2024-01-02T03:04:05.123Z": True,
            "2024-01-02T03:04:05.12Z": True,
            "2024-01-02T03:04:05.1Z": True,
            "2024-01-02T03:04:05.123+02:00": True,
            "2024-01-02T03:04:05.123-11:30": True,
            "2024-01-02T03:04:05.123456Z": False,
            "2024-01-02T03:04:05.1234Z": False,
            "2024-01-02T03:04:05Z": False,
            "2024-01-02T03:04:05+00:00": False,
            "2024-01-02T03:04:05.123": False,
            "2024-01-02T03:04:05.123+0000": False,
            "2024-13-02T03:04:05.123Z": False,
            "2024-02-30T03:04:05.123Z": False,
            "2024-01-02 03:04:05.123Z": False,
            "2024-01-02": False,
            "bad": False,
            "": False,
            None: False,
        },
    ),
    "well_formed": ({}, {None: True, "{": False, "": False}),
}


@pytest.fixture(params=["true", "false"], ids=["ansi", "no_ansi"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_text_rule(spark, ansi, name):
    params, expected = TEXTS[name]
    df = spark.createDataFrame([(v,) for v in expected], "v string")
    rows = df.select("v", rule_type(name).build("v", params).alias("ok")).collect()
    assert {r.v: r.ok for r in rows} == expected


def test_array_not_empty(spark, ansi):
    df = spark.createDataFrame([(1, ["a"]), (2, []), (3, None), (4, [None])], "id int, v array<string>")
    rows = df.select("id", rule_type("array_not_empty").build("v", {}).alias("ok")).collect()
    assert {r.id: r.ok for r in rows} == {1: True, 2: False, 3: False, 4: True}


def test_no_allowed_value_at_all(spark, ansi):
    df = spark.createDataFrame([("a",), (None,)], "v string")
    rows = df.select(rule_type("allowed_values").build("v", {"values": []}).alias("ok")).collect()
    assert [r.ok for r in rows] == [False, False]


def test_allowed_values_as_json_text(spark):
    df = spark.createDataFrame([("a",), ("c",)], "v string")
    check = rule_type("allowed_values").build("v", {"values": '["a", "b"]'})
    assert [r.ok for r in df.select(check.alias("ok")).collect()] == [True, False]
    for bad in ("a,b", '"a"', 7):
        with pytest.raises(RuleParameterError):
            rule_type("allowed_values").build("v", {"values": bad})


def test_iso_shortcut_never_changes_the_outcome(spark):
    """The fraction test in front of the parser agrees with the parser alone."""
    days = ["2024-01-02", "2024-1-2", "12024-01-02", "-2024-01-02", "+2024-01-02", "2024-02-30"]
    times = ["T03:04:05", "t03:04:05", " 03:04:05", "T3:4:5", "T24:00:00", "T03:04"]
    fractions = ["", ".", ".1", ".12", ".123", ".1234", ".123456", ",123", ".١٢٣"]
    zones = ["", "Z", "z", "+00:00", "-05:30", "+0000", "+00", "+00:00:00", "+19:00", " Z", "Z ", "UTC"]
    rows = [(d + t + f + z,) for d in days for t in times for f in fractions for z in zones]
    df = spark.createDataFrame(rows, "v string").select(
        "v",
        rule_type("is_iso_timestamp").build("v", {}).alias("ours"),
        F.try_to_timestamp("v", F.lit(ISO_FORMAT)).isNotNull().alias("parser"),
    )
    assert df.filter("ours").count() > 0
    assert df.filter("ours <> parser").collect() == []


def test_iso_format_parameter_and_parsed_column(spark):
    df = spark.sql("select '02.01.2024' as v, timestamp'2024-01-02 03:04:05' as t")
    build = rule_type("is_iso_timestamp").build
    row = df.select(
        build("v", {}).alias("strict"),
        build("v", {"format": "dd.MM.yyyy"}).alias("custom"),
        build("t", {}).alias("parsed"),
    ).head()
    assert (row.strict, row.custom, row.parsed) == (False, True, True)


def test_own_rule_type(spark):
    register_rule("at_most", lambda name, params: F.col(name) <= int(params["max"]), ["max"])
    df = spark.createDataFrame([(1,), (9,), (None,)], "v int")
    rows = df.select(rule_type("at_most").build("v", {"max": "5"}).alias("ok")).collect()
    assert [r.ok for r in rows] == [True, False, None]
    with pytest.raises(ValueError):
        register_rule("not_null", lambda name, params: F.lit(True))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_text_values_on_typed_columns(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(1, 1.5), (2, 2.0), (None, None)], "n int, x double")
        rules = [
            Rule("N", "allowed_values", "n", {"values": '["A", "2"]'}, "m"),
            Rule("X", "allowed_values", "x", {"values": '["2", 7, "much"]'}, "m"),
        ]
        got = {r.n: (r.is_valid, [e.rule_id for e in r.dq_errors]) for r in apply_rules(df, rules).collect()}
        assert got == {1: (False, ["N", "X"]), 2: (True, []), None: (False, ["N", "X"])}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_unusable_parameters_name_the_rule(spark):
    df = spark.createDataFrame([("a",)], "v string")
    for kind, params in (("regex_pattern", {"pattern": "["}), ("is_iso_timestamp", {"format": "jjj{"})):
        with pytest.raises(RuleParameterError, match="rule BAD"):
            apply_rules(df, [Rule("BAD", kind, "v", params)])
    register_rule("broken", lambda name, params: 1 / 0)
    with pytest.raises(RuleParameterError, match="rule BAD"):
        apply_rules(df, [Rule("BAD", "broken", "v")])
