"""Verdict logic: three-valued outcomes, scopes, entries and their order."""

import itertools
import logging

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowsieve.functions.checks import RuleParameterError, register_rule
from rowsieve.plans.rules import Rule, rules_from_dict, rules_from_policies
from rowsieve.plans.verdict import (
    ERRORS_TYPE,
    apply_rules,
    error_rows,
    split_verdict,
    valid_rows,
    with_verdict,
)

TRI = (True, False, None)
register_rule("flag", lambda name, params: F.col(name))


def expected_verdict(scopes, checks):
    """Verdict and failed rules of one row, from plain three-valued logic."""
    failed, open_rules = [], 0
    for i, (scope, check) in enumerate(zip(scopes, checks, strict=True)):
        if scope is False or check is True:
            continue
        if scope is True and check is False:
            failed.append(f"R{i}")
        else:
            open_rules += 1
    if failed:
        return False, failed
    return (None if open_rules else True), []


def test_all_outcomes_of_three_scoped_rules(spark):
    """729 rows: definite verdicts equal the model's, and no row is lost."""
    apps = {True: "in", False: "out", None: None}
    rows, expected = [], {}
    for scope in itertools.product(TRI, repeat=3):
        for check in itertools.product(TRI, repeat=3):
            expected[len(rows)] = expected_verdict(scope, check)
            rows.append((len(rows), *[apps[s] for s in scope], *check))
    df = spark.createDataFrame(
        rows, "id int, a0 string, a1 string, a2 string, c0 boolean, c1 boolean, c2 boolean"
    )
    # One scope column for each rule, as part of its check.
    for i in range(3):
        register_rule(
            f"scoped_flag_{i}",
            lambda name, params, i=i: ~((F.col(f"a{i}") == "in") & ~F.col(name)),
        )
    ours = apply_rules(df, [Rule(f"R{i}", f"scoped_flag_{i}", f"c{i}", {}, f"m{i}") for i in range(3)])
    got = ours.collect()
    assert len(got) == 729
    lost = 0
    for r in got:
        verdict, ids = expected[r.id]
        assert r.is_valid is not None
        assert r.is_valid == (len(r.dq_errors) == 0)
        if verdict is None:
            lost += 1
            assert not r.is_valid
            assert all(e.message.startswith("undetermined: m") for e in r.dq_errors)
        else:
            assert (r.is_valid, [e.rule_id for e in r.dq_errors]) == (verdict, ids)
    assert lost == 387
    assert sum(r.is_valid for r in got) == 125


INCLUDE = {"ALL": ["ALL"], "list": ["web", "app"], "null": None, "empty": []}
EXCLUDE = {"empty": [], "list": ["app"], "null": None}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_scope_matrix(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame(
            [(a, v) for a in ("web", "app", "atm", None) for v in ("ok", "bad")],
            "applicationCode string, v string",
        )
        for (inc, include), (exc, exclude) in itertools.product(INCLUDE.items(), EXCLUDE.items()):
            rules = rules_from_policies(
                [
                    {
                        "policy_id": "P",
                        "rule_type": "regex_pattern",
                        "target_column": "v",
                        "rule_params": {"pattern": "ok"},
                        "app_scope_inclusion": include,
                        "app_scope_exclusion": exclude,
                        "error_message": "m",
                    }
                ]
            )
            for r in apply_rules(df, rules).collect():
                app = r.applicationCode
                included = inc in ("ALL", "null") or (inc == "list" and app in ("web", "app"))
                excluded = exc == "list" and app == "app"
                if inc == "empty":
                    scope = False
                elif app is None:
                    scope = None if inc == "list" or exc == "list" else True
                else:
                    scope = included and not excluded
                where = (inc, exc, app, r.v)
                if r.v == "ok" or scope is False:
                    assert r.is_valid and r.dq_errors == [], where
                else:
                    message = "m" if scope else "undetermined: m"
                    assert not r.is_valid, where
                    assert [tuple(e) for e in r.dq_errors] == [("P", "v", message)], where
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


TEXT = st.one_of(st.none(), st.sampled_from(["", "a", "ab", "abc", "web", "atm", "2024-01-02T03:04:05.1Z"]))
ROW = st.tuples(TEXT, TEXT, TEXT, st.one_of(st.none(), st.lists(TEXT, max_size=2)))
ALL_TYPES = [
    Rule("1", "not_null", "a", {}, "missing"),
    Rule("2", "min_length", "b", {"length": 2}, "short", ("web", "ab")),
    Rule("3", "regex_pattern", "a", {"pattern": "b"}, None, None, ("atm",)),
    Rule("4", "allowed_values", "b", {"values": ["ab", "web"]}, "unknown"),
    Rule("5", "is_iso_timestamp", "a", {}, "no time", ("web", None)),
    Rule("6", "array_not_empty", "tags", {}, "empty", None, ("a",)),
]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=20, max_size=60))
def test_valid_and_error_add_up(spark, rows):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "id int, applicationCode string, a string, b string, tags array<string>",
    )
    verdicts = apply_rules(df, ALL_TYPES)
    valid, error = (part.collect() for part in split_verdict(verdicts))
    assert {r.id for r in valid} | {r.id for r in error} == set(range(len(rows)))
    assert len(valid) + len(error) == len(rows)
    assert all(r.dq_errors for r in error)
    assert sorted(valid_rows(df, ALL_TYPES).collect()) == sorted(valid)
    assert sorted(r.id for r in error_rows(df, ALL_TYPES).collect()) == sorted(r.id for r in error)


def test_null_id_under_not_null_and_regex(spark):
    """A definite failure stands alone; the undetermined regex adds nothing to it."""
    df = spark.createDataFrame([(None,), ("x",)], "id string")
    both = [Rule("N", "not_null", "id", {}, "m"), Rule("R", "regex_pattern", "id", {"pattern": "x"}, "r")]
    missing, fine = apply_rules(df, both).collect()
    assert [e.rule_id for e in missing.dq_errors] == ["N"]
    assert fine.is_valid
    alone = apply_rules(df, both[1:]).head()
    assert [tuple(e) for e in alone.dq_errors] == [("R", "id", "undetermined: r")]


def test_same_entry_once_and_stable_order(spark):
    df = spark.createDataFrame([(None, "", [])], "a string, b string, tags array<string>")
    policies = [
        ("P9", "array_not_empty", "tags", {}),
        ("P2", "min_length", "b", {"length": "1"}),
        ("P3", "not_null", "a", {}),
        ("P1", "not_null", "a", {}),
        ("P3", "not_null", "a", {}),
    ]
    rows = [
        {"policy_id": i, "rule_type": t, "target_column": c, "rule_params": p, "error_message": "m"}
        for i, t, c, p in policies
    ]
    for order in (rows, rows[::-1]):
        row = apply_rules(df, rules_from_policies(order)).head()
        assert [e.rule_id for e in row.dq_errors] == ["P1", "P3", "P2", "P9"]


def test_entries_keep_their_text(spark):
    odd = 'a "quoted" \\back\\slash \' {x} ${y} \n\t \u00e4\u4e2d\U0001f600'
    rules = [Rule(odd, "not_null", "a", {}, odd), Rule("none", "not_null", "a", {}, None)]
    row = apply_rules(spark.createDataFrame([(None,)], "a string"), rules).head()
    assert [tuple(e) for e in row.dq_errors] == [(odd, "a", odd), ("none", "a", None)]
    plan = apply_rules(spark.createDataFrame([(None,)], "a string"), rules)
    assert "from_json" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_unknown_type_and_absent_column_have_no_effect(spark, caplog):
    df = spark.createDataFrame([("x",)], "a string")
    rules = [Rule("T", "no_such_type", "a"), Rule("C", "not_null", "no_such_column")]
    with caplog.at_level(logging.WARNING):
        row = apply_rules(df, rules).head()
    assert row.is_valid is True and row.dq_errors == []
    assert "rule T" in caplog.text and "rule C" in caplog.text
    assert apply_rules(df, rules).schema["dq_errors"].dataType.simpleString() == ERRORS_TYPE


def test_schema_and_names(spark):
    df = spark.createDataFrame([("x", 1, None, True)], "signInID string, `a.b` int, DQ_Errors string, is_valid boolean")
    rules = [Rule("1", "not_null", "signInId"), Rule("2", "flag", "a.b")]
    register_rule("flag", lambda name, params: F.col(name).cast("boolean"))
    out = apply_rules(df, rules)
    assert out.columns == ["signInID", "a.b", "dq_errors", "is_valid"]
    assert out.head().is_valid
    assert out.schema["dq_errors"].dataType == with_verdict(df.schema)["dq_errors"].dataType
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert len(apply_rules(df, [Rule("1", "regex_pattern", "signInId", {"pattern": "no"})]).head().dq_errors) == 0
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")
        register_rule("flag", lambda name, params: F.col(name))


def test_missing_parameter_and_scope_column_fail_while_planning(spark):
    df = spark.createDataFrame([("x",)], "a string")
    for kind, params in (("min_length", {}), ("min_length", {"length": "ten"}), ("regex_pattern", {})):
        with pytest.raises(RuleParameterError, match="BAD_1"):
            apply_rules(df, [Rule("BAD_1", kind, "a", params)])
    with pytest.raises(ValueError, match="SCOPED"):
        apply_rules(df, [Rule("SCOPED", "not_null", "a", include=("web",))])
    assert apply_rules(df, [Rule("FREE", "not_null", "a")]).head().is_valid


def test_dictionary_form(spark):
    document = {
        "dataQualityRules": {
            "array_not_empty": {"columns": ["tags"]},
            "min_length": [{"column": "b", "length": 10, "ruleId": "ERR_SHORT"}],
            "allowed_values": [{"column": "b", "values": ["x"]}],
            "regex_pattern": [{"column": "b", "pattern": "^y", "rule_id": "ERR_Y"}],
            "not_null": {"columns": ["a", "b"], "ruleId": "ERR_N"},
        }
    }
    rules = rules_from_dict(document)
    assert rules == rules_from_dict(document["dataQualityRules"])
    df = spark.createDataFrame([(None, "zzz", [])], "a string, b string, tags array<string>")
    assert [tuple(e) for e in apply_rules(df, rules).head().dq_errors] == [
        ("ERR_N", "a", "Value is Null"),
        ("ERR_Y", "b", "Pattern match failed: ^y"),
        ("ERR_INVALID_VALUE", "b", "Value not in allowed list"),
        ("ERR_SHORT", "b", "Length < 10"),
        ("ERR_EMPTY_ARRAY", "tags", "Array is empty"),
    ]


def test_plan_evaluates_each_check_once(spark):
    """Two projections whatever the number of rules, and no Python worker."""
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rules = [
        Rule(f"R{i}", "regex_pattern", "props", {"pattern": f"mark{i}_"}, "m", ("click",))
        for i in range(20)
    ]
    plan = apply_rules(df, rules, "event_type")._jdf.queryExecution().executedPlan().toString()
    assert all(plan.count(f"mark{i}_") == 1 for i in range(20))
    assert "Python" not in plan and "Exchange" not in plan


def test_error_route_evaluates_each_check_once(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rules = [
        Rule(f"R{i}", "regex_pattern", "props", {"pattern": f"mark{i}_"}, "m", ("click",))
        for i in range(20)
    ]
    for rows in (
        error_rows(df, rules, "event_type"),
        split_verdict(apply_rules(df, rules, "event_type", filtered=True))[1],
    ):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert all(plan.count(f"mark{i}_") == 1 for i in range(20))


def test_two_thousand_rules(spark):
    """With the default heap and stack."""
    df = spark.createDataFrame([("7",), ("x7",), (None,)], "v string")
    rules = [Rule(f"R{i:04}", "regex_pattern", "v", {"pattern": f"^[0-{i % 10}]"}, "m") for i in range(2000)]
    counts = {r.v: len(r.dq_errors) for r in apply_rules(df, rules).collect()}
    assert counts == {"7": 1400, "x7": 2000, None: 2000}
    assert valid_rows(df, rules).count() == 0


def test_valid_route_pushes_checks_into_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rules = [
        Rule("A", "allowed_values", "event_type", {"values": ["click", "view"]}),
        Rule("N", "not_null", "props"),
        Rule("S", "allowed_values", "user_id", {"values": [1, 2]}, include=("click",)),
    ]
    rows = valid_rows(df, rules, "event_type").select("event_id")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters:") :].split("\n")[0]
    assert "In(event_type, [click,view])" in pushed
    assert "IsNotNull(props)" in pushed
    assert "user_id" in pushed
    assert "value" not in plan[plan.index("ReadSchema:") :]
