"""Queries over the rule engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve.functions.checks import register_rule
from rowsieve.operators.route import count_routes
from rowsieve.plans.rules import rules_from_dict, rules_from_policies
from rowsieve.plans.verdict import apply_rules, error_rows, valid_rows
from rowsieve.queries.common import scratch, table, verdict_sql, verdict_view
from rowsieve.sinks.tables import overwrite_table
from rowsieve.sources.metadata import dq_policies, load_rules

ISO_SQL = r"coalesce(regexp_full_match(time_text, '\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{1,3}(Z|[+-]\d{2}:\d{2})'), false)"


def policy(policy_id, rule_type, column, message, params=None, include=("ALL",), exclude=(), dataset="events"):
    return {
        "policy_id": policy_id,
        "dataset_name": dataset,
        "rule_type": rule_type,
        "target_column": column,
        "rule_params": params or {},
        "app_scope_inclusion": None if include is None else list(include),
        "app_scope_exclusion": list(exclude),
        "error_message": message,
    }


def checked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the flaws that rules look for: NULLs, odd times, empty arrays."""
    stamp = lambda pattern: F.date_format("ts", pattern)
    form = F.col("event_id") % 5
    return table(spark, sf_dir, "events").select(
        "event_id",
        "value",
        "props",
        F.nullif("event_type", F.lit("signup")).alias("applicationCode"),
        F.nullif("event_type", F.lit("error")).alias("label"),
        F.when(form == 0, F.concat(stamp("yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z")))
        .when(form == 1, F.concat(stamp("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
        .when(form == 2, F.concat(stamp("yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .when(form == 3, F.lit("bad"))
        .alias("time_text"),
        F.when(
            F.col("value") <= 150, F.filter(F.split("event_type", ""), lambda c: c == "i")
        ).alias("tags"),
    )


CHECKED_SQL = """
SELECT event_id, value, props,
  nullif(event_type, 'signup') AS applicationCode,
  nullif(event_type, 'error') AS label,
  CASE event_id % 5
    WHEN 0 THEN left(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), 23) || 'Z'
    WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'
    WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z'
    WHEN 3 THEN 'bad' END AS time_text,
  CASE WHEN value <= 150 THEN list_filter(string_split(event_type, ''), lambda c: c = 'i') END AS tags
FROM events
"""

COMBINED = [
    policy("E01", "not_null", "label", "label is missing"),
    policy("E01", "not_null", "label", "label is missing"),  # a repeated policy counts once
    policy("E02", "min_length", "props", "props too short", {"length": "9"}, ["click", "view"]),
    policy("E03", "regex_pattern", "props", "props not in steps of 5", {"pattern": "[05]\\}$"}, exclude=["purchase"]),
    policy("E04", "allowed_values", "label", "unknown label", {"values": '["click", "view", "purchase"]'}),
    policy("E05", "is_iso_timestamp", "time_text", "not an ISO time", None, ["view", "purchase", "error"]),
    policy("E06", "array_not_empty", "tags", "no tags", None, None),
]
COMBINED_SQL_RULES = [
    ("E01", "label is missing", "label IS NULL"),
    ("E02", "props too short", "applicationCode IN ('click', 'view') AND NOT length(props) >= 9"),
    (
        "E03",
        "props not in steps of 5",
        "applicationCode NOT IN ('purchase') AND NOT regexp_matches(props, '[05]\\}$')",
    ),
    ("E04", "unknown label", "NOT label IN ('click', 'view', 'purchase')"),
    ("E05", "not an ISO time", f"applicationCode IN ('view', 'purchase', 'error') AND NOT {ISO_SQL}"),
    ("E06", "no tags", "NOT coalesce(len(tags) > 0, false)"),
]


def dq_not_null(spark, sf_dir):
    rules = rules_from_policies([policy("N1", "not_null", "label", "label is missing")])
    return verdict_view(apply_rules(checked_events(spark, sf_dir), rules), "event_id")


def customer_names(spark, sf_dir):
    hidden = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", hidden.alias("name"))


def dq_regex(spark, sf_dir):
    pattern = "^Customer#[0-9]+[02468]$"
    rules = rules_from_policies(
        [policy("R1", "regex_pattern", "name", "odd customer", {"pattern": pattern})]
    )
    return verdict_view(apply_rules(customer_names(spark, sf_dir), rules), "c_custkey")


def dq_allowed_values(spark, sf_dir):
    values = '["click", "purchase", "signup", "view"]'
    rules = rules_from_policies(
        [policy("A1", "allowed_values", "event_type", "unknown type", {"values": values})]
    )
    return verdict_view(apply_rules(table(spark, sf_dir, "events"), rules), "event_id")


def dq_min_length(spark, sf_dir):
    rules = rules_from_policies(
        [policy("L1", "min_length", "props", "props too short", {"length": "9"})]
    )
    return verdict_view(apply_rules(table(spark, sf_dir, "events"), rules), "event_id")


def dq_array_not_empty(spark, sf_dir):
    words = F.filter(F.split("text", " "), lambda w: w == "the")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("source") != "src1", words).alias("hits")
    )
    rules = rules_from_policies([policy("T1", "array_not_empty", "hits", "word never used")])
    return verdict_view(apply_rules(documents, rules), "doc_id")


def dq_iso_timestamp(spark, sf_dir):
    rules = rules_from_policies(
        [policy("I1", "is_iso_timestamp", "time_text", "not an ISO time")]
    )
    return verdict_view(apply_rules(checked_events(spark, sf_dir), rules), "event_id")


def dq_scoped(spark, sf_dir):
    rules = rules_from_policies(
        [
            policy("S1", "min_length", "props", "short", {"length": "9"}, ["click", "view"]),
            policy("S2", "regex_pattern", "label", "no i", {"pattern": "i"}, exclude=["purchase"]),
            policy("S3", "not_null", "tags", "no tags", include=["view", "error"], exclude=["error"]),
            policy("S4", "not_null", "label", "never", include=[]),
        ]
    )
    return verdict_view(apply_rules(checked_events(spark, sf_dir), rules), "event_id")


def combined_rules():
    return rules_from_policies(COMBINED)


def dq_combined(spark, sf_dir):
    return verdict_view(apply_rules(checked_events(spark, sf_dir), combined_rules()), "event_id")


def dq_unknown_and_missing(spark, sf_dir):
    rules = rules_from_policies(
        [
            policy("U1", "no_such_type", "label", "never"),
            policy("U2", "not_null", "no_such_column", "never"),
            policy("U3", "not_null", "label", "label is missing"),
        ]
    )
    return verdict_view(apply_rules(checked_events(spark, sf_dir), rules), "event_id")


def dq_dict_rules(spark, sf_dir):
    rules = rules_from_dict(
        {
            "array_not_empty": {"columns": ["tags"], "ruleId": "EMPTY_TAGS"},
            "min_length": [{"column": "props", "length": 9, "ruleId": "SHORT_PROPS"}],
            "allowed_values": [{"column": "label", "values": ["click", "view", "purchase"]}],
            "regex_pattern": [{"column": "props", "pattern": "[05]\\}$", "rule_id": "STEPS"}],
            "not_null": {"columns": ["label", "time_text"], "ruleId": "MISSING"},
        }
    )
    return verdict_view(apply_rules(checked_events(spark, sf_dir), rules), "event_id")


DICT_SQL_RULES = [
    ("MISSING", "Value is Null", "label IS NULL"),
    ("MISSING", "Value is Null", "time_text IS NULL"),
    ("STEPS", "Pattern match failed: [05]\\}$", "NOT regexp_matches(props, '[05]\\}$')"),
    ("ERR_INVALID_VALUE", "Value not in allowed list", "NOT label IN ('click', 'view', 'purchase')"),
    ("SHORT_PROPS", "Length < 9", "NOT length(props) >= 9"),
    ("EMPTY_TAGS", "Array is empty", "NOT coalesce(len(tags) > 0, false)"),
]


def dq_custom_rule(spark, sf_dir):
    register_rule("min_value", lambda name, params: F.col(name) >= float(params["min"]), ["min"])
    rules = rules_from_policies(
        [policy("M1", "min_value", "value", "value too small", {"min": "20"})]
    )
    return verdict_view(apply_rules(table(spark, sf_dir, "events"), rules), "event_id")


def filter_valid(spark, sf_dir):
    rows = valid_rows(checked_events(spark, sf_dir), combined_rules())
    return rows.select("event_id", "applicationCode", "label", "props", "value", "time_text")


def filter_error(spark, sf_dir):
    rows = error_rows(checked_events(spark, sf_dir), combined_rules())
    return verdict_view(rows, "event_id", "value", "time_text")


def batch_metrics(spark, sf_dir):
    return count_routes(apply_rules(checked_events(spark, sf_dir), combined_rules()))


def policy_lookup(spark, sf_dir):
    """Policies written to a table, looked up by dataset and applied to all orders."""
    entries = [
        policy("P1", "not_null", "status", "status is missing", dataset="orders"),
        policy("P2", "min_length", "o_orderpriority", "short", {"length": "6"}, ["F", "O"], dataset="orders"),
        policy("P3", "regex_pattern", "o_orderpriority", "not urgent", {"pattern": "^[12]-"}, exclude=["O"], dataset="orders"),
        policy("P9", "not_null", "o_orderkey", "never", dataset="other"),
    ]
    folder = scratch(spark, "policies")
    name = "meta_dq_policy_" + folder[-32:]
    overwrite_table(dq_policies(spark, entries), name, folder)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.nullif("o_orderstatus", F.lit("P")).alias("status")
    )
    rules = load_rules(spark, "orders", name)
    spark.sql(f"DROP TABLE {name}")
    return verdict_view(apply_rules(orders, rules, "status"), "o_orderkey")


def dq_typed_values(spark, sf_dir):
    """Allowed values given as text, for a whole-number and a floating-point column."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    rules = rules_from_policies(
        [
            policy("V1", "allowed_values", "l_linenumber", "odd line", {"values": '["1", "3", "x"]'}),
            policy("V2", "allowed_values", "l_quantity", "odd amount", {"values": '["10", "20.0", 30, "many"]'}),
            policy("V3", "allowed_values", "l_orderkey", "never", {"values": '["none"]'}, ["nowhere"]),
        ]
    )
    verdicts = apply_rules(items.withColumn("applicationCode", F.lit("here")), rules)
    return verdict_view(verdicts, "l_orderkey", "l_linenumber", "l_quantity")


MANY = range(500)


def dq_many_rules(spark, sf_dir):
    """Five hundred scoped rules, one for each part of the orders."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_orderkey") % len(MANY)).cast("string").alias("applicationCode"),
    )
    rules = rules_from_policies(
        [
            policy(f"M{i:03}", "allowed_values", "l_linenumber", f"line {i}", {"values": f'["{i % 7 + 1}", "2"]'}, [str(i)])
            for i in MANY
        ]
    )
    return verdict_view(apply_rules(items, rules), "l_orderkey", "l_linenumber")


QUERIES = {
    f.__name__: f
    for f in (
        dq_typed_values,
        dq_many_rules,
        dq_not_null,
        dq_regex,
        dq_allowed_values,
        dq_min_length,
        dq_array_not_empty,
        dq_iso_timestamp,
        dq_scoped,
        dq_combined,
        dq_unknown_and_missing,
        dq_dict_rules,
        dq_custom_rule,
        filter_valid,
        filter_error,
        batch_metrics,
        policy_lookup,
    )
}

COMBINED_VERDICT_SQL = verdict_sql(
    CHECKED_SQL,
    ["event_id", "value", "props", "applicationCode", "label", "time_text"],
    COMBINED_SQL_RULES,
)

ORACLES = {
    "dq_typed_values": verdict_sql(
        "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
        ["l_orderkey", "l_linenumber", "l_quantity"],
        [("V1", "odd line", "l_linenumber NOT IN (1, 3)"), ("V2", "odd amount", "l_quantity NOT IN (10, 20, 30)")],
    ),
    "dq_many_rules": verdict_sql(
        "SELECT l_orderkey, l_linenumber FROM lineitem",
        ["l_orderkey", "l_linenumber"],
        [(f"M{i:03}", f"line {i}", f"l_orderkey % {len(MANY)} = {i} AND l_linenumber NOT IN ({i % 7 + 1}, 2)") for i in MANY],
    ),
    "dq_not_null": verdict_sql(
        CHECKED_SQL, ["event_id"], [("N1", "label is missing", "label IS NULL")]
    ),
    "dq_regex": verdict_sql(
        "SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS name FROM customer",
        ["c_custkey"],
        [("R1", "odd customer", "NOT regexp_matches(name, '^Customer#[0-9]+[02468]$')")],
    ),
    "dq_allowed_values": verdict_sql(
        "SELECT * FROM events",
        ["event_id"],
        [("A1", "unknown type", "event_type NOT IN ('click', 'purchase', 'signup', 'view')")],
    ),
    "dq_min_length": verdict_sql(
        "SELECT * FROM events", ["event_id"], [("L1", "props too short", "NOT length(props) >= 9")]
    ),
    "dq_array_not_empty": verdict_sql(
        "SELECT doc_id, CASE WHEN source <> 'src1' THEN "
        "list_filter(string_split(text, ' '), lambda w: w = 'the') END AS hits FROM documents",
        ["doc_id"],
        [("T1", "word never used", "NOT coalesce(len(hits) > 0, false)")],
    ),
    "dq_iso_timestamp": verdict_sql(
        CHECKED_SQL, ["event_id"], [("I1", "not an ISO time", f"NOT {ISO_SQL}")]
    ),
    "dq_scoped": verdict_sql(
        CHECKED_SQL,
        ["event_id"],
        [
            ("S3", "no tags", "applicationCode IN ('view', 'error') AND applicationCode NOT IN ('error') AND tags IS NULL"),
            ("S1", "short", "applicationCode IN ('click', 'view') AND NOT length(props) >= 9"),
            ("S2", "no i", "applicationCode NOT IN ('purchase') AND NOT regexp_matches(label, 'i')"),
        ],
    ),
    "dq_combined": verdict_sql(CHECKED_SQL, ["event_id"], COMBINED_SQL_RULES),
    "dq_unknown_and_missing": verdict_sql(
        CHECKED_SQL, ["event_id"], [("U3", "label is missing", "label IS NULL")]
    ),
    "dq_dict_rules": verdict_sql(CHECKED_SQL, ["event_id"], DICT_SQL_RULES),
    "dq_custom_rule": verdict_sql(
        "SELECT * FROM events", ["event_id"], [("M1", "value too small", "NOT value >= 20")]
    ),
    "filter_valid": "SELECT event_id, applicationCode, label, props, value, time_text "
    f"FROM ({COMBINED_VERDICT_SQL}) WHERE is_valid",
    "filter_error": "SELECT event_id, value, time_text, is_valid, rule_ids, messages "
    f"FROM ({COMBINED_VERDICT_SQL}) WHERE NOT is_valid",
    "batch_metrics": "SELECT count(*) FILTER (is_valid) AS valid, "
    f"count(*) FILTER (NOT is_valid) AS error FROM ({COMBINED_VERDICT_SQL})",
    "policy_lookup": verdict_sql(
        "SELECT o_orderkey, o_orderpriority, nullif(o_orderstatus, 'P') AS status FROM orders",
        ["o_orderkey"],
        [
            ("P1", "status is missing", "status IS NULL"),
            ("P2", "short", "status IN ('F', 'O') AND NOT length(o_orderpriority) >= 6"),
            ("P3", "not urgent", "status NOT IN ('O') AND NOT regexp_matches(o_orderpriority, '^[12]-')"),
        ],
    ),
}
