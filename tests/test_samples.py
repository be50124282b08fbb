"""The sample event log: its policies, its rule set and the rows they are meant for."""

import pytest
from pyspark.sql import functions as F

from rowsieve.operators import add_event_date, add_platform, parse_timestamp, rename_present
from rowsieve.plans import apply_rules, rules_from_dict, rules_from_policies
from rowsieve.sources import dq_policies, load_rules

# Application codes, UUID pattern, sample policies and sample rule set.
APPLICATIONS = [
    "App-Mobile-iOS",
    "App-Mobile-Android",
    "Web-Banking-Portal",
    "ATM-Interface",
    "Branch-CRM",
    "Partner-API",
]
UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
POLICIES = [
    ("DQ_001", "not_null", "signInId", {}, ["ALL"], [], "signInId is missing"),
    ("DQ_002", "not_null", "viewedFieldNames", {}, ["Web-Banking-Portal"], [], "Web Portal events must have viewed fields"),
    ("DQ_003", "regex_pattern", "signInId", {"pattern": UUID_PATTERN}, ["ALL"], ["ATM-Interface"], "Invalid UUID format"),
    ("DQ_004", "array_not_empty", "viewedFieldNames", {}, ["ALL"], [], "viewedFieldNames array is empty"),
    ("DQ_005", "is_iso_timestamp", "eventTimestamp", {}, ["ALL"], [], "Invalid ISO timestamp format"),
]
RULE_SET = {
    "not_null": {
        "columns": ["signInId", "customerId", "applicationCode", "eventTimestamp", "viewedFieldNames"],
        "ruleId": "ERR_NULL_CHECK",
    },
    "regex_pattern": [{"column": "signInId", "pattern": UUID_PATTERN, "ruleId": "ERR_INVALID_UUID"}],
    "allowed_values": [{"column": "applicationCode", "values": APPLICATIONS, "ruleId": "ERR_INVALID_APP_CODE"}],
    "min_length": [{"column": "customerId", "length": 10, "ruleId": "ERR_SHORT_CUST_ID"}],
    "array_not_empty": {"columns": ["viewedFieldNames"], "ruleId": "ERR_EMPTY_VIEWED_FIELDS"},
}

UUID = "0f8fad5b-d9cb-469f-a165-70867728950e"
TIME = "2024-01-02T03:04:05.123Z"
WEB, ATM, MOBILE = "Web-Banking-Portal", "ATM-Interface", "App-Mobile-iOS"
ROWS = {
    # name: (signInId, customerId, applicationCode, eventTimestamp, viewedFieldNames), policy ids
    "good": ((UUID, "CUSTOMERID1", WEB, TIME, ["a"]), []),
    "no id": ((None, "CUSTOMERID1", WEB, TIME, ["a"]), ["DQ_001"]),
    "no id at an ATM": ((None, "CUSTOMERID1", ATM, TIME, ["a"]), ["DQ_001"]),
    "old id at an ATM": (("42", "CUSTOMERID1", ATM, TIME, ["a"]), []),
    "old id elsewhere": (("42", "CUSTOMERID1", MOBILE, TIME, ["a"]), ["DQ_003"]),
    "good id, no application": ((UUID, "CUSTOMERID1", None, TIME, ["a"]), []),
    "old id, no application": (("42", "CUSTOMERID1", None, TIME, ["a"]), ["DQ_003?"]),
    "no array on the web": ((UUID, "CUSTOMERID1", WEB, TIME, None), ["DQ_002", "DQ_004"]),
    "no array on mobile": ((UUID, "CUSTOMERID1", MOBILE, TIME, None), ["DQ_004"]),
    "no array, no application": ((UUID, "CUSTOMERID1", None, TIME, None), ["DQ_004"]),
    "empty array": ((UUID, "CUSTOMERID1", WEB, TIME, []), ["DQ_004"]),
    "time with offset": ((UUID, "CUSTOMERID1", WEB, "2024-01-02T03:04:05.123+02:00", ["a"]), []),
    "time with six digits": ((UUID, "CUSTOMERID1", WEB, "2024-01-02T03:04:05.123456+00:00", ["a"]), ["DQ_005"]),
    "time without fraction": ((UUID, "CUSTOMERID1", WEB, "2024-01-02T03:04:05+00:00", ["a"]), ["DQ_005"]),
    "date only": ((UUID, "CUSTOMERID1", WEB, "2024-01-02", ["a"]), ["DQ_005"]),
    "no time": ((UUID, "CUSTOMERID1", WEB, None, ["a"]), ["DQ_005"]),
    "several": (("42", "short", MOBILE, "bad", []), ["DQ_003", "DQ_005", "DQ_004"]),
}
SILVER = "name string, signInId string, customerId string, applicationCode string, eventTimestamp string, viewedFieldNames array<string>"


def policies(spark):
    names = (
        "policy_id", "rule_type", "target_column", "rule_params",
        "app_scope_inclusion", "app_scope_exclusion", "error_message",
    )
    return dq_policies(spark, [{"dataset_name": "event_log", **dict(zip(names, p))} for p in POLICIES])


@pytest.fixture(params=["true", "false"], ids=["ansi", "no_ansi"])
def events(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield spark.createDataFrame([(n, *values) for n, (values, _) in ROWS.items()], SILVER)
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_sample_policies(spark, events):
    rules = load_rules(spark, "event_log", policies(spark))
    assert rules == rules_from_policies(policies(spark).collect()[::-1])
    texts = {p[0]: p[-1] for p in POLICIES}
    for row in apply_rules(events, rules).collect():
        want = ROWS[row.name][1]
        assert [e.rule_id for e in row.dq_errors] == [w.rstrip("?") for w in want], row.name
        assert [e.message for e in row.dq_errors] == [
            "undetermined: " + texts[w[:-1]] if w.endswith("?") else texts[w] for w in want
        ]
        assert row.is_valid == (not want)


def test_sample_rule_set(spark, events):
    wrong = spark.createDataFrame(
        [("unknown application", UUID, "CUSTOMERID1", "App-Desktop", TIME, ["a"])], SILVER
    )
    # The rule set looks at parsed times, as the silver job does.
    typed = parse_timestamp(events.unionByName(wrong))
    verdicts = {r.name: r for r in apply_rules(typed, rules_from_dict(RULE_SET)).collect()}
    ids = {n: [(e.rule_id, e.column) for e in r.dq_errors] for n, r in verdicts.items()}
    assert ids["good"] == [] and verdicts["good"].is_valid
    assert ids["time with six digits"] == [] and ids["date only"] == []
    assert ids["no id"] == [("ERR_NULL_CHECK", "signInId")]
    assert ids["old id at an ATM"] == [("ERR_INVALID_UUID", "signInId")]
    assert ids["good id, no application"] == [("ERR_NULL_CHECK", "applicationCode")]
    assert ids["unknown application"] == [("ERR_INVALID_APP_CODE", "applicationCode")]
    assert ids["no array on mobile"] == [
        ("ERR_NULL_CHECK", "viewedFieldNames"),
        ("ERR_EMPTY_VIEWED_FIELDS", "viewedFieldNames"),
    ]
    assert ids["several"] == [
        ("ERR_NULL_CHECK", "eventTimestamp"),
        ("ERR_INVALID_UUID", "signInId"),
        ("ERR_SHORT_CUST_ID", "customerId"),
        ("ERR_EMPTY_VIEWED_FIELDS", "viewedFieldNames"),
    ]
    assert verdicts["several"].dq_errors[1].message == f"Pattern match failed: {UUID_PATTERN}"


def test_rename_map_form(spark):
    """The other way to standardise: a fixed map of names, time parsed in place."""
    # Source and target names.
    names = {
        "signInID": "signInId", "customerID": "customerId", "applicationID": "applicationCode",
        "eventDateTimestamp": "eventTimestamp", "viewedField": "viewedFieldNames",
    }
    raw = spark.createDataFrame(
        [(UUID, MOBILE, TIME), (UUID, None, "bad")], "signInID string, applicationID string, eventDateTimestamp string"
    )
    out = add_platform(add_event_date(parse_timestamp(rename_present(raw, names))))
    assert out.columns == ["signInId", "applicationCode", "eventTimestamp", "eventDate", "platform_type"]
    got = out.select(F.col("eventDate").cast("string"), "platform_type").collect()
    assert [tuple(r) for r in got] == [("2024-01-02", "App"), (None, None)]
