"""Time the headline queries and print one JSON line.

``queries`` holds seconds per query; ``value`` is their sum. ``compare`` holds the plain
way of doing the same work, which the reader of the numbers can set against them: a column
for each rule, and a batch routed without a cache and counted by reading it back.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve.operators.route import route_batch
from rowsieve.plans.rules import Rule
from rowsieve.plans.verdict import ERRORS_TYPE, apply_rules, bind_rules, split_verdict
from rowsieve.queries import QUERIES
from rowsieve.queries.common import scratch, table
from rowsieve.queries.jobs import run_bronze, silver_rules
from rowsieve.queries.rules import checked_events, combined_rules
from rowsieve.session import tune_session
from rowsieve.sinks.tables import RouteSink
from rowsieve.streaming.silver import await_end, start_silver

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune_session(spark)
    return spark


def lineitem_rules(count: int) -> list[Rule]:
    """Rules of four types, a third of them scoped, over the lineitem table."""
    kinds = [
        ("regex_pattern", "l_comment_text", lambda i: {"pattern": f"^[0-9]+/[1-9][0-9]{{0,{i}}}$"}),
        ("min_length", "l_comment_text", lambda i: {"length": 3 + i % 2}),
        ("allowed_values", "l_returnflag", lambda i: {"values": ["A", "N", "R"][: 2 + i % 3] + [f"X{i}"]}),
        ("not_null", "l_shipdate", lambda i: {}),
    ]
    rules = []
    for i in range(count):
        kind, column, params = kinds[i % 4]
        include = ("O", f"Z{i}") if i % 3 == 0 else None
        rules.append(Rule(f"R{i:03}", kind, column, params(i), f"rule {i}", include))
    return rules


def lineitem(spark: SparkSession) -> DataFrame:
    text = F.concat_ws("/", "l_orderkey", "l_linenumber")
    return table(spark, SF_DIR, "lineitem").withColumn("l_comment_text", text)


def wide_rules(df: DataFrame, rules: list[Rule], scope: str) -> DataFrame:
    """The same verdict in the plain way: a column for each rule's entry, then one step
    that collects them."""
    marked = df
    for i, b in enumerate(bind_rules(df, rules, scope)):
        texts = (b.rule.rule_id, b.rule.column, b.rule.message)
        marked = marked.withColumn(f"entry_{i}", F.when(F.coalesce(b.fails, F.lit(True)), F.struct(*map(F.lit, texts))))
    entries = F.array_compact(F.array(*[c for c in marked.columns if c.startswith("entry_")]))
    return marked.select(*df.columns, entries.cast(ERRORS_TYPE).alias("dq_errors"), (F.size(entries) == 0).alias("is_valid"))


def route_plainly(df: DataFrame, rules: list[Rule], folder: str) -> None:
    """Each route filtered from the uncached verdicts, written, and read back to be counted."""
    for name, part in zip(("valid", "error"), split_verdict(apply_rules(df, rules)), strict=True):
        part.write.partitionBy("applicationCode").parquet(f"{folder}/{name}")
        df.sparkSession.read.schema(part.schema).parquet(f"{folder}/{name}").count()


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def best(work, runs: int = 2) -> float:
    return min(seconds(work) for _ in range(runs))


def main() -> None:
    spark = session()
    items, events = lineitem(spark), checked_events(spark, SF_DIR)
    consume(items)
    consume(apply_rules(events, combined_rules()))

    timed, compare = {}, {}
    for name, query in QUERIES.items():
        timed[name] = best(lambda: consume(query(spark, SF_DIR)))  # noqa: B023
    for count in (5, 20, 40, 100):
        rules = lineitem_rules(count)
        one_pass = lambda: consume(apply_rules(items, rules, "l_linestatus"))  # noqa: B023, E731
        wide = lambda: consume(wide_rules(items, rules, "l_linestatus"))  # noqa: B023, E731
        timed[f"rules_{count}_one_pass"] = best(one_pass)
        compare[f"rules_{count}_wide"] = best(wide)

    def routed() -> None:
        folder = scratch(spark, "bench")
        sinks = [RouteSink(f"{folder}/{n}", ("applicationCode",)) for n in ("valid", "error")]
        route_batch(events, combined_rules(), *sinks)

    timed["route_observed"] = best(routed)
    compare["route_plain"] = best(
        lambda: route_plainly(events, combined_rules(), scratch(spark, "bench"))
    )

    rows = {"lineitem": items.count(), "events": events.count()}
    rate = {f"rules_{n}_rows_per_sec": round(rows["lineitem"] / timed[f"rules_{n}_one_pass"]) for n in (5, 20, 40, 100)}
    # The silver job alone, over a bronze table that is there.
    config = run_bronze(spark, SF_DIR, "bench")
    timed["silver_job"] = seconds(lambda: await_end(start_silver(spark, config, silver_rules())))
    rate["silver_job_rows_per_sec"] = round(rows["events"] / timed["silver_job"])
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "compare": compare,
                "rates": rate,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
