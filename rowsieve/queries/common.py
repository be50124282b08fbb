"""What the registered queries share: tables, scratch space, verdict SQL."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsieve.plans.verdict import ERRORS, VERDICT, error_ids
from rowsieve.session import tune_session

SECONDS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SECONDS_SQL = "%Y-%m-%d %H:%M:%S.%f"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    tune_session(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder in the shared space that the session names for such files.

    Only a local session without that setting falls back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/rowsieve-{purpose}-{uuid.uuid4().hex}"


def messages() -> Column:
    return F.array_join(F.transform(F.col(ERRORS), lambda e: e["message"]), "|")


def verdict_view(verdicts: DataFrame, *keep: str) -> DataFrame:
    """Verdict columns as scalars."""
    return verdicts.select(
        *keep, VERDICT, error_ids().alias("rule_ids"), messages().alias("messages")
    )


def verdict_sql(source: str, keep: Sequence[str], rules: Sequence[tuple[str, str, str]]) -> str:
    """The verdict of rules ``(id, message, fails)`` over a source query, in plain SQL.

    ``fails`` is a three-valued SQL expression; entries come in the order given.
    """
    fails = ", ".join(f"({f}) AS f{i}" for i, (_, _, f) in enumerate(rules))
    v3 = " AND ".join(f"NOT f{i}" for i in range(len(rules)))

    def joined(separator: str, texts: Sequence[str], prefix: str = "") -> str:
        sure = ", ".join(f"CASE WHEN f{i} THEN '{t}' END" for i, t in enumerate(texts))
        unsure = ", ".join(f"CASE WHEN f{i} IS NULL THEN '{prefix}{t}' END" for i, t in enumerate(texts))
        return (
            f"CASE WHEN v3 THEN '' WHEN v3 IS NULL THEN concat_ws('{separator}', {unsure}) "
            f"ELSE concat_ws('{separator}', {sure}) END"
        )

    return (
        f"WITH src AS ({source}), outcomes AS (SELECT *, {fails} FROM src), "
        f"verdicts AS (SELECT *, {v3} AS v3 FROM outcomes) "
        f"SELECT {', '.join(keep)}, coalesce(v3, false) AS is_valid, "
        f"{joined(',', [r[0] for r in rules])} AS rule_ids, "
        f"{joined('|', [r[1] for r in rules], 'undetermined: ')} AS messages FROM verdicts"
    )
