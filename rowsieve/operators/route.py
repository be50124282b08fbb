"""Route the rows of one batch to exactly one of a valid and an error sink."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowsieve.plans.rules import Rule
from rowsieve.plans.verdict import SCOPE_COLUMN, VERDICT, apply_rules, split_verdict, with_verdict
from rowsieve.session import tune_session
from rowsieve.sinks.tables import RouteSink


@dataclass(frozen=True)
class BatchMetrics:
    """How many rows of a batch went where."""

    valid: int
    error: int

    @property
    def total(self) -> int:
        return self.valid + self.error


def _counts():
    return F.count_if(F.col(VERDICT)).alias("valid"), F.count_if(~F.col(VERDICT)).alias("error")


def count_routes(verdicts: DataFrame) -> DataFrame:
    """Valid and error row counts of a DataFrame that has verdict columns."""
    return verdicts.agg(*_counts())


def route_batch(
    df: DataFrame,
    rules: Iterable[Rule],
    valid: RouteSink,
    error: RouteSink,
    batch_id: int = 0,
    scope_column: str = SCOPE_COLUMN,
    storage: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
    committed_counts: bool = False,
) -> BatchMetrics:
    """Evaluate the rules, write both routes and return the row counts.

    The batch is persisted around the two writes, so source and rules are evaluated
    once. With ``storage=None`` nothing is cached and the source is read twice: the
    choice for a backlog too large to hold, given a source that reads the same twice,
    unless one dataset for both routes will do (see :func:`route_once`). The counts are
    observed while the valid route is written, so no job is spent on counting; they
    could only be too high, after the loss of an executor in a ``rebalance`` shuffle. With
    ``committed_counts`` they are taken from the footers of the committed files instead,
    which is exact and costs a job for each route.
    An empty error route is not written, unless an earlier attempt at this batch left
    rows there.
    """
    verdicts = apply_rules(df, rules, scope_column, filtered=storage is None)
    return write_routes(verdicts, valid, error, batch_id, storage, committed_counts)


def write_routes(
    verdicts: DataFrame,
    valid: RouteSink,
    error: RouteSink,
    batch_id: int = 0,
    storage: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
    committed_counts: bool = False,
) -> BatchMetrics:
    """The writing part of :func:`route_batch`, for rows that have their verdict."""
    tune_session(verdicts.sparkSession)
    if storage is not None:
        verdicts = verdicts.persist(storage)
    try:
        counts = Observation()
        valid_part, _ = split_verdict(verdicts.observe(counts, *_counts()))
        valid.write_batch(valid_part, batch_id)
        metrics = BatchMetrics(counts.get["valid"], counts.get["error"])
        _, error_part = split_verdict(verdicts)
        if metrics.error or error.has_batch(
            verdicts.sparkSession, error_part.schema, batch_id
        ):
            error.write_batch(error_part, batch_id)
        if committed_counts:
            spark = verdicts.sparkSession
            return BatchMetrics(
                valid.count_batch(spark, valid_part.schema, batch_id),
                error.count_batch(spark, error_part.schema, batch_id),
            )
        return metrics
    finally:
        if storage is not None:
            verdicts.unpersist()


def route_once(
    df: DataFrame,
    rules: Iterable[Rule],
    sink: RouteSink,
    batch_id: int = 0,
    scope_column: str = SCOPE_COLUMN,
) -> BatchMetrics:
    """Write both routes in one job, as two partitions of one dataset.

    Source and rules are evaluated once and nothing is cached, which makes this the
    cheapest way to route a large backlog. :func:`read_once` gives the routes back.
    """
    return write_once(apply_rules(df, rules, scope_column), sink, batch_id)


def write_once(verdicts: DataFrame, sink: RouteSink, batch_id: int = 0) -> BatchMetrics:
    """The writing part of :func:`route_once`, for rows that have their verdict."""
    tune_session(verdicts.sparkSession)
    counts = Observation()
    _by_verdict(sink).write_batch(verdicts.observe(counts, *_counts()), batch_id)
    return BatchMetrics(counts.get["valid"], counts.get["error"])


def read_once(
    spark: SparkSession, sink: RouteSink, schema: StructType
) -> tuple[DataFrame, DataFrame]:
    """The valid and the error rows that :func:`route_once` wrote, given the data's schema."""
    return split_verdict(_by_verdict(sink).read(spark, with_verdict(schema)))


def _by_verdict(sink: RouteSink) -> RouteSink:
    return replace(sink, partition_keys=(VERDICT, *sink.partition_keys))
