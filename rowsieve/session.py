"""Session settings that the jobs rely on for speed, never for results."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Methods above this size are never compiled by the HotSpot JIT.
JIT_METHOD_LIMIT = 8000
# Each open file buffers up to a row group, so only a few at a time.
OPEN_FILES_PER_TASK = 4

_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def tune_session(spark: SparkSession) -> None:
    """Two settings that the jobs make for themselves; the session's own choice stays.

    Many rules in one projection give a method that the JVM only interprets, several
    times slower. Below the method limit Spark uses a projection split into small
    methods instead.

    A task that meets only a few partition values, as bronze with its one ingestion date
    does, writes them side by side instead of sorting all its rows first.
    """
    for name, value in ((_METHOD_LIMIT, JIT_METHOD_LIMIT), (_OPEN_FILES, OPEN_FILES_PER_TASK)):
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, str(value))
