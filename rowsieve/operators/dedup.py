"""Keep one row per declared key.

A row without any key value identifies nothing, so it is a copy only of a row that
equals it in every column: malformed input, whose keys are all NULL, is not lost.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from rowsieve.functions.naming import column, require_columns

_RANK = "_rank_in_key"
_CONTENT = "_content_without_key"
_SALT = "_key_salt"


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] = ()) -> DataFrame:
    """One row per key; with ``order_by`` the first row in that order.

    Without an order the surviving row is any of its group. Copies are reduced before
    the shuffle, by partial aggregation where every column is a key and else by a rank
    limit in each task, so a key that holds a large share of the rows does not load one
    task.
    """
    keys = require_columns(df, keys, "dedup")
    if set(keys) == set(df.columns):
        return df.dropDuplicates()
    group = [column(k) for k in keys] + [F.col(_CONTENT)]
    window = Window.partitionBy(*group).orderBy(*(order_by or group[:1]))
    ranked = _with_content(df, keys).withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK, _CONTENT)


def dedup_stream(
    df: DataFrame, keys: Sequence[str], event_time: str, delay: str, salts: int = 16
) -> DataFrame:
    """One row per key in a stream; state is kept for ``delay`` of event time.

    Rows later than that are discarded by the watermark, also if no copy of them came
    before; :func:`dropped_as_late` counts them. A row without an event time never is, and
    its copies are recognised within one micro-batch only.

    A stream cannot aggregate before its shuffle, so the copies of a hot key would all
    meet in one task. They are first reduced within ``salts`` parts of each key, by the
    input partition they came in, and then across the parts. Where no key is hot,
    ``salts=1`` saves that step and its state.

    State for a long delay belongs in a store on disk: set
    ``spark.sql.streaming.stateStore.providerClass`` to Spark's RocksDB provider.
    """
    keys = require_columns(df, keys, "dedup_stream")
    [time] = require_columns(df, [event_time], "dedup_stream")
    rows = _with_content(df, keys)
    if salts > 1:
        salt = F.pmod(F.spark_partition_id(), F.lit(salts))
        rows = rows.withColumn(_SALT, salt).withWatermark(time, delay)
        rows = rows.dropDuplicatesWithinWatermark([*keys, _CONTENT, _SALT]).drop(_SALT)
    else:
        rows = rows.withWatermark(time, delay)
    return rows.dropDuplicatesWithinWatermark([*keys, _CONTENT]).drop(_CONTENT)


def _with_content(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the whole row as a value of its own where every key column is NULL."""
    return df.withColumn(_CONTENT, F.when(without_keys(keys), F.struct(*comparable_columns(df).values())))


def without_keys(keys: Sequence[str]) -> Column:
    """Whether every key column is NULL."""
    return reduce(and_, [column(k).isNull() for k in keys])


def comparable_columns(df: DataFrame) -> dict[str, Column]:
    """All columns by name, in forms that Spark can group by."""
    return {f.name: _groupable(column(f.name), f.dataType).alias(f.name) for f in df.schema.fields}


def _groupable(value: Column, kind: DataType) -> Column:
    """Maps as their entries in order of the key, variants as text; NULL stays NULL."""
    if not _has_map(kind):
        return value
    if isinstance(kind, MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(e["key"].alias("key"), _groupable(e["value"], kind.valueType).alias("value")),
        )
        return F.array_sort(entries)
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _groupable(x, kind.elementType))
    if isinstance(kind, StructType):
        fields = [_groupable(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return F.to_json(value)


def _has_map(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (MapType, VariantType))


def dropped_as_late(query: StreamingQuery) -> int:
    """Rows that a stream has discarded so far because they came after the watermark.

    Spark keeps the progress of the last 100 micro-batches, so sum the results of
    ``query.recentProgress`` on a schedule where a stream runs for longer.
    """
    return sum(
        state.numRowsDroppedByWatermark for progress in query.recentProgress for state in progress.stateOperators
    )
