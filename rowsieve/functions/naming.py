"""Column-name helpers shared by the operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PLAIN = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def quote(name: str) -> str:
    """Quote a column name that Spark would otherwise parse as a path."""
    return name if _PLAIN.fullmatch(name) else "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quote(name))


class Names:
    """Looks names up the way the session does: by default whatever their case."""

    def __init__(self, spark: SparkSession, names: Iterable[str] = ()):
        setting = spark.conf.get("spark.sql.caseSensitive", "false")
        self._sensitive = str(setting).lower() == "true"
        self._names = {}
        for name in names:
            self._names.setdefault(self.fold(name), name)

    @classmethod
    def of(cls, df: DataFrame) -> Names:
        return cls(df.sparkSession, df.columns)

    def fold(self, name: str) -> str:
        """The form under which two names count as the same."""
        return name if self._sensitive else name.lower()

    def find(self, name: str) -> str | None:
        """The spelling that is there, or None when the name is absent."""
        return self._names.get(self.fold(name))


def find_column(df: DataFrame, name: str) -> str | None:
    return Names.of(df).find(name)


def require_columns(df: DataFrame, names: Sequence[str], purpose: str) -> list[str]:
    known = Names.of(df)
    missing = [n for n in names if known.find(n) is None]
    if missing:
        raise ValueError(f"{purpose}: no column {missing} among {df.columns}")
    return [known.find(n) for n in names]
