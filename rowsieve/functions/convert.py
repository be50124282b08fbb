"""Scalar conversions of the standardising step, all built-in Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_event_timestamp(text: Column) -> Column:
    """Text to timestamp; malformed text gives NULL in every ANSI mode."""
    return F.try_to_timestamp(text)


def leading_token(text: Column, separator: str = "-") -> Column:
    """The text before the first separator (all of it when there is none)."""
    return F.substring_index(text, separator, 1)
