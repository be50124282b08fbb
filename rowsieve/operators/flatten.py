"""Flatten nested columns: structs into columns, arrays into rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from rowsieve.functions.naming import Names, column, require_columns


@dataclass(frozen=True)
class _Field:
    name: str
    type: DataType
    value: Column
    nested: bool  # whether this column takes part


def flatten(
    df: DataFrame,
    outer: bool = False,
    columns: Sequence[str] | None = None,
    on_clash: str = "error",
) -> DataFrame:
    """Flatten until no struct or array column is left; maps stay as they are.

    The first nested column goes first. A struct's fields are appended as
    ``parent_child`` and the parent is dropped; an array gives one row per element
    in place. Rows with an empty or NULL array are dropped unless ``outer`` is set,
    and two arrays in a row give every combination of their elements, so name the
    ``columns`` to flatten when only some are wanted.

    When a new name already exists, ``on_clash`` decides: ``"error"`` raises,
    ``"overwrite"`` replaces the existing column.
    """
    if on_clash not in ("error", "overwrite"):
        raise ValueError(f"on_clash is 'error' or 'overwrite', not {on_clash!r}")
    chosen = None if columns is None else set(require_columns(df, columns, "flatten"))
    explode = F.explode_outer if outer else F.explode
    fields = [
        _Field(f.name, f.dataType, column(f.name), chosen is None or f.name in chosen)
        for f in df.schema.fields
    ]
    names = Names(df.sparkSession)
    changed = False
    while (at := _first_nested(fields)) is not None:
        changed = True
        field = fields[at]
        if isinstance(field.type, StructType):
            fields = _expand(names, fields, at, on_clash)
            continue
        element = _Field(field.name, field.type.elementType, column(field.name), True)
        df = df.select(
            *[(explode(f.value) if f is field else f.value).alias(f.name) for f in fields]
        )
        fields = [
            element if f is field else _Field(f.name, f.type, column(f.name), f.nested)
            for f in fields
        ]
    return df.select(*[f.value.alias(f.name) for f in fields]) if changed else df


def _first_nested(fields: Sequence[_Field]) -> int | None:
    for at, f in enumerate(fields):
        if f.nested and isinstance(f.type, (ArrayType, StructType)):
            return at
    return None


def _expand(names: Names, fields: Sequence[_Field], at: int, on_clash: str) -> list[_Field]:
    """Replace a struct by its fields without a projection of its own."""
    parent = fields[at]
    rest = [f for i, f in enumerate(fields) if i != at]
    for child in parent.type.fields:
        name = f"{parent.name}_{child.name}"
        new = _Field(name, child.dataType, parent.value.getField(child.name), True)
        taken = [i for i, f in enumerate(rest) if names.fold(f.name) == names.fold(name)]
        if not taken:
            rest.append(new)
        elif on_clash == "overwrite":
            rest[taken[0]] = new
        else:
            raise ValueError(f"flattening {parent.name!r} gives {name!r}, which already exists")
    return rest
