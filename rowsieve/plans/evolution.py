"""How one schema follows from another, and expressions that bring rows from one to the other."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql.types import (
    ArrayType,
    AtomicType,
    BinaryType,
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

# Integral types by width, with the decimal digits of each.
_DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 19}
ADDED, WIDENED, BREAKING = "added", "widened", "breaking"


@dataclass(frozen=True)
class Change:
    """What became of one field, by its path; ``kind`` is added, widened or breaking."""

    path: str
    kind: str
    before: str | None
    after: str | None

    def __str__(self) -> str:
        return f"{self.path}: {self.before or 'absent'} -> {self.after or 'absent'} ({self.kind})"


class BreakingChange(ValueError):
    """A schema version that rows of an earlier one do not fit."""

    def __init__(self, step: str, changes: Iterable[Change]):
        self.changes = [c for c in changes if c.kind == BREAKING]
        super().__init__(f"{step}: " + "; ".join(map(str, self.changes)))


def compare(old: StructType, new: StructType, case_sensitive: bool = False) -> list[Change]:
    """The changes from one schema to the next, nested fields by their paths.

    A new field is added if it may be NULL; a type is widened if it takes every value of
    the old one, as is a field that may be NULL from now on. All else is breaking: fields
    that are gone, narrower or other types, and fields that may no longer be NULL.
    """
    return _fields(old, new, "", case_sensitive)


def _fields(old: StructType, new: StructType, prefix: str, exact: bool) -> list[Change]:
    fold = (lambda n: n) if exact else str.lower
    before = {fold(f.name): f for f in old}
    out = []
    for field in new:
        path = prefix + field.name
        was = before.pop(fold(field.name), None)
        if was is None:
            out.append(Change(path, ADDED if field.nullable else BREAKING, None, _text(field.dataType, field.nullable)))
        else:
            out += _types(was.dataType, field.dataType, was.nullable, field.nullable, path, exact)
    gone = [Change(prefix + f.name, BREAKING, _text(f.dataType, f.nullable), None) for f in before.values()]
    return out + gone


def _types(old: DataType, new: DataType, old_null: bool, new_null: bool, path: str, exact: bool) -> list[Change]:
    out = []
    if old_null != new_null:
        kind = WIDENED if new_null else BREAKING
        out.append(Change(path, kind, _text(old, old_null), _text(new, new_null)))
    if isinstance(old, StructType) and isinstance(new, StructType):
        return out + _fields(old, new, path + ".", exact)
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return out + _types(old.elementType, new.elementType, old.containsNull, new.containsNull, path + "[]", exact)
    if isinstance(old, MapType) and isinstance(new, MapType) and old.keyType == new.keyType:
        values = (old.valueType, new.valueType, old.valueContainsNull, new.valueContainsNull)
        return out + _types(*values, path + "{}", exact)
    if old != new:
        kind = WIDENED if widest(old, new) == new else BREAKING
        out.append(Change(path, kind, _text(old), _text(new)))
    return out


def _text(kind: DataType, nullable: bool = True) -> str:
    return kind.simpleString() + ("" if nullable else " not null")


def widest(a: DataType, b: DataType) -> DataType | None:
    """The narrowest type that takes every value of both, or None.

    Numbers widen without loss (a long is no double); every other atomic type but binary
    has a text form. Structs have the fields of both, by name whatever its case.
    """
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        return widest_schema([a, b], strict=False)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        inner = widest(a.elementType, b.elementType)
        return inner and ArrayType(inner, a.containsNull or b.containsNull)
    if isinstance(a, MapType) and isinstance(b, MapType):
        inner = widest(a.valueType, b.valueType) if a.keyType == b.keyType else None
        return inner and MapType(a.keyType, inner, a.valueContainsNull or b.valueContainsNull)
    return _number(a, b) or _as_text(a, b)


def _number(a: DataType, b: DataType) -> DataType | None:
    if a in _DIGITS and b in _DIGITS:
        return max(a, b, key=_DIGITS.get)
    floats = [k for k in (a, b) if isinstance(k, (FloatType, DoubleType))]
    if len(floats) == 2:
        return DoubleType()
    if floats:
        # A float holds integers of 24 bits, a double those of 53.
        [real], other = floats, b if a in floats else a
        if other in (ByteType(), ShortType()):
            return real
        return DoubleType() if other == IntegerType() else None
    wide = [_decimal(k) for k in (a, b)]
    if None in wide:
        return None
    scale = max(k.scale for k in wide)
    precision = max(k.precision - k.scale for k in wide) + scale
    return DecimalType(precision, scale) if precision <= 38 else None


def _decimal(kind: DataType) -> DecimalType | None:
    if isinstance(kind, DecimalType):
        return kind
    return DecimalType(_DIGITS[kind], 0) if kind in _DIGITS else None


def _as_text(a: DataType, b: DataType) -> DataType | None:
    """Text takes values of other types, but two types do not both turn into text."""
    other = b if isinstance(a, StringType) else a if isinstance(b, StringType) else None
    fits = isinstance(other, AtomicType) and not isinstance(other, BinaryType)
    return StringType() if fits else None


def widest_schema(schemas: Iterable[StructType], strict: bool = True) -> StructType | None:
    """The fields of all schemas in order of appearance, each with the widest of its types.

    Without a common type this raises and names the field; if not ``strict`` it is None.
    """
    return reduce(lambda a, b: None if a is None else _merged(a, b, strict), schemas)


def _merged(a: StructType, b: StructType, strict: bool) -> StructType | None:
    theirs = {f.name.lower(): f for f in b}
    out = []
    for field in a:
        other = theirs.pop(field.name.lower(), None)
        if other is None:
            out.append(StructField(field.name, field.dataType, True))
            continue
        kind = widest(field.dataType, other.dataType)
        if kind is None:
            if strict:
                raise ValueError(f"column {field.name!r}: no type takes {_text(field.dataType)} and {_text(other.dataType)}")
            return None
        out.append(StructField(field.name, kind, field.nullable or other.nullable))
    return StructType(out + [StructField(f.name, f.dataType, True) for f in theirs.values()])


def conform_sql(have: StructType, want: StructType) -> list[str]:
    """One SQL expression for each wanted column over rows of another schema.

    Nested fields are matched by name, not by place. Absent ones are NULL, and so are
    values that the wanted type does not take, whatever the session's ANSI setting.
    """
    return [f"{e} AS {_quote(f.name)}" for e, f in zip(_by_name(None, have, want, 0), want)]


def _by_name(value: str | None, have: StructType, want: StructType, depth: int) -> list[str]:
    known = {f.name.lower(): f for f in have}
    out = []
    for field in want:
        mine = known.get(field.name.lower())
        if mine is None:
            out.append(f"CAST(NULL AS {field.dataType.simpleString()})")
        else:
            path = _quote(mine.name) if value is None else f"{value}.{_quote(mine.name)}"
            out.append(_convert(path, mine.dataType, field.dataType, depth))
    return out


def _convert(value: str, have: DataType, want: DataType, depth: int) -> str:
    if have == want:
        return value
    if isinstance(have, StructType) and isinstance(want, StructType):
        parts = zip(want.names, _by_name(value, have, want, depth))
        made = ", ".join(f"{e} AS {_quote(name)}" for name, e in parts)
        return f"CASE WHEN {value} IS NOT NULL THEN struct({made}) END"
    item = f"_x{depth}"
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return f"transform({value}, {item} -> {_convert(item, have.elementType, want.elementType, depth + 1)})"
    if isinstance(have, MapType) and isinstance(want, MapType) and have.keyType == want.keyType:
        made = _convert(item, have.valueType, want.valueType, depth + 1)
        return f"transform_values({value}, (_k{depth}, {item}) -> {made})"
    return f"try_cast({value} AS {want.simpleString()})"


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
