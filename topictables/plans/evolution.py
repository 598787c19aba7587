"""Compatibility of schemas: two nested types made one, with the casts that lead there."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The order in which a narrower number is promoted to a wider one.
NUMBERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType())
WHOLE_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}


class SchemaConflict(ValueError):
    """Two types that no value can have both of; `path` says where in the schema."""

    def __init__(self, path: str, one: T.DataType, other: T.DataType):
        super().__init__(f"{path or 'the schema'}: {one.simpleString()} and {other.simpleString()} have no common type")
        self.path = path


def unified(one: T.DataType, other: T.DataType, aliases: Mapping[str, str] | None = None, path: str = "") -> T.DataType:
    """The narrowest type that both can be cast to without loss of meaning.

    Numbers are promoted to the wider one, decimals to enough digits, dates to timestamps, text and
    bytes to bytes; a void takes the other type. Fields of records are matched by name, those of the
    first record first; one that only a single record has becomes nullable. `aliases` gives, by its
    path in the second type, the name that a field has in the first.
    """
    aliases = aliases or {}
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        theirs = _renamed(other, aliases, path)
        fields = []
        for f in one.fields:
            twin = theirs.pop(f.name, None)
            if twin is None:
                fields.append(T.StructField(f.name, f.dataType, True, f.metadata))
            else:
                kind = unified(f.dataType, twin.dataType, aliases, _at(path, f.name))
                fields.append(T.StructField(f.name, kind, f.nullable or twin.nullable, f.metadata))
        return T.StructType(fields + [T.StructField(name, f.dataType, True, f.metadata) for name, f in theirs.items()])
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        items = unified(one.elementType, other.elementType, aliases, f"{path}[]")
        return T.ArrayType(items, one.containsNull or other.containsNull)
    if isinstance(one, T.MapType) and isinstance(other, T.MapType):
        keys = unified(one.keyType, other.keyType, aliases, f"{path}{{key}}")
        values = unified(one.valueType, other.valueType, aliases, f"{path}{{}}")
        return T.MapType(keys, values, one.valueContainsNull or other.valueContainsNull)
    found = _atomic(one, other) or _atomic(other, one)
    if found is None:
        raise SchemaConflict(path, one, other)
    return found


def _at(path: str, name: str) -> str:
    return f"{path}.{name}" if path else name


def _renamed(record: T.StructType, aliases: Mapping[str, str], path: str) -> dict[str, T.StructField]:
    """The fields of the second record by the names that they have in the first."""
    found: dict[str, T.StructField] = {}
    for f in record.fields:
        name = aliases.get(_at(path, f.name), f.name)
        if name in found:
            raise ValueError(f"two fields are called {_at(path, name)}")
        found[name] = f
    return found


def _atomic(one: T.DataType, other: T.DataType) -> T.DataType | None:
    if one == other or isinstance(other, T.NullType):
        return one
    if one in NUMBERS and other in NUMBERS:
        return NUMBERS[max(NUMBERS.index(one), NUMBERS.index(other))]
    if isinstance(one, T.DecimalType):
        if isinstance(other, T.DecimalType):
            whole, scale = max(k.precision - k.scale for k in (one, other)), max(one.scale, other.scale)
        elif other in WHOLE_DIGITS:
            whole, scale = max(one.precision - one.scale, WHOLE_DIGITS[other]), one.scale
        else:
            return T.DoubleType() if other in NUMBERS else None
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if isinstance(one, T.DateType) and isinstance(other, (T.TimestampType, T.TimestampNTZType)):
        return other
    if isinstance(one, T.StringType) and isinstance(other, T.BinaryType):
        return other
    return None


def evolved(
    value: Column,
    have: T.DataType,
    want: T.DataType,
    aliases: Mapping[str, str] | None = None,
    defaults: Mapping[str, object] | None = None,
    path: str = "",
) -> Column:
    """A value of one type as the other, to which `unified` has led: the cast plan.

    `aliases` as there, for the type that the value has; a field that it lacks is null, or the entry of
    `defaults` for its path. A field that the wanted type lacks is left out.
    """
    aliases, defaults = aliases or {}, defaults or {}
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        fields, columns = _renamed(have, aliases, path), []
        for f in want.fields:
            place = _at(path, f.name)
            if f.name in fields:
                source = fields[f.name]
                column = evolved(value.getField(source.name), source.dataType, f.dataType, aliases, defaults, place)
            else:
                column = F.lit(defaults.get(place)).cast(f.dataType)
            columns.append(column.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*columns))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda item: evolved(item, have.elementType, want.elementType, aliases, defaults, f"{path}[]"))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        keyed = F.transform_keys(value, lambda k, _: evolved(k, have.keyType, want.keyType, aliases, defaults, f"{path}{{key}}"))
        return F.transform_values(keyed, lambda _, v: evolved(v, have.valueType, want.valueType, aliases, defaults, f"{path}{{}}"))
    if have == want:
        return value
    if _atomic(have, want) != want and _atomic(want, have) != want:
        raise SchemaConflict(path, have, want)
    return value.cast(want)
