"""JSON messages as variants: parsed once, read by path."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topictables.plans.schema import table_schema

#: The column of a table of parsed messages.
MESSAGE = "message"


def parsed_message(value: Column, mode: str = "FAILFAST") -> Column:
    """The JSON object in message bytes as a variant.

    FAILFAST raises on text that is no object, PERMISSIVE gives null. Unlike `from_json`, text after
    the object and a key that occurs twice make the message invalid.
    """
    text = value.cast("string")
    is_object = F.ltrim(text, F.lit(" \t\r\n")).startswith("{")
    if mode == "PERMISSIVE":
        return F.try_parse_json(F.when(is_object, text))
    problem = F.raise_error(F.lit("a JSON message must be an object")).cast("string")
    return F.parse_json(F.when(is_object, text).otherwise(problem))


def variants(messages: DataFrame, mode: str = "FAILFAST", keep: Sequence[str] = ()) -> DataFrame:
    """Messages with their JSON as a variant in the column `message`, parsed once."""
    value = F.col("value")
    if mode == "FAILFAST":
        value = F.coalesce(value, F.raise_error(F.lit("null message")).cast("binary"))
    # Exploding one array keeps filters on paths above the parser.
    parsed = F.explode(F.array(parsed_message(value, mode)))
    return messages.select(*keep, parsed.alias(MESSAGE))


def field_path(name: str) -> str:
    """The path of a field of an object, whatever its name."""
    for quote in ("'", '"'):
        if quote not in name:
            return f"$[{quote}{name}{quote}]"
    raise ValueError(f"a field with both kinds of quotes has no path: {name}")


def value_at(variant: Column, path: str, kind: T.DataType, mode: str = "FAILFAST") -> Column:
    """The value at a path; null where there is none. One that has no such type raises, or is null if
    the mode is PERMISSIVE. Bytes are base64 text; those within records, maps or arrays are refused."""
    get = F.try_variant_get if mode == "PERMISSIVE" else F.variant_get
    if isinstance(kind, T.BinaryType):
        text = get(variant, path, "string")
        return F.try_to_binary(text, F.lit("base64")) if mode == "PERMISSIVE" else F.unbase64(text)
    if "binary" in re.findall(r"\w+", kind.simpleString()):
        raise ValueError("bytes within a record, map or array cannot be read out of a variant")
    if isinstance(kind, T.NullType):
        return F.lit(None)
    return get(variant, path, kind.simpleString())


def variant_value(variant: Column, field: T.StructField, mode: str = "FAILFAST") -> Column:
    """A declared field of an object."""
    return value_at(variant, field_path(field.name), field.dataType, mode)


def variant_paths(table: DataFrame, paths: Mapping[str, tuple[str, object]], column: str = MESSAGE, mode: str = "FAILFAST") -> DataFrame:
    """The columns of a table of variants and, for each name, what is at a path, as the given type.

    Paths are Spark's: `$.labels.flag`, `$.stops[0].day` (array positions count from 0 there). A path
    that leads nowhere gives null.
    """
    declared = table_schema({name: kind for name, (_, kind) in paths.items()})
    values = [value_at(F.col(column), paths[f.name][0], f.dataType, mode).alias(f.name) for f in declared]
    return table.select("*", *values)


def variant_schema(table: DataFrame, column: str = MESSAGE) -> T.StructType:
    """The schema that holds all objects of a bounded table, where none is declared.

    One aggregation with a partial one in front of the shuffle; one text comes to the driver. Fields
    that are always null are text, fields of several types stay variants.
    """
    text = table.agg(F.schema_of_variant_agg(column)).first()[0]
    # Names stand in backquotes where they could be mistaken for a type.
    words = re.sub(r"`[^`]*(?:``[^`]*)*`|\bOBJECT<|\bVOID\b", lambda m: {"OBJECT<": "STRUCT<", "VOID": "STRING"}.get(m[0], m[0]), text)
    if not words.startswith("STRUCT<"):
        return T.StructType()
    return T.StructType.fromDDL(f"c {words}")["c"].dataType
