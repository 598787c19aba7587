"""JSON messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def from_json_message(value: Column, schema: T.StructType, mode: str = "FAILFAST") -> Column:
    """The declared fields of a JSON object as a struct; absent fields are null.

    FAILFAST raises on an empty message and on a bare `null`, from which `from_json` makes a row of
    nulls. As in Spark, text after the object is not looked at.
    """
    text = value.cast("string")
    if mode == "FAILFAST":
        blank = F.btrim(text, F.lit(" \t\r\n")).isin("", "null")
        text = F.when(blank, F.raise_error(F.lit("empty JSON message")).cast("string")).otherwise(text)
    return F.from_json(text, schema, {"mode": mode})


def to_json_message(row: Column, keep_nulls: bool = True) -> Column:
    """A struct as JSON bytes. Null fields are written as null unless `keep_nulls` is off."""
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return F.to_json(row, options).cast("binary")
