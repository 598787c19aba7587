"""Fit a query's rows to the declared schema of a sink (K6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def check_sink_schema(rows: T.StructType, sink: T.StructType) -> None:
    """Columns are matched by position; their number and types must agree."""
    if len(rows) != len(sink):
        raise ValueError(f"the sink has {len(sink)} columns, the query {len(rows)}")
    for have, want in zip(rows.fields, sink.fields, strict=True):
        kinds = [k.dataType.simpleString() for k in (have, want)]
        if kinds[0] != kinds[1]:
            raise ValueError(f"sink column {want.name} is {kinds[1]}, the query gives {kinds[0]}")


def conform(df: DataFrame, sink: T.StructType) -> list[Column]:
    """The rows' columns under the sink's names; null in a required column raises."""
    return conformed([F.col(f"`{name}`") for name in df.columns], df.schema, sink)


def conformed(columns: list[Column], rows: T.StructType, sink: T.StructType) -> list[Column]:
    """The same for columns that are yet to be selected, of which `rows` is the schema."""
    check_sink_schema(rows, sink)
    found = []
    for column, have, want in zip(columns, rows.fields, sink.fields, strict=True):
        if have.nullable and not want.nullable:
            problem = F.raise_error(F.lit(f"null in the required column {want.name}"))
            column = F.coalesce(column, problem.cast(want.dataType))
        found.append(column.alias(want.name))
    return found
