"""Avro messages as column functions.

Spark's own `from_avro` and `to_avro` are used where the Avro module is on the class path
(`--packages org.apache.spark:spark-avro_2.13:<version>`); otherwise the same columns come from an
Arrow batch codec. The module is not present in the development container, so only the Arrow path
is covered by tests there.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.avro import functions as connector

from topictables.functions import avro_arrow
from topictables.plans.schema import avro_text, avro_type, load_avro

MODES = ("FAILFAST", "PERMISSIVE")

# The codec travels with the query, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(avro_arrow)

_loaded: dict[int, bool] = {}


def avro_module_loaded(spark: SparkSession | None = None) -> bool:
    """Whether Spark's Avro functions can be used in this session."""
    spark = spark or SparkSession.active()
    if id(spark) not in _loaded:
        try:
            probe = connector.from_avro(F.lit(b"\0"), '"int"')
            _loaded[id(spark)] = bool(spark.range(0).select(probe.alias("c")).schema)
        except AnalysisException:
            _loaded[id(spark)] = False
    return _loaded[id(spark)]


def record_node(schema: str | dict) -> dict:
    """The resolved record schema, checked for types that no column can have."""
    node = load_avro(schema)
    if isinstance(node, list):
        raise ValueError("an Avro message cannot be a union; name one of its records")
    if node["type"] != "record":
        raise ValueError("an Avro message needs a record schema")
    avro_type(node)
    _refuse_unsafe(node)
    return node


def _refuse_unsafe(node: dict | list) -> None:
    """Refuse arrays of items that take no bytes, whose number nothing limits, and fixed sizes too
    small for the precision of their decimals."""
    if isinstance(node, list):
        for branch in node:
            _refuse_unsafe(branch)
        return
    if node["type"] == "array" and avro_arrow.takes_no_bytes(node["items"]):
        raise ValueError("an array of items without bytes cannot be a column")
    if node["type"] == "fixed" and node.get("logicalType") == "decimal":
        if 10 ** node["precision"] > 1 << (8 * node["size"] - 1):
            raise ValueError(f"{node['size']} bytes do not hold {node['precision']} decimal digits")
    parts = [f["type"] for f in node.get("fields", ())]
    parts += [node[name] for name in ("items", "values") if name in node]
    for part in parts:
        _refuse_unsafe(part)


def _schema_text(schema: str | dict) -> str:
    return schema if isinstance(schema, str) else json.dumps(schema)


def _narrowed(node: dict, columns: Iterable[str] | None) -> dict:
    """The record with the fields outside `columns` marked to be skipped."""
    if columns is None:
        return node
    wanted = set(columns)
    unknown = wanted - {f["name"] for f in node["fields"]}
    if unknown:
        raise ValueError(f"the record has no field {', '.join(sorted(unknown))}")
    fields = [dict(f, skip=f["name"] not in wanted) for f in node["fields"]]
    return dict(node, fields=fields)


def from_avro_message(
    value: Column,
    schema: str | dict,
    columns: Iterable[str] | None = None,
    mode: str = "FAILFAST",
) -> Column:
    """One Avro record per message (no container header, no registry prefix) as a struct.

    With `columns`, only these top-level fields are built; the others are passed over. FAILFAST
    raises on a broken message, PERMISSIVE gives a null struct.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    node = _narrowed(record_node(schema), columns)
    kept = [f for f in node["fields"] if not f.get("skip")]
    if avro_module_loaded():
        options = {"mode": mode}
        if columns is not None:
            options["avroSchema"] = avro_text(dict(node, fields=kept))
        return connector.from_avro(value, _schema_text(schema), options)

    permissive = mode == "PERMISSIVE"

    @F.arrow_udf(_nullable(avro_type(dict(node, fields=kept))))
    def decode(messages: pa.Array) -> pa.Array:
        return avro_arrow.decode(node, messages, permissive)

    return decode(value)


def to_avro_message(row: Column, schema: str | dict) -> Column:
    """A struct as one Avro record of the given schema; fields are matched by position.

    A null struct gives no message.
    """
    node = record_node(schema)
    if avro_module_loaded():
        # The module matches fields by name; the cast names them by position.
        row = row.cast(_nullable(avro_type(node)))
        return connector.to_avro(row, _schema_text(schema))

    @F.arrow_udf(T.BinaryType())
    def encode(rows: pa.Array) -> pa.Array:
        if not rows.null_count:
            return avro_arrow.encode(node, rows)
        present = rows.is_valid().to_numpy(zero_copy_only=False)
        messages = avro_arrow.encode(node, rows.drop_null())
        return messages.take(pa.array(np.cumsum(present) - 1, mask=~present))

    return encode(row)


def _nullable(kind: T.DataType) -> T.DataType:
    """The type with every field, element and map value nullable."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _nullable(kind.valueType))
    return kind
