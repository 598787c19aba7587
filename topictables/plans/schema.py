"""Schemas: declared by type names, derived from Avro JSON or from JSON Schema text."""

from __future__ import annotations

import ast
import json
from collections.abc import Mapping

from pyspark.sql import types as T

# The type names a table schema is declared with.
TYPE_NAMES = {
    "VOID": T.NullType(),
    "BOOLEAN": T.BooleanType(),
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "LONG": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "BIG_DEC": T.DecimalType(38, 18),
    "BIG_INT": T.DecimalType(38, 0),
    "SQL_DATE": T.DateType(),
    "SQL_TIME": T.StringType(),
    "SQL_TIMESTAMP": T.TimestampNTZType(),
}


def table_schema(columns: Mapping[str, object] | T.StructType | str) -> T.StructType:
    """A table schema from ordered (name, type) pairs, a DDL string or a StructType.

    A type is one of `TYPE_NAMES`, a DDL type string or a Spark type.
    """
    if isinstance(columns, T.StructType):
        return columns
    if isinstance(columns, str):
        return T.StructType.fromDDL(columns)
    schema = T.StructType()
    for name, kind in columns.items():
        metadata = {"kind": "time"} if kind == "SQL_TIME" else None
        if isinstance(kind, str):
            kind = TYPE_NAMES.get(kind) or T.StructType.fromDDL(f"c {kind}")[0].dataType
        schema.add(T.StructField(name, kind, True, metadata))
    return schema


# Avro primitive types and the logical types that change the Spark type.
AVRO_PRIMITIVES = {
    "null": T.NullType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}
AVRO_LOGICAL_TYPES = {
    ("int", "date"): T.DateType(),
    ("long", "timestamp-millis"): T.TimestampType(),
    ("long", "timestamp-micros"): T.TimestampType(),
    ("long", "local-timestamp-millis"): T.TimestampNTZType(),
    ("long", "local-timestamp-micros"): T.TimestampNTZType(),
}


def load_avro(schema: str | dict | list) -> dict | list | str:
    """Avro schema JSON with every reference to a named type replaced by its definition.

    Recursive records have no Spark type and are refused.
    """
    if isinstance(schema, str):
        schema = json.loads(schema) if schema.lstrip()[:1] in ("{", "[", '"') else schema
    named: dict[str, dict] = {}

    def full_name(name: str, namespace: str | None) -> str:
        return f"{namespace}.{name}" if namespace and "." not in name else name

    def resolve(node, namespace, enclosing):
        if isinstance(node, str):
            if node in AVRO_PRIMITIVES:
                return {"type": node}
            name = full_name(node, namespace)
            name = name if name in named or name in enclosing else node
            if name in enclosing:
                raise ValueError(f"record {name} contains itself")
            if name not in named:
                raise ValueError(f"unknown Avro type {node!r}")
            return named[name]
        if isinstance(node, list):
            return [resolve(branch, namespace, enclosing) for branch in node]
        kind = node["type"]
        if isinstance(kind, (dict, list)):
            return resolve(kind, namespace, enclosing)
        if kind in ("record", "enum", "fixed"):
            namespace = node.get("namespace", namespace)
            name = full_name(node["name"], namespace)
            if "." in node["name"]:
                namespace = node["name"].rpartition(".")[0]
            if kind == "record":
                fields = [
                    {
                        "name": f["name"],
                        "type": resolve(f["type"], namespace, enclosing | {name}),
                    }
                    for f in node["fields"]
                ]
                node = {"type": "record", "name": name, "fields": fields}
            else:
                node = {k: v for k, v in node.items() if k not in ("namespace", "aliases")}
                node["name"] = name
            named[name] = node
            return node
        if kind == "array":
            return {"type": "array", "items": resolve(node["items"], namespace, enclosing)}
        if kind == "map":
            return {"type": "map", "values": resolve(node["values"], namespace, enclosing)}
        if kind in AVRO_PRIMITIVES:
            return node
        return resolve(kind, namespace, enclosing)

    return resolve(schema, None, frozenset())


def avro_record(schema: str | list, name: str) -> str:
    """One record, by full or last name, out of a schema text that defines several."""
    resolved = load_avro(schema)
    records = resolved if isinstance(resolved, list) else [resolved]
    for node in records:
        if name in (node.get("name"), node.get("name", "").rpartition(".")[2]):
            return avro_text(node)
    raise ValueError(f"the schema defines no record {name}")


def avro_text(node: dict) -> str:
    """Avro schema JSON of a resolved schema: every named type is defined where it first occurs."""
    defined: set[str] = set()

    def written(node):
        if isinstance(node, list):
            return [written(branch) for branch in node]
        if "name" in node:
            if node["name"] in defined:
                return node["name"]
            defined.add(node["name"])
        if node["type"] == "record":
            fields = [{"name": f["name"], "type": written(f["type"])} for f in node["fields"]]
            return dict(node, fields=fields)
        for part in ("items", "values"):
            if part in node:
                return dict(node, **{part: written(node[part])})
        return node

    return json.dumps(written(node))


def nullable_branch(union: list) -> tuple[int, int, dict]:
    """Index of null (-1 if absent), index and schema of the value branch of a union.

    Unions of several value types have no single column type and are refused.
    """
    values = [i for i, branch in enumerate(union) if branch["type"] != "null"]
    if len(values) != 1:
        raise ValueError("only unions of null and one other type can be columns")
    nulls = [i for i, branch in enumerate(union) if branch["type"] == "null"]
    return (nulls[0] if nulls else -1), values[0], union[values[0]]


def avro_type(node) -> T.DataType:
    """The Spark type of a resolved Avro schema node."""
    if isinstance(node, list):
        return avro_type(nullable_branch(node)[2])
    kind = node["type"]
    if kind == "record":
        return T.StructType(
            [
                T.StructField(f["name"], avro_type(f["type"]), is_nullable(f["type"]))
                for f in node["fields"]
            ]
        )
    if kind == "array":
        return T.ArrayType(avro_type(node["items"]), is_nullable(node["items"]))
    if kind == "map":
        return T.MapType(T.StringType(), avro_type(node["values"]), is_nullable(node["values"]))
    if kind == "enum":
        return T.StringType()
    if kind in ("bytes", "fixed") and node.get("logicalType") == "decimal":
        return T.DecimalType(node["precision"], node.get("scale", 0))
    if kind == "fixed":
        return T.BinaryType()
    return AVRO_LOGICAL_TYPES.get((kind, node.get("logicalType")), AVRO_PRIMITIVES[kind])


def is_nullable(node) -> bool:
    if isinstance(node, list):
        return nullable_branch(node)[0] >= 0
    return node["type"] == "null"


def avro_schema(schema: str | dict | list) -> T.StructType:
    """The table schema of an Avro record schema, fields in schema order."""
    resolved = load_avro(schema)
    if isinstance(resolved, list) or resolved["type"] != "record":
        raise ValueError("a table needs an Avro record schema")
    return avro_type(resolved)


def load_json(text: str) -> dict:
    """JSON text; single-quoted strings are accepted too."""
    try:
        return json.loads(text)
    except json.JSONDecodeError:
        words = {"true": True, "false": False, "null": None}

        class Words(ast.NodeTransformer):
            def visit_Name(self, node):
                return ast.Constant(words[node.id]) if node.id in words else node

        return ast.literal_eval(Words().visit(ast.parse(text.strip(), mode="eval")))


# JSON Schema types and string formats.
JSON_TYPES = {
    "string": T.StringType(),
    "number": T.DecimalType(38, 18),
    "integer": T.DecimalType(38, 0),
    "boolean": T.BooleanType(),
    "null": T.NullType(),
}
JSON_STRING_FORMATS = {
    "date": T.DateType(),
    "date-time": T.TimestampType(),
}


def pointer(root: dict, ref: str) -> dict:
    """The part of a JSON Schema that a reference names."""
    if not ref.startswith("#/"):
        raise ValueError(f"only references inside the schema are supported, not {ref!r}")
    node = root
    for part in ref[2:].split("/"):
        node = node[part.replace("~1", "/").replace("~0", "~")]
    return node


def json_schema(schema: str | dict) -> T.StructType:
    """The table schema of a JSON Schema text that describes an object."""
    root = load_json(schema) if isinstance(schema, str) else schema

    def spark_type(node: dict, seen: frozenset) -> T.DataType:
        if "$ref" in node:
            if node["$ref"] in seen:
                raise ValueError(f"{node['$ref']} contains itself")
            return spark_type(pointer(root, node["$ref"]), seen | {node["$ref"]})
        if "oneOf" in node:
            kinds = [k for k in node["oneOf"] if k.get("type") != "null"]
            if len(kinds) != 1:
                raise ValueError("only a choice of null and one other type can be a column")
            return spark_type(kinds[0], seen)
        kind = node.get("type")
        if isinstance(kind, list):
            kinds = [k for k in kind if k != "null"]
            if len(kinds) != 1:
                raise ValueError("only a choice of null and one other type can be a column")
            kind = kinds[0]
        if kind == "object":
            return T.StructType(
                [
                    T.StructField(name, spark_type(child, seen))
                    for name, child in node.get("properties", {}).items()
                ]
            )
        if kind == "array":
            if not isinstance(node.get("items"), dict):
                raise ValueError("an array needs one item schema")
            return T.ArrayType(spark_type(node["items"], seen))
        if kind == "string" and "base64" in str(node.get("contentEncoding", "")):
            return T.BinaryType()
        if kind == "string" and node.get("format") in JSON_STRING_FORMATS:
            return JSON_STRING_FORMATS[node["format"]]
        if kind not in JSON_TYPES:
            raise ValueError(f"unsupported JSON Schema type {kind!r}")
        return JSON_TYPES[kind]

    table = spark_type(root, frozenset())
    if not isinstance(table, T.StructType):
        raise ValueError("a table needs a JSON Schema of type object")
    return table
