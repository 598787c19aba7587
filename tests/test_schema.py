"""Schemas from type names, Avro JSON and JSON Schema text, and mapping onto table columns."""

import json

import pytest
from pyspark.sql import types as T

from topictables import avro_record, avro_schema, json_schema, table_schema
from topictables.operators.mapping import source_fields


def test_type_names(spark):
    schema = table_schema(
        {"a": "INT", "b": "BIG_DEC", "c": "SQL_TIMESTAMP", "d": "SQL_TIME", "e": "map<string,int>", "f": T.DateType()}
    )
    assert schema.simpleString() == (
        "struct<a:int,b:decimal(38,18),c:timestamp_ntz,d:string,e:map<string,int>,f:date>"
    )
    assert schema["d"].metadata == {"kind": "time"}
    assert table_schema("a int, b string").names == ["a", "b"]


def record(*fields, **extra):
    return {"type": "record", "name": "R", "fields": [{"name": n, "type": t} for n, t in fields], **extra}


def test_avro_types():
    schema = avro_schema(
        record(
            ("s", "string"), ("u", ["null", "long"]), ("v", ["double", "null"]), ("raw", "bytes"),
            ("e", {"type": "enum", "name": "E", "symbols": ["A"]}),
            ("x", {"type": "fixed", "name": "X", "size": 4}),
            ("m", {"type": "map", "values": {"type": "array", "items": ["null", "int"]}}),
            ("n", ["null", record(("b", "boolean"), name="N")]),
            ("again", "N"), ("flags", {"type": "array", "items": {"type": "float"}}),
        )
    )
    assert schema.simpleString() == (
        "struct<s:string,u:bigint,v:double,raw:binary,e:string,x:binary,m:map<string,array<int>>,"
        "n:struct<b:boolean>,again:struct<b:boolean>,flags:array<float>>"
    )
    nullable = {f.name for f in schema if f.nullable}
    assert nullable == {"u", "v", "n"}


def test_avro_names_resolve_within_namespaces():
    inner = record(("i", "int"), name="Inner")
    schema = avro_schema(
        record(("a", inner), ("b", "Inner"), ("c", "space.Inner"), namespace="space")
    )
    assert [f.dataType.simpleString() for f in schema] == ["struct<i:int>"] * 3


@pytest.mark.parametrize("bad", ['"int"', record(("a", "Unknown")), record(("a", ["null"]))])
def test_avro_schemas_without_a_table(bad):
    with pytest.raises(ValueError):
        avro_schema(bad)


def test_json_schema_text():
    text = """{ 'title': 'Person', 'type': 'object',
        'properties': { 'id': {'type': 'string'}, 'name': {'type': 'string'},
            'age': {'description': 'years', 'type': 'number', 'minimum': 0, 'exclusive': true} },
        'required': ['id', 'name'] }"""
    assert json_schema(text).simpleString() == "struct<id:string,name:string,age:decimal(38,18)>"


def test_json_schema_nested():
    schema = {
        "type": "object",
        "definitions": {"point": {"type": "object", "properties": {"x": {"type": "number"}}}},
        "properties": {
            "at": {"$ref": "#/definitions/point"},
            "tags": {"type": "array", "items": {"type": ["string", "null"]}},
            "n": {"oneOf": [{"type": "integer"}, {"type": "null"}]},
            "ok": {"type": "boolean"},
            "day": {"type": "string", "format": "date"},
            "when": {"type": "string", "format": "date-time"},
        },
    }
    assert json_schema(json.dumps(schema)).simpleString() == (
        "struct<at:struct<x:decimal(38,18)>,tags:array<string>,n:decimal(38,0),ok:boolean,"
        "day:date,when:timestamp>"
    )


@pytest.mark.parametrize(
    "bad",
    [
        {"type": "string"},
        {"type": "object", "properties": {"a": {"type": ["string", "number"]}}},
        {"type": "object", "properties": {"a": {"$ref": "#"}}},
        {"type": "object", "properties": {"a": {"type": "array"}}},
        {"type": "object", "properties": {"a": {}}},
    ],
)
def test_json_schemas_without_a_table(bad):
    with pytest.raises(ValueError):
        json_schema(bad)


def test_mapping():
    fields = table_schema({"x": "INT", "y": "STRING", "z": "LONG"})
    declared = table_schema({"a": "LONG", "y": "STRING"})
    assert source_fields(declared, fields, {"a": "z"}) == ["z", "y"]
    assert source_fields(None, fields, {"a": "z"}) == ["x", "y", "z"]
    for mapping, problem in [
        (None, "no field a"),
        ({"a": "x"}, "column a is bigint, field x is int"),
        ({"a": "q"}, "no field q"),
        ({"a": "z", "b": "x"}, "no column of the table: b"),
    ]:
        with pytest.raises(ValueError, match=problem):
            source_fields(declared, fields, mapping)


def test_one_record_of_several():
    inner = record(("i", "int"), name="Inner")
    several = [record(("a", inner), namespace="space"), record(("b", "space.Inner"), name="Q")]
    assert avro_schema(avro_record(several, "Q")).simpleString() == "struct<b:struct<i:int>>"
    text = avro_record(json.dumps(several), "space.R")
    assert json.loads(text)["name"] == "space.R"
    assert avro_schema(text).names == ["a"]
    with pytest.raises(ValueError, match="no record Z"):
        avro_record(several, "Z")
