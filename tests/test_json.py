"""JSON tables: one parse a message, variants, constraints, rows and reasons."""

import json
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import messages as m
from topictables import (
    delimited_results,
    good_rows,
    json_results,
    json_schema_violation,
    json_table,
    rejected,
    variant_paths,
    variant_schema,
)

COLUMNS = {
    "id": "LONG",
    "name": "STRING",
    "tags": "map<string,string>",
    "places": "array<struct<city:string,zip:int>>",
    "odd 'name": "DOUBLE",
}
RECORDS = [
    {"id": 1, "name": "a", "tags": {"x": "y"}, "places": [{"city": "c", "zip": 3}, {"city": None}], "odd 'name": 0.5},
    {"id": 2, "extra": [1, 2], "places": []},
    {"id": None, "name": "ü\n\"q\"", "tags": {}},
    {},
]


def topic(spark, values):
    rows = [(i, v if v is None or isinstance(v, bytes) else v.encode()) for i, v in enumerate(values)]
    return spark.createDataFrame([(None, v, "t", 0, i, None, 0) for i, v in rows], m.ENVELOPE)


@pytest.fixture(scope="module")
def messages(spark):
    return topic(spark, [json.dumps(r) for r in RECORDS])


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def parses(df):
    return len(re.findall(r"jsontostructs|from_json\(|parse_json|parseJson", plan(df)))


@pytest.mark.parametrize("as_variant", [False, True])
def test_one_parse_a_message(spark, messages, as_variant):
    table = json_table(messages, COLUMNS, as_variant=as_variant, keep=["offset"])
    queries = [
        table.filter("id > 0 AND name = 'a' AND tags['x'] = 'y'").select("id", "name", "places"),
        table.filter("places[0].zip = 3").filter("id = 1"),
        table.select("id"),
    ]
    for query in queries:
        assert parses(query) == 1
    assert [r.id for r in queries[0].collect()] == [1]


def test_conditions_on_the_envelope_reach_the_scan(spark, messages, tmp_path):
    messages.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    for options in ({}, {"as_variant": True}):
        table = json_table(stored, COLUMNS, keep=["offset"], **options).filter("offset > 1 AND id = 1")
        text = table._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThan(offset,1)" in text


def test_columns_narrow_the_parser(spark, messages):
    table = json_table(messages, COLUMNS, columns=["name", "id"])
    assert table.columns == ["name", "id"]
    fields = re.search(r"(?:jsontostructs|from_json)\(([^\n]*)", plan(table))[1]
    assert "name" in fields and "places" not in fields
    renamed = json_table(messages, {"key": "LONG", "who": "STRING"}, mapping={"key": "id", "who": "name"}, columns=["who"])
    assert [r.who for r in renamed.collect()] == ["a", None, "ü\n\"q\"", None]
    text = '{"type": "object", "properties": {"id": {"type": "integer"}, "name": {"type": "string"}}}'
    assert json_table(messages, json_schema_text=text, mapping={"who": "name"}, columns=["who"]).columns == ["who"]
    with pytest.raises(ValueError, match="no column other"):
        json_table(messages, COLUMNS, columns=["other"])


def test_variant_columns_are_those_of_from_json(spark, messages):
    one = json_table(messages, COLUMNS, keep=["offset"]).collect()
    two = json_table(messages, COLUMNS, as_variant=True, keep=["offset"]).collect()
    assert one == two
    bare = json_table(messages, as_variant=True)
    assert bare.columns == ["message"] and bare.schema["message"].dataType == T.VariantType()


def test_variant_types(spark):
    record = {"b": "aGk=", "d": "2024-02-03", "t": "2024-02-03T04:05:06Z", "n": 12.345678, "i": 7, "o": True, "f": 1e300}
    schema = {"b": "binary", "d": "SQL_DATE", "t": "timestamp", "n": "BIG_DEC", "i": "BIG_INT", "o": "BOOLEAN", "f": "DOUBLE", "v": "VOID"}
    table = topic(spark, [json.dumps(record)])
    assert json_table(table, schema, as_variant=True).collect() == json_table(table, schema).collect()
    with pytest.raises(ValueError, match="bytes within"):
        json_table(table, {"b": "array<binary>"}, as_variant=True)


def test_broken_variants(spark):
    broken = topic(spark, ['{"id": 1}', '{"id": ', "[1]", "null", " ", None, '{"id": "x"}', '{"id": 1, "id": 2}'])
    rows = json_table(broken, {"id": "LONG"}, as_variant=True, mode="PERMISSIVE", keep=["offset"]).collect()
    assert [r.id for r in rows] == [1] + [None] * 7
    for offset in range(1, 8):
        with pytest.raises(Exception, match="(?i)object|malformed|null message|cast|duplicate"):
            json_table(broken.filter(F.col("offset") == offset), {"id": "LONG"}, as_variant=True).collect()


def test_paths_and_found_schema(spark, messages):
    table = json_table(messages, as_variant=True, keep=["offset"])
    paths = {"zip": ("$.places[0].zip", "INT"), "x": ("$.tags.x", "STRING"), "odd": ("$[\"odd 'name\"]", "DOUBLE")}
    rows = variant_paths(table, paths).select("offset", *paths).collect()
    assert [tuple(r)[1:] for r in rows] == [(3, "y", 0.5), (None, None, None), (None, None, None), (None, None, None)]
    found = variant_schema(table)
    assert found["id"].dataType == T.LongType() and found["places"].dataType.elementType["zip"].dataType == T.LongType()
    assert json_table(messages, found, as_variant=True).count() == 4
    strange = topic(spark, ['{"OBJECT<": null, "a": 1, "b`c": "OBJECT<"}', '{"a": "x"}'])
    found = variant_schema(json_table(strange, as_variant=True))
    assert set(found.names) == {"OBJECT<", "a", "b`c"} and found["a"].dataType == T.VariantType()
    assert variant_schema(json_table(strange.limit(0), as_variant=True)) == T.StructType()


SCHEMA = {
    "type": "object",
    "required": ["id", "place"],
    "definitions": {"small": {"type": "integer", "minimum": 0, "maximum": 9}},
    "properties": {
        "id": {"$ref": "#/definitions/small"},
        "kind": {"type": "string", "enum": ["a", "b", None]},
        "code": {"type": "string", "pattern": "^[a-z]+$", "minLength": 2, "maxLength": 4},
        "price": {"type": "number", "exclusiveMinimum": 0, "multipleOf": 0.5},
        "old": {"type": "number", "maximum": 5, "exclusiveMaximum": True},
        "one": {"type": "string", "const": "x"},
        "place": {"type": "object", "required": ["city"], "properties": {"city": {"type": "string"}, "zip": {"type": "integer", "not": {"minimum": 100}}}},
        "marks": {"type": "array", "maxItems": 3, "uniqueItems": True, "items": {"type": "object", "required": ["n"], "properties": {"n": {"$ref": "#/definitions/small"}}}},
        "either": {"type": "integer", "anyOf": [{"maximum": 1}, {"minimum": 5}]},
        "both": {"type": "integer", "allOf": [{"minimum": 1}, {"maximum": 5}]},
        "maybe": {"oneOf": [{"type": "null"}, {"type": "integer", "minimum": 3}]},
    },
    "dependentRequired": {"code": ["kind"]},
}
PLACE = {"city": "c"}
CASES = [
    ({"id": 1, "place": PLACE}, None),
    ({"place": PLACE}, "id: required"),
    ({"id": 1}, "place: required"),
    ({"id": 10, "place": PLACE}, "id: maximum"),
    ({"id": -1, "place": PLACE}, "id: minimum"),
    ({"id": 1, "place": {}}, "place.city: required"),
    ({"id": 1, "place": {"city": "c", "zip": 100}}, "place.zip: not"),
    ({"id": 1, "place": {"city": "c", "zip": 99}}, None),
    ({"id": 1, "place": PLACE, "kind": "c"}, "kind: enum"),
    ({"id": 1, "place": PLACE, "kind": None}, None),
    ({"id": 1, "place": PLACE, "kind": "a", "code": "abcde"}, "code: maxLength"),
    ({"id": 1, "place": PLACE, "kind": "a", "code": "A1"}, "code: pattern"),
    ({"id": 1, "place": PLACE, "code": "ab"}, "message: dependentRequired"),
    ({"id": 1, "place": PLACE, "price": 0}, "price: exclusiveMinimum"),
    ({"id": 1, "place": PLACE, "price": 1.25}, "price: multipleOf"),
    ({"id": 1, "place": PLACE, "price": 1.5}, None),
    ({"id": 1, "place": PLACE, "old": 5}, "old: exclusiveMaximum"),
    ({"id": 1, "place": PLACE, "one": "y"}, "one: const"),
    ({"id": 1, "place": PLACE, "marks": [{"n": 1}, {"n": 10}]}, "marks[].n: maximum"),
    ({"id": 1, "place": PLACE, "marks": [{"n": 1}, {}]}, "marks[].n: required"),
    ({"id": 1, "place": PLACE, "marks": [{"n": 1}, {"n": 1}]}, "marks: uniqueItems"),
    ({"id": 1, "place": PLACE, "marks": [{"n": i} for i in range(4)]}, "marks: maxItems"),
    ({"id": 1, "place": PLACE, "either": 3}, "either: anyOf"),
    ({"id": 1, "place": PLACE, "either": 7}, None),
    ({"id": 1, "place": PLACE, "both": 6}, "both: maximum"),
    ({"id": 1, "place": PLACE, "maybe": 2}, "maybe: minimum"),
]


def test_constraints(spark):
    table = topic(spark, [json.dumps(r) for r, _ in CASES])
    results = json_results(table, json_schema_text=SCHEMA, keep=["offset"])
    assert parses(results) == 1 and "Python" not in plan(results)
    assert {r.offset: r.reason for r in results.collect()} == {i: reason for i, (_, reason) in enumerate(CASES)}
    for options in ({}, {"as_variant": True}):
        rows = json_table(table, json_schema_text=SCHEMA, check=True, mode="PERMISSIVE", keep=["offset"], columns=["id"], **options)
        assert {r.offset for r in rows.collect() if r.id is not None} == {i for i, (_, reason) in enumerate(CASES) if reason is None}
        with pytest.raises(Exception, match="id: required"):
            json_table(table.filter("offset = 1"), json_schema_text=SCHEMA, check=True, **options).collect()
        with pytest.raises(ValueError, match="only a JSON Schema"):
            json_table(table, {"id": "LONG"}, check=True, **options)


def test_constraints_that_cannot_be_checked():
    for node in ({"if": {}}, {"additionalProperties": False}, {"properties": {"a": {"type": "object", "minProperties": 1}}}):
        with pytest.raises(ValueError, match="cannot check"):
            json_schema_violation({"type": "object", **node}, F.col("r"))
    with pytest.raises(ValueError, match="has no type"):
        json_schema_violation({"type": "object", "required": ["a"]}, F.col("r"))


def test_rows_and_reasons(spark):
    values = ['{"id": 1, "n": 2.5}', None, "", "null", "[]", '{"id": ', '{"id": "x"}', '{"id": 1.5, "n": "y"}', '{"n": null}']
    results = json_results(topic(spark, values), {"key": "LONG", "n": "DOUBLE"}, mapping={"key": "id"}, keep=["offset"])
    assert results.columns == ["offset", "row", "reason"]
    assert [r.reason for r in results.orderBy("offset").collect()] == [
        None, "no bytes", *["no JSON object"] * 4, "field id: not a bigint", "field n: not a double", None,
    ]
    assert good_rows(results, ["offset"]).orderBy("offset").collect() == [(0, 1, 2.5), (8, None, None)]
    assert rejected(results).count() == 7
    lines = topic(spark, ["1\ta", "x\tb", None, "", "2\tc\tmore", "\t", "3\td:e,::"])
    results = delimited_results(lines, {"id": "INT", "tags": "map<string,string>"}, keep=["offset"])
    assert [r.reason for r in results.orderBy("offset").collect()] == [
        None, "column id: not a int: x", "no bytes", "column id: not a int: ", None, None, "column tags: not a map<string,string>: d:e,::",
    ]
    assert [r.id for r in good_rows(results).collect()] == [1, 2, None]
