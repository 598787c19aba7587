"""Whole jobs as streams: topic in, SQL, topics out."""

import json

import pytest
from pyspark.sql import functions as F

from topictables import (
    ENVELOPE,
    Catalog,
    avro_table,
    avro_topic,
    console,
    delimited_table,
    files,
    json_table,
    json_topic,
    register_table,
    start,
    start_all,
    start_at,
    table_topic,
    to_avro_message,
)

WEIGHED = json.dumps(
    {"type": "record", "name": "Weighed", "fields": [
        {"name": "parcel", "type": "string"}, {"name": "grams", "type": "long"},
    ]}
)
PARCEL = json.dumps(
    {"type": "record", "name": "Parcel", "fields": [
        {"name": "legs", "type": {"type": "array", "items":
            {"type": "record", "name": "Leg", "fields": [{"name": "town", "type": "string"}]}}},
        {"name": "parcel", "type": "string"},
        {"name": "grams", "type": ["null", "long"]},
        {"name": "marks", "type": {"type": "map", "values": "string"}},
        {"name": "rooms", "type": {"type": "map", "values":
            {"type": "record", "name": "Room", "fields": [{"name": "floor", "type": "int"}]}}},
        {"name": "codes", "type": {"type": "array", "items": "string"}},
    ]}
)


@pytest.fixture
def topic(spark, tmp_path):
    """Write messages as a topic on disk and open it as a stream."""

    def opened(values, name="test"):
        path = str(tmp_path / name)
        columns = {
            "key": F.lit(None), "topic": F.lit(name), "partition": F.lit(0), "offset": F.col("n"),
            "timestamp": F.lit("2024-01-01 00:00:00"), "timestampType": F.lit(0), "value": F.col("value"),
        }
        columns = [columns[f.name].cast(f.dataType).alias(f.name) for f in ENVELOPE]
        values.withColumn("n", F.monotonically_increasing_id()).select(columns).write.parquet(path)
        stream = spark.readStream.schema(ENVELOPE).parquet(path)
        return table_topic(stream, name, start_at("earliest-offset"))

    return opened


def lines(spark, *values):
    return spark.createDataFrame([(v.encode(),) for v in values], "value binary")


def test_nested_avro_filter_to_avro_and_print(spark, topic, tmp_path):
    rows = spark.sql(
        """SELECT named_struct('legs', array(named_struct('town', town), named_struct('town', 'Pau')),
             'parcel', parcel, 'grams', weight, 'marks', map('care', care),
             'rooms', map('depot', named_struct('floor', floor)), 'codes', array('x', code)) AS r
           FROM VALUES ('p1', 900L, 'glass', 2, 'b7', 'Ulm'), ('p2', 50L, 'none', 2, 'b7', 'Ulm'),
             ('p3', 70L, 'glass', 3, 'b7', 'Ulm'), ('p4', 80L, 'glass', 2, 'c1', 'Ulm'),
             ('p5', 90L, 'glass', 2, 'b7', 'Bonn') AS t(parcel, weight, care, floor, code, town)"""
    )
    messages = topic(rows.select(to_avro_message(F.col("r"), PARCEL).alias("value")))
    schema = {
        "name": "STRING", "weight": "LONG", "legs": "array<struct<town:string>>", "marks": "map<string,string>",
        "rooms": "map<string,struct<floor:int>>", "codes": "array<string>",
    }
    mapping = {"name": "parcel", "weight": "grams"}
    register_table(avro_table(messages, PARCEL, schema, mapping), "parcels")
    result = spark.sql(
        """SELECT name, weight FROM parcels WHERE marks['care'] = 'glass' AND rooms['depot'].floor = 2
             AND try_element_at(codes, 2) = 'b7' AND try_element_at(legs, 1).town = 'Ulm'"""
    )
    path = str(tmp_path / "out")
    outputs = [(None, avro_topic("heavy", WEIGHED, path=path)), (None, console())]
    start_all(result, outputs, str(tmp_path / "c"), available_now=True).awaitTermination()
    sent = avro_table(spark.read.parquet(path), WEIGHED).collect()
    assert [tuple(r) for r in sent] == [("p1", 900)]


def test_catalog_with_json_schema_and_three_outputs(spark, topic, tmp_path):
    messages = topic(
        lines(
            spark,
            '{"sensor":"s1","place":"roof","level":-3.25}',
            '{"sensor":"s2","place":"hall","level":18}',
            '{"sensor":"s3","place":"oven","level":210.5}',
            '{"sensor":"s4","place":"yard"}',
        )
    )
    schema_text = "{'properties': {'level': {'type': 'number'}, 'place': {'type': 'string'}, 'sensor': {'type': 'string', 'minLength': 2}}, 'type': 'object'}"
    catalog = Catalog(spark, "topics")
    columns = {"sensor": "STRING", "place": "STRING", "level": "BIG_DEC"}
    readings = json_table(messages, columns, json_schema_text=schema_text)
    catalog.create_table("readings", readings)
    one = {"place": "STRING"}
    outputs = [
        (lambda t: t.filter("level > 18").select("place"), json_topic("hot", schema=one, path=str(tmp_path / "hot"))),
        (lambda t: t.filter("level <= 18").select("place"), json_topic("cool", schema=one, path=str(tmp_path / "cool"))),
        (lambda t: t.select("place"), json_topic("every", schema=one, path=str(tmp_path / "every"))),
    ]
    query = start_all(catalog.table("readings"), outputs, str(tmp_path / "c"), available_now=True)
    query.awaitTermination()
    got = [
        sorted(r.place for r in json_table(spark.read.parquet(str(tmp_path / o)), one).collect())
        for o in ("hot", "cool", "every")
    ]
    assert got == [["oven"], ["hall", "roof"], ["hall", "oven", "roof", "yard"]]


def test_delimited_to_avro(spark, topic, tmp_path):
    record = json.dumps(
        {"type": "record", "name": "Stock", "fields": [
            {"name": "shelf", "type": ["null", "string"]}, {"name": "article", "type": "long"},
            {"name": "labels", "type": {"type": "map", "values": "string"}},
        ]}
    )
    messages = topic(lines(spark, "A\t4\tkind:nail,metal:zinc", "B\t5\tkind:screw", "C\t6", "\t\t"))
    schema = {"shelf": "STRING", "article": "LONG", "labels": "map<string,string>"}
    register_table(delimited_table(messages, schema), "stock")
    result = spark.sql("SELECT * FROM stock WHERE labels['kind'] = 'nail'")
    path = str(tmp_path / "out")
    start(
        result, avro_topic("nails", record, path=path), str(tmp_path / "c"), available_now=True
    ).awaitTermination()
    (row,) = avro_table(spark.read.parquet(path), record).collect()
    assert tuple(row) == ("A", 4, {"kind": "nail", "metal": "zinc"})


def test_json_to_json(spark, topic, tmp_path):
    messages = topic(
        lines(
            spark,
            '{"title":"Dune","year":1965,"tags":{"shelf":"sf"}}',
            '{"title":"Emma","year":1815,"tags":{"shelf":"novel"}}',
            '{"title":"Untagged","year":2001}',
        )
    )
    schema = {"title": "STRING", "year": "INT", "tags": "map<string,string>"}
    register_table(json_table(messages, schema), "books")
    result = spark.sql("SELECT title, year FROM books WHERE tags['shelf'] = 'novel'")
    path = str(tmp_path / "out")
    sink = json_topic("novels", path=path)
    start(result, sink, str(tmp_path / "c"), available_now=True).awaitTermination()
    assert [bytes(r.value) for r in spark.read.parquet(path).collect()] == [b'{"title":"Emma","year":1815}']


def test_restart_goes_on_where_the_stream_stopped(spark, tmp_path):
    """A second run with the same checkpoint sends only messages that came since."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "c"))
    for n, expected in ((1, 1), (2, 2), (3, 3)):
        lines(spark, f"{n}\tx").write.mode("append").parquet(source)
        stream = spark.readStream.schema("value binary").parquet(source)
        rows = delimited_table(stream, {"id": "INT", "name": "STRING"})
        start(rows, files(out), checkpoint, available_now=True).awaitTermination()
        assert spark.read.parquet(out).count() == expected
