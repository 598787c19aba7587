"""What is handed to Spark's Kafka and Avro modules, which are not installed here."""

import json

import pytest
from pyspark.sql import functions as F

from checks.messages import CUSTOMER
from topictables import from_avro_message, kafka_topic, start_at, to_avro_message
from topictables.functions import avro


class Reader:
    def __init__(self):
        self.given = {}

    def format(self, name):
        self.given["format"] = name
        return self

    def option(self, key, value):
        self.given[key] = value
        return self

    def options(self, **options):
        self.given.update(options)
        return self

    def load(self):
        return self.given


class Session:
    read, readStream = property(lambda self: Reader()), property(lambda self: Reader())


PROPERTIES = {"bootstrap.servers": "h:9092", "zookeeper.connect": "h:2181", "group.id": "g"}


def test_kafka_reader():
    given = kafka_topic(
        Session(), "t", PROPERTIES, start_at("specific-offsets", {1: 5}), partitions=2,
        options={"maxOffsetsPerTrigger": "1000"},
    )
    assert given == {
        "format": "kafka", "subscribe": "t", "startingOffsets": '{"t": {"0": -2, "1": 5}}',
        "kafka.bootstrap.servers": "h:9092", "groupIdPrefix": "g", "maxOffsetsPerTrigger": "1000",
    }


@pytest.fixture
def module(monkeypatch):
    calls = []
    monkeypatch.setattr(avro, "avro_module_loaded", lambda: True)
    for name in ("from_avro", "to_avro"):
        monkeypatch.setattr(
            avro.connector, name, lambda c, *rest, name=name: calls.append((name, *rest)) or c
        )
    return calls


def test_avro_module_reads(spark, module):
    from_avro_message(F.col("value"), CUSTOMER, mode="PERMISSIVE")
    from_avro_message(F.col("value"), CUSTOMER, ["name", "key"])
    (_, writer, options), (_, same_writer, narrowed) = module
    assert json.loads(writer) == json.loads(same_writer) == CUSTOMER
    assert options == {"mode": "PERMISSIVE"} and narrowed["mode"] == "FAILFAST"
    reader = json.loads(narrowed["avroSchema"])
    assert [f["name"] for f in reader["fields"]] == ["key", "name"]


def test_avro_module_writes(spark, module):
    to_avro_message(F.struct(F.lit(1).alias("a")), {"type": "record", "name": "R", "fields": [
        {"name": "a", "type": "int"}]})
    assert [(name, json.loads(schema)["name"]) for name, schema in module] == [("to_avro", "R")]


def test_module_is_looked_for_once(spark):
    assert avro.avro_module_loaded() is False
    assert avro._loaded[id(spark)] is False
