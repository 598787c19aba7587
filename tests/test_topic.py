"""Envelopes, start positions and their checks."""

import json

import pytest
from pyspark.sql import functions as F

from topictables import (
    EARLIEST,
    ENVELOPE,
    GROUP,
    LATEST,
    SPECIFIC,
    check_topic,
    commit_offsets,
    committed_offsets,
    delimited_table,
    end_offsets,
    json_table,
    reset_offsets,
    start_at,
    table_topic,
)
from topictables.sources.topic import kafka_options, kafka_topic, starting_offsets


@pytest.fixture(scope="module")
def messages(spark):
    """Partitions 0-3 with offsets 0-9, 0-9, 0-9 and 100-109; two messages of another topic."""
    rows = spark.range(40).select(
        (F.col("id") % 4).cast("int").alias("partition"), F.expr("id div 4").alias("n")
    )
    offset = F.when(F.col("partition") == 3, F.col("n") + 100).otherwise(F.col("n"))
    columns = {
        "key": F.lit(None),
        "value": F.concat_ws("\t", offset.cast("string"), F.lit("x")),
        "topic": F.lit("t"),
        "partition": F.col("partition"),
        "offset": offset,
        "timestamp": F.timestamp_seconds(offset),
        "timestampType": F.lit(0),
    }
    mine = rows.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in ENVELOPE])
    return mine.union(mine.filter("offset < 1 and partition < 2").withColumn("topic", F.lit("u")))


def read(messages, start):
    counts = table_topic(messages, "t", start).groupBy("partition").agg(
        F.min("offset").alias("first"), F.count("*").alias("n")
    )
    return {r.partition: (r.first, r.n) for r in counts.collect()}


ALL = {0: (0, 10), 1: (0, 10), 2: (0, 10), 3: (100, 10)}


def test_start_positions(messages):
    assert read(messages, start_at(EARLIEST)) == ALL
    assert read(messages, None) == ALL
    assert read(messages, start_at(LATEST)) == {}
    assert read(messages, start_at(SPECIFIC, {0: 7, 3: 105})) == ALL | {0: (7, 3), 3: (105, 5)}
    assert read(messages, start_at(SPECIFIC, {0: 7, 3: 105}, LATEST)) == {0: (7, 3), 3: (105, 5)}
    assert read(messages, start_at(SPECIFIC, {1: 10})) == {k: v for k, v in ALL.items() if k != 1}
    assert read(messages, start_at(GROUP, {2: 9}, LATEST)) == {2: (9, 1)}
    assert read(messages, start_at(GROUP, {})) == ALL
    assert read(messages, start_at(GROUP, {}, LATEST)) == {}
    assert read(messages, start_at(SPECIFIC, {500: 3})) == ALL
    far = {0: 7, 2_000_000_000: 3}
    assert read(messages, start_at(SPECIFIC, far)) == ALL | {0: (7, 3)}
    assert read(messages, start_at(SPECIFIC, far, LATEST)) == {0: (7, 3)}


def test_latest_after_a_snapshot(messages):
    mine = table_topic(messages, "t")
    ends = end_offsets(mine.filter("offset % 100 < 6"))
    assert ends == {0: 6, 1: 6, 2: 6, 3: 106}
    assert read(messages, start_at(LATEST, ends)) == {
        0: (6, 4), 1: (6, 4), 2: (6, 4), 3: (106, 4)
    }
    # A partition without messages then has only later ones.
    assert read(messages, start_at(LATEST, {0: 6, 1: 6, 2: 6}))[3] == (100, 10)


def test_streams_need_the_ends_to_start_at_the_latest_offset(spark, messages, tmp_path):
    path = str(tmp_path / "topic")
    messages.filter("offset % 100 < 6").write.parquet(path)
    ends = end_offsets(table_topic(spark.read.parquet(path), "t"))
    stream = spark.readStream.schema(ENVELOPE).parquet(path)
    for start in (start_at(LATEST), start_at(SPECIFIC, {0: 7}, LATEST), start_at(GROUP, {}, LATEST)):
        with pytest.raises(ValueError, match="end offsets"):
            table_topic(stream, "t", start)
    later = table_topic(stream, "t", start_at(LATEST, ends)).select("partition", "offset")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    for _ in range(2):
        query = later.writeStream.format("parquet").option("path", out)
        query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        messages.filter("offset % 100 >= 6").write.mode("append").parquet(path)
    assert spark.read.parquet(out).count() == 16


def test_group_offsets(spark, messages, tmp_path):
    path = str(tmp_path / "offsets")
    assert committed_offsets(spark, path, "g", "t") == {}
    commit_offsets(messages.filter("offset < 4"), path, "g")
    commit_offsets(messages.filter("offset < 6 and partition = 1"), path, "g")
    commit_offsets(messages.filter("offset < 4"), path, "g")
    commit_offsets(messages.filter("offset < 9"), path, "other")
    assert committed_offsets(spark, path, "g", "t") == {0: 4, 1: 6, 2: 4}
    assert committed_offsets(spark, path, "g", "u") == {0: 1, 1: 1}
    offsets = committed_offsets(spark, path, "g", "t")
    assert read(messages, start_at(GROUP, offsets)) == {
        0: (4, 6), 1: (6, 4), 2: (4, 6), 3: (100, 10)
    }


def test_a_group_can_be_set_back_and_keeps_few_files(spark, tmp_path):
    path = str(tmp_path / "offsets")
    for n in range(1, 13):
        rows = [("t", p, n * 10 + p) for p in range(2)]
        commit_offsets(spark.createDataFrame(rows, "topic string, partition int, offset bigint"), path, "a/b ü")
    assert committed_offsets(spark, path, "a/b ü", "t") == {0: 121, 1: 122}
    reset_offsets(spark, path, "a/b ü", "t", {1: 5})
    assert committed_offsets(spark, path, "a/b ü", "t") == {0: 121, 1: 5}
    commit_offsets(spark.createDataFrame([("t", 1, 7)], "topic string, partition int, offset bigint"), path, "a/b ü")
    assert committed_offsets(spark, path, "a/b ü", "t") == {0: 121, 1: 8}
    assert len(list((tmp_path / "offsets").rglob("*.parquet"))) <= 2
    with pytest.raises(ValueError, match="needs a name"):
        reset_offsets(spark, path, "", "t", {0: 1})


def test_start_filters_reach_the_scan(spark, messages, tmp_path):
    path = str(tmp_path / "topic")
    messages.write.parquet(path)
    stored = table_topic(spark.read.parquet(path), "t", start_at(SPECIFIC, {0: 7, 3: 105}, LATEST))
    plan = stored.select("value")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") : plan.index("ReadSchema")]
    assert "GreaterThanOrEqual(offset,7)" in pushed and "LessThanOrEqual(partition,3)" in pushed
    assert "ReadSchema: struct<value:binary,topic:string,partition:int,offset:bigint>" in plan


def test_decoded_columns_do_not_stop_envelope_filters(spark, messages, tmp_path):
    path = str(tmp_path / "topic")
    messages.write.parquet(path)
    rows = delimited_table(
        table_topic(spark.read.parquet(path), "t"), {"n": "LONG", "s": "STRING"}, keep=["offset"]
    )
    plan = rows.filter("offset >= 8 and n >= 9")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset,8)" in plan[plan.index("PushedFilters") :]
    assert rows.filter("offset >= 8 and n >= 9").count() == 13


@pytest.mark.parametrize(
    "arguments",
    [
        ("nowhere",),
        (SPECIFIC,),
        (SPECIFIC, {-1: 0}),
        (SPECIFIC, {0: -5}),
        (SPECIFIC, {0: "5"}),
        (SPECIFIC, {True: 5}),
        (SPECIFIC, {0: 1}, GROUP),
        (EARLIEST, {0: 1}),
        (GROUP,),
    ],
)
def test_bad_starts(arguments):
    with pytest.raises(ValueError):
        start_at(*arguments)


@pytest.mark.parametrize("topic, properties", [("", {}), (None, {}), ("t", {"": "x"}), ("t", {"k": None})])
def test_bad_topics(topic, properties):
    with pytest.raises(ValueError):
        check_topic(topic, properties)


def test_topics_and_properties():
    check_topic("t", {"k": ""})
    options = kafka_options(
        {"bootstrap.servers": "h:9092", "zookeeper.connect": "h:2181", "group.id": "g"}
    )
    assert options == {"kafka.bootstrap.servers": "h:9092", "groupIdPrefix": "g"}
    client = {
        "key.serializer": "x", "value.serializer": "x", "key.deserializer": "x", "value.deserializer": "x",
        "enable.auto.commit": "false", "acks": "all", "group.id": "g",
    }
    assert kafka_options(client, writing=True) == {"kafka.acks": "all"}
    for key in ("enable.auto.commit", "auto.offset.reset", "interceptor.classes"):
        with pytest.raises(ValueError, match=f"property {key}"):
            kafka_options({key: "true"})


def test_starting_offsets_option():
    assert starting_offsets("t", start_at(EARLIEST)) == "earliest"
    assert starting_offsets("t", start_at(LATEST)) == "latest"
    specific = start_at(SPECIFIC, {0: 23, 2: 5})
    assert json.loads(starting_offsets("t", specific, 4)) == {"t": {"0": 23, "1": -2, "2": 5, "3": -2}}
    group = start_at(GROUP, {1: 4}, LATEST)
    assert json.loads(starting_offsets("t", group, 2)) == {"t": {"0": -1, "1": 4}}
    with pytest.raises(ValueError, match="number of partitions"):
        starting_offsets("t", specific)
    with pytest.raises(ValueError, match="has 2 partitions"):
        starting_offsets("t", specific, 2)


def test_kafka_needs_servers(spark):
    with pytest.raises(ValueError, match="bootstrap.servers"):
        kafka_topic(spark, "t", {})
    with pytest.raises(ValueError, match="bounded read"):
        kafka_topic(spark, "t", {"bootstrap.servers": "h"}, start_at(LATEST), stream=False)


def test_tables_need_envelopes(spark):
    with pytest.raises(ValueError, match="lack the envelope columns"):
        table_topic(spark.range(1), "t")


def test_json_messages(spark):
    values = ['{"id":1,"name":"a","count":3,"labels":{"colour":"red"}}', '{"id":2,"more":[1]}']
    df = spark.createDataFrame([(v.encode(),) for v in values], "value binary")
    schema = {"id": "LONG", "name": "STRING", "count": "INT", "labels": "map<string,string>"}
    rows = json_table(df, schema).collect()
    assert [tuple(r) for r in rows] == [(1, "a", 3, {"colour": "red"}), (2, None, None, None)]
    renamed = json_table(df, {"key": "LONG"}, mapping={"key": "id"})
    assert [r.key for r in renamed.collect()] == [1, 2]

    broken = spark.createDataFrame([(b"not json",), (None,)], "value binary").coalesce(1)
    assert [tuple(r) for r in json_table(broken, {"id": "LONG"}, mode="PERMISSIVE").collect()] == [
        (None,), (None,)
    ]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        json_table(broken.limit(1), {"id": "LONG"}).collect()
    for empty in (b"", b" \n\t", b"null"):
        blank = spark.createDataFrame([(empty,)], "value binary")
        with pytest.raises(Exception, match="empty JSON message"):
            json_table(blank, {"id": "LONG"}).collect()
        assert json_table(blank, {"id": "LONG"}, mode="PERMISSIVE").collect()[0].id is None
    with pytest.raises(Exception, match="null message"):
        json_table(broken.filter("value is null"), {"id": "LONG"}).collect()
    with pytest.raises(ValueError, match="needs a schema"):
        json_table(df)
