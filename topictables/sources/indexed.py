"""Stored topics with an index of their files.

The index is a zone map: for every file and partition in it the first and last offset and time. It is
kept when messages are appended and read before the topic, so a start position opens only files
that reach it. A file that is not in the index is not part of the topic, so an append that fails
half-way adds nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topictables.sources.topic import EARLIEST, ENVELOPE, Start, table_topic

ZONES = "topic string, file string, partition int, first_offset bigint, last_offset bigint, first_time timestamp, last_time timestamp, messages bigint"


def append_messages(messages: DataFrame, path: str) -> None:
    """Add envelopes to a stored topic, and the zones of their files to its index.

    Files hold the messages as they are dealt to the writers: the narrower the range of offsets that
    each writer has, the fewer files a start position opens. Zones are read from the new files alone,
    two columns of them; an index has a row per file and partition.
    """
    spark, name = messages.sparkSession, uuid.uuid4().hex
    folder = f"{path}/messages/{name}"
    messages.select(*ENVELOPE.names).write.parquet(folder)
    written = spark.read.schema(ENVELOPE).parquet(folder)
    file = F.concat(F.lit(f"{name}/"), F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    offset, time = F.col("offset"), F.col("timestamp")
    zones = written.groupBy("topic", file.alias("file"), "partition").agg(
        F.min(offset).alias("first_offset"),
        F.max(offset).alias("last_offset"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
        F.count("*").alias("messages"),
    )
    zones.write.mode("append").parquet(f"{path}/zones")


def zones(spark: SparkSession, path: str) -> DataFrame:
    """The index of a stored topic."""
    return spark.read.schema(ZONES).parquet(f"{path}/zones")


def files_from(spark: SparkSession, path: str, topic: str, start: Start | None = None, since: object = None) -> list[str]:
    """The files that hold messages at or after the start position, and at or after a time.

    Their names come to the driver, as those of any table's files do when it is listed.
    """
    start = start or Start()
    reached = F.col("topic") == topic
    if start.offsets:
        first = F.coalesce(_start_of(start), F.lit(0) if _from_first(start) else F.lit(None).cast("bigint"))
        reached &= F.col("last_offset") >= first
    elif not _from_first(start):
        return []
    if since is not None:
        reached &= F.col("last_time") >= F.lit(since).cast("timestamp")
    found = zones(spark, path).filter(reached).select("file").distinct()
    return sorted(f"{path}/messages/{row.file}" for row in found.toLocalIterator())


def _from_first(start: Start) -> bool:
    return start.otherwise == EARLIEST or start.ends


def _start_of(start: Start) -> Column:
    pairs = [F.lit(n).cast(kind) for offsets in start.offsets.items() for n, kind in zip(offsets, ("int", "bigint"), strict=True)]
    return F.create_map(*pairs)[F.col("partition")]


def indexed_topic(spark: SparkSession, path: str, topic: str, start: Start | None = None, since: object = None) -> DataFrame:
    """A stored topic from its start position on, and from a time on if `since` is given; only the
    files that the index picks are opened."""
    picked = files_from(spark, path, topic, start, since)
    if not picked:
        return spark.createDataFrame([], ENVELOPE)
    messages = table_topic(spark.read.schema(ENVELOPE).parquet(*picked), topic, start)
    return messages if since is None else messages.filter(F.col("timestamp") >= F.lit(since).cast("timestamp"))
