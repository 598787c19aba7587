"""Topics as DataFrames of message envelopes, and where reading starts.

A topic is read from Kafka, or from any table or stream that has the envelope columns. The Kafka
connector is not present in the development container: the options passed to it are tested, reading
through it is not.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of a message as the connector gives them.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# The names of the start modes.
EARLIEST = "earliest-offset"
LATEST = "latest-offset"
GROUP = "group-offsets"
SPECIFIC = "specific-offsets"
START_MODES = (EARLIEST, LATEST, GROUP, SPECIFIC)

# Offsets that stand for the two ends of a partition in the connector's options.
KAFKA_EARLIEST, KAFKA_LATEST = -2, -1


@dataclass(frozen=True)
class Start:
    """Where reading starts: an offset per partition, and one of the two ends for the others."""

    otherwise: str = EARLIEST
    offsets: Mapping[int, int] = field(default_factory=dict)
    #: The offsets are the ends of all partitions that had messages; others had none.
    ends: bool = False


def check_topic(topic: str, properties: Mapping[str, str] | None = None) -> None:
    """Refuse an empty topic name and properties without a key or a value."""
    if not isinstance(topic, str) or not topic:
        raise ValueError("a topic needs a name")
    for key, value in (properties or {}).items():
        if not isinstance(key, str) or not key:
            raise ValueError("a property needs a key")
        if not isinstance(value, str):
            raise ValueError(f"property {key} needs a text value")


def start_at(
    mode: str = EARLIEST,
    offsets: Mapping[int, int] | None = None,
    otherwise: str | None = None,
) -> Start:
    """A start position.

    `specific-offsets` and `group-offsets` take the first offset to read per partition; partitions
    without one start at `otherwise`, the earliest offset unless told. `latest-offset` over a
    table or stream of envelopes takes the end offsets that count as "now" (see `end_offsets`).
    """
    if mode not in START_MODES:
        raise ValueError(f"start mode must be one of {START_MODES}, not {mode!r}")
    if otherwise not in (None, EARLIEST, LATEST):
        raise ValueError(f"otherwise must be {EARLIEST!r} or {LATEST!r}, not {otherwise!r}")
    if mode == SPECIFIC and not offsets:
        raise ValueError("specific-offsets needs an offset for at least one partition")
    if mode == GROUP and offsets is None:
        raise ValueError("group-offsets needs the offsets of the group")
    if mode == EARLIEST and offsets:
        raise ValueError("earliest-offset takes no offsets")
    for partition, offset in (offsets or {}).items():
        for number in (partition, offset):
            if not isinstance(number, int) or isinstance(number, bool) or number < 0:
                raise ValueError(f"partition and offset must be integers >= 0, not {number!r}")
    if mode == LATEST:
        return Start(LATEST, dict(offsets or {}), offsets is not None)
    return Start(otherwise or EARLIEST, dict(offsets or {}))


def end_offsets(messages: DataFrame) -> dict[int, int]:
    """The offset after the last message of each partition of a bounded table.

    One row per topic partition comes to the driver.
    """
    ends = messages.groupBy("partition").agg((F.max("offset") + 1).alias("offset"))
    return {row.partition: row.offset for row in ends.toLocalIterator()}


def from_start(messages: DataFrame, start: Start) -> DataFrame:
    """The messages at or after the start position, for a table or stream of envelopes.

    With end offsets, partitions that are not among them had no messages and are read from their
    first one. Without, a bounded table has nothing after its latest offset, and a stream is
    refused: which of its messages come later cannot be told from the messages.
    """
    if messages.isStreaming and start.otherwise == LATEST and not start.ends:
        raise ValueError("a stream of messages needs the end offsets to start at the latest offset")
    from_first = start.otherwise == EARLIEST or start.ends
    if not start.offsets:
        return messages if from_first else messages.filter(F.lit(False))
    open_from = 0 if from_first else None
    floor = min([*start.offsets.values(), *([0] if open_from == 0 else [])])
    kept = messages.filter(F.col("offset") >= floor) if floor else messages
    if open_from is None:
        kept = kept.filter(F.col("partition").between(min(start.offsets), max(start.offsets)))
    return kept.filter(F.col("offset") >= _offset_of(F.col("partition"), start.offsets, open_from))


def _offset_of(partition: Column, offsets: Mapping[int, int], otherwise: int | None) -> Column:
    """The start offset of a partition, looked up by position in an array of literals.

    Partitions are numbered from 0; numbers far beyond their count are looked up in a map.
    """
    if max(offsets) < 1000 + 10 * len(offsets):
        starts = F.array(
            *[F.lit(offsets.get(p, otherwise)).cast("bigint") for p in range(max(offsets) + 1)]
        )
        known = F.get(starts, partition)
    else:
        pairs = [F.lit(n).cast(t) for p in offsets.items() for n, t in zip(p, ("int", "bigint"))]
        known = F.create_map(*pairs)[partition]
    return known if otherwise is None else F.coalesce(known, F.lit(otherwise))


def table_topic(messages: DataFrame, topic: str, start: Start | None = None) -> DataFrame:
    """A topic kept in a table or stream with the envelope columns."""
    check_topic(topic)
    missing = [f.name for f in ENVELOPE if f.name not in messages.columns]
    if missing:
        raise ValueError(f"messages lack the envelope columns {', '.join(missing)}")
    return from_start(
        messages.select(*ENVELOPE.names).filter(F.col("topic") == topic), start or Start()
    )


# Client properties with no meaning for the connector, which reads and writes bytes.
DROPPED_PROPERTIES = (
    "zookeeper.connect",
    "key.serializer",
    "value.serializer",
    "key.deserializer",
    "value.deserializer",
)
# Client properties that the connector refuses, and what to use in their place.
REFUSED_PROPERTIES = {
    "auto.offset.reset": "choose the start with start_at",
    "enable.auto.commit": "commit with commit_offsets",
    "interceptor.classes": "the connector cannot run interceptors",
}


def kafka_options(properties: Mapping[str, str], writing: bool = False) -> dict[str, str]:
    """Consumer or producer properties as connector options.

    The connector keeps its own positions, so a group id becomes a prefix of its group names; for a
    writer it means nothing.
    """
    options = {}
    for key, value in properties.items():
        if key in REFUSED_PROPERTIES and (key, value) != ("enable.auto.commit", "false"):
            raise ValueError(f"property {key} cannot be used: {REFUSED_PROPERTIES[key]}")
        if key in DROPPED_PROPERTIES or key in REFUSED_PROPERTIES:
            continue
        if key == "group.id":
            if not writing:
                options["groupIdPrefix"] = value
        else:
            options[f"kafka.{key}"] = value
    return options


def starting_offsets(topic: str, start: Start, partitions: int | None = None) -> str:
    """The connector's `startingOffsets` for a start position.

    The connector wants an entry for every partition, so offsets need the partition count.
    """
    if not start.offsets:
        return "earliest" if start.otherwise == EARLIEST else "latest"
    if partitions is None:
        raise ValueError("start offsets need the number of partitions of the topic")
    if max(start.offsets) >= partitions:
        raise ValueError(f"topic {topic} has {partitions} partitions, not {max(start.offsets) + 1}")
    end = KAFKA_EARLIEST if start.otherwise == EARLIEST else KAFKA_LATEST
    return json.dumps({topic: {str(p): start.offsets.get(p, end) for p in range(partitions)}})


def kafka_topic(
    spark: SparkSession,
    topic: str,
    properties: Mapping[str, str],
    start: Start | None = None,
    *,
    partitions: int | None = None,
    stream: bool = True,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A Kafka topic as a stream, or as a bounded table if `stream` is off.

    `options` are passed to the connector as they are, for example `minPartitions`,
    `maxOffsetsPerTrigger` or `failOnDataLoss`.
    """
    check_topic(topic, properties)
    if not properties.get("bootstrap.servers"):
        raise ValueError("a Kafka topic needs bootstrap.servers")
    start = start or Start()
    if not stream and start.otherwise == LATEST:
        raise ValueError("a bounded read cannot start at the latest offset")
    reader = spark.readStream if stream else spark.read
    return (
        reader.format("kafka")
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets(topic, start, partitions))
        .options(**kafka_options(properties))
        .options(**(options or {}))
        .load()
    )
