"""Sinks: rows as Avro or JSON messages to topics, files or the console.

A sink is described once and serves batch writes, streams, and streams with several outputs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from topictables.functions.avro import to_avro_message
from topictables.functions.json_text import to_json_message
from topictables.operators.conform import conform
from topictables.operators.partitioning import Partitioner, fixed
from topictables.plans.schema import avro_schema, table_schema
from topictables.sources.topic import check_topic, kafka_options


@dataclass(frozen=True)
class Sink:
    """Where rows go (`format`, `options`), their schema if declared, and how they become messages."""

    format: str
    options: Mapping[str, str] = field(default_factory=dict)
    schema: T.StructType | None = None
    topic: str | None = None
    encode: Callable[[Column], Column] | None = None
    partition: Column | None = None
    key: Column | None = None

    def rows(self, df: DataFrame) -> DataFrame:
        """The DataFrame to write: typed rows, or `topic`, `value`, `partition` and `key` of messages."""
        columns = conform(df, self.schema) if self.schema is not None else ["*"]
        if self.encode is None:
            return df.select(*columns)
        if self.schema is None:
            columns = [F.col(f"`{name}`") for name in df.columns]
        message = [
            F.lit(self.topic).alias("topic"),
            self.encode(F.struct(*columns)).alias("value"),
        ]
        if self.partition is not None:
            message.append(self.partition.alias("partition"))
        if self.key is not None:
            message.append(self.key.cast("binary").alias("key"))
        return df.select(*message)


def _partition(partitioner: Column | Partitioner | None, partitions: int | None) -> Column | None:
    if partitioner is None:
        return fixed(partitions) if partitions else None
    if isinstance(partitioner, Column):
        return partitioner
    if not partitions:
        raise ValueError("the partitioner needs the number of partitions of the topic")
    return partitioner(partitions)


def _target(topic: str, properties: Mapping[str, str] | None, path: str | None):
    check_topic(topic, properties)
    if (properties is None) == (path is None):
        raise ValueError("a topic sink needs either producer properties or a path")
    return ("parquet", {"path": path}) if path else ("kafka", kafka_options(properties, writing=True))


def avro_topic(
    topic: str,
    record: str | dict,
    properties: Mapping[str, str] | None = None,
    *,
    path: str | None = None,
    partitions: int | None = None,
    partitioner: Column | Partitioner | None = None,
    key: Column | None = None,
) -> Sink:
    """Rows as Avro records to a topic (K1), columns matched by position.

    With `partitions` each parallel writer keeps to one partition, unless a partitioner decides.
    With `path` the messages go to Parquet files instead of Kafka.
    """
    kind, options = _target(topic, properties, path)
    return Sink(
        kind,
        options,
        avro_schema(record),
        topic,
        lambda row: to_avro_message(row, record),
        _partition(partitioner, partitions),
        key,
    )


def json_topic(
    topic: str,
    properties: Mapping[str, str] | None = None,
    schema: object = None,
    *,
    path: str | None = None,
    partitions: int | None = None,
    partitioner: Column | Partitioner | None = None,
    key: Column | None = None,
) -> Sink:
    """Rows as JSON objects to a topic (K2), with the key of the message if one is given."""
    kind, options = _target(topic, properties, path)
    declared = table_schema(schema) if schema is not None else None
    partition = _partition(partitioner, partitions)
    return Sink(kind, options, declared, topic, to_json_message, partition, key)


def console() -> Sink:
    """Print every row, its values separated by commas, where it is computed (K5).

    On a cluster that is the executors' output; nothing is brought to the driver.
    """
    return Sink("console")


def _print_row(row) -> None:
    print(*("null" if value is None else value for value in row), sep=",", flush=True)


def _print_rows(rows) -> None:
    for row in rows:
        _print_row(row)


def files(path: str, schema: object = None, format: str = "parquet") -> Sink:
    """Typed rows to files."""
    declared = table_schema(schema) if schema is not None else None
    return Sink(format, {"path": path}, declared)


def write(df: DataFrame, sink: Sink) -> None:
    """Append a bounded query's rows to a sink."""
    rows = sink.rows(df)
    if sink.format == "console":
        rows.foreachPartition(_print_rows)
    else:
        rows.write.format(sink.format).options(**sink.options).mode("append").save()


def start(
    df: DataFrame,
    sink: Sink,
    checkpoint: str | None,
    *,
    available_now: bool = False,
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a stream into one sink, in append mode (T5).

    `available_now` stops after the messages that are there; otherwise the stream never ends (T4).
    """
    writer = sink.rows(df).writeStream
    if sink.format == "console":
        writer = writer.foreach(_print_row)
    else:
        writer = writer.format(sink.format).options(**sink.options)
    return _started(writer.outputMode("append"), checkpoint, available_now, every, name)


def _started(writer, checkpoint, available_now, every, name):
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    if name:
        writer = writer.queryName(name)
    return writer.start()


Output = tuple[Callable[[DataFrame], DataFrame] | None, Sink]


def start_all(
    df: DataFrame,
    outputs: Sequence[Output],
    checkpoint: str,
    *,
    available_now: bool = False,
    every: str | None = None,
    name: str | None = None,
    after_batch: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """One stream into several sinks, each behind its own query on the same rows (K7, K8).

    Every micro-batch is decoded once and, if there are several outputs, kept for them; over a
    large topic set the source's `maxOffsetsPerTrigger`. After a failure Spark repeats the last
    batch: file outputs overwrite the directory named by the ids of the query and the batch, Kafka
    outputs may repeat messages. The query's id comes from its checkpoint, so queries with other
    checkpoints add to the same path. `after_batch` runs once the outputs are written, for example
    to commit offsets.
    """
    if not outputs:
        raise ValueError("name at least one output")
    for query, sink in outputs:
        sink.rows(query(df) if query else df)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        kept = len(outputs) + bool(after_batch) > 1
        if kept:
            batch.persist()
        try:
            for query, sink in outputs:
                _write_batch(query(batch) if query else batch, sink, batch_id)
            if after_batch:
                after_batch(batch, batch_id)
        finally:
            if kept:
                batch.unpersist()

    writer = df.writeStream.foreachBatch(write_batch)
    return _started(writer, checkpoint, available_now, every, name)


def _write_batch(df: DataFrame, sink: Sink, batch_id: int) -> None:
    if "path" not in sink.options:
        return write(df, sink)
    query_id = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    folder = f"query={query_id}/batch={batch_id}"
    options = dict(sink.options, path=f"{sink.options['path']}/{folder}")
    sink.rows(df).write.format(sink.format).options(**options).mode("overwrite").save()


def routed(
    df: DataFrame, routes: Sequence[tuple[Column | None, Sequence[str | Column], Sink]]
) -> DataFrame:
    """Messages for several topics of one cluster in a single pass over the rows (K8).

    A route is a condition (None takes every row), the columns to send and a topic sink. Each row
    gives one message per route it meets; the `topic` column says where it goes. Nothing is kept
    between outputs, so this is the cheaper form of `start_all` where all outputs are topics.
    """
    wanted, values, partitions, keys = [], [], [], []
    route = F.col("_route")
    for number, (condition, columns, sink) in enumerate(routes):
        if sink.encode is None:
            raise ValueError("only topic sinks can be routed to")
        columns = [F.col(c) if isinstance(c, str) else c for c in columns]
        if sink.schema is not None:
            columns = conform(df.select(*columns), sink.schema)
        tag = F.lit(number)
        wanted.append(tag if condition is None else F.when(condition, tag))
        # Rows of other routes are null here: they are neither checked nor encoded.
        values.append(sink.encode(F.when(route == number, F.struct(*columns))))
        partition = F.lit(None) if sink.partition is None else sink.partition
        partitions.append(F.when(route == number, partition.cast("int")))
        if sink.key is not None:
            keys.append(F.when(route == number, sink.key.cast("binary")))
    tags = F.filter(F.array(*wanted), lambda tag: tag.isNotNull())
    topics = F.array(*[F.lit(sink.topic) for _, _, sink in routes])
    return df.select("*", F.explode(tags).alias("_route")).select(
        F.get(topics, route).alias("topic"),
        F.coalesce(*values).alias("value"),
        F.coalesce(*partitions).alias("partition"),
        *([F.coalesce(*keys).alias("key")] if keys else []),
    )
