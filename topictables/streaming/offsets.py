"""Offsets a consumer group has read, kept as a table.

Spark queries restart from their own checkpoint. This table is for what a group id does beyond
that: a new query, batch or stream, that goes on where the group stopped. Each commit writes the
group's whole state, one row per topic partition, as a new version and drops all but the one before,
so the files stay few. One writer per group at a time; a commit repeated after a failure changes
nothing.
"""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import quote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

STATE = "topic string, partition int, offset bigint"
KEPT_VERSIONS = 2


def commit_offsets(messages: DataFrame, path: str, group: str) -> None:
    """Record that `group` has read these messages. A commit never moves the group back."""
    read = messages.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("offset"))
    _write(messages.sparkSession, path, group, read, F.max("offset"))


def commit_read(spark: SparkSession, path: str, group: str, topic: str, offsets: Mapping[int, int]) -> None:
    """Record the next offsets of a group that are known already. A commit never moves the group back."""
    rows = spark.createDataFrame([(topic, p, o) for p, o in offsets.items()], STATE)
    _write(spark, path, group, rows, F.max("offset"))


class ObservedOffsets(StreamingQueryListener):
    """Commits what a stream has read by what it observes of itself.

    `observed` puts the metrics into the stream: the last offset of each partition of the topic, counted
    while the batch passes, so a commit needs no aggregation of its own. As a listener of the
    session (`spark.streams.addListener`) it commits each batch some time after it has ended;
    `commit(query)` does the same at once, for a query that has stopped.
    """

    def __init__(self, spark: SparkSession, path: str, group: str, topic: str, partitions: int):
        if partitions < 1:
            raise ValueError("a topic has at least one partition")
        self.spark, self.path, self.group = spark, path, group
        self.topic, self.partitions = topic, partitions
        self.metric = f"read offsets of {group} in {topic}"

    def observed(self, messages: DataFrame) -> DataFrame:
        """The messages, whose partitions are numbered below the number given; others raise at the commit."""
        partition, offset = F.col("partition"), F.col("offset")
        last = [F.max(F.when(partition == p, offset)).alias(f"p{p}") for p in range(self.partitions)]
        beyond = F.max(F.when(partition >= self.partitions, partition)).alias("beyond")
        return messages.observe(self.metric, *last, beyond)

    def commit(self, query: StreamingQuery) -> None:
        for progress in query.recentProgress:
            self._commit(progress.observedMetrics)

    def _commit(self, metrics: Mapping[str, Row]) -> None:
        row = metrics.get(self.metric)
        if row is None:
            return
        if row["beyond"] is not None:
            raise ValueError(f"topic {self.topic} has a partition {row['beyond']}")
        offsets = {p: row[f"p{p}"] + 1 for p in range(self.partitions) if row[f"p{p}"] is not None}
        if offsets:
            commit_read(self.spark, self.path, self.group, self.topic, offsets)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._commit(event.progress.observedMetrics)

    def onQueryTerminated(self, event) -> None:
        pass


def reset_offsets(
    spark: SparkSession, path: str, group: str, topic: str, offsets: Mapping[int, int]
) -> None:
    """Set the group's next offset of these partitions, forwards or back."""
    rows = spark.createDataFrame([(topic, p, o) for p, o in offsets.items()], STATE)
    _write(spark, path, group, rows, F.max_by("offset", "new"))


def committed_offsets(spark: SparkSession, path: str, group: str, topic: str) -> dict[int, int]:
    """The next offset of each partition for `group`; empty if it has not committed yet.

    One row per topic partition comes to the driver.
    """
    folder, versions = _versions(spark, path, group)
    if not versions:
        return {}
    state = spark.read.schema(STATE).parquet(f"{folder}/version={versions[-1]}")
    rows = state.filter(F.col("topic") == topic)
    return {row.partition: row.offset for row in rows.toLocalIterator()}


def _write(spark: SparkSession, path: str, group: str, rows: DataFrame, merged) -> None:
    if not group:
        raise ValueError("a consumer group needs a name")
    folder, versions = _versions(spark, path, group)
    state = rows.select("topic", "partition", "offset", F.lit(1).alias("new"))
    if versions:
        before = spark.read.schema(STATE).parquet(f"{folder}/version={versions[-1]}")
        state = state.unionByName(before.withColumn("new", F.lit(0)))
    number = versions[-1] + 1 if versions else 0
    # The rows are few once they are merged, and only then brought into one file.
    (
        state.groupBy("topic", "partition")
        .agg(merged.alias("offset"))
        .repartition(1)
        .write.mode("overwrite")
        .parquet(f"{folder}/version={number}")
    )
    files = _file_system(spark, folder)
    for old in versions[: max(0, len(versions) + 1 - KEPT_VERSIONS)]:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/version={old}"), True)


def _versions(spark: SparkSession, path: str, group: str) -> tuple[str, list[int]]:
    """The group's folder and its versions that were written to the end, in order."""
    folder = f"{path}/group={quote(group, safe='')}"
    files, hadoop = _file_system(spark, folder), spark._jvm.org.apache.hadoop.fs
    if not files.exists(hadoop.Path(folder)):
        return folder, []
    names = [status.getPath().getName() for status in files.listStatus(hadoop.Path(folder))]
    numbers = sorted(int(n.partition("=")[2]) for n in names if n.startswith("version="))
    return folder, [n for n in numbers if files.exists(hadoop.Path(f"{folder}/version={n}/_SUCCESS"))]


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration())
