"""Time columns of a table, late and repeated messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_proctime(df: DataFrame, name: str) -> DataFrame:
    """Add the processing time (T1). Spark fixes it per micro-batch, not per row."""
    if name in df.columns:
        raise ValueError(f"the table already has a column {name}")
    return df.withColumn(name, F.current_timestamp())


def with_rowtime(df: DataFrame, name: str, source: str | None = None, delay: str = "0 seconds") -> DataFrame:
    """Declare the event-time column of a table and how late rows may come.

    `source` makes a new column out of another, for example the message `timestamp` kept from the
    envelope (T3). Watermarks need timestamps with a zone; wall-clock columns are read in the
    session's zone.
    """
    if not name:
        raise ValueError("an event-time column needs a name")
    source = source or name
    if source not in df.columns:
        raise ValueError(f"the table has no column {source}")
    kind = df.schema[source].dataType.typeName()
    if kind not in ("timestamp", "timestamp_ntz"):
        raise ValueError(f"event time must be a timestamp, column {source} is {kind}")
    if source != name or kind == "timestamp_ntz":
        df = df.withColumn(name, F.col(source).cast("timestamp"))
    return df.withWatermark(name, delay)


def without_repeats(messages: DataFrame, delay: str, time: str = "timestamp", keys: Sequence[str] = ("topic", "partition", "offset")) -> DataFrame:
    """Messages without those that come again, for example after a producer or a reader failed.

    A stream keeps the keys of the messages within `delay` of the latest time in its state store, drops
    what comes again within the delay, and what is later than the delay altogether. So its state is
    bounded by the delay, not by the topic. A bounded table keeps one message of each key.
    """
    missing = [name for name in (time, *keys) if name not in messages.columns]
    if missing:
        raise ValueError(f"the table has no column {', '.join(missing)}")
    if not messages.isStreaming:
        return messages.dropDuplicates(list(keys))
    return with_rowtime(messages, time, delay=delay).dropDuplicatesWithinWatermark(list(keys))
