"""Which partition of the output topic a row goes to (K3, K4)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A custom assignment (K4): a function of the number of partitions, giving the partition column.
Partitioner = Callable[[int], Column]


def fixed(partitions: int) -> Column:
    """Each parallel writer writes to one partition; partitions are shared or stay empty (K3)."""
    if partitions < 1:
        raise ValueError("a topic has at least one partition")
    return F.pmod(F.spark_partition_id(), F.lit(partitions)).cast("int")
