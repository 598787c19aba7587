"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder of spark.checkpoint.dir, which driver and executors share. Where that
    is unset, only a local session gets a temporary folder; a cluster is refused."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read again, which cuts the lineage."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder(id_column: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor; null for a null id."""
    return F.crc32(id_column.cast("string").cast("binary")) % divisor


def byte_texts(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def each_batch(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str, rows: int | None = None) -> DataFrame:
    """function on every Arrow batch, or on slices of so many rows of it; it keeps nothing between them,
    and the caches of a worker are emptied at the end of its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, rows or max(1, batch.num_rows)):
                    yield from function(batch.slice(at, rows))
        finally:
            empty_caches()

    return df.mapInArrow(run, schema)


#: Caches of this worker that hold anything.
CACHES: list[dict] = []


def alone(cache: dict) -> None:
    """Empty the caches of other operators, which a worker that runs several of them still holds."""
    for other in [c for c in CACHES if c is not cache]:
        other.clear()
    if not any(c is cache for c in CACHES):
        CACHES.append(cache)


def empty_caches() -> None:
    for cache in CACHES:
        cache.clear()
    CACHES.clear()


class Vocabulary(dict):
    """Word -> 64-bit hash, kept between batches of a worker and emptied when it has grown large."""

    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


HASHES = Vocabulary()


def word_hashes(words: list[bytes]) -> np.ndarray:
    alone(HASHES)
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal neighbours."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return starts, np.diff(np.r_[starts, len(values)])


#: A component's smallest id goes to its members in so many shares.
SHARES = 32


def with_smallest(members: DataFrame, root: str, node: str, value: str, name: str) -> DataFrame:
    """The rows, one per node, with the least value of all that have their root.

    A root may have a third of all rows: values are pre-aggregated, and what goes back is dealt by
    the hash of the node. Rows that are alone with their root take part in no join.
    """
    least = members.groupBy(root).agg(F.min(value).alias("_least"), F.count("*").alias("_n")).where("_n > 1")
    share = F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("_share")
    dealt = members.withColumn("_share", F.pmod(F.xxhash64(node), F.lit(SHARES)).cast("int"))
    found = dealt.join(least.select(root, "_least", share), [root, "_share"], "left")
    return found.withColumn(name, F.coalesce("_least", value)).drop("_share", "_least")


def connected_components(edges: DataFrame, first: str, second: str) -> DataFrame:
    """(node, root) of every node of the edges that is not itself the smallest node of its component.

    Alternating star contraction: every node hands its larger neighbours to its smallest one, then
    its smaller neighbours. Minima are pre-aggregated and joined, no neighbourhood is gathered, so a
    hub is no hot group. Rounds grow with the logarithm of the longest path; each ends in a checkpoint.
    Nodes of any type that can be ordered; edges with a null and loops are ignored.
    """
    spark = edges.sparkSession
    shared_folder(spark)
    pairs = (
        edges.select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v"))
        .where(F.col(first).isNotNull() & F.col(second).isNotNull() & (F.col("u") > F.col("v")))
        .distinct()
        .checkpoint()
    )
    seen = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u != v")
            .distinct()
            .checkpoint()
        )
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
