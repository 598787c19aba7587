"""Embedding near-duplicates through a pivot-permutation index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topictables.llm.common import connected_components, each_batch, shared_folder, stored, table, with_smallest

#: Reference points: one for so many different vectors, within these bounds, from a sample of the same size.
VECTORS_A_PIVOT, LEAST_PIVOTS, MOST_PIVOTS = 32, 16, 16_384
#: Nearest pivots that describe a vector, and how many of them two vectors must share to be compared.
NEAREST, SHARED = 8, 2
#: No two pivots have a larger cosine.
APART = 0.8
#: Vectors of a list that one task compares with each other. A longer list is split by a second pivot,
#: and what is still longer into blocks.
BLOCK = 2048
#: Vectors that are held against all pivots at a time, and pairs whose pivots are compared at a time.
VECTORS, PAIRS = 256, 200_000


def _packed(df: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """(id, label, vector): the vector as doubles in bytes, null where it can link with nothing."""

    def pack(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        blobs = []
        for key, label, vector in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            v = np.array([np.nan if x is None else x for x in vector], float) if vector and key is not None and label is not None else np.zeros(0)
            blobs.append((v + 0.0).tobytes() if len(v) and np.isfinite(v).all() and v.any() else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary())], ["id", "label", "vector"])

    source = df.select(F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(vector_column).alias("vector"))
    kinds = [source.schema[c].dataType.simpleString() for c in ("id", "label")]
    return each_batch(source, pack, f"id {kinds[0]}, label {kinds[1]}, vector binary")


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _pivots(distinct: DataFrame, n: int) -> dict[int, np.ndarray]:
    """By dimension, reference points of length one: vectors of a sample of the bounded size, by hash. Of
    those that lie close together one is kept, else the order of pivots within a dense group is chance."""
    count = int(np.clip(n // VECTORS_A_PIVOT, LEAST_PIVOTS, MOST_PIVOTS))
    found: dict[int, list[np.ndarray]] = {}
    for r in distinct.select("vector", F.xxhash64("vector").alias("h")).orderBy("h", "vector").limit(count).collect():
        v = np.frombuffer(bytes(r["vector"]))
        found.setdefault(len(v), []).append(v)
    return {d: _apart(unit(np.array(vs))) for d, vs in found.items()}


def _apart(points: np.ndarray, block: int = 1024) -> np.ndarray:
    """One after another, the points that lie apart from all that were kept before."""
    kept = points[:0]
    for at in range(0, len(points), block):
        part = points[at : at + block]
        part = part[~(part @ kept.T > APART).any(1)]
        near = part @ part.T > APART
        some: list[int] = []
        for i in range(len(part)):
            if not near[i, some].any():
                some.append(i)
        kept = np.concatenate([kept, part[some]])
    return kept


def permutations(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The numbers of the NEAREST pivots of each vector, nearest first."""
    near = min(NEAREST, len(pivots))
    found = np.zeros((len(vectors), near), np.int64)
    for at in range(0, len(vectors), VECTORS):
        similar = unit(vectors[at : at + VECTORS]) @ pivots.T
        some = np.argpartition(-similar, near - 1, axis=1)[:, :near]
        order = np.argsort(-np.take_along_axis(similar, some, 1), axis=1, kind="stable")
        found[at : at + VECTORS] = np.take_along_axis(some, order, 1)
    return found


def linked(a: np.ndarray, b: np.ndarray, lists_a: np.ndarray, lists_b: np.ndarray, pivot: int, second: int, least: float) -> np.ndarray:
    """Which pairs of vectors link and are counted in this list: those that share SHARED pivots or
    more, of which this is the first (and the second, if the list has one), and whose cosine is high
    enough. Pivots are counted for pairs of high cosine only, which one product has found."""
    adjacent = unit(a) @ unit(b).T >= least
    one, two = np.nonzero(adjacent)
    none = np.iinfo(np.int64).max
    for at in range(0, len(one), PAIRS):
        i, j = one[at : at + PAIRS], two[at : at + PAIRS]
        mine = lists_a[i]
        same = (mine[:, :, None] == lists_b[j][:, None, :]).any(2)
        first = np.sort(np.where(same, mine, none), axis=1)[:, :2]
        here = (same.sum(1) >= min(SHARED, lists_a.shape[1])) & (first[:, 0] == pivot)
        if second >= 0:
            here &= first[:, 1] == second
        adjacent[i, j] = here
    return adjacent


def _roots(adjacent: np.ndarray) -> np.ndarray:
    """The smallest index that each index reaches."""
    root = np.arange(len(adjacent))
    while True:
        new = np.minimum(root, np.where(adjacent, root[None, :], len(root)).min(1, initial=len(root)))
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_duplicates(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", cosine: float = 0.98) -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    Rows link if their labels are equal and not null and their vectors have a cosine, in doubles, of
    `cosine` or more; n_links counts other rows, component_id is the smallest id reachable. Vectors
    that are null, empty, zero or hold null or non-finite components, and rows without id or label, link
    with nothing. Rows that repeat, with the same id too, are counted as vectors of their own.
    Vectors of different lengths are never compared. An empty table gives no rows.

    Equal vectors are merged first. A vector is described by its nearest pivots in order; each of them
    has an inverted list per label. A pair is found in the list of its first shared pivot if it shares
    enough of them, and is verified there. A list beyond BLOCK is split by second pivots, which leaves
    in each part only vectors that share both; parts beyond BLOCK are compared block by block in tasks
    of their own. Pivots grow with the vectors up to MOST_PIVOTS. Pairs stay in the task, which returns
    counts and a star of links for each vector.
    """
    spark = df.sparkSession
    shared_folder(spark)
    packed = _packed(df, id_column, vector_column, label_column)
    merged = packed.where("vector is not null").groupBy("label", "vector").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    distinct = merged.withColumn("node", F.md5(F.concat_ws("/", F.col("label").cast("string"), F.hex("vector")))).checkpoint()
    pivots = spark.sparkContext.broadcast(_pivots(distinct, distinct.count()))
    kind = df.schema[label_column].dataType.simpleString()

    def describe(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vectors = [np.frombuffer(v) for v in batch.column(2).to_pylist()]
        lists: list = [None] * len(vectors)
        for d in {len(v) for v in vectors}:
            rows = [i for i, v in enumerate(vectors) if len(v) == d]
            if d in pivots.value:
                found = permutations(np.array([vectors[i] for i in rows]), pivots.value[d])
            else:
                found = np.zeros((len(rows), 1), int)
            for i, f in zip(rows, found.tolist(), strict=True):
                lists[i] = f
        sizes = pa.array([len(v) for v in vectors], pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(3), sizes, pa.array(lists, pa.list_(pa.int32()))], ["node", "label", "vector", "copies", "size", "pivots"])

    described = stored(each_batch(distinct.select("node", "label", "vector", "copies"), describe, f"node string, label {kind}, vector binary, copies long, size int, pivots array<int>"))
    listed = described.select("*", F.explode("pivots").alias("pivot"))
    key = ["label", "size", "pivot", "second"]
    sizes = listed.groupBy("label", "size", "pivot").count().where(F.col("count") > 1)
    counted = listed.join(sizes, ["label", "size", "pivot"])
    # Pairs of a long list meet in the list of their first two shared pivots, which only their kind are in.
    crowded = (F.col("count") > BLOCK) & (F.size("pivots") >= SHARED)
    seconds = F.when(crowded, F.filter("pivots", lambda p: p > F.col("pivot"))).otherwise(F.array(F.lit(-1)))
    split = counted.withColumn("second", F.explode(seconds)).drop("count")
    long = split.groupBy(*key).count().where(F.col("count") > 1).select(*key, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("block", o).alias("i"), F.greatest("block", o).alias("j")))
    spread = split.join(long, key).withColumn("block", block).select(*key, "node", "vector", "copies", "pivots", "block", F.inline(pairs))

    def compare(names: tuple, group: pd.DataFrame) -> pd.DataFrame:
        _, _, pivot, second, i, j = names
        group = group.sort_values("node", ignore_index=True)
        one = np.flatnonzero(group["block"] == i) if i != j else np.arange(len(group))
        two = np.flatnonzero(group["block"] == j) if i != j else one
        vectors = np.array([np.frombuffer(v) for v in group["vector"]])
        lists = np.array([np.array(p, np.int64) for p in group["pivots"]])
        copies = group["copies"].to_numpy()
        adjacent = linked(vectors[one], vectors[two], lists[one], lists[two], pivot, second, cosine)
        links = np.zeros(len(group), np.int64)
        if i == j:
            np.fill_diagonal(adjacent, False)
            links += adjacent @ copies
            whole = adjacent
        else:
            links[one] += adjacent @ copies[two]
            links[two] += copies[one] @ adjacent
            whole = np.zeros((len(group), len(group)), bool)
            whole[np.ix_(one, two)] = adjacent
            whole |= whole.T
        nodes = group["node"].to_numpy()
        has = links > 0
        return pd.DataFrame({"node": nodes[has], "root": nodes[_roots(whole)][has], "links": links[has]})

    found = spread.groupBy(*key, "i", "j").applyInPandas(compare, "node string, root string, links long").checkpoint()
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found, "node", "root")
    named = distinct.join(links, "node", "left").join(roots, "node", "left").select("node", "label", "vector", "least", "copies", "links", F.coalesce("root", "node").alias("root"))
    named = with_smallest(named, "root", "node", "least", "component")
    known = named.select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component")
    # Seven bytes are no vector: a null would send all rows that link with nothing to one task.
    spread_out = F.coalesce("vector", F.substring(F.md5(F.coalesce(F.col("id").cast("string"), F.lit(""))), 1, 7).cast("binary"))
    rows = packed.withColumn("vector", spread_out).join(known, ["label", "vector"], "left")
    component = F.coalesce("component", "id")
    return rows.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links of every vector; nulls, repeats and empty tables as in `near_duplicates`."""
    return near_duplicates(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
