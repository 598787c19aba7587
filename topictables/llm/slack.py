"""Best-fit packing of whole documents: minimum bin slack by bitset subset sums."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from topictables.llm.common import stored, table
from topictables.llm.packing import encoded, tokenizer_path

#: Tokens of a sequence, and the id that ends a document.
TOKENS, END = 2048, 0

#: The lengths of a sequence, longest first, each with how many pieces have it.
Combination = list[tuple[int, int]]


def fullest(available: np.ndarray, room: int) -> Combination:
    """Of available[n] pieces of each length n, a combination with the largest sum up to `room`.

    Bit s of `sums` says that a sum s is possible. Longer pieces come first and the search ends with
    the first one that fills the room, so short pieces are kept for sequences that need them.
    """
    everything = (1 << (room + 1)) - 1
    sums, before = 1, []
    for n in np.flatnonzero(available[: room + 1])[::-1].tolist():
        before.append((n, sums))
        left, times = min(int(available[n]), room // n), 1
        while left:
            sums |= sums << (n * min(times, left)) & everything
            left -= min(times, left)
            times *= 2
        if sums >> room & 1:
            break
    at, chosen = sums.bit_length() - 1, []
    for n, possible in reversed(before):
        times = 0
        while not possible >> at & 1:
            at -= n
            times += 1
        if times:
            chosen.append((n, times))
    return chosen[::-1]


def minimum_slack(counts: dict[int, int], tokens: int = TOKENS) -> list[tuple[Combination, int]]:
    """Combinations, each with the number of sequences that it fills one after another, until no piece is
    left. A sequence starts with the longest piece and takes the fullest combination for the rest; that
    stays the fullest as long as its pieces last, so it is taken so many times at once. The number of
    combinations depends on `tokens` only, not on the number of pieces."""
    available = np.zeros(tokens + 1, np.int64)
    for length, n in counts.items():
        available[length] = n
    found = []
    while available.any():
        longest = int(np.flatnonzero(available)[-1])
        available[longest] -= 1
        rest = dict(fullest(available, tokens - longest))
        available[longest] += 1
        rest[longest] = rest.get(longest, 0) + 1
        combination = sorted(rest.items(), reverse=True)
        times = min(int(available[n]) // k for n, k in combination)
        for n, k in combination:
            available[n] -= k * times
        found.append((combination, times))
    return found


class Placement:
    """Where the pieces of each length, numbered from 0, go."""

    def __init__(self, combinations: list[tuple[Combination, int]]):
        taken: dict[int, int] = {}
        rows, first = [], 0
        for combination, times in combinations:
            offset = 0
            for n, k in combination:
                rows.append((n, taken.get(n, 0), first, k, offset))
                taken[n] = taken.get(n, 0) + k * times
                offset += n * k
            first += times
        rows.sort()
        self.length, self.start, self.sequence, self.each, self.offset = np.array(rows, np.int64).reshape(-1, 5).T
        # Sorts as (length, number): numbers are below the sum of all, which is the largest start and more.
        self.span = max(taken.values(), default=0) + 1
        self.keys = self.length * self.span + self.start

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces with these lengths and numbers."""
        row = np.searchsorted(self.keys, length * self.span + number, "right") - 1
        within = number - self.start[row]
        return self.sequence[row] + within // self.each[row], self.offset[row] + within % self.each[row] * length


def pieces(df: DataFrame, id_column: str, text_column: str, path: str, tokens: int, end: int) -> DataFrame:
    """(task, id, piece, start, length, ids_crc32, place) of every document's pieces; place counts the
    pieces of that length in the task that cut them."""
    source = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    names = ["id", "task", "piece", "start", "length", "ids_crc32", "place"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen, kind, rows = TaskContext.get().partitionId(), [0] * (tokens + 1), None, []

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch.column(0).type
                yield batch

        def batch() -> pa.RecordBatch:
            types = [kind, pa.int32(), pa.int32(), *[pa.int64()] * 4]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for key, ids in encoded(typed(), path):
            blob = ids + end.to_bytes(4, "little")
            total = len(blob) // 4
            for piece, start in enumerate(range(0, total, tokens)):
                n = min(tokens, total - start)
                rows.append((key, task, piece, start, n, zlib.crc32(blob[start * 4 : (start + n) * 4]), seen[n]))
                seen[n] += 1
            if len(rows) >= 10_000:
                yield batch()
        if rows:
            yield batch()

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(cut, f"id {kind}, task int, piece int, start long, length long, ids_crc32 long, place long")


def pack_whole(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None, tokens: int = TOKENS, end: int = END) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    A document is the ids of its text and `end`; only one of more than `tokens` is cut, into pieces of
    that length and a last one. Each task counts its pieces by length. The counts by length over all
    tasks, at most `tokens` numbers however many documents there are, are all that minimum bin slack
    needs; its combinations are sent to the tasks, which number the pieces of a length from the counts
    of the tasks before them. So all documents are packed as one, and no task or driver sees them all.

    A null text is empty, an empty one `end` alone. Repeated rows and null ids are packed row by row;
    other columns are ignored; an empty table gives no rows.
    """
    spark = df.sparkSession
    cut = stored(pieces(df, id_column, text_column, path or tokenizer_path(), tokens, end))
    counts = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    placement = spark.sparkContext.broadcast(Placement(minimum_slack(total, tokens)))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = cut.join(before, ["task", "length"]).select("id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("number"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = placement.value.find(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])

    kind = cut.schema["id"].dataType.simpleString()
    return numbered.mapInArrow(place, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens; nulls, repeats and empty tables as in `pack_whole`."""
    return pack_whole(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
