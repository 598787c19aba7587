"""Ranked lexical search: the short lists of a query are summed into accumulators, which then are one
bounded iterator beside the long lists, document at a time."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from topictables.llm.common import each_batch, stored, table

TOP = 20
#: Characters of queries that are answered at a time and broadcast; more queries take more passes.
BLOCK_CHARS = 5_000_000
#: Documents of a part of the index that is inverted and searched at a time.
PART_DOCS = 50_000
#: Lists of a part of up to so many documents are short.
SHORT = 1000
#: Documents of the first range that is looked at; each further one is twice as wide.
RANGE = 1024

#: A to Z become lower-case; all other ASCII but digits and letters separates terms.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text; null has none."""
    return (text or "").encode().translate(FOLD).split()


@dataclass
class Queries:
    """A block of queries: ids, the known terms of each with their repeats, and the term -> number."""

    ids: list
    lists: list[list[tuple[int, int]]]
    numbers: dict[bytes, int]

    @classmethod
    def of(cls, ids: list, texts: list[str | None]) -> Queries:
        numbers: dict[bytes, int] = {}
        lists = [[(numbers.setdefault(t, len(numbers)), n) for t, n in Counter(terms(text)).items()] for text in texts]
        return cls(ids, lists, numbers)


class Lists:
    """The inverted lists of a part of the documents, whose numbers ascend with their ids. A posting
    holds what its term adds to the score of its document."""

    def __init__(self, ids: list, n: np.ndarray, of: np.ndarray, term: np.ndarray, tf: np.ndarray, weights: np.ndarray, total: int, length: int):
        order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i])), np.int64)
        self.ids = [ids[i] for i in order]
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        m = 75 + 25 * n * total // max(length, 1)
        adds = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[of]))
        docs = place[of]
        by_term = np.lexsort((docs, term))
        self.docs, self.adds = docs[by_term], adds[by_term]
        self.starts = np.searchsorted(term[by_term], np.arange(len(weights) + 1))
        filled = np.flatnonzero(np.diff(self.starts))
        self.most = np.zeros(len(weights), np.int64)
        if len(filled):
            self.most[filled] = np.maximum.reduceat(self.adds, self.starts[filled])

    def __getitem__(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.starts[number], self.starts[number + 1])
        return self.docs[part], self.adds[part]


def accumulators(lists: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: the documents of (documents, adds, times) lists, ascending, and their sums."""
    if not lists:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    docs = np.concatenate([d for d, _, _ in lists])
    adds = np.concatenate([a * times for _, a, times in lists])
    order = np.argsort(docs, kind="stable")
    docs = docs[order]
    starts = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
    return docs[starts], np.add.reduceat(adds[order], starts)


def looked_up(docs: np.ndarray, adds: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """What a list adds to these documents; it is skipped through by bisection."""
    at = np.minimum(np.searchsorted(docs, wanted), len(docs) - 1)
    return np.where(docs[at] == wanted, adds[at], 0)


def search(part: Lists, query: list[tuple[int, int]], top: int, least: int = 1, short: int = SHORT, width: int = RANGE) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of a part that score `least` or more, the `top` best of them, best first and
    equal scores by document.

    The iterators are the accumulators of the short lists and each long list, in the order of the most
    that they can add. Those that together stay below the threshold are only looked up, for documents
    of the others that can still reach it; so the longest lists are skipped through.
    """
    lists = [(*part[t], times) for t, times in query if part.starts[t] < part.starts[t + 1]]
    docs, sums = accumulators([x for x in lists if len(x[0]) <= short])
    iterators = [(int(a.max()) * times, d, a, times) for d, a, times in lists if len(d) > short]
    if len(docs):
        iterators.append((int(sums.max()), docs, sums, 1))
    iterators.sort(key=lambda x: x[0])
    bounds = np.cumsum([0, *(x[0] for x in iterators)])
    best, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(docs) >= top:  # the best accumulators, completed, give a first threshold
        first = np.sort(docs[np.argpartition(-sums, top - 1)[:top]])
        least = max(least, int(sum(looked_up(d, a, first) * times for _, d, a, times in iterators).min()))
    low = 0
    while low < len(part.ids) and bounds[-1] >= least:
        high = min(low + width, len(part.ids))
        width *= 2
        passive = int(np.searchsorted(bounds, least)) - 1  # so many iterators can't reach the threshold
        found = np.zeros(high - low, np.int64)
        for _, d, a, times in iterators[passive:]:
            i, j = np.searchsorted(d, (low, high))
            found[d[i:j] - low] += a[i:j] * times
        alive = np.flatnonzero(found > max(0, least - 1 - bounds[passive]))
        found = found[alive]
        alive += low
        for k in range(passive - 1, -1, -1):
            _, d, a, times = iterators[k]
            found = found + looked_up(d, a, alive) * times
            able = found + bounds[k] >= least
            alive, found = alive[able], found[able]
        best, scores = np.concatenate([best, alive]), np.concatenate([scores, found])
        order = np.lexsort((best, -scores))[:top]
        best, scores = best[order], scores[order]
        if len(best) == top:
            least = max(least, int(scores[-1]))
        low = high
    return best, scores


class Searcher:
    """The best documents of each query among the parts that it has seen."""

    def __init__(self, queries: Queries, weights: np.ndarray, total: int, length: int, top: int, short: int):
        self.queries, self.weights, self.total, self.length, self.top, self.short = queries, weights, total, length, top, short
        self.found: list[list[tuple]] = [[] for _ in queries.ids]

    def add(self, batches: list[pa.RecordBatch]) -> None:
        rows = pa.Table.from_batches(batches).combine_chunks()
        ids, n = rows.column(0).to_pylist(), rows.column(1).to_numpy()
        column = lambda k: rows.column(k).combine_chunks()
        sizes = column(2).value_lengths().to_numpy(zero_copy_only=False)
        term, tf = (column(k).flatten().to_numpy(zero_copy_only=False) for k in (2, 3))
        of = np.repeat(np.arange(len(ids)), sizes)
        part = Lists(ids, n.astype(np.int64), of, term.astype(np.int64), tf.astype(np.int64), self.weights, self.total, self.length)
        for q, query in enumerate(self.queries.lists):
            before = self.found[q]
            least = -before[-1][0] if len(before) == self.top else 1
            docs, scores = search(part, query, self.top, least, self.short)
            new = [(-s, part.ids[d] is None, part.ids[d]) for d, s in zip(docs.tolist(), scores.tolist(), strict=True)]
            if new:
                self.found[q] = sorted(before + new)[: self.top]


def _index(docs: DataFrame, queries: Queries) -> DataFrame:
    """(id, n, terms, tfs) of every document with a term: its length and its terms of the queries."""
    numbers = docs.sparkSession.sparkContext.broadcast(queries.numbers)

    def read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known = numbers.value
        split = [terms(t) for t in batch.column(1).to_pylist()]
        n = np.array([len(s) for s in split], np.int64)
        found = np.fromiter(map(known.get, chain.from_iterable(split), repeat(-1)), np.int64, n.sum())
        of = np.repeat(np.arange(len(n)), n)[found >= 0]
        pairs, tf = np.unique(of * (len(known) + 1) + found[found >= 0], return_counts=True)
        ends = np.searchsorted(pairs, np.arange(len(n) + 1) * (len(known) + 1))
        listed = lambda values: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
        rows = pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), listed(pairs % (len(known) + 1)), listed(tf)], ["id", "n", "terms", "tfs"])
        yield rows.filter(pa.array(n > 0))

    return stored(each_batch(docs, read, f"id {docs.schema['id'].dataType.simpleString()}, n long, terms array<int>, tfs array<int>", 500))


def _blocks(items: DataFrame, block_chars: int) -> Iterator[Queries]:
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = size // block_chars + 1
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).collect()
        part.sort(key=lambda r: (r["id"] is None, r["id"], r["text"] or ""))
        yield Queries.of([r["id"] for r in part], [r["text"] for r in part])


def ranked(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", top: int = TOP, block_chars: int = BLOCK_CHARS, part_docs: int = PART_DOCS, short: int = SHORT) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` best documents of every item, with a score above 0.

    The queries are taken in blocks of bounded size. The documents are read once a block: what stays is
    each one's length and its terms that a query has. Sums over that index give the weights; then its
    parts are inverted and searched where they lie, each with the best of the parts before it in its
    task as threshold, and the best of all tasks are merged by a limited window.

    Null and empty texts have no terms: such documents don't count, such items have no rows. Rows that
    repeat, with the same id too, are documents or items of their own; equal scores are ranked by id,
    null ids last. Other columns are ignored. Without documents or items there are no rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).alias("id"), F.col(doc_text).alias("text"))
    wanted = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text"))
    item_kind, doc_kind = (x.schema["id"].dataType.simpleString() for x in (wanted, source))
    item_type = to_arrow_type(wanted.schema["id"].dataType)
    result = None
    for queries in _blocks(wanted, block_chars):
        index = _index(source, queries)
        total, length = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(queries.numbers), np.int64)
        for r in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[r["term"]] = r["count"]
        weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        shared = spark.sparkContext.broadcast((queries, weights))

        def find(batches: Iterator[pa.RecordBatch], shared=shared, total=total, length=length) -> Iterator[pa.RecordBatch]:
            searcher, held, first = Searcher(*shared.value, total, length, top, short), [], None
            for batch in batches:
                held.append(batch)
                first = batch.column(0).type
                if sum(b.num_rows for b in held) >= part_docs:
                    searcher.add(held)
                    held = []
            if held:
                searcher.add(held)
            for q, rows in enumerate(searcher.found):
                if rows:
                    name = pa.array([shared.value[0].ids[q]] * len(rows), item_type)
                    yield pa.RecordBatch.from_arrays([pa.array([q] * len(rows), pa.int32()), name, pa.array([r[2] for r in rows], first), pa.array([-r[0] for r in rows])], ["query", "item_id", "doc_id", "score"])

        found = index.mapInArrow(find, f"query int, item_id {item_kind}, doc_id {doc_kind}, score long")
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
        result = best if result is None else result.unionByName(best)
    return result


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of each benchmark item; nulls, repeats and empty tables as in `ranked`."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE = f"""
    WITH d AS (SELECT doc_id, {_TERMS} AS words FROM documents),
    s AS (SELECT count(*) AS total, sum(len(words))::BIGINT AS length FROM d WHERE len(words) > 0),
    p AS (SELECT doc_id, term, n, count(*) AS tf FROM (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM d) GROUP BY ALL),
    w AS (SELECT term, floor(1000 * ln((2 * any_value(total) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term),
    q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
    r AS (
        SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * total) // length))))::BIGINT AS score
        FROM q JOIN w USING (term) JOIN p USING (term), s GROUP BY ALL),
    o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM r WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM o WHERE rank <= {TOP}"""
