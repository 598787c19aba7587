"""Toxicity: a factorization machine over hashed terms."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topictables.llm.common import alone, each_batch, remainder, table

#: About so many labelled rows are fitted on at most; they are taken by the hash of their id.
SAMPLE = 12_000
#: A term becomes a feature if it occurs in so many rows of the sample, and so many standard deviations
#: more or less often in toxic ones than by chance; of more than MOST such terms the strongest are taken.
LEAST_ROWS, DEVIATIONS, MOST = 2, 3.5, 50_000
#: Pairs are looked for among these and the terms in so many rows of the sample and such a share of it,
#: the most frequent PAIRABLE of both at most. A pair counts if chance gives as much among all pairs that are
#: looked at with probability CHANCE at most; of more than MOST_PAIRED terms in such pairs the strongest are taken.
FREQUENT_ROWS, FREQUENT_SHARE, PAIRABLE, CHANCE, MOST_PAIRED = 5, 0.01, 8192, 0.05, 2000
#: Terms, a multiple of 8, of which the pairs are counted at a time, in so many rows; entries of rows that
#: the descent looks at together; texts that are hashed or scored together.
PAIR_BLOCK, ROW_BLOCK, ENTRIES, TEXTS = 1024, 2048, 200_000, 500
FACTORS, STEPS, PAIR_DECAY = 8, 300, 1e-4
#: From this score on a text counts as toxic.
TOXIC = 0.7

WORD = re.compile(r"[^\W_]+")


class Terms(dict):
    """White-space separated word -> hashes of its terms, emptied when it has grown large."""

    LIMIT = 200_000

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        found: list[int] = []
        for word in WORD.findall(chunk):
            names = {f"={word}", word[:4], word[:5]} if len(word) > 4 else {f"={word}"}
            found += (xxhash.xxh32_intdigest(name) for name in sorted(names))
        value = self[chunk] = tuple(found)
        return value


TERMS = Terms()


def terms(text: str | None) -> np.ndarray:
    """Sorted distinct 32-bit hashes of the words of a text and of their first 4 and 5 letters."""
    alone(TERMS)
    chunks = set((text or "").lower().split())
    return np.unique(np.fromiter((t for c in chunks for t in TERMS[c]), np.uint32))


@dataclass
class Machine:
    """score = sigmoid(bias + sum of w[i] x[i] + sum over pairs of <v[i], v[j]>) over the terms of a text,
    where x is the value of a term."""

    names: np.ndarray
    values: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def logits(self, rows: np.ndarray, columns: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        return machine_logits(self.bias, self.weights, self.factors, rows, columns, x, n, np.ones(len(x)))[0]

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities of whole texts; those without a known term, empty ones too, share the bias."""
        rows, columns = [], []
        for row, text in enumerate(texts):
            if len(self.names):
                found = terms(text)
                at = np.minimum(np.searchsorted(self.names, found), len(self.names) - 1)
                at = at[self.names[at] == found]
                columns.append(at)
                rows.append(np.full(len(at), row))
        columns, rows = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (columns, rows))
        return sigmoid(self.logits(rows, columns, self.values[columns], len(texts)))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def machine_logits(bias, weights, factors, rows, columns, x, n, present=None):
    """Logits of n rows in sparse form, whose numbers ascend, and the sums that the gradient needs. The
    pairwise sum takes `present` for x where it is given."""
    parts = factors[columns] * (x if present is None else present)[:, None]
    sums = np.zeros((n, factors.shape[1]))
    squares = np.zeros(n)
    if len(rows):
        starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        sums[rows[starts]] = np.add.reduceat(parts, starts, axis=0)
        squares[rows[starts]] = np.add.reduceat((parts**2).sum(1), starts)
    linear = np.bincount(rows, weights[columns] * x, n)
    return bias + linear + 0.5 * ((sums**2).sum(1) - squares), sums, parts


def term_counts(found: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, rows that hold it, toxic ones among them), by term."""
    none = np.zeros(0, np.uint32)
    names, rows = np.unique(np.concatenate([none, *found]), return_counts=True)
    toxic_names, n = np.unique(np.concatenate([none, *(f for f, label in zip(found, y, strict=True) if label)]), return_counts=True)
    toxic = np.zeros(len(names))
    toxic[np.searchsorted(names, toxic_names)] = n
    return names, rows, toxic


def term_values(found: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(term, value) of the features: the smoothed log ratio of the toxic share among the rows that
    hold a term to that among all."""
    share = np.clip(y.mean() if len(y) else 0, 1e-6, 1 - 1e-6)
    names, rows, toxic = term_counts(found, y)
    some = rows >= LEAST_ROWS
    names, rows, toxic = names[some], rows[some], toxic[some]
    z = (toxic - rows * share) / np.sqrt(rows * share * (1 - share))
    strong = np.abs(z) >= DEVIATIONS
    if strong.sum() > MOST:
        strong &= np.abs(z) >= np.sort(np.abs(z[strong]))[-MOST]
    value = np.log((toxic + 5 * share) / (rows + 5) / share)
    return names[strong], np.clip(value[strong], -3, 3)


def presence(found: list[np.ndarray], names: np.ndarray) -> np.ndarray:
    """Which row holds which of the names, a bit each."""
    held = np.zeros((len(found), -(-len(names) // 8)), np.uint8)
    for i, f in enumerate(found):
        row = np.zeros(len(names), bool)
        row[np.intersect1d(names, f, assume_unique=True, return_indices=True)[1]] = True
        held[i] = np.packbits(row)
    return held


def pair_terms(found: list[np.ndarray], y: np.ndarray, expected: np.ndarray, strong: np.ndarray) -> np.ndarray:
    """The terms of the pairs that are toxic together more or less often than these expected shares of
    the rows say, however neutral each is alone. By chance, O toxic of N rows where P are expected have at most
    the probability exp(-O log(O / P) - (N - O) log((N - O) / (N - P))) (Hoeffding's bound), which is held
    against the number of pairs. Presence is kept as bits and taken out in blocks of rows and terms."""
    names, counts, _ = term_counts(found, y)
    able = np.flatnonzero((counts >= max(FREQUENT_ROWS, FREQUENT_SHARE * len(y))) | np.isin(names, strong) & (counts >= FREQUENT_ROWS))
    able = np.sort(able[np.argsort(-counts[able], kind="stable")[:PAIRABLE]])
    names = names[able]
    if len(names) < 2:
        return names[:0]
    toxic_first = np.argsort(-y, kind="stable")
    held = presence([found[i] for i in toxic_first], names)
    chance = expected[toxic_first].astype(np.float32)[:, None]
    toxic_rows = int(y.sum())
    bound = np.log(len(names) * (len(names) - 1) / 2 / CHANCE)
    strength = np.zeros(len(names))

    def block(first: int, last: int, a: int) -> np.ndarray:
        bits = held[first:last, a // 8 : (a + PAIR_BLOCK) // 8]
        return np.unpackbits(bits, axis=1, count=min(PAIR_BLOCK, len(names) - a)).astype(np.float32)

    # Blocks of rows end where the toxic ones do.
    cuts = [*range(0, toxic_rows, ROW_BLOCK), *range(toxic_rows, len(y), ROW_BLOCK), len(y)]
    for a in range(0, len(names), PAIR_BLOCK):
        for b in range(a, len(names), PAIR_BLOCK):
            shape = min(PAIR_BLOCK, len(names) - a), min(PAIR_BLOCK, len(names) - b)
            o, clean, p = (np.zeros(shape, np.float32) for _ in range(3))
            for first, last in zip(cuts[:-1], cuts[1:], strict=True):
                left, right = block(first, last, a), block(first, last, b)
                both = o if first < toxic_rows else clean
                both += left.T @ right
                left *= chance[first:last]
                p += left.T @ right
            n = o + clean
            p = np.clip(p, 1e-6, np.maximum(n - 1e-6, 1e-6))
            unlikely = np.maximum(n - p, 1e-6)
            against = o * np.log(np.maximum(o, 1e-6) / p) + clean * np.log(np.maximum(clean, 1e-6) / unlikely)
            if a == b:
                np.fill_diagonal(against, 0)
            for start, axis in ((a, 1), (b, 0)):
                most = against.max(axis)
                strength[start : start + len(most)] = np.maximum(strength[start : start + len(most)], most)
    paired = np.flatnonzero(strength >= bound)
    return np.sort(names[paired[np.argsort(-strength[paired], kind="stable")[:MOST_PAIRED]]])


@dataclass
class Entries:
    """Terms of rows in sparse form: of row i those from starts[i] to starts[i + 1]."""

    starts: np.ndarray
    columns: np.ndarray
    x: np.ndarray

    @classmethod
    def of(cls, columns: list[np.ndarray], x: list[np.ndarray]) -> Entries:
        none = [np.zeros(0)]
        starts = np.cumsum([0, *map(len, columns)])
        return cls(starts, np.concatenate(none + columns).astype(np.int32), np.concatenate(none + x).astype(np.float32))

    def blocks(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, row within them, column, x) of about ENTRIES entries at a time."""
        first = 0
        while first < len(self.starts) - 1:
            last = max(first + 1, int(np.searchsorted(self.starts, self.starts[first] + ENTRIES, "right")) - 1)
            part = slice(self.starts[first], self.starts[last])
            within = np.repeat(np.arange(last - first), np.diff(self.starts[first : last + 1]))
            yield slice(first, last), within, self.columns[part].astype(np.int64), self.x[part].astype(float)
            first = last


def descend(y: np.ndarray, bias: float, n: int, entries: Entries, pairs: bool) -> list[np.ndarray]:
    """(bias, weights, factors) of n terms after STEPS steps; without `pairs` the factors are zero."""
    start = np.random.default_rng(7).normal(0, 0.02, (n, FACTORS)) if pairs else np.zeros((n, FACTORS))
    values_of = [np.array([bias]), np.zeros(n), start]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in values_of]
    for step in range(1, STEPS + 1):
        bias, weights, factors = values_of
        gradients = [np.zeros(1), 1e-5 * weights, PAIR_DECAY * factors]
        for rows, at, columns, x in entries.blocks():
            if pairs:
                logits, sums, parts = machine_logits(bias[0], weights, factors, at, columns, x, rows.stop - rows.start, np.ones(len(x)))
            else:
                logits = bias[0] + np.bincount(at, weights[columns] * x, rows.stop - rows.start)
            error = (sigmoid(logits) - y[rows]) / len(y)
            gradients[0] += error.sum()
            gradients[1] += np.bincount(columns, error[at] * x, n)
            if pairs:
                slope = error[at][:, None] * (sums[at] - parts)
                for f in range(FACTORS):
                    gradients[2][:, f] += np.bincount(columns, slope[:, f], n)
        for p, g, (m, s) in zip(values_of, gradients, moments, strict=True):
            m *= 0.9
            m += 0.1 * g
            s *= 0.999
            s += 0.001 * g**2
            p -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return values_of


def fit(found: list[np.ndarray], y: np.ndarray) -> Machine:
    """A machine for rows with these terms and labels 0 or 1. The values of a row's features come
    from the other half of the rows, so that a term which is rare in both is worth nothing. Terms that
    tell only in pairs join them with the value 1, and the pairwise sum is over presence. Without
    rows, or with one label only, every score is the share of toxic rows (0 without rows)."""
    y = np.asarray(y, float)
    names, values = term_values(found, y)
    share = float(np.clip(y.mean() if len(y) else 0, 1e-6, 1 - 1e-6))
    bias = float(np.log(share / (1 - share)))
    if not 0 < y.sum() < len(y):
        return Machine(names, values, bias, np.zeros(len(names)), np.zeros((len(names), FACTORS)))
    columns: list[np.ndarray] = [np.zeros(0, np.int64)] * len(y)
    x = [np.zeros(0)] * len(y)
    half = np.random.default_rng(3).permutation(len(y)) % 2
    for side in (0, 1):
        others = np.flatnonzero(half != side)
        known, worth = term_values([found[i] for i in others], y[others])
        common, mine, theirs = np.intersect1d(names, known, return_indices=True)
        for i in np.flatnonzero(half == side):
            _, at, _ = np.intersect1d(common, found[i], return_indices=True)
            columns[i], x[i] = mine[at], worth[theirs[at]]
    entries = Entries.of(columns, x)
    alone_bias, alone_weights, _ = descend(y, bias, len(names), entries, False)
    expected = np.concatenate([sigmoid(alone_bias[0] + np.bincount(at, alone_weights[c] * v, rows.stop - rows.start)) for rows, at, c, v in entries.blocks()])
    paired = pair_terms(found, y, expected, names)
    every = np.union1d(names, paired)
    moved = np.searchsorted(every, names)
    worth_alone = np.isin(every, names)
    for i, f in enumerate(found):
        # A strong term of a pair is present in all its rows, also where the other half gives it no value.
        known = moved[columns[i]]
        more = np.setdiff1d(np.searchsorted(every, np.intersect1d(paired, f, assume_unique=True)), known)
        columns[i], x[i] = np.concatenate([known, more]), np.concatenate([x[i], ~worth_alone[more]])
    every_value = np.ones(len(every))
    every_value[moved] = values
    final_bias, weights, factors = descend(y, bias, len(every), Entries.of(columns, x), True)
    return Machine(every, every_value, float(final_bias[0]), weights, factors)


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", sample: int = SAMPLE) -> Machine:
    """Fit on about `sample` labelled rows at most, chosen by the hash of the id, which may be of any type;
    rows of one id that repeat are cut at twice that. Null labels and ids are left out; an id with
    several labels is toxic if one of them says so. Only the machine (at most MOST terms and
    MOST_PAIRED) comes to the driver; the ids that are broadcast are as many as the sample."""
    known = labels.where(F.col(id_column).isNotNull() & F.col(label_column).isNotNull()).select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("y"))
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    share = min(1.0, sample / max(1, known.count()))
    taken = known.where((F.xxhash64(F.lit("fit"), "id").bitwiseAND(F.lit(0xFFFFFF).cast("long"))) < int(share * 0x1000000))
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def hashed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        blobs = [terms(t).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], ["y", "terms"])

    rows = each_batch(texts.join(F.broadcast(taken), "id").select("y", "text"), hashed, "y int, terms binary", TEXTS)

    def fitted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = sorted((y, blob) for part in parts for y, blob in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True))
        m = fit([np.frombuffer(t, np.uint32) for _, t in every], np.array([y for y, _ in every], float))
        columns = [m.names.tobytes(), m.values.tobytes(), m.bias, m.weights.tobytes(), m.factors.tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in columns], ["names", "values", "bias", "weights", "factors"])

    r = rows.limit(2 * sample).repartition(1).mapInArrow(fitted, "names binary, values binary, bias double, weights binary, factors binary").first()
    if r is None:
        return fit([], np.zeros(0))
    read = lambda blob, kind: np.frombuffer(bytes(blob), kind)
    return Machine(read(r["names"], np.uint32), read(r["values"], float), r["bias"], read(r["weights"], float), read(r["factors"], float).reshape(-1, FACTORS))


def scores(docs: DataFrame, machine: Machine, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, score, predicted) of every row; null text counts as empty, ids may be null or repeat."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def compute(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        score = shared.value.score(batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= TOXIC).astype(np.int32))], ["id", "score", "predicted"])

    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return each_batch(source, compute, f"id {source.schema['id'].dataType.simpleString()}, score double, predicted int", TEXTS)


def without_toxic(docs: DataFrame, machine: Machine, text_column: str = "text") -> DataFrame:
    """The rows, all columns, that score below the threshold. Null and empty texts share one score, that of
    a text without known terms; null ids and repeated rows are judged like any other; an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    at = docs.columns.index(text_column)

    def compute(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.filter(pa.array(shared.value.score(batch.column(at).to_pylist()) < TOXIC))

    return each_batch(docs, compute, docs.schema, TEXTS)


def trained(spark: SparkSession, sf_dir: str) -> Machine:
    labels = table(spark, sf_dir, "labels")
    return train(table(spark, sf_dir, "documents"), labels.where(remainder(F.col("doc_id"), 3) != 1))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document; null texts count as empty, a null id is not held out."""
    docs = table(spark, sf_dir, "documents")
    found = scores(docs, trained(spark, sf_dir))
    held_out = F.coalesce(remainder(F.col("id"), 3) == 1, F.lit(False))
    return found.select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "score", "predicted")
