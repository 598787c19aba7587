"""Language ID: a document as a mixture of languages, inferred by expectation-maximisation."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topictables.llm.common import each_batch, remainder, table

#: About so many labelled rows of each language are fitted on at most, by the hash of their id; so many
#: languages, those with the most rows, are learned at most.
SAMPLE, LANGUAGES = 2000, 256
#: Character n-grams of words with their ends marked, by length, hashed into so many buckets.
GRAMS, BUCKETS = (1, 2, 3, 4), 1 << 16
ADDED = 0.05
#: Rounds of expectation-maximisation, and the weight of the languages' shares in the sample, in words.
ROUNDS, PRIOR = 12, 0.5
#: A language is a candidate from this share on; each one more must gain this much log likelihood for
#: each unit of the logarithm of the number of words.
CANDIDATE, PENALTY = 0.02, 2.0
UNKNOWN = "und"

WORD = re.compile(r"[^\W\d_]+")


def grams(some: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where each word begins in the letters of all of them, ends marked; and for each length of n-gram
    the bucket of the one that begins at each letter, BUCKETS where the word ends before it."""
    marked = [f"<{w}>" for w in some]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    letters = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    left = np.repeat(starts + lengths, lengths) - np.arange(len(letters))
    found = []
    for n in GRAMS:
        total = np.full(len(letters), n, np.uint64)
        for j in range(n):
            total[: len(letters) - j] += letters[j:]
            total *= np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
        bucket = (total % np.uint64(BUCKETS)).astype(np.int32)
        bucket[left < n] = BUCKETS
        found.append(bucket)
    return starts, found


def words(text: str | None) -> list[str]:
    """Runs of letters, in lower case; numbers, whatever they look like, are no letters."""
    found = WORD.findall((text or "").lower())
    if all(map(str.isalpha, found)):
        return found
    return [part for w in found for part in "".join(c if c.isalpha() else " " for c in w).split()]


@dataclass
class Mixture:
    """languages and, for each, log probabilities of the buckets; prior: their shares in the sample."""

    languages: list[str]
    logs: np.ndarray
    prior: np.ndarray
    rows: dict[str, int] = field(default_factory=dict)
    likelihoods: np.ndarray | None = None

    LIMIT = 300_000

    def __getstate__(self):
        return {"languages": self.languages, "logs": self.logs, "prior": self.prior, "rows": {}, "likelihoods": None}

    def lookup(self, some: list[str]) -> np.ndarray:
        """Likelihood of each word in each language, with the best of them at 1."""
        new = [w for w in dict.fromkeys(some) if w not in self.rows]
        if self.likelihoods is None or len(self.rows) + len(new) > self.LIMIT:
            new = list(dict.fromkeys(some))
            self.rows, self.likelihoods = {}, np.zeros((max(self.LIMIT, len(new)), len(self.languages)), np.float32)
        if new:
            first = len(self.rows)
            self.rows.update(zip(new, range(first, first + len(new)), strict=True))
            starts, found = grams(new)
            padded = np.hstack([self.logs, np.zeros((len(self.languages), 1))])
            for lang, logs in enumerate(padded):
                self.likelihoods[first : first + len(new), lang] = sum(np.add.reduceat(logs[bucket], starts) for bucket in found)
            part = self.likelihoods[first : first + len(new)]
            np.exp(part - part.max(1, keepdims=True), out=part)
        return self.likelihoods[np.fromiter(map(self.rows.__getitem__, some), np.int64, len(some))].astype(float)

    def infer(self, text: str | None) -> list[tuple[str, float]]:
        return self.infer_all([text])[0]

    def infer_all(self, texts: list[str | None]) -> list[list[tuple[str, float]]]:
        """For each text its languages with their shares of the words, the largest first; none without a letter."""
        counters = [Counter(words(t)) for t in texts]
        sizes = np.array([len(c) for c in counters])
        if not self.languages or not sizes.sum():
            return [[] for _ in texts]
        like = self.lookup([w for c in counters for w in c])
        times = np.fromiter((n for c in counters for n in c.values()), float, len(like))
        filled = np.flatnonzero(sizes)
        starts = np.r_[0, np.cumsum(sizes[filled])[:-1]]
        owner = np.repeat(np.arange(len(filled)), sizes[filled])
        totals = np.add.reduceat(times, starts)
        shares = np.tile(self.prior, (len(filled), 1))
        for _ in range(ROUNDS):
            mixed = like * shares[owner]
            mixed *= (times / mixed.sum(1))[:, None]
            shares = np.add.reduceat(mixed, starts) + PRIOR * self.prior
            shares /= (totals + PRIOR)[:, None]
        result: list[list[tuple[str, float]]] = [[] for _ in texts]
        for k, row in enumerate(filled):
            part = slice(starts[k], starts[k] + sizes[row])
            chosen = self._select(like[part], times[part], shares[k])
            result[row] = sorted(((self.languages[i], float(s)) for i, s in chosen), key=lambda x: (-x[1], x[0]))
        return result

    def _fit(self, like: np.ndarray, times: np.ndarray, some: list[int]) -> tuple[float, np.ndarray]:
        """Log likelihood and shares of a set of languages."""
        prior = self.prior[some] / self.prior[some].sum()
        part, shares = like[:, some] + 1e-30, prior
        for _ in range(ROUNDS if len(some) > 1 else 0):
            mixed = part * shares
            shares = ((mixed * (times / mixed.sum(1))[:, None]).sum(0) + PRIOR * prior) / (times.sum() + PRIOR)
        return float((times * np.log((part * shares).sum(1))).sum() + PRIOR * (prior * np.log(shares)).sum()), shares

    def _select(self, like: np.ndarray, times: np.ndarray, shares: np.ndarray) -> list[tuple[int, float]]:
        """Grows the set of languages as long as the penalised likelihood does."""
        candidates = [i for i in np.argsort(-shares, kind="stable").tolist() if shares[i] >= CANDIDATE]
        if len(candidates) <= 1:
            return [(candidates[0], 1.0)] if candidates else [(int(shares.argmax()), 1.0)]
        fits = {(i,): self._fit(like, times, [i]) for i in candidates}
        best = max(fits, key=lambda s: fits[s][0])
        value, of = fits[best]
        while len(best) < len(candidates):
            more = {(*best, i): self._fit(like, times, [*best, i]) for i in candidates if i not in best}
            new = max(more, key=lambda s: more[s][0])
            if more[new][0] - value <= PENALTY * np.log(times.sum() + 1):
                break
            best, (value, of) = new, more[new]
        return list(zip(best, of.tolist(), strict=True))


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", sample: int = SAMPLE, most: int = LANGUAGES) -> Mixture:
    """Fit on a bounded sample: of each language about `sample` rows at most, chosen by the hash of the
    id, and of languages the `most` with the most rows, of equal ones the first in order; a column that
    holds more values than there are languages teaches no more than these. Null languages, texts and
    ids are left out. The counts come to the driver by language and bucket, both bounded."""
    known = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang")).where("id is not null and text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most).collect()}
    if not sizes:
        return Mixture([], np.zeros((0, BUCKETS)), np.zeros(0))
    wanted = F.create_map(*(x for lang, n in sorted(sizes.items()) for x in (F.lit(lang), F.lit(int(min(1.0, sample / n) * 0x1000000)))))
    taken = known.where(F.xxhash64(F.lit("fit"), "id").bitwiseAND(F.lit(0xFFFFFF).cast("long")) < wanted[F.col("lang")])

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
            counts = Counter(words(text))
            if counts:
                starts, found = grams(list(counts))
                times = np.repeat(list(counts.values()), np.diff(np.r_[starts, len(found[0])]))
                total += sum(np.bincount(bucket, times, BUCKETS + 1)[:BUCKETS].astype(np.int64) for bucket in found)
        for lang, total in totals.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(total[some])], ["lang", "bucket", "n"])

    counted = each_batch(taken.select("lang", "text"), count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sizes)
    counts = np.full((len(languages), BUCKETS), ADDED)
    counts[np.searchsorted(languages, counted["lang"].to_numpy(str)), counted["bucket"]] += counted["n"]
    prior = np.array([sizes[lang] for lang in languages], float)
    return Mixture(languages, np.log(counts / counts.sum(1, keepdims=True)), prior / prior.sum())


def identify(docs: DataFrame, model: Mixture, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, lang_pred, score, languages, shares) of every row.

    Each word is drawn from one language, with its probability as a product over its n-grams; the
    shares of the languages of a whole text are estimated by expectation-maximisation, and the set of
    languages grows while the likelihood gains more than the penalty. lang_pred has the largest share,
    which is the score; of equal ones the first in order. Null texts, texts without a letter, and any
    text if nothing was learned: `und`, score 0 and no languages. Ids may be null or repeat.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            found = shared.value.infer_all(part.column(1).to_pylist())
            first = [f[0] if f else (UNKNOWN, 0.0) for f in found]
            columns = [pa.array([f[0] for f in first], pa.string()), pa.array([min(1.0, f[1]) for f in first], pa.float64())]
            columns += [pa.array([[x[k] for x in f] for f in found], pa.list_(kind)) for k, kind in ((0, pa.string()), (1, pa.float64()))]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["id", "lang_pred", "score", "languages", "shares"])

    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return each_batch(source, compute, f"id {source.schema['id'].dataType.simpleString()}, lang_pred string, score double, languages array<string>, shares array<double>")


def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; null texts and a null id, which is not held out, as in `identify`."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(remainder(F.col("doc_id"), 5) != 0))
    held_out = F.coalesce(remainder(F.col("id"), 5) == 0, F.lit(False))
    return identify(docs, model).select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score", "languages", "shares")
