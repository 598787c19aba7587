"""Benchmark decontamination by spaced-seed hashing."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topictables.llm.common import alone, each_batch, table

#: Seeds: 1 is a token that must agree, 0 a token that may differ. All span SPAN tokens. Together they
#: hit every stretch of 13 to 20 tokens of which SIMILARITY are equal.
MASKS = ("11101011", "11010111", "10111101", "11100111", "10001111", "11101100")
SPAN = 8
#: An overlap counts with so many tokens (or the whole item, if it is shorter) and such a share equal.
LEAST_TOKENS, SIMILARITY = 13, 0.8
#: Characters of benchmark text that are compared at a time and broadcast; a larger benchmark takes more passes.
BLOCK_CHARS = 20_000_000
#: Pairs of a seed's places in documents and items that are held at a time; documents that are read at a time.
PAIRS, ROWS = 1_000_000, 500

WORD = re.compile(r"[^\W_]+")


class WordHashes(dict):
    LIMIT = 500_000

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


HASHES = WordHashes()


def tokens(text: str | None) -> list[str]:
    """Runs of letters and digits, in lower case."""
    return WORD.findall((text or "").lower())


def hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts one after another, and where each text begins and ends."""
    alone(HASHES)
    lists = [tokens(t) for t in texts]
    ends = np.cumsum([0, *map(len, lists)])
    return np.fromiter(map(HASHES.__getitem__, chain.from_iterable(lists)), np.uint64, ends[-1]), ends


def seeds(values: np.ndarray, mask: int) -> np.ndarray:
    """Hash of the masked tokens at each position from which the mask fits."""
    n = max(0, len(values) - SPAN + 1)
    total = np.full(n, mask + 1, np.uint64)
    for j, used in enumerate(MASKS[mask]):
        if used == "1":
            total *= np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
            total += values[j : j + n]
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(32))


def owners(ends: np.ndarray, positions: np.ndarray) -> np.ndarray:
    return np.searchsorted(ends, positions, "right") - 1


def longest_overlap(equal: np.ndarray) -> tuple[int, int]:
    """(start, length) of the longest stretch that begins and ends with an equal token and has a share
    of SIMILARITY or more equal; the first of several. (0, 0) if nothing is equal."""
    at = np.flatnonzero(equal)
    if not len(at):
        return 0, 0
    worth = np.r_[0, np.cumsum(np.where(equal, 1 - SIMILARITY, -SIMILARITY))]
    ends = at + 1
    latest = np.maximum.accumulate(worth[ends][::-1])[::-1]  # the best sum at this end or a later one
    best = (0, 0)
    for start in at:
        j = np.searchsorted(-latest, -(worth[start] - 1e-9), "right") - 1
        if j >= 0 and ends[j] - start > best[1]:
            best = (int(start), int(ends[j] - start))
    return best


class Index:
    """Seeds of a block of benchmark items."""

    def __init__(self, ids: list, texts: list[str | None]):
        self.ids = ids
        self.values, self.ends = hashed(texts)
        keys, places = [], []
        for mask in range(len(MASKS)):
            key = seeds(self.values, mask)
            place = np.arange(len(key))
            item = owners(self.ends, place)
            whole = place + SPAN <= self.ends[item + 1] if len(place) else np.zeros(0, bool)
            keys.append(key[whole])
            places.append(place[whole])
        keys, places = np.concatenate(keys), np.concatenate(places)
        order = np.argsort(keys, kind="stable")
        self.keys, self.places = keys[order], places[order]
        self.bits = max(16, min(26, int(len(keys)).bit_length() + 4))
        self.present = np.zeros(1 << self.bits, bool)
        self.present[self.keys >> np.uint64(64 - self.bits)] = True

    def _diagonals(self, at: np.ndarray, rows: np.ndarray, ends: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[np.ndarray]:
        """The different (row, item, shift) of hits at these places with these ranges of keys, expanded
        for so many hits at a time that about PAIRS pairs, or those of one hit, are held."""
        steps = np.cumsum(last - first)
        for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(steps // PAIRS)) + 1):
            counts = last[part] - first[part]
            within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            places = self.places[np.repeat(first[part], counts) + within]
            items, row = owners(self.ends, places), np.repeat(rows[part], counts)
            shift = np.repeat(at[part], counts) - ends[row] - places + self.ends[items]
            yield np.unique(np.stack([row, items, shift], axis=1), axis=0)

    def overlaps(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int, int]]:
        """(row, item, row's token, item's token, tokens, equal tokens): of each row and item, the longest
        verified overlap, of several the first."""
        values, ends = hashed(texts)
        diagonals = [np.zeros((0, 3), np.int64)]
        for mask in range(len(MASKS)):
            key = seeds(values, mask)
            at = np.flatnonzero(self.present[key >> np.uint64(64 - self.bits)])
            first, last = np.searchsorted(self.keys, key[at], "left"), np.searchsorted(self.keys, key[at], "right")
            rows = owners(ends, at)
            hit = (first < last) & (at + SPAN <= ends[rows + 1])
            diagonals += self._diagonals(at[hit], rows[hit], ends, first[hit], last[hit])
        found = np.unique(np.concatenate(diagonals), axis=0)
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for row, item, shift in found.tolist():
            row_values, item_values = values[ends[row] : ends[row + 1]], self.values[self.ends[item] : self.ends[item + 1]]
            first, last = max(0, -shift), min(len(item_values), len(row_values) - shift)
            equal = row_values[first + shift : last + shift] == item_values[first:last]
            start, n = longest_overlap(equal)
            if n >= min(LEAST_TOKENS, len(item_values)) and n > best.get((row, item), (0, 0, 0, 0))[2]:
                best[row, item] = (first + shift + start, first + start, n, int(equal[start : start + n].sum()))
        return [(*key, *value) for key, value in sorted(best.items())]


def blocks(benchmark: DataFrame, id_column: str, text_column: str, block_chars: int) -> Iterator[Index]:
    """The benchmark in blocks of about so many characters."""
    items = benchmark.where(F.col(text_column).isNotNull()).select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = size // block_chars + 1
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).collect()
        part.sort(key=lambda r: (r["id"] is None, r["id"], r["text"]))
        yield Index([r["id"] for r in part], [r["text"] for r in part])


def overlaps(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, doc_start, item_start, n_tokens, n_equal): the longest overlap of each document
    with each item that it has one with.

    Fixed masks over SPAN tokens give the seeds of items and documents; a common seed fixes how the
    two lie against each other, and along that line the longest stretch with a share of SIMILARITY or
    more equal tokens is taken, so single replaced tokens don't break it. It counts from LEAST_TOKENS
    tokens on, or as the whole item if that is shorter; as a stretch begins and ends with an equal token,
    an item of LEAST_TOKENS tokens or fewer whose first or last token is replaced is not found, and one
    of fewer than LEAST_TOKENS tokens with replaced ones may lack a common seed. Items of fewer than SPAN tokens are too short
    to tell a leak and match nothing. Null or empty texts overlap with nothing; null ids are returned
    as null; repeated documents and items are each reported; an empty benchmark gives no rows. Whole
    documents are streamed against the benchmark, in blocks of a fixed size, without a shuffle.
    """
    source = docs.select(F.col(doc_id).alias("id"), F.col(doc_text).alias("text"))
    schema = f"doc_id {source.schema['id'].dataType.simpleString()}, item_id {benchmark.schema[item_id].dataType.simpleString()}, doc_start long, item_start long, n_tokens long, n_equal long"
    result = None
    for index in blocks(benchmark, item_id, item_text, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def compute(batch: pa.RecordBatch, shared=shared) -> Iterator[pa.RecordBatch]:
            found = shared.value.overlaps(batch.column(1).to_pylist())
            ids = batch.column(0).take(pa.array([f[0] for f in found], pa.int64()))
            items = pa.array([shared.value.ids[f[1]] for f in found])
            rest = [pa.array([f[k] for f in found], pa.int64()) for k in range(2, 6)]
            if found:
                yield pa.RecordBatch.from_arrays([ids, items, *rest], ["doc_id", "item_id", "doc_start", "item_start", "n_tokens", "n_equal"])

        part = each_batch(source, compute, schema, ROWS)
        result = part if result is None else result.unionByName(part)
    return result


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents, all columns, that overlap with no item. Null and empty texts and null ids stay,
    repeated rows stay or go together; an empty benchmark leaves every document."""
    at = docs.columns.index(doc_text)
    for index in blocks(benchmark, item_id, item_text, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def compute(batch: pa.RecordBatch, shared=shared) -> Iterator[pa.RecordBatch]:
            keep = np.ones(batch.num_rows, bool)
            keep[[f[0] for f in shared.value.overlaps(batch.column(at).to_pylist())]] = False
            yield batch.filter(pa.array(keep))

        docs = each_batch(docs, compute, docs.schema, ROWS)
    return docs


def op7_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overlaps of all documents with the benchmark; nulls, repeats and empty tables as in `overlaps`."""
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
