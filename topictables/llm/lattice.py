"""LM scoring: marginal likelihood of a text over all its segmentations into subword pieces."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topictables.llm.common import byte_texts, each_batch, remainder, shared_folder, stored, table

VOCABULARY = "piece_bpe_32k.model"
#: A word begins with this byte, which stands for the vocabulary's word mark and never occurs in a word.
MARK = b" "
#: Rounds of expectation-maximisation over all training words; added to each piece's expected count.
ROUNDS, ADDED = 3, 0.1
#: Added to each token's count in the base score.
BASE_ADDED = 0.1
#: At most so many of the most frequent words are broadcast; the rest are joined.
HOT_WORDS = 200_000
LN10 = math.log(10)


class Lattice:
    """Pieces as a trie over bytes. Every byte is a piece too, so that each text has a segmentation."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        children: dict[int, int] = {}
        terminal = [-1]
        for number, piece in enumerate(pieces):
            node = 0
            for byte in piece:
                key = node << 8 | byte
                if key not in children:
                    children[key] = len(terminal)
                    terminal.append(-1)
                node = children[key]
            terminal[node] = number
        keys = np.array(sorted(children), np.int64)
        self.keys, self.child, self.terminal = keys, np.array([children[k] for k in keys.tolist()], np.int32), np.array(terminal, np.int32)
        self.longest = max(map(len, pieces))

    def edges(self, text: np.ndarray) -> list[np.ndarray]:
        """text: words as rows of bytes, padded with zeros on the right. By length, from 1 on, the number of
        the piece that begins at each place, or -1."""
        rows, width = text.shape
        found = []
        at = np.arange(rows * width)
        node = np.zeros(rows * width, np.int64)
        flat = text.ravel().astype(np.int64)
        for n in range(1, min(width, self.longest) + 1):
            inside = at % width + n <= width
            at, node = at[inside], node[inside]
            key = node << 8 | flat[at + n - 1]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            alive = self.keys[place] == key
            at, node = at[alive], self.child[place[alive]].astype(np.int64)
            numbers = np.full(rows * width, -1, np.int32)
            numbers[at] = self.terminal[node]
            found.append(numbers.reshape(rows, width))
            if not len(at):
                break
        return found

    def forward(self, edges: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
        """Log probability of each prefix; weights: log probabilities of pieces and, last, minus infinity."""
        rows, width = edges[0].shape
        alpha = np.full((rows, width + 1), -np.inf)
        alpha[:, 0] = 0
        for end in range(1, width + 1):
            terms = [alpha[:, end - n] + weights[edges[n - 1][:, end - n]] for n in range(1, min(end, len(edges)) + 1)]
            alpha[:, end] = _log_sum(terms)
        return alpha

    def backward(self, edges: list[np.ndarray], weights: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        rows, width = edges[0].shape
        beta = np.full((rows, width + 1), -np.inf)
        beta[np.arange(rows), lengths] = 0
        for start in range(width - 1, -1, -1):
            terms = [beta[:, start + n] + weights[edges[n - 1][:, start]] for n in range(1, min(width - start, len(edges)) + 1)]
            beta[:, start] = np.where(lengths == start, 0, _log_sum(terms))
        return beta


def _log_sum(terms: list[np.ndarray]) -> np.ndarray:
    stacked = np.array(terms)
    top = np.maximum(stacked.max(0), -1e300)
    return top + np.log(np.exp(stacked - top).sum(0), out=np.full(len(top), -np.inf), where=np.isfinite(stacked).any(0))


def _padded(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Words of like length together: their indices, bytes and lengths."""
    sizes = np.array([len(w) + 1 for w in words])
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        end = at + 1
        width = sizes[order[at]]
        while end < len(order) and end - at < 4096 and sizes[order[end]] <= width + 1 + width // 16 and (end - at) * sizes[order[end]] < 200_000:
            end += 1
        part = order[at:end]
        width = int(sizes[part].max())
        text = np.frombuffer(b"".join((MARK + words[i]).ljust(width, b"\0") for i in part), np.uint8).reshape(len(part), width)
        yield part, text, sizes[part]
        at = end


def log_likelihoods(lattice: Lattice, weights: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Natural logarithm of each word's probability, summed over its segmentations."""
    result = np.zeros(len(words))
    for part, text, lengths in _padded(words):
        result[part] = lattice.forward(lattice.edges(text), weights)[np.arange(len(part)), lengths]
    return result


def expected_counts(lattice: Lattice, weights: np.ndarray, words: list[bytes], counts: np.ndarray) -> np.ndarray:
    """How often each piece is expected in these words, occurring so often."""
    total = np.zeros(len(lattice.pieces) + 1)
    for part, text, lengths in _padded(words):
        edges = lattice.edges(text)
        alpha, beta = lattice.forward(edges, weights), lattice.backward(edges, weights, lengths)
        whole = beta[:, 0]
        for n, numbers in enumerate(edges, 1):
            width = numbers.shape[1] - n + 1
            share = np.exp(alpha[:, :width] + weights[numbers[:, :width]] + beta[:, n : n + width] - whole[:, None])
            known = numbers[:, :width] >= 0
            total += np.bincount(numbers[:, :width][known], (share * counts[part, None])[known], len(total))
    return total[:-1]


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """The pieces of a SentencePiece file as bytes, and starting weights from its scores. Control pieces,
    and such with a word mark elsewhere than in front, are left out; all 256 bytes are in. A file whose
    scores are ranks (BPE) is taken as Zipf's law over them."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores: dict[bytes, float] = {bytes([b]): -math.inf for b in range(256)}
    for i in range(model.get_piece_size()):
        text = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or "▁" in text[1:]:
            continue
        scores[text.replace("▁", " ").encode()] = model.get_score(i)
    pieces = sorted(scores)
    values = np.array([scores[p] for p in pieces])
    known = values[np.isfinite(values)]
    if len(known) and np.all(known == np.round(known)):
        values = -np.log(1 - values + 100)
    values = np.where(np.isfinite(values), values, values[np.isfinite(values)].min())
    return pieces, values - np.logaddexp.reduce(values)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, text_column: str, learned: str) -> DataFrame:
    """(word, c, n): of every word of all texts, its count in those to learn from and in all."""
    lower = F.translate(F.col(text_column), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = docs.select(F.explode(F.split(lower, "[\\x20\\x09-\\x0D]+")).alias("word"), F.col(learned).cast("long").alias("k")).where("word != ''")
    return words.groupBy("word").agg(F.sum("k").alias("c"))


def fit_weights(words: DataFrame, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Log weights of the pieces, and minus infinity.

    words: (word, c). The lattice stands in for words that were not seen, so it is fitted to the different
    words with c > 0, each counting once. Each round takes the expected counts of the pieces, summed on
    the executors; only sums by piece come to the driver. Without words the starting weights stay."""
    pieces, start = vocabulary(path)
    spark = words.sparkSession
    weights = np.append(start, -np.inf)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((path, weights))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            path, weights = shared.value
            total = np.zeros(len(weights) - 1)
            for batch in batches:
                some = batch.column(0).cast(pa.binary()).to_pylist()
                total += expected_counts(known_lattice(path), weights, some, np.ones(len(some)))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["piece", "expected"])

        sums = words.where("c > 0").select("word").mapInArrow(expect, "piece int, expected double").groupBy("piece").agg(F.sum("expected").alias("expected")).collect()
        if not sums:
            break
        counts = np.full(len(pieces), ADDED)
        for r in sums:
            counts[r["piece"]] += r["expected"]
        weights = np.append(np.log(counts / counts.sum()), -np.inf)
    return weights


_LATTICES: dict[str, Lattice] = {}


def known_lattice(path: str) -> Lattice:
    if path not in _LATTICES:
        _LATTICES[path] = Lattice(vocabulary(path)[0])
    return _LATTICES[path]


def score(docs: DataFrame, learned: str, id_column: str = "doc_id", text_column: str = "text", path: str | None = None, hot_words: int = HOT_WORDS, rounds: int = ROUNDS) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score, pieces_score) of every row.

    learned names a boolean column: rows to learn from. A text, lower-cased in A-Z, is its words and one
    end. score is the log10 of its probability, summed over all segmentations by a forward recursion in
    log space. The pieces are those of the given vocabulary, and their weights are fitted to the words to
    learn from. A seen word is an edge of the lattice too: it has its share of all tokens, less a discount
    (the usual estimate from the words seen once and twice), and what is discounted weighs the paths of
    pieces; so the score is a probability over all texts. No piece crosses a word, so a text's score is
    the sum of its words' and the end's, and each different word is run once. pieces_score is the same
    without the edges of seen words: every token is a word, by the pieces alone, or the end, as often as
    it was seen. base_score is that of a word unigram model with BASE_ADDED to each count.

    Null and empty texts are the end alone. A null flag is false. Rows that repeat are each scored and
    each learned from; ids may be null. With nothing to learn from, pieces keep the vocabulary's weights,
    a text ends after each word with probability one half, and the base score counts nothing.

    The most frequent words, a bounded number, are broadcast, and each task adds up what its texts have
    of them; what is left of a text, its rare words with their counts, is joined, so that no word is a
    hot key.
    """
    spark = docs.sparkSession
    path = path or vocabulary_path()
    shared_folder(spark)
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.coalesce(F.col(learned), F.lit(False)).alias("learned"))
    counted = stored(token_counts(source, "text", "learned"))
    total, different, once, twice = counted.agg(F.sum("c"), *(F.count(F.when(F.col("c").between(*x), 1)) for x in ((1, 1 << 62), (1, 1), (2, 2)))).first()
    texts = source.where("learned").count()
    tokens, types = (total or 0) + texts, different + (texts > 0)
    discount = once / (once + 2 * twice) if once and twice else 0.5
    weights = fit_weights(counted, path, rounds)
    shared = spark.sparkContext.broadcast((path, weights))
    whole = tokens + BASE_ADDED * (types + 1)
    rest = discount * types / tokens if tokens else 0.5
    ends = texts / tokens if texts and tokens > texts else 0.5
    going_on = math.log1p(-ends)

    def judge(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        path, weights = shared.value
        pieces = log_likelihoods(known_lattice(path), weights, batch.column(0).cast(pa.binary()).to_pylist())
        seen = np.maximum(batch.column(1).to_numpy() - discount, 0) / max(1, tokens)
        logs = np.logaddexp(np.log(seen, out=np.full(len(seen), -np.inf), where=seen > 0), math.log(rest) + pieces)
        columns = [pa.array(logs / LN10), pa.array((pieces + going_on) / LN10)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["word", "c", "score", "pieces"])

    judged = stored(each_batch(counted, judge, "word string, c long, score double, pieces double"))
    sizes = judged.groupBy(F.floor(F.log2(F.col("c") + 1) * 16).alias("size")).count().collect()
    left, least = hot_words, 1 << 62
    for r in sorted(sizes, key=lambda r: -r["size"]):
        left -= r["count"]
        if left < 0 or r["size"] <= 0:
            break
        least = r["size"]
    hot = judged.where(F.floor(F.log2(F.col("c") + 1) * 16) >= least).toPandas()
    base = lambda c: math.log10((c + BASE_ADDED) / whole)
    values = zip(hot["word"], hot["c"].tolist(), hot["score"].tolist(), hot["pieces"].tolist(), strict=True)
    hot_scores = {w.encode(): (base(c), s, p) for w, c, s, p in values}
    known = spark.sparkContext.broadcast(hot_scores)
    end_base, end_score = base(texts), math.log10((texts - discount) / tokens if texts else 0.5)

    def split(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        import xxhash

        table_ = known.value
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            rows, names, words, counts, heads = [], [], [], [], []
            for row, text in enumerate(byte_texts(part.column(1))):
                name = xxhash.xxh3_128_digest(text)
                n_known, b, s, p, n = int(texts > 0), end_base, end_score, math.log10(ends), 1
                for word, times in Counter(text.lower().split()).items():
                    n += times
                    found = table_.get(word)
                    if found:
                        n_known += times
                        b += times * found[0]
                        s += times * found[1]
                        p += times * found[2]
                    else:
                        rows.append(row)
                        names.append(name)
                        words.append(word.decode())
                        counts.append(times)
                        heads.append(None)
                rows.append(row)
                names.append(name)
                words.append(" " + name.hex())  # no word: a null would send all heads to one task of the join
                counts.append(None)
                heads.append({"copies": 1, "n_tokens": n, "n_known": n_known, "base": b, "score": s, "pieces": p})
            ids = part.column(0).take(pa.array(rows, pa.int64()))
            head = pa.struct([("copies", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("pieces", pa.float64())])
            yield pa.RecordBatch.from_arrays([ids, pa.array(names, pa.binary()), pa.array(words, pa.string()), pa.array(counts, pa.int64()), pa.array(heads, head)], ["id", "name", "word", "times", "head"])

    kind = source.schema["id"].dataType.simpleString()
    parts = each_batch(source.select("id", "text"), split, f"id {kind}, name binary, word string, times long, head struct<copies:long,n_tokens:long,n_known:long,base:double,score:double,pieces:double>")
    rare = judged.where(F.floor(F.log2(F.col("c") + 1) * 16) < least).select("word", "c", F.col("score").alias("log"), F.col("pieces").alias("pieces_log"))
    joined = parts.join(rare, "word", "left")
    times = F.coalesce("times", F.lit(0))
    word_base = F.log10((F.col("c") + BASE_ADDED) / whole)
    summed = joined.groupBy("id", "name").agg(
        F.sum("head.copies").alias("copies"),
        F.sum("head.n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("head.n_known", F.when(F.col("c") > 0, times), F.lit(0))).alias("n_known"),
        F.sum(F.coalesce("head.base", times * word_base)).alias("base"),
        F.sum(F.coalesce("head.score", times * F.col("log"))).alias("score"),
        F.sum(F.coalesce("head.pieces", times * F.col("pieces_log"))).alias("pieces"),
    )
    share = lambda c: (F.col(c) / F.col("copies")).alias(c)
    each = summed.select("id", (F.col("n_tokens") / F.col("copies")).cast("long").alias("n_tokens"), (F.col("n_known") / F.col("copies")).cast("long").alias("n_known"), share("base"), share("score"), share("pieces"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    return each.select("id", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score", F.col("pieces").alias("pieces_score"))


def op1_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores of every document; null texts and ids, which are not held out, as in `score`."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (remainder(F.col("doc_id"), 10) != 0).alias("learned"))
    found = score(docs, "learned")
    held_out = F.coalesce(remainder(F.col("id"), 10) == 0, F.lit(False))
    return found.select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "pieces_score")
