import math
import random
from collections import Counter

import numpy as np
import pytest

from topictables.llm import lattice
from topictables.llm.lattice import Lattice

SCHEMA = "doc_id long, text string, learned boolean, id string, score double, word string"


def segmentations(word, pieces):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in pieces:
            for rest in segmentations(word[n:], pieces):
                yield [word[:n], *rest]


@pytest.fixture(scope="module")
def small():
    pieces = sorted({b" ", b"a", b"b", b"c", b" a", b"ab", b"abc", b"bc", b"ca", b" ca", b"\xc3", b"\xa9", b"\xc3\xa9"})
    rng = np.random.default_rng(1)
    weights = np.log(rng.dirichlet(np.ones(len(pieces))))
    return Lattice(pieces), pieces, np.append(weights, -np.inf)


def words_of(rng):
    return ["".join(rng.choices("abcé", k=rng.randint(1, 9))).encode() for _ in range(60)]


def test_forward_sums_all_segmentations(small):
    model, pieces, weights = small
    words = words_of(random.Random(2))
    got = lattice.log_likelihoods(model, weights, words)
    for word, log in zip(words, got, strict=True):
        paths = [sum(weights[pieces.index(p)] for p in s) for s in segmentations(b" " + word, pieces)]
        assert math.isclose(log, np.logaddexp.reduce(paths), rel_tol=1e-9)


def test_expected_counts_are_those_of_the_paths(small):
    model, pieces, weights = small
    words = words_of(random.Random(3))
    counts = np.arange(1, len(words) + 1)
    expected = np.zeros(len(pieces))
    for word, times in zip(words, counts, strict=True):
        paths = list(segmentations(b" " + word, pieces))
        logs = np.array([sum(weights[pieces.index(p)] for p in s) for s in paths])
        for path, share in zip(paths, np.exp(logs - np.logaddexp.reduce(logs)), strict=True):
            for piece in path:
                expected[pieces.index(piece)] += times * share
    assert np.allclose(lattice.expected_counts(model, weights, words, counts), expected)


def test_rounds_raise_the_likelihood(small):
    model, pieces, weights = small
    words = words_of(random.Random(4))
    last = -math.inf
    for _ in range(4):
        total = lattice.log_likelihoods(model, weights, words).sum()
        assert total >= last
        last = total
        counts = lattice.expected_counts(model, weights, words, np.ones(len(words))) + 1e-9
        weights = np.append(np.log(counts / counts.sum()), -np.inf)


def test_real_vocabulary_and_long_words():
    path = lattice.vocabulary_path()
    pieces, start = lattice.vocabulary(path)
    assert math.isclose(np.exp(start).sum(), 1, rel_tol=1e-9)
    model, weights = Lattice(pieces), np.append(start, -np.inf)
    words = [b"the", "日本語のテキスト".encode(), b"\xff\x00\xfe", b"x" * 5000]
    got = lattice.log_likelihoods(model, weights, words)
    assert np.isfinite(got).all()
    known = set(pieces)
    for word, log in zip(words[:2], got, strict=False):
        paths = [sum(start[pieces.index(p)] for p in s) for s in segmentations(b" " + word[:12], known)]
        if len(word) <= 12:
            assert math.isclose(log, np.logaddexp.reduce(paths), rel_tol=1e-9)


def test_scores(spark):
    rng = random.Random(5)
    words = ["alpha", "beta", "Gamma,", "delta", "ünï"] + [f"rare{i}" for i in range(40)]
    rows = [(i, "\n ".join(rng.choices(words, weights=[20] * 5 + [1] * 40, k=rng.randint(0, 25))), i % 5 > 0) for i in range(60)]
    rows += [(70, None, True), (71, "", False), (None, "alpha new", None), (3, rows[3][1], True), (3, rows[3][1], True), (72, "unseen words here", False)]
    df = spark.createDataFrame([(*r, "x", 0.0, "y") for r in rows], SCHEMA).repartition(3)
    lower = lambda t: (t or "").encode().lower().split()
    counts, texts = Counter(), 0
    for _, t, learned in rows:
        if learned:
            counts.update(lower(t))
            texts += 1
    n, v = sum(counts.values()) + texts, len(counts) + 1
    base = lambda c: math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
    expected = sorted((str(k), len(lower(t)) + 1, sum(w in counts for w in lower(t)) + 1, n, round(sum(base(counts[w]) for w in lower(t)) + base(texts), 6)) for k, t, _ in rows)
    results = []
    for hot in (lattice.HOT_WORDS, 3):
        found = lattice.score(df, "learned", hot_words=hot).collect()
        assert sorted((str(r["id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found) == expected
        results.append(sorted((str(r["id"]), round(r["score"], 6)) for r in found))
    assert results[0] == results[1] and all(s < 0 for _, s in results[0])


def test_words_have_probabilities_that_sum_to_one_at_most(spark):
    """Over the seen words and the end, plus what is left for the lattice."""
    df = spark.createDataFrame([(i, t, True, "x", 0.0, "y") for i, t in enumerate(["a b", "a c", "d", "a"])] + [(10 + i, w, False, "x", 0.0, "y") for i, w in enumerate("abcd")], SCHEMA)
    found = {r["id"]: r["score"] for r in lattice.score(df, "learned").collect()}
    end = 10 ** found[3] / 10 ** found[10] if 3 in found else 1
    assert math.isclose(end, 1)
    seen = sum(10 ** found[10 + i] for i in range(4))
    assert seen < 1


def test_nothing_learned_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b", False, "x", 0.0, "y"), (2, None, False, "x", 0.0, "y")], SCHEMA)
    found = {r["id"]: r for r in lattice.score(df, "learned").collect()}
    assert found[1]["train_tokens"] == 0 and found[1]["n_known"] == 0 and found[2]["n_tokens"] == 1
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in found.values())
    assert lattice.score(df.limit(0), "learned").count() == 0


def test_pieces_score_is_the_lattice_alone(spark):
    rows = [(1, "a bee a sea", True), (2, "bee", True), (3, "unseen sea", False), (4, None, False), (5, "", True)]
    df = spark.createDataFrame([(k, t, learned, "x", 0.0, "w") for k, t, learned in rows], SCHEMA)
    path = lattice.vocabulary_path()
    weights = np.append(lattice.vocabulary(path)[1], -np.inf)
    alone = lattice.known_lattice(path)
    ends = 3 / 8  # three texts to learn from, of five words
    for hot in (0, 100):
        found = {r["id"]: r["pieces_score"] for r in lattice.score(df, "learned", rounds=0, hot_words=hot).collect()}
        for key, text, _ in rows:
            logs = lattice.log_likelihoods(alone, weights, (text or "").encode().split()) if text else np.zeros(0)
            expected = (logs.sum() + len(logs) * math.log(1 - ends) + math.log(ends)) / math.log(10)
            assert math.isclose(found[key], expected, rel_tol=1e-9)
