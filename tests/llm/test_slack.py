import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from topictables.llm import packing, slack

SCHEMA = "doc_id long, text string, id string, length long, task string"


def test_fullest_matches_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        room = rng.randint(0, 40)
        pieces = rng.choices(range(1, 30), k=rng.randint(0, 9))
        available = np.bincount(pieces, minlength=60)
        chosen = slack.fullest(available, room)
        assert all(k <= available[n] for n, k in chosen)
        best = max(sum(c) for r in range(len(pieces) + 1) for c in itertools.combinations(pieces, r) if sum(c) <= room)
        assert sum(n * k for n, k in chosen) == best


def one_by_one(counts, tokens):
    left, sequences = Counter(counts), []
    while +left:
        longest = max(n for n, k in left.items() if k)
        left[longest] -= 1
        available = np.zeros(tokens + 1, int)
        for n, k in left.items():
            available[n] = k
        rest = Counter(dict(slack.fullest(available, tokens - longest)))
        left -= rest
        rest[longest] += 1
        sequences.append(rest)
    return sequences


def test_repeated_combinations_are_those_of_one_bin_after_another():
    rng = random.Random(5)
    for _ in range(30):
        tokens = rng.choice([10, 37, 100])
        counts = {n: rng.choice([1, 2, 50]) for n in rng.sample(range(1, tokens + 1), rng.randint(1, 10))}
        together = [Counter(dict(c)) for c, times in slack.minimum_slack(counts, tokens) for _ in range(times)]
        assert together == one_by_one(counts, tokens)


def test_many_pieces_take_few_combinations():
    rng = random.Random(1)
    few = slack.minimum_slack(dict(Counter(rng.choices(range(1, 301), k=30_000))), 300)
    many = slack.minimum_slack({n: rng.randint(1, 10**9) for n in range(1, 301)}, 300)
    assert len(many) < 4 * len(few) < 4000
    used = sum(n * k * times for c, times in few for n, k in c)
    assert sum(times for _, times in few) <= used / 300 * 1.005


def check(texts, rows, tokenizer, tokens):
    documents, sequences = defaultdict(list), defaultdict(list)
    for p in rows:
        documents[p["id"]].append(p)
        sequences[p["sequence_id"]].append(p)
    assert documents.keys() == texts.keys()
    for key, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, slack.END], "<u4")
        at = 0
        for i, p in enumerate(sorted(documents[key], key=lambda p: p["start"])):
            assert (p["piece"], p["start"]) == (i, at)
            assert p["length"] == min(tokens, len(ids) - at)
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= tokens
    return len(sequences), [p["length"] for p in rows]


def best_fit_decreasing(lengths, tokens):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else tokens) - n)
    return len(rooms)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.tokenizer_path())


@pytest.mark.parametrize("tokens", [2048, 64])
def test_documents(spark, tokenizer, tokens):
    rng = random.Random(4)
    words = "alpha beta gamma Delta, epsilon. zeta! Ünï".split()
    texts = {i: " ".join(rng.choices(words, k=rng.choice([0, 1, 3, 40, 400, 3000]))) for i in range(150)}
    texts[200], texts[201], texts[202] = None, "", " ".join(["alpha"] * 63)
    df = spark.createDataFrame([(k, t, "x", 1, "y") for k, t in texts.items()], SCHEMA).repartition(3)
    n, lengths = check(texts, slack.pack_whole(df, tokens=tokens).collect(), tokenizer, tokens)
    assert n <= best_fit_decreasing(lengths, tokens)


def test_repeated_null_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a", "x", 1, "y"), (1, "a", "x", 1, "y"), (None, "b", None, None, None)], SCHEMA)
    rows = slack.pack_whole(df).collect()
    assert sorted((r["id"] or 0, r["length"]) for r in rows) == [(0, 2), (1, 2), (1, 2)]
    assert sorted(r["offset"] for r in rows) == [0, 2, 4]
    assert slack.pack_whole(df.limit(0)).count() == 0


def test_query(spark, sf_dir, tokenizer):
    from topictables.llm.common import table

    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    rows = [r.asDict() | {"id": r["doc_id"]} for r in slack.op12_best_fit_packing(spark, sf_dir).collect()]
    n, lengths = check(texts, rows, tokenizer, 2048)
    assert n <= best_fit_decreasing(lengths, 2048)
