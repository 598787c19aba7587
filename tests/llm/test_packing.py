import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from topictables.llm import packing

SCHEMA = "doc_id long, text string, id string, start long"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.tokenizer_path())


def test_word_by_word_ids_are_the_tokenizers(tokenizer):
    rng = random.Random(1)
    letters = "aAbéÉÀß×÷ÿ'.,!?()<|>-_`~{}[]19 \t\n\x0b\x1c\x85 　œŒİΣſﬁ́K"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(4000)]
    texts += ["x<|endoftext|>y z", "<|startoftext|>", "'the 'S don't they're' (it's", "''s", "", None]
    encoded = packing.WordIds(packing.tokenizer_path()).encode(texts)
    for text, got in zip(texts, encoded, strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def check(rows, pieces, limits, ids_of):
    documents, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        documents[p["id"]].append(p)
        sequences[p["sequence_id"]].append(p)
    for key in rows:
        at = 0
        for p in sorted(documents[key], key=lambda p: p["start"]):
            ids = np.array(ids_of(key), "<u4")
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids_of(key))
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= limits[0] and len(s) <= limits[1] and s[0]["loss_tokens"] <= limits[2]
    return [sum(p["length"] for p in s) for s in sequences.values()]


def test_texts(spark, tokenizer):
    rng = random.Random(4)
    words = "alpha beta gamma Delta, epsilon. zeta! Ünï".split()
    texts = {i: " ".join(rng.choices(words, k=rng.choice([0, 1, 3, 40, 400, 3000]))) for i in range(120)}
    texts[200], texts[201] = None, ""
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in texts.items()], SCHEMA).repartition(3)
    ids = {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END] for k, t in texts.items()}
    for limits in ((4096, 256, 4096), (512, 4, 300)):
        sizes = check(texts, packing.pack_texts(df, limits=limits).collect(), limits, ids.__getitem__)
        assert all(n in (limits[0],) or n & (n - 1) == 0 or n == limits[2] for n in sizes)


def test_examples_stay_whole_under_three_limits(spark):
    rng = random.Random(6)
    rows = []
    for i in range(150):
        n = rng.randint(1, 60)
        rows.append((i, rng.choices(range(1000), k=n), [rng.random() < 0.4 for _ in range(n)]))
    rows += [(200, None, None), (201, [], []), (202, [5], None)]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>, loss array<boolean>").repartition(2)
    limits = (64, 5, 30)
    ids = {k: v or [] for k, v, _ in rows}
    pieces = packing.pack_examples(df, "doc_id", "ids", "loss", limits).collect()
    check(ids, pieces, limits, ids.__getitem__)
    assert all(p["start"] == 0 for p in pieces)
    loss = {k: sum(m) if m is not None else len(v or []) for k, v, m in rows}
    by = defaultdict(int)
    for p in pieces:
        by[p["sequence_id"]] += loss[p["id"]]
    assert all(by[p["sequence_id"]] == p["loss_tokens"] for p in pieces)
    cut = packing.pack_examples(df, "doc_id", "ids", "loss", limits, cut=True).collect()
    assert all(n & (n - 1) == 0 for n in check(ids, cut, limits, ids.__getitem__))
    with pytest.raises(Exception, match="may not be cut"):
        packing.pack_examples(df, "doc_id", "ids", "loss", (10, 5, 30)).collect()


def test_dot_product_prefers_large_pieces():
    packer = packing.Packer(100, 10, 100, window=50, cut=False)
    full = []
    for i, n in enumerate((10, 60, 30, 95)):
        full += packer.add(i, np.zeros(n, "<u4"))
    full += packer.finish()
    assert [[p.length for p in s] for s in full] == [[95], [60, 30, 10]]


def test_repeated_null_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a", "x", 1), (1, "a", "x", 1), (None, "b", None, None)], SCHEMA)
    assert sorted((r["id"] or 0, r["length"]) for r in packing.pack_texts(df).collect()) == [(0, 2), (1, 2), (1, 2)]
    assert packing.pack_texts(df.limit(0)).count() == 0
