import itertools
import random

import numpy as np

from topictables.llm import decontamination as d

ITEMS = "item_id long, text string, ids string"
DOCS = "doc_id long, text string, id string, item_id long"


def best(equal):
    found = (0, 0)
    for a in range(len(equal)):
        for b in range(a + 1, len(equal) + 1):
            part = equal[a:b]
            if part[0] and part[-1] and part.mean() >= d.SIMILARITY - 1e-9 and b - a > found[1]:
                found = (a, b - a)
    return found


def test_longest_overlap():
    rng = np.random.default_rng(3)
    for _ in range(300):
        equal = rng.random(rng.integers(0, 40)) < rng.random()
        assert d.longest_overlap(equal) == best(equal)


def brute(docs, items):
    found = set()
    for key, text in docs:
        words = d.tokens(text)
        for item, passage in items:
            target = d.tokens(passage)
            if len(target) < d.SPAN:
                continue
            longest = 0
            for shift in range(-len(target), len(words)):
                a, b = max(0, -shift), min(len(target), len(words) - shift)
                if b > a:
                    longest = max(longest, best(np.array([words[shift + i] == target[i] for i in range(a, b)]))[1])
            if longest >= min(d.LEAST_TOKENS, len(target)):
                found.add((key, item, longest))
    return found


def test_overlaps_match_brute_force(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(2000)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([3, 8, 10, 30])))) for i in range(12)] + [(50, None), (51, "")]
    docs = []
    for i in range(40):
        text = rng.choices(words, k=rng.randint(0, 30))
        if i % 2:
            passage = d.tokens(items[rng.randrange(12)][1])
            for _ in range(len(passage) // 10):
                passage[rng.randrange(len(passage))] = "Other"
            text[rng.randint(0, len(text)) : 0] = passage
        docs.append((i, ", ".join(text).upper() if i % 3 else " ".join(text)))
    docs += [(100, None), (101, ""), (None, items[3][1]), (1, docs[1][1])]
    frame = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], DOCS).repartition(3)
    bench = spark.createDataFrame([(k, t, "x") for k, t in items], ITEMS)
    for chars in (d.BLOCK_CHARS, 300):
        rows = d.overlaps(frame, bench, block_chars=chars).collect()
        assert {(r["doc_id"], r["item_id"], r["n_tokens"]) for r in rows} == brute(docs, items)
    flagged = {k for k, _, _ in brute(docs, items)}
    kept = d.without_leaks(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(k) for k, _ in docs if k not in flagged)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", 1)], DOCS)
    none = spark.createDataFrame([], ITEMS)
    assert d.overlaps(docs, none).count() == 0
    assert d.without_leaks(docs, none).count() == 1
    assert d.overlaps(docs.limit(0), spark.createDataFrame([(1, "a b c d e f g h i", "x")], ITEMS)).count() == 0


def test_seeds_hit_every_stretch():
    for n in range(d.LEAST_TOKENS, 21):
        places = [{at + j for j, used in enumerate(mask) if used == "1"} for mask in d.MASKS for at in range(n - d.SPAN + 1)]
        for replaced in itertools.combinations(range(n), int(n * (1 - d.SIMILARITY) + 1e-9)):
            assert any(p.isdisjoint(replaced) for p in places), (n, replaced)
