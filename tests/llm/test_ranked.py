import math
import random
import re
from collections import Counter

import duckdb
import pytest

from topictables.llm import ranked as r

DOCS = "doc_id long, text string, id string, n long"
ITEMS = "item_id long, text string, rank int, terms string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(docs, items, top):
    split = [(k, TERM.findall((t or "").translate(LOWER))) for k, t in docs]
    split = [(k, Counter(w), len(w)) for k, w in split if w]
    total, length = len(split), sum(n for _, _, n in split)
    df = Counter(t for _, c, _ in split for t in c)
    rows = []
    for item, text in items:
        scores = []
        for key, counts, n in split:
            m, score = 75 + 25 * n * total // length, 0
            for term in TERM.findall((text or "").translate(LOWER)):
                if tf := counts[term]:
                    score += math.floor(1000 * math.log((2 * total + 2) / (2 * df[term] + 1))) * (1000000000 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scores.append((-score, key is None, key or 0))
        rows += [(item, i, None if none else key, -s) for i, (s, none, key) in enumerate(sorted(scores)[:top], 1)]
    return sorted(rows, key=str)


def collected(df):
    return sorted(((x["item_id"], x["rank"], x["doc_id"], x["score"]) for x in df.collect()), key=str)


def test_terms():
    assert r.terms("Ab-c_9é　x\x00y\x7fÄ…") == [b"ab", b"c", "9é　x".encode(), b"y", "Ä…".encode()]
    text = "".join(map(chr, range(0x300)))
    assert [t.decode() for t in r.terms(text)] == TERM.findall(text.translate(LOWER))


@pytest.mark.parametrize("seed", range(3))
def test_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([1, 3, 20, 200])))) for i in range(300)]
    docs += [(400 + i, docs[7][1]) for i in range(30)]  # ties
    docs += [(3, docs[3][1]), (3, "w1 w2"), (500, None), (501, ""), (502, " .,!"), (None, "w1 w5 w9"), (None, "w1")]
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choices(words + ["other"], k=rng.choice([1, 5, 40])))) for i in range(25)]
    items += [(5, items[5][1]), (90, None), (91, ""), (92, "W1, w1 w1. unseen"), (None, "w2")]
    frame = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], DOCS).repartition(3)
    asked = spark.createDataFrame([(k, t, 0, "y") for k, t in items], ITEMS)
    expected = brute(docs, items, 20)
    assert len({row[0] for row in expected}) > 20
    for options in ({}, {"short": 5}, {"short": 0, "part_docs": 40}, {"short": 40, "block_chars": 300}):
        assert collected(r.ranked(frame, asked, **options)) == expected
    assert collected(r.ranked(frame, asked, top=3, short=30)) == brute(docs, items, 3)


def test_ranges_skip_and_agree():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    docs = [rng.choices(words, [1 / (i + 1) ** 0.7 for i in range(300)], k=rng.randint(1, 60)) for _ in range(3000)]
    queries = r.Queries.of([0], [" ".join(words)])
    import numpy as np

    of, term, tf = map(np.array, zip(*[(d, queries.numbers[w.encode()], n) for d, text in enumerate(docs) for w, n in Counter(text).items()], strict=True))
    weights = np.array([rng.randint(0, 9000) for _ in words])
    n = np.array([len(d) for d in docs])
    part = r.Lists(list(range(3000)), n, of, term, tf, weights, 3000, int(n.sum()))
    for _ in range(40):
        query = [(rng.randrange(300), rng.randint(1, 3)) for _ in range(rng.randint(1, 12))]
        query = list(dict(query).items())
        full = np.zeros(3000, np.int64)
        for t, times in query:
            d, a = part[t]
            full[d] += a * times
        order = np.lexsort((np.arange(3000), -full))[:20]
        expected = [(int(d), int(full[d])) for d in order if full[d] > 0]
        for short in (0, 30, 300, 5000):
            docs_found, scores = r.search(part, query, 20, 1, short, 16)
            assert list(zip(docs_found.tolist(), scores.tolist(), strict=True)) == expected
            if len(expected) == 20:
                least = expected[9][1]
                docs_found, scores = r.search(part, query, 20, least, short, 16)
                assert list(zip(docs_found.tolist(), scores.tolist(), strict=True)) == [x for x in expected if x[1] >= least]


def test_empty_tables_and_text_ids(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "X")], "item_id string, text string")
    assert collected(r.ranked(docs, items)) == collected(r.ranked(docs.repartition(2), items))
    assert [row["doc_id"] for row in r.ranked(docs.unionByName(docs.sparkSession.createDataFrame([("c", "z z"), ("d", "z")], docs.schema)), items).orderBy("rank").collect()] == ["a", "b"]
    assert r.ranked(docs.limit(0), items).count() == 0
    assert r.ranked(docs, items.limit(0)).count() == 0


def test_query_is_its_sql(spark, sf_dir):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    rows = con.execute(r.ORACLE).fetchall()
    assert collected(r.op11_ranked_search(spark, sf_dir)) == sorted(rows, key=str)
