import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from topictables.llm import collocations as c

SCHEMA = "doc_id long, text string, lang string, n long, phrase string, hash string"


def sql(rows, least, first):
    con = duckdb.connect()
    con.register("documents", pa.table({"text": pa.array([t for t, _ in rows], pa.string()), "lang": pa.array([x for _, x in rows], pa.string())}))
    return sorted(con.execute(c.oracle(least, first)).fetchall())


def frame(spark, rows):
    return spark.createDataFrame([(i, t, x, 7, "p", "h") for i, (t, x) in enumerate(rows)], SCHEMA).repartition(3)


def collected(df):
    return sorted(tuple(r[k] for k in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def texts(rng, n):
    words = [f"w{i}" for i in range(25)] + ["Ünï", "É", "x\x1cy", "'"]
    weights = [1 / (i + 1) for i in range(len(words))]
    passage = " ".join(rng.choices(words, k=9))
    rows = []
    for _ in range(n):
        text = ""
        for word in rng.choices(words, weights, k=rng.choice([0, 1, 5, 30, 60])):
            text += rng.choice([word, word.upper()]) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\x0b", ";"])
        rows.append((text + (passage if rng.random() < 0.4 else ""), rng.choice(["en", "en", "en", "fr", None, "und", ""])))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_matches_sql(spark, seed):
    rng = random.Random(seed)
    rows = texts(rng, 200) + [(None, "en"), ("", None), ("...", "fr"), ("one", "xx")]
    rows += rows[:20]
    df = frame(spark, rows)
    for least, options in ((4, {}), (4, {"hot": 20, "shard": 100, "positions": 300}), (9, {"hot": 0, "bits": 16, "positions": 1})):
        expected = sql(rows, least, 2000)
        assert len(expected) > 40
        assert collected(c.collocations(df, least=least, **options)) == expected
    assert collected(c.collocations(df, least=4, first=5)) == sql(rows, 4, 5)


def test_partitions_are_counts():
    rng = random.Random(3)
    rows = [[rng.randint(1, 6) for _ in range(rng.randint(1, 5))] for _ in range(800)]
    counts = Counter()
    for r in rows:
        counts.update(tuple(r[:k]) for k in range(2, len(r) + 1))
    padded = np.array([r + [0] * (5 - len(r)) for r in rows], np.uint64)
    first, weights = c.collapsed(list(padded.T), np.ones(len(padded), np.int64))
    found = padded[first]
    assert len(found) == len({tuple(r) for r in rows}) and weights.sum() == 800
    for least in (1, 7):
        got = {tuple(found[row, :n].tolist()): count for n, row, count in c.partitioned(found, weights, least, 2)}
        assert got == {k: n for k, n in counts.items() if n >= least}


def test_rows_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(c, "mixed", lambda columns: np.zeros(len(columns[0]), np.uint64))
    rows = np.array([[1, 2], [3, 4], [1, 2], [1, 5]], np.uint64)
    first, weights = c.collapsed(list(rows.T), np.array([1, 1, 5, 1]))
    assert sorted(zip(rows[first].tolist(), weights.tolist(), strict=True)) == [([1, 2], 6), ([1, 5], 1), ([3, 4], 1)]


def test_suffixes_are_packed_whole():
    rng = np.random.default_rng(1)
    for n in (1, 7, 3000):
        words = rng.integers(0, 1 << 63, 400, np.uint64)[rng.integers(0, 400, (n, 5))]
        weights = rng.integers(1, 1 << 31, n)
        got, counts = c.unpacked(c.packed(words, weights))
        assert (got == words).all() and (counts == weights).all()


def test_words_with_one_hash_get_another_seed(spark, monkeypatch):
    # Seed 0 gives all words one hash; the module goes to the workers by value of this patched class.
    rows = [("a b a b a b c c", "en")] * 3
    whole = c.coded

    def clashing(df, lang, text, seed):
        found = whole(df, lang, text, seed)
        return found if seed else found.withColumn("hash", found["hash"] * 0)

    monkeypatch.setattr(c, "coded", clashing)
    assert collected(c.collocations(frame(spark, rows), least=3)) == sql(rows, 3, 2000)


def test_large_products_are_exact(spark):
    a, n = 9 * 10**13, 9 * 10**17
    row = spark.sql(f"SELECT (1000 * CAST({a} AS DECIMAL(15,0)) * CAST({n} AS DECIMAL(19,0))) div (CAST({a + 7} AS DECIMAL(19,0)) * CAST({a + 1} AS DECIMAL(19,0))) AS s").first()
    assert row["s"] == 1000 * a * n // ((a + 7) * (a + 1))


def test_empty_tables(spark):
    df = frame(spark, [("a b", "en")])
    assert c.collocations(df.limit(0)).count() == 0
    assert c.collocations(df).count() == 0


def test_query_is_its_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    assert collected(c.op13_phrase_collocations(spark, sf_dir)) == sorted(con.execute(c.ORACLE).fetchall())
