import hashlib
import random

from topictables.llm import substrings
from topictables.llm.substrings import WINDOW, Automaton

SCHEMA = "doc_id long, text string, key string, n_chars long"


def brute(rows):
    """rows in the order of their windows; equal ids only with equal texts."""
    first, result = {}, []
    for key, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        words = (text or "").split(" ") if text else []
        covered = [False] * len(words)
        for i in range(len(words) - WINDOW + 1):
            window = tuple(words[i : i + WINDOW])
            if first.setdefault(window, (key, i)) != (key, i):
                covered[i : i + WINDOW] = [True] * WINDOW
        kept = [w for w, c in zip(words, covered, strict=True) if not c]
        result.append((key, len(words), sum(covered), hashlib.sha256(" ".join(kept).encode()).hexdigest(), " ".join(kept)))
    return sorted(result, key=str)


def corpus(rng):
    words = [f"w{i}" for i in range(400)]
    passages = [[rng.choice(words) for _ in range(rng.randint(15, 60))] for _ in range(8)]
    rows = []
    for i in range(80):
        text = [rng.choice(words) for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            text += rng.choice(passages) + [rng.choice(words) for _ in range(rng.randint(0, 9))]
        rows.append((i, " ".join(text)))
    rows += [(100 + i, rows[i][1]) for i in range(20)]
    rows += [(130, "a " * 70 + "end"), (131, "x y " * 40), (132, "a " * 40 + "b"), (133, ""), (134, None), (None, rows[3][1] + " tail"), (1, rows[1][1])]
    return [(k, t.strip() if t else t) for k, t in rows]


def test_matches_brute_force(spark, monkeypatch):
    rows = corpus(random.Random(11))
    df = spark.createDataFrame([(k, t, "x", 0) for k, t in rows], SCHEMA).repartition(5)
    for hot in (2000, 3):
        monkeypatch.setattr(substrings, "HOT", hot)
        found = substrings.deduplicate(df, with_text=True)
        got = sorted(((r["row"]["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"], r["kept_text"] or "") for r in found.collect()), key=str)
        assert got == brute(rows)


def test_pipeline_form_keeps_columns_and_clean_texts(spark):
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(1, "keep\n  this   as is", "x", 5), (2, text, "x", 7), (3, text + "  more\nhere", "x", 9), (4, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, substrings.without_repeats(df, length_column="n_chars").collect()))
    assert got == [(1, "keep\n  this   as is", "x", 5), (2, text, "x", 7), (3, "more here", "x", 9), (4, None, None, None)]
    assert substrings.without_repeats(df).columns == df.columns


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert substrings.deduplicate(empty).count() == 0
    assert substrings.without_repeats(empty).count() == 0


def test_automaton_statistics():
    rng = random.Random(2)
    automaton, before = Automaton(), []
    for _ in range(30):
        segment = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 25))]
        got = automaton.add(segment)
        for i in range(len(segment)):
            longest = 0
            for n in range(1, i + 2):
                part = segment[i + 1 - n : i + 1]
                texts = [*before, segment[:i]]
                if any(t[k : k + n] == part for t in texts for k in range(len(t) - n + 1)):
                    longest = n
            assert got[i] == longest
        before.append(segment)


def test_settled_copies_are_dealt_by_their_document():
    import pickle

    import numpy as np
    import pyarrow as pa
    import zstandard

    words = [f"w{i}" for i in range(60)]
    blob = zstandard.ZstdCompressor().compress(" ".join(words).encode())
    _, _, places, hashes = substrings.anchored(substrings.word_hashes([w.encode() for w in words]), np.array([0, 60]))
    keys = [hashlib.sha256(str(i).encode()).digest()[: substrings.KEY_BYTES] for i in range(200)]
    columns = [pa.array(keys), pa.array([False] * 200), pa.array(list(range(200))), pa.array([blob] * 200), pa.array([places.tolist()] * 200, pa.list_(pa.int32()))]
    part = pa.RecordBatch.from_arrays(columns, ["key", "no_id", "id", "z", "at"])
    for hot in (np.zeros(0, np.uint64), np.sort(hashes)):
        found = substrings._segments(part, hot, 50)
        settled = [len(pickle.loads(zstandard.ZstdDecompressor().decompress(b))[2]) for b in found.column(1).to_pylist()]
        assert sum(settled) >= 199 and max(settled) < 0.2 * sum(settled)
