import random

import numpy as np
import pytest

from topictables.llm import languages

SCHEMA = "doc_id long, text string, lang string, id string, score double"
SYLLABLES = {"aa": ["ka", "to", "mi", "ru"], "bb": ["schl", "icht", "ung", "ver"], "cc": ["eau", "oui", "ment", "que"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(i, text(rng, lang, rng.randint(3, 40)), lang) for i, lang in enumerate(list(SYLLABLES) * 60)]
    rows += [(900, None, "aa"), (None, "ka", "bb"), (901, "eau", None)]
    return languages.train(spark.createDataFrame([(*r, "x", 0.0) for r in rows], SCHEMA))


def test_held_out_accuracy(spark, model):
    rng = random.Random(2)
    rows = [(i, text(rng, lang, rng.randint(1, 30)), lang) for i, lang in enumerate(list(SYLLABLES) * 50)]
    found = languages.identify(spark.createDataFrame([(*r, "x", 0.0) for r in rows], SCHEMA), model).collect()
    right = sum(r["lang_pred"] == rows[r["id"]][2] for r in found)
    assert right >= 0.98 * len(rows)
    assert sum(len(r["languages"]) == 1 for r in found) >= 0.95 * len(rows)


def test_mixtures(model):
    rng = random.Random(3)
    for shares in ((30, 20, 0), (10, 0, 40), (15, 25, 20)):
        mixed = " ".join(text(rng, lang, n) for lang, n in zip(SYLLABLES, shares, strict=True))
        found = model.infer(mixed)
        assert {lang for lang, _ in found} == {lang for lang, n in zip(SYLLABLES, shares, strict=True) if n}
        for lang, share in found:
            assert abs(share - shares[list(SYLLABLES).index(lang)] / sum(shares)) < 0.1
        assert found[0][1] == max(s for _, s in found)


def test_shares_maximise_the_likelihood(model):
    """The shares beat those near them."""
    like = np.array([[1, 0.2, 0.01], [0.1, 1, 0.3], [0.5, 0.5, 1.0], [1, 0.9, 0.1]])
    times = np.array([3.0, 2, 4, 1])
    value, shares = model._fit(like, times, [0, 1, 2])
    assert np.isclose(shares.sum(), 1)
    score = lambda s: (times * np.log(like @ s)).sum()
    for a in range(3):
        for b in range(3):
            moved = shares.copy()
            moved[a] += 0.2 * shares[b] * (a != b)
            moved[b] -= 0.2 * shares[b] * (a != b)
            assert score(moved) <= score(shares) + 0.05


def test_defined_cases(spark, model):
    rows = [(1, None), (2, ""), (3, "12 ,. 7"), (None, "ka to"), (4, "ka"), (4, "ka"), (5, "語")]
    found = languages.identify(spark.createDataFrame([(k, t, "x", "x", 0.0) for k, t in rows], SCHEMA), model).collect()
    by = {r["id"]: r for r in found}
    assert len(found) == len(rows)
    assert all(by[k]["lang_pred"] == "und" and by[k]["score"] == 0 and by[k]["languages"] == [] for k in (1, 2, 3))
    assert by[5]["lang_pred"] in SYLLABLES and by[None]["lang_pred"] == "aa"
    empty = spark.createDataFrame([], SCHEMA)
    nothing = languages.train(empty)
    assert languages.identify(empty, model).count() == 0
    assert [r["lang_pred"] for r in languages.identify(spark.createDataFrame([(1, "ka", None, "x", 0.0)], SCHEMA), nothing).collect()] == ["und"]


def test_numbers_are_no_letters(spark):
    assert languages.words("½ ² ① Ⅷ x² ab12cd É_é ª") == ["x", "ab", "cd", "é", "é", "ª"]
    model = languages.Mixture(["aa"], np.zeros((1, languages.BUCKETS)), np.ones(1))
    df = spark.createDataFrame([(1, "½ ² ①"), (2, "Ⅷ 12 !"), (3, "a")], "doc_id long, text string")
    assert {r["id"]: (r["lang_pred"], r["score"]) for r in languages.identify(df, model).collect()} == {1: ("und", 0.0), 2: ("und", 0.0), 3: ("aa", 1.0)}


def test_only_the_most_frequent_languages_are_learned(spark):
    rows = [(i, f"some words {i}", f"l{i % 7}" if i < 70 else f"rare{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert languages.train(df, most=7).languages == [f"l{i}" for i in range(7)]
    assert len(languages.train(df, most=9).languages) == 9
