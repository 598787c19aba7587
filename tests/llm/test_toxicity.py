import random

import numpy as np

from topictables.llm import toxicity

SCHEMA = "doc_id long, text string, id string, score double"


def texts(n, seed=9):
    """Toxic are an insult, and a word that insults only beside a group's name."""
    rng = random.Random(seed)
    plain = [f"plain{i}" for i in range(300)]
    rows = []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(3, 60))
        kind = i % 8
        words += {0: ["rotter"], 1: ["vermin"], 2: ["folk"], 3: ["vermin", "folk"]}.get(kind, [])
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(kind in (0, 3))))
    return rows


def test_learns_words_and_pairs(spark):
    rows = texts(1600)
    docs = spark.createDataFrame([(k, t, "x", 0.0) for k, t, _ in rows], SCHEMA)
    labels = spark.createDataFrame([(k, y, "z") for k, _, y in rows[:1000]] + [(1, None, None), (None, 1, None)], "doc_id long, toxic int, text string")
    machine = toxicity.train(docs, labels)
    got = {r["id"]: r for r in toxicity.scores(docs, machine).collect()}
    held_out = rows[1000:]
    wrong = [k for k, _, y in held_out if got[k]["predicted"] != y]
    assert len(wrong) <= 0.02 * len(held_out)
    assert all((r["score"] >= toxicity.TOXIC) == r["predicted"] and 0 <= r["score"] <= 1 for r in got.values())
    kept = toxicity.without_toxic(docs, machine)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, r in got.items() if not r["predicted"]}


def test_logits_match_the_pairwise_sum():
    rng = np.random.default_rng(1)
    weights, factors, x = rng.normal(size=6), rng.normal(size=(6, 3)), rng.normal(size=6)
    got = toxicity.machine_logits(0.5, weights, factors, np.zeros(6, int), np.arange(6), x, 1)[0][0]
    pairs = sum(factors[i] @ factors[j] * x[i] * x[j] for i in range(6) for j in range(i))
    assert np.isclose(got, 0.5 + weights @ x + pairs)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 0.0), (None, None, None, None), (2, "", "x", 0.0)], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    found = toxicity.scores(docs, toxicity.train(docs, labels)).collect()
    assert len(found) == 3 and all(r["score"] < 0.01 for r in found)
    assert toxicity.scores(docs.limit(0), toxicity.train(docs.limit(0), labels)).count() == 0


def test_scores_do_not_depend_on_the_order_of_rows(spark):
    rows = texts(400)
    docs = spark.createDataFrame([(k, t, "x", 0.0) for k, t, _ in rows], SCHEMA)
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    one = toxicity.train(docs.repartition(4), labels)
    two = toxicity.train(docs.repartition(2, "text"), labels.repartition(3))
    assert np.array_equal(one.weights, two.weights) and np.array_equal(one.factors, two.factors)


def neutral(n, seed):
    """An eighth of the rows is toxic. `folk` is in a tenth of the rows, with that same share; `vermin` in
    a fortieth. Where they meet a row is toxic by nothing else, elsewhere by an insult."""
    rng = random.Random(seed)
    plain = [f"plain{i}" for i in range(300)]
    rows = []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(3, 40))
        group, other = i % 10 == 0, i % 80 in (10, 33)
        both = group and other
        insult = not both and (i % 400 == 20 if group else rng.random() < 0.125)
        words += ["folk"] * group + ["vermin"] * other + ["rotter"] * insult
        rng.shuffle(words)
        rows.append((" ".join(words), int(both or insult), both))
    return rows


def test_learns_a_pair_whose_group_word_is_neutral_alone():
    known, held_out = neutral(4000, 1), neutral(4000, 2)
    y = np.array([y for _, y, _ in known])
    group = np.array(["folk" in t for t, _, _ in known])
    assert abs(y[group].mean() - y.mean()) < 0.04
    machine = toxicity.fit([toxicity.terms(t) for t, _, _ in known], y)
    predicted = machine.score([t for t, _, _ in held_out]) >= toxicity.TOXIC
    both = np.array([b for _, _, b in held_out])
    assert predicted[both].mean() >= 0.9
    assert (predicted != [y for _, y, _ in held_out]).mean() <= 0.01
