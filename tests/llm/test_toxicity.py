"""Toxicity: the kernel against its definition, held-out accuracy, and altered insults."""

from __future__ import annotations

import math
import random
from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearwell.llm import toxicity as tox
from clearwell.llm.queries import QUERIES


def by_definition(one, other):
    """Normalised gap-weighted kernel of subsequences of three symbols."""
    def features(word):
        word, out = f"^{word}$", {}
        for places in combinations(range(len(word)), 3):
            key = "".join(word[i] for i in places)
            out[key] = out.get(key, 0) + tox.DECAY ** (places[-1] - places[0] + 1)
        return out

    a, b = features(one), features(other)
    dot = lambda x, y: sum(v * y.get(k, 0) for k, v in x.items())
    return dot(a, b) / (dot(a, a) * dot(b, b)) ** 0.5


def test_kernel_equals_its_definition():
    words = ["idiot", "idxiot", "trash", "aaaa", "ab", "stupid", "stupidity"]
    got = tox.kernel(words, words)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert got[i, j] == pytest.approx(by_definition(a, b), abs=1e-5)


def test_decision_equals_the_sum_over_landmarks():
    model = tox._train({"idiot": 5, "trash": 3}, {"house": 4, "garden": 2, "indigo": 1})
    assert model.decide(["idiot", "trash", "house"]) == pytest.approx([1, 1, -1], abs=0.1)
    long = "x" * 40 + "idiot" + "x" * 40
    assert model.decide([long])[0] <= model.decide(["idiot"])[0]


def test_words_join_what_is_spelled_out():
    assert "idiot" in tox.words("you I.D.I.O.T!") and "idiot" in tox.words("an i d i o t here")
    assert "idiot" in tox.words("id-iot") and tox.words(None) == set() and tox.words("12 -- !") == set()


@pytest.fixture(scope="module")
def learned():
    r = random.Random(1)
    syllables = ["the", "re", "on", "ti", "ha", "st", "ea", "in", "or", "le"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randrange(1, 5)))
    bags, labels = [], []
    for i in range(400):
        bag = {word() for _ in range(60)}
        if i % 4 == 0:
            bag |= set(r.sample(["idiot", "moron", "clown", "worthless", "stupid"], 2))
        bags.append(bag)
        labels.append(int(i % 4 == 0))
    return tox.learn(bags, labels)


def test_plain_and_altered_insults(learned):
    score = lambda text: learned.score(learned.bags([tox.words(text)])[0])
    for text in ("what an idiot", "STUPID!", "m-o-r-o-n", "you c l o w n", "worthlless", "stxupid", "idi.ot"):
        assert score(text) >= 0.5, text
    for text in ("the restless heron", "a plain sentence on history", "", None, "...", "station"):
        assert score(text) < 0.5, text


def test_one_kind_of_labels_scores_nothing():
    for labels in ([0] * 5, [1] * 5, []):
        model = tox.learn([{"some", "words"}] * len(labels), labels)
        assert model.score(model.bags([{"some"}])[0]) < 0.01


def test_hostile_rows(documents, llm):
    labels = llm.createDataFrame(
        [(1, 1, 1), (1, 1, 1), (2, 0, 0), (3, 0, None), (None, 0, 1), (9, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    df = documents([(1, "idiot"), (1, "idiot"), (2, "fine"), (3, None), (None, ""), (4, "word " * 30_000)])
    model = tox.fit(df, labels)
    rows = df.select("doc_id", tox.score(llm, model, F.col("text")).alias("score")).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    assert documents([]).select(tox.score(llm, tox.fit(documents([]), labels), F.col("text"))).count() == 0


def test_held_out_accuracy(llm):
    folder = "/root/testdata/sf0.1"
    labels = llm.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op6_toxicity"](llm, folder).join(labels, "doc_id").where("held_out").collect()
    score, truth = np.array([r["score"] for r in rows]), np.array([r["toxic"] for r in rows])
    rank = np.empty(len(score))
    rank[np.argsort(score, kind="stable")] = np.arange(len(score))
    auc = (rank[truth == 1].mean() - (truth.sum() - 1) / 2) / (truth == 0).sum()
    assert auc > 0.9 and np.mean((score >= 0.5) == truth) > 0.93
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)


@pytest.mark.parametrize(("inside", "outside", "share"), [(2, 1, 0.25), (700, 400, 0.5), (1450, 375, 0.5), (4000, 3900, 0.5)])
def test_chance_with_few_and_many_bags(inside, outside, share):
    n, p = inside + outside, Fraction(share)
    exact = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(inside, n + 1))
    assert tox._chance(inside, outside, share) == pytest.approx(float(exact), rel=1e-6)


def test_a_word_of_thousands_of_bags():
    name = lambda i: "".join("bdfglmnprs"[int(d)] + "aeiou"[int(d) % 5] for d in str(i))
    bags = [{"der", name(i), "idiot" if i % 3 else "moron"} for i in range(1600)]
    bags += [{"der" if i % 4 == 0 else "the", name(5000 + i)} for i in range(1600)]
    model = tox.learn(bags, [1] * 1600 + [0] * 1600)
    scores = [model.score(v) for v in model.bags([{"idiot"}, {"moron"}, {"the"}])]
    assert min(scores[:2]) >= 0.5 > scores[2]
