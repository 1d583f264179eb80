"""Language identification: held-out accuracy and defined results."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from clearwell.llm import language
from clearwell.llm.queries import QUERIES


def predicted(llm, model, texts):
    df = llm.createDataFrame(list(enumerate(texts)), "i long, text string")
    rows = df.select("i", language.predict(llm, model, F.col("text")).alias("p")).select("i", "p.*").collect()
    return [(r["lang_pred"], r["score"], r["rejected"]) for r in sorted(rows)]


def test_held_out_accuracy(llm):
    folder = "/root/testdata/sf0.1"
    truth = llm.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op3_language"](llm, folder)
    assert found.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    rows = found.join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 2000
    assert sum(r["lang_pred"] == r["lang"] for r in rows) > 0.99 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in rows) < 0.002 * len(rows)


def test_what_is_like_no_language_is_rejected(llm, documents):
    r = random.Random(1)
    words = {"aa": ["kalo", "mira", "tesu", "bano"], "bb": ["grth", "schn", "pflu", "krax"]}
    rows = [(i, " ".join(r.choice(words[lang]) for _ in range(80)), lang)
            for i, lang in enumerate(["aa", "bb"] * 60)]
    model = language.fit(documents(rows))
    assert model.languages == ["aa", "bb"]
    got = predicted(llm, model, ["Kalo, MIRA tesu! " * 20, "krax grth pflu " * 20, "这是中文文本" * 30, "zzyzx " * 60,
                                 None, "", "123 -- 456", "kalo"])
    assert [g[0] for g in got[:2]] == ["aa", "bb"] and not got[0][2] and not got[1][2]
    assert got[2][2] and got[3][2]
    assert got[4:7] == [("und", 0.0, True)] * 3
    assert got[7][0] == "aa" and not got[7][2]


def test_nothing_to_learn_from(llm, documents):
    for rows in ([], [(1, None, "en"), (2, "text", None)], [(1, "...", "en")]):
        assert predicted(llm, language.fit(documents(rows)), ["some text", None]) == [
            ("und", 0.0, False), ("und", 0.0, True)]


def test_blocks_count_every_gram_once(monkeypatch):
    text = "the quick brown fox jumps over the lazy dog " * 50
    whole, letters = language.gram_counts(text)
    monkeypatch.setattr(language, "BLOCK", 37)
    assert (language.gram_counts(text)[0] == whole).all() and letters == 35 * 50


def test_copies_and_order_do_not_change_the_model(documents):
    rows = [(i, f"alpha beta {i} gamma delta epsilon" * 3, "aa") for i in range(30)]
    one, two = language.fit(documents(rows)), language.fit(documents(rows[::-1]))
    assert (one.centroids == two.centroids).all()


def test_copies_do_not_thin_the_sample(llm, documents):
    r = random.Random(2)
    words = {"aa": ["kalo", "mira", "tesu", "bano"], "bb": ["grth", "schn", "pflu", "krax"]}
    text = lambda lang: " ".join(r.choice(words[lang]) for _ in range(80))
    rows = [(text("aa"), "aa")] * 1500 + [(text("aa"), "aa") for _ in range(20)]
    rows += [(text("bb"), "bb") for _ in range(500)] + [(str(n), "aa") for n in range(900)]
    model = language.fit(documents([(i, *row) for i, row in enumerate(rows)]), sample_per_language=20)
    assert model.languages == ["aa", "bb"] and (model.owners == 0).sum() == 6
    got = predicted(llm, model, [text("aa"), text("bb")])
    assert [g[0] for g in got] == ["aa", "bb"] and not got[0][2] and not got[1][2]


def test_a_small_sample_still_has_a_text_per_cluster(documents):
    rows = [(i, f"alpha beta {'abcdefghij'[i % 10]} gamma {'klmnopqrst'[i // 10]} delta", "aa") for i in range(100)]
    model = language.fit(documents(rows), clusters=6, sample_per_language=1)
    assert len(model.centroids) == 6
