"""Exact duplicates against plain Python, also where digests collide and one text holds most rows."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clearwell.llm import exact_duplicates as ed
from clearwell.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[(text or "").translate(LOWER)].append(key)
    out = []
    for content, keys in groups.items():
        known = [k for k in keys if k is not None]
        keep, done = max(known) if known else None, False
        for key in keys:
            kept = key == keep and not done
            done |= kept
            out.append((key, keep, len(keys), kept, hashlib.sha256(content.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(documents, rows, **options):
    got = ed.exact_duplicates(documents(rows), **options).withColumn("digest", F.lower(F.hex("digest")))
    return sorted(map(tuple, got.collect()), key=repr)


ODD = [
    (1, "One text"), (5, "one TEXT"), (3, "one text "), (2, None), (9, ""), (4, " "), (None, "one text"), (7, "Äpfel"),
    (8, "äpfel"), (10, "ÄPFEL"), (11, "Äpfel"), (None, "alone"), (None, "alone"), (12, "İ"), (13, "i̇"),
    (14, "K"), (15, "k"), (16, "x" * 200_000), (17, "X" * 200_000), (18, "x" * 199_999 + "y"), (5, "one text"),
    (6, "twice"), (6, "twice"), (6, "Thrice"), (19, "tab\t"), (20, "tab"),
]


def test_equal_texts_by_full_content(documents):
    assert found(documents, ODD) == plain(ODD)


def test_empty_table(documents):
    assert found(documents, []) == []


@pytest.mark.parametrize("salts", [1, 3, 64])
def test_most_rows_are_copies(documents, salts):
    r = random.Random(3)
    rows = [(i, "The Same Text" if i % 3 else f"text {r.randrange(60)}") for i in range(900)]
    assert found(documents, rows, salts=salts, share=0.05) == plain(rows)


def test_texts_that_share_a_digest_are_told_apart(documents):
    r = random.Random(4)
    rows = ODD + [(100 + i, f"{r.choice('ab')} {r.randrange(9)}") for i in range(200)]
    weak = found(documents, rows, digest=lambda c: F.left(c, F.lit(1)).cast("binary"), share=0.1)
    assert [x[:4] for x in weak] == [x[:4] for x in sorted((y[:4] for y in plain(rows)), key=repr)]


def test_keys_of_other_types(documents):
    rows = [(1, "a"), (2, "A"), (10, "b")]
    named = documents(rows).withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    got = {(x.doc_id, x.keep_id, x.kept) for x in ed.exact_duplicates(named).collect()}
    assert got == {("d1", "d2", False), ("d2", "d2", True), ("d10", "d10", True)}


def test_one_document_of_each_text_stays(documents):
    kept = ed.deduplicate(documents(ODD))
    assert kept.columns == documents(ODD).columns
    texts = [(x.text or "").translate(LOWER) for x in kept.collect()]
    assert len(texts) == len(set(texts)) and set(texts) == {(t or "").translate(LOWER) for _, t in ODD}
    wanted = {(k, s) for k, _, _, is_kept, s in plain(ODD) if is_kept}
    assert {(x.doc_id, hashlib.sha256((x.text or "").translate(LOWER).encode()).hexdigest()) for x in kept.collect()} == wanted


def test_only_built_ins_run(llm, plan_of, monkeypatch):
    plans = []
    stage = ed.stage
    monkeypatch.setattr(ed, "stage", lambda df, label: plans.append(plan_of(df)) or stage(df, label))
    plans.append(plan_of(QUERIES["op12_exact_duplicates"](llm, "/root/testdata/sf0.001")))
    assert len(plans) >= 5
    assert not [p for p in plans for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop") if word in p]
