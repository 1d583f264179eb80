"""The permutation, and an exact round trip through the shards."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearwell.llm import training_order as to
from clearwell.llm.tokenizing import encoder
from clearwell.session import new_folder


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 4097])
def test_slots_are_a_permutation(n):
    slots = to.permute(np.arange(n), n, 42)
    assert sorted(slots.tolist()) == list(range(n))


def test_the_key_matters_and_order_is_mixed():
    first, second = (to.permute(np.arange(5000), 5000, key) for key in (1, 2))
    assert (first != second).mean() > 0.99
    assert abs(np.corrcoef(first, np.arange(5000))[0, 1]) < 0.05


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_documents_come_back_from_the_shards(documents, llm, file, tmp_path):
    rows = [(i, f"word{i} " * (i % 40), "en", "a") for i in range(200)]
    rows += [(7, "repeated row"), (7, "repeated row"), (None, "no key"), (300, None), (301, ""), (302, "ß" * 30_000)]
    documents(rows).write.parquet(str(tmp_path / "docs"))
    docs = llm.read.parquet(str(tmp_path / "docs"))
    path = str(tmp_path / "shards")
    manifest = to.training_order(docs, path, file=file, length=16, per_shard=32).collect()
    assert {r["path"] for r in manifest} == {path}
    encode = encoder(file)
    end = to.vocabulary(file)[1]

    # Every slot is there once, in shards of full strides; only the last sequence of a task is not full.
    stored = {
        r["shard"] * 32 + r["place"]: r["tokens"]
        for r in to.read_shards(llm, path, 16, 2).collect()
    }
    tokens = sum(len(ids) + 1 for _, text, *_ in rows if (ids := encode(text or "")))
    assert sorted(stored) == list(range(len(stored))) and sum(map(len, stored.values())) == tokens
    assert sum(len(ids) < 16 for ids in stored.values()) <= docs.rdd.getNumPartitions()

    # Pieces read at their byte offset give the documents, each followed by an end.
    whole = {f.parent.name: f.read_bytes() for f in (tmp_path / "shards").glob("shard=*/part-*")}
    pieces = {}
    for r in manifest:
        at = np.frombuffer(whole[f"shard={r['shard']}"], dtype="<u2", count=r["n_tokens"], offset=r["byte_offset"])
        pieces.setdefault(r["doc_id"], []).append((r["seq_no"], at.tolist(), r["slot"]))
        shard, start = to.locate(r["slot"], 16, 2, 32)
        assert shard == r["shard"] and start < r["byte_offset"] < start + 2 * 18
    for doc_id in {i for i, *_ in rows}:
        wanted = [encode(t or "") for i, t, *_ in rows if i == doc_id]
        found = sorted(pieces.get(doc_id, []))
        if len(wanted) == 1:
            assert [n for n, *_ in found] == list(range(len(found)))
            assert [x for _, ids, _ in found for x in ids] == wanted[0]
        else:
            assert sorted(x for _, ids, _ in found for x in ids) == sorted(x for ids in wanted for x in ids)
    (last,) = [p for p in pieces[302] if p[0] == max(n for n, *_ in pieces[302])]
    after = stored[last[2]]
    assert after[-1] == end or end in after

    resumed = to.read_shards(llm, path, 16, 2, first_shard=2)
    assert resumed.agg(F.min("shard")).first()[0] == 2


def test_sequences_do_not_depend_on_how_documents_arrive():
    documents = [(i, list(range(i * 50, i * 50 + i % 23))) for i in range(40)]
    whole, parts = (to._Stream(16, np.dtype("<u2"), 9) for _ in range(2))
    one = [*whole.add(documents), *whole.rest()]
    two = [found for i in range(0, 40, 3) for found in parts.add(documents[i : i + 3])] + parts.rest()
    plain = lambda found: [(ids.tolist(), of) for ids, of in found]
    assert plain(one) == plain(two)
    for ids, of in one:
        for piece in of:
            known = dict(documents)[piece["key"]]
            assert len(ids) <= 16 and set(ids[piece["at"] : piece["at"] + piece["n"]].tolist()) <= set(known)


def test_tokens_are_encoded_once_and_the_staged_table_goes(documents, llm):
    from clearwell import session

    before = list(session._staged)
    manifest = to.training_order(documents([(i, f"some words {i}") for i in range(50)]), length=16)
    left = [p for p in session._staged if p not in before]
    assert ["training-manifest" in p for p in left] == [True]
    assert manifest.count() >= 50 and manifest.select("path").distinct().count() == 1


def test_workers_get_few_texts_and_blocks_at_a_time(documents, llm, monkeypatch):
    name, met = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = llm.conf.get(name)
    for step in ("_encode", "_write"):
        whole = getattr(to, step)
        monkeypatch.setattr(to, step, lambda *of, whole=whole: met.append(int(llm.conf.get(name))) or whole(*of))
    assert to.training_order(documents([(i, f"some words {i}") for i in range(50)]), length=16).count() >= 50
    assert met == [to.TEXTS, to.PACKS] and llm.conf.get(name) == before


def test_empty_table(documents, llm):
    assert to.training_order(documents([]), new_folder(llm, "none")).collect() == []
    assert to.training_order(documents([(1, None), (2, "")])).collect() == []
    named = documents([(1, "a b")]).withColumn("doc_id", F.lit("one"))
    assert to.training_order(named).first()["doc_id"] == "one"
