"""The pipeline's stages one after the other, each against what it must keep."""

from __future__ import annotations

import random
from collections import Counter
from pathlib import Path

import corpus_pipeline
from __spark_entry__ import queries
from clearwell.session import shared_folder


def test_registered():
    names = set(queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}


def test_stages(llm, tmp_path):
    r = random.Random(7)
    syllables = ["the", "re", "on", "ti", "ha", "st", "ea", "in", "or", "le"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randrange(1, 5)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, text(120), "en", f"s{i % 3}") for i in range(90)]
    item = text(30)
    copy = rows[5][1]
    near = copy.split()
    near[60] = "changed"
    rows += [
        (100, copy, "en", "s0"), (101, " ".join(near), "en", "s1"), (102, rows[6][1], "en", None),
        (103, f"{text(40)} {item} {text(40)}", "en", "s2"), (104, "这是中文文本" * 40, None, "s0"),
        (105, None, "en", "s0"), (106, "12345 --- 678", "en", "s1"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    llm.createDataFrame([(*row, len(row[1] or "")) for row in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    llm.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs = llm.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, function in corpus_pipeline.STAGES:
        out = function(llm, docs, str(tmp_path))
        out.write.parquet(path := f"{tmp_path}/{name.replace(' ', '-')}")
        docs = llm.read.parquet(path)
        kept[name] = Counter(r["doc_id"] for r in docs.select("doc_id").collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    clean = set(range(90))
    assert set(kept["language ID"]) == clean | {100, 101, 102, 103}
    assert set(kept["MinHash near-dedup"]) == clean | {103}
    assert set(kept["benchmark decontamination"]) == clean
    assert set(kept["mixing sources"]) <= clean and max(kept["mixing sources"].values()) == 2
    assert set(kept["token-ID output"]) == set(kept["mixing sources"])
    slots = {r["slot"] for r in docs.select("slot").collect()}
    assert slots == set(range(len(slots)))
    assert len({r["path"] for r in docs.select("path").collect()}) == 1


def test_run_leaves_its_result_and_the_shards(llm):
    shared = Path(shared_folder(llm))
    before = {p.name for p in shared.iterdir()}
    result = corpus_pipeline.run(llm, "/root/testdata/sf0.001")
    assert result.count() > 0 and Path(result.first()["path"]).is_dir()
    left = sorted(p.name.rsplit("-", 1)[0] for p in shared.iterdir() if p.name not in before)
    assert left == ["token-id-output", "training-order"]
