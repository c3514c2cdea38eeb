"""The pipeline on the smallest tables, stage by stage against plain checks."""

import re
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from floodledger.llm import mixing, packing
from floodledger.llm.store import cut

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [shingles(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing", "token_packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        after = cut(stage(spark, docs, SF), name)
        if name != "token_packing":
            assert after.columns == corpus_pipeline.COLUMNS
            rows = {r.doc_id: r.text for r in after.collect()}
            assert rows.items() <= before.items() and after.count() == len(rows)
        gone = set(before) - set(rows)
        if name == "quality_classifier":
            known = [d for d in before if d in labels]
            assert sum((d in rows) == (labels[d] == 1) for d in known) >= 0.97 * len(known)
        elif name == "ngram_jaccard_join":
            sets = {d: shingles(t) for d, t in before.items()}
            near = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
            assert not any(near(a, b) for a in rows for b in rows if a < b and sets[a])
            assert all(any(near(d, e) for e in before if e < d) for d in gone)
        elif name == "benchmark_decontamination":
            assert gone == {d for d, t in before.items() if any(i and len(i & shingles(t)) >= 0.8 * len(i) for i in items)}
        elif name == "source_mixing":
            assert not gone
        else:
            assert {d for r in after.collect() for d in r.doc_ids} == set(before)
        docs = after


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns[:2] == ["pack_id", "ids"] and out.count() > 0
    assert np.frombuffer(out.first().ids, "<u2").size == 2048
    assert packing.SCHEMA.startswith("pack_id long")


def test_packs_follow_the_mixture_over_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mixing, "STRETCH_ROWS", 64)
    docs = spark.range(900).selectExpr("id AS doc_id", "repeat(concat('text ', id, ' '), cast(1 + id % 400 as int)) AS text", "'en' AS lang", "IF(id % 9 = 0, 'small', 'large') AS source", "10L AS n_chars")
    place = {r.doc_id: r.position for r in mixing.mix_sources(docs).collect()}
    for i in range(7):  # what mixing leaves, in files of several sizes
        mixing.in_mixed_order(docs).where(f"doc_id % 28 BETWEEN {i * (i + 1) // 2} AND {(i + 1) * (i + 2) // 2 - 1}").coalesce(1).write.mode("append").parquet(str(tmp_path / "mixed"))
    packs = sorted(corpus_pipeline.tokens(spark, spark.read.parquet(str(tmp_path / "mixed")), SF).collect(), key=lambda r: r.pack_id)
    assert len({r.pack_id for r in packs}) == len(packs) and {d for r in packs for d in r.doc_ids} == set(range(900))
    stretches = [{place[d] // 64 for d in r.doc_ids} for r in packs]
    assert all(len(s) == 1 for s in stretches)
    assert [min(s) for s in stretches] == sorted(min(s) for s in stretches)
    firsts = [(min(place[d] for d in r.doc_ids)) for r in packs]
    assert firsts == sorted(firsts)
