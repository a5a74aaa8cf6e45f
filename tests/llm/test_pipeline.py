"""The pipeline against a plain version, stage by stage."""

import pytest
from pyspark.sql import functions as F

from evtlens.llm import mixing
from evtlens.llm.common import DOC_COLUMNS, written

from . import brute

corpus_pipeline = pytest.importorskip("corpus_pipeline")
STAGES = dict(corpus_pipeline.STAGES)


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "mixing", "packing"]


def test_stages_take_effect(spark, docs, rows):
    first = written(STAGES["quality_rules"](spark, docs, ""), "t-quality")
    bad = {d for d, v in brute.op6([(d, t) for d, t, *_ in rows]).items() if v[-1]}
    kept = {r["doc_id"]: r["text"] for r in first.collect()}
    assert not bad & kept.keys() and first.columns == DOC_COLUMNS

    second = written(STAGES["line_dedup"](spark, first, ""), "t-lines")
    want = brute.op10(sorted(kept.items()))
    lines = {r["doc_id"]: r for r in second.collect()}
    assert {d: r["text"] for d, r in lines.items()} == {d: w[3] for d, w in want.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in lines.values())

    third = written(STAGES["simhash_near_dedup"](spark, second, ""), "t-simhash")
    groups = brute.op9([(d, r["text"]) for d, r in sorted(lines.items())])
    assert sorted(r["doc_id"] for r in third.collect()) == sorted({c for *_, c in groups})

    fourth = written(STAGES["mixing"](spark, third, ""), "t-mix")
    want_copies = {r["doc_id"]: r["copies"] for r in mixing.mix(third).collect() if r["copies"]}
    got_copies = {r["doc_id"]: r["count"] for r in fourth.groupBy("doc_id").count().collect()}
    assert got_copies == want_copies and fourth.columns == DOC_COLUMNS

    pieces = STAGES["packing"](spark, fourth, "").collect()
    assert sum(p["length"] for p in pieces if p["start"] == 0) <= sum(p["length"] for p in pieces)
    per_doc = {}
    for p in pieces:
        per_doc[p["doc_id"]] = per_doc.get(p["doc_id"], 0) + p["length"]
    tokens = {p["doc_id"]: p["doc_tokens"] for p in pieces}
    assert per_doc == {d: tokens[d] * n for d, n in got_copies.items()}


def test_stages_on_odd_input(spark, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd_docs, "")
        assert out.count() >= 0
        if name != "packing":
            assert out.columns == DOC_COLUMNS
        assert stage(spark, no_docs, "").count() == 0


def test_clean_documents_pass_quality(spark):
    good = "the house of the river and a table in the wind was green for that is it as with stone cloud glass paper"
    import random
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(good.split()) + rng.choice(["", "", "s"]) + (f"{rng.choice('abcdefgh')}" if rng.random() < .5 else "")
                         for _ in range(150)), "en", "s", 1) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = STAGES["quality_rules"](spark, df, "")
    failed = {d for d, v in brute.op6([(r[0], r[1]) for r in rows]).items() if v[-1]}
    assert out.count() == 40 - len(failed) and len(failed) < 5
    assert out.where(F.col("text").isNull()).count() == 0
