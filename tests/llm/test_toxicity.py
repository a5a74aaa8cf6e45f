"""The classifier on held-out texts, its layers against plain loops, odd input."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from evtlens.llm import queries
from evtlens.llm import toxicity as tx

RUDE = ["vermin", "brute", "wretch"]


def corpus(n=600, seed=4, rude=RUDE):
    rng = random.Random(seed)
    words = {"en": [f"en{i}" for i in range(150)], "fr": [f"fr{i}" for i in range(150)]}
    words = {k: [w.replace("0", "o").replace("1", "i").replace("2", "z").replace("3", "e").replace("4", "a").replace("5", "s")
                 .replace("6", "g").replace("7", "t").replace("8", "b").replace("9", "q") for w in v] for k, v in words.items()}
    out = []
    for i in range(n):
        lang = rng.choice(["en", "fr"])
        text = [rng.choice(words[lang]) for _ in range(rng.randint(10, 120))]
        bad = rng.random() < 0.3
        if bad:
            for _ in range(rng.randint(1, 3)):
                w = rng.choice(rude)
                text.insert(rng.randrange(len(text)), rng.choice([w, w.upper() + "!!", w + "###"]))
        out.append((i, " ".join(text), int(bad), lang))
    return out


@pytest.fixture(scope="module")
def model():
    rows = corpus()
    return tx.fit([(t, y, lang) for _, t, y, lang in rows], (0.7, 0.3))


def predicted(model, texts):
    row = {b: i for i, b in enumerate(model.buckets.tolist(), 1)}
    return tx.scores(model, [np.array([row.get(h, 0) for h in tx.hashed(t)], np.int64) for t in texts])


def test_held_out_accuracy(model):
    held = corpus(400, seed=9)
    s = predicted(model, [t for _, t, _, _ in held])
    y = np.array([r[2] for r in held])
    assert ((s >= 0.5) == y)[y == 1].mean() > 0.95 and ((s >= 0.5) == y)[y == 0].mean() > 0.95
    assert set(model.languages) == {"en", "fr"} and set(model.thresholds) == {"en", "fr"}
    assert s.min() >= 0 and s.max() <= 1


def plain_pooled(model, doc):
    filters = len(model.out) // len(tx.WIDTHS)
    n = max(len(doc), 1)
    padded = list(doc) + [0] * (n - len(doc) + tx.PAD)
    top = []
    for w in tx.WIDTHS:
        for f in range(filters):
            top.append(max(0, max(sum(model.tables[w, j][padded[p + j]][f] for j in range(w)) + model.bias[w][f] for p in range(n))))
    return top, sum((model.language_table[x] for x in doc), np.zeros(len(model.languages)))


def test_layers_equal_plain_loops(model, monkeypatch):
    rng = random.Random(2)
    docs = [np.array([rng.randrange(len(model.buckets) + 1) for _ in range(n)], np.int64) for n in [0, 1, 2, 3, 40, 0, 7, 130, 1]]
    want = [plain_pooled(model, d.tolist()) for d in docs]
    for chunk in (1 << 17, 50, 8, 3):              # texts longer than a chunk are taken in overlapping pieces
        monkeypatch.setattr(tx, "CHUNK", chunk)
        top, lang = tx.pooled(model, docs)
        assert np.allclose(top, [t for t, _ in want], atol=1e-4)
        assert np.allclose(lang, [x for _, x in want], atol=1e-6)


def test_one_word_marks_a_very_long_text(model):
    rng = random.Random(3)
    clean = [t for _, t, y, _ in corpus(300, seed=12) if not y]
    text = " ".join(rng.choice(clean) for _ in range(4000))            # whole texts count, not a prefix
    a, b = predicted(model, [text, text + " vermin"])
    assert len(text) > 500_000 and a < 0.5 <= b


def test_threshold_ties_and_weights():
    logit, y = np.array([3.0, 2.0, 2.0, 1.0]), np.array([1, 1, 0, 0])
    assert 1 < tx.best_threshold(logit, y, np.ones(4)) < 2              # both rows of the tie, or none
    assert 2 < tx.best_threshold(logit, y, np.array([1, 1, 50, 1])) < 3


def test_query_reads_no_held_out_label(spark, tmp_path):
    rows = corpus(500)
    docs = spark.createDataFrame([(i, t, lang, "s", len(t)) for i, t, _, lang in rows]
                                 + [(None, "vermin", None, None, 1), (9000, None, "en", "s", 0), (9001, "", None, None, 0), (3, rows[3][1], "en", "s", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.withColumns({c: F.lit(c) for c in ("key", "y", "draw", "score", "toxic")}).write.parquet(f"{tmp_path}/a/documents.parquet")
    marks = spark.createDataFrame([(i, 1, y) for i, _, y, _ in rows] + [(None, 1, 1), (1, None, None), (2, 0, 7)], "doc_id long, quality int, toxic int")
    marks.write.parquet(f"{tmp_path}/a/labels.parquet")
    first = {r["doc_id"]: r for r in queries.op13_toxicity(spark, f"{tmp_path}/a").collect()}
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    marks.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic"))).write.parquet(f"{tmp_path}/b/labels.parquet")
    docs.withColumns({"lang": F.when(held, F.lit("xx")).otherwise(F.col("lang")), "source": F.lit("z")}).write.parquet(f"{tmp_path}/b/documents.parquet")
    again = {r["doc_id"]: r for r in queries.op13_toxicity(spark, f"{tmp_path}/b").collect()}
    assert first == again and len(first) == 503
    y = {i: v for i, _, v, _ in rows}
    tested = [r for i, r in first.items() if i in y and r["held_out"]]
    assert len(tested) > 60 and sum(r["predicted"] == y[r["doc_id"]] for r in tested) > 0.9 * len(tested)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in first.values())
    assert not first[None]["held_out"] and first[9000]["score"] == first[9001]["score"]


def test_sample_is_bounded(spark):
    rows = corpus(300)
    docs = spark.createDataFrame([(i, t, lang) for i, t, _, lang in rows] * 2 + [(300, "x " * 5000, "en")], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, y) for i, _, y, _ in rows] * 3 + [(300, 1)], "doc_id long, toxic int")
    got, shares = tx.sample(docs, marks, per_label=40, max_chars=5000)
    of = [y for _, y, _ in got]                     # the long text may be among the drawn, and is left out
    assert of.count(0) == 40 and of.count(1) in (39, 40) and abs(sum(shares) - 1) < 1e-9
    few, _ = tx.sample(docs, marks, per_label=40, max_chars=5000, sample_chars=8000)
    assert 0 < sum(len(t) for t, _, _ in few) <= 8000
    assert {t for t, _, _ in few} <= {t for t, _, _ in got}


def test_odd_input(spark, odd_docs, no_docs, model):
    assert tx.score(odd_docs, model).count() == odd_docs.count()
    assert tx.score(no_docs, model).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert tx.train(no_docs, none) is None and tx.train(odd_docs, none) is None
    assert {r["score"] for r in tx.score(odd_docs, None).collect()} == {0.0}
    assert tx.fit([("a b", 0, None)] * 20 + [("c d", 1, None)] * 4) is None
    same = tx.fit([("a b c", 0, None)] * 20 + [("d e f", 1, None)] * 20)       # copies only: nothing to keep apart
    assert predicted(same, ["d e f"])[0] >= 0.5 > predicted(same, ["a b c"])[0]


def _corpus_tables(spark, rows):
    return (spark.createDataFrame([(i, t, lang) for i, t, _, lang in rows], "doc_id long, text string, lang string"),
            spark.createDataFrame([(i, y) for i, _, y, _ in rows], "doc_id long, toxic int"))


def test_every_labelled_text_is_learnt_from(spark):
    """Long ones too: the word that marks them occurs in no text below 200,000 characters."""
    rng = random.Random(5)
    clean = [t for _, t, y, _ in corpus(400, seed=6) if not y]
    rows = [(i, t, 0, "en") for i, t in enumerate(clean[:100])]
    for i in range(100, 112):
        words = " ".join(rng.choice(clean) for _ in range(700)).split()
        words.insert(rng.randrange(len(words)), "zorblat")
        rows.append((i, " ".join(words), 1, "en"))
    assert min(len(t) for _, t, y, _ in rows if y) > 200_000
    model = tx.train(*_corpus_tables(spark, rows))
    assert tx.hashed("zorblat")[0] in model.buckets
    assert (predicted(model, [t for _, t, y, _ in rows if y]) >= 0.5).all() and (predicted(model, clean[150:200]) < 0.5).all()


def test_training_in_parts_takes_all_texts_and_is_as_good(spark):
    rows = corpus(1500)
    docs, marks = _corpus_tables(spark, rows)
    texts = tx.labelled(docs, marks)
    got = texts.collect()
    assert {r["key"] for r in got} == set(range(1500)) and len(got) == 1500
    assert all(r["words"] == tx.hashed(rows[r["key"]][1]) and r["kept"] == tx.apart(rows[r["key"]][1].encode()) for r in got)
    buckets = np.unique(np.concatenate([r["words"] for r in got])).astype(np.int64)
    dealt = spark.read.parquet(tx._dealt(texts, buckets, ["en", "fr"], True, 3, 4)).collect()
    assert sorted((r["y"], len(r["words"])) for r in dealt) == sorted((r["y"], len(r["words"])) for r in got)
    assert {r["turn"] for r in dealt} == {-1, 0, 1, 2} and all(r["part"] // 4 == r["turn"] for r in dealt if r["turn"] >= 0)
    one, two = (tx.train(docs, marks, part_docs=100, wide=4) for _ in range(2))
    held = corpus(400, seed=9)
    s, y = predicted(one, [t for _, t, _, _ in held]), np.array([r[2] for r in held])
    assert ((s >= 0.5) == y)[y == 1].mean() > 0.95 and ((s >= 0.5) == y)[y == 0].mean() > 0.95
    assert (s == predicted(two, [t for _, t, _, _ in held])).all()               # the order in which tasks end doesn't count


def test_average_of_parts():
    net, rng = tx.Net(3, 2, 2, 0.1, np.random.default_rng(1)), np.random.default_rng(2)
    before, parts = net.emb.copy(), []
    for texts, moved in ((30, [0, 1, 0, 3]), (10, [0, 0, 0, 1])):
        emb = rng.standard_normal((4, 2)).astype(np.float32)
        mine = tx.Net(3, 2, 2, 0.1, rng)
        mine.emb, mine.gathered = emb, np.arange(4, dtype=np.float32) * texts
        parts.append(mine.changed(np.array(moved), texts))
    net.average(parts)
    assert (net.emb[2] == before[2]).all() and (net.emb[0] == 0).all()
    assert np.allclose(net.emb[1], parts[0]["emb"][0])                            # moved by one part only: not diluted
    assert np.allclose(net.emb[3], (3 * parts[0]["emb"][1] + parts[1]["emb"][0]) / 4) and np.isclose(net.gathered[3], (3 * 90 + 30) / 4)
    assert np.allclose(net.dense["v"], 0.75 * parts[0]["dense"]["v"] + 0.25 * parts[1]["dense"]["v"])


def test_long_texts_are_learnt_in_pieces(monkeypatch):
    docs = [np.random.default_rng(7).integers(0, 40, 90)]
    net = tx.Net(39, 4, 3, 0.5, np.random.default_rng(3))
    whole = net.spots(*tx.laid_out(docs))
    monkeypatch.setattr(tx, "CHUNK", 8)
    for (_, a), (_, b) in zip(whole, net.spots(*tx.laid_out(docs)), strict=True):
        assert np.allclose(a, b)
