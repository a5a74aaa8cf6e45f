"""Quality verdicts of labels beyond the four listed languages."""

import random

from evtlens.llm import quality

ITALIAN = "il di che è la per un in non sono gli con ma come anche lo più della nel questo".split()
ENGLISH = quality.COMMON_WORDS["en"]


def text(rng, common, stems, n=200):
    return " ".join(rng.choice(common) if rng.random() < 0.4 else rng.choice(stems) + rng.choice(stems) for _ in range(n))


def test_quality_labels_have_their_references(spark):
    rng = random.Random(6)
    stems = ["ma", "re", "sto", "ne", "li", "ghi", "do", "ver", "ca", "pi", "tu", "fo"]
    rows = [(i, text(rng, ENGLISH, stems), "en") for i in range(30)]
    rows += [(100 + i, text(rng, ITALIAN, stems), "it") for i in range(30)]
    rows += [(200, text(rng, ITALIAN, stems), None), (201, text(rng, ITALIAN, stems), "en")]
    rows += [(202, " ".join(rng.choice(stems) * 2 + rng.choice(stems) + rng.choice(stems) for _ in range(200)), "it")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r["doc_id"]: r for r in quality.judged(df).collect()}
    assert not any(r["base_failed"] for r in out.values())
    assert all(out[i]["kept"] for i in range(30))
    assert all(out[100 + i]["kept"] and out[100 + i]["word_distance"] < 0.3 for i in range(30))
    assert out[200]["kept"] and out[200]["word_distance"] is None
    assert not out[201]["kept"]                                # labelled as English without its words
    assert not out[202]["kept"] and out[202]["word_distance"] > 0.3

    four = {r["doc_id"]: r for r in quality.judged(df.where("lang = 'en'")).collect()}
    assert all(four[d]["word_distance"] == out[d]["word_distance"] for d in four)


def test_quality_many_labels(spark):
    """Four hundred labels are rows of a table, not literals of the plan; the verdicts of one don't move the others'."""
    import time
    rng = random.Random(7)
    stems = ["ma", "re", "sto", "ne", "li", "ghi", "do", "ver", "ca", "pi", "tu", "fo"]
    rows = [(i, text(rng, ENGLISH, stems), "en") for i in range(20)] + [(100 + i, text(rng, ITALIAN, stems), "it") for i in range(20)]
    few = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    begin = time.time()
    want = {r["doc_id"]: (r["kept"], r["word_distance"], r["class_distance"]) for r in quality.judged(few).collect()}
    first = time.time() - begin
    more = rows + [(1000 + i, text(rng, [f"{c}{i % 400}" for c in "abcdefgh"], stems, 60), f"l{i % 400}") for i in range(800)]
    df = spark.createDataFrame(more, "doc_id long, text string, lang string").repartition(4)
    begin = time.time()
    got = {r["doc_id"]: (r["kept"], r["word_distance"]) for r in quality.judged(df).collect()}
    assert time.time() - begin < 20 + 3 * first
    assert all(got[d][1] == w[1] for d, w in want.items()) and all(got[1000 + i][0] for i in range(800))


def test_quality_own_distances_equal_plain_version(spark):
    import math
    from collections import Counter
    rng = random.Random(8)
    stems = ["ma", "re", "sto", "ne", "li", "ghi", "do"]
    rows = [(i, text(rng, ITALIAN, stems, rng.randint(60, 200)), "it") for i in range(25)]
    out = {r["doc_id"]: r["word_distance"] for r in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string"),
                                                                    min_words_judged=50).collect()}
    share = {d: {w: n / len(t.split()) for w, n in Counter(t.split()).items()} for d, t, _ in rows}
    total = Counter()
    for s in share.values():
        total.update(s)
    words = [w for w, _ in sorted(total.items(), key=lambda x: (-round(x[1], 6), x[0]))][:quality.OWN_WORDS]
    ref = {w: round(sum(s.get(w, 0) for s in share.values()) / len(rows), 6) for w in words}

    def term(p, q):
        return sum(x * math.log2(2 * x / (x + y)) for x, y in ((p, q), (q, p)) if x > 0)

    for d, s in share.items():
        d2 = sum(term(s.get(w, 0), ref[w]) for w in words) + term(max(0, 1 - sum(s.get(w, 0) for w in words)), max(0, 1 - sum(ref.values())))
        assert abs(out[d] - math.sqrt(max(d2 / 2, 0))) < 1e-6
