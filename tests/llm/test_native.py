"""Mixing, fingerprints, quality rules and line dedup against plain versions."""

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from evtlens.llm import line_dedup, merkle, mixing, quality

from . import brute


def test_mixing_targets_and_takes(docs, rows):
    out = mixing.mix(docs).collect()
    sizes, docs_of = defaultdict(int), defaultdict(list)
    for d, t, _, s, _ in rows:
        n = len(brute.words(t))
        sizes[s] += n
        docs_of[s].append(n)
    weights = dict(zip([*sorted(s for s in sizes if s), None], [3, 1, 2, 3]))
    want = brute.water_fill(sizes, weights)
    assert len(out) == len(rows)
    taken = defaultdict(int)
    for r in out:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6
        assert r["size"] == len(brute.words(r["text"])) and r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert want[s] - max(docs_of[s]) <= taken[s] <= want[s] + 1e-6
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in out)
    assert mixing.repeated(mixing.mix(docs)).count() == sum(r["copies"] for r in out)


def test_water_level_clamps_and_reshares(spark):
    df = spark.createDataFrame([(10.0, 3.0), (100.0, 1.0), (1000.0, 2.0)], "clamp double, weight double")
    level = mixing.water_level(df, 400.0)
    assert abs(sum(min(c, level * w) for c, w in [(10, 3), (100, 1), (1000, 2)]) - 400) < 1e-9
    assert mixing.water_level(df, 2000.0) == float("inf")


def test_mixing_odd_input(odd_docs, no_docs):
    out = mixing.mix(odd_docs)
    assert out.count() == odd_docs.count()
    assert set(odd_docs.columns) <= set(out.columns)
    assert mixing.mix(no_docs).count() == 0


def test_quality_counts(docs, rows):
    got = {r["doc_id"]: r for r in quality.judged(docs).drop("text").collect()}
    for d, want in brute.op6([(d, t) for d, t, *_ in rows]).items():
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want
        assert not (r["base_failed"] and r["kept"])


def test_quality_verdict_by_divergence(spark):
    good = "the house of the river and a table in the wind was green for that is it as with "
    rows = [(i, (good + f"stone{i} cloud ") * 8 + "\n" + " ".join(f"w{i}x{j}" for j in range(80)), "en") for i in range(30)]
    rows += [(100, " ".join(f"x{i}###" for i in range(200)), "en"),
             (101, " ".join("qwert" + chr(97 + i % 26) + chr(97 + i // 26) for i in range(300)), "en")]
    rows = [(d, t if d >= 100 else " ".join(sorted(t.split(), key=lambda w: hashlib.md5(f"{w}{d}".encode()).digest())), lang)
            for d, t, lang in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r["doc_id"]: r for r in quality.judged(df, max_repeat_percent=100).collect()}
    assert out[100]["class_distance"] > 0.28 and not out[100]["kept"]
    assert out[101]["word_distance"] > 0.3 and not out[101]["kept"]
    assert all(out[i]["kept"] for i in range(30))


def test_quality_odd_input(odd_docs, no_docs):
    out = quality.judged(odd_docs)
    assert out.count() == odd_docs.count()
    assert out.where("text is null and (kept or n_words > 0)").count() == 0
    assert quality.judged(no_docs).count() == 0


def test_merkle(docs, rows):
    got = {r["doc_id"]: r for r in merkle.compared(docs, rows_per_block=10).collect()}
    texts = {d: t or "" for d, t, *_ in rows}
    for d, (n, edited, following) in brute.op3([(d, t) for d, t, *_ in rows]).items():
        r = got[d]
        assert r["n_chars"] == n and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r["near_edited"] - brute.likeness(texts[d], edited)) < 1e-12
        assert abs(r["near_next"] - brute.likeness(texts[d], following)) < 1e-12
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (texts[d] == edited)
    assert got[5]["fingerprint"] == got[20]["fingerprint"] != got[6]["fingerprint"]


def test_merkle_likeness_without_clause_marks(spark):
    """Half-edited texts without spaces or marks share half their leaves; leaf cuts lose no character."""
    import random
    rng = random.Random(3)
    plain = "".join(chr(rng.randrange(0x4e00, 0x9fa0)) for _ in range(4000))
    marked = "".join(chr(rng.randrange(0x4e00, 0x9fa0)) + ("。" if i % 17 == 0 else "，" if i % 11 == 0 else "") for i in range(3000))
    other = "".join(chr(rng.randrange(0x0e01, 0x0e2f)) for _ in range(4000))
    rows = [(1, plain), (2, other), (3, plain[::-1]), (4, marked), (5, "a" * 121), (6, "a" * 120), (7, "x" * 119 + ". y"), (8, "x" * 119 + ".y"), (9, "")]
    got = {r["doc_id"]: r for r in merkle.compared(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [d for d in (1, 2, 4) if got[d]["near_edited"] <= 0.4 or got[d]["near_next"] >= 0.1] == [], {
        d: (got[d]["near_edited"], got[d]["near_next"]) for d in (1, 2, 4)}
    assert len({r["fingerprint"] for r in got.values()}) == len(rows)
    for d, t in rows:
        edited, after = brute.op3(rows)[d][1:]
        assert abs(got[d]["near_edited"] - brute.likeness(t, edited)) < 1e-12
        assert abs(got[d]["near_next"] - brute.likeness(t, after)) < 1e-12


def test_merkle_locates_edits(spark):
    text = "\n".join(f"Line {i} has some words, and a clause." for i in range(30))
    new = text.replace("Line 17 has", "Line 17 had")
    df = spark.createDataFrame([(text, new), (text, text)], "x string, y string").select(
        merkle.fingerprint(F.col("x")).alias("old"), merkle.fingerprint(F.col("y")).alias("new"))
    rows = merkle.locate(df).collect()
    assert {r["side"] for r in rows} == {"old", "new"} and len(rows) == 2


def test_merkle_odd_input(spark, odd_docs, no_docs, rows):
    out = merkle.compared(odd_docs, rows_per_block=3)
    assert out.count() == odd_docs.count()
    assert merkle.compared(no_docs).count() == 0
    one = spark.createDataFrame([(1, "alone. here")], "doc_id long, text string")
    assert merkle.compared(one).first()["near_next"] == 1.0
    # one id has most rows: blocks are cut by the text hash, and the order is a total one
    same = spark.createDataFrame([(None if i % 3 else i, f"text {i}") for i in range(300)], "doc_id long, text string")
    pairs = merkle.with_next(same, rows_per_block=4).collect()
    assert len(pairs) == 300 and sorted(r["text"] for r in pairs) == sorted(r["next_text"] for r in pairs)


def same_lines(df, rows, **given):
    got = {r["doc_id"]: (r["n_lines"], r["n_removed_lines"], r["n_runs"], r["kept_text"])
           for r in line_dedup.deduplicated(df, **given).collect()}
    want = brute.op10(rows, **given)
    assert got == want
    return want


def test_line_dedup(spark, docs, rows):
    same_lines(docs, [(d, t) for d, t, *_ in rows])
    same_lines(docs, [(d, t) for d, t, *_ in rows], min_words=5)
    for n in (1, 25):
        same_lines(docs, [(d, t) for d, t, *_ in rows], min_words=n)


def test_line_dedup_repeated_line_verse_and_short_documents(spark):
    def frame(rows):
        return spark.createDataFrame(rows, "doc_id long, text string").repartition(2)

    line = " ".join(f"w{i}" for i in range(60))                        # one long line in three documents
    rows = [(i, f"a{i} b\n{line}\nc{i} d") for i in range(3)]
    want = same_lines(frame(rows), rows)
    assert [w[1] for w in want.values()] == [0, 1, 1]
    verse = "\n".join(f"v{i % 9} x{i}" for i in range(100))             # a hundred short lines, twice
    rows = [(1, verse), (2, verse), (3, "head\n" + verse.split("\n", 90)[-1]), (4, line), (5, line)]
    want = same_lines(frame(rows), rows)
    assert [want[d][1] for d in (1, 2, 3, 4, 5)] == [0, 100, 10, 0, 1]
    short = "\n".join("a b c d".split())                              # too few words, however often
    rows = [(1, short), (2, short), (3, short + "\n" + short + "\n" + short + "\nx"), (4, "\n" + short * 4)]
    assert [w[1] for w in same_lines(frame(rows), rows).values()] == [0, 0, 0, 0]


def test_line_dedup_random_lines(spark):
    """Few different lines of zero to six words, so runs of all lengths repeat, touch and overlap."""
    import random
    rng = random.Random(8)
    pool = [" ".join(rng.choice("abcdefg") for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 6]))) for _ in range(14)] + ["", " ", "\r"]
    rows = []
    for d in range(120):
        if rows and rng.random() < 0.3:
            lines = rng.choice(rows)[1].split("\n")
            at = rng.randrange(len(lines) + 1)
            lines = lines[at // 2:at] + [rng.choice(pool)] + lines[at:]
        else:
            lines = [rng.choice(pool) for _ in range(rng.randint(0, 25))]
        rows.append((d, "\n".join(lines)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for n in (12, 7, 3):
        assert sum(w[1] for w in same_lines(df, rows, min_words=n).values()) > 20


def test_line_dedup_odd_input(odd_docs, no_docs):
    out = line_dedup.deduplicated(odd_docs)
    assert out.count() == odd_docs.count()
    assert out.where("text is null and kept_text is not null").count() == 0
    # rows equal in id and text keep the same lines
    twice = out.where("doc_id < 5").groupBy("doc_id").agg(F.countDistinct(F.coalesce("kept_text", F.lit(""))).alias("n"))
    assert twice.where("n > 1").count() == 0
    assert line_dedup.deduplicated(no_docs).count() == 0
