"""Packing, secret scan, language, WARC, suffix dedup and SimHash against plain versions."""

import base64
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from evtlens.llm import language, packing, secret_scan, simhash, suffix_dedup, warc
from evtlens.llm.components import components

from . import brute

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def test_packing_round_trip(docs, rows):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(TOKENIZER)
    pieces = packing.packed(docs, TOKENIZER, window=64).collect()
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p["key"], []).append(p)
        by_seq.setdefault(p["sequence_id"], []).append(p)
    assert len(by_doc) == len(rows)
    for d, t, *_ in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        got = sorted(by_doc[d], key=lambda p: p["start"])
        assert [x for p in got for x in np.frombuffer(p["ids"], "<u4").tolist()] == ids
        assert all(p["doc_tokens"] == len(ids) and p["length"] * 4 == len(p["ids"]) for p in got)
    full = 0
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        full += at == 64
    assert full >= len(by_seq) - 1
    assert sorted(by_seq) == list(range(len(by_seq)))
    seq = packing.sequences(packing.packed(docs, TOKENIZER, window=64), 64)
    assert seq.where("n_tokens = 64 and padding <> 0").count() == 0


def test_word_encoder_equals_tokenizer():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(TOKENIZER)
    texts = ["a b\x0bc\x1cd", "it's we'll I'M", "  lead  trail ", "x\x1ey", "  ", "é ́x", "<|endoftext|> a<|startoftext|>b",
             "日本語 тест 12345 ١٢", "\x85next line", "ΑΣ ΣΑΣ", "", "İstanbul ŒUVRE ǅ"]
    encode, width, forget = packing.word_tokenizer(TOKENIZER)
    forget()
    for t in [*texts, *texts]:
        assert np.frombuffer(encode(t.encode()), f"<u{width}").tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_word_encoder_where_normal_forms_end_in_marks():
    """Every letter before a stop, and random mixes of marks, zero-width, control and other odd characters."""
    import random

    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(TOKENIZER)
    encode, width, _ = packing.word_tokenizer(TOKENIZER)

    def same(t):
        assert np.frombuffer(encode(t.encode()), f"<u{width}").tolist() == tok.encode(t, add_special_tokens=False).ids, ascii(t)

    same("TARİHİ, İLİ. क़, ड़. ড়.")
    for c in range(0x80, 0x30000):
        if chr(c).isalpha() and (c < 0x3000 or c % 37 == 0):
            same(f"a{chr(c)}. {chr(c)},")
    rng = random.Random(1)
    pool = [*"aZé,.'\"1;-<|>_ \t\n\x0b\x0c\r\x1c\x1f\x85\xa0\u200b\u200d\u2028\u3000\ufeff\x00\x7f", "'s", "'RE", "<|endoftext|>",
            "İ", "ﬁ", "ß", "Σ", "ς", "ǅ", "A\u030a", "가", "\u1100\u1161", "क", "क\u093c", "²", "Ⅷ", "\U0001f600",
            *map(chr, range(0x300, 0x340)), *map(chr, range(0x93a, 0x950))]
    for _ in range(8000):
        same("".join(rng.choice(pool) for _ in range(rng.randint(1, 12))))


def test_word_ids_forget_and_relearn():
    asked = []
    w = packing.WordIds(lambda x: asked.append(x) or x, 3)
    for x in [b"a", b"b", b"c", b"d", b"a", b"e", b"f", b"a", b"b"]:
        assert w[x] == x
    assert len(w) <= 3 and asked[:4] == [b"a", b"b", b"c", b"d"] and b"a" not in asked[1:]


def test_packing_odd_input(odd_docs, no_docs):
    out = packing.packed(odd_docs, TOKENIZER)
    total = out.agg(F.sum("length")).first()[0]
    assert total == packing.tokenized(odd_docs, TOKENIZER).agg(F.sum("doc_tokens")).first()[0]
    assert packing.packed(no_docs, TOKENIZER).count() == 0


def test_secret_base_and_novel(docs, rows):
    got = {r["doc_id"]: r for r in secret_scan.scan(docs).collect()}
    for d, t, *_ in rows:
        found, text = brute.op4_base(t or "")
        assert got[d]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [got[d][k] for k in ("n_assign", "n_access", "n_hex")] == [sum(f[1] == k for f in found) for k in range(3)]
        assert set(text.split(",") if text else []) <= set(got[d]["spans"].split(","))
    assert got[40]["n_assign"] == 1 and got[40]["n_access"] == 1 and got[40]["n_hex"] == 1
    spans = [s.split(":") for s in got[41]["spans"].split(",")]
    text = rows[41][1]
    assert [text[int(s):int(e)] for k, s, e in spans if k == "novel"] == ["Zx81kQpLm27RtYw09BvNc34HsDfGj56"]
    assert secret_scan.span_rows(secret_scan.scan(docs)).count() >= 4


def test_secret_odd_input(odd_docs, no_docs):
    assert secret_scan.scan(odd_docs).count() == odd_docs.count()
    assert secret_scan.scan(no_docs).count() == 0


def test_secret_assign_edge_cases():
    for t in ["token=secret = abcdefgh", "PASSWORD:'abcdef'", "api_key=abcde", "apikey = ======", "tokeſn = abcdefgh",
              "passwd\"  :  \"abc/def+1", "secret: abcdefg", "token = token = abcdefg", "AKIAAKIA" + "A1" * 8, "é" * 5 + "token=abcdefg"]:
        assert secret_scan.base_spans(t) == brute.op4_base(t)[0]


def test_language(spark):
    words = {"en": "the house river stone wind table", "fr": "maison rivière pierre vent tableau été", "de": "haus fluss stein wind tisch über"}
    import random
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(words[k].split()) for _ in range(80)), k) for i in range(90) for k in words]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    d = language.train(df.where("doc_id % 3 <> 0"))
    assert set(d) == set(words)
    held = language.classify(df.where("doc_id % 3 = 0"), d, carry=("doc_id", "lang"))
    assert held.where("lang = lang_pred").count() >= 0.95 * held.count()
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !!"), (None, "haus stein fluss über")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language.classify(odd, d).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and got[None]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert {r["lang_pred"] for r in language.classify(df, {}).collect()} == {"und"}


def test_language_equals_plain_version_and_learns_short_texts(spark, docs, rows):
    d = language.train(docs)
    got = {r["doc_id"]: (r["lang_pred"], r["rejected"]) for r in language.classify(docs, d).collect()}
    assert got == {i: brute.op5(t, d) for i, t, *_ in rows}
    few = spark.createDataFrame([(i, "ja ja nein", "de") for i in range(3)] + [(9, "yes yes no", "en"), (10, "ß", "xx")] +
                                [(11, "z" * 40_000 + "q" * 40_000, "long")], "doc_id long, text string, lang string")
    learned = language.train(few)
    assert list(learned) == ["de", "en", "long", "xx"] and learned["xx"] == "ß ".encode()
    assert 12_000 < len(learned["long"]) < 12_300
    assert list(language.train(few, max_languages=2)) == ["de", "en"]


def test_language_draws_from_a_hot_language(spark):
    df = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("wort "), F.col("id").cast("string"), F.lit(" haus")).alias("text"),
                                    F.when(F.col("id") % 100 == 0, "fr").otherwise("de").alias("lang"))
    d = language.train(df, sample_docs=64)
    assert d["de"].count(b"wort") == 64 and d["fr"].count(b"wort") == 64


def test_language_odd_input(odd_docs, no_docs):
    d = language.train(odd_docs)
    assert language.classify(odd_docs, d).count() == odd_docs.count()
    assert language.train(no_docs) == {} and language.classify(no_docs, d).count() == 0


PAGES = [(1, "http://a", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://c", None), (4, "http://d\r\nX: y", ""),
         (5, "http://e", "WARC/1.1\r\n\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (6, "u", "ünï \U0001f600" * 2000),
         (7, "v", "<p>x</p>"), (8, "w", "\x1f\x8b"), (None, "n", "<p>x</p>")]


def test_warc_round_trip(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(2)
    path = str(tmp_path / "warc")
    warc.write_archives(warc.resolved(df), path, records_per_file=3)
    records = warc.read_archives(spark, path)
    got = {r["record_id"]: r for r in records.collect()}
    heads = {r["record_id"]: r for r in warc.joined(records).collect()}
    first = {}
    for k, _, h in sorted(PAGES, key=lambda p: (p[0] is None, p[0])):
        body = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        r, head = got[warc.record_id(k)], heads[warc.record_id(k)]
        assert (head["digest"], head["payload_bytes"]) == (digest, len(body))
        if digest in first:
            assert head["record_type"] == "revisit" and head["refers_to"] == warc.record_id(first[digest]) and not r["content"]
        else:
            first[digest] = k
            assert head["record_type"] == "response" and head["refers_to"] is None and bytes(r["content"]) == body
    assert len(got) == len(PAGES)
    assert got[warc.record_id(4)]["url"] == "http://dX: y"


def test_warc_odd_input(spark, tmp_path):
    twice = spark.createDataFrame(PAGES[:2] * 2, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    out = warc.resolved(twice).collect()
    assert sorted(r["record_type"] for r in out) == ["response", "response", "revisit", "revisit"]
    none = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(warc.resolved(none), str(tmp_path / "none"))
    assert warc.joined(warc.read_archives(spark, str(tmp_path / "none"))).count() == 0
    small = warc.resolved(spark.createDataFrame(PAGES, "page_id long, url string, html string"), min_bytes=100)
    assert small.where("record_type = 'revisit'").count() == 0


@pytest.mark.parametrize("chunk, bucket", [(2_000_000, 12_000_000), (3000, 2000)])
def test_suffix_dedup(docs, rows, chunk, bucket):
    out = suffix_dedup.removed(docs, chunk_bytes=chunk, bucket_bytes=bucket, with_text=True).collect()
    got = {r["doc_id"]: r for r in out}
    for d, n, removed, spans, sha in brute.op8([(d, (t or "").encode()) for d, t, *_ in rows]):
        assert (got[d]["n_bytes"], got[d]["n_removed"], got[d]["n_spans"], got[d]["kept_sha256"]) == (n, removed, spans, sha), d
    assert got[20]["kept_text"] == "" and got[21]["n_removed"] == got[21]["n_bytes"]


def test_suffix_dedup_random_strings(spark):
    import random
    rng = random.Random(5)
    for alphabet in ("ab", "a", "abcdefgh "):
        pool = ["".join(rng.choice(alphabet) for _ in range(rng.choice([20, 49, 50, 51, 75, 130]))) for _ in range(12)]
        rows = [(rng.choice([i, i, None, i // 2]), "".join(rng.choice(pool) for _ in range(rng.randint(0, 4)))) for i in range(60)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                     for r in suffix_dedup.removed(df, chunk_bytes=700, bucket_bytes=500).collect())
        want = sorted(((d is None, d or 0), n, rem, s, h) for d, n, rem, s, h in brute.op8([(d, t.encode()) for d, t in rows]))
        assert got == want


def test_suffix_dedup_odd_input(odd_docs, no_docs):
    assert suffix_dedup.removed(odd_docs).count() == odd_docs.count()
    assert suffix_dedup.removed(no_docs).count() == 0


def test_multikey_order():
    rng = np.random.default_rng(1)
    w = rng.integers(0, 3, (500, 3)).astype(np.uint64)
    order, group = suffix_dedup.multikey_order(w)
    s = w[order]
    assert [tuple(x) for x in s.tolist()] == sorted(map(tuple, w.tolist()))
    assert all((group[i] == group[i + 1]) == (tuple(s[i]) == tuple(s[i + 1])) for i in range(499))


def test_simhash_groups(docs, rows):
    got = {r["doc_id"]: (f"{r['fp'] & (2**64 - 1):016x}", r["component_id"]) for r in simhash.groups(docs).collect()}
    for d, fp, c in brute.op9([(d, t) for d, t, *_ in rows]):
        assert got[d] == (fp, c)


@pytest.mark.parametrize("distance, block", [(3, 4096), (3, 7), (2, 16), (5, 4096), (1, 5)])
def test_simhash_links_lose_nothing(spark, distance, block):
    """Clusters around a few centres: the components equal those of all pairs."""
    rng = np.random.default_rng(distance)
    centres = rng.integers(-2**63, 2**63 - 1, 6)
    fps = set(rng.integers(-2**63, 2**63 - 1, 300).tolist())
    for c in centres.tolist():
        for _ in range(80):
            x = c
            for b in rng.choice(64, rng.integers(0, 5), replace=False).tolist():
                x ^= (1 << b) if b < 63 else -(1 << 63)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp long").repartition(3)
    root = {r["vertex"]: r["root"] for r in components(simhash.links(df, distance=distance, block=block)).collect()}
    a = np.array(fps).view(np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= distance
    lab = simhash.forest(len(a), *np.nonzero(near))
    want = {fps[i]: fps[lab[i]] for i in range(len(fps)) if lab[i] != i}
    assert root == want


def test_simhash_keep_one(docs, odd_docs, no_docs, rows):
    kept = simhash.keep_one(docs).select("doc_id").collect()
    assert sorted(r[0] for r in kept) == sorted({c for _, _, c in brute.op9([(d, t) for d, t, *_ in rows])})
    odd = simhash.keep_one(odd_docs)
    groups = simhash.groups(odd_docs).select("root").distinct().count()
    assert odd.count() == groups and odd.columns == odd_docs.columns
    assert simhash.groups(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0


def test_majority_matches_plain():
    import xxhash
    texts = ["a b c d e", "", "one", "x y", "A a A a A a", "w " * 700]
    for t in texts:
        h = simhash.shingle_hashes(t.encode(), 3, 42)
        assert int(simhash.majority(np.array(h, np.uint64), np.array([len(h)]))[0]) == brute.simhash(t)
    assert xxhash.xxh64_intdigest(b"one", 42) == int(simhash.shingle_hashes(b"One", 3, 42)[0])


def test_components_chain_and_star(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(5, 5), (200, 201), (201, 200)]
    got = {r["vertex"]: r["root"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}, 201: 200}
