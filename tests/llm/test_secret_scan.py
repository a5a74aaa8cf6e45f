"""Novel strings of the secret scan."""

import random
import string
import time

from pyspark.sql import functions as F

from evtlens.llm import secret_scan


COMPRESSOR = secret_scan.primed()


def novel(text):
    _, every = secret_scan.spans_of(text, COMPRESSOR)
    return [text[s:e] for s, k, e in every if secret_scan.KINDS[k] == "novel"]


def random_strings(alphabet, n, count=50, seed=4):
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=n)) for _ in range(count)]


def share_found(strings):
    return sum(novel(f"the api key was {c} they said") == [c] for c in strings) / len(strings)


def test_secret_novel_needs_no_digits():
    rng = random.Random(5)
    for n in (16, 20, 32, 64, 512):
        assert share_found(random_strings(string.ascii_letters, n)) == 1
        one = ["".join(rng.sample(c[1:] + "7", n)) for c in random_strings(string.ascii_letters, n)]
        assert share_found(one) == 1
        assert share_found(random_strings(string.ascii_lowercase, n)) >= (0.9 if n == 16 else 1)
    assert share_found(["client_secret_client_id", "authorization_endpoint_configuration", "application.properties"]) == 0


def test_secret_novel_with_copies():
    for n in (16, 32, 64, 128):
        for c in random_strings(string.ascii_letters + string.digits, n):
            assert novel(f"Authorization Bearer {c}\nretry with Bearer {c}") == [c, c]
            assert novel(f"Bearer {c} {c} {c}") == [c, c, c]
            assert novel(f"Bearer {c}\n" + "x " * 38 + c) == [c, c]          # a copy cut by the reach
            assert novel(f"Bearer {c}\nbearer name/{c}") == [c, f"name/{c}"]
            assert novel(f"Bearer {c}\n" + "far away " * 40 + c) == [c, c]


def test_secret_novel_long_strings():
    for c in random_strings(string.ascii_letters + string.digits, 20000, 3):
        assert novel(f"see {c} token") == [c]
        assert novel(f"see {c}: token and token, {c}") == [c, c]
    for alphabet in (string.digits + "ABCDEF", string.ascii_uppercase + "234567"):
        for n in (128, 512, 4096):
            assert share_found(random_strings(alphabet, n, 20)) == 1


def test_secret_unbroken_text_is_walked_once():
    text = "token;" * 100_000 + "Zx81kQpLm27RtYw09BvNc34HsDfGj56"
    begin = time.process_time()
    assert novel(text) == ["Zx81kQpLm27RtYw09BvNc34HsDfGj56"]
    assert time.process_time() - begin < 20


#: Ordinary strings that stand beside sensitive words.
ORDINARY = """build_query_from_parameters MAX_CONCURRENT_CONNECTIONS requirements-dev.txt /var/log/nginx/access.log
docs.python.org/3/library/re.html ================ -------------------- .................... ________________________
authorization_endpoint_configuration application.properties client_secret_client_id get_user_by_email_address
src/main/java/com/example/Application.java node_modules/lodash/package.json https://api.example.com/v1/users/profile
DefaultAuthenticationProvider AbstractUserDetailsService process_payment_transaction test_connection_pool_timeout
org.springframework.security Content-Disposition-Filename README-installation-guide.md config/environments/production.rb
SELECT_STATEMENT_BUILDER /usr/local/share/applications""".split()


def test_secret_ordinary_strings_are_left_alone():
    assert sum(novel(f"the api key was {c} they said") != [] for c in ORDINARY) <= 2
    assert novel("Access token\n" + "=" * 16 + "\n") == novel("id | token\n" + "-" * 20 + "\n") == []


def test_secret_many_base_hits_are_linear():
    """50,000 base spans in 5 MB, with candidates between them."""
    rng = random.Random(3)
    line = "token = {} and the log at /var/log/service/access.log says " + "x" * 10 + "\n"
    text = "".join(line.format("".join(rng.choices(string.hexdigits, k=24))) for _ in range(55_000))
    assert len(text) > 5_000_000
    begin = time.process_time()
    base, every = secret_scan.spans_of(text[:len(text) // 4], COMPRESSOR)
    quarter = time.process_time() - begin
    begin = time.process_time()
    base, every = secret_scan.spans_of(text, COMPRESSOR)
    assert len(base) >= 50_000 and time.process_time() - begin < 8 * quarter


def test_secret_novel_equals_plain_version():
    from . import brute
    rng = random.Random(6)
    words = "the token api_key of build_query_from_parameters and bearer ================ /usr/lib/python3/dist-packages password: hunter2hunter2 0123456789abcdef0123456789".split()
    for _ in range(60):
        secret = "".join(rng.choices(string.ascii_letters + string.digits, k=rng.randint(14, 40)))
        text = " ".join(rng.choice([*words, "plain", "words", secret, f"x/{secret}"]) for _ in range(rng.randint(3, 60)))
        assert novel(text) == brute.op4_novel(text, COMPRESSOR)


def test_corpus_identifiers(spark):
    rows = [(i, f"call load_zorgblat_{i} and zorgblat.path{i} or makeZorgblat, token = q8Zk_vvXq7PpLm") for i in range(4)] * 3
    df = spark.createDataFrame([*rows, (None, None), (9, "")], "doc_id long, text string")
    assert secret_scan.corpus_identifiers(df)[0] == "zorgblat"
    assert not {"vvxq", "plm", "lm", "pp"} & set(secret_scan.corpus_identifiers(df))     # one identifier, whatever its copies
    assert secret_scan.corpus_identifiers(df.limit(0)) == []


def test_corpus_identifiers_come_from_all_documents(spark):
    """More documents than any sample had; the identifiers stand in the few whose text hash is greatest."""
    rows = spark.range(2600).selectExpr("concat('plain words ', id) AS text").orderBy(F.xxhash64("text").desc()).limit(2600)
    last = [r["text"] for r in rows.limit(3).collect()]
    df = rows.withColumn("text", F.when(F.col("text").isin(last), F.concat(F.lit("call zorgblat_"), F.regexp_extract("text", "[0-9]+", 0)))
                         .otherwise(F.col("text")))
    low = df.where("text LIKE 'plain%'").agg(F.sort_array(F.collect_list(F.xxhash64("text")))[1999]).first()[0]
    df = df.unionByName(spark.range(200).selectExpr("concat('run quuxword_x', id) AS text").where(F.xxhash64("text") > low))
    assert {"zorgblat", "quuxword"} <= set(secret_scan.corpus_identifiers(df))
