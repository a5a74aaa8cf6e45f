"""Quality rules: distribution divergence (DataFrame functions only).

The base rules drop texts under 50 words and texts more than half of whose words stand
in repeated three-word windows. The method's verdict compares two histograms of a
document with references of the languages by Jensen-Shannon distance (base 2, 0 to 1):

* its characters by class (lower case, upper case, other letters, digits, white space,
  common punctuation, everything else);
* its common words: how often each word of the languages' short function-word lists
  occurs, and all other words together.

A reference is the mean of the normalised histograms of all documents labelled with that
language that pass the length rule, so that no long document and no single copy outweighs
others. The references are a table of languages x 70 numbers, gathered by one partially
combined aggregation over the whole corpus. Labels other than the four of COMMON_WORDS get
a reference of their own: the OWN_WORDS words with the largest mean share in the documents
of that label, counted from the corpus, and its mean classes. A document is judged by the
nearest of the four references and that of its own label; one without a label has no
reference of its language and gets no word verdict. A histogram is judged only above its
minimum length (``min_chars``, ``min_words_judged``).

Limits: text in another language, code or tables under one of the four labels is judged as
that language and fails for want of its words; classes of unlabelled texts are set against
the four references; the few documents of a rare label make their own reference.

Defined results: a null text counts as empty and fails the length rule; without any
reference only the base rules decide; null ids, repeated rows and extra columns pass
through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, WORD, text_of, written

# Frequent function words by language.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "en": "the of and to in a is that for it as was with be by on not he this are".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au".split(),
}
MANY_LABELS = 10_000
OWN_WORDS = 20
VOCABULARY = sorted({w for words in COMMON_WORDS.values() for w in words})
CLASSES = ["lower", "upper", "letter", "digit", "space", "punct", "other"]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
ADDED = [*COUNTS, "base_failed", "class_distance", "word_distance", "kept"]


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _length_without(text: Column, pattern: str) -> tuple[Column, Column]:
    rest = F.regexp_replace(text, F.lit(pattern), F.lit(""))
    return rest, F.char_length(rest)


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows found at least twice (first occurrence included).

    Windows are sorted by their words; equal neighbours are the repeated ones, and the
    words they cover are counted from the gaps between their sorted places."""
    n = F.size(words)
    at = F.sequence(F.lit(1), n - 2)
    hashes = F.transform(at, lambda i: F.xxhash64(
        F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)))

    def covered(rows: Column) -> Column:
        last = F.size(rows) - 1

        def same(i, j):
            a, b = F.get(rows, i), F.get(rows, j)
            return ((a["h"] == b["h"]) & (a["a"] == b["a"]) & (a["b"] == b["b"]) & (a["c"] == b["c"]))

        hit = F.filter(rows, lambda r, i: F.when(i > 0, same(i, i - 1)).otherwise(False)
                       | F.when(i < last, same(i, i + 1)).otherwise(False))
        places = F.sort_array(F.transform(hit, lambda r: r["i"]))

        def width(p):
            following = F.concat(F.slice(p, 2, F.greatest(F.size(p), F.lit(1))),
                                 F.array(F.lit(2**31 - 4)))
            return F.aggregate(F.zip_with(p, following, lambda x, y: F.least(F.lit(3), y - x)),
                               F.lit(0), lambda s, x: s + x)

        return _let(places, width)

    def judge(h: Column) -> Column:
        rows = F.sort_array(F.transform(h, lambda x, i: F.struct(
            x.alias("h"), F.get(words, i).alias("a"), F.get(words, i + 1).alias("b"),
            F.get(words, i + 2).alias("c"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(rows, covered))

    return F.when(n < 3, F.lit(0)).otherwise(_let(hashes, judge))


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five base counts (columns ``__q_...``), by whole texts."""
    body = text_of(text)
    df = docs.withColumn("__q_words", F.regexp_extract_all(body, F.lit(WORD), F.lit(0)))
    rest, chars = _length_without(body, SPACE)
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(WORD))
    return df.withColumns({
        "__q_n_words": F.size("__q_words").cast("long"),
        "__q_word_chars": chars.cast("long"),
        "__q_n_symbols": F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long"),
        "__q_n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "__q_n_repeat_words": _repeat_words(F.col("__q_words")).cast("long"),
    })


def own_words(docs: DataFrame, *, text: str = "text", lang: str = "lang", min_words: int = 50) -> DataFrame:
    """The common words of each label that COMMON_WORDS lacks, those with the largest mean share: (__q_of, __q_mine,
    an array of OWN_WORDS at most)."""
    df = docs.where(~F.col(lang).isin(sorted(COMMON_WORDS))).select(       # no null labels either
        F.col(lang).alias("__q_of"), F.regexp_extract_all(text_of(text), F.lit(WORD), F.lit(0)).alias("words"))
    each = (df.where(F.size("words") >= min_words)
            .select("__q_of", (F.lit(1.0) / F.size("words")).alias("share"), F.explode("words").alias("word"))
            .groupBy("__q_of", "word").agg(F.sum("share").alias("share")))
    order = Window.partitionBy("__q_of").orderBy(F.round("share", 6).desc(), "word")
    rows = each.withColumn("i", F.row_number().over(order)).where(F.col("i") <= OWN_WORDS)
    return rows.groupBy("__q_of").agg(F.sort_array(F.collect_list("word")).alias("__q_mine"))


def histograms(docs: DataFrame, text: str = "text", *, lang: str = "lang", own: DataFrame | None = None) -> DataFrame:
    """Adds ``__q_chars``, ``__q_classes`` (shares by class, in the order of CLASSES) and
    ``__q_common`` (array of word and share; the words of VOCABULARY that occur), and with
    ``own`` (:func:`own_words`, joined by label) ``__q_own``, the same of the own label's words."""
    body = text_of(text)
    df = docs if own is None else docs.join(own, F.col(lang) == F.col("__q_of"), "left").drop("__q_of")
    if "__q_words" not in df.columns:
        df = df.withColumn("__q_words", F.regexp_extract_all(body, F.lit(WORD), F.lit(0)))
    rest, n = body, F.char_length(body)
    steps = [("space", SPACE), ("lower", "[a-z]+"), ("upper", "[A-Z]+"), ("letter", r"\p{L}+"),
             ("digit", "[0-9]+"), ("punct", "[.,;:!?'\"()-]+")]
    df = df.withColumn("__q_l0", n)
    for i, (_, pattern) in enumerate(steps):      # each pass reads what the last one left
        rest = F.regexp_replace(rest if i == 0 else F.col(f"__q_r{i}"), pattern, "")
        df = df.withColumn(f"__q_r{i + 1}", rest).withColumn(
            f"__q_l{i + 1}", F.char_length(F.col(f"__q_r{i + 1}")))
    size = {name: F.col(f"__q_l{i}") - F.col(f"__q_l{i + 1}") for i, (name, _) in enumerate(steps)}
    size["other"] = F.col(f"__q_l{len(steps)}")
    hits = {"__q_hits": F.sort_array(F.filter("__q_words", lambda w: w.isin(VOCABULARY)))}
    if own is not None:
        hits["__q_own_hits"] = F.when(F.col("__q_mine").isNotNull(), F.sort_array(
            F.filter("__q_words", lambda w: F.array_contains("__q_mine", w))))
    df = df.withColumns({
        "__q_chars": F.col("__q_l0"),
        "__q_classes": F.array(*[size[c] / F.greatest(F.col("__q_l0"), F.lit(1)) for c in CLASSES]),
        **hits,
        "__q_n": F.size("__q_words"),
    })

    def shares(h):
        def of(words):
            first = F.transform(words, lambda w: F.array_position(h, w))
            end = (F.size(h) + 1).cast("long")
            return _let(first, lambda p: F.transform(words, lambda w, i: F.struct(
                w.alias("word"), ((F.coalesce(F.get(p, i + 1), end) - F.get(p, i))
                                  / F.col("__q_n")).alias("share"))))
        return _let(F.array_distinct(h), of)

    if own is not None:
        df = df.withColumn("__q_own", F.when(F.col("__q_own_hits").isNotNull(), shares(F.col("__q_own_hits"))))
    return df.withColumn("__q_common", shares(F.col("__q_hits"))).drop(
        *[f"__q_l{i}" for i in range(len(steps) + 1)], *[f"__q_r{i + 1}" for i in range(len(steps))])


def _entries(features: DataFrame, of: Column, common: str, min_words: int) -> DataFrame:
    """Sums of the class and word shares of each label's documents that are long enough: __q_of, key, s."""
    entries = F.concat(
        F.array(*[F.struct(F.lit(f"c:{c}").alias("key"), F.get("__q_classes", F.lit(i)).alias("share"))
                  for i, c in enumerate(CLASSES)], F.struct(F.lit("n").alias("key"), F.lit(1.0).alias("share"))),
        F.transform(common, lambda x: F.struct(F.concat(F.lit("w:"), x["word"]).alias("key"),
                                               x["share"].alias("share"))))
    return (features.where(of & (F.col("__q_n_words") >= min_words))
            .select(F.col("__q_lang").alias("__q_of"), F.explode(entries).alias("e"))
            .groupBy("__q_of", "e.key").agg(F.sum("e.share").alias("s")))


def references(features: DataFrame, *, min_words: int = 50) -> dict[str, dict[str, float]]:
    """Mean histograms of the languages in COMMON_WORDS, each over all its documents."""
    rows = _entries(features, F.col("__q_lang").isin(sorted(COMMON_WORDS)), "__q_common", min_words).collect()
    out: dict[str, dict[str, float]] = {}
    for r in rows:         # four languages x (classes + vocabulary) numbers at most
        out.setdefault(r[0], {})[r["key"]] = r["s"]
    return {k: {x: round(v / d["n"], 6) for x, v in d.items() if x != "n"} for k, d in out.items()}


def own_references(features: DataFrame, *, min_words: int = 50) -> DataFrame:
    """The same of every other label, as a table: __q_of, __q_ref_classes (in the order of CLASSES) and
    __q_ref_words (word, share; OWN_WORDS at most)."""
    sums = _entries(features, F.col("__q_own").isNotNull(), "__q_own", min_words)
    n = F.max(F.when(F.col("key") == "n", F.col("s")))
    word = F.when(F.col("key").startswith("w:") & (F.col("s") > 0), F.struct(F.substring("key", 3, 1 << 30).alias("word"), F.col("s").alias("share")))
    found = sums.groupBy("__q_of").agg(
        n.alias("n"), F.sort_array(F.collect_list(word)).alias("words"),
        *[F.coalesce(F.max(F.when(F.col("key") == f"c:{c}", F.col("s"))), F.lit(0.0)).alias(f"c_{c}") for c in CLASSES])
    return found.select(
        "__q_of", F.array(*[F.round(F.col(f"c_{c}") / F.col("n"), 6) for c in CLASSES]).alias("__q_ref_classes"),
        F.transform("words", lambda x: F.struct(x["word"].alias("word"), F.round(x["share"] / F.col("n"), 6).alias("share"))).alias("__q_ref_words"))


def _term(p, q):
    """What one bin adds to twice the divergence."""
    def part(x, y):
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)
    return part(p, q) + part(q, p)


def _class_distance(ref: dict[str, float]) -> Column:
    terms = [_term(F.get("__q_classes", F.lit(i)), F.lit(ref.get(f"c:{c}", 0.0))) for i, c in enumerate(CLASSES)]
    return F.sqrt(F.greatest(sum(terms[1:], terms[0]) / 2, F.lit(0.0)))


def _word_distance(ref: dict[str, float]) -> Column:
    words = {k[2:]: v for k, v in ref.items() if k.startswith("w:") and v > 0}
    q = F.create_map(*[F.lit(x) for kv in sorted(words.items()) for x in kv]) if words else None
    state = F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))

    def add(s, x):
        y = F.coalesce(F.element_at(q, x["word"]), F.lit(0.0)) if words else F.lit(0.0)
        return F.struct((s["d"] + _term(x["share"], y)).alias("d"), (s["p"] + x["share"]).alias("p"),
                        (s["q"] + y).alias("q"))

    rest_q = max(0.0, 1.0 - sum(words.values()))

    def close(s):       # words that the document lacks add their q; then the bin of all others
        unseen = F.greatest(F.lit(sum(words.values())) - s["q"], F.lit(0.0))
        other = _term(F.greatest(1.0 - s["p"], F.lit(0.0)), F.lit(rest_q))
        return F.sqrt(F.greatest((s["d"] + unseen + other) / 2, F.lit(0.0)))

    return F.aggregate("__q_common", state, add, close)


def _own_class_distance() -> Column:
    """Distance to the reference of the own label; null where it has none."""
    mine = F.col("__q_ref_classes")
    terms = [_term(F.get("__q_classes", F.lit(i)), F.get(mine, F.lit(i))) for i in range(len(CLASSES))]
    return F.when(mine.isNotNull(), F.sqrt(F.greatest(sum(terms[1:], terms[0]) / 2, F.lit(0.0))))


def _own_word_distance() -> Column:
    """Distance to the reference of the own label; null where it has none."""
    mine = F.col("__q_ref_words")

    def share(entries, word):
        return F.coalesce(F.get(F.filter(entries, lambda x: x["word"] == word), F.lit(0))["share"], F.lit(0.0))

    def total(entries):
        return F.aggregate(entries, F.lit(0.0), lambda s, x: s + x["share"])

    # every word that the document has is one of its label's, so the reference's words are all bins
    bins = F.aggregate(mine, F.lit(0.0), lambda s, x: s + _term(share(F.col("__q_own"), x["word"]), x["share"]))
    other = _term(F.greatest(1.0 - total(F.col("__q_own")), F.lit(0.0)), F.greatest(1.0 - total(mine), F.lit(0.0)))
    return F.when(mine.isNotNull(), F.sqrt(F.greatest((bins + other) / 2, F.lit(0.0))))


def judged(docs: DataFrame, *, text: str = "text", lang: str = "lang", carry: list[str] | None = None,
           min_words: int = 50, max_repeat_percent: int = 50, max_class_distance: float = 0.28,
           max_word_distance: float = 0.30, min_chars: int = 200, min_words_judged: int = 100) -> DataFrame:
    """``docs`` with the counts, both distances and the verdict (columns ADDED, which
    replace existing ones of these names); ``carry`` names the columns to keep (all).

    Texts are read once (those of labels that COMMON_WORDS lacks once more, for their common
    words): the features go to a table in the shared folder with the carried columns, the
    references are summed from it, and the verdict is a projection of it."""
    carry = [c for c in (carry or docs.columns) if c not in ADDED]
    own = written(own_words(docs, text=text, lang=lang, min_words=min_words), "quality-words")
    labels = own.count()          # a label is a row of OWN_WORDS words; beyond MANY_LABELS it is a shuffle join
    few = F.broadcast if labels <= MANY_LABELS else (lambda x: x)
    df = histograms(counts(docs, text), text, lang=lang, own=few(own) if labels else None)
    if not labels:
        df = df.withColumn("__q_own", F.lit(None).cast("array<struct<word:string,share:double>>"))
    feats = written(df.select(*carry, F.col(lang).alias("__q_lang"), "__q_chars", "__q_classes", "__q_common", "__q_own",
                              *[f"__q_{c}" for c in COUNTS]), "quality")
    refs = references(feats, min_words=min_words)
    if labels:
        feats = feats.join(few(own_references(feats, min_words=min_words)), F.col("__q_lang") == F.col("__q_of"), "left")
    else:
        feats = feats.withColumns({"__q_ref_classes": F.lit(None).cast("array<double>"),
                                   "__q_ref_words": F.lit(None).cast("array<struct<word:string,share:double>>")})

    def pick(distance, own_distance):
        return F.array_min(F.array(*[distance(refs[k]) for k in sorted(refs)], own_distance))

    failed = ((F.col("__q_n_words") < min_words)
              | (100 * F.col("__q_n_repeat_words") > max_repeat_percent * F.col("__q_n_words")))
    feats = feats.withColumns({
        "__q_class": F.when(F.col("__q_chars") >= min_chars, pick(_class_distance, _own_class_distance())),
        "__q_word": F.when((F.col("__q_n_words") >= min_words_judged) & F.col("__q_lang").isNotNull(),
                           pick(_word_distance, _own_word_distance())),
    })
    far = (F.coalesce(F.col("__q_class") > max_class_distance, F.lit(False))
           | F.coalesce(F.col("__q_word") > max_word_distance, F.lit(False)))
    return feats.select(
        *carry, *[F.col(f"__q_{c}").alias(c) for c in COUNTS], failed.alias("base_failed"),
        F.col("__q_class").alias("class_distance"), F.col("__q_word").alias("word_distance"),
        (~failed & ~far).alias("kept"))
