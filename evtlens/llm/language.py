"""Language identification by compression.

For each language a zstandard dictionary of raw content is made from labelled texts. A
text is compressed with each dictionary and gets the language whose dictionary leaves the
fewest bytes; when the best two are nearly equal the answer is rejected. Dictionaries and
texts are first reduced to lower-case letters and single spaces, so that capitals, digits
and symbols tell nothing.

A text is compressed in independent blocks of ``block`` bytes, so that the dictionary
counts all through a long text and not only until the text has taught the compressor its
own words.

Training takes, for each of the ``max_languages`` most frequent languages, the ``sample_docs`` texts
with a letter that have the least hash (a bounded, seeded sample, the documented bound of the classifier) up to
``dict_bytes`` in all; a text longer than an eighth of that gives a stretch of that length
from a place that its hash names. Short texts count like others. Whole texts are classified. Only text and label are read.

Defined results: null texts and texts without a letter are ``und`` with score 0; ties go
to the language with more labelled texts, then the first by code point; with no labelled text all are ``und``; documents
whose id is null are neither held out nor learned from.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches
from .packing import slabs

_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    return _OTHER.sub(" ", text.lower()).encode()


def train(labelled: DataFrame, *, text: str = "text", lang: str = "lang", sample_docs: int = 256,
          dict_bytes: int = 98_304, max_languages: int = 256) -> dict[str, bytes]:
    """language -> dictionary content, most frequent language first. Texts are drawn by hash: a threshold from the
    language's approximate number of different texts leaves some ``4 x sample_docs`` of each before anything is
    gathered by language, so a frequent language sends no more than others, however many tasks there are."""
    cap = dict_bytes // 8
    usable = labelled.where(F.col(lang).isNotNull() & F.regexp_like(text, F.lit(r"\p{L}"))).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.lit(5), F.col(text)).alias("draw"))
    often = (usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("draw", 0.05).alias("d"))
             .orderBy(F.col("n").desc(), "lang").limit(max_languages).collect())
    if not often:
        return {}
    spark = labelled.sparkSession
    cuts = spark.createDataFrame([(r["lang"], (1 << 63) - 1 if r["d"] <= 4 * sample_docs else
                                   int((1 << 64) * (4 * sample_docs / r["d"])) - (1 << 63)) for r in often], "lang string, cut long")
    near = usable.join(F.broadcast(cuts), "lang").where(F.col("draw") <= F.col("cut"))       # max_languages rows
    order = Window.partitionBy("lang").orderBy("draw")
    keys = (near.select("lang", "draw").distinct()
            .withColumn("r", F.row_number().over(order)).where(F.col("r") <= sample_docs).drop("r"))
    n = F.char_length("text")
    piece = F.when(n <= cap, F.col("text")).otherwise(F.substring("text", (F.lit(1) + F.pmod("draw", n - cap)).cast("int"), F.lit(cap)))
    picked = (near.join(F.broadcast(keys), ["lang", "draw"])       # sample_docs rows a language
              .groupBy("lang", "draw").agg(F.min(piece).alias("text")).orderBy("lang", "draw").collect())
    out = dict.fromkeys([r["lang"] for r in often], b"")
    for r in picked:                              # sample_docs pieces a language at most
        have = out[r["lang"]]
        if len(have) < dict_bytes:
            out[r["lang"]] = (have + letters(r["text"]) + b" ")[:dict_bytes]
    return out


def classify(docs: DataFrame, dictionaries: dict[str, bytes], *, text: str = "text",
             carry: tuple[str, ...] = ("doc_id",), block: int = 4096, level: int = 6,
             min_margin: float = 0.01) -> DataFrame:
    """carry columns, lang_pred, score (0 to 1: the part of its bytes by which the best
    dictionary beats the second, scaled) and rejected (margin below ``min_margin``)."""
    kinds = dict((f.name, f.dataType) for f in docs.schema)
    names = list(dictionaries)

    def run(batches):
        import zstandard
        made = []
        for k in names:
            d = zstandard.ZstdCompressionDict(dictionaries[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            made.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False,
                                                 write_checksum=False, write_dict_id=False).compress)
        for batch in batches:
            for first, texts in slabs(batch.column(len(carry))):
                lang, score, rejected = [], [], []
                for raw in texts:
                    plain = raw.decode()
                    if not names or not _LETTER.search(plain):
                        lang.append("und")
                        score.append(0.0)
                        rejected.append(True)
                        continue
                    t = letters(plain)
                    size = [0] * len(names)
                    for at in range(0, len(t), block):
                        part = t[at:at + block]
                        for i, f in enumerate(made):
                            size[i] += len(f(part))
                    best = min(range(len(names)), key=size.__getitem__)
                    second = min((s for i, s in enumerate(size) if i != best), default=2 * size[best])
                    margin = (second - size[best]) / max(second, 1)
                    lang.append(names[best])
                    score.append(min(1.0, margin / 0.25))
                    rejected.append(margin < min_margin)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(first, len(texts)) for i in range(len(carry))],
                     pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                    names=[*carry, "lang_pred", "score", "rejected"])

    small_batches(docs.sparkSession)
    schema = ", ".join([*[f"`{c}` {kinds[c].simpleString()}" for c in carry],
                        "lang_pred string, score double, rejected boolean"])
    return docs.select(*carry, F.col(text).alias("text")).mapInArrow(run, schema)
