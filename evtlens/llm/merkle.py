"""Document fingerprints: a Merkle tree over sentences, paragraphs and sections
(DataFrame functions only).

* Leaves: the clauses of each line (cut after . ! ? , ; : or | and a space, and after the clause marks of
  scripts that need no space), hashed. A clause of more than LONGEST characters is cut on from its start, so that text
  without marks has leaves of bounded length too; an edit moves the cuts up to the clause's end only.
* A paragraph is a line; its node hashes its leaves.
* A section is a run of paragraphs that ends after a paragraph whose hash starts with
  0 to 3. Borders depend on content only, so an insertion moves no later border.
* The root hashes the section nodes.

A fingerprint is text: the root, ``:``, then the sections separated by ``|``. A section is
its node, ``=``, then its paragraphs separated by ``;``; a paragraph is its leaf hashes
separated by ``,``. Equal texts have equal fingerprints; roots alone test equality.
``locate`` walks down the branches that differ.
Likeness is twice the number of common leaves over the leaves of both (sets).

Defined results: a null text is empty; the empty text has one leaf, that of "";
two empty texts are alike (1.0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

LEAF, NODE = 12, 16       # hex digits kept of a leaf's and a node's hash
# Clause marks.
CLAUSE_END = "([.!?,;:|] |[。．！？，、；：…؟،؛।॥။።])"
LONGEST = 120
LONG_CLAUSE = rf"([^\n]{{{LONGEST}}})([^\n])"


def tree(text: Column) -> Column:
    """The sections as text: ``hash=leaf,leaf;leaf|hash=...``. String functions only, so
    that the plan stays small however long the text is."""
    lines = F.split(text, "\n", -1)
    paragraphs = F.transform(lines, lambda p: F.array_join(F.transform(
        F.split(F.regexp_replace(F.regexp_replace(p, CLAUSE_END, "$1\n"), LONG_CLAUSE, "$1\n$2"), "\n", -1),
        lambda s: F.left(F.md5(s), F.lit(LEAF))), ","))
    # the paragraph's hash decides whether a section ends behind it
    marked = F.array_join(F.transform(paragraphs, lambda p: F.concat(
        p, F.when(F.left(F.md5(p), F.lit(1)) < "4", F.lit("|")).otherwise(F.lit(";")))), "")
    sections = F.split(F.regexp_replace(marked, r"[|;]\z", ""), r"\|", -1)
    return F.array_join(F.transform(sections, lambda s: F.concat(node(s), F.lit("="), s)), "|")


def node(section: Column) -> Column:
    """Hash of a section: over the hashes of its paragraphs."""
    return F.left(F.md5(F.array_join(F.transform(F.split(section, ";", -1), lambda p: F.left(
        F.md5(p), F.lit(NODE))), ",")), F.lit(NODE))


def root(tree_text: Column) -> Column:
    return F.md5(F.array_join(F.transform(F.split(tree_text, r"\|", -1), lambda s: F.left(s, F.lit(NODE))), ","))


def fingerprint(text: Column) -> Column:
    body = tree(text)
    return F.element_at(F.transform(F.array(body), lambda t: F.concat(root(t), F.lit(":"), t)), 1)


def leaves(fp: Column) -> Column:
    """The set of leaf hashes of a fingerprint."""
    rest = F.regexp_replace(F.regexp_replace(fp, r"^[0-9a-f]{32}:[0-9a-f]{16}=", ""), r"\|[0-9a-f]{16}=", ",")
    return F.array_distinct(F.split(rest, "[,;]", -1))


def likeness(a: Column, b: Column) -> Column:
    """Twice the shared leaves over the leaves of both, for two leaf sets."""
    return 2.0 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b))


def locate(pairs: DataFrame, old: str = "old", new: str = "new") -> DataFrame:
    """Where two fingerprints differ: ``pairs`` with one row per differing branch of
    either side - side (old, new), section and paragraph (numbers from 0) and paragraph
    text of leaf hashes. Sections whose nodes the other side has are not opened; in the
    others the paragraphs that the other side's differing sections lack are listed. Equal
    roots give no row."""
    def sections(fp):
        return F.split(F.regexp_replace(fp, r"^[0-9a-f]{32}:", ""), r"\|", -1)

    def paragraphs(fp, other):
        nodes = F.transform(sections(other), lambda s: F.left(s, F.lit(NODE)))
        opened = F.filter(F.transform(sections(fp), lambda s, i: F.struct(i.alias("section"), s.alias("s"))),
                          lambda x: ~F.array_contains(nodes, F.left(x["s"], F.lit(NODE))))
        return F.flatten(F.transform(opened, lambda x: F.transform(
            F.split(F.substring(x["s"], NODE + 2, 1 << 30), ";", -1),
            lambda p, j: F.struct(x["section"].alias("section"), j.alias("paragraph"), p.alias("leaves")))))

    def missing(mine, theirs):
        known = F.transform(theirs, lambda x: x["leaves"])
        return F.filter(mine, lambda x: ~F.array_contains(known, x["leaves"]))

    a, b = paragraphs(F.col(old), F.col(new)), paragraphs(F.col(new), F.col(old))
    sides = F.array(F.struct(F.lit("old").alias("side"), missing(a, b).alias("d")),
                    F.struct(F.lit("new").alias("side"), missing(b, a).alias("d")))
    return (pairs.where(~F.col(old).eqNullSafe(F.col(new)))
            .withColumn("__m", F.explode(sides)).withColumn("__d", F.explode("__m.d"))
            .select(*pairs.columns, F.col("__m.side").alias("side"), "__d.section", "__d.paragraph", "__d.leaves"))


def with_next(docs: DataFrame, *, key: str = "doc_id", text: str = "text", rows_per_block: int = 2000) -> DataFrame:
    """key, text, next_text, fingerprint, next_fingerprint: each row with the next one by
    (key, text hash), nulls last; the last row gets the first. A text is fingerprinted
    once, before the shuffle.

    Keys are cut into blocks of equal width; a block that holds far more rows than others
    (a key with very many rows) is cut once more by key and hash, in order. A copy of each
    block's first row goes to the block before it, so all successors are found inside
    blocks, by one shuffle of the texts. The block table has one small row per block."""
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(key).alias("k"), body.alias("t"), F.xxhash64(body).alias("h"))
    span = base.agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("k").alias("n")).first()
    lo = span["lo"] if span["lo"] is not None else 0
    hi = span["hi"] if span["hi"] is not None else 0
    width = max(1, -(-(hi - lo + 1) * rows_per_block // max(span["n"], 1)))
    coarse = F.coalesce(F.floor((F.col("k") - F.lit(lo)) / F.lit(width)).cast("long"), F.lit(1 << 62))
    keys = written(base.select("k", "h", coarse.alias("c")), "merkle-keys")
    heavy = (keys.groupBy("c").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 8 * rows_per_block)
             .select(F.col("c").alias("hc")))
    heavy = written(heavy, "merkle-heavy")
    fine = F.struct(F.col("k").alias("k"), F.shiftright("h", 54).alias("p"))
    none = F.struct(F.lit(None).cast("long").alias("k"), F.lit(None).cast("long").alias("p"))

    def blocked(df, *more):
        return (df.join(heavy, F.col("c") == F.col("hc"), "left")
                .select("k", "h", *more, F.struct(F.col("c"), F.when(F.col("hc").isNotNull(), fine)
                                                  .otherwise(none).alias("f")).alias("block")))

    order = F.struct(F.col("k").isNull().alias("n"), F.col("k").alias("k"), F.col("h").alias("h"))
    blocks = blocked(keys).groupBy("block").agg(F.min(order).alias("first"))
    by = Window.orderBy("first")
    blocks = written(blocks.select(
        "block", "first", F.lag("block").over(by).alias("before"),
        F.max(F.struct("first", "block")).over(Window.orderBy(F.lit(1)).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)).alias("last")), "merkle-blocks")
    rows = blocked(base.withColumn("c", coarse), "t")
    # the first row of each block, once, as the row behind the last one of the block before it
    firsts = (rows.join(blocks.select(F.col("block").alias("b"), "first", F.coalesce(
        "before", F.col("last.block")).alias("to"), F.col("before").isNull().alias("wraps")),
        (F.col("block").eqNullSafe(F.col("b"))) & F.col("first.h").eqNullSafe(F.col("h"))
        & F.col("first.k").eqNullSafe(F.col("k")))
        .dropDuplicates(["b"]).select("k", "h", "t", F.col("to").alias("block"), "wraps", F.lit(True).alias("copy")))
    every = rows.select("k", "h", "t", "block", F.lit(False).alias("wraps"), F.lit(False).alias("copy")).unionByName(firsts)
    every = every.withColumn("fp", fingerprint(F.col("t")))
    inside = Window.partitionBy("block").orderBy("wraps", F.col("k").asc_nulls_last(), "h", "copy")
    return (every.withColumns({"next_text": F.lead("t").over(inside), "next_fp": F.lead("fp").over(inside)})
            .where(~F.col("copy"))
            .select(F.col("k").alias(key), F.col("t").alias(text), "next_text", F.col("fp").alias("fingerprint"),
                    F.col("next_fp").alias("next_fingerprint")))


def compared(docs: DataFrame, *, key: str = "doc_id", text: str = "text", rows_per_block: int = 2000) -> DataFrame:
    """key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    df = with_next(docs, key=key, text=text, rows_per_block=rows_per_block)
    n = F.char_length(text)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    df = df.withColumn("n_chars", n.cast("long"))
    df = df.withColumn("__m_edited", F.concat(F.left(text, (F.col("n_chars") - half).cast("int")),
                                              F.left("next_text", half)))
    df = df.select(key, "n_chars", F.sha2("__m_edited", 256).alias("edited_sha256"), "fingerprint",
                   fingerprint(F.col("__m_edited")).alias("edited_fingerprint"),
                   F.col("next_fingerprint").alias("__m_next"))
    df = df.withColumns({"__m_a": leaves(F.col("fingerprint")), "__m_b": leaves(F.col("edited_fingerprint")),
                         "__m_c": leaves(F.col("__m_next"))})
    return df.select(key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                     likeness(F.col("__m_a"), F.col("__m_b")).alias("near_edited"),
                     likeness(F.col("__m_a"), F.col("__m_c")).alias("near_next"))
