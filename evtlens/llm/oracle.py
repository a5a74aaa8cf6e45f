"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from .merkle import CLAUSE_END, LONG_CLAUSE
from .quality import CLASSES, COMMON_WORDS, VOCABULARY

WORD = r"[^\x20\x09-\x0D]+"


def op1(weights=(3, 1, 2), ratio=1.5, epochs=2, seed=42, rounds=3) -> str:
    pick = "[" + ", ".join(f"{float(w)}::DOUBLE" for w in weights) + "]"
    ctes = [f"""
docs AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
    md5('{seed}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS draw FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighted AS (SELECT *, {epochs}.0::DOUBLE * source_size AS clamp,
    {pick}[((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % {len(weights)} + 1] AS weight FROM sizes),
live AS (SELECT *, clamp / weight AS ratio, row_number() OVER (ORDER BY clamp / weight, source) AS i
    FROM weighted WHERE source_size > 0),
cum AS (SELECT *, coalesce(sum(clamp) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
    sum(weight) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM live),
level AS (SELECT min_by(({ratio} * (SELECT sum(source_size) FROM sizes) - held) / rest, i) AS level FROM cum
    WHERE ({ratio} * (SELECT sum(source_size) FROM sizes) - held) / rest < ratio),
state0 AS (SELECT *, target - whole * source_size AS need0 FROM (SELECT *,
    CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM (
    SELECT source, source_size, CASE WHEN source_size = 0 THEN 0.0 WHEN (SELECT level FROM level) IS NULL THEN clamp
        ELSE least(clamp, (SELECT level FROM level) * weight) END AS target FROM weighted))),
rows0 AS (SELECT d.*, s.source_size, s.target, s.whole, s.need0, false AS extra0 FROM docs d JOIN state0 s
    ON d.source IS NOT DISTINCT FROM s.source)"""]
    for r in range(rounds):
        ctes.append(f"""
run{r} AS (SELECT *, CASE WHEN NOT extra{r} AND size <= need{r} THEN sum(CASE WHEN NOT extra{r} AND size <= need{r}
    THEN size END) OVER (PARTITION BY source ORDER BY draw) END AS cum{r} FROM rows{r}),
cut{r} AS (SELECT source, coalesce(min(CASE WHEN cum{r} > need{r} THEN draw END), 'g') AS cut,
    coalesce(max(CASE WHEN cum{r} <= need{r} THEN cum{r} END), 0) AS got FROM run{r} GROUP BY source),
rows{r + 1} AS (SELECT x.* EXCLUDE (cum{r}), x.extra{r} OR (x.size <= x.need{r} AND x.draw < c.cut) AS extra{r + 1},
    x.need{r} - c.got AS need{r + 1} FROM run{r} x JOIN cut{r} c ON x.source IS NOT DISTINCT FROM c.source)""")
    return ("WITH " + ",".join(ctes) + f"""
SELECT doc_id, size, source_size, target, (size * (whole + extra{rounds}::INT))::BIGINT AS taken FROM rows{rounds}""")


def op3() -> str:
    def tree(t: str) -> str:
        paragraphs = (f"list_transform(string_split({t}, chr(10)), lambda p: array_to_string(list_transform(string_split("
                      f"regexp_replace(regexp_replace(p, '{CLAUSE_END}', '\\1' || chr(10), 'g'), '{LONG_CLAUSE}', '\\1' || chr(10) || '\\2', 'g'), "
                      "chr(10)), lambda s: left(md5(s), 12)), ','))")
        marked = (f"array_to_string(list_transform({paragraphs}, lambda p: p || CASE WHEN left(md5(p), 1) < '4' "
                  "THEN '|' ELSE ';' END), '')")
        sections = f"string_split(regexp_replace({marked}, '[|;]$', ''), '|')"
        return (f"array_to_string(list_transform({sections}, lambda s: left(md5(array_to_string(list_transform("
                "string_split(s, ';'), lambda p: left(md5(p), 16)), ',')), 16) || '=' || s), '|')")

    def fp(t: str) -> str:
        return f"md5(array_to_string(list_transform(string_split({t}, '|'), lambda s: left(s, 16)), ',')) || ':' || {t}"

    def leaves(t: str) -> str:
        return (f"list_distinct(regexp_split_to_array(regexp_replace(regexp_replace({t}, '^[0-9a-f]{{16}}=', ''), "
                f"'\\|[0-9a-f]{{16}}=', ',', 'g'), '[,;]'))")

    def near(a: str, b: str) -> str:
        return f"2.0::DOUBLE * len(list_intersect({a}, {b})) / (len({a}) + len({b}))"

    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
nexts AS (SELECT *, coalesce(lead(t) OVER (ORDER BY doc_id NULLS LAST), first(t) OVER (ORDER BY doc_id NULLS LAST)) AS nt
    FROM docs),
edits AS (SELECT *, left(t, (length(t) - length(t) // 2)::INT) || left(nt, (length(t) // 2)::INT) AS e FROM nexts),
trees AS (SELECT doc_id, length(t)::BIGINT AS n_chars, sha256(e) AS edited_sha256, {tree('t')} AS a, {tree('e')} AS b,
    {tree('nt')} AS c FROM edits),
sets AS (SELECT *, {leaves('a')} AS la, {leaves('b')} AS lb, {leaves('c')} AS lc FROM trees)
SELECT doc_id, n_chars, edited_sha256, {fp('a')} AS fingerprint, {fp('b')} AS edited_fingerprint,
    {near('la', 'lb')} AS near_edited, {near('la', 'lc')} AS near_next FROM sets"""


def op6(min_words=50, percent=50, max_class=0.28, max_word=0.30, min_chars=200, min_judged=100) -> str:
    vocabulary = "[" + ", ".join(f"'{w}'" for w in VOCABULARY) + "]"
    langs = ", ".join(f"'{k}'" for k in sorted(COMMON_WORDS))
    patterns = {"space": r"[\x20\x09-\x0D]", "lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]"}
    # classes are taken in turn from what the earlier ones left, as letters include a-z and A-Z
    n = {k: f"(length(t) - length(regexp_replace(t, '{p}', '', 'g')))" for k, p in patterns.items()}
    n["letter"] = r"(length(t) - length(regexp_replace(t, '\p{L}', '', 'g')) - " + f"{n['lower']} - {n['upper']})"
    n["punct"] = """(length(t) - length(regexp_replace(t, '[.,;:!?''"()-]', '', 'g')))"""
    n["other"] = "(length(t) - " + " - ".join(n[k] for k in ("space", "lower", "upper", "letter", "digit", "punct")) + ")"
    classes = ", ".join(f"{n[c]}::DOUBLE / greatest(length(t), 1) AS c_{c}" for c in CLASSES)

    def part(x, y):
        return f"CASE WHEN {x} > 0 THEN {x} * log2(2 * {x} / ({x} + {y})) ELSE 0 END"

    def term(p, q):
        return f"({part(p, q)} + {part(q, p)})"

    class_sum = " + ".join(term(f"f.c_{c}", f"r.c_{c}") for c in CLASSES)
    ref_classes = ", ".join(f"round(sum(c_{c}) / count(*), 6) AS c_{c}" for c in CLASSES)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, lang, coalesce(text, '') AS t FROM documents),
split AS (SELECT *, regexp_extract_all(t, '{WORD}') AS w FROM docs),
wins AS (SELECT id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS g FROM (
    SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) >= 3)),
hot AS (SELECT id, i FROM (SELECT *, count(*) OVER (PARTITION BY id, g) AS n FROM wins) WHERE n > 1),
rep AS (SELECT id, count(DISTINCT j)::BIGINT AS n_repeat_words FROM (SELECT id, unnest([i, i + 1, i + 2]) AS j FROM hot)
    GROUP BY id),
feat AS (SELECT s.id, doc_id, lang, t, w, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')))
     - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')))))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, {classes} FROM split s LEFT JOIN rep USING (id)),
hits AS (SELECT id, word, count(*) / any_value(n_words) AS p FROM (
    SELECT id, n_words, unnest(list_filter(w, lambda x: list_contains({vocabulary}, x))) AS word FROM feat) GROUP BY id, word),
refs AS (SELECT lang, count(*) AS n, {ref_classes} FROM feat WHERE lang IN ({langs}) AND n_words >= {min_words} GROUP BY lang),
ref_words AS (SELECT f.lang, h.word, round(sum(h.p) / any_value(r.n), 6) AS q FROM feat f JOIN hits h USING (id)
    JOIN refs r ON r.lang = f.lang WHERE f.n_words >= {min_words} GROUP BY f.lang, h.word),
ref_sums AS (SELECT lang, coalesce(sum(q), 0) AS q FROM refs LEFT JOIN ref_words USING (lang) GROUP BY lang),
word_terms AS (SELECT f.id, r.lang, coalesce(sum({term('h.p', 'coalesce(rw.q, 0)')}), 0) AS d, coalesce(sum(h.p), 0) AS p,
    coalesce(sum(rw.q), 0) AS q FROM feat f CROSS JOIN refs r LEFT JOIN hits h ON h.id = f.id
    LEFT JOIN ref_words rw ON rw.lang = r.lang AND rw.word = h.word GROUP BY f.id, r.lang),
word_near AS (SELECT id, min(sqrt(greatest((d + greatest(s.q - wt.q, 0)
    + {term('greatest(1 - wt.p, 0)', 'greatest(1 - s.q, 0)')}) / 2, 0))) AS wd FROM word_terms wt JOIN ref_sums s USING (lang)
    GROUP BY id),
class_near AS (SELECT f.id, min(sqrt(greatest(({class_sum}) / 2, 0))) AS cd FROM feat f CROSS JOIN refs r GROUP BY f.id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    (n_words < {min_words} OR 100 * n_repeat_words > {percent} * n_words) AS base_failed,
    NOT (n_words < {min_words} OR 100 * n_repeat_words > {percent} * n_words)
    AND NOT coalesce(length(t) >= {min_chars} AND cd > {max_class}, false)
    AND NOT coalesce(n_words >= {min_judged} AND lang IS NOT NULL AND wd > {max_word}, false) AS kept
FROM feat LEFT JOIN class_near USING (id) LEFT JOIN word_near USING (id)"""


def op7() -> str:
    bits = "[" + ", ".join(f"'{i:04b}'" for i in range(16)) + "]"
    fives = "[" + ", ".join(f"'{i:05b}'" for i in range(32)) + "]"
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS x FROM p),
b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: {bits}[strpos('0123456789abcdef', x[i])]), '') AS bits FROM d),
f AS (SELECT *, first_value(page_id) OVER (PARTITION BY x ORDER BY page_id NULLS LAST) AS least FROM b)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[list_position({fives}, bits[5 * i + 1 : 5 * i + 5])]), '') AS payload_digest,
    CASE WHEN least IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN least IS NOT DISTINCT FROM page_id THEN NULL ELSE least END AS refers_to FROM f"""


def op10(min_words=12) -> str:
    """Every run of up to ``min_words`` lines with enough words is looked for; a longer one is the union of such."""
    return f"""
WITH each AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS p
    FROM documents),
counted AS (SELECT *, len(regexp_extract_all(line, '{WORD}')) AS n FROM each),
owned AS (SELECT *, sum((n > 0)::INT) OVER (PARTITION BY doc_id ORDER BY p) AS i FROM counted),
solid AS (SELECT doc_id, list(line ORDER BY p) AS lines, list(n ORDER BY p) AS ns FROM counted WHERE n > 0 GROUP BY doc_id),
starts AS (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM solid),
runs AS (SELECT doc_id, i, l, lines[i : i + l - 1] AS run, list_sum(ns[i : i + l - 1]) AS n
    FROM starts, (SELECT unnest(range(1, {min_words} + 1)) AS l) WHERE i + l - 1 <= len(lines)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS r FROM runs WHERE n >= {min_words}),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + l)) AS i FROM ranked WHERE r > 1),
kept AS (SELECT o.doc_id, count(g.i)::BIGINT AS removed, coalesce(string_agg(line, chr(10) ORDER BY o.p)
    FILTER (WHERE g.i IS NULL), '') AS text FROM owned o LEFT JOIN gone g ON g.doc_id = o.doc_id AND g.i = o.i GROUP BY o.doc_id),
heads AS (SELECT g.doc_id, count(*)::BIGINT AS n FROM gone g LEFT JOIN gone b ON b.doc_id = g.doc_id AND b.i = g.i - 1
    WHERE b.i IS NULL GROUP BY g.doc_id)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(k.removed, 0) AS n_removed_lines,
    coalesce(h.n, 0) AS n_runs, CASE WHEN d.text IS NULL THEN NULL ELSE sha256(k.text) END AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN heads h USING (doc_id)"""


def op12(every=100, few=5, low=80, high=100) -> str:
    return f"""
WITH v AS (SELECT row_number() OVER () AS uid, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(c::DOUBLE * 256)) AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c) OR abs(c) >= 65536)) = 0),
scored AS (SELECT a.uid, a.id AS anchor_id, b.id, a.label = b.label AS same, coalesce(list_sum(list_transform(
    range(1, least(len(a.x), len(b.x)) + 1), lambda i: a.x[i] * b.x[i])), 0)::BIGINT AS score
    FROM v a JOIN v b ON a.id % {every} = 0),
near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, id) AS place FROM scored
    WHERE same AND id <> anchor_id) WHERE place <= {few}),
fits AS (SELECT n.anchor_id, n.id AS positive_id, s.id AS negative_id, n.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY n.uid, n.place ORDER BY s.score DESC, s.id)::INT AS rank
    FROM near n JOIN scored s ON s.uid = n.uid AND NOT s.same
    AND {low} * n.score <= 100 * s.score AND 100 * s.score <= {high} * n.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM fits WHERE rank <= {few}"""


ORACLE_SQL = {
    "op1_mixing": op1(),
    "op3_fingerprints": op3(),
    "op6_quality_rules": op6(),
    "op7_warc": op7(),
    "op10_line_dedup": op10(),
    "op12_hard_negatives": op12(),
}
