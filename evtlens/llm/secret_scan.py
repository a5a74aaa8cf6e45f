"""Secret scans: fixed patterns plus dictionary-primed zstandard novelty.

The fixed patterns (assignments to secret-like names, access keys, long hex runs) are
found in every whole text; their matches are reported as they are.

The method adds candidates the patterns miss: unbroken strings of ``LEAST`` (16) characters or more that
stand near a sensitive word; shorter ones are not judged, as too few bytes tell words from chance. Each is judged by its
marginal compressed size: zstandard is primed with a dictionary of identifiers of code and with the
text around the candidate (other copies of it blanked), and the bytes that the candidate adds are set against
those that its own characters add in other orders. Both have the same letter entropy, so
what is left is what dictionary and surroundings know: words, names and paths add less than their
letters shuffled, random strings as much. A candidate is reported (kind ``novel``) from ``MIN_RATIO`` of that on;
strings of few different characters (rules, dots; under ``MIN_BITS`` a character) never. Strings over
``LONG`` characters are set against their letter entropy itself. A candidate also counts as novel when a part of it
between separators does.

Identifiers come from the names that Python's standard library defines, cut into words, and from the corpus:
:func:`corpus_identifiers` takes the words that stand in three or more different identifiers of all
documents, so that a secret with many copies is none.

A string found novel is reported at all its places in the text, near a sensitive word or not.

Spans are code points of the text, end exclusive. Texts are scanned row by row, so
no text is shuffled; work is linear in a text's length.

Defined results: null and empty texts have no spans; ids may be null or repeat.
"""

from __future__ import annotations

import hashlib
import importlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterable
from functools import lru_cache
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .packing import slabs

# The base patterns and the least length of what they must match.
ASSIGN = re.compile(r"""((?a:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")       # a run is matched whole, so shorter ones fail
KINDS = ["assign", "access", "hex", "novel"]
MIN_ASSIGN, MIN_ACCESS = 6, 20

# Words that make the text around a string sensitive.
SENSITIVE = re.compile(r"(?a:(?i:passw|secret|token|api.?key|credential|bearer|authori[sz]|private.?key|access.?key"
                       r"|AKIA|signature|jwt|oauth))")
LEAST = 16
#: Parameters of the verdict.
MIN_RATIO, MIN_BITS, LONG, SHUFFLES, LEVEL = 0.9, 2.5, 1024, 6, 3
LIBRARY_WORDS, LEAD = 3000, 500
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]{%d,}" % LEAST)
GAP = re.compile(r"\s")
SEPARATORS = re.compile(r"[/+_=.-]")

# What code around secrets is made of, to prime the dictionary.
IDENTIFIERS = (
    "import from class def return self None True False const let var function public private static final void string int "
    "if else for while try except catch throw new export default async await lambda struct interface package namespace "
    "config settings environment environ getenv process.env os.environ client_id client_secret access_key secret_key api_key "
    "apikey api-key auth_token access_token refresh_token bearer Authorization authorization password passwd username user "
    "login credential credentials private_key public_key certificate BEGIN END RSA PRIVATE KEY http:// https:// www. .com .org "
    ".net localhost 127.0.0.1 /usr/local/bin /home/user /etc/ssl postgres mysql mongodb redis amqp s3 bucket region endpoint "
    "database connection connect host port timeout headers Content-Type application/json user-agent utf-8 base64 sha256 "
    "the of and to in is that for it with as on be by this are from at or an "
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and non-overlapping per kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def novelty(compressor_for, around: bytes, candidate: bytes) -> int:
    """Bytes that ``candidate`` adds to the compressed ``around``."""
    compressor = compressor_for()
    return len(compressor.compress(around + candidate)) - len(compressor.compress(around))


def surroundings(text: str, start: int, end: int, reach: int) -> bytes:
    """``reach`` characters on both sides of a candidate. Parts of LEAST characters or more
    that it has too (another copy, also one within a longer string or cut by the border) are
    blanked, as they would hide it."""
    c = text[start:end]

    def blanked(side: str) -> str:
        shared = [i for i in range(len(side) - LEAST + 1) if side[i:i + LEAST] in c]
        for i in shared:
            side = side[:i] + " " * LEAST + side[i + LEAST:]
        return side

    before = blanked(text[max(0, start - reach - LEAST + 1):start])
    after = blanked(text[end:end + reach + LEAST - 1])
    return (before[-reach:] + after[:reach]).encode(errors="replace")


def entropy(candidate: str) -> float:
    """Bits a character of the candidate's own letter frequencies."""
    n = len(candidate)
    return -sum(v / n * math.log2(v / n) for v in Counter(candidate).values())


def bound(candidate: str) -> float:
    """Bytes of a random string of this length over the letter and digit classes and the symbols it uses."""
    have = set(candidate)
    size = (26 * any(x.islower() for x in have) + 26 * any(x.isupper() for x in have)
            + 10 * any(x.isdigit() for x in have) + sum(not x.isalnum() for x in have))
    return len(candidate) * math.log2(max(size, 2)) / 8


def is_novel(compressor_for, around: bytes, candidate: str) -> bool:
    """Whether the candidate is, or a part of it between separators that is long enough."""
    parts = [p for p in SEPARATORS.split(candidate) if LEAST <= len(p) < len(candidate)]
    return any(_is_novel(compressor_for, around, c) for c in (candidate, *parts))


def _is_novel(compressor_for, around: bytes, candidate: str) -> bool:
    bits = entropy(candidate)
    if bits < MIN_BITS:
        return False
    added = novelty(compressor_for, around, candidate.encode())
    if len(candidate) > LONG:
        return added >= 0.97 * len(candidate) * bits / 8
    if len(candidate) >= 64 and added >= bound(candidate):       # there the compressor may code the letters of one order and not of another
        return True
    letters, rng, total = list(candidate), random.Random(crc32(candidate.encode())), 0
    for _ in range(SHUFFLES):
        rng.shuffle(letters)
        total += novelty(compressor_for, around, "".join(letters).encode())
    return SHUFFLES * added >= MIN_RATIO * total


def merged(spans: Iterable[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of the stretches that spans, sorted by start, cover."""
    out: list[tuple[int, int]] = []
    for a, _, b in spans:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def uncovered(matches, covered: list[tuple[int, int]]):
    """The matches, in order, that touch no covered stretch."""
    j = 0
    for m in matches:
        while j < len(covered) and covered[j][1] <= m.start():
            j += 1
        if j == len(covered) or m.end() <= covered[j][0]:
            yield m


def novel_spans(text: str, known: list[tuple[int, int, int]], compressor_for, *,
                reach: int = 80) -> list[tuple[int, int, int]]:
    """Incompressible strings within ``reach`` characters of a sensitive word, and wherever
    else in the text they stand, other than those that the known spans cover."""
    near = [m.span() for m in SENSITIVE.finditer(text)]
    covered = merged(known)
    out, i, gap = [], 0, -1
    for m in uncovered(CANDIDATE.finditer(text), covered) if near else ():
        while i < len(near) and near[i][1] + reach <= m.start():
            i += 1
        if i == len(near):
            break
        lo = near[i][0] - reach
        if m.end() <= lo:        # out of reach, unless the unbroken string that lo cuts begins here
            if gap < m.end():
                found = GAP.search(text, m.end())
                gap = found.start() if found else len(text)
            if gap < lo:
                continue
        if is_novel(compressor_for, surroundings(text, m.start(), m.end(), reach), m.group()):
            out.append((m.start(), 3, m.end()))
    secrets = {text[s:e] for s, _, e in out}
    if secrets:
        out += [(m.start(), 3, m.end()) for m in uncovered(CANDIDATE.finditer(text), covered) if m.group() in secrets]
    return sorted(set(out))


def spans_of(text: str, compressor_for) -> tuple[list, list]:
    base = base_spans(text)
    return base, sorted(set(base + novel_spans(text, base, compressor_for)))


WORD_PARTS = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{3,}(?![a-z])")
#: Modules whose names and descriptions are taken as code.
MODULES = ("builtins os re json logging logging.handlers argparse configparser socket ssl subprocess datetime collections unittest "
           "http.client http.server http.cookies urllib.request urllib.parse email.message threading multiprocessing asyncio sqlite3 csv "
           "xml.etree.ElementTree hashlib hmac secrets base64 pathlib shutil tempfile signal errno stat inspect ast typing "
           "concurrent.futures dataclasses queue statistics string traceback uuid zipfile tarfile platform getpass locale "
           "ftplib imaplib smtplib mimetypes selectors decimal calendar codecs io html xmlrpc.client ipaddress").split()


@lru_cache(maxsize=1)
def library_words() -> tuple[str, ...]:
    """Words of the identifiers that the standard library defines, the most frequent first."""
    often: Counter = Counter()
    for name in MODULES:
        try:
            module = importlib.import_module(name)
        except ImportError:                   # a module that this Python lacks adds nothing
            continue
        names = {*name.split("."), *dir(module)}
        for x in dir(module):
            thing = getattr(module, x, None)
            if isinstance(thing, type):
                names.update(dir(thing))
            if callable(thing):
                names.update(re.findall(r"[A-Za-z_]{3,}", str(getattr(thing, "__doc__", None) or "")[:2000]))
        often.update(w.lower() for n in names for w in WORD_PARTS.findall(n))
    return tuple(sorted(often, key=lambda w: (-often[w], w))[:LIBRARY_WORDS])


def corpus_identifiers(docs: DataFrame, *, text: str = "text", most: int = 1500) -> list[str]:
    """The ``most`` frequent words that stand in three or more different identifiers (strings with an
    underscore, dot, slash or inner capital) of the documents, all of which are read."""
    token = (docs.select(F.explode(F.regexp_extract_all(
        text, F.lit(r"([A-Za-z]+(?:[_./-][A-Za-z0-9]+)+|[a-z]+(?:[A-Z][a-z]+)+)"), F.lit(1))).alias("t")).distinct())
    parts = (token.select("t", F.explode(F.array_distinct(F.transform(F.regexp_extract_all("t", F.lit("([A-Z]?[a-z]{2,}|[A-Z]{3,})"), F.lit(1)),
                                                                        F.lower))).alias("w"))
             .groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("n >= 3"))
    return [r["w"] for r in parts.orderBy(F.col("n").desc(), "w").limit(most).collect()]        # words, ``most`` of them


def trained(dictionary: str = IDENTIFIERS, words: Iterable[str] = ()) -> bytes:
    """Content of the zstandard dictionary: each word in upper case, capitalised and in lower case,
    the words of the corpus and of secrets' surroundings last, where they are coded shortest."""
    more = [*dict.fromkeys([*library_words(), *words])]
    return " ".join([*(w.upper() for w in more), *(w.capitalize() for w in more), *more, *dictionary.split()]).encode()


class Primed:
    """A compressor that knows the dictionary. Every input begins with a stretch of the dictionary's own, so that
    it is always worth compressing and short ones aren't stored as they are."""

    def __init__(self, content: bytes, level: int):
        import zstandard
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        self.lead = content[-LEAD - 100:-100]
        self.made = zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)

    def compress(self, data: bytes) -> bytes:
        return self.made.compress(self.lead + data)


def primed(dictionary: bytes | None = None, level: int = LEVEL):
    """A function that gives a compressor primed with the dictionary."""
    compressor = Primed(trained() if dictionary is None else dictionary, level)
    return lambda: compressor


def render(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, *, text: str = "text", carry: tuple[str, ...] = ("doc_id",),
         dictionary: str = IDENTIFIERS) -> DataFrame:
    """carry columns, spans (array of kind, start, end, in order) and n_base, and the same
    rendered as text (``base``, ``all``)."""
    kinds = dict((f.name, f.dataType) for f in docs.schema)
    # once, on the driver: the same bytes for every task
    learned = trained(dictionary, corpus_identifiers(docs, text=text))

    def run(batches):
        compressor_for = primed(learned)
        for batch in batches:
            for first, texts in slabs(batch.column(len(carry))):
                base, every, n = [], [], [[], [], [], []]
                for t in texts:
                    b, a = spans_of(t.decode(), compressor_for)
                    base.append(hashlib.sha256(render(b).encode()).hexdigest())
                    every.append(render(a))
                    for k in range(4):
                        n[k].append(sum(x[1] == k for x in a))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(first, len(texts)) for i in range(len(carry))],
                     *[pa.array(x, pa.int64()) for x in n], pa.array(base, pa.string()), pa.array(every, pa.string())],
                    names=[*carry, "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"])

    small_batches(docs.sparkSession)
    schema = ", ".join([*[f"`{c}` {kinds[c].simpleString()}" for c in carry],
                        "n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string"])
    return docs.select(*carry, F.col(text).alias("text")).mapInArrow(run, schema)


def span_rows(scanned: DataFrame) -> DataFrame:
    """One row per span: the carried columns, kind, start, end."""
    each = scanned.where("spans <> ''").withColumn("__p", F.explode(F.split("spans", ",")))
    parts = F.split("__p", ":")
    return (each.withColumns({"kind": F.get(parts, F.lit(0)), "start": F.get(parts, F.lit(1)).cast("long"),
                              "end": F.get(parts, F.lit(2)).cast("long")}).drop("__p", "spans"))
