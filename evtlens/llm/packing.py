"""Packing: concatenate all token streams and cut them into fixed windows.

Two passes. The first tokenizes each partition once and writes, for every document, its
ids with its place in the partition's stream; a table of partition totals follows. The
prefix sums over these totals (one row per partition) turn places into global offsets.
The second pass cuts each document at the window borders its offsets cross, so a window
border makes a boundary record on either side of it. All windows but the last one are
full, so at most one window is padded.

The streams are joined in partition order; the table of the first pass holds one
successful attempt of each task, so a lost executor can't change the offsets.

Tokenizing goes word by word: white space never joins a token of the word tokenizer, so
the ids of a text are those of its words in order. Texts are split into words, and each distinct word is encoded once.

Defined results: a null text is empty; every document, empty ones too, ends with the end
id, so it has at least one token; an empty table has no windows; repeated rows are packed
as often as they occur.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, written

SLAB_BYTES = 4_000_000
#: A worker remembers the ids of so many words, and of as many older ones.
CACHE_WORDS = 300_000

# How the word tokenizer's file cuts lower-case text, and what that comes
# to for printable ASCII without white space.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


def _byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable
    Latin-1 stands for itself, the others get the characters from 256 on in turn."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [x for x in range(256) if x not in printable]
    return [chr(x) if x in printable else chr(256 + others.index(x)) for x in range(256)]


class WordIds(dict):
    """word -> ids, as bytes; missing words are encoded. When it is full, what it holds
    becomes the older half, from which words in use come back."""

    def __init__(self, encode: Callable[[bytes], bytes], limit: int):
        self.encode, self.limit, self.older = encode, limit, {}

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(word)
        if ids is None:
            ids = self.encode(word)
        self[word] = ids
        return ids


@lru_cache(maxsize=4)
def word_tokenizer(path: str) -> tuple[Callable[[bytes], bytes], int, Callable[[], None]]:
    """For a tokenizer file whose pre-tokenizer ends tokens at white space: a function from
    UTF-8 text to its ids as little-endian bytes, the bytes of an id, and a function that
    frees memory between tasks.

    Each distinct word is cut into pieces as the file says and its pieces are encoded by the
    library's model. Words of Latin letters (a comma or full stop behind them) and
    printable ASCII are cut here, others by the library; words that may hold special tokens
    go through the whole tokenizer. A Python worker keeps what it has learnt for its
    next tasks."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    model, normal, cutter = tok.model, tok.normalizer, tok.pre_tokenizer
    plain = json.loads(tok.to_str())["pre_tokenizer"]["pretokenizers"][0]["pattern"].get("Regex") == SPLIT
    chars = dict(enumerate(_byte_chars()))
    kind = "H" if tok.get_vocab_size() <= 65536 else "I"
    if sys.byteorder != "little":
        raise RuntimeError("ids are written in the machine's byte order, which must be little-endian")

    def latin(word: str) -> bool:
        """Letters whose normal, lower-case forms are letters again (that of U+0130 ends in a mark,
        which would join what follows)."""
        return word.isalpha() and (word.isascii() or max(word) < "\u0250" and "\u0130" not in word and is_normalized("NFC", word))

    def pieces(word: str) -> list[str]:
        if plain:
            if latin(word):
                return [word if word.isascii() else word.lower().encode().decode("latin-1").translate(chars)]
            elif word.isascii() and word.isprintable():
                return ASCII_SPLIT.findall(word)
        return [p for p, _ in cutter.pre_tokenize_str(normal.normalize_str(word))]

    def ids_of(word: bytes) -> bytes:
        """A word's ids; its ASCII letters are lower case unless it holds ``<|``."""
        if b"<|" in word:
            return array(kind, tok.encode(word.decode(), add_special_tokens=False).ids).tobytes()
        text = word.decode()
        if plain and text[-1] in ",." and latin(text[:-1]):
            return words[word[:-1]] + words[word[-1:]]
        return array(kind, [t.id for p in pieces(text) for t in model.tokenize(p)]).tobytes()

    words = WordIds(ids_of, CACHE_WORDS)

    def encode(text: bytes) -> bytes:
        # the file lowers upper-case ASCII too, but not in a special token
        split = text.lower().split() if b"<|" not in text else [w if b"<|" in w else w.lower() for w in text.split()]
        return b"".join(map(words.__getitem__, split))

    def forget() -> None:
        """An idle worker keeps the words of its last texts only."""
        words.older = {}

    return encode, array(kind).itemsize, forget


def slabs(column: pa.Array, limit: int = SLAB_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of a string column as (first row, UTF-8 texts) of about ``limit`` bytes."""
    texts, first, size = [], 0, 0
    for i, t in enumerate(column.cast(pa.binary()).to_pylist()):
        texts.append(t or b"")
        size += len(texts[-1])
        if size >= limit:
            yield first, texts
            texts, first, size = [], i + 1, 0
    if texts:
        yield first, texts


def tokenized(docs: DataFrame, tokenizer_path: str, *, end_id: int = 1, text: str = "text",
              key: str = "doc_id") -> DataFrame:
    """First pass: key, part, start (in the part's stream), doc_tokens, ids (little-endian
    unsigned 16-bit where the vocabulary allows, else 32-bit; ``width`` bytes each)."""
    kind = dict((f.name, f.dataType) for f in docs.schema)[key]

    def run(batches):
        encode, width, forget = word_tokenizer(tokenizer_path)
        tail = end_id.to_bytes(width, "little")
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            keys = batch.column(0)
            for first, texts in slabs(batch.column(1)):
                out = [encode(t) + tail for t in texts]
                sizes = [len(x) // width for x in out]
                starts = [at, *accumulate(sizes, initial=at)][1:-1]
                at += sum(sizes)
                yield pa.RecordBatch.from_arrays([
                    keys.slice(first, len(texts)), pa.array([part] * len(texts), pa.int32()),
                    pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array([width] * len(texts), pa.int32()), pa.array(out, pa.binary())],
                    names=["key", "part", "start", "doc_tokens", "width", "ids"])
        forget()

    small_batches(docs.sparkSession)
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind.simpleString()}, part int, start long, doc_tokens long, width int, ids binary")


def packed(docs: DataFrame, tokenizer_path: str, *, window: int = 2048, end_id: int = 1,
           text: str = "text", key: str = "doc_id") -> DataFrame:
    """Pieces: key, start, length, doc_tokens, sequence_id, offset, ids (unsigned 32-bit,
    little-endian)."""
    first = written(tokenized(docs, tokenizer_path, end_id=end_id, text=text, key=key), "pack-tokens")
    kind = dict((f.name, f.dataType) for f in first.schema)["key"]
    totals = first.groupBy(F.col("part").alias("of_part")).agg(F.sum("doc_tokens").alias("total"))
    before = Window.orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)   # a row per partition
    offsets = totals.select("of_part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # one row of 12 bytes for each task of the first pass
    second = (first.join(F.broadcast(offsets), F.col("part") == F.col("of_part"))
              .select("key", (F.col("base") + F.col("start")).alias("at"), "doc_tokens", "width", "ids"))

    def cut(batches):
        for batch in batches:
            keys, cols = batch.column(0), [c.to_pylist() for c in batch.columns[1:]]
            rows, piece = [], []
            for i, (at, n, width, raw) in enumerate(zip(*cols, strict=True)):
                ids = np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes()
                start = 0
                while start < n:
                    seq, off = divmod(at + start, window)
                    length = min(window - off, n - start)
                    rows.append(i)
                    piece.append((start, length, n, seq, off, ids[4 * start:4 * (start + length)]))
                    start += length
            parts = list(zip(*piece, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(rows, pa.int64())), *[pa.array(p, pa.int64()) for p in parts[:5]],
                 pa.array(parts[5], pa.binary())],
                names=["key", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return second.mapInArrow(cut, f"key {kind.simpleString()}, start long, length long, doc_tokens long, "
                                  "sequence_id long, offset long, ids binary")


def sequences(pieces: DataFrame, window: int = 2048, pad_id: int = 0) -> DataFrame:
    """The windows themselves: sequence_id, n_tokens, padding, pieces in order. A window
    has at most ``window`` pieces, as each has a token at least. A window whose length is a
    power of two is left so; any other is padded to the full length."""
    got = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("offset", "length", "key", "start", "ids"))).alias("pieces"))
    n = F.col("n_tokens")
    return got.withColumn("padding", F.when(n.bitwiseAND(n - 1) == 0, 0).otherwise(F.lit(window) - n).cast("long"))
