"""Toxicity: a convolutional text classifier, trained here in numpy.

A text is its sequence of lower-case letter words. A word is hashed into a bucket, and buckets
known from enough training texts have an embedding; all others share the zero vector. Filters of
several widths (one, two, three words) slide over the embeddings, each filter keeps its largest response in
the text (max pooling), and a linear layer on the rectified maxima gives the logit. As the
largest response counts, one passage marks a text of any length; whole texts are read.

Training (Adam on the filters, Adagrad on the embeddings, balanced classes, word dropout) reads every labelled
text, whole, and is spread over Spark tasks (:func:`train`). Document frequencies, which choose the at most
``max_buckets`` known buckets, and the languages' word counts are Spark aggregations over all of them. A fifth of the texts (by
text hash, so that copies stay together) is kept from the filters: it picks the pass and the thresholds. The others are dealt, by
the hash of their key, to turns of at most ``wide`` parts. In a turn every part is a task's: it goes on from the common
parameters with the texts of its part and returns the parameters it changed, and their averages (a word's by how often
a task moved it) are the next turn's. A pass over all turns takes every text once; there are two passes at least, more
where that gives a task fewer than ``least_steps`` steps. What reaches the driver is ``wide`` times the
parameters at most, whatever the number of texts. :func:`fit` is the same training in one process on a list of texts, and
:func:`sample` a bounded one to try it on; neither has a part in :func:`train`.

Thresholds are calibrated by language. The language of a text is itself told from its words
(naive Bayes over the known buckets, learnt from the language labels), so a label of
the text to be scored is never read. The threshold is the one with the best F1 at the labels' true shares. A language with
few calibration texts of a label shares those of the others: they count in full where it has none, less the more
it has, and no more from ``OWN`` of either label on. :func:`train` counts logits in steps of 1 / ``STEPS``.
The score is the logistic function of the logit less the threshold, so 0.5 is the threshold.

Scoring is one pass without a shuffle; the model (some megabytes at most, by its parameters) is broadcast.

Defined results: a null or empty text, or one without letters, is scored as a text of one unknown word;
of rows equal in key the one with the least text hash is learnt from, and of several labels of a key the
greatest; keys that are null are never learnt from; labels other than 0 and 1 don't count. With
fewer than ``LEAST`` texts of either label every score is 0.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_folder, small_batches, written
from .packing import slabs

WORDS = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 22
WIDTHS = (1, 2, 3)
LEAST = 5                    # texts of a label, to learn or calibrate from
OWN = 5 * LEAST              # texts of either label, from which on a language is calibrated alone
STEPS = 256                  # of a unit of the logit, in the counts that thresholds are found from
CHUNK = 1 << 17              # words convolved at a time
PAD = max(WIDTHS) - 1


@dataclass
class Model:
    buckets: np.ndarray                          # known buckets, ascending; row 0 of the tables is the unknown word
    tables: dict                                 # (width, offset) -> response of each known word to each filter
    bias: dict                                   # width -> per filter
    out: np.ndarray
    constant: float
    languages: list[str] = field(default_factory=list)
    language_table: np.ndarray | None = None     # log likelihoods
    thresholds: dict = field(default_factory=dict)
    threshold: float = 0.0                       # of the other languages


def hashed(text: str) -> list[int]:
    return [crc32(w.encode()) & (BUCKETS - 1) for w in WORDS.findall(text.lower())]


def laid_out(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word rows of the texts in one array, with zeros between them that keep windows apart;
    starts, and positions of each text (one at least)."""
    n = np.array([max(len(d), 1) for d in docs], np.int64)
    starts = np.concatenate([[0], np.cumsum(n + PAD)[:-1]]).astype(np.int64)
    flat = np.zeros(int(n.sum()) + PAD * len(docs), np.int64)
    for s, d in zip(starts.tolist(), docs, strict=True):
        flat[s:s + len(d)] = d
    return flat, starts, n


def _segments(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.stack([starts, starts + n], 1).ravel()


def pooled(model: Model, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the rectified maxima of all filters, and the log likelihoods of the languages."""
    filters = len(model.out) // len(WIDTHS)
    top = np.zeros((len(docs), len(model.out)), np.float32)
    lang = np.zeros((len(docs), len(model.languages)), np.float64)

    def convolved(flat, width):
        return sum(model.tables[width, j][flat[j:len(flat) - PAD + j]] for j in range(width)) + model.bias[width]

    def one_chunk(first, flat, starts, n):
        cuts, last, rows = _segments(starts, n), len(flat) - PAD, slice(first, first + len(n))
        cuts = cuts[:-1] if cuts[-1] >= last else cuts
        for k, width in enumerate(WIDTHS):
            best = np.maximum.reduceat(convolved(flat, width), cuts, axis=0)[::2]
            at = slice(k * filters, (k + 1) * filters)
            top[rows, at] = np.maximum(top[rows, at], best)
        if len(model.languages):
            lang[rows] += np.add.reduceat(model.language_table[flat[:last]], cuts, axis=0)[::2]

    first, part, size = 0, [], 0
    for i, d in enumerate(docs):
        if size + len(d) > CHUNK and part:
            one_chunk(first, *laid_out(part))
            first, part, size = i, [], 0
        if len(d) > CHUNK:                   # a very long text in pieces that look ahead; their maximum counts
            whole = np.concatenate([d, np.zeros(PAD, np.int64)])
            for at in range(0, len(d), CHUNK):
                piece = whole[at:at + CHUNK + PAD]
                one_chunk(i, piece, np.array([0]), np.array([len(piece) - PAD]))
            first = i + 1
        else:
            part.append(d)
            size += len(d)
    if part:
        one_chunk(first, *laid_out(part))
    return top, lang


def scores(model: Model, docs: list[np.ndarray]) -> np.ndarray:
    if not len(docs):
        return np.zeros(0)
    logit, told = logits(model, docs)
    limits = np.array([model.thresholds.get(x, model.threshold) for x in model.languages] or [model.threshold])
    return 1 / (1 + np.exp(-np.clip(logit - limits[told], -50, 50)))


def best_threshold(logit: np.ndarray, label: np.ndarray, weight: np.ndarray) -> float:
    """The logit with the best F1 at these weights, midway to the next lower one."""
    order = np.argsort(-logit, kind="stable")
    y, w, x = label[order], weight[order], logit[order]
    hits, taken = np.cumsum(w * y), np.cumsum(w)
    f1 = 2 * hits / (taken + (w * y).sum())
    f1[:-1][x[:-1] == x[1:]] = -1                       # equal logits fall together
    k = int(f1.argmax())
    return float(x[k] - 1e-6 if k + 1 == len(x) else (x[k] + x[k + 1]) / 2)


class Net:
    """The parameters in training, with the state of their optimizers."""

    def __init__(self, known: int, dim: int, filters: int, spread: float, rng: np.random.Generator):
        self.filters, self.step = filters, 0
        self.emb = (rng.standard_normal((known + 1, dim)) * spread).astype(np.float32)
        self.emb[0] = 0
        self.dense = {("w", w): (rng.standard_normal((w, dim, filters)) * 0.3).astype(np.float32) for w in WIDTHS}
        self.dense |= {("b", w): np.zeros(filters, np.float32) for w in WIDTHS}
        self.dense |= {"v": (rng.standard_normal(filters * len(WIDTHS)) * 0.3).astype(np.float32), "c": np.zeros(1, np.float32)}
        self.mean, self.square = ({k: np.zeros_like(v) for k, v in self.dense.items()} for _ in range(2))
        self.gathered = np.zeros(len(self.emb), np.float32)

    def model(self, buckets: np.ndarray) -> Model:
        d = self.dense
        tables = {(w, j): self.emb @ d["w", w][j] for w in WIDTHS for j in range(w)}
        return Model(buckets, tables, {w: d["b", w].copy() for w in WIDTHS}, d["v"].astype(np.float64), float(d["c"][0]))

    def _spots(self, flat: np.ndarray, starts: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per width: the words under each filter's largest response (filters x texts x width), and that response."""
        every = np.concatenate([self.dense["w", w][j] for w in WIDTHS for j in range(w)], 1).T @ self.emb[flat].T    # filters x words
        found, row = [], 0
        for w in WIDTHS:
            conv = self.dense["b", w][:, None]
            for j in range(w):
                conv = conv + every[row:row + self.filters, j:len(flat) - PAD + j]
                row += self.filters
            spot = np.stack([conv[:, s:s + m].argmax(1) + s for s, m in zip(starts.tolist(), n.tolist(), strict=True)], 1)
            found.append((flat[spot[..., None] + np.arange(w)], np.take_along_axis(conv, spot, 1)))
        return found

    def spots(self, flat: np.ndarray, starts: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        if len(n) > 1 or n[0] <= CHUNK:
            return self._spots(flat, starts, n)
        best = None
        for at in range(0, int(n[0]), CHUNK):                # a very long text in pieces that look ahead
            piece = flat[at:at + CHUNK + PAD]
            part = self._spots(piece, np.array([0]), np.array([len(piece) - PAD]))
            best = part if best is None else [(np.where((v > u)[..., None], r, q), np.maximum(u, v))
                                              for (q, u), (r, v) in zip(best, part, strict=True)]
        return best

    def learn(self, docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray, rng: np.random.Generator, *, batch: int, rate: float,
              pace: float, dropout: float, moved: np.ndarray | None = None) -> None:
        """One pass over the texts in their order; ``moved`` counts the steps that changed a word."""
        first, words = 0, 0
        for i, d in enumerate(docs):
            if i > first and (i - first == batch or words + len(d) + PAD > CHUNK):
                self._step(docs[first:i], y[first:i], weight[first:i], batch, rng, rate, pace, dropout, moved)
                first, words = i, 0
            words += len(d) + PAD
        if docs:
            self._step(docs[first:], y[first:], weight[first:], len(docs) - first, rng, rate, pace, dropout, moved)

    def _step(self, docs, y, weight, of, rng, rate, pace, dropout, moved) -> None:
        flat, starts, n = laid_out(docs)
        flat[rng.random(len(flat), np.float32) < dropout] = 0
        found, dense, filters = self.spots(flat, starts, n), self.dense, self.filters
        top = np.maximum(np.concatenate([v.T for _, v in found], 1), 0)
        p = 1 / (1 + np.exp(-np.clip(top @ dense["v"] + dense["c"], -30, 30)))
        slope = ((p - y) * weight / of).astype(np.float32)
        grad = {"v": top.T @ slope + 1e-4 * dense["v"], "c": slope.sum(keepdims=True)}
        back = slope[:, None] * dense["v"][None] * (top > 0)
        rows, change = [], []
        for k, w in enumerate(WIDTHS):
            g = back[:, k * filters:(k + 1) * filters]
            grad["b", w] = g.sum(0)
            part = np.empty_like(dense["w", w])
            for j in range(w):
                at = found[k][0][..., j].T
                part[j] = np.einsum("bfd,bf->df", self.emb[at], g)
                rows.append(at.ravel())
                change.append((g[..., None] * dense["w", w][j].T[None]).reshape(-1, self.emb.shape[1]))
            grad["w", w] = part + 1e-4 * dense["w", w]
        self.step += 1
        for key, g in grad.items():
            self.mean[key] = 0.9 * self.mean[key] + 0.1 * g
            self.square[key] = 0.999 * self.square[key] + 0.001 * g * g
            dense[key] -= rate * (self.mean[key] / (1 - 0.9 ** self.step)) / (np.sqrt(self.square[key] / (1 - 0.999 ** self.step)) + 1e-8)
        hit, of = np.unique(np.concatenate(rows), return_inverse=True)
        total = np.zeros((len(hit), self.emb.shape[1]), np.float32)
        np.add.at(total, of, np.concatenate(change))
        self.gathered[hit] += (total * total).sum(1)
        self.emb[hit] -= pace * total / (np.sqrt(self.gathered[hit])[:, None] + 1e-6)
        self.emb[0] = 0
        if moved is not None:
            moved[hit] += 1

    def changed(self, moved: np.ndarray, texts: int) -> dict:
        """What a task returns: all but the words that it did not move."""
        at = np.flatnonzero(moved)
        return {"at": at.astype(np.int32), "moved": moved[at], "emb": self.emb[at], "gathered": self.gathered[at], "texts": texts,
                "dense": self.dense, "mean": self.mean, "square": self.square, "step": self.step}

    def average(self, parts: list[dict]) -> None:
        """The mean of the tasks' parameters: by their texts, of a word by the steps that moved it."""
        share = np.array([p["texts"] for p in parts], np.float64) / sum(p["texts"] for p in parts)
        for name in ("dense", "mean", "square"):
            mine = getattr(self, name)
            for key in mine:
                mine[key] = sum(s * p[name][key] for s, p in zip(share, parts, strict=True)).astype(np.float32)
        self.step = round(float(share @ [p["step"] for p in parts]))
        count = np.zeros(len(self.emb))
        emb, gathered = np.zeros(self.emb.shape), np.zeros(len(self.emb))
        for p in parts:
            count[p["at"]] += p["moved"]
            emb[p["at"]] += p["moved"][:, None] * p["emb"]
            gathered[p["at"]] += p["moved"] * p["gathered"]
        hit = np.flatnonzero(count)
        self.emb[hit] = emb[hit] / count[hit, None]
        self.gathered[hit] = gathered[hit] / count[hit]
        self.emb[0] = 0


def rows_of(buckets: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Rows of hashed words in the tables; 0 where the bucket isn't known."""
    at = np.searchsorted(buckets, words).clip(max=max(len(buckets) - 1, 0))
    return np.where(buckets[at] == words, at + 1, 0) if len(buckets) and len(words) else np.zeros(len(words), np.int64)


def apart(text: bytes) -> bool:
    """Whether a text is kept from the filters."""
    return hashlib.md5(text).digest()[0] % 5 == 0


def _loss(logit: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, np.where(y == 1, -logit, logit))


def fit(texts: list[tuple[str, int, str | None]], shares: tuple[float, float] = (0.5, 0.5), *, dim: int = 16, filters: int = 8,
        min_docs: int = 5, max_buckets: int = 65_536, epochs: int = 14, least_steps: int = 600, patience: int = 6, batch: int = 48,
        rate: float = 0.004, pace: float = 0.05, spread: float = 0.01, dropout: float = 0.35, max_languages: int = 32,
        seed: int = 7) -> Model | None:
    """In one process, for lists of texts: (text, label, language or None); ``shares``: of labels 0 and 1 in the corpus."""
    rng = np.random.default_rng(seed)
    y = np.array([t[1] for t in texts], np.float64)
    if min((y == 0).sum(), (y == 1).sum()) < LEAST:
        return None
    words = [np.array(hashed(t[0]), np.int64) for t in texts]
    seen, often = np.unique(np.concatenate([np.unique(w) for w in words] or [[]]), return_counts=True)
    order = np.lexsort((seen, -often))
    buckets = np.sort(seen[order][often[order] >= min(min_docs, max(2, len(texts) // 40))][:max_buckets]).astype(np.int64)
    docs = [rows_of(buckets, w) for w in words]
    kept = np.array([apart(t[0].encode(errors="replace")) for t in texts])
    if min((y[kept] == 0).sum(), (y[kept] == 1).sum(), (y[~kept] == 0).sum(), (y[~kept] == 1).sum()) < LEAST:
        kept = np.ones(len(texts), bool)                  # too few to keep some apart
        learn = np.arange(len(texts))
    else:
        learn = np.flatnonzero(~kept)
    weight = np.where(y == 1, 0.5 / (y[learn] == 1).mean(), 0.5 / (y[learn] == 0).mean())

    net = Net(len(buckets), dim, filters, spread, rng)
    check = [docs[i] for i in np.flatnonzero(kept)]
    best, least, waited = None, np.inf, 0
    for _ in range(max(epochs, min(4 * epochs, least_steps * batch // len(learn)))):
        learn = rng.permutation(learn)
        net.learn([docs[i] for i in learn], y[learn], weight[learn], rng, batch=batch, rate=rate, pace=pace, dropout=dropout)
        made = net.model(buckets)
        loss = np.average(_loss(logits(made, check)[0], y[kept]), weights=weight[kept])
        if loss < least:
            best, least, waited = made, loss, 0
        elif (waited := waited + 1) == patience:
            break
    names, often = np.unique([t[2] for t in texts if t[2] is not None] or np.array([], str), return_counts=True)
    names = names[np.lexsort((names, -often))][:max_languages].tolist()
    counts = np.zeros((len(names), len(buckets) + 1))
    for d, t in zip(docs, texts, strict=True):
        if t[2] in names:
            np.add.at(counts[names.index(t[2])], d, 1)
    _languages(best, names, counts)
    logit, told = logits(best, check)
    _thresholds(best, logit, told, y[kept], np.ones(len(check)), shares)
    return best


def logits(model: Model, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the logit, and the number of the language it is told to be in (0 without languages)."""
    top, lang = pooled(model, docs)
    return top.astype(np.float64) @ model.out + model.constant, lang.argmax(1) if model.languages else np.zeros(len(docs), int)


def _thresholds(model: Model, logit: np.ndarray, told: np.ndarray, y: np.ndarray, n: np.ndarray, shares: tuple[float, float]) -> None:
    """From the kept texts' logits, languages and labels; ``n`` texts each."""
    natural = n * np.where(y == 1, shares[1] / max(n[y == 1].sum(), 1), shares[0] / max(n[y == 0].sum(), 1))
    model.threshold = best_threshold(logit, y, natural)
    for k, name in enumerate(model.languages):
        own = told == k
        rarer = min(n[own & (y == 1)].sum(), n[own & (y == 0)].sum())
        if rarer >= LEAST:
            near = own | (rarer < OWN)                    # few of its own: the others' count too, the less the more there are
            weight = natural * np.where(own, 1, 1 - rarer / OWN)
            model.thresholds[name] = best_threshold(logit[near], y[near], weight[near])


def _languages(model: Model, names: list[str], counts: np.ndarray) -> None:
    """Naive Bayes over the known words, from how often each occurs in the languages' texts."""
    counts = counts + 1.0
    counts[:, 0] = 0
    table = np.zeros_like(counts)
    if len(model.buckets):
        table[:, 1:] = np.log(counts[:, 1:] / counts[:, 1:].sum(1, keepdims=True))
    model.languages, model.language_table = names, np.ascontiguousarray(table.T)


def _marks(marks: DataFrame, key: str, label: str) -> DataFrame:
    """key, y, and draw, the hash by which texts are dealt; one row a key."""
    marks = (marks.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).alias("key"))
             .agg(F.max(label).cast("int").alias("y")))
    return marks.withColumn("draw", F.xxhash64(F.lit(42), "key"))


def sample(docs: DataFrame, marks: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", label: str = "toxic",
           per_label: int = 3000, max_chars: int = 200_000, sample_chars: int = 24_000_000) -> tuple[list, tuple[float, float]]:
    """The bounded training sample (text, label, language) and the shares of the two labels."""
    marks = written(_marks(marks, key, label), "toxic-marks")
    often = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}     # two rows
    total = max(sum(often.values()), 1)
    drawn = [marks.where(F.col("y") == y).orderBy("draw", "key").limit(per_label) for y in (0, 1)]
    keys = drawn[0].unionByName(drawn[1])                                     # 2 x per_label rows of three numbers
    picked = (docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
              .where(F.col("key").isNotNull() & (F.char_length("text") <= max_chars))
              .join(F.broadcast(keys), "key")
              .groupBy("key", "y", "draw").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "lang")).alias("of")))
    picked = written(picked.select("y", "draw", "key", "of.text", "of.lang"), "toxic-sample")
    sizes = picked.select("y", "draw", "key", F.char_length("text").alias("n")).orderBy("draw", "key").collect()
    room, last = {0: sample_chars // 2, 1: sample_chars // 2}, {}
    for r in sizes:                                                           # up to the character bound of each label
        room[r["y"]] -= r["n"]
        if room[r["y"]] >= 0:
            last[r["y"]] = r["draw"]
    inside = F.lit(False)
    for y, draw in last.items():
        inside = inside | ((F.col("y") == y) & (F.col("draw") <= draw))
    rows = picked.where(inside).orderBy("draw", "key").select("text", "y", "lang").collect()
    return [tuple(r) for r in rows], (often.get(0, 0) / total, often.get(1, 0) / total)


def labelled(docs: DataFrame, marks: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang",
             label: str = "toxic") -> DataFrame:
    """Every labelled text: key, draw, y, lang, kept (from the filters), words (hashed)."""
    docs = (docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
            .where(F.col("key").isNotNull() & F.col("text").isNotNull()))
    one = (docs.join(_marks(marks, key, label), "key").groupBy("key", "y", "draw")
           .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "lang")).alias("of"))
           .select("key", "draw", "y", "of.lang", "of.text"))
    kind = one.schema["key"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for first, texts in slabs(batch.column(4)):
                words = [np.array(hashed(t.decode()), np.int32) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(first, len(texts)) for i in range(4)], pa.array([apart(t) for t in texts], pa.bool_()), _lists(words)],
                    names=["key", "draw", "y", "lang", "kept", "words"])

    small_batches(docs.sparkSession)
    return one.mapInArrow(run, f"key {kind}, draw long, y int, lang string, kept boolean, words array<int>")


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *[len(a) for a in arrays]])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *arrays]), pa.int32()))


def _arrays(column: pa.Array) -> list[np.ndarray]:
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy()
    return [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def train(docs: DataFrame, marks: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", label: str = "toxic",
          dim: int = 16, filters: int = 8, min_docs: int = 5, max_buckets: int = 65_536, max_languages: int = 32, passes: int = 2,
          most_passes: int = 56, least_steps: int = 600, patience: int = 6, batch: int = 48, rate: float = 0.004, pace: float = 0.05,
          spread: float = 0.01, dropout: float = 0.35, part_docs: int = 1500, wide: int = 32, seed: int = 7) -> Model | None:
    """The model learnt from all labelled texts; every pass over them is Spark's."""
    spark = docs.sparkSession
    texts = written(labelled(docs, marks, key=key, text=text, lang=lang, label=label), "toxic-words")
    often = {(r["y"], r["kept"]): r["n"] for r in texts.groupBy("y", "kept").agg(F.count(F.lit(1)).alias("n")).collect()}    # four rows
    both = [sum(often.get((y, k), 0) for k in (False, True)) for y in (0, 1)]
    if min(both) < LEAST:
        return None
    split = min(often.get((y, k), 0) for y in (0, 1) for k in (False, True)) >= LEAST        # else too few to keep some apart
    of = [often[y, False] if split else both[y] for y in (0, 1)]
    total = sum(of)
    weights = np.array([0.5 * total / of[0], 0.5 * total / of[1]])
    share = _marks(marks, key, label).groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()           # two rows
    share = {r["y"]: r["n"] / sum(x["n"] for x in share) for r in share}

    seen = (texts.select(F.explode(F.array_distinct("words")).alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min(min_docs, max(2, sum(both) // 40))).orderBy(F.col("n").desc(), "b").limit(max_buckets))
    buckets = np.sort(np.array([r["b"] for r in seen.collect()], np.int64))
    names = [r["lang"] for r in texts.where("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.col("n").desc(), "lang").limit(max_languages).collect()]

    side = max(1, min(total // part_docs, max(8, int((total / part_docs) ** 0.5)), wide))              # parts of a turn
    turns = max(1, total // part_docs // side)
    steps = total / side / batch                                                                       # of a task, in a pass
    passes = max(passes, min(most_passes, int(np.ceil(least_steps / steps))))
    again = max(1, min(8, passes // 4, int(24 // steps)))                                              # passes of a task in a turn
    path = _dealt(texts, buckets, names, split, turns, side)
    kinds = "y int, language int, words array<int>, turn int, part int"
    whole = spark.read.schema(kinds).parquet(path)
    check = whole.where("turn < 0") if split else whole

    rng = np.random.default_rng(seed)
    net = Net(len(buckets), dim, filters, spread, rng)
    best, least, waited = None, np.inf, 0
    for number in range(-(-passes // again)):
        for turn in rng.permutation(turns).tolist():
            rows = spark.read.schema(kinds).parquet(path).where(F.col("turn") == turn).select("part", "y", "words")
            parts = _turn(rows, net, weights, (seed, number, turn), again, batch=batch, rate=rate, pace=pace, dropout=dropout)
            if parts:
                net.average(parts)
        made = net.model(buckets)
        loss = _checked(check, made, weights)
        if loss < least:
            best, least, waited = made, loss, 0
        elif (waited := waited + 1) == patience:
            break
    counts = np.zeros((len(names), len(buckets) + 1))
    found = (whole.where("language >= 0").select("language", F.explode("words").alias("row")).where("row > 0")
             .groupBy("language", "row").agg(F.count(F.lit(1)).alias("n")).toArrow())       # max_languages x max_buckets rows at most
    counts[found["language"].to_numpy(), found["row"].to_numpy()] = found["n"].to_numpy()
    _languages(best, names, counts)
    told, step, y, n = _histogram(check, best)
    _thresholds(best, step / STEPS, told, y, n.astype(np.float64), (share.get(0, 0.0), share.get(1, 0.0)))
    return best


def _dealt(texts: DataFrame, buckets: np.ndarray, names: list[str], split: bool, turns: int, side: int) -> str:
    """The texts as rows of the tables, a file for each part of each turn (turn -1: kept from the filters)."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(buckets)

    def run(batches):
        known = shared.value
        for b in batches:
            words = [rows_of(known, w).astype(np.int32) for w in _arrays(b.column(5))]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(5)], _lists(words)],
                                             names=["draw", "key", "y", "language", "slot", "words"])

    language = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in names]), F.col("lang")).cast("int") - 1, F.lit(-1)) if names else F.lit(-1)
    slot = F.pmod("draw", F.lit(turns * side)).cast("int")
    if split:
        slot = F.when(F.col("kept"), -1 - slot).otherwise(slot)
    kind = texts.schema["key"].dataType.simpleString()
    small_batches(spark)
    rows = (texts.select("draw", "key", "y", language.alias("language"), slot.alias("slot"), "words")
            .mapInArrow(run, f"draw long, key {kind}, y int, language int, slot int, words array<int>")
            .withColumns({"turn": F.when(F.col("slot") < 0, -1).otherwise(F.floor(F.col("slot") / side).cast("int")),
                          "part": F.when(F.col("slot") < 0, -1 - F.col("slot")).otherwise(F.col("slot"))})
            .repartition("turn", "part").sortWithinPartitions("turn", "part", "draw", "key").select("y", "language", "words", "turn", "part"))
    path = shared_folder(spark, "toxic-parts")
    rows.write.option("compression", "zstd").partitionBy("turn", "part").parquet(path)
    return path


def _turn(rows: DataFrame, net: Net, weights: np.ndarray, seed: tuple, again: int, **pace) -> list[dict]:
    """What the parts of a turn make of the parameters, in the order of their numbers."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(pickle.dumps(net))

    def run(batches):
        def learnt(docs, y):
            docs, y = list(docs), np.array(y, np.int64)
            for _ in range(again):
                order = rng.permutation(len(docs))
                mine.learn([docs[i] for i in order], y[order].astype(np.float64), weights[y[order]], rng, moved=moved, **pace)

        def done():
            learnt(docs, labels)
            blob = pickle.dumps(mine.changed(moved, texts + len(docs)))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([blob], pa.binary())], names=["part", "blob"])

        part = None
        for b in batches:
            words = _arrays(b.column(2))
            for p, y, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), words, strict=True):
                if p != part:
                    if part is not None:
                        yield done()
                    part, mine, rng = p, pickle.loads(shared.value), np.random.default_rng((*seed, p))
                    moved, docs, labels, size, texts = np.zeros(len(mine.emb), np.int64), [], [], 0, 0
                docs.append(w)
                labels.append(y)
                size += len(w)
                if len(docs) == 4096 or size > 1 << 24:           # what a task holds at once
                    learnt(docs, labels)
                    texts += len(docs)
                    docs, labels, size = [], [], 0
        if part is not None:
            yield done()

    small_batches(spark)
    got = rows.mapInArrow(run, "part int, blob binary").collect()              # ``wide`` rows of parameters
    shared.unpersist()
    return [pickle.loads(r["blob"]) for r in sorted(got, key=lambda r: (r["part"], bytes(r["blob"])))]


def _checked(rows: DataFrame, model: Model, weights: np.ndarray) -> float:
    """The weighted loss over all rows, summed in whole numbers so that its order doesn't matter."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            y = b.column(0).to_numpy()
            lost = _loss(logits(shared.value, _arrays(b.column(1)))[0], y) * weights[y]
            yield pa.RecordBatch.from_arrays([pa.array([int(np.rint(lost * 1e6).sum())], pa.int64()),
                                              pa.array([int(np.rint(weights[y] * 1e6).sum())], pa.int64())], names=["lost", "of"])

    small_batches(rows.sparkSession)
    r = rows.select("y", "words").mapInArrow(run, "lost long, of long").agg(F.sum("lost").alias("lost"), F.sum("of").alias("of")).first()
    shared.unpersist()
    return r["lost"] / r["of"]


def _histogram(rows: DataFrame, model: Model) -> tuple[np.ndarray, ...]:
    """How many texts have a language, a logit (in steps) and a label: at most max_languages x 100 x STEPS x 2 rows."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            logit, told = logits(shared.value, _arrays(b.column(1)))
            step = np.rint(np.clip(logit, -50, 50) * STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(told.astype(np.int32)), pa.array(step), b.column(0)], names=["told", "step", "y"])

    small_batches(rows.sparkSession)
    found = (rows.select("y", "words").mapInArrow(run, "told int, step int, y int").groupBy("told", "step", "y")
             .agg(F.count(F.lit(1)).alias("n")).orderBy("told", "step", "y").toArrow())
    shared.unpersist()
    return tuple(found[c].to_numpy() for c in ("told", "step", "y", "n"))


def score(docs: DataFrame, model: Model | None, *, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """carry columns, score (0 to 1) and predicted (1 from 0.5 on)."""
    kinds = dict((f.name, f.dataType) for f in docs.schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)       # bounded by max_buckets, filters and max_languages

    def run(batches):
        m = shared.value
        row = {} if m is None else {b: i for i, b in enumerate(m.buckets.tolist(), 1)}
        for batch in batches:
            for first, texts in slabs(batch.column(len(carry))):
                if m is None:
                    s = np.zeros(len(texts))
                else:
                    s = scores(m, [np.array([row.get(h, 0) for h in hashed(t.decode())], np.int64) for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(first, len(texts)) for i in range(len(carry))],
                     pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())],
                    names=[*carry, "score", "predicted"])

    small_batches(docs.sparkSession)
    schema = ", ".join([*[f"`{c}` {kinds[c].simpleString()}" for c in carry], "score double, predicted int"])
    return docs.select(*carry, F.col(text).alias("text")).mapInArrow(run, schema)
