"""Suffix-array dedup: repeated byte strings across documents.

A byte is removed when it lies in a string of ``window`` bytes that also starts in a
document with a smaller key; strings never cross documents and are judged on the input.

A suffix array over every byte would move eight times the text. Instead the suffixes are
thinned so that nothing is lost, and only those that can repeat are sorted:

1. Thinning. In every window of 50 bytes the 24-byte string with the least hash is the
   window's anchor. Equal windows have equal anchors at equal places, so comparing the
   surroundings of equal anchors finds all equal windows. About one byte in 14 is an anchor.
2. Filter. Each chunk of documents sends the distinct hashes of its anchors, sorted and
   packed, to hash ranges; hashes that two chunks hold go back to those chunks.
3. Suffix sort. The suffixes at the remaining anchors, with the bytes before the anchor
   that their windows reach, are range-partitioned by their leading 16 bytes at sampled
   splitters. Each bucket sorts its suffixes by multikey sort, eight bytes at a time and
   only among ties; neighbours that share the anchor are compared window by window
   (equal hashes are checked byte for byte). Equal leading bytes never straddle a
   splitter, so suffixes of two buckets can't share an anchor and nothing is left to
   compare across the border. Each window's least document goes back to the chunks.
4. Each chunk marks the windows that a smaller document holds and cuts their bytes.

A chunk sends equal surroundings once, with its least document, so a passage that a third
of all documents hold is one record per chunk. Texts are shuffled once, to chunks by a
hash of key and text; the later steps read the same shuffle again. Chunks and buckets are
sized by the corpus (``chunk_bytes``, ``bucket_bytes``), so their number grows with it and
their size does not.

Defined results: a null text is empty; a null key is larger than any other; rows with
equal keys remove nothing from one another; texts shorter than the window are kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 24
_LAST = np.int64(2**63 - 1)
_MIX = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                               0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


# --- bytes of a chunk ------------------------------------------------------------------

def loads(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every place, as little-endian integers (zero padded)."""
    n = len(buf)
    buf = np.concatenate((buf, np.zeros(8, np.uint8)))
    out = np.empty(n, np.uint64)
    for s in range(min(8, n)):
        count = (n - s + 7) // 8
        out[s::8] = buf[s:s + 8 * count].view("<u8") if s + 8 * count <= len(buf) else \
            np.concatenate((buf[s:], np.zeros(8, np.uint8)))[:8 * count].view("<u8")
    return out


def gram_hashes(x: np.ndarray, n: int) -> np.ndarray:
    """Hash of the 24 bytes from each place that has them."""
    h = x[:n] * _MIX[0]
    h ^= h >> np.uint64(32)
    h += x[8:8 + n]
    h *= _MIX[1]
    h ^= h >> np.uint64(29)
    h += x[16:16 + n]
    h *= _MIX[2]
    h ^= h >> np.uint64(32)
    return h


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    return np.minimum(v[:len(v) - (width - size)], v[width - size:]) if size < width else v


def anchors(buf: np.ndarray, starts: np.ndarray, window: int):
    """Runs of windows with one anchor: hash, anchor place, first and last window, document.
    starts: where the documents begin, and the end."""
    none = np.zeros(0, np.int64)
    n, width = len(buf), window - GRAM + 1
    if n < window:
        return np.zeros(0, np.uint64), none, none, none, none
    h = gram_hashes(loads(buf), n - GRAM + 1)
    place = np.arange(len(h), dtype=np.uint64)
    least = sliding_min((h & np.uint64(0xFFFFFFFF00000000)) | place, width)
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    edge = np.zeros(len(at) + 1, np.int32)
    lo, hi = starts[:-1], np.minimum(starts[1:] - window + 1, len(at))
    ok = hi > lo
    np.add.at(edge, lo[ok], 1)
    np.add.at(edge, hi[ok], -1)
    valid = np.cumsum(edge[:-1]) > 0
    change = np.concatenate(([True], at[1:] != at[:-1]))
    # a window that starts another document is a run of its own
    change[lo[ok]] = True
    first = np.flatnonzero(valid & change)
    stop = valid.copy()
    stop[:-1] &= change[1:] | ~valid[1:]
    last = np.flatnonzero(stop)
    a = at[first]
    doc = np.searchsorted(starts, first, side="right") - 1
    return h[a], a, first, last, doc


def read_chunk(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """Bytes, document starts, document order and keys of a chunk. A shuffle delivers rows
    in any order; here they get one order, so that each pass numbers them alike."""
    rows = sorted(zip(table.column("k").to_pylist(), table.column("t").to_pylist(), strict=True),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    buf = np.frombuffer(b"".join(t for _, t in rows), np.uint8)
    starts = np.concatenate(([0], np.cumsum([len(t) for _, t in rows]))).astype(np.int64)
    order = np.array([_LAST if k is None else k for k, _ in rows], np.int64)
    return buf, starts, order, [k for k, _ in rows]


# --- packed arrays ---------------------------------------------------------------------

def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays of one length, bytes of equal weight together, compressed."""
    import zstandard
    body = [np.array([len(arrays[0])], "<u4").tobytes()]
    for a in arrays:
        body.append(np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(body))


def unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(data)
    n, at, out = int(np.frombuffer(raw, "<u4", 1)[0]), 4, []
    for k in kinds:
        w = np.dtype(k).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * w, at).reshape(w, n).T).view(k).ravel())
        at += n * w
    return out


def pack_keys(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, "<u8")[0], dtype=np.uint64)


# --- step 2: which anchors repeat ------------------------------------------------------

def short(hashes: np.ndarray) -> np.ndarray:
    """48 bits of an anchor's hash: what a chunk sends. Hashes that agree by chance only
    let a suffix into step 3, where bytes are compared."""
    return hashes >> np.uint64(16)


def hash_range(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)


def chunk_keys(window: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        buf, starts, _, _ = read_chunk(table)
        keys = np.unique(short(anchors(buf, starts, window)[0]))
        b = hash_range(keys, buckets)
        cut = np.flatnonzero(np.diff(b, prepend=b[:1] + np.uint64(1)))
        parts = np.split(keys, cut[1:]) if len(keys) else []
        return pa.table({"bucket": pa.array(b[cut].astype(np.int64) if len(keys) else [], pa.int64()),
                         "chunk": pa.array([chunk] * len(parts), pa.int64()),
                         "data": pa.array([pack_keys(p) for p in parts], pa.binary())})
    return run


def repeated_keys(table: pa.Table) -> pa.Table:
    """Of a hash range: to each chunk, its hashes that another chunk has too."""
    chunks = np.array(table.column("chunk").to_pylist(), np.int64)
    each = [unpack_keys(d) for d in table.column("data").to_pylist()]
    keys = np.concatenate(each)
    row = np.repeat(np.arange(len(each)), [len(e) for e in each])
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    same = sorted_keys[1:] == sorted_keys[:-1]
    hit = np.zeros(len(keys), bool)
    hit[1:] |= same
    hit[:-1] |= same
    mark = np.zeros(len(keys), bool)
    mark[order[hit]] = True
    out_c, out_d = [], []
    rows = row[mark]
    picked = keys[mark]
    cut = np.flatnonzero(np.diff(rows, prepend=-1))
    for r, p in zip(rows[cut].tolist(), np.split(picked, cut[1:]) if len(rows) else [], strict=True):
        out_c.append(int(chunks[r]))
        out_d.append(pack_keys(p))
    return pa.table({"chunk": pa.array(out_c, pa.int64()), "kind": pa.array([0] * len(out_c), pa.int32()),
                     "bucket": pa.array([0] * len(out_c), pa.int64()), "data": pa.array(out_d, pa.binary())})


# --- step 3: surroundings of repeating anchors -------------------------------------------

def chunk_suffixes(docs: pa.Table, replies: list[bytes], splitters: np.ndarray, window: int) -> dict:
    """Distinct surroundings (bytes that the windows of one anchor cover) of the chunk's
    repeating anchors, in order of bucket and leading bytes, and where they occur."""
    buf, starts, order, keys = read_chunk(docs)
    key, a, lo, hi, doc = anchors(buf, starts, window)
    key = short(key)
    known = np.unique(np.concatenate([unpack_keys(r) for r in replies])) if replies else np.zeros(0, np.uint64)
    # hashes that two documents of this chunk share
    by = np.lexsort((doc, key))
    same = (key[by][1:] == key[by][:-1]) & (doc[by][1:] != doc[by][:-1])
    own = np.unique(key[by][1:][same])
    take = np.isin(key, np.concatenate((known, own)))
    a, lo, hi, doc = a[take], lo[take], hi[take], doc[take]
    raw, seen = buf.tobytes(), {}
    entry = np.empty(len(a), np.int64)
    texts: list[bytes] = []
    offs: list[int] = []
    for i, (s, e, o) in enumerate(zip(lo.tolist(), (hi + window).tolist(), (a - lo).tolist(), strict=True)):
        t = (raw[s:e], o)
        n = seen.setdefault(t, len(texts))
        if n == len(texts):
            texts.append(t[0])
            offs.append(o)
        entry[i] = n
    least = np.full(len(texts), _LAST)
    np.minimum.at(least, entry, order[doc])
    most = np.full(len(texts), np.int64(-2**63))
    np.maximum.at(most, entry, order[doc])
    lead = np.array([t[o:o + 16] for t, o in zip(texts, offs, strict=True)], "S16")
    bucket = np.searchsorted(splitters, lead, side="right") if len(splitters) else np.zeros(len(texts), np.int64)
    rank = np.lexsort((np.arange(len(texts)), lead, bucket))
    place = np.empty(len(texts), np.int64)
    place[rank] = np.arange(len(texts))
    return {"buf": buf, "starts": starts, "order": order, "keys": keys, "lo": lo, "doc": doc, "entry": place[entry],
            "texts": [texts[i] for i in rank], "offs": np.array(offs, np.uint8)[rank],
            "least": least[rank], "multi": (most > least)[rank], "bucket": bucket[rank]}


def send_suffixes(splitters: np.ndarray, window: int):
    def run(key, docs: pa.Table, replies: pa.Table) -> pa.Table:
        import zstandard
        rows: list[tuple] = []
        if docs.num_rows:
            c = chunk_suffixes(docs, replies.column("data").to_pylist(), splitters, window)
            cut = np.flatnonzero(np.diff(c["bucket"], prepend=-1))[:len(c["bucket"])]
            for s, e in zip(cut.tolist(), np.append(cut, len(c["bucket"]))[1:].tolist(), strict=True):
                sizes = np.array([len(t) for t in c["texts"][s:e]], "<u4")
                rows.append((int(c["bucket"][s]), s, pack(sizes, c["offs"][s:e], c["least"][s:e], c["multi"][s:e].view(np.uint8)),
                             zstandard.ZstdCompressor(level=3).compress(b"".join(c["texts"][s:e]))))
        cols = list(zip(*rows, strict=True)) or [[], [], [], []]
        return pa.table({"bucket": pa.array(cols[0], pa.int64()), "chunk": pa.array([key[0].as_py()] * len(rows), pa.int64()),
                         "first": pa.array(cols[1], pa.int64()), "head": pa.array(cols[2], pa.binary()),
                         "data": pa.array(cols[3], pa.binary())})
    return run


def multikey_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by their words, first word first, and the number of the group of equal
    rows for each place of that order. Later words are looked at among ties only."""
    order = np.argsort(words[:, 0], kind="stable")
    new = np.concatenate(([True], words[order[1:], 0] != words[order[:-1], 0]))[:len(order)]
    for w in range(1, words.shape[1]):
        group = np.cumsum(new) - 1
        size = np.bincount(group, minlength=1)
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        rows = order[tied]
        sub = np.lexsort((words[rows, w], group[tied]))
        order[tied] = rows[sub]
        value, g = words[rows, w][sub], group[tied]
        split = np.concatenate(([True], (value[1:] != value[:-1]) | (g[1:] != g[:-1])))
        new[tied] |= split
    return order, np.cumsum(new) - 1


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of the ranges starts[i] .. starts[i] + sizes[i] - 1."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    return row, np.repeat(starts - first, sizes) + np.arange(int(sizes.sum()))


def equal_runs(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order in which rows equal in all parts stand together, and where each run of equal
    rows begins. Rows are sorted by a hash; if different rows meet by chance, by the parts."""
    n = len(parts[0])
    h = np.zeros(n, np.uint64)
    for i, x in enumerate(parts):
        h += x.astype(np.uint64)
        h *= _MIX[i % len(_MIX)]
        h ^= h >> np.uint64(31)
    order = np.argsort(h, kind="stable")
    equal = h[order][1:] == h[order][:-1]
    for x in parts:
        y = x[order]
        if not np.array_equal(y[1:][equal], y[:-1][equal]):
            order = np.lexsort(parts)
            equal = np.ones(max(n - 1, 0), bool)
            for z in parts:
                equal &= z[order][1:] == z[order][:-1]
            break
    return order, np.flatnonzero(np.concatenate((np.ones(min(n, 1), bool), ~equal)))


def least_documents(window: int):
    steps = [*range(0, window - 7, 8), window - 8]       # eight-byte loads that cover a window

    def run(table: pa.Table) -> pa.Table:
        """Of a bucket: for each suffix the runs of its windows that another suffix or another
        document has, with the least document."""
        import zstandard
        chunks = table.column("chunk").to_pylist()
        first = table.column("first").to_pylist()
        bucket = table.column("bucket")[0].as_py()
        heads = [unpack(d, "<u4", "u1", "<i8", "u1") for d in table.column("head").to_pylist()]
        buf = np.frombuffer(b"".join(zstandard.ZstdDecompressor().decompress(d) for d in table.column("data").to_pylist()), np.uint8)
        size, off, least, multi = (np.concatenate([h[i] for h in heads]) for i in range(4))
        size = size.astype(np.int64)
        source = np.repeat(np.arange(len(heads)), [len(h[0]) for h in heads])
        number = np.concatenate([np.arange(len(h[0])) + f for h, f in zip(heads, first, strict=True)])
        begin = np.cumsum(size) - size
        x = loads(buf)
        # whole surroundings that several chunks sent are one from here on (a surrounding is
        # shorter than two windows, so its first and last window cover it)
        order, start = equal_runs([size, off, *[x[begin + s] for s in steps], *[x[begin + size - window + s] for s in steps]])
        same = np.diff(np.append(start, len(order)))
        whole = np.empty(len(size), np.int64)             # entry -> distinct surrounding
        whole[order] = np.repeat(np.arange(len(start)), same)
        one = order[start]
        d_least = np.minimum.reduceat(least[order], start)
        d_begin, d_count = begin[one], size[one] - window + 1
        # suffixes from the anchor on, in order; those with the anchor in common are compared
        at = d_begin + off[one]
        rank, group = multikey_order(np.stack([x[at].byteswap(), x[at + 8].byteswap(), x[at + 16].byteswap()], axis=1))
        shared = np.zeros(len(one), bool)
        shared[rank] = np.bincount(group)[group] > 1
        keep = np.flatnonzero(shared)
        row, place = _ragged(d_begin[keep], d_count[keep])
        run_of, run_lo, run_hi, run_low = [np.flatnonzero(~shared)], [np.zeros((~shared).sum(), np.int64)], [d_count[~shared] - 1], [d_least[~shared]]
        if len(place):
            by, begins = equal_runs([x[place + s] for s in steps])
            low = np.empty(len(place), np.int64)
            low[by] = np.repeat(np.minimum.reduceat(d_least[keep][row][by], begins), np.diff(np.append(begins, len(by))))
            cut = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (low[1:] != low[:-1]))))
            last = np.append(cut[1:], len(place)) - 1
            of = keep[row[cut]]
            run_of.append(of)
            run_lo.append(place[cut] - d_begin[of])
            run_hi.append(place[last] - d_begin[of])
            run_low.append(low[cut])
        run_of, run_lo, run_hi, run_low = (np.concatenate(r) for r in (run_of, run_lo, run_hi, run_low))
        by = np.argsort(run_of, kind="stable")
        runs = np.bincount(run_of, minlength=len(one))
        head = np.cumsum(runs) - runs
        entry, i = _ragged(head[whole], runs[whole])
        i = by[i]
        # a chunk whose only document with this surrounding is the least one cuts nothing
        hit = (run_low[i] < least[entry]) | (multi[entry] > 0)
        entry, i = entry[hit], i[hit]
        src = source[entry]
        by = np.argsort(src, kind="stable")
        entry, i, src = entry[by], i[by], src[by]
        out_c, out_d = [], []
        for g in np.split(np.arange(len(src)), np.flatnonzero(np.diff(src)) + 1) if len(src) else []:
            out_c.append(chunks[int(src[g[0]])])
            out_d.append(pack(number[entry[g]].astype("<u4"), run_lo[i[g]].astype("<u2"), run_hi[i[g]].astype("<u2"),
                              run_low[i[g]].astype("<i8")))
        return pa.table({"chunk": pa.array(out_c, pa.int64()), "kind": pa.array([1] * len(out_c), pa.int32()),
                         "bucket": pa.array([bucket] * len(out_c), pa.int64()), "data": pa.array(out_d, pa.binary())})
    return run


# --- step 4: cutting ---------------------------------------------------------------------

def cut_chunk(splitters: np.ndarray, window: int, with_text: bool):
    def run(key, docs: pa.Table, replies: pa.Table) -> pa.Table:
        names = ["k", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept_text"] if with_text else [])]
        if not docs.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(
                names, [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()], strict=False)})
        kinds, data = replies.column("kind").to_pylist(), replies.column("data").to_pylist()
        c = chunk_suffixes(docs, [d for k, d in zip(kinds, data, strict=True) if k == 0], splitters, window)
        buf, starts = c["buf"], c["starts"]
        edge = np.zeros(len(buf) + 1, np.int32)
        found = [unpack(d, "<u4", "<u2", "<u2", "<i8") for k, d in zip(kinds, data, strict=True) if k == 1]
        if found:
            n, lo, hi, low = (np.concatenate([f[i] for f in found]).astype(np.int64) for i in range(4))
            by = np.argsort(c["entry"], kind="stable")
            e = c["entry"][by]
            first, last = np.searchsorted(e, n), np.searchsorted(e, n, side="right")
            row, at = _ragged(first, last - first)
            occ = by[at]
            later = low[row] < c["order"][c["doc"][occ]]
            row, occ = row[later], occ[later]
            np.add.at(edge, c["lo"][occ] + lo[row], 1)
            np.add.at(edge, c["lo"][occ] + hi[row] + window, -1)
        gone = np.cumsum(edge[:-1]) > 0
        rise = gone & ~np.concatenate(([False], gone[:-1]))
        begins = starts[:-1][np.diff(starts) > 0]
        rise[begins] = gone[begins]
        sums = np.concatenate(([0], np.cumsum(gone)))
        spans = np.concatenate(([0], np.cumsum(rise)))
        kept = buf[~gone].tobytes()
        left = starts - sums[starts]
        parts = [kept[s:e] for s, e in zip(left[:-1].tolist(), left[1:].tolist(), strict=True)]
        out = {"k": pa.array(c["keys"], pa.int64()), "n_bytes": pa.array(np.diff(starts)),
               "n_removed": pa.array(np.diff(sums[starts]).astype(np.int64)),
               "n_spans": pa.array(np.diff(spans[starts]).astype(np.int64)),
               "kept_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string())}
        if with_text:          # a cut may fall inside a character
            out["kept_text"] = pa.array([p.decode(errors="replace") for p in parts], pa.string())
        return pa.table(out)
    return run


def sampled_splitters(docs: DataFrame, buckets: int, window: int, sample_docs: int = 2000, per_doc: int = 64) -> np.ndarray:
    """Leading bytes that cut the suffixes at anchors into buckets of about equal size, from
    a bounded sample."""
    if buckets < 2:
        return np.zeros(0, "S16")

    def run(batches):
        for batch in batches:
            out = []
            for t in batch.column(0).to_pylist():
                buf = np.frombuffer(t, np.uint8)
                a = np.unique(anchors(buf, np.array([0, len(buf)]), window)[1])
                pick = a[::max(1, -(-len(a) // per_doc))]
                out += [t[i:i + 16] for i in pick.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["lead"])

    n = docs.count()
    some = docs.select("t").where(F.pmod(F.xxhash64(F.lit("split"), "k", "t"), F.lit(1 << 30))
                                  < F.lit(int((1 << 30) * min(1.0, sample_docs / max(n, 1)))))
    lead = np.sort(np.array([bytes(r[0]) for r in some.mapInArrow(run, "lead binary").collect()], "S16"))
    if not len(lead):
        return lead
    return np.unique(lead[(np.arange(1, buckets) * len(lead)) // buckets])


def removed(docs: DataFrame, *, window: int = 50, key: str = "doc_id", text: str = "text",
            chunk_bytes: int = 2_000_000, bucket_bytes: int = 12_000_000, with_text: bool = False) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256 (and kept_text) of every document."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    base = docs.select(F.col(key).cast("long").alias("k"), body.alias("t"))
    total = base.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    chunks, buckets = -(-total // chunk_bytes) or 1, -(-total // bucket_bytes) or 1
    splitters = sampled_splitters(base, buckets, window)
    chunked = base.withColumn("chunk", F.pmod(F.xxhash64("k", "t"), F.lit(chunks)))
    sent = chunked.groupBy("chunk").applyInArrow(chunk_keys(window, buckets), "bucket long, chunk long, data binary")
    reply = "chunk long, kind int, bucket long, data binary"
    back = sent.groupBy("bucket").applyInArrow(repeated_keys, reply)
    suffixes = chunked.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(
        send_suffixes(splitters, window), "bucket long, chunk long, first long, head binary, data binary")
    least = suffixes.groupBy("bucket").applyInArrow(least_documents(window), reply)
    schema = "k long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept_text string" if with_text else "")
    return (chunked.groupBy("chunk").cogroup(back.unionByName(least).groupBy("chunk"))
            .applyInArrow(cut_chunk(splitters, window, with_text), schema).withColumnRenamed("k", key))
