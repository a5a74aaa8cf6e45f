"""Plain single-machine versions of the operators, for comparison."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

W = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return W.findall(text or "")


def op6(rows):
    out = {}
    for d, t in rows:
        t = t or ""
        w = words(t)
        c = Counter(zip(w, w[1:], w[2:]))
        cover = set()
        for i in range(len(w) - 2):
            if c[(w[i], w[i + 1], w[i + 2])] > 1:
                cover |= {i, i + 1, i + 2}
        lines = [x for x in t.split("\n") if W.search(x)]
        out[d] = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover),
                  len(w) < 50 or 100 * len(cover) > 50 * len(w))
    return out


def op3(rows):
    """rows in order of id: (n_chars, edited text)."""
    rows = [(d, t or "") for d, t in rows]
    out = {}
    for i, (d, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        out[d] = (len(t), t[:len(t) - half] + nxt[:half], nxt)
    return out


def merkle_leaves(text, longest=120):
    out = set()
    for p in text.split("\n"):
        for s in re.split("(?<=[.!?,;:|] )|(?<=[。．！？，、；：…؟،؛।॥။።])", p):
            first = s[:longest]
            rest = s[longest:]
            parts = [first] + [rest[i:i + longest + 1] for i in range(0, len(rest), longest + 1)]
            out |= {hashlib.md5(x.encode()).hexdigest()[:12] for x in parts}
    return out


def likeness(a, b):
    x, y = merkle_leaves(a), merkle_leaves(b)
    return 2 * len(x & y) / (len(x) + len(y))


def op4_base(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    names = ["assign", "access", "hex"]
    return sorted(found), ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(found))


def op4_novel(text, compressor_for, reach=80):
    """Strings judged novel: every candidate against every sensitive word and base span."""
    import math
    import random
    import zlib

    from evtlens.llm import secret_scan as ss
    size = lambda x: len(compressor_for().compress(x))                     # noqa: E731
    base = op4_base(text)[0]
    free = [m for m in ss.CANDIDATE.finditer(text) if not any(a < m.end() and m.start() < b for a, _, b in base)]
    found = set()
    for m in free:
        if not any(w.end() + reach > m.start() and w.start() - reach < m.end() for w in ss.SENSITIVE.finditer(text)):
            continue
        around = ss.surroundings(text, m.start(), m.end(), reach)
        cost = lambda x: size(around + x.encode()) - size(around)          # noqa: E731
        for c in [m.group(), *[p for p in re.split("[/+_=.-]", m.group()) if len(p) >= 16]]:
            freq = [c.count(x) / len(c) for x in set(c)]
            rng, letters, total = random.Random(zlib.crc32(c.encode())), list(c), 0
            for _ in range(6):
                rng.shuffle(letters)
                total += cost("".join(letters))
            if -sum(p * math.log2(p) for p in freq) >= 2.5 and (
                    6 * cost(c) >= 0.9 * total or len(c) >= 64 and cost(c) >= ss.bound(c)):
                found.add(m.group())
    return [m.group() for m in free if m.group() in found]


def op8(rows, n=50):
    """rows (key, bytes): {row number: (n_bytes, n_removed, n_spans, sha256)}."""
    first = {}
    inf = float("inf")
    for d, t in rows:
        k = inf if d is None else d
        for i in range(len(t) - n + 1):
            g = t[i:i + n]
            if k < first.get(g, (inf, 0))[0] or g not in first:
                first[g] = (k, 0)
    out = []
    for d, t in rows:
        k = inf if d is None else d
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if first[t[i:i + n]][0] < k:
                gone[i:i + n] = b"\x01" * n
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def simhash(text, size=3, seed=42):
    import xxhash
    t = (text or "").encode().lower().split()
    if not t:
        return 0
    sh = [b" ".join(t)] if len(t) < size else [b" ".join(t[i:i + size]) for i in range(len(t) - size + 1)]
    hs = [xxhash.xxh64_intdigest(s, seed) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def op9(rows, distance=3):
    fps = [simhash(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                parent[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None and (least[r] is None or d < least[r]):
            least[r] = d
    return [(d, f"{fps[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(rows)]


def op10(rows, min_words=12):
    """rows (id, text) with distinct ids, in order of id: {id: (lines, removed, runs, kept text)}. For each line
    the longest run from it that also starts at an earlier place; those with enough words go."""
    docs = []
    for d, t in rows:
        parts = []                                            # lines with words, with the wordless ones behind them
        for line in (t or "").split("\n"):
            if words(line) or not parts:
                parts.append([line])
            else:
                parts[-1].append(line)
        docs.append((d, t, parts, bool(parts) and not words(parts[0][0])))
    name = {(i, p): (x[0],) for i, (_, t, parts, blank) in enumerate(docs) if t is not None
            for p, x in enumerate(parts) if not (blank and p == 0)}
    longest, k = {}, 1
    while name:
        first, often = {}, Counter(name.values())
        for at in sorted(name):
            first.setdefault(name[at], at)
        longest.update({at: k for at, n in name.items() if first[n] < at})
        number = {n: j for j, n in enumerate(first)}
        name = {(i, p): (number[n], docs[i][2][p + k][0]) for (i, p), n in name.items()
                if often[n] > 1 and p + k < len(docs[i][2])}
        k += 1
    out = {}
    for i, (d, t, parts, _) in enumerate(docs):
        gone = set()
        for (j, p), n in longest.items():
            if j == i and sum(len(words(x[0])) for x in parts[p:p + n]) >= min_words:
                gone |= set(range(p, p + n))
        out[d] = ((0, 0, 0, None) if t is None else
                  (t.count("\n") + 1, sum(len(parts[p]) for p in gone), sum(p - 1 not in gone for p in gone),
                   "\n".join("\n".join(x) for p, x in enumerate(parts) if p not in gone)))
    return out


def water_fill(sizes, weights, ratio=1.5, epochs=2):
    """sizes, weights: {source: value}."""
    budget, held = ratio * sum(sizes.values()), {}
    live = {s for s in sizes if sizes[s]}
    while True:
        rest = budget - sum(held.values())
        w = sum(weights[s] for s in live - held.keys())
        over = {s for s in live - held.keys() if rest * weights[s] / w > epochs * sizes[s]}
        if not over:
            out = {s: 0.0 for s in sizes}
            out.update(held)
            out.update({s: rest * weights[s] / w for s in live - held.keys()})
            return out
        held.update({s: float(epochs * sizes[s]) for s in over})


def periodic_runs(w, min_length=6, min_periods=4):
    """Every diagonal in full; a stretch counts if no shorter period fits it."""
    out = set()
    for q in range(1, len(w) // min_periods + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            s, n = i - q, j - (i - q)
            if n >= max(min_length, min_periods * q) and not any(
                    all(w[s + x] == w[s + x - d] for x in range(d, n)) for d in range(1, q)):
                out.add((s, n, q))
            i = max(j, i + 1)
    return sorted(out)


def looped(doc_id, w):
    import zlib
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(w), h // 10
    if doc_id is None or h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def op11(doc_id, text):
    w = looped(doc_id, words(text))
    runs = periodic_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(((-n, s, q) for s, n, q in runs), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    top = (None,) * 4 if best is None else (best[1], -best[0], best[2], -1000 * best[0] // best[2])
    return (doc_id, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def hard_negatives(rows, every=100, few=5, low=80, high=100, scale=256):
    """rows (id, vector, label)."""
    import math
    usable = [(i, [math.floor(x * scale) for x in v], y) for i, v, y in rows if i is not None and y is not None
              and v is not None and all(x is not None and abs(x) < 65536 for x in v)]
    out = []
    for i, v, y in usable:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, w, z in usable)
        for p, j, _ in [s for s in scored if s[2] == y and s[1] != i][:few]:
            fits = [(n, k) for n, k, z in scored if z != y and -low * p <= -100 * n <= -high * p]
            out += [(i, j, r + 1, k, -p, -n) for r, (n, k) in enumerate(fits[:few])]
    return sorted(out)


def op5(text, dictionaries, block=4096, least=0.01):
    """(language, rejected) by compressing every block with every dictionary."""
    import zstandard
    letters = re.sub(r"[\W\d_]+", " ", (text or "").lower()).encode()
    if not dictionaries or not re.search(r"[^\W\d_]", text or ""):
        return "und", True
    total = []
    for k, content in dictionaries.items():
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=6)
        c = zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
        total.append((sum(len(c.compress(letters[i:i + block])) for i in range(0, len(letters), block)), len(total), k))
    total.sort()
    second = total[1][0] if len(total) > 1 else 2 * total[0][0]
    return total[0][2], (second - total[0][0]) / max(second, 1) < least
