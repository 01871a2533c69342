"""Plain Python answers to compare with; small inputs only."""

from __future__ import annotations

import hashlib
import re
import zlib

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def grams(text, size):
    w = SPACED.findall(lower(text))
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}


def near_duplicates(rows, size=4, percent=85):
    sets = [grams(t, size) for _, t in rows]
    where = {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        common = {}
        for g in s:
            for j in where[g]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        least[r] = min(least.get(r, d), d)
    return sorted((d, len(sets[i]), least[root(i)] if sets[i] else d) for i, (d, _) in enumerate(rows))


def decontaminate(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = ALNUM.findall(lower(text))
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add("" if item is None else str(item))
    lengths = sorted({len(k) for k in windows})
    out = []
    for d, text in docs:
        w = ALNUM.findall(lower(text))
        hit, names = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i : i + n]))
                if found:
                    names |= found
                    hit.update(range(i, i + n))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out)


def repeated_words(docs, size=50):
    first = {}
    words = [(d, SPACED.findall(t or "")) for d, t in docs]
    for d, w in words:
        for i in range(len(w) - size + 1):
            k = tuple(w[i : i + size])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < d:
                gone.update(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def repeated_bytes(docs, size=50):
    first = {}
    raw = [(d, (t or "").encode()) for d, t in docs]
    for d, b in raw:
        for i in range(len(b) - size + 1):
            k = b[i : i + size]
            first[k] = min(first.get(k, d), d)
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if first[b[i : i + size]] < d:
                gone[i : i + size] = b"\1" * size
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(c for i, c in enumerate(b) if not gone[i])
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def features(text):
    w = ALNUM.findall(lower(text))
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def resampled(docs, target, buckets=10000, percent=25, least_words=20, seed=7):
    """Rows of (doc_id, n_features, weight, score, rank), sorted; None doc_ids last."""
    import math

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for text in (x for _, x in docs):
        for f in features(text):
            s[bucket(f)] += 1
    for text in target:
        for f in features(text):
            t[bucket(f)] += 1
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    gain = [math.floor(1000 * math.log((b + 1.0) * all_s / ((a + 1.0) * all_t))) for a, b in zip(s, t)]
    rows = []
    for d, text in docs:
        f = features(text)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= 2 * least_words - 1), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for i, r in enumerate(able[: len(able) * percent // 100]):
        r[4] = i + 1
    return sorted(map(tuple, rows), key=str)


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def valued(*values):
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def merkle_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(last[i : i + 8]) for i in range(0, len(last), 8)])
    return levels


def siblings(levels, i):
    path = []
    for level in levels[:-1]:
        first = i - i % 8
        path.append((level[first:i], level[i + 1 : first + 8]))
        i //= 8
    return path


def manifest(rows):
    """``rows`` of (group, doc_id, leaf, claimed leaf): what a proof of each gives, sorted."""
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        trees[g] = merkle_levels([r[2] for r in groups[g]])
    top = merkle_levels([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, (_, doc_id, leaf, claimed) in enumerate(groups[g]):
            path = siblings(trees[g], i) + siblings(top, k)
            folded = claimed
            for left, right in path:
                folded = digest([*left, folded, *right])
            proof = digest(x for left, right in path for x in left + right)
            out.append((doc_id, leaf, trees[g][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=str)
