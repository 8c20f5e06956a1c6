"""Plain single-process versions of the operators, for comparison on small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def components(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in links:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def op1(docs):
    prints = [simhash(t) for _, t in docs]
    ordered = sorted(range(len(docs)), key=lambda i: docs[i][0])
    links = []
    codes = np.array(prints, np.uint64)
    for x, i in enumerate(ordered):
        rest = ordered[x + 1 :]
        near = np.bitwise_count(codes[rest] ^ codes[i]) <= 4
        links += [(x, x + 1 + int(k)) for k in np.flatnonzero(near)]
    roots = components(len(docs), links)
    component = {ordered[x]: docs[ordered[r]][0] for x, r in enumerate(roots)}
    return sorted((docs[i][0], f"{prints[i]:016x}", component[i]) for i in range(len(docs)))


def op4(docs, window=35):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    starts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), sha(kept)))
    return sorted(out)


def op5(rows, threshold=0.93):
    n = len(rows)
    good = [
        r[2] is not None and r[1] is not None and len(r[1]) and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])
        for r in rows
    ]
    order = sorted(range(n), key=lambda i: rows[i][0])
    links, counts = [], Counter()
    for x, i in enumerate(order):
        for y in range(x + 1, n):
            j = order[y]
            if good[i] and good[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                u, v = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if u @ v / np.sqrt(u @ u) / np.sqrt(v @ v) >= threshold:
                    links.append((x, y))
                    counts[i] += 1
                    counts[j] += 1
    roots = components(n, links)
    return sorted((rows[i][0], counts[i], rows[order[roots[x]]][0]) for x, i in enumerate(order))


def op7(docs, items, n=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in items:
        w = word.findall(lower(text))
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[i : i + size])].add(str(item))
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w = word.findall(lower(text))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (key := tuple(w[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[key]
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return sorted(out)


def crc(key):
    return zlib.crc32(str(key).encode())


def op12(rows, min_count=10, limit=2000, covered=50):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found, most = defaultdict(list), Counter()
    for (lang, p), a in counts.items():
        if len(p) > 1 and a >= min_count:
            cuts = [(1_000_000 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found[lang].append((-score, -a, " ".join(p).encode(), p, counts[lang, p[:k]], counts[lang, p[k:]]))
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    most[lang, part] = max(most[lang, part], a)
    out = []
    for lang, rows in found.items():
        kept = [r for r in rows if len(r[3]) == 3 or 100 * most[lang, r[3]] < covered * -r[1] or not most[lang, r[3]]]
        for rank, (score, a, _, p, left, right) in enumerate(sorted(kept)[:limit], 1):
            out.append((lang, rank, " ".join(p), -a, left, right, totals[lang], -score))
    return sorted(out)


def op13(rows, clusters=8, rounds=10, seed=3, dim=64):
    """(vec_id, cluster, distance, cluster inertia, inertia, centroid hash), in Python integers."""
    good = [(i, v) for i, v in rows if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    vectors = [[int(np.floor(1024 * float(x))) for x in v] for _, v in good]
    order = sorted(range(len(good)), key=lambda r: (good[r][0] is None, sha(f"{seed}:{good[r][0]}"), vectors[r]))
    centroids = [vectors[r] for r in order[:clusters]]

    def assign():
        out = []
        for v in vectors:
            out.append(min((sum((x - y) ** 2 for x, y in zip(v, c)), i) for i, c in enumerate(centroids)))
        return out

    for _ in range(rounds):
        members = defaultdict(list)
        for v, (_, c) in zip(vectors, assign()):
            members[c].append(v)
        for c, own in members.items():
            centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    last = assign()
    sums = Counter()
    for d, c in last:
        sums[c] += d
    return [(i, c, d, sums[c], sum(sums.values()), sha(",".join(map(str, centroids[c])))) for (i, _), (d, c) in zip(good, last)]
