"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def substring_dedup(rows, n=20):
    """(id, text) rows in order of (id, hash of the text) -> (n_words, n_removed, kept text) of each."""
    seen, out = set(), []
    by_hash = lambda t: (xxhash.xxh64_intdigest(t or "", seed=42) + 2**63) % 2**64  # noqa: E731  as a signed number
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, by_hash(r[1]))):
        w = PLAIN.findall(t or "")
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in seen:
                gone[i : i + n] = [True] * n
            seen.add(tuple(w[i : i + n]))
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return Counter(out)


def contamination(rows, items, n=13):
    return Counter(contamination_list(rows, items, n))


def contamination_list(rows, items, n=13):
    windows = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(lower(t))
        m = min(n, len(w))
        for s in range(len(w) - m + 1 if w else 0):
            windows[tuple(w[s : s + m])].add("" if i is None else str(i))
    out = []
    for d, t in rows:
        w = ALNUM.findall(lower(t))
        hit, found = [False] * len(w), set()
        for m in {len(k) for k in windows}:
            for s in range(len(w) - m + 1):
                if (k := tuple(w[s : s + m])) in windows:
                    found |= windows[k]
                    hit[s : s + m] = [True] * m
        out.append((d, len(w), sum(hit), ",".join(sorted(found))))
    return out


def shingles(text, n=3):
    w = PLAIN.findall(lower(text))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def jaccard_components(rows, n=3, percent=90):
    """(id, text) rows with ids -> id: component, by comparing all pairs."""
    sets = [(d, shingles(t, n)) for d, t in rows]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                u, v = sorted((find(a), find(b)))
                parent[v] = u
    return {d: find(d) for d in parent}


def mix_targets(sizes, weights=(3, 1, 2)):
    """source: size -> source: target, by resharing the excess until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest, share = total - sum(2 * sizes[s] for s in full), sum(w[s] for s in names if s not in full)
        t = {s: 2 * sizes[s] if s in full else rest * w[s] / share for s in names}
        if not (more := {s for s in names if s not in full and t[s] > 2 * sizes[s]}):
            return t
        full |= more
