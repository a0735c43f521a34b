"""Plain Python versions of the operators, written from the contracts."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import regex


def words(text, low=False):
    raw = (text or "").encode()
    return [w.decode() for w in (raw.lower() if low else raw).split()]


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
    often = Counter(windows)
    covered = {k + j for k, x in enumerate(windows) if often[x] > 1 for j in range(8)}
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))


def shingle_set(text, size):
    w = words(text, low=True)
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def components(rows, size, percent):
    """id -> (set size, smallest linked id)."""
    sets = {i: shingle_set(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i in sorted(sets):
        shared = Counter(j for g in sets[i] for j in holders.get(g, ()))
        for j, k in shared.items():
            if 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for g in sets[i]:
            holders.setdefault(g, []).append(i)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def benchmark_shingles(text):
    w = regex.sub(r"[^\p{L}\p{N}\x20\x09-\x0D]+", "", (text or "").lower()).encode().split()
    return [tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))] if w else []


def leaks(docs, items):
    """(doc, item) -> best weighted Jaccard of any window of the item's length, if 0.8 or more."""
    held = {i: benchmark_shingles(t) for i, t in items}
    found = {}
    for d, t in docs:
        s = benchmark_shingles(t)
        for i, own in held.items():
            if not own or not set(own) & set(s):
                continue
            bag = Counter(own)
            best = 0
            for k in range(len(s)):
                window = Counter(s[k : k + len(own)])
                common = sum((window & bag).values())
                best = max(best, common / (sum(window.values()) + len(own) - common))
            if best >= 0.8:
                found[d, i] = round(best, 6)
    return found


def without_repeats(rows, length=100):
    """id -> (bytes, removed, spans, digest of the rest)."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i] = (len(b), len(b) - len(kept), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def without_repeated_words(texts, length=35):
    """For each text (words, removed, digest of the rest)."""
    lists = [words(t) for t in texts]
    often = Counter(tuple(w[k : k + length]) for w in lists for k in range(len(w) - length + 1))
    out = []
    for w in lists:
        gone = {k + j for k in range(len(w) - length + 1) if often[tuple(w[k : k + length])] > 1 for j in range(length)}
        out.append((len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
