"""Plain versions of the contracts, for small tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def words(text):
    return WORD.findall(text or "")


def az(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def pii(text):
    out = []
    for no, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), no, m.end(), kind))
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(out)]


def quality(text):
    text = text or ""
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {i + j for i in range(len(w) - 2) if windows[tuple(w[i: i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for x in w for c in x), dup, len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def licences(text):
    w, hits = TOKEN.findall(az(text)), []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        hits += [(i, label) for i in range(len(w)) if w[i: i + len(p)] == p]
    at = [i for i, _ in hits]
    return (len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits})))


class Sets:
    """Union-find whose roots are the smallest members."""

    def __init__(self, items):
        self.up = {i: i for i in items}

    def root(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, i, j):
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)


def shingle_set(text, k=5):
    w = words(az(text))
    return frozenset(tuple(w[i: i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def jaccard(docs):
    """{id: (size, component)} of (id, text) rows."""
    sets = {i: shingle_set(t) for i, t in docs}
    groups, items = Sets(sets), sorted(sets.items())
    for n, (i, a) in enumerate(items):
        for j, b in items[:n]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                groups.join(i, j)
    return {i: (len(s), groups.root(i)) for i, s in sets.items()}


def substring(docs, span=20):
    """{id: (words, removed, kept text)} of (id, text) rows."""
    seen, out = set(), {}
    for i, t in sorted(dict(docs).items()):
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - span + 1):
            key = tuple(w[s: s + span])
            if key in seen:
                gone[s: s + span] = [True] * span
            seen.add(key)
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def neardup(rows, cosine=0.98):
    """{id: (links, component, kept)} of (id, vector, label) rows."""
    def unit(v):
        if v is None or not len(v) or any(x is None for x in v):
            return None
        x = np.asarray(v, float)
        return x / np.linalg.norm(x) if np.isfinite(x).all() and np.abs(x).max() > 0 else None
    units, groups, links = {i: unit(v) for i, v, _ in rows}, Sets([i for i, _, _ in rows]), Counter()
    label = {i: x for i, _, x in rows}
    ids = sorted(units)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = units[i], units[j]
            if a is not None and b is not None and len(a) == len(b) and label[i] is not None and label[i] == label[j] and a @ b >= cosine:
                links.update((i, j))
                groups.join(i, j)
    return {i: (links[i], groups.root(i), groups.root(i) == i) for i in ids}


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2
