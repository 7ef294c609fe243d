"""Plain versions of the operators, for comparison on small tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_ASCII = {c: c + 32 for c in range(65, 91)}


def shingle_set(text: str | None, k: int) -> frozenset:
    w = WORD.findall((text or "").translate(_ASCII))
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def near_duplicates(rows: list[tuple], k: int, percent: int) -> dict[int, tuple]:
    """doc_id -> (n_shingles, component_id, kept); ids must be distinct."""
    sets = {d: shingle_set(t, k) for d, t in rows}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    common = Counter()
    for who in holders.values():
        for i, a in enumerate(who):
            for b in who[:i]:
                common[a, b] += 1
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}


def repeated_words(rows: list[tuple], size: int) -> dict[int, tuple]:
    """doc_id -> (n_words, n_removed, kept words joined)."""
    docs = {d: WORD.findall(t or "") for d, t in rows}
    seen = Counter(tuple(w[i : i + size]) for w in docs.values() for i in range(len(w) - size + 1))
    out = {}
    for d, w in docs.items():
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out
