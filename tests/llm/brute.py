"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import defaultdict


def shingle_set(text: str | None, n: int = 5) -> frozenset:
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def jaccard_components(rows) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows, by comparing all that share a shingle."""
    sets = [shingle_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_shingle, done = defaultdict(list), set()
    for i, s in enumerate(sets):
        if rows[i][0] is None:
            continue
        for shingle in s:
            for j in by_shingle[shingle]:
                if (i, j) not in done:
                    done.add((i, j))
                    both = len(s & sets[j])
                    if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                        parent[root(i)] = root(j)
            by_shingle[shingle].append(i)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[root(i)] = min(doc, low.get(root(i), doc))
    return [(doc, len(sets[i]), None if doc is None else low[root(i)]) for i, (doc, _) in enumerate(rows)]


def leaks(changed, min_words: int = 13) -> bool:
    """Whether a stretch of min_words words (or the whole item) has four fifths unchanged."""
    n = len(changed)
    need = min(min_words, n)
    return any(
        5 * sum(not c for c in changed[a:b]) >= 4 * (b - a) for a in range(n) for b in range(a + need, n + 1)
    )
