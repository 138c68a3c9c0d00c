"""License scan: winnowed fingerprints of templates, then banded alignment.

Runs of ``GRAM`` words are hashed and winnowed: of every ``WINDOW`` hashes in a row the
smallest is kept, so any shared passage of GRAM + WINDOW - 1 words shares a fingerprint.
An inverted index from fingerprint to (template, position) names candidates and diagonals for
every run of words in a text. Around each candidate the words of text and template are aligned by dynamic programming within a
band around the diagonal, which allows for inserted, missing and replaced words; the result
is the matched share of the template and the span in the text.

A license differs from its relatives by few words, so coverage alone decides nothing: the decisive
words in the matched span (names, "affero", "sharealike", version numbers and the like) must be exactly those of the
template, and a span that a negation leads up to is no notice. Of matches that overlap in a text, whatever
their templates, the one with most matched words is kept, then the best covered, then the first.

Templates are a parameter, a dictionary of name and wordings; their fingerprints have to fit
into ``MOST_FINGERPRINTS`` (checked) as every task holds them. A wording of fewer than ``GRAM`` words
is looked up as a whole. Texts are never shuffled.

Words are runs of ASCII letters, digits and characters beyond ASCII; letter case of A-Z is
ignored. Null and empty texts, and templates without words, match nothing. Rows without
doc_id are left out, repeated rows are reported alike, very long texts are scanned whole,
extra columns are ignored and an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.words import ALNUM, ngrams, word_groups

GRAM, WINDOW = 3, 2
BAND = 8
MIN_COVERAGE = 0.8
MOST_FINGERPRINTS = 1_000_000

# Notices in common use, as their publishers word them.
_GNU_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published "
    "by the Free Software Foundation, either version {version} of the License, or (at your option) any later version"
)
_GNU = {
    "GPL-2.0": ("General Public License", "2"),
    "GPL-3.0": ("General Public License", "3"),
    "LGPL-2.1": ("Lesser General Public License", "2.1"),
    "LGPL-3.0": ("Lesser General Public License", "3"),
    "AGPL-3.0": ("Affero General Public License", "3"),
}
_CREATIVE_COMMONS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_OTHERS = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License',
        "Apache License Version 2.0",
    ),
    "MIT": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Mozilla Public License Version 2.0",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain",),
}
_SPDX = ("Apache-2.0", "MIT", "MPL-2.0", "ISC", "Unlicense", "BSD-2-Clause", "BSD-3-Clause")
# Words that tell licenses apart.
DECISIVE = (
    "affero", "agpl", "apache", "attribution", "bsd", "by", "cc", "clause", "gpl", "isc", "lesser", "lgpl", "library", "mit",
    "mozilla", "mpl", "nc", "nd", "noderivatives", "noderivs", "noncommercial", "sa", "sharealike", "unlicense",
    *map(str, range(21)),
)
NEGATIONS = ("not", "never", "isn", "wasn", "aren", "weren", "neither", "nor")
LEADING = 5  # words before a span in which a negation counts


def _templates() -> dict[str, tuple[str, ...]]:
    made = {name: list(wordings) for name, wordings in _OTHERS.items()}
    for name, (title, version) in _GNU.items():
        made[name] = [
            _GNU_HEADER.format(name=title, version=version),
            f"This work is licensed under the GNU {title}, version {version}",
            f"GNU {title}, version {version}",
        ]
    for part, title in _CREATIVE_COMMONS.items():
        made[f"CC-{part}-4.0"] = [
            f"Licensed under CC {part} 4.0",
            f"This work is licensed under a Creative Commons {title} 4.0 International License",
        ]
    for name in (*_SPDX, *[f"{g}-{kind}" for g in _GNU for kind in ("only", "or-later")], *[f"CC-{p}-4.0" for p in _CREATIVE_COMMONS]):
        known = name.removesuffix("-only").removesuffix("-or-later")
        made.setdefault(known if known in made else name, []).append(f"SPDX-License-Identifier: {name}")
    return {name: tuple(wordings) for name, wordings in made.items()}


TEMPLATES = _templates()

SCHEMA = (
    "doc_id long, license string, matched_words long, template_words long, coverage double, "
    "start_byte long, end_byte long"
)


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the smallest hash (the last among equals) of every window."""
    if len(hashes) <= window:
        return np.array([len(hashes) - 1 - int(np.argmin(hashes[::-1]))]) if len(hashes) else np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)
    return np.unique(np.arange(len(views)) + window - 1 - np.argmin(views[:, ::-1], axis=1))


class Index:
    """Templates' words and the inverted index of their fingerprints."""

    def __init__(self, templates: dict[str, str | Sequence[str]]):
        wordings = [(n, w) for n, ws in templates.items() for w in ([ws] if isinstance(ws, str) else ws)]
        self.names, self.words = [name for name, _ in wordings], _hashed([text for _, text in wordings])
        self.decisive, self.negations = (set(np.concatenate(_hashed(w)).tolist()) for w in (DECISIVE, NEGATIONS))
        index = defaultdict(list)
        self.short: dict[int, dict[int, list[int]]] = {}
        for number, words in enumerate(self.words):
            grams = ngrams(words, GRAM)
            for place in winnow(grams).tolist():
                index[int(grams[place])].append((number, place))
            if 0 < len(words) < GRAM:
                whole = int(ngrams(words, len(words))[0])
                self.short.setdefault(len(words), {}).setdefault(whole, []).append(number)
        self.index = dict(index)
        self.hash = np.sort(np.array(list(index), np.uint64))
        if len(self.hash) > MOST_FINGERPRINTS:
            raise ValueError(f"{len(self.hash)} fingerprints; scan with templates in several groups")
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.hash >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of a text's fingerprints that a template has, with the hashes."""
        grams = ngrams(words, GRAM)
        at = np.flatnonzero(self.bits[(grams >> np.uint64(44)).astype(np.int64)])
        if len(at) and len(self.hash):
            slot = np.minimum(np.searchsorted(self.hash, grams[at]), len(self.hash) - 1)
            at = at[self.hash[slot] == grams[at]]
        return at, grams[at]


    def decided(self, words: np.ndarray, first: int, a: int, b: int, template: np.ndarray) -> bool:
        """Whether a span has the template's decisive words and nothing denies it."""
        if self.decisive.intersection(words[a:b].tolist()) != self.decisive.intersection(template.tolist()):
            return False
        return self.negations.isdisjoint(words[max(first, a - LEADING) : a].tolist())

    def whole_matches(self, words: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int]]:
        """Template and position of every wording that is shorter than a fingerprint."""
        for n, known in self.short.items():
            grams = ngrams(words, n)
            for at in np.flatnonzero(np.isin(grams, np.array(list(known), np.uint64))).tolist():
                if doc[at] == doc[at + n - 1]:
                    for template in known[int(grams[at])]:
                        yield template, at


def _hashed(texts: Sequence[str]) -> list[np.ndarray]:
    groups = word_groups(pa.array(list(texts), pa.string()), ALNUM)
    return [g.hash[a:b] for g in groups for a, b in zip(g.first[:-1], g.first[1:], strict=True)]


def align(text: np.ndarray, template: np.ndarray, shift: int, band: int = BAND) -> tuple[int, int, int]:
    """Equal words of the best alignment, and its first and last-plus-one word in the text.

    Row i aligns the first i template words with a stretch of the text that ends near word
    i + shift, at most ``band`` words off. An equal word scores 2; a replaced, missing or
    inserted one costs 1; the text before and after the stretch is free.
    """
    width, none = 2 * band + 1, (-(1 << 30), 0, 0)
    cells = [(0, shift + j - band, 0) if 0 <= shift + j - band <= len(text) else none for j in range(width)]
    best, span = (0, 0), (0, 0)
    for i, word in enumerate(template.tolist(), 1):
        fresh: list[tuple[int, int, int]] = []
        for j in range(width):
            t = shift + i + j - band
            cell = none
            if 0 <= t <= len(text):
                up = cells[j + 1] if j + 1 < width else none
                cell = max((0, t, 0), (up[0] - 1, up[1], up[2]))
                if t:
                    score, start, equal = cells[j]
                    same = int(text[t - 1]) == word
                    cell = max(cell, (score + (2 if same else -1), start, equal + same))
                    if j:
                        score, start, equal = fresh[j - 1]
                        cell = max(cell, (score - 1, start, equal))
            fresh.append(cell)
            if (cell[0], cell[2]) > best:
                best, span = (cell[0], cell[2]), (cell[1], t)
        cells = fresh
    return best[1], *span


def _best_of_each_place(matches: list[tuple]) -> list[tuple]:
    """Of matches (matched, coverage, start, end, template) that overlap the best, in the order of the text."""
    kept: list[tuple] = []
    for match in sorted(set(matches), key=lambda m: (-m[0], -m[1], m[2], m[3], m[4])):
        at = bisect_left(kept, match[2], key=lambda m: m[3])  # the first kept one that ends after this begins
        while at < len(kept) and kept[at][3] <= match[2]:
            at += 1
        if at == len(kept) or kept[at][2] >= match[3]:
            kept.insert(at, match)
    return kept


def _scan(index: Index, min_coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            ids = batch.column(0)
            for group in word_groups(batch.column(1), ALNUM):
                matches: dict[int, list[tuple]] = defaultdict(list)
                at, grams = index.hits(group.hash)
                tried: set[tuple[int, int]] = set()
                for position, gram in zip(at.tolist(), grams.tolist(), strict=True):
                    d = int(group.doc[position])
                    first, stop = int(group.first[d]), int(group.first[d + 1])
                    if position + GRAM > stop:
                        continue
                    for template, place in index.index[gram]:
                        if (template, position - place) in tried:
                            continue
                        tried.add((template, position - place))
                        words = index.words[template]
                        band = min(BAND, len(words) // 2)  # a repetition of a short notice is outside
                        origin = max(first, position - place - band)
                        text = group.hash[origin : min(stop, position - place + len(words) + band)]
                        matched, a, b = align(text, words, position - place - origin, band)
                        coverage, a, b = matched / len(words), origin + a, origin + b
                        if coverage >= min_coverage and index.decided(group.hash, first, a, b, words):
                            matches[d].append((matched, round(coverage, 6), a, b, template))
                for template, a in index.whole_matches(group.hash, group.doc):
                    d, n = int(group.doc[a]), len(index.words[template])
                    if index.decided(group.hash, int(group.first[d]), a, a + n, index.words[template]):
                        matches[d].append((n, 1.0, a, a + n, template))
                for d in sorted(matches):
                    for matched, coverage, a, b, template in _best_of_each_place(matches[d]):
                        found.append(
                            (ids[group.lo + d].as_py(), index.names[template], matched, len(index.words[template]), coverage,
                             int(group.start[a]), int(group.end[b - 1]))
                        )
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            columns = list(zip(*found, strict=True)) if found else [[]] * len(kinds)
            names = [field.split()[0] for field in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def scan(
    docs: DataFrame, templates: dict[str, str | Sequence[str]] | None = None, min_coverage: float = MIN_COVERAGE
) -> DataFrame:
    """One row for each place where a document holds a license notice."""
    slim = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return slim.mapInArrow(_scan(Index(TEMPLATES if templates is None else templates), min_coverage), SCHEMA)
