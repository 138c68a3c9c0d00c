"""Words of many texts at once, as 64-bit hashes in numpy arrays.

Every operator that hashes words goes through `word_groups`: texts are taken in
groups of about a megabyte, so the working arrays stay small however large a batch
is; one longer text makes a group of its own and is cut between words while hashing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 20

_rng = np.random.default_rng(20240229)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Alphabet:
    """Which bytes part words, and the hash value of every other byte."""

    parts: np.ndarray
    value: np.ndarray


def _alphabet(separators: list[int]) -> Alphabet:
    parts = np.zeros(256, bool)
    parts[separators] = True
    folded = np.arange(256)
    folded[65:91] += 32
    return Alphabet(parts, _BYTE[folded])


# Words between blanks: everything but space, tab, newlines and feeds.
BLANKS = _alphabet([0x20, *range(0x09, 0x0E)])
# Words of ASCII letters and digits and of any character beyond ASCII.
ALNUM = _alphabet([b for b in range(128) if not chr(b).isalnum()])

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
            ramp = np.full(n, base, np.uint64)
            ramp[0] = 1
            globals()[name] = np.multiply.accumulate(ramp)


def _hash(data: np.ndarray, bounds: np.ndarray, letters: Alphabet):
    """Hash, start and end of every word in a piece; `bounds` are the text starts in it."""
    n = len(data)
    _grow(n + 1)
    word = ~letters.parts[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = bounds[(bounds > 0) & (bounds < n)]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(letters.value[data] * _powers[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _inverses[starts]), starts, ends


@dataclass(frozen=True)
class Words:
    """Words of the texts ``lo`` to ``hi - 1`` of a batch.

    ``doc`` counts from 0 within the group; ``start`` and ``end`` are byte offsets in
    the word's own text; ``first[i]`` is the index of text i's first word.
    """

    lo: int
    hi: int
    hash: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data, offsets


def word_groups(texts: pa.Array, letters: Alphabet) -> Iterator[Words]:
    """The words of every text, group by group; a null text counts as empty."""
    if not len(texts):
        return
    data, offsets = _bytes(texts)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + GROUP_BYTES, side="right")) - 1)
        hi = min(hi, len(texts))
        base, stop = int(offsets[lo]), int(offsets[hi])
        hashes, starts, ends = [], [], []
        at = base
        while at < stop:
            cut = stop
            if stop - at > 2 * GROUP_BYTES:  # one long text: cut it at a separator
                window, size = None, GROUP_BYTES
                while window is None and at + size < stop:
                    found = np.flatnonzero(letters.parts[data[at : at + size]])
                    window, size = (int(found[-1]) + 1, size) if len(found) else (None, size * 2)
                cut = at + window if window else stop
            h, s, e = _hash(data[at:cut], offsets[lo : hi + 1] - at, letters)
            hashes.append(h)
            starts.append(s + at)
            ends.append(e + at)
            at = cut
        if hashes:
            h, s, e = np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends)
        else:
            h, s, e = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        doc = np.searchsorted(offsets[lo + 1 : hi + 1], s, side="right")
        first = np.searchsorted(doc, np.arange(hi - lo + 1))
        begin = offsets[lo:hi][doc] if len(doc) else s
        yield Words(lo, hi, h, doc, s - begin, e - begin, first)
        lo = hi
    pa.default_memory_pool().release_unused()  # workers live on: give back what the batch took


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words, text borders ignored."""
    count = max(0, len(hashes) - n + 1)
    out = np.full(count, np.uint64(n), np.uint64)
    for i in range(n):
        out = out * _BASE + hashes[i : i + count]
    return mix(out)
