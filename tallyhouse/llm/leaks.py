"""Benchmark decontamination by spaced-seed hashing.

A mask is a fixed pattern of token positions, some of them ignored. Every position of a
benchmark text and of a document is hashed under each mask; equal hashes put the two texts
on one diagonal (document position less benchmark position). On every diagonal with a hit
the words are compared one by one. An overlap is the longest stretch of at least ``min_words``
words (or the whole item, if it is shorter) of which ``min_match`` are equal, then the longest in
what is left beside it, and so on; unequal words at its ends are left out as far as it stays long
enough. A document with an overlap is a leak of the item.

The masks meet every such stretch for a ``min_match`` of 0.8 or more: one of 26 words or more holds
a shorter one of at least 13, and every placing of the substitutions in 13 to 25 words, or in a whole
item of 6 to 12, leaves a window of some mask untouched (tested by going through all of them).

The benchmark is read in blocks of at most ``BLOCK_HASHES`` hashes (16 bytes each), so what
a task holds has a fixed bound; a larger benchmark takes more passes over the documents, none
of which shuffles a text. Matching a window costs one look into a bit table, so frequent
windows cost what others do, and a task reports one row for each document and item.

Words are runs of ASCII letters, digits and characters beyond ASCII; letter case of A-Z is
ignored. Null and empty texts, on either side, leak nothing, and items shorter than
``LEAST_ITEM`` words match nothing. Documents and items without an id are left out. Repeated
documents are reported alike, repeated items (same id and text) once. Very long documents
are read whole. Extra columns are ignored; an empty table on either side gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.words import ALNUM, mix, word_groups

# Which positions of a window count; each mask tolerates substitutions in other places.
MASKS = ("1101111", "1100010111", "11011000011", "1110111")
SHORT_MASKS = ("10111", "111001")  # where fewer than SHORT words are enough
SHORT, LEAST_ITEM = 13, 6
MIN_WORDS, MIN_MATCH = 13, 0.8
BLOCK_HASHES = 1 << 20
BITS = 22
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mask_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the counting words of each window of a mask."""
    count = max(0, len(words) - len(mask) + 1)
    out = np.full(count, np.uint64(int(mask, 2)), np.uint64)
    for i, use in enumerate(mask):
        if use == "1":
            out = out * _ODD + words[i : i + count]
    return mix(out)


def stretches(equal: np.ndarray, need: int, min_match: float) -> list[tuple[int, int]]:
    """Separate stretches of at least ``need`` words that hold the wanted share, longest first on each part."""
    found, parts = [], [(0, len(equal))]
    while parts:
        begin, end = parts.pop()
        if end - begin < need or need < 1:
            continue
        same = equal[begin:end]
        # a stretch holds the share if the surplus of equal words does not fall along it
        surplus = np.concatenate([[0.0], np.cumsum(same - min_match)])
        low = np.minimum.accumulate(surplus)
        start = np.searchsorted(-low, -surplus - 1e-9)
        stop = int(np.argmax(np.arange(len(surplus)) - start))
        start = int(start[stop])
        if stop - start < need:
            continue
        while stop - start > need and not same[stop - 1]:
            stop -= 1
        while stop - start > need and not same[start]:
            start += 1
        found.append((begin + start, begin + stop))
        parts += [(begin, begin + start), (begin + stop, end)]
    return sorted(found)


class Index:
    """Hashes of a block of benchmark texts, sorted, with a bit table in front."""

    def __init__(self, items: list[tuple[int, np.ndarray]], min_words: int = MIN_WORDS):
        self.items = items
        self.masks: set[str] = set()
        hashes, owners, places = [], [], []
        for number, (_, words) in enumerate(items):
            masks = MASKS if min(min_words, len(words)) >= SHORT else SHORT_MASKS
            self.masks.update(masks)
            for mask in masks:
                made = mask_hashes(words, mask)
                hashes.append(made)
                owners.append(np.full(len(made), number, np.int32))
                places.append(np.arange(len(made), dtype=np.int32))
        joined = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(joined, kind="stable")
        self.hash = joined[order]
        self.owner = np.concatenate(owners)[order] if owners else np.zeros(0, np.int32)
        self.place = np.concatenate(places)[order] if places else np.zeros(0, np.int32)
        self.bits = np.zeros(1 << BITS, bool)
        self.bits[(self.hash >> np.uint64(64 - BITS)).astype(np.int64)] = True

    def hits(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Window position, owner and owner's position of every hit."""
        for mask in sorted(self.masks):
            made = mask_hashes(words, mask)
            maybe = np.flatnonzero(self.bits[(made >> np.uint64(64 - BITS)).astype(np.int64)])
            low = np.searchsorted(self.hash, made[maybe], side="left")
            high = np.searchsorted(self.hash, made[maybe], side="right")
            many = high - low
            at = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]).astype(np.int64), many)
            entry = at + np.arange(int(many.sum()))
            yield np.repeat(maybe, many), self.owner[entry], self.place[entry]


def item_words(items: DataFrame, item: str = "item_id") -> DataFrame:
    """``item_id, words``: distinct benchmark texts as 64-bit word hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in word_groups(batch.column(1), ALNUM):
                words = [group.hash[a:b].tobytes() for a, b in zip(group.first[:-1], group.first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(group.lo, group.hi - group.lo), pa.array(words, pa.binary())],
                    names=["item_id", "words"],
                )

    named = items.select(F.col(item).cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return named.where("item_id is not null and text is not null").distinct().mapInArrow(run, "item_id long, words binary")


def blocks(words: DataFrame) -> Iterator[list[tuple[int, np.ndarray]]]:
    """The benchmark in blocks of bounded size; a longer text makes a block of its own."""
    block, held = [], 0
    for row in words.toLocalIterator():
        hashes = np.frombuffer(row["words"], np.uint64)
        if len(hashes) < LEAST_ITEM:
            continue
        if block and held + len(hashes) * len(MASKS) > BLOCK_HASHES:
            yield block
            block, held = [], 0
        block.append((row["item_id"], hashes))
        held += len(hashes) * len(MASKS)
    if block:
        yield block


def _scan(index: Index, min_words: int, min_match: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            ids = batch.column(0)
            for group in word_groups(batch.column(1), ALNUM):
                tried: set[tuple[int, int, int]] = set()
                for position, owner, place in index.hits(group.hash):
                    doc = group.doc[position]
                    keys = np.unique(np.stack([doc, owner, position - place]), axis=1) if len(doc) else ()
                    for d, o, diagonal in zip(*[k.tolist() for k in keys], strict=True) if len(keys) else ():
                        if (d, o, diagonal) in tried:
                            continue
                        tried.add((d, o, diagonal))
                        item, words = index.items[o]
                        first, stop = int(group.first[d]), int(group.first[d + 1])
                        a, b = max(0, first - diagonal), min(len(words), stop - diagonal)
                        equal = group.hash[diagonal + a : diagonal + b] == words[a:b]
                        for start, end in stretches(equal, min(min_words, len(words)), min_match):
                            matched = int(equal[start:end].sum())
                            found.append(
                                (ids[group.lo + d].as_py(), item, matched, end - start, len(words),
                                 a + start, int(group.start[diagonal + a + start]), int(group.end[diagonal + a + end - 1]))
                            )
            names = ["doc_id", "item_id", "matched_words", "overlap_words", "item_words", "item_start", "start_byte", "end_byte"]
            columns = list(zip(*found, strict=True)) if found else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


SCHEMA = (
    "doc_id long, item_id long, matched_words long, overlap_words long, item_words long, "
    "item_start long, start_byte long, end_byte long"
)


def overlaps(
    docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS, min_match: float = MIN_MATCH
) -> DataFrame:
    """One row for each overlap of a document with a benchmark item: words and byte span."""
    slim = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    out = None
    for block in blocks(item_words(benchmark)):
        part = slim.mapInArrow(_scan(Index(block, min_words), min_words, min_match), SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], SCHEMA)


def leaks(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """One row for each document and item: the overlap with most equal words, and how much of the item it covers."""
    longest = F.max(F.struct("matched_words", "overlap_words", "item_words", (-F.col("start_byte")).alias("before"), "end_byte"))
    best = overlaps(docs, benchmark, **limits).groupBy("doc_id", "item_id").agg(longest.alias("best"), F.count("*").alias("overlaps"))
    return best.select(
        "doc_id",
        "item_id",
        F.col("best.matched_words").alias("matched_words"),
        F.col("best.overlap_words").alias("overlap_words"),
        F.round(F.col("best.matched_words") / F.col("best.item_words"), 6).alias("coverage"),
        (-F.col("best.before")).alias("start_byte"),
        F.col("best.end_byte").alias("end_byte"),
        "overlaps",
    )


def _clean(index: Index, min_words: int, min_match: float):
    """Pass on the rows whose text has no overlap with a block of the benchmark."""
    scan = _scan(index, min_words, min_match)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = pa.array(np.arange(batch.num_rows))
            texts = pa.RecordBatch.from_arrays([numbers, batch.column("text").cast(pa.string())], names=["row", "text"])
            leaking = np.zeros(batch.num_rows, bool)
            for found in scan(iter([texts])):
                leaking[found.column("doc_id").to_numpy()] = True
            yield batch.filter(pa.array(~leaking))

    return run


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS, min_match: float = MIN_MATCH
) -> DataFrame:
    """Documents that hold no benchmark passage, as they are. Decided while they are scanned, so no text is shuffled."""
    for block in blocks(item_words(benchmark)):
        docs = docs.mapInArrow(_clean(Index(block, min_words), min_words, min_match), docs.schema)
    return docs
