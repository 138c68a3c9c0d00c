"""Byte-pair encoding with a priority queue of merges over a linked list of symbols.

A word's symbols form a doubly linked list. Every neighbouring pair that has a merge
rank goes into a heap as (rank, position); the lowest rank, leftmost first, is merged
and its two new neighbours are pushed. An entry whose symbols have changed since it
was pushed is stale and skipped. Decoding concatenates vocabulary strings.

Null and empty texts encode to no ids and decode to the empty text. Very long texts
are encoded whole, word by word. Repeated rows give repeated results, an empty table
an empty one, and input columns are kept unless they bear the result's name, which is
replaced.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from hashlib import sha256
from heapq import heapify, heappop, heappush
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words a worker remembers with their ids. A full memory keeps what was used since it was half
# full, which changes no result.
REMEMBERED_WORDS = 300_000
TEXTS_PER_STEP = 250
_GONE = -(1 << 62)
# Blanks to str.split() that the tokenizer takes for characters.
_SEPARATORS = re.compile("[\x1c-\x1f]")


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, spare = {}, 256
    for byte in range(256):
        if byte in plain:
            table[byte] = chr(byte)
        else:
            table[byte] = chr(spare)
            spare += 1
    return [table[byte] for byte in range(256)]


class Codec:
    """One tokenizer file: normalizer, word pattern, merges, vocabulary, special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.pattern = regex.compile(split["pattern"]["Regex"])
        ascii_only = split["pattern"]["Regex"].replace(r"\p{L}", "a-zA-Z").replace(r"\p{N}", "0-9")
        self.ascii_pattern = re.compile(ascii_only, re.ASCII)  # the same on plain ASCII, and faster
        self.blank = regex.compile(r"\p{White_Space}+")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.strings = {i: s for s, i in (self.vocab | self.special).items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # (left, right) as one number -> rank, and the symbol each rank makes
        self.ranks = {self.vocab[a] << 32 | self.vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.made = [self.vocab[a + b] for a, b in pairs]
        characters = _byte_characters()
        self.inner = [self.vocab.get(c, -1) for c in characters]
        self.last = [self.vocab.get(c + self.suffix, -1) for c in characters]
        self.known = _Memory(self.word, REMEMBERED_WORDS)

    def merge(self, symbols: list[int]) -> list[int]:
        """Apply merges to one word's symbols: lowest rank first, leftmost among equals."""
        n, known, made_by = len(symbols), self.ranks.get, self.made
        if n < 2:
            return symbols
        shift = max(20, n.bit_length())
        low = (1 << shift) - 1
        found = [known(a << 32 | b) for a, b in zip(symbols, symbols[1:], strict=False)]
        heap = [rank << shift | i for i, rank in enumerate(found) if rank is not None]
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n))
        while heap:
            entry = heappop(heap)
            i, rank = entry & low, entry >> shift
            j = after[i]
            if j >= n or known(symbols[i] << 32 | symbols[j]) != rank:
                continue  # stale: one of the two has been merged meanwhile
            made = symbols[i] = made_by[rank]
            symbols[j] = _GONE
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = known(made << 32 | symbols[k])
                if rank is not None:
                    heappush(heap, rank << shift | i)
            h = before[i]
            if h >= 0:
                rank = known(symbols[h] << 32 | made)
                if rank is not None:
                    heappush(heap, rank << shift | h)
        return [s for s in symbols if s != _GONE]

    def words(self, text: str) -> bytes:
        """Ids of a text without special tokens, word by word."""
        if _SEPARATORS.search(text):
            text = self.blank.sub(" ", text)
        elif text.isascii():
            return b"".join(map(self.known.__getitem__, self.ascii_pattern.findall(text.lower())))
        plain = normalize("NFC", text).replace("\u03a3", "\u03c3")
        return b"".join(map(self.known.__getitem__, self.pattern.findall(plain.lower())))

    def word(self, word: str) -> bytes:
        data = word.encode("utf-8")
        symbols = [self.inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        if -1 in symbols:  # a vocabulary without this byte: the tokenizer leaves it out
            symbols = [s for s in symbols if s >= 0]
        return _packed(self.merge(symbols))

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        parts = self.marks.split(text) if "<|" in text else [text]
        special = self.special
        return b"".join([_packed([special[p]]) if p in special else self.words(p) for p in parts])

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings one after the other, parted by blanks: the file names no decoder."""
        return " ".join(map(self.strings.__getitem__, ids))


class _Memory(dict):
    """Results of a function of one string, in two generations: the older one goes when the younger is full."""

    def __init__(self, compute, most: int):
        self.compute, self.half, self.older = compute, most // 2, {}

    def __missing__(self, key: str):
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        result = self[key] = self.older[key] if key in self.older else self.compute(key)
        return result


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The tokenizer of a path, read once in each worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _with_column(df: DataFrame, name: str, kind: T.DataType, source: str, values) -> DataFrame:
    """Append a column computed from one other, a few hundred rows at a time."""
    kept = [c for c in df.columns if c != name or c == source]
    schema = T.StructType([df.schema[c] for c in kept if c != name] + [T.StructField(name, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_PER_STEP):
                batch = whole.slice(at, TEXTS_PER_STEP)
                columns = {c: batch.column(c) for c in schema.names if c != name}
                columns[name] = values(batch.column(source))
                yield pa.RecordBatch.from_pydict({c: columns[c] for c in schema.names})

    return df.select(*kept).mapInArrow(run, schema)


def _encoded(column: pa.Array, tokenizer: str) -> pa.ListArray:
    coder = codec(tokenizer)
    coded = [coder.encode(t) for t in column.to_pylist()]
    offsets = np.zeros(len(coded) + 1, np.int32)
    np.cumsum([len(c) // 4 for c in coded], out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(coded), "<i4")))


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    numbers, offsets = column.values.to_numpy(), column.offsets.to_numpy()
    return (numbers[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True))


def _decoded(column: pa.ListArray, tokenizer: str) -> pa.Array:
    coder = codec(tokenizer)
    return pa.array([coder.decode(ids.tolist()) for ids in _lists(column)], pa.string())


def encode(df: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the token ids of every text, as an array of integers."""
    return _with_column(df, ids, T.ArrayType(T.IntegerType()), text, lambda column: _encoded(column, tokenizer))


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text that every list of ids stands for; a null list gives the empty text."""
    return _with_column(df, text, T.StringType(), ids, lambda column: _decoded(column, tokenizer))


def _digest(coder: Codec, text: str | None) -> tuple[int, str, str]:
    """Number of tokens, digest of the ids, digest of the decoded text."""
    ids = coder.encode(text)
    decoded = coder.decode(np.frombuffer(ids, "<u4").tolist())
    return len(ids) // 4, sha256(ids).hexdigest(), sha256(decoded.encode("utf-8")).hexdigest()


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text, encoded and decoded.

    The steps of `encode` and `decode` in one pass, so that ids and decoded texts, several
    times the size of the input, stay in the worker; ids count as little-endian unsigned
    32-bit numbers, texts as UTF-8, digests are lower-case hex.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_PER_STEP):
                batch = whole.slice(at, TEXTS_PER_STEP)
                rows = [_digest(coder, text.as_py()) for text in batch.column("text")]
                n, ids, decoded = zip(*rows, strict=True)
                columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            pa.default_memory_pool().release_unused()

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
