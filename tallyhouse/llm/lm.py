"""Language-model scores by stupid backoff, from n-gram counts of the whole corpus.

A word's score is count(n-gram) / count(its context) for the longest n-gram that other
documents have, times ``BACKOFF`` for every order stepped down; a word no other document has
counts as half an occurrence. A document's own occurrences are left out of all counts, so a
text does not vouch for itself. Scores are base-10 logarithms, summed for each document.

The computation is the join of exploded n-grams with a count table, in blocks. Documents
are dealt into chunks by a hash, the distinct n-grams of a chunk and their counts are cut by
hash range into blocks (one row each), a group of all blocks of one range adds up the count
table of that range and answers every block, and the answers are joined to the chunk they
came from. So an n-gram moves once for each chunk it is in, however frequent it is. Chunks and
ranges have a fixed size; their number grows with the corpus. N-grams are hashes of 48 bits
beyond those of their range.

Words are runs of ASCII letters, digits and characters beyond ASCII; letter case of A-Z is
ignored. N-grams stay within a document. Null and empty texts have no words, score 0 and a
null mean. Repeated rows count as further documents. Very long texts are scored whole. Extra
columns are ignored; an empty table gives an empty result. Rows without doc_id are scored too.
"""

from __future__ import annotations


import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.words import ALNUM, ngrams, word_groups

ORDER = 3
BACKOFF = 0.4
CHUNK_BYTES, RANGE_BYTES = 6_000_000, 3_000_000
HASH_BITS = 48  # of a hash, after those that its range has in common
_ZSTD = pa.Codec("zstd", 1)


class Chunk:
    """Words of some documents, and the index of every n-gram among the chunk's distinct ones."""

    def __init__(self, texts: pa.Array, order: int):
        groups = list(word_groups(texts, ALNUM))
        words = np.concatenate([g.hash for g in groups]) if groups else np.zeros(0, np.uint64)
        sizes = np.concatenate([np.diff(g.first) for g in groups]) if groups else np.zeros(0, np.int64)
        self.sizes, self.order = sizes, order
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        # grams[k][i]: the n-gram of order k + 1 that ends at word i, where the document has it
        parts, self.ends = [np.zeros(1, np.uint64)], []
        for k in range(1, order + 1):
            ends = np.flatnonzero(self.place >= k - 1)
            parts.append(ngrams(words, k)[ends - (k - 1)])
            self.ends.append(ends)
        joined = np.concatenate(parts)
        self.hash, index, self.count = np.unique(joined, return_inverse=True, return_counts=True)
        self.count[0] += len(words) - 1  # the empty n-gram precedes every word
        cuts = np.cumsum([len(p) for p in parts])
        self.index = [index[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _ranges(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """First index of each hash range, and the end."""
    edges = (np.arange(1, ranges) * (2.0**64 / ranges)).astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]]).astype(np.int64)


def _shorten(hashes: np.ndarray, number: int, ranges: int) -> np.ndarray:
    """The leading HASH_BITS of the hashes' offset in their range, still ascending."""
    start = np.uint64(int(number * (2.0**64 / ranges)))
    spare = np.uint64(max(0, 64 - HASH_BITS - (ranges.bit_length() - 1)))
    return (hashes - start) >> spare


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte of their digits, compressed."""
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T
    used = int(planes.any(axis=1).nonzero()[0].max(initial=-1)) + 1
    return struct.pack("<QB", len(numbers), used) + _ZSTD.compress(np.ascontiguousarray(planes[:used]), asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    count, used = struct.unpack_from("<QB", data)
    cells = np.zeros((count, 8), np.uint8)
    planes = np.frombuffer(_ZSTD.decompress(data[9:], count * used, asbytes=True), np.uint8)
    cells[:, :used] = planes.reshape(used, count).T
    return cells.view("<u8").ravel()


def _blocks(order: int, ranges: int):
    def run(table: pa.Table) -> pa.Table:
        chunk = Chunk(_texts(table), order)
        cuts = _ranges(chunk.hash, ranges)
        full = [n for n in range(ranges) if cuts[n + 1] > cuts[n]]
        return pa.table(
            {
                "part": pa.array(full, pa.int32()),
                "chunk": pa.array([table.column("chunk")[0].as_py()] * len(full), pa.int64()),
                "hashes": pa.array(
                    [_pack(np.diff(_shorten(chunk.hash[cuts[n] : cuts[n + 1]], n, ranges), prepend=np.uint64(0))) for n in full],
                    pa.binary(),
                ),
                "counts": pa.array([_pack(chunk.count[cuts[n] : cuts[n + 1]]) for n in full], pa.binary()),
            }
        )

    return run


def _texts(table: pa.Table) -> pa.Array:
    return pa.chunked_array(table.column("text").chunks, pa.string()).cast(pa.large_string()).combine_chunks()


def _totals(table: pa.Table) -> pa.Table:
    """Add up one hash range's counts and answer every block with the totals of its n-grams."""
    hashes = [np.cumsum(_unpack(h), dtype=np.uint64) for h in table.column("hashes").to_pylist()]
    counts = np.concatenate([_unpack(c) for c in table.column("counts").to_pylist()])
    distinct, index = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(index, weights=counts, minlength=len(distinct)).astype("<u8")[index]
    cuts = np.cumsum([0, *map(len, hashes)])
    answers = [_pack(total[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.table({"chunk": table.column("chunk"), "part": table.column("part"), "totals": pa.array(answers, pa.binary())})


def _score(order: int, backoff: float):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(_texts(docs), order)
        parts = answers.column("part").to_numpy()
        blocks = answers.column("totals").to_pylist()
        total = np.concatenate([_unpack(blocks[i]) for i in np.argsort(parts)]).astype(np.int64)
        words, documents = len(chunk.doc), len(chunk.sizes)
        # others[k][i]: what other documents have of the n-gram of order k ending at word i
        others = [total[0] - chunk.sizes[chunk.doc]]
        for ends, index in zip(chunk.ends, chunk.index, strict=True):
            key = chunk.doc[ends] * np.int64(len(chunk.hash)) + index
            _, inverse, own = np.unique(key, return_inverse=True, return_counts=True)
            other = np.zeros(words, np.int64)
            other[ends] = total[index] - own[inverse]
            others.append(other)
        longest = np.minimum(chunk.place + 1, order)
        score, found = np.zeros(words), np.zeros(words, bool)
        for k in range(order, 0, -1):
            now = ~found & (longest >= k) & (others[k] > 0)
            at = np.flatnonzero(now)
            context = others[0][at] if k == 1 else others[k - 1][at - 1]
            score[at] = np.log10(others[k][at] / context) + (longest[at] - k) * np.log10(backoff)
            found |= now
        rest = np.flatnonzero(~found)
        score[rest] = np.log10(0.5 / np.maximum(others[0][rest], 1)) + (longest[rest] - 1) * np.log10(backoff)
        sums = np.bincount(chunk.doc, weights=score, minlength=documents)
        mean = np.divide(sums, chunk.sizes, out=np.zeros(documents), where=chunk.sizes > 0)
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "n_words": pa.array(chunk.sizes.astype(np.int64)),
                "log10_score": pa.array(sums),
                "mean_log10": pa.array(mean, mask=chunk.sizes == 0),
            }
        )

    return run


def scores(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF) -> DataFrame:
    """``doc_id, n_words, log10_score, mean_log10`` of every row."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, ranges = max(1, -(-size // CHUNK_BYTES)), max(1, -(-size // RANGE_BYTES))
    dealt = slim.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk"), "doc_id", "text")
    blocks = dealt.groupBy("chunk").applyInArrow(_blocks(order, ranges), "part int, chunk long, hashes binary, counts binary")
    answers = blocks.groupBy("part").applyInArrow(_totals, "chunk long, part int, totals binary")
    return (
        dealt.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(_score(order, backoff), "doc_id long, n_words long, log10_score double, mean_log10 double")
    )


ORACLE = """
with words as (
  select doc, unnest(list) as word, unnest(range(1, len(list) + 1)) as i from (
    select doc_id as doc,
      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\\x{80}-\\x{10FFFF}]+') as list
    from documents)
), grams as (
  select *, lag(word, 1) over w as one, lag(word, 2) over w as two from words window w as (partition by doc order by i)
), counted as (
  select *,
    count(*) over () - count(*) over (partition by doc) as n0,
    count(*) over (partition by word) - count(*) over (partition by word, doc) as n1,
    count(*) over (partition by one, word) - count(*) over (partition by one, word, doc) as n2,
    count(*) over (partition by two, one, word) - count(*) over (partition by two, one, word, doc) as n3
  from grams
), context as (
  select *, lag(n1) over w as c1, lag(n2) over w as c2 from counted window w as (partition by doc order by i)
), scored as (
  select doc, case
    when i >= 3 and n3 > 0 then log10(n3 / c2)
    when i >= 2 and n2 > 0 then log10(n2 / c1) + (least(i, 3) - 2) * log10(0.4)
    when n1 > 0 then log10(n1 / n0) + (least(i, 3) - 1) * log10(0.4)
    else log10(0.5 / greatest(n0, 1)) + (least(i, 3) - 1) * log10(0.4) end as score
  from context
), sums as (
  select doc, count(*) as n_words, sum(score) as score from scored group by doc
)
select doc_id, coalesce(n_words, 0) as n_words, round(coalesce(score, 0), 4) as log10_score, round(score / n_words, 6) as mean_log10
from documents left join sums on doc = doc_id
"""
