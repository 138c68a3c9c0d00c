"""Vector code compression: product codes whose nearest entries come from sliced bitmasks.

Every component becomes a whole number, every vector is cut into equal parts, and every part
is replaced by the index of the nearest of the part's ``ENTRIES`` codebook entries. Codebooks
start as the parts of the first vectors and are refined in ``ROUNDS`` rounds of assigning and
averaging.

Search. For each dimension of a part, the entries' coordinates are sorted, and each place in
that order carries the mask of all entries before it. A few entries that are near in one
dimension give an initial radius: their smallest distance. In every dimension the radius selects
a range of the sorted coordinates, so the entries of that range are one mask less another, and
the masks of all dimensions are ANDed. Whatever is nearer than the radius is in the result, so
distances to its entries alone settle the nearest, ties to the lower index.

A round is one pass over the vectors, staged once as whole numbers: tasks send one sum for each
(part, entry, position), so the driver sees a codebook's size and never a vector but the first ones.

Rows whose vector is null, empty, or holds a null or non-finite component take no part, nor do
vectors whose length is no multiple of ``PARTS`` or not the most frequent one (ties: the longest),
or that hold a component of ``LIMIT`` or more, whose squares would leave 64 bits. Rows without id count as
vectors and follow all others. Repeated rows are vectors of their own. With fewer than ``ENTRIES``
vectors there are as many entries as vectors. Equal distances go to the lower index. Extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.sources.scratch import stage

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LIMIT = 65536.0  # of a component's size; scaled it stays below 2 ** 28
GUESSES = 3  # dimensions whose nearest coordinate proposes an entry for the initial radius


@dataclass(frozen=True)
class Slices:
    """One part's entries, and for each dimension their sorted coordinates with prefix masks."""

    entries: np.ndarray  # entry, position
    order: np.ndarray  # position, rank -> entry
    sorted: np.ndarray  # position, rank -> coordinate
    prefix: np.ndarray  # position, rank -> mask of the entries of lower rank; one rank more than entries
    wide: np.ndarray  # the positions with the widest spread of coordinates

    @staticmethod
    def of(entries: np.ndarray) -> Slices:
        if len(entries) > 64:
            raise ValueError("a mask of 64 bits holds at most 64 entries")
        order = np.argsort(entries, axis=0, kind="stable").T
        bits = np.uint64(1) << order.astype(np.uint64)
        prefix = np.zeros((bits.shape[0], bits.shape[1] + 1), np.uint64)
        np.bitwise_or.accumulate(bits, axis=1, out=prefix[:, 1:])
        spread = entries.max(axis=0) - entries.min(axis=0)
        return Slices(
            entries, order, np.take_along_axis(entries.T, order, axis=1), prefix, np.argsort(-spread, kind="stable")[:GUESSES]
        )

    def radius(self, parts: np.ndarray) -> np.ndarray:
        """The smallest distance to an entry that is nearest in one of the wide dimensions, rounded up."""
        best = np.full(len(parts), np.iinfo(np.int64).max)
        for position in self.wide:
            at = np.searchsorted(self.sorted[position], parts[:, position]).clip(max=len(self.entries) - 1)
            np.minimum(best, _squared(parts, self.entries[self.order[position][at]]), out=best)
        return np.sqrt(best.astype(np.float64)).astype(np.int64) + 1

    def candidates(self, parts: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Mask of the entries within the radius in every dimension."""
        mask = np.full(len(parts), np.uint64((1 << len(self.entries)) - 1))
        for position in range(parts.shape[1]):
            x, coordinates, prefix = parts[:, position], self.sorted[position], self.prefix[position]
            low = np.searchsorted(coordinates, x - radius, side="left")
            high = np.searchsorted(coordinates, x + radius, side="right")
            mask &= prefix[high] & ~prefix[low]
        return mask

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of every part, and its squared distance."""
        mask = self.candidates(parts, self.radius(parts))
        code = np.zeros(len(parts), np.int64)
        best = np.full(len(parts), np.iinfo(np.int64).max)
        for entry, coordinates in enumerate(self.entries):
            rows = np.flatnonzero(mask >> np.uint64(entry) & np.uint64(1))
            distance = _squared(parts[rows], coordinates)
            nearer = distance < best[rows]
            rows = rows[nearer]
            best[rows], code[rows] = distance[nearer], entry
        return code, best


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(axis=1)


def _matrix(column: pa.ListArray, parts: int) -> np.ndarray:
    """Vectors of one length as (vector, part, position)."""
    return column.flatten().to_numpy().astype(np.int64).reshape(len(column), parts, -1)


def whole_numbers(vectors: DataFrame, vector: str = "embedding", parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """``id, label, v``: the vectors that take part, as arrays of integers, written once."""
    usable = F.forall("x", lambda c: c.isNotNull() & (F.abs(c) < LIMIT))
    scaled = vectors.select(
        F.col("vec_id").cast("long").alias("id"), "label", F.col(vector).cast("array<double>").alias("x")
    ).where((F.size("x") > 0) & (F.size("x") % parts == 0) & F.coalesce(usable, F.lit(False)))
    v = F.transform("x", lambda c: F.floor(c * F.lit(float(scale))).cast("int"))
    staged = stage(scaled.select("id", "label", v.alias("v")), "vectors")
    lengths = staged.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n"))
    return staged.where(F.size("v") == ([r["n"] for r in lengths.take(1)] or [0])[0])


def first_entries(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """Codebooks of the vectors with the smallest ids: (part, entry, position)."""
    rows = vectors.orderBy(F.asc_nulls_last("id"), "v").select("v").take(entries)
    start = np.array([r["v"] for r in rows], np.int64)
    return start.reshape(len(rows), parts, -1).transpose(1, 0, 2) if rows else np.zeros((parts, 0, 0), np.int64)


def refine(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: assign every part, then replace each used entry by the floored mean of its parts."""
    parts, entries, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices.of(b) for b in books]
        total, count = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            x = _matrix(batch.column("v"), parts)
            for p, part in enumerate(slices):
                code, _ = part.nearest(x[:, p])
                count[p] += np.bincount(code, minlength=entries)
                for j in range(width):  # sums of a batch are far below 2 ** 53, so doubles hold them exactly
                    total[p, :, j] += np.bincount(code, x[:, p, j], entries).astype(np.int64)
        used = np.flatnonzero(count.ravel().repeat(width))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(total.ravel()[used]), pa.array(count.ravel().repeat(width)[used])],
            names=["slot", "total", "n"],
        )

    made = vectors.select("v").mapInArrow(sums, "slot long, total long, n long").groupBy("slot")
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    new = books.copy().ravel()
    for row in made.agg(wide("total").alias("total"), wide("n").alias("n")).collect():
        new[row["slot"]] = int(row["total"]) // int(row["n"])
    return new.reshape(books.shape)


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks as (part, entry, position), learned from all vectors of `whole_numbers`."""
    books = first_entries(vectors, parts, entries)
    for _ in range(rounds if books.size else 0):
        books = refine(vectors, books)
    return books


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """``id, label, code, error``: entry numbers in part order, two hex digits each, and squared distances summed."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices.of(b) for b in books] if books.size else []
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("v"), parts)
            found = [part.nearest(x[:, p]) for p, part in enumerate(slices)]
            codes = np.stack([c for c, _ in found], axis=1).astype(np.uint8)
            text = [c.tobytes().hex() for c in codes]
            error = np.sum([d for _, d in found], axis=0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(text, pa.string()), pa.array(error, pa.int64())],
                names=["id", "label", "code", "error"],
            )

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id long, label {label}, code string, error long")


def decode(codes: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """Add ``decoded``: the vector that every code stands for."""
    entries = [[e.tolist() for e in book] for book in (books / scale)]
    table = F.lit(entries)
    index = lambda p: F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")
    pieces = [F.element_at(F.element_at(table, p + 1), index(p) + 1) for p in range(len(books))]
    return codes.withColumn("decoded", F.concat(*pieces))


def digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components, by part, entry and position."""
    return sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every vector that takes part.

    ``label_error`` sums the errors of equal labels, nulls together. Labels are summed first and then
    joined; a label with a third of all rows is a hot key that adaptive execution may split.
    """
    numbers = whole_numbers(vectors, vector)
    books = train(numbers)
    coded = stage(encode(numbers, books), "codes")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "same")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("same"))).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same in SQL: every part against every entry, round after round."""
    steps = [
        f"""
with kept as (
  select vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v
  from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
), parts as (
  select vec_id, label, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] as x
  from kept, (select unnest(range({parts})) as p)
), first_ids as (
  select vec_id, row_number() over (order by vec_id) - 1 as e from (select vec_id from kept order by vec_id limit {entries})
), book0 as (
  select p, e, x as c from parts join first_ids using (vec_id)
)"""
    ]
    for n in range(rounds + 1):
        steps.append(f"""
, near{n} as (
  select vec_id, label, p, any_value(x) as x, min(e) as e, any_value(d) as d from (
    select vec_id, label, p, x, e, d, min(d) over (partition by vec_id, p) as least from (
      select vec_id, label, parts.p, x, e,
        list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
      from parts join book{n} on parts.p = book{n}.p))
  where d = least group by vec_id, label, p
)""")
        if n < rounds:
            steps.append(f"""
, mean{n} as (
  select p, e, list(floor(s / n)::bigint order by i) as c from (
    select p, e, i, sum(x[i])::bigint as s, count(*) as n
    from near{n}, (select unnest(range(1, (select max(len(x)) + 1 from parts))) as i) group by p, e, i)
  group by p, e
), book{n + 1} as (
  select b.p, b.e, coalesce(m.c, b.c) as c from book{n} b left join mean{n} m on b.p = m.p and b.e = m.e
)""")
    steps.append(f"""
, coded as (
  select vec_id, label, string_agg(printf('%02x', e), '' order by p) as code, sum(d)::bigint as error
  from near{rounds} group by vec_id, label
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
  (select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) from book{rounds}) as codebooks_sha256
from coded
""")
    return "".join(steps)
