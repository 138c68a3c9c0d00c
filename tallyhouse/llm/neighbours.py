"""Approximate nearest neighbours by cosine, with several shifted space-filling curves.

Each of ``CURVES`` curves projects the normalised vectors on a few random directions, shifts
and scales the projections into a cube and sorts all vectors by Hilbert key, range-partitioned
by Spark. Keys have twice ``BITS`` bits an axis, in two numbers, so that a crowd of nearly equal vectors
is ordered within its cell; what still ties is ordered by a hash that differs between curves. A curve's order is cut into blocks; a query looks at every vector of the blocks that
its window of ranks touches, so near vectors split by a cell border of one curve are met in
another. The blocks' best are merged and ranked by the exact cosine of the original vectors.

The window grows as ``WINDOW`` times the number of vectors to the power ``GROWTH`` (less than one),
as neighbours come closer when there are more vectors. Blocks hold a set number of ranks, never
a range of keys, so no block is larger for a crowded region; equal vectors are one point of the curves, and its
smallest ids stand for it.

Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows
without an id or of another length than the most frequent one. Repeated rows count once.
Queries with fewer candidates than asked for get all that were met. Ties go to the smaller id.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.sources.scratch import stage

CURVES, DIRECTIONS, BITS = 48, 8, 7
WINDOW, GROWTH = 0.12, 0.75
LEAST_BLOCK = 1024


def hilbert_keys(cells: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Position on the Hilbert curve of points with whole coordinates below 2 ** bits: upper and lower half."""
    x = cells.astype(np.uint32).T.copy()
    dims = len(x)
    # Undo the curve's turns from the coarsest bit down, then take the Gray code of the rest.
    for bit in range(bits - 1, 0, -1):
        high, below = np.uint32(1 << bit), np.uint32((1 << bit) - 1)
        for axis in range(dims):
            flip = (x[axis] & high) != 0
            swap = np.where(flip, np.uint32(0), (x[0] ^ x[axis]) & below)
            x[0] ^= np.where(flip, below, swap)
            x[axis] ^= swap
    for axis in range(1, dims):
        x[axis] ^= x[axis - 1]
    parity = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        parity ^= np.where((x[-1] >> np.uint32(bit)) & 1, np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= parity
    halves = []
    for top, low in ((bits, bits // 2), (bits // 2, 0)):
        key = np.zeros(x.shape[1], np.int64)
        for bit in range(top - 1, low - 1, -1):
            for axis in range(dims):
                key = key << 1 | (x[axis] >> np.uint32(bit) & 1).astype(np.int64)
        halves.append(key)
    return halves[0], halves[1]


def _curve(number: int, dims: int, directions: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng((1901, number))
    axes = np.linalg.qr(rng.standard_normal((dims, min(directions, dims))))[0]
    return axes, rng.random(axes.shape[1])


def _keys(curves: int, directions: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("point")
            x = np.frombuffer(b"".join(batch.column("vector").to_pylist()), np.float64).reshape(len(ids), -1)
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            for number in range(curves):
                axes, shift = _curve(number, x.shape[1], directions)
                # projections of unit vectors spread like a normal law of deviation 1 / sqrt(dims)
                even = 1 / (1 + np.exp(-1.702 * np.sqrt(x.shape[1]) * (unit @ axes)))
                cells = np.minimum((even + shift) / 2 * (1 << 2 * bits), (1 << 2 * bits) - 1)
                key, fine = hilbert_keys(cells, 2 * bits)
                columns = [pa.array(np.full(len(ids), number, np.int32)), pa.array(key), pa.array(fine), ids]
                yield pa.RecordBatch.from_arrays(columns, names=["curve", "key", "fine", "point"])

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles."""
    for batch in batches:
        lists = batch.column("vector")
        values, cuts = lists.values.to_numpy().astype(np.float64), lists.offsets.to_numpy()
        packed = [values[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["point", "vector"])


def _best(keep: int):
    """The nearest of a block's vectors for each query in it."""

    def run(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids = table.column("point").to_numpy()
        x = np.frombuffer(b"".join(table.column("vector").to_pylist()), np.float64).reshape(len(ids), -1)
        size = np.sqrt((x * x).sum(axis=1))
        q, m = np.flatnonzero(asks), np.flatnonzero(~asks)
        rows: list[list[np.ndarray]] = [[], [], []]
        for at in range(0, len(q) if len(m) else 0, 256):
            some = q[at : at + 256]
            score = (x[some] @ x[m].T) / (size[some][:, None] * size[m][None])
            n = min(keep, len(m))
            top = np.argpartition(-score, n - 1, axis=1)[:, :n]
            edge = np.take_along_axis(score, top, axis=1).min(axis=1)
            r, c = np.nonzero(score >= edge[:, None])  # ties at the edge stay
            rows[0].append(ids[some][r])
            rows[1].append(ids[m][c])
        asked, met = (np.concatenate(r) if r else np.zeros(0, np.int64) for r in rows[:2])
        return pa.table({"ask": pa.array(asked, pa.int64()), "met": pa.array(met, pa.int64())})

    return run


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact cosine of every pair, in double precision, the same wherever the pair turns up."""
    for batch in batches:
        if batch.num_rows:
            x, y = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.float64).reshape(batch.num_rows, -1)
                for c in ("vector_ask", "vector_met")
            )
            score = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("ask"), batch.column("met"), pa.array(score)], names=["ask", "met", "score"]
            )


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, vector`` of the rows that can take part, once each."""
    v = F.col("vector")
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda c: c != 0)).distinct()
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (lengths["n"] if lengths else 0))


def ranks(keys: DataFrame) -> DataFrame:
    """``curve, point, rank``: places in each curve's order, from one range-partitioned sort."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = ["curve", "key", "fine", F.xxhash64("curve", "point"), "point"]
    ordered = (
        keys.repartitionByRange(parts, *places)
        .sortWithinPartitions(*places)
        .select("curve", "point", F.monotonically_increasing_id().alias("at"))
    )
    ordered = stage(ordered, "curves")
    part, at = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    runs = ordered.groupBy("curve", part.alias("part")).agg(F.min(at).alias("begin"), F.count("*").alias("size"))
    earlier = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select("curve", "part", "begin", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    return (
        ordered.withColumn("part", part)
        .join(offsets, ["curve", "part"])
        .select("curve", "point", (at - F.col("begin") + F.col("offset")).alias("rank"))
    )


def nearest(
    vectors: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding",
    curves: int = CURVES, window: float = WINDOW, growth: float = GROWTH, least_block: int = LEAST_BLOCK,
) -> DataFrame:
    """``query_id, rank, id, score``: up to k nearest other rows of every row where ``is_query`` holds.

    ``is_query`` is a condition on the column ``id``.
    """
    rows = stage(usable(vectors, key, vector), "vectors")
    keep = k + 1
    first = Window.partitionBy("vector").orderBy("id")
    # the smallest ids of every distinct vector; they and the query itself decide all ties
    heads = stage(
        rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= keep), "heads"
    )
    points = stage(
        heads.where("n = 1").select(F.col("id").alias("point"), "vector").mapInArrow(_pack, "point long, vector binary"),
        "points",
    )
    stands_for = heads.join(heads.where("n = 1").select(F.col("id").alias("point"), "vector"), "vector").select("id", "point")
    asked = rows.where(is_query).join(
        heads.where("n = 1").select(F.col("id").alias("point"), "vector"), "vector"
    ).select(F.col("id").alias("query_id"), "point")
    count = points.count()
    reach = max(keep, ceil(window * count**growth))
    size = max(least_block, 2 * reach)
    placed = stage(ranks(points.mapInArrow(_keys(curves, DIRECTIONS, BITS), "curve int, key long, fine long, point long")), "ranks")
    members = placed.select("curve", F.floor(F.col("rank") / size).alias("block"), "point", F.lit(False).alias("asks"))
    asks = placed.join(asked.select("point").distinct(), "point").select(
        "curve",
        F.explode(
            F.sequence(
                F.floor(F.greatest(F.col("rank") - reach, F.lit(0)) / size),
                F.floor(F.least(F.col("rank") + reach, F.lit(max(count - 1, 0))) / size),
            )
        ).alias("block"),
        "point",
        F.lit(True).alias("asks"),
    )
    met = (
        members.unionByName(asks)
        .join(points, "point")
        .groupBy("curve", "block")
        .applyInArrow(_best(keep), "ask long, met long")
        .distinct()
    )
    side = lambda s: points.select(F.col("point").alias(s), F.col("vector").alias(f"vector_{s}"))
    exact = met.join(side("ask"), "ask").join(side("met"), "met").mapInArrow(_cosines, "ask long, met long, score double")
    best = Window.partitionBy("ask").orderBy(F.desc("score"), "met")
    merged = exact.withColumn("n", F.row_number().over(best)).where(F.col("n") <= keep)
    found = (
        merged.join(stands_for.withColumnRenamed("point", "met"), "met")
        .join(asked.withColumnRenamed("point", "ask"), "ask")
        .where("id != query_id")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        found.select("query_id", "id", "score", F.row_number().over(order).alias("rank"))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
    )
