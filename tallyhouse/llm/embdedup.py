"""Near-duplicate embeddings through randomly rotated binary codes.

Two vectors of one label link when their cosine is at least ``THRESHOLD``. A unit vector is
rotated at random and coded by the signs of its coordinates; with the code goes its correction
factor, the inner product of the vector with its own code. The inner product of one vector's code
with another vector, divided by that factor, is an unbiased estimate of the cosine, whose error is
bounded with a confidence set by ``SPREAD``. The other vector enters with four bits a coordinate, rounded
at random so that the estimate stays unbiased. A pair whose upper bound is below the threshold is out;
every other pair that is met is computed again from the original vectors in double precision, so no link is wrong.

1. Equal vectors of a label are one point with a weight.
2. Signs of further rotations make join keys. A key has some bits more than the number of
   points, so chance meetings are few, and there are so many keys that a pair at the threshold
   misses all of them with a probability of at most ``MISS`` (nearer pairs far less).
3. Points that share a key are estimated against its smallest point. Keys that still
   hold points of several groups are compared in blocks, all others against the largest group. Only
   pairs that the bound cannot exclude join groups, and only spanning links are written.
4. Each group is compared in pairs of blocks: estimates first, then exact cosines. A task sends
   one count a point and a spanning forest, so a crowd of near copies never becomes a list of pairs.

A crowd of m different near copies takes m * m comparisons, as its exact link counts ask for, in tasks of
at most ``BLOCK`` times ``BLOCK``.

Rows with a null label, or a vector that is null, empty, zero or holds null or non-finite components link
with nothing and are their own component; so do vectors of different lengths. Rows without vec_id link
with nothing and have no component and are not kept. Repeated rows are vectors of their own that link. Extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import acos, ceil, log, log2, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.graph import components
from tallyhouse.llm.words import mix
from tallyhouse.sources.scratch import stage

THRESHOLD = 0.98
MISS = 1e-5  # the chance that a pair at the threshold shares no key
SPREAD = 5.0  # deviations of the estimate's error bound
CODE_BITS = 64  # at least; a rotation gives as many bits as there are dimensions
BLOCK, LEAST_BLOCK = 4096, 128
FEATURES = "code binary, factor double, levels binary, low double, step double"


@lru_cache(maxsize=256)
def rotation(dims: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    return np.linalg.qr(np.random.default_rng((4129, dims, number)).standard_normal((dims, dims)))[0]


def key_plan(points: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """Bits of a key and number of keys for so many points of one label."""
    bits = min(max(ceil(log2(max(points, 2))) + 7, 8), 48)
    meet = (1 - acos(min(max(threshold, -1.0), 1.0)) / pi) ** bits
    return bits, max(1, ceil(log(miss) / log(1 - meet))) if meet < 1 else 1


def _matrix(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and unit vectors, one matrix for each length of vectors."""
    packed = column.to_pylist()
    sizes = np.array([len(p) for p in packed])
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        x = np.frombuffer(b"".join(packed[r] for r in rows), np.float64).reshape(len(rows), -1)
        x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
        yield rows, x / np.linalg.norm(x, axis=1, keepdims=True)


def _turned(unit: np.ndarray, first: int, bits: int) -> np.ndarray:
    """Coordinates after as many rotations as it takes for so many bits."""
    turns = ceil(bits / unit.shape[1])
    return np.hstack([unit @ rotation(unit.shape[1], first + n) for n in range(turns)]) / sqrt(turns)


def features(unit: np.ndarray, points: np.ndarray) -> list[pa.Array]:
    """Binary code, correction factor, and the coordinates in four bits."""
    turned = _turned(unit, 0, CODE_BITS)
    dims = turned.shape[1]
    low, high = turned.min(axis=1), turned.max(axis=1)
    step = np.maximum((high - low) / 15, 1e-12)
    # rounds up with the probability of the remainder; the same for the same point
    chance = (np.random.default_rng(dims).random(dims) + (points[:, None] % 65537) * 0.6180339887498949) % 1.0
    levels = np.floor((turned - low[:, None]) / step[:, None] + chance).clip(0, 15).astype(np.uint8)
    if dims % 2:
        levels = np.hstack([levels, np.zeros((len(levels), 1), np.uint8)])
    nibbles = levels[:, ::2] << 4 | levels[:, 1::2]
    return [
        pa.array([c.tobytes() for c in np.packbits(turned > 0, axis=1)], pa.binary()),
        pa.array(np.abs(turned).sum(axis=1) / sqrt(dims)),
        pa.array([n.tobytes() for n in nibbles], pa.binary()),
        pa.array(low),
        pa.array(step),
    ]


class Side:
    """The features of some points as matrices."""

    def __init__(self, table: pa.Table | pa.RecordBatch, width: int, ending: str = ""):
        read = lambda name: table.column(f"{name}{ending}")
        dims = width * ceil(CODE_BITS / width)
        raw = lambda name: np.array([np.frombuffer(v, np.uint8) for v in read(name).to_pylist()])
        self.signs = np.unpackbits(raw("code"), axis=1)[:, :dims].astype(np.float32) * 2 - 1
        nibbles = raw("levels")
        levels = np.stack([nibbles >> 4, nibbles & 15], axis=2).reshape(len(nibbles), -1)[:, :dims]
        low, step = read("low").to_numpy(), read("step").to_numpy()
        self.rough = (low[:, None] + step[:, None] * levels).astype(np.float32)
        self.factor = read("factor").to_numpy()
        error = np.sqrt(np.maximum(1 - self.factor**2, 0)) / self.factor / sqrt(max(dims - 1, 1))
        self.bound = SPREAD * np.hypot(error, step.max(initial=0.0) / 2 / self.factor)

    def take(self, rows: np.ndarray) -> Side:
        part = object.__new__(Side)
        part.__dict__ = {name: value[rows] for name, value in self.__dict__.items()}
        return part


def possible(a: Side, b: Side, threshold: float) -> np.ndarray:
    """Which pairs the bounds cannot exclude, from either side's code."""
    scale = sqrt(a.signs.shape[1])
    one = a.signs @ b.rough.T / (scale * a.factor[:, None]) + a.bound[:, None]
    two = a.rough @ b.signs.T / (scale * b.factor[None, :]) + b.bound[None, :]
    return np.minimum(one, two) >= threshold


def _spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Which of the links (a, b) between n nodes make a spanning forest."""
    parent = list(range(n))
    keep = np.zeros(len(a), bool)
    for k, (i, j) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        while parent[j] != j:
            parent[j] = j = parent[parent[j]]
        if i != j:
            parent[i] = j
            keep[k] = True
    return keep


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["point", *[f.split()[0] for f in FEATURES.split(", ")]]
    for batch in batches:
        for rows, unit in _matrix(batch.column("vector")):
            points = batch.column("point").take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([points, *features(unit, points.to_numpy())], names=names)


def _keys(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.uint64(1) << np.arange(bits, dtype=np.uint64)
        for batch in batches:
            label = batch.column("label_hash").to_numpy().view(np.uint64)
            for rows, unit in _matrix(batch.column("vector")):
                signs = _turned(unit, 1000, bits * tables) > 0  # rotations other than the code's
                points = batch.column("point").take(pa.array(rows))
                for table in range(tables):
                    word = (signs[:, table * bits : (table + 1) * bits] * weights).sum(axis=1, dtype=np.uint64)
                    key = mix(mix(word + mix(label[rows])) + np.uint64(table))
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), points], names=["key", "point"])

    return run


def _spokes(threshold: float):
    """Pairs (a, b) that the bounds cannot exclude."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths):
                part = batch.filter(pa.array(widths == width))
                a, b = Side(part, int(width), "_a"), Side(part, int(width), "_b")
                scale = sqrt(a.signs.shape[1])
                one = (a.signs * b.rough).sum(axis=1) / (scale * a.factor) + a.bound
                two = (a.rough * b.signs).sum(axis=1) / (scale * b.factor) + b.bound
                yield part.select(["a", "b"]).filter(pa.array(np.minimum(one, two) >= threshold))

    return run


def _across(threshold: float):
    """A spanning forest of the possible pairs between a block of a key and the key's smaller groups."""

    def run(table: pa.Table) -> pa.Table:
        points, role = table.column("point").to_numpy(), table.column("roams").to_numpy(zero_copy_only=False)
        side = Side(table, int(table.column("width")[0].as_py()))
        found = [np.zeros(0, np.int64)] * 2
        roaming, here = np.flatnonzero(role), np.flatnonzero(~role)
        for at in range(0, len(roaming), 1024):
            rows = roaming[at : at + 1024]
            for others in (here, roaming):
                i, j = np.nonzero(possible(side.take(rows), side.take(others), threshold))
                i, j = rows[i], others[j]
                i, j = i[points[i] != points[j]], j[points[i] != points[j]]
                keep = _spanning(i, j, len(points))
                found = [np.append(found[0], i[keep]), np.append(found[1], j[keep])]
        return pa.table({"a": pa.array(points[found[0]]), "b": pa.array(points[found[1]])})

    return run


def _compare(threshold: float):
    """Exact links within a pair of blocks: weights linked to each point, and a spanning forest."""

    def run(table: pa.Table) -> pa.Table:
        points, weight = table.column("point").to_numpy(), table.column("weight").to_numpy()
        block = table.column("block").to_numpy()
        side = Side(table, int(table.column("width")[0].as_py()))
        ((_, unit),) = _matrix(table.column("vector"))
        same = block.min() == block.max()
        left = np.flatnonzero(block == block.min())
        right = left if same else np.flatnonzero(block == block.max())
        linked = np.zeros(len(points), np.int64)
        forest: list[tuple[int, int]] = []
        for at in range(0, len(left), 512):
            rows = left[at : at + 512]
            open_pairs = possible(side.take(rows), side.take(right), threshold)
            if same:  # each pair once, none with itself
                open_pairs &= points[rows][:, None] < points[right][None, :]
            i, j = np.flatnonzero(open_pairs.any(axis=1)), np.flatnonzero(open_pairs.any(axis=0))
            if not len(i):
                continue
            links = (unit[rows[i]] @ unit[right[j]].T >= threshold) & open_pairs[np.ix_(i, j)]
            linked[rows[i]] += links @ weight[right[j]]
            linked[right[j]] += weight[rows[i]] @ links
            x, y = np.nonzero(links)
            x, y = rows[i][x], right[j][y]
            keep = _spanning(x, y, len(points))
            forest += zip(points[x[keep]].tolist(), points[y[keep]].tolist(), strict=True)
        met = np.flatnonzero(linked)
        a = points[met].tolist() + [p for p, _ in forest]
        b = [None] * len(met) + [q for _, q in forest]
        n = linked[met].tolist() + [None] * len(forest)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    return run


def read_vectors(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, label, vector, digest`` of every row; vector (doubles as bytes) and digest are null where a row takes no part."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    usable = (F.size(x) > 0) & finite & F.exists(x, lambda c: c != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.when(F.coalesce(usable, F.lit(False)), x).alias("x")
    )

    label = vectors.schema["label"].dataType.simpleString()
    schema = f"vec_id long, label {label}, vector binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x")
            values, sizes = x.flatten().to_numpy() + 0.0, x.value_lengths().fill_null(0).to_numpy()
            cuts = np.append(0, np.cumsum(sizes))
            whole = [values[a:b].tobytes() if b > a else None for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(whole, pa.binary())], names=["vec_id", "label", "vector"]
            )

    packed = rows.mapInArrow(pack, schema)
    text = F.concat_ws("|", F.col("label").cast("string"), F.hex("vector"))
    return packed.withColumn("digest", F.when(F.col("vector").isNotNull(), F.unhex(F.substring(F.sha2(text, 256), 1, 32))))


def candidate_groups(points: DataFrame, described: DataFrame, threshold: float, block: int) -> DataFrame:
    """``point, group`` of the points that may link with another one; whoever may link is in one group."""
    sizes = points.groupBy("label", F.length("vector")).count().agg(F.max("count").alias("n"))
    bits, tables = key_plan(sizes.collect()[0]["n"] or 0, threshold)
    hashed = points.select("point", "vector", F.xxhash64("label", F.length("vector")).alias("label_hash"))
    keys = stage(hashed.mapInArrow(_keys(bits, tables), "key long, point long"), "keys")
    hubs = keys.groupBy("key").agg(F.min("point").alias("hub"), F.count("*").alias("size")).where("size > 1")
    members = stage(keys.join(hubs, "key"), "members")
    side = lambda s: described.select(*[F.col(c).alias(f"{c}_{s}" if c != "point" else s) for c in described.columns])
    pairs = members.where("hub != point").select(F.col("hub").alias("a"), F.col("point").alias("b")).distinct()
    met = pairs.join(side("a"), "a").join(side("b"), "b").where("width_a = width_b").withColumnRenamed("width_a", "width")
    near = stage(met.mapInArrow(_spokes(threshold), "a long, b long"), "near")
    labels = components(near).withColumnRenamed("node", "point")
    # keys whose points are not all in one group, but for those of two points, which were compared
    placed = members.where("size > 2").join(labels, "point", "left").select(
        "key", "point", "size", F.coalesce("label", "point").alias("label")
    )
    groups = stage(placed.groupBy("key", "label").agg(F.count("*").alias("n")), "key_groups")
    largest = groups.groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("k"))
    blocks = F.ceil(F.col("size") / block).cast("int")
    spread = placed.join(largest.where("k > 1"), "key").select(
        "key", "point", (F.col("label") != F.col("main")).alias("roams"), blocks.alias("blocks")
    )
    dealt = spread.withColumn(
        "block",
        F.explode(
            F.when(F.col("roams"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(
                F.array(F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int"))
            )
        ),
    ).join(described, "point")
    more = stage(dealt.groupBy("key", "block", "width").applyInArrow(_across(threshold), "a long, b long"), "more")
    if more.isEmpty():
        return labels.select("point", F.col("label").alias("group"))
    return components(near.unionByName(more)).select(F.col("node").alias("point"), F.col("label").alias("group"))


def exact_links(points: DataFrame, described: DataFrame, groups: DataFrame, threshold: float, block: int, least: int) -> DataFrame:
    """``a, n`` for the weight linked to a point within two blocks, ``a, b`` for spanning links."""
    sizes = groups.groupBy("group").agg(F.count("*").alias("size"))
    n = F.greatest(F.ceil(F.col("size") / block), F.least(F.lit(8), F.ceil(F.col("size") / least))).cast("int")
    dealt = (
        groups.join(sizes, "group")
        .select("point", "group", n.alias("blocks"))
        .withColumn("block", F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("point", "group", "block", F.least("block", "other").alias("low_block"), F.greatest("block", "other").alias("high_block"))
    )
    full = points.select("point", "label", "weight", "vector").join(described, "point")
    return (
        dealt.join(full, "point")
        .groupBy("group", "label", "width", "low_block", "high_block")
        .applyInArrow(_compare(threshold), "a long, b long, n long")
    )


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    vector: str = "embedding",
    block: int = BLOCK,
    least_block: int = LEAST_BLOCK,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    rows = stage(read_vectors(vectors, vector), "vectors")
    equal = (
        rows.where("digest is not null")
        .groupBy("digest")
        .agg(F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("weight"), F.min("vec_id").alias("lowest"))
    )
    points = stage(equal.withColumn("point", F.monotonically_increasing_id()), "points")
    width = points.select("point", (F.length("vector") / 8).cast("int").alias("width"))
    described = stage(points.select("point", "vector").mapInArrow(_describe, f"point long, {FEATURES}").join(width, "point"), "codes")
    groups = stage(candidate_groups(points, described, threshold, block), "groups")
    links = stage(exact_links(points, described, groups, threshold, block, least_block), "links")
    linked = links.where("n is not null").groupBy(F.col("a").alias("point")).agg(F.sum("n").alias("linked"))
    found = components(links.where("b is not null").select("a", "b")).withColumnRenamed("node", "point")
    lowest = (
        points.select("point", "digest", "weight", "lowest")
        .join(linked, "point", "left")
        .join(found.withColumnRenamed("label", "component"), "point", "left")
        .withColumn("component", F.coalesce("component", "point"))
    )
    smallest = lowest.groupBy("component").agg(F.min("lowest").alias("component_id"))
    result = lowest.join(smallest, "component").select(
        "digest", (F.col("weight") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id"
    )
    joined = rows.select("vec_id", "digest").join(result, "digest", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


ORACLE = f"""
with recursive vectors as (
  select vec_id, label, embedding::double[] as v from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
    and len(list_filter(embedding, lambda x: x != 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from vectors a join vectors b
  on a.label = b.label and a.vec_id != b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= {THRESHOLD}
), reach as (
  select vec_id as a, vec_id as b from embeddings
  union
  select reach.a, links.b from reach join links on reach.b = links.a
), lowest as (
  select a as vec_id, min(b) as component_id from reach group by a
)
select vec_id, (select count(*) from links where links.a = lowest.vec_id) as n_links, component_id,
  vec_id = component_id as kept
from lowest
"""
