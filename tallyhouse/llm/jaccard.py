"""N-gram Jaccard join with parity sketches.

Sets of hashed word shingles are compared through XOR sketches. A sketch word is the XOR
of all shingles that fall in one part of the hash range, so it changes only where shingles
differ: the number of differing words never exceeds the size of the symmetric difference.
Sets of similar size share a level; a level cuts the hash range into more parts than a
linked pair can differ in, so linked sets agree in some words (pigeonhole) and meet in an
equality join on (level, part, word). Two documents link when 100 * |A and B| >= 80 * |A or B|.

Exactness. In a level with k parts and at most d differences, linked sets share at least
k - d parts, less the parts that are empty in both. A set with more than k - d - 1 empty
parts under one hash seed is also cut with the next seed, and after the last seed emits its
empty parts too; so of two linked sets, the first seed under which one is not so poor finds
the pair. As a linked pair shares at least q = k - d - (empty parts) words, each set can
leave out its q - 1 most frequent words (prefix filter): a word that is frequent only
because a passage is, is then not joined at all.

Groups. Equal sets are one node. Within a bucket all members are first compared with one
hub. Members that are then still in different components are compared by their parity sketches,
block by block, and only those within reach are verified, so no pair of linked members is listed.

Null and empty texts and texts of separators only have no shingles and link with nothing.
Rows without doc_id are counted but have no component and link with nothing. Repeated rows
are kept as rows and share their component. Very long texts are hashed whole. Extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.graph import components
from tallyhouse.llm.tables import batches_of
from tallyhouse.llm.words import BLANKS, Words, mix, ngrams, word_groups
from tallyhouse.sources.scratch import discard, scratch_scope, stage

SHINGLE_WORDS = 5
SEEDS = 4
LEVELS = 128
BLOCK = 4096  # members of a bucket that one task compares with as many others
BATCH = 512  # texts, or pairs of sets, that a worker is given at once
SKETCH_WORDS = 16  # of 64 bits: the parity sketch candidates are tested with
_SEED = np.random.default_rng(7).integers(1, 1 << 63, SEEDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@cache
def level_sizes() -> tuple[int, ...]:
    """Smallest set size of each level; one level up covers sizes a quarter larger."""
    sizes = [1]
    while len(sizes) < LEVELS:
        sizes.append(-(-5 * sizes[-1] // 4))
    return tuple(sizes)


@cache
def level_parts(level: int) -> tuple[int, int]:
    """Parts of a level, and the most shingles a linked pair of it can differ in."""
    low, above = level_sizes()[level], level_sizes()[level + 1]
    most = (above - 1) // 4
    if not most:
        return 1, 0
    parts = most + 2
    while True:
        empty = parts * (1 - 1 / parts) ** low
        if parts - most - 1 >= min(empty + 3 * sqrt(empty) + 2, low):
            return parts, most
        parts += 1


def shingle_sets(group: Words) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a group."""
    runs = ngrams(group.hash, SHINGLE_WORDS)
    for first, stop in zip(group.first[:-1].tolist(), group.first[1:].tolist(), strict=True):
        words = stop - first
        if words >= SHINGLE_WORDS:
            yield np.unique(runs[first : stop - SHINGLE_WORDS + 1])
        elif words:
            yield ngrams(group.hash[first:stop], words)
        else:
            yield runs[:0]


def _identity(shingles: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    if not len(shingles):
        return b"\0" * 16
    one = np.bitwise_xor.reduce(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)))
    two = np.add.reduce(mix(shingles * np.uint64(0xD1342543DE82EF95)))
    return mix(np.array([one, two])).tobytes()


def _tag(identity: bytes) -> int:
    return int.from_bytes(identity[:6], "little")


def _parity(shingles: np.ndarray) -> np.ndarray:
    """Each shingle flips one of the sketch's bits."""
    spots = (mix(shingles ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(40)) % np.uint64(SKETCH_WORDS * 64)
    odd = np.bincount(spots.astype(np.int64), minlength=SKETCH_WORDS * 64) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _level_keys(shingles: np.ndarray, level: int) -> Iterator[tuple[np.ndarray, int]]:
    """Join keys of a set in one level with what is packed beside them: seed and q."""
    parts, most = level_parts(level)
    edges = (np.arange(1, parts, dtype=np.float64) * (2.0**64 / parts)).astype(np.uint64)
    for seed in range(SEEDS):
        values = shingles if not seed else np.sort(mix(shingles * _SEED[seed]))
        cuts = np.concatenate([[0], np.searchsorted(values, edges), [len(values)]])
        full = np.flatnonzero(cuts[1:] > cuts[:-1])
        words = np.bitwise_xor.reduceat(mix(values ^ _SEED[0]), cuts[full])
        place = np.uint64(level << 40 | seed << 32) + full.astype(np.uint64)
        slack = parts - most - (parts - len(full))
        yield mix(words + mix(place)), seed << 7 | min(max(slack, 1), 127)
        if slack >= 1:
            return
    empty = np.setdiff1d(np.arange(parts), full).astype(np.uint64)
    yield mix(mix(np.uint64(level << 40) + empty) + np.uint64(1)), SEEDS - 1 << 7 | 1


def set_keys(shingles: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """All join keys of a set: its own level, and the one below, where it is the larger set."""
    own = int(np.searchsorted(level_sizes(), len(shingles), side="right")) - 1
    for level in (own, own - 1):
        if level >= 0 and level_parts(level)[1]:
            for keys, packed in _level_keys(shingles, level):
                yield keys, level << 9 | packed


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for group in word_groups(batch.column("text"), BLANKS):
            sizes, identities = [], []
            for shingles in shingle_sets(group):
                sizes.append(len(shingles))
                identities.append(_identity(shingles))
            rows = pa.array(sizes, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(group.lo, group.hi - group.lo), rows, pa.array(identities, pa.binary())],
                names=["doc_id", "n_shingles", "set_id"],
            )


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of every distinct set a task meets."""
    seen: set[bytes] = set()
    for batch in batches:
        for group in word_groups(batch.column("text"), BLANKS):
            keys, tags = [], []
            for shingles in shingle_sets(group):
                if not len(shingles) or (identity := _identity(shingles)) in seen:
                    continue
                seen.add(identity)
                tag = _tag(identity)
                for made, packed in set_keys(shingles):
                    keys.append(made)
                    tags.append(np.full(len(made), tag << 16 | packed, np.uint64))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(tags).view(np.int64))],
                    names=["key", "tag"],
                )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for group in word_groups(batch.column("text"), BLANKS):
            sets = list(shingle_sets(group))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_identity(s) for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([_parity(s).tolist() for s in sets], pa.list_(pa.int64())),
                ],
                names=["set_id", "shingles", "sketch"],
            )


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        left, right = batch.column("shingles_a"), batch.column("shingles_b")
        for i in range(batch.num_rows):
            a, b = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (left, right))
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * both >= 80 * (len(a) + len(b) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def describe_sets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_id``: one row for each input row."""
    return _slim(docs).mapInArrow(_describe, "doc_id long, n_shingles long, set_id binary")


def shared_keys(docs: DataFrame) -> DataFrame:
    """``key, tag`` of sketch words that different sets have in common, once each.

    One exchange. Copies of a set in several tasks repeat its rows, so a key's lowest and
    highest tag show whether it has another set.
    """
    keys = _slim(docs).where("doc_id is not null and text is not null").mapInArrow(_emit, "key long, tag long")
    order = Window.partitionBy("key").orderBy("tag")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    near = keys.select(
        "key",
        "tag",
        F.lag("tag").over(order).alias("before"),
        F.min("tag").over(whole).alias("low"),
        F.max("tag").over(whole).alias("high"),
    )
    first = F.col("before").isNull() | (F.col("before") != F.col("tag"))
    return near.where(first & (F.col("low") != F.col("high"))).select("key", "tag")


def prefix_filtered(shared: DataFrame) -> DataFrame:
    """Leave out the q - 1 most frequent words of each set, level and seed."""
    counts = shared.groupBy("key").agg(F.count("*").alias("sets"))
    ranked = shared.join(counts.where("sets > 1"), "key").select(
        "key",
        "tag",
        F.row_number().over(Window.partitionBy("tag").orderBy(F.desc("sets"), "key")).alias("rank"),
        F.expr("tag & 127").alias("shared_at_least"),
    )
    return ranked.where("rank >= shared_at_least").select(
        "key", F.expr("shiftrightunsigned(tag, 16)").alias("set_tag")
    )


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of set ids that link, from candidate pairs: sizes, parity sketches, then shingles."""
    side = lambda s: sets.select(*[F.col(c).alias(f"{c}_{s}" if c != "set_id" else s) for c in sets.columns])
    small = lambda s: side(s).drop(f"shingles_{s}")
    met = pairs.join(small("a"), "a").join(small("b"), "b")
    total = F.col("n_shingles_a") + F.col("n_shingles_b")
    flips = F.expr(
        "aggregate(zip_with(sketch_a, sketch_b, (x, y) -> bit_count(x ^ y)), 0, (total, n) -> total + n)"
    )
    close = met.where((flips * 9 <= total) & (F.abs(F.col("n_shingles_a") - F.col("n_shingles_b")) * 9 <= total))
    full = lambda s: side(s).select(s, f"shingles_{s}")
    return close.select("a", "b").join(full("a"), "a").join(full("b"), "b").mapInArrow(_verify, "a binary, b binary")


def links(docs: DataFrame, described: DataFrame) -> DataFrame:
    """``node, label``: the smallest set id every set with links can reach."""
    nodes = (
        described.where("n_shingles > 0 and doc_id is not null")
        .groupBy("set_id", "n_shingles")
        .agg(F.min("doc_id").alias("doc_id"))
    )
    tagged = nodes.select("set_id", _tag_column().alias("set_tag"))
    shared = stage(shared_keys(docs), "shared")
    members = stage(prefix_filtered(shared).join(tagged, "set_tag").select("key", "set_id").distinct(), "members")
    discard(shared)
    wanted = members.select("set_id").distinct().join(nodes, "set_id")
    fetched = (
        _slim(docs)
        .join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
        .mapInArrow(_sets, "set_id binary, shingles binary, sketch array<long>")
        .dropDuplicates(["set_id"])
        .join(wanted.select("set_id", "n_shingles"), "set_id")
    )
    sets = stage(fetched, "sets")
    hubs = members.groupBy("key").agg(F.min("set_id").alias("a"))
    spokes = members.join(hubs, "key").select("a", F.col("set_id").alias("b")).where("a != b").distinct()
    found = stage(verified(spokes, sets), "links")
    labels = components(found)
    labelled = members.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "key", "set_id", F.coalesce("label", "set_id").alias("label")
    )
    rest = labelled.join(hubs, "key").where("set_id != a").select("key", "set_id", "label")
    open_keys = (
        rest.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("key")
    )
    more = across(rest.join(open_keys, "key"), sets).join(spokes, ["a", "b"], "left_anti")
    return components(found.unionByName(stage(verified(more, sets), "links")))


def across(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of a bucket's members in different components whose parity sketches are near enough.

    Members are numbered and taken in blocks, so a task compares at most BLOCK with BLOCK
    sketches, and only pairs within reach leave it.
    """
    place = Window.partitionBy("key").orderBy("label", "set_id")
    numbered = members.withColumn("block", F.floor((F.row_number().over(place) - 1) / BLOCK))
    blocks = numbered.groupBy("key").agg(F.max("block").alias("last"))
    paired = (
        numbered.join(blocks, "key")
        .join(sets.select("set_id", "n_shingles", "sketch"), "set_id")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
        .select(
            "key",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "block", "set_id", "label", "n_shingles", "sketch",
        )
    )
    return paired.groupBy("key", "low", "high").applyInArrow(_near, "a binary, b binary").distinct()


def _near(table: pa.Table) -> pa.Table:
    ids, block = table.column("set_id").to_pylist(), table.column("block").to_numpy()
    _, label = np.unique(np.array(table.column("label").to_pylist(), "S16"), return_inverse=True)
    size = table.column("n_shingles").to_numpy()
    sketch = np.array(table.column("sketch").to_pylist(), np.int64).view(np.uint64)
    most = np.bincount(label).argmax()  # members of the largest component are met from the other side
    pairs: list[tuple[bytes, bytes]] = []
    for i in np.flatnonzero(label != most).tolist():
        other = label != label[i]
        if block.min() != block.max():
            other &= block != block[i]
        flips = np.bitwise_count(sketch[other] ^ sketch[i]).sum(axis=1, dtype=np.int64)
        total = size[other] + size[i]
        near = (flips * 9 <= total) & (np.abs(size[other] - size[i]) * 9 <= total)
        pairs += [(min(ids[i], ids[j]), max(ids[i], ids[j])) for j in np.flatnonzero(other)[near].tolist()]
    found = sorted(set(pairs))
    return pa.table({"a": pa.array([p[0] for p in found], pa.binary()), "b": pa.array([p[1] for p in found], pa.binary())})


def _tag_column():
    """The first six bytes of a set id as a little-endian number, as in `_tag`."""
    h = F.hex("set_id")
    swapped = F.concat(*[F.substring(h, 2 * i + 1, 2) for i in range(5, -1, -1)])
    return F.conv(swapped, 16, 10).cast("long")


def with_set_id(docs: DataFrame, name: str) -> DataFrame:
    """Add the identity of every row's shingle set; null where there are no shingles."""
    columns = [*docs.columns]
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.string())
            made = [_identity(s) if len(s) else None for g in word_groups(texts, BLANKS) for s in shingle_sets(g)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*columns, name])

    return docs.mapInArrow(run, schema)


def labelled_sets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_id, group_id, component_id`` for every row of ``docs``, written; nothing else is left of the search.

    ``group_id`` is the smallest set a row's set can reach, and tells groups apart whose smallest doc_id is the same.
    """
    with scratch_scope(docs.sparkSession, "jaccard"), batches_of(docs.sparkSession, BATCH):
        described = stage(describe_sets(docs), "described")
        labels = links(docs, described)
        linked = described.where("n_shingles > 0 and doc_id is not null")
        lowest = (
            linked.groupBy("set_id")
            .agg(F.min("doc_id").alias("lowest"))
            .join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
            .select("set_id", "lowest", F.coalesce("label", "set_id").alias("label"))
        )
        smallest = lowest.groupBy("label").agg(F.min("lowest").alias("component_id"))
        by_set = lowest.join(smallest, "label").select("set_id", F.col("label").alias("group_id"), "component_id")
        alone = described.where("n_shingles = 0 or doc_id is null").withColumns(
            {"group_id": F.lit(None).cast("binary"), "component_id": F.col("doc_id")}
        )
        columns = ["doc_id", "n_shingles", "set_id", "group_id", "component_id"]
        rows = linked.join(by_set, "set_id").select(*columns).unionByName(alone.select(*columns))
        return stage(rows, "labelled", outlives=True)


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    return labelled_sets(docs).select("doc_id", "n_shingles", "component_id")


def first_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the document with the smallest doc_id.

    Rows without doc_id or shingles stay. An id that stands on several rows is decided row by row: rows with
    texts of other groups stay or go with those, and of equal rows, or linked ones under one id, one stays. The texts are joined
    once, with a table of the ids that are not simply kept.
    """
    spark, columns = docs.sparkSession, docs.columns
    groups = labelled_sets(docs)
    known = groups.where("doc_id is not null")
    fates = known.groupBy("doc_id").agg((F.count("*") > 1).alias("again"), F.max(F.col("component_id") != F.col("doc_id")).alias("gone"))
    fates = stage(fates.where("again or gone").select("doc_id", "again"), "fates")
    # Always the same join, so that what is broadcast does not depend on the size of the table.
    kept = docs.join(fates.select(F.col("doc_id").alias("__doc")).hint("merge"), F.col("doc_id").cast("long") == F.col("__doc"), "left_anti")
    again = fates.where("again").select(F.col("doc_id").alias("__doc"))
    if again.isEmpty():
        return kept
    chosen = known.where("component_id = doc_id and n_shingles > 0").groupBy("group_id", "doc_id").agg(F.min("set_id").alias("set_id"))
    packed = docs.join(again, F.col("doc_id").cast("long") == F.col("__doc"), "left_semi").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct(*columns).alias("row")
    )
    with batches_of(spark, BATCH):
        rows = stage(with_set_id(packed, "set_id").drop("text"), "repeated")
    order = F.xxhash64(*[F.col("row")[c].cast("string") for c in columns])
    first = rows.where("set_id is not null").groupBy("doc_id", "set_id").agg(F.min_by("row", order).alias("row"))
    first = first.join(chosen, ["doc_id", "set_id"], "left_semi")
    empty = rows.where("set_id is null")
    return kept.unionByName(first.select("row.*")).unionByName(empty.select("row.*"))
