"""Prefix trie of conversations, built from sorted shards under a skeleton of splitter paths.

A conversation is a path of turns, and a trie node is a distinct sequence of first turns. Paths
are sequences of 16-byte turn hashes, so their order as bytes is the trie's depth-first order.

1. A bounded sample of paths gives the splitters of a range partitioning; a splitter includes the
   conversation's id, so equal paths may be dealt to several shards too.
2. The trie of the splitters' paths is the skeleton. A node whose conversations lie in two shards is
   a prefix of the splitter between them, so only skeleton nodes are shared; the rest is complete within its shard.
3. Every shard is sorted and read once with a stack of open nodes. Nodes outside the skeleton are
   finished when they leave the stack; for those of the skeleton the shard sends partial aggregates.
4. Partial aggregates are reduced by node and summed up along the skeleton, whose size is bounded by
   ``MOST_SHARDS`` times ``SEGMENT`` nodes whatever the input; it alone is broadcast and brought to the driver.

Long conversations are cut into segments of ``SEGMENT`` turns, each a row. Later segments form tries of
their own below the node that their first turns lead to, so no row, sort key or skeleton path grows with a
conversation. What such a trie adds to the nodes above it is charged to its smallest conversation and summed
along that conversation's segments.

The ids that end at one node are hashed in order as a stream, in one task: SHA-256 is sequential. They
arrive as sorted blocks of text, so that task reads few rows and holds one.

Turns are ordered by turn number, nulls first, then by turn hash. Null roles and texts are
empty. Rows without conv_id are left out. Repeated rows are turns of their own. Very long texts count whole.
Extra columns are ignored; an empty table gives no nodes, not even a root.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.sources.scratch import stage

SEGMENT = 64
SHARD_TURNS, MOST_SHARDS = 20_000, 4096
SAMPLED = 16  # paths a splitter is chosen from
SORT_ROWS, MOST_SORTS = 50_000, 16_384  # turns in one task while they are put in order, and tasks
IDS_PER_BLOCK = 20_000
FAMILY, HEADS = 5, 9  # conversations that share first turns; first turns taken over: crc32 modulo this
TOKEN = 16

NODE, SHARED, IDS, ROOT = range(4)
OUT = (
    "kind int, conv long, depth long, parent long, at int, n long, children long, leaves long, saved long, "
    "size long, goes_on boolean, ends string, segment long, r1 long, r2 long"
)
_NAMES = [f.split()[0] for f in OUT.split(", ")]


def ordered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, position, token, size``: turns numbered from 1 in every conversation.

    All turns are sorted by range, so one conversation may fill several tasks; the tasks' counts are
    then added up along each conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    token = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * TOKEN))
    slim = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        token.alias("token"),
        F.octet_length(text).cast("long").alias("size"),
        (F.monotonically_increasing_id() % 4096).alias("salt"),  # parts equal turns, whose order does not matter
    )
    slim = stage(slim, "turns")
    order = ["conv_id", F.asc_nulls_first("turn"), "token", "salt"]
    tasks = min(MOST_SORTS, slim.count() // SORT_ROWS + 1)
    line = stage(
        slim.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
        .select("conv_id", "token", "size", F.monotonically_increasing_id().alias("line")), "lines",
    ).withColumn("task", F.shiftright("line", 33))
    pieces = line.groupBy("conv_id", "task").agg(F.min("line").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select("conv_id", "task", (F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("start"))
    placed = line.join(starts, ["conv_id", "task"])
    return placed.select("conv_id", (F.col("line") - F.col("start") + 1).alias("position"), "token", "size")


def share_heads(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """Rebuild every conversation c: the first h turns of conversation c - c % family, then its own turns after
    the first h; h is crc32 of c as text modulo ``heads``. A conversation without turns is one row without a position.
    """
    turns = stage(turns, "ordered")
    base = F.col("conv_id") - F.col("conv_id") % family
    head = F.crc32(F.col("conv_id").cast("string")) % heads
    counts = stage(
        turns.groupBy("conv_id").agg(F.max("position").alias("n")).select("conv_id", "n", base.alias("base"), head.alias("h")),
        "conversations",
    )
    lengths = counts.where("conv_id = base").select("base", F.col("n").alias("n_base"))
    other = counts.where("conv_id != base").join(lengths, "base", "left").withColumn(
        "taken", F.least("h", F.coalesce("n_base", F.lit(0)))
    )
    firsts = turns.where((F.col("position") < heads) & (base == F.col("conv_id"))).withColumnRenamed("conv_id", "base")
    taken = other.where("taken > 0").join(firsts, "base").where("position <= taken")
    own = turns.where(base != F.col("conv_id")).join(other.where("n > h").select("conv_id", "h", "taken"), "conv_id")
    own = own.where("position > h").withColumn("position", F.expr("taken + position - h"))
    columns = ["conv_id", "position", "token", "size"]
    turnless = other.where("taken = 0 and n <= h").selectExpr(
        "conv_id", "cast(null as long) as position", "cast(null as binary) as token", "0L as size"
    )
    whole = turns.where(base == F.col("conv_id"))
    return whole.select(*columns).unionByName(taken.select(*columns)).unionByName(own.select(*columns)).unionByName(turnless)


def segments(turns: DataFrame, length: int = SEGMENT) -> DataFrame:
    """One row for every ``length`` turns: ``conv_id, segment, r1, r2, path, sizes, goes_on``.

    ``r1, r2`` identify the turns before the segment, and ``goes_on`` tells whether more follow. A conversation
    that ends with a full segment has an empty one after it, so that every trie of later segments
    knows all conversations of the node it hangs on.
    """
    number = F.coalesce(F.floor((F.col("position") - 1) / length), F.lit(0)).alias("segment")
    turn = F.when(F.col("position").isNotNull(), F.struct("position", "token", "size"))
    rows = turns.groupBy("conv_id", number).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    rows = rows.select(
        "conv_id",
        "segment",
        F.unhex(F.array_join(F.transform("turns.token", F.hex), "")).alias("path"),
        F.col("turns.size").alias("sizes"),
    )
    by_conversation = Window.partitionBy("conv_id").orderBy("segment")
    before = by_conversation.rowsBetween(Window.unboundedPreceding, -1)
    turned = {n: F.xxhash64(F.lit(n), "segment", "path") for n in (1, 2)}
    root = [F.coalesce(F.bit_xor(turned[n]).over(before), F.lit(0)).alias(f"r{n}") for n in (1, 2)]
    rows = stage(
        rows.select(
            "conv_id", "segment", *root, "path", "sizes", F.lead("segment").over(by_conversation).isNotNull().alias("goes_on")
        ),
        "segments",
    )
    full = rows.where(~F.col("goes_on") & (F.size("sizes") == length))
    after = [F.col(f"r{n}").bitwiseXOR(turned[n]).alias(f"r{n}") for n in (1, 2)]
    return rows.unionByName(
        full.select("conv_id", (F.col("segment") + 1).alias("segment"), *after).withColumns(
            {"path": F.lit(b""), "sizes": F.array().cast("array<long>"), "goes_on": F.lit(False)}
        )
    )


@dataclass(slots=True)
class _Open:
    """A node on the stack."""

    depth: int
    size: int
    at: int | None  # number in the skeleton
    conv: int | None = None
    n: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    goes_on: bool = False
    ended: object = None
    ids: list = field(default_factory=list)
    waiting: list = field(default_factory=list)  # rows of finished children, which lack this node's conv


@dataclass(frozen=True)
class Skeleton:
    """Splitters, and the trie of their paths: children by (parent, turn hash), roots by segment trie."""

    splitters: list[tuple]
    roots: dict[tuple, int]
    child: dict[tuple[int, bytes], int]
    parent: list[int | None]
    depth: list[int]
    segment: list[tuple]

    @staticmethod
    def of(splitters: list[tuple]) -> Skeleton:
        made = Skeleton(splitters, {}, {}, [], [], [])
        for *trie, path, _ in splitters:
            at = made.roots.get(tuple(trie))
            if at is None:
                at = made.roots[tuple(trie)] = made._add(None, 0, tuple(trie))
            for i in range(0, len(path), TOKEN):
                key = at, path[i : i + TOKEN]
                if key not in made.child:
                    made.child[key] = made._add(at, made.depth[at] + 1, tuple(trie))
                at = made.child[key]
        return made

    def _add(self, parent: int | None, depth: int, trie: tuple) -> int:
        self.parent.append(parent)
        self.depth.append(depth)
        self.segment.append(trie)
        return len(self.parent) - 1


def choose_splitters(rows: DataFrame, shards: int, count: int) -> list[tuple]:
    """Paths that part the rows into about equal shards, from a sample of bounded size."""
    if shards < 2:
        return []
    most = SAMPLED * shards
    slot = F.pmod(F.xxhash64("conv_id", "segment"), F.lit(1 << 40))
    share = int(min(1.0, 1.5 * most / max(count, 1)) * (1 << 40))
    key = ["segment", "r1", "r2", "path", "conv_id"]
    sample = sorted(tuple(r) for r in rows.where(slot < share).orderBy(slot, "conv_id", "segment").limit(most).select(*key).collect())
    sample = [(s, a, b, bytes(path), conv) for s, a, b, path, conv in sample]
    return sorted({sample[i * len(sample) // shards] for i in range(1, shards)}) if sample else []


def _assign(splitters: list[tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in ("segment", "r1", "r2", "path", "conv_id")], strict=True)
            shard = pa.array([bisect_right(splitters, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shard], names=[*batch.schema.names, "shard"])

    return run


class _Shard:
    """Reads the sorted rows of a shard and finishes nodes as they leave the stack."""

    def __init__(self, skeleton: Skeleton, length: int):
        self.skeleton, self.length = skeleton, length
        self.stack: list[_Open] = []
        self.trie, self.path = None, b""
        self.rows: list[tuple] = []

    def add(self, shard, trie, path, conv, sizes, goes_on, more_children, more_leaves, more_saved) -> None:
        if (shard, trie) != self.trie:
            self.close()
            self.trie, self.path = (shard, trie), b""
            self.stack = [_Open(0, 0, self.skeleton.roots.get(trie))]
        known, common = self.path, 0
        limit = min(len(known), len(path))
        while common < limit and known[common : common + TOKEN] == path[common : common + TOKEN]:
            common += TOKEN
        while len(self.stack) > common // TOKEN + 1:
            self.pop()
        for i in range(common, len(path), TOKEN):
            above = self.stack[-1]
            at = None if above.at is None else self.skeleton.child.get((above.at, path[i : i + TOKEN]))
            self.stack.append(_Open(len(self.stack), sizes[i // TOKEN], at))
        self.path = path
        node = self.stack[-1]
        node.n += 1
        node.conv = conv if node.conv is None else min(node.conv, conv)
        node.children += more_children
        node.leaves += more_leaves
        node.saved += more_saved
        if goes_on:
            node.goes_on = True
        elif trie[0] and not path:
            pass  # its end belongs to the last node of the segment before
        elif node.at is not None:
            node.ids.append(conv)
            if len(node.ids) >= IDS_PER_BLOCK:
                self.send_ids(node)
        elif node.ended is None:
            node.ended = sha256(b"%d" % conv)
        else:
            node.ended.update(b",%d" % conv)

    def send_ids(self, node: _Open) -> None:
        if node.ids:
            text = ",".join(map(str, node.ids))
            self.rows.append((IDS, node.ids[0], None, None, node.at, *[None] * 6, text, None, None, None))
            node.ids = []

    def pop(self) -> None:
        node = self.stack.pop()
        above = self.stack[-1] if self.stack else None
        segment, r1, r2 = self.trie[1]
        depth = segment * self.length + node.depth
        if node.at is not None:
            self.send_ids(node)
            self.rows.append(
                (SHARED, node.conv, depth, None, node.at, node.n, node.children, node.leaves, node.saved, node.size,
                 node.goes_on, None, None, None, None)
            )
        else:
            for row in node.waiting:
                self.rows.append((*row[:3], node.conv, *row[4:]))
            if above is None and segment:
                self.rows.append(
                    (ROOT, node.conv, depth, None, None, node.n, node.children, node.leaves, node.saved, 0, True, None,
                     segment, r1, r2)
                )
                return
            node.leaves += not node.children and not node.goes_on
            node.saved += (node.n - 1) * node.size
            ends = (node.ended or sha256()).hexdigest()
            row = (NODE, node.conv, depth, None, None if above is None else above.at, node.n, node.children, node.leaves,
                   node.saved, node.size, node.goes_on, ends, None, None, None)
            (self.rows if above is None or above.at is not None else above.waiting).append(row)
            if above is not None:
                above.children += 1
                above.leaves += node.leaves
                above.saved += node.saved
        if above is not None:
            above.n += node.n
            above.conv = node.conv if above.conv is None else min(above.conv, node.conv)

    def close(self) -> None:
        while self.stack:
            self.pop()

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) if self.rows else [()] * len(_NAMES)
        kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
        arrays = [pa.array(c, kinds[f.split()[1]]) for c, f in zip(columns, OUT.split(", "), strict=True)]
        self.rows = []
        return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


def _finish(skeleton: Skeleton, length: int):
    names = ("shard", "segment", "r1", "r2", "path", "conv_id", "sizes", "goes_on", "more_children", "more_leaves", "more_saved")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Shard(skeleton, length)
        for batch in batches:
            for shard, segment, r1, r2, path, *rest in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
                state.add(shard, (segment, r1, r2), path, *rest)
                if len(state.rows) > 20_000:
                    yield state.take()
        state.close()
        yield state.take()

    return run


def _streamed_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the texts of each node, sorted by node and first id."""
    at, running = None, None
    found: list[tuple] = []
    for batch in batches:
        for node, text in zip(batch.column("at").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if node != at:
                if running is not None:
                    found.append((at, running.hexdigest()))
                at, running = node, sha256(text.encode())
            else:
                running.update(b"," + text.encode())
    if running is not None:
        found.append((at, running.hexdigest()))
    yield pa.RecordBatch.from_arrays(
        [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.string())], names=["at", "digest"]
    )


def _pass(rows: DataFrame, length: int, shard_turns: int) -> tuple[DataFrame, DataFrame]:
    """One pass over sorted shards: finished nodes, and totals of the tries that later segments form."""
    spark = rows.sparkSession
    size = rows.agg(F.count("*").alias("n"), F.sum(F.size("sizes")).alias("turns")).collect()[0]
    shards = min(MOST_SHARDS, -(-(size["turns"] or 0) // shard_turns))
    skeleton = Skeleton.of(choose_splitters(rows, shards, size["n"]))
    shards = len(skeleton.splitters) + 1
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    dealt = rows.mapInArrow(_assign(skeleton.splitters), f"{schema}, shard int").repartitionById(shards, F.col("shard"))
    in_order = dealt.sortWithinPartitions("shard", "segment", "r1", "r2", "path", "conv_id")
    out = stage(in_order.mapInArrow(_finish(skeleton, length), OUT), "nodes")

    shared = out.where(f"kind = {SHARED}").groupBy("at").agg(
        F.min("conv").alias("conv"), F.max("depth").alias("depth"), F.max("size").alias("size"),
        F.max("goes_on").alias("goes_on"), *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")],
    )
    found = {r["at"]: r.asDict() for r in shared.collect()}  # no more than the skeleton's nodes
    for at in range(len(skeleton.parent) - 1, -1, -1):  # children come after their parents
        node, above = found[at], skeleton.parent[at]
        root_of_rest = above is None and skeleton.segment[at][0] > 0
        if not root_of_rest:
            node["leaves"] += not node["children"] and not node["goes_on"]
            node["saved"] += (node["n"] - 1) * node["size"]
        node["parent"] = None if above is None else found[above]["conv"]
        if above is not None:
            found[above]["children"] += 1
            found[above]["leaves"] += node["leaves"]
            found[above]["saved"] += node["saved"]
    fields = "conv", "depth", "parent", "n", "children", "leaves", "saved"
    table, roots = [], []
    for at, node in found.items():
        values = tuple(node[f] for f in fields)
        if skeleton.parent[at] is None and skeleton.segment[at][0] > 0:
            roots.append((*skeleton.segment[at], node["conv"], node["children"], node["leaves"], node["saved"]))
        else:
            table.append((at, *values))
    shared = spark.createDataFrame(table, "at int, " + ", ".join(f"{f} long" for f in fields))
    ids = out.where(f"kind = {IDS}").select("at", "conv", "ends").repartition("at").sortWithinPartitions("at", "conv")
    digests = ids.mapInArrow(_streamed_digests, "at int, digest string")
    # Bounded by MOST_SHARDS x (SEGMENT + 1) rows of two numbers.
    above = F.broadcast(spark.createDataFrame([(at, n["conv"]) for at, n in found.items()], "at int, above long"))
    finished = out.where(f"kind = {NODE}").join(above, "at", "left").withColumn("parent", F.coalesce("parent", "above"))
    shared = shared.join(digests, "at", "left").withColumn("ends", F.coalesce("digest", F.lit(sha256().hexdigest())))
    nodes = finished.select(*fields, "ends").unionByName(shared.select(*fields, "ends"))
    totals = out.where(f"kind = {ROOT}").select("segment", "r1", "r2", "conv", "children", "leaves", "saved")
    listed = spark.createDataFrame(roots, totals.schema)
    return nodes, totals.unionByName(listed)


def _from_below(deep: DataFrame, length: int, shard_turns: int) -> DataFrame:
    """``conv_id, segment, more_*``: what later segments add to the last node of an earlier one, on one row for each."""
    _, totals = _pass(deep.withColumns({f"more_{c}": F.lit(0).cast("long") for c in ("children", "leaves", "saved")}), length, shard_turns)
    totals = stage(totals, "totals")
    charged = deep.select("conv_id", "segment", "r1", "r2").join(
        totals.select(F.col("conv").alias("conv_id"), "segment", "leaves", "saved"), ["conv_id", "segment"], "left"
    )
    below = Window.partitionBy("conv_id").orderBy(F.desc("segment")).rowsBetween(Window.unboundedPreceding, 0)
    sums = charged.select("segment", "r1", "r2", *[F.coalesce(F.sum(c).over(below), F.lit(0)).alias(c) for c in ("leaves", "saved")])
    sums = sums.groupBy("segment", "r1", "r2").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    return totals.join(sums, ["segment", "r1", "r2"]).select(
        F.col("conv").alias("conv_id"), (F.col("segment") - 1).alias("segment"),
        F.col("children").alias("more_children"), "more_leaves", "more_saved",
    )


def prefix_trie(turns: DataFrame, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All nodes of the trie of numbered turns (`ordered_turns` or `share_heads`).

    ``conv_id`` is the smallest conversation below a node and names it together with ``depth``.
    """
    rows = segments(turns, segment)
    deep = rows.where("segment > 0")
    more = ["more_children", "more_leaves", "more_saved"]
    if deep.isEmpty():
        rows = rows.withColumns({c: F.lit(0).cast("long") for c in more})
    else:
        rows = rows.join(_from_below(deep, segment, shard_turns), ["conv_id", "segment"], "left")
        rows = stage(rows.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in more}), "segments")
    nodes, _ = _pass(rows, segment, shard_turns)
    return nodes.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )


def shared_heads_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations, rebuilt with their families' first turns."""
    return prefix_trie(share_heads(ordered_turns(conversations)))


ORACLE = f"""
with crc_table as (
  select list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, i: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by n) as crc
  from (select unnest(range(256))::bigint as n)
), turns as (
  select conv_id, turn, octet_length(encode(coalesce(text, ''))) as size,
    left(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32) as token
  from conversations where conv_id is not null
), placed as (
  select conv_id, token, size, row_number() over (partition by conv_id order by turn nulls first, token) as p from turns
), convs as (
  select conv_id, count(*) as n, conv_id - conv_id % {FAMILY} as base,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::varchar, ''), lambda ch: ord(ch)::bigint)),
      lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % {HEADS} as h
  from placed, crc_table group by conv_id, crc
), families as (
  select c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) as taken from convs c left join convs b on b.conv_id = c.base
), rebuilt as (
  select f.conv_id, p as d, token, size from families f join placed on placed.conv_id = f.base where p <= taken
  union all
  select f.conv_id, taken + p - h as d, token, size from families f join placed on placed.conv_id = f.conv_id where p > h
), rows_of as (
  select conv_id, d, size, md5(string_agg(token, '') over (partition by conv_id order by d)) as key from rebuilt
  union all
  select conv_id, 0, 0, '' from convs
), linked as (
  select *, lag(key) over (partition by conv_id order by d) as above,
    lead(d) over (partition by conv_id order by d) is null as ends
  from rows_of
), nodes as (
  select d, key, min(above) as above, min(conv_id) as conv_id, count(*) as n, min(size) as size,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256
  from linked group by d, key
), children as (
  select d - 1 as d, above as key, count(*) as n_children from nodes where d > 0 group by d, above
), charged as (
  select nodes.*, coalesce(n_children, 0) as n_children, (n - 1) * size as own,
    case when n_children is null then 1 else 0 end as leaf
  from nodes left join children using (d, key)
), below as (
  select l.d, l.key, sum(coalesce(leaf, 0)) over w as leaves, sum(coalesce(own, 0)) over w as saved
  from linked l left join charged c on c.conv_id = l.conv_id and c.d = l.d
  window w as (partition by l.conv_id order by l.d desc)
), sums as (
  select d, key, sum(leaves) as leaves, sum(saved) as saved from below group by d, key
)
select c.conv_id, c.d::bigint as depth, p.conv_id as parent_conv_id, c.n as n_convs, c.n_children,
  leaves::bigint as n_leaves, saved::bigint as saved_tokens, c.ends_sha256
from charged c join sums using (d, key) left join nodes p on p.d = c.d - 1 and p.key = c.above
"""
