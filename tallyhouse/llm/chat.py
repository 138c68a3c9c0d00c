"""Chat formatting with cumulative-snapshot collapse, in DataFrame operations only.

Logs often hold a conversation once after every turn. Every turn gets the hash of all turns up
to it, and a conversation whose last hash is some turn's hash in a longer conversation is a
snapshot of it: an anti join keeps the maximal conversations, of equal ones that with the
smallest conv_id. These are rendered with role markers.

Prefix hashes are the XOR of hashes of (position, role, text), 128 bits. Turns are numbered
and combined in blocks of ``BLOCK_TURNS`` turn numbers first and then across blocks, so one
conversation with a third of all turns is spread over tasks. Prefixes are made distinct
before they are joined, so a first turn that a third of the conversations share is one row.

Rows without conv_id or turn have no place in a conversation and are left out. A null role
or text counts as empty. Repeated rows count once; different rows with the same turn number
follow each other by role and text. Very long texts are kept whole, and a conversation of more than
``BLOCK_TURNS`` turns is rendered in several parts, numbered from 0. Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_TURNS = 256
# Fixed value: the widespread chat markup.
TURN = ("<|im_start|>", "\n", "<|im_end|>\n")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """``conv_id, position, role, text, p1, p2, is_last``: turns in order with prefix hashes."""
    rows = (
        turns.where("conv_id is not null and turn is not null")
        .select(
            "conv_id",
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
        .withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS))
        .dropDuplicates()
    )
    by_conversation = Window.partitionBy("conv_id").orderBy("block")
    before = by_conversation.rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "block").agg(F.count("*").alias("size"))
    starts = blocks.select(
        "conv_id",
        "block",
        "size",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"),
        F.lead("block").over(by_conversation).isNull().alias("last_block"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    placed = rows.join(starts, ["conv_id", "block"]).select(
        "conv_id", "block", "turn", "role", "text", "size", "offset", "last_block", F.row_number().over(inside).alias("at")
    )
    placed = placed.withColumn("position", F.col("offset") + F.col("at"))
    hashed = placed.withColumns(
        {f"h{n}": F.xxhash64(F.lit(n), F.col("position"), "role", F.length("role"), "text") for n in (1, 2)}
    )
    running = Window.partitionBy("conv_id", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rolled = hashed.withColumns({f"r{n}": F.bit_xor(f"h{n}").over(running) for n in (1, 2)})
    ends = rolled.where("at = size").select(
        "conv_id", "block", *[F.bit_xor(f"r{n}").over(before).alias(f"b{n}") for n in (1, 2)]
    )
    joined = rolled.join(ends, ["conv_id", "block"])
    prefix = [F.col(f"r{n}").bitwiseXOR(F.coalesce(f"b{n}", F.lit(0))).alias(f"p{n}") for n in (1, 2)]
    return joined.select(
        "conv_id", "position", "role", "text", *prefix, (F.col("last_block") & (F.col("at") == F.col("size"))).alias("is_last")
    )


def maximal(hashed: DataFrame) -> DataFrame:
    """``conv_id, n_turns, copies`` of conversations that are no prefix of another."""
    key = ["position", "p1", "p2"]
    whole = (
        hashed.where("is_last").groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    )
    inner = hashed.where("not is_last").select(*key).distinct()
    return whole.join(inner, key, "left_anti").select("conv_id", F.col("position").alias("n_turns"), "copies")


def render(hashed: DataFrame, keep: DataFrame) -> DataFrame:
    """``conv_id, part, n_turns, copies, text``: the kept conversations with role markers."""
    begin, middle, end = map(F.lit, TURN)
    turn = F.struct("position", F.concat(begin, "role", middle, "text", end).alias("markup"))
    parts = (
        hashed.join(keep.select("conv_id"), "conv_id", "left_semi")
        .groupBy("conv_id", F.floor((F.col("position") - 1) / BLOCK_TURNS).alias("part"))
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    )
    return parts.join(keep, "conv_id").select(
        "conv_id", "part", "n_turns", "copies", F.concat_ws("", F.col("turns.markup")).alias("text")
    )


def collapse(turns: DataFrame) -> DataFrame:
    """Maximal conversations, rendered."""
    hashed = prefix_hashes(turns)
    return render(hashed, maximal(hashed))


ORACLE = """
with turns as (
  select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null and turn is not null
), placed as (
  select conv_id, role, text,
    row_number() over (partition by conv_id order by turn, role, text) as position,
    count(*) over (partition by conv_id) as n_turns,
    md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, chr(30)) over (
      partition by conv_id order by turn, role, text rows between unbounded preceding and current row)) as prefix
  from turns
), whole as (
  select position as n_turns, prefix, min(conv_id) as conv_id, count(*) as copies
  from placed where position = n_turns group by position, prefix
), kept as (
  select * from whole where not exists (
    select 1 from placed p where p.position < p.n_turns and p.position = whole.n_turns and p.prefix = whole.prefix)
)
select conv_id, (position - 1) // 256 as part, kept.n_turns, copies,
  string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' order by position) as text
from placed join kept using (conv_id)
group by conv_id, (position - 1) // 256, kept.n_turns, copies
"""
