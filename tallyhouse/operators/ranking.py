"""Exact quartiles, positions and ranks over a whole dataset, without sorting it in one task.

``ntile`` over an unpartitioned window sends every row to a single task. Bucket
membership, however, only depends on the rows standing at the bucket ends. Each
row gets a text key that sorts like its ranking columns. A sample of keys brackets each
bucket end; the next pass counts the rows below and within the bracket exactly and samples
within it, or reads it whole once it is small enough. Every row is then labelled by comparing its key with
the keys found. No row is shuffled, ties and hot values cost nothing extra, and the driver sees samples of
bounded size. Up to some 100,000 rows take two passes, up to some 10,000,000 three, whatever the keys' width.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import sqrt

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegralType, StringType

from tallyhouse.sources.scratch import stage

# Keys of a ranking that one pass may bring to the driver for each bucket end.
SAMPLE = 20_000
# Deviations of a sampled rank that a bracket allows for; a miss is seen by the counts and costs a pass.
SPREAD = 6.0


def sort_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """Text that sorts like the columns in ascending order, nulls first."""
    parts = []
    for name in columns:
        column, kind = F.col(name), df.schema[name].dataType
        if isinstance(kind, StringType):
            # '!' sorts before every hex digit: a prefix sorts before longer text.
            digits = F.concat(F.hex(F.encode(column, "UTF-8")), F.lit("!"))
        else:
            if isinstance(kind, DecimalType):
                number = (column * 10**kind.scale).cast("bigint")
            elif isinstance(kind, DateType):
                number = F.unix_date(column).cast("bigint")
            elif isinstance(kind, IntegralType):
                number = column.cast("bigint")
            else:
                raise TypeError(f"cannot rank by {name}: {kind.simpleString()}")
            # Flipping the sign bit makes two's complement sort as unsigned hex.
            flipped = number.bitwiseXOR(F.lit(-(2**63)).cast("bigint"))
            digits = F.lpad(F.hex(flipped), 16, "0")
        parts.append(F.when(column.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), digits)))
    return F.concat(*parts)


def bucket_ends(row_count: int, buckets: int) -> list[int]:
    """Position of the last row of each bucket but the last, counted from 1."""
    size, larger = divmod(row_count, buckets)
    return [size * n + min(n, larger) for n in range(1, buckets)]


@dataclass
class _Search:
    """The key at one position of one ranking: above ``low``, not above ``high``, perhaps ``guess``."""

    ranking: str
    position: int
    row_count: int
    sample: int
    expected: float  # rows within the bracket, as far as is known
    low: str | None = None
    high: str | None = None
    guess: str | None = None
    key: str | None = None

    def within(self) -> Column:
        key, inside = F.col(self.ranking), F.lit(True)
        if self.low is not None:
            inside = inside & (key > self.low)
        return inside if self.high is None else inside & (key <= self.high)

    def measures(self) -> Column:
        """What a pass finds out: exact counts, and keys within the bracket."""
        key, inside = F.col(self.ranking), self.within()
        drawn = inside & (F.col("_chance") < min(1.0, self.sample / max(self.expected, 1.0)))
        return F.struct(
            F.count_if(key <= F.lit(self.low)).alias("below"),
            F.count_if(inside).alias("inside"),
            F.count_if(key < F.lit(self.guess)).alias("under_guess"),
            F.count_if(key == F.lit(self.guess)).alias("at_guess"),
            F.collect_list(F.when(drawn, key)).alias("drawn"),
        )

    def narrow(self, found: Row) -> None:
        """Settle the key or tighten the bracket by what a pass found."""
        if found["under_guess"] < self.position <= found["under_guess"] + found["at_guess"]:
            self.key = self.guess
            return
        place, inside, drawn = self.position - found["below"], found["inside"], sorted(found["drawn"])
        if not 0 < place <= inside:  # the sample misled: open the side the position lies on
            self.low, self.high = (None, self.high) if place <= 0 else (self.low, None)
            self.expected = self.row_count
        elif len(drawn) == inside:
            self.key = drawn[place - 1]
        else:
            share = place / inside
            rank, margin = share * len(drawn), SPREAD * sqrt(len(drawn) * share * (1 - share)) + 2
            first, last = int(rank - margin) - 1, int(rank + margin) + 1
            before = self.low, self.high
            if first >= 0:
                self.low = drawn[first]
            if last < len(drawn):
                self.high = drawn[last]
            self.guess = drawn[min(int(rank), len(drawn) - 1)] if drawn else None
            if (self.low, self.high) == before:
                self.sample *= 2
            span = min(last, len(drawn)) - max(first, 0)
            self.expected = 1.2 * inside * span / len(drawn) if drawn else inside


def _end_keys(keyed: DataFrame, rankings: Sequence[str], buckets: int, sample: int) -> dict[str, list[str]]:
    row_count = keyed.count()
    searches = [
        # nothing stands before an empty bucket's end
        _Search(name, position, row_count, sample, row_count, key=None if position else "")
        for name in rankings
        for position in bucket_ends(row_count, buckets)
    ]
    number = 0
    while open_searches := [s for s in searches if s.key is None]:
        number += 1
        chanced = keyed.withColumn("_chance", F.rand(number))
        found = chanced.agg(*[s.measures().alias(f"s{n}") for n, s in enumerate(open_searches)]).first()
        for search, result in zip(open_searches, found, strict=True):
            search.narrow(result)
    return {name: [s.key for s in searches if s.ranking == name] for name in rankings}


def with_ntiles(
    staged: DataFrame,
    rankings: Mapping[str, Sequence[str]],
    buckets: int = 4,
    *,
    sample: int = SAMPLE,
) -> DataFrame:
    """Add one bucket column per ranking: ``{column: ranking columns}``.

    Same result as ``ntile(buckets)`` ordered by the ranking columns ascending,
    nulls first. The ranking columns together must identify a row, or rows equal
    in all of them may share a bucket. The frame is read several times, so give a
    written table (see ``tallyhouse.sources.scratch.stage``), not a long plan.
    """
    keys = {f"_key_{n}": sort_key(staged, columns) for n, columns in enumerate(rankings.values())}
    keyed = staged.select(*[key.alias(name) for name, key in keys.items()])
    ends = _end_keys(keyed, list(keys), buckets, sample)
    labels = {}
    for column, (name, key) in zip(rankings, keys.items(), strict=True):
        label = F.lit(1)
        for end in ends[name]:
            label = label + (key > F.lit(end)).cast("int")
        labels[column] = label
    return staged.withColumns(labels)


def top_rows(df: DataFrame, by: str | None, keys: Sequence[str], most: int | None = 1) -> DataFrame:
    """Rows in falling order of a measure, the first ones only if a number is given; the keys settle ties."""
    ordered = df.orderBy(*([F.col(by).desc()] if by else []), *keys)
    return ordered if most is None else ordered.limit(most)


def _in_order(df: DataFrame, order: Sequence[Column]) -> tuple[DataFrame, Column]:
    """The rows written in order, with ``_line`` rising along it, and the task each was sorted in.

    Line numbers leave gaps between tasks; they are settled once written, so a lost task changes nothing.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(ordered.withColumn("_line", F.monotonically_increasing_id()), "ordered"), F.shiftright("_line", 33)


def _before(line: DataFrame, task: Column, **counts: Column) -> DataFrame:
    """For every task its first line and the sums over the tasks before it: one row a task, worked out on the driver."""
    totals = line.groupBy(task.alias("_task")).agg(F.min("_line").alias("_first"), *[c.alias(n) for n, c in counts.items()])
    rows, before = [], dict.fromkeys(counts, 0)
    for row in sorted(totals.collect(), key=lambda r: r["_task"]):
        rows.append((row["_task"], row["_first"], *before.values()))
        before = {name: before[name] + row[name] for name in counts}
    schema = ", ".join(["_task bigint", "_first bigint", *[f"_before_{name} bigint" for name in counts]])
    return F.broadcast(line.sparkSession.createDataFrame(rows, schema))  # as many rows as the sort had tasks


def with_positions(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Number all rows from 1 in an order that tells every row apart, without bringing them to one task."""
    line, task = _in_order(df, order)
    before = _before(line, task, n=F.count(F.lit(1)))
    placed = line.join(before, task.cast("bigint") == F.col("_task"))
    position = (F.col("_line") - F.col("_first") + F.col("_before_n") + 1).alias(name)
    return placed.select(*df.columns, position)


def with_ranks(df: DataFrame, by: str, rank: str = "rank", dense_rank: str = "dense_rank") -> DataFrame:
    """Add ``rank`` and ``dense_rank`` by one column in falling order, nulls last, over a whole dataset.

    Equal values are counted before they are sorted, so what is put in order is one row for each value, and
    a rank is the number of rows before its value, from counts per task and running counts within a task.
    """
    values = df.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    line, task = _in_order(values, [F.desc_nulls_last(by)])
    before = _before(line, task, values=F.count(F.lit(1)), rows=F.sum("_n"))
    running = Window.partitionBy("_task").orderBy("_line").rowsBetween(Window.unboundedPreceding, -1)
    placed = line.join(before, task.cast("bigint") == F.col("_task"))
    ranks = placed.select(
        F.col(by).alias("_value"),
        (F.col("_before_rows") + F.coalesce(F.sum("_n").over(running), F.lit(0)) + 1).alias(rank),
        (F.col("_before_values") + F.col("_line") - F.col("_first") + 1).alias(dense_rank),
    )
    return df.join(ranks, F.col(by).eqNullSafe(F.col("_value"))).drop("_value")
