"""Gates: comparisons of one-row metric frames that must hold before publishing."""

from __future__ import annotations

import functools
import logging
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.casts import MONEY
from tallyhouse.functions.measures import money_sum, money_total, rows
from tallyhouse.operators.customers import customer_orders
from tallyhouse.operators.gold import unmatched_option_lines
from tallyhouse.operators.sales import OPTION_GROUP
from tallyhouse.schemas import LINE_KEY

log = logging.getLogger(__name__)

VALUE = "decimal(28,2)"


class GateError(RuntimeError):
    """A dataset failed a check and must not be published."""


@dataclass(frozen=True)
class Gate:
    """One comparison between fields of ``source`` and ``target`` metric rows."""

    check: str
    expected: str
    actual: str
    at_least: bool = False
    warn_only: bool = False

    def row(self) -> Column:
        expected = F.expr(self.expected).cast(VALUE)
        actual = F.expr(self.actual).cast(VALUE)
        ok = F.coalesce(actual >= expected, F.lit(False)) if self.at_least else actual.eqNullSafe(expected)
        return F.struct(
            F.lit(self.check).alias("check_name"),
            F.lit("warn" if self.warn_only else "error").alias("severity"),
            expected.alias("expected"),
            actual.alias("actual"),
            ok.alias("ok"),
        )


def non_empty(side: str, label: str | None = None) -> Gate:
    return Gate(f"{label or side} is not empty", "1", f"{side}.row_count", at_least=True)


def rows_kept() -> Gate:
    return Gate("row count preserved", "source.row_count", "target.row_count")


def unique_grain() -> Gate:
    return Gate("grain is unique", "target.row_count", "target.key_count")


def total_kept(metric: str) -> Gate:
    return Gate(f"{metric} preserved", f"source.{metric}", f"target.{metric}")


def key_count(keys: Sequence[str]) -> Column:
    """Distinct keys, a null key counting as a value."""
    return F.count_distinct(F.struct(*keys)).alias("key_count")


def gate_report(dataset: str, source: DataFrame, target: DataFrame, gates: Iterable[Gate]) -> DataFrame:
    """One row per gate. Both metric frames have one row, each from a single pass."""
    both = source.sparkSession.range(1).select(
        source.select(F.struct("*")).scalar().alias("source"),
        target.select(F.struct("*")).scalar().alias("target"),
    )
    checked = both.select(F.inline(F.array(*[gate.row() for gate in gates])))
    return checked.select(F.lit(dataset).alias("dataset"), "*")


def enforce(report: DataFrame) -> list[tuple]:
    """Evaluate a gate report; raise on failed errors, log failed warnings."""
    results = report.collect()
    failed = [row for row in results if not row["ok"]]
    for row in failed:
        if row["severity"] == "warn":
            log.warning("%s: %s: %s, not %s", row["dataset"], row["check_name"], row["actual"], row["expected"])
    errors = [
        f"{row['dataset']}: {row['check_name']}: expected {row['expected']}, got {row['actual']}"
        for row in failed
        if row["severity"] == "error"
    ]
    if errors:
        raise GateError("; ".join(errors))
    return results


def written_gate(dataset: str, observed: int | None, written: DataFrame) -> DataFrame:
    """The files hold as many rows as went into them; counting files reads their footers only."""
    source = written.sparkSession.range(1).select(F.lit(observed or 0).cast("bigint").alias("row_count"))
    gate = Gate("all rows were written", "source.row_count", "target.row_count")
    return gate_report(dataset, source, written.agg(rows("row_count")), [gate])


def row_count_gate(dataset: str, raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Cleaning keeps every row. Both frames should read written files: two plans over one scan cannot differ."""
    return gate_report(dataset, raw.agg(rows("row_count")), clean.agg(rows("row_count")), [rows_kept()])


def line_grain_gate(order_items: DataFrame, line_options: DataFrame, lines: DataFrame) -> DataFrame:
    """Order lines survive the option join one to one.

    Repeated line keys attach the same options twice without changing the row
    count; that shows as attached revenue differing from matched revenue, which
    is reported but does not stop the run.
    """
    unmatched = unmatched_option_lines(order_items, line_options)
    matched = F.coalesce(F.sum("option_revenue"), F.lit(0)) - F.coalesce(
        unmatched.agg(F.sum("option_revenue")).scalar(), F.lit(0)
    )
    source = line_options.agg(matched.alias("option_revenue")).withColumn(
        "row_count", order_items.agg(rows("row_count")).scalar()
    )
    target = lines.agg(rows("row_count"), F.coalesce(F.sum("option_revenue"), F.lit(0)).alias("option_revenue"))
    attached = Gate(
        "option revenue attached once", "source.option_revenue", "target.option_revenue", warn_only=True
    )
    return gate_report("fact_order_line", source, target, [rows_kept(), attached])


def order_grain_gate(lines: DataFrame, orders: DataFrame) -> DataFrame:
    source = lines.agg(rows("row_count"))
    target = orders.agg(rows("row_count"), key_count(["order_id"]))
    return gate_report("fact_order", source, target, [non_empty("target"), unique_grain()])


def customer_daily_clv_gate(orders: DataFrame, mart: DataFrame) -> DataFrame:
    source = customer_orders(orders).agg(money_total("net_order_revenue", "net_revenue"))
    target = mart.agg(rows("row_count"), money_total("daily_net_revenue", "net_revenue"))
    return gate_report("customer_daily_clv", source, target, [non_empty("target"), total_kept("net_revenue")])


def customer_clv_snapshot_gate(daily_clv: DataFrame, mart: DataFrame) -> DataFrame:
    return _one_row_per_user("customer_clv_snapshot", daily_clv, mart)


def customer_rfm_gate(snapshot: DataFrame, mart: DataFrame) -> DataFrame:
    return _one_row_per_user("customer_rfm", snapshot, mart)


def _one_row_per_user(dataset: str, source: DataFrame, mart: DataFrame) -> DataFrame:
    target = mart.agg(rows("row_count"), key_count(["user_id"]))
    gates = [non_empty("source"), non_empty("target"), unique_grain()]
    return gate_report(dataset, source.agg(rows("row_count")), target, gates)


def _calendar_metrics(date_dim: DataFrame) -> DataFrame:
    """Calendar rows, and dates that occur more than once."""
    by_date = date_dim.groupBy("date_key").agg(rows("copies"))
    repeated = F.count_if(F.col("date_key").isNotNull() & (F.col("copies") > 1))
    return by_date.agg(
        F.struct(F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"), repeated.alias("repeated"))
    )


def _daily_gates(*extra: Gate) -> list[Gate]:
    return [
        non_empty("source", "fact_order"),
        Gate("date_dim is not empty", "1", "source.calendar.row_count", at_least=True),
        Gate("date_dim keys are unique", "0", "source.calendar.repeated"),
        non_empty("target"),
        total_kept("net_revenue"),
        *extra,
        Gate("all days are in date_dim", "0", "target.unmatched_date_count", warn_only=True),
    ]


def _daily_metrics(mart: DataFrame) -> DataFrame:
    return mart.agg(
        rows("row_count"),
        money_total("net_revenue"),
        F.sum("order_count").alias("order_count"),
        F.count_if("used_derived_date_attributes").alias("unmatched_date_count"),
    )


def daily_sales_gate(orders: DataFrame, date_dim: DataFrame, mart: DataFrame) -> DataFrame:
    source = orders.agg(rows("row_count"), money_total("net_order_revenue", "net_revenue")).withColumn(
        "calendar", _calendar_metrics(date_dim).scalar()
    )
    return gate_report("daily_sales", source, _daily_metrics(mart), _daily_gates())


def restaurant_daily_sales_gate(orders: DataFrame, date_dim: DataFrame, mart: DataFrame) -> DataFrame:
    source = orders.agg(
        rows("row_count"),
        money_total("net_order_revenue", "net_revenue"),
        F.count_distinct("order_id").alias("order_count"),
    ).withColumn("calendar", _calendar_metrics(date_dim).scalar())
    gates = _daily_gates(total_kept("order_count"))
    return gate_report("restaurant_daily_sales", source, _daily_metrics(mart), gates)


def _item_gate(dataset: str, keys: Sequence[str], lines: DataFrame, mart: DataFrame) -> DataFrame:
    source = lines.agg(
        rows("row_count"),
        rows("line_item_count"),
        F.sum("item_quantity").alias("item_quantity"),
        money_total("net_line_revenue", "net_revenue"),
    )
    target = mart.agg(
        rows("row_count"),
        key_count(keys),
        F.sum("line_item_count").alias("line_item_count"),
        F.sum("total_item_quantity").alias("item_quantity"),
        money_total("net_revenue"),
    )
    kept = [total_kept(metric) for metric in ("net_revenue", "line_item_count", "item_quantity")]
    gates = [non_empty("source"), non_empty("target"), unique_grain(), *kept]
    return gate_report(dataset, source, target, gates)


def item_sales_gate(lines: DataFrame, mart: DataFrame) -> DataFrame:
    return _item_gate("item_sales", ["item_category", "item_name"], lines, mart)


def restaurant_item_sales_gate(lines: DataFrame, mart: DataFrame) -> DataFrame:
    keys = ["restaurant_id", "item_category", "item_name"]
    return _item_gate("restaurant_item_sales", keys, lines, mart)


def option_sales_gate(options: DataFrame, mart: DataFrame) -> DataFrame:
    source = options.agg(
        rows("row_count"),
        money_total("option_revenue"),
        money_total("discount_amount"),
        F.sum("option_quantity").alias("option_quantity"),
    )
    target = mart.agg(
        rows("row_count"),
        key_count(OPTION_GROUP),
        money_total("option_revenue"),
        money_total("discount_amount"),
        F.sum("total_option_quantity").alias("option_quantity"),
    )
    kept = [total_kept(metric) for metric in ("option_revenue", "discount_amount", "option_quantity")]
    gates = [non_empty("source"), non_empty("target"), unique_grain(), *kept]
    return gate_report("option_sales", source, target, gates)


def reconcile_marts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Source total against mart total for every headline metric.

    ``layers`` holds the cleaned options, both facts and the marts by name. Each
    dataset is read once; its totals are one row.
    """
    lines, orders = layers["fact_order_line"], layers["fact_order"]
    options = layers["order_item_options_clean"]
    line_totals = lines.agg(
        rows("line_items"),
        F.sum("item_quantity").alias("item_quantity"),
        F.sum("net_line_revenue").alias("net_revenue"),
    )
    order_totals = orders.agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("net_order_revenue").alias("net_revenue"),
    )
    customer_totals = customer_orders(orders).agg(
        F.count_distinct("user_id").alias("customers"),
        F.sum("net_order_revenue").alias("lifetime_revenue"),
    )
    option_totals = options.agg(
        rows("option_rows"),
        F.sum("option_quantity").alias("option_quantity"),
        F.sum("option_revenue").alias("option_revenue"),
    )
    order_metrics = {"total_orders": F.sum("order_count"), "net_revenue": F.sum("net_revenue")}
    item_metrics = {
        "line_items": F.sum("line_item_count"),
        "item_quantity": F.sum("total_item_quantity"),
        "net_revenue": F.sum("net_revenue"),
    }
    customer_metrics = {
        "customers": F.count(F.lit(1)),
        "lifetime_revenue": F.sum("lifetime_net_revenue"),
    }
    option_metrics = {
        "option_rows": F.sum("option_row_count"),
        "option_quantity": F.sum("total_option_quantity"),
        "option_revenue": F.sum("option_revenue"),
    }
    compared = {
        "daily_sales": (order_totals, order_metrics),
        "restaurant_daily_sales": (order_totals, order_metrics),
        "item_sales": (line_totals, item_metrics),
        "restaurant_item_sales": (line_totals, item_metrics),
        "customer_clv_snapshot": (customer_totals, customer_metrics),
        "customer_rfm": (customer_totals, customer_metrics),
        "option_sales": (option_totals, option_metrics),
    }
    reports = []
    for mart, (source, metrics) in compared.items():
        target = layers[mart].agg(*[value.alias(name) for name, value in metrics.items()])
        gates = [Gate(name, f"source.{name}", f"target.{name}") for name in metrics]
        reports.append(gate_report(mart, source, target, gates))
    return functools.reduce(DataFrame.unionByName, reports).select(
        F.col("dataset").alias("mart"),
        F.col("check_name").alias("metric"),
        F.col("expected").alias("source_total"),
        F.col("actual").alias("mart_total"),
        F.col("ok").alias("is_match"),
    )


def option_revenue_gap(order_items: DataFrame, line_options: DataFrame) -> DataFrame:
    """Option revenue that no order line carries, and the orphans explaining it.

    One join of line sums with line counts gives all totals: a sum is attached
    once for every line with its key, and not at all without one. A null key
    matches nothing, as in the fact.
    """
    line_counts = order_items.groupBy(*LINE_KEY).agg(rows("line_count"))
    joined = line_options.join(line_counts, list(LINE_KEY), "left")
    revenue, is_orphan = F.col("option_revenue"), F.col("line_count").isNull()

    def money(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast(MONEY)

    return joined.agg(
        money_sum("option_revenue", "total_option_revenue"),
        money(revenue * F.col("line_count")).alias("attached_option_revenue"),
        F.count_if(is_orphan).alias("unmatched_option_lines"),
        money(F.when(is_orphan, revenue)).alias("unmatched_option_revenue"),
    ).select(
        "total_option_revenue",
        "attached_option_revenue",
        (F.col("total_option_revenue") - F.col("attached_option_revenue"))
        .cast(MONEY)
        .alias("option_revenue_gap"),
        "unmatched_option_lines",
        "unmatched_option_revenue",
    )
