"""The whole run for one ingest date: raw, cleaned, facts, marts.

Every dataset is written once, next to its place. Counts and totals are measured during that write, gates compare them and the
written files with the sources, and a dataset that passes is renamed into its date. What the run put into
the scratch folder is removed at its end, also after a failed gate.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass, field
from datetime import UTC, datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession

from tallyhouse.operators import checks, customers, gold, sales, silver
from tallyhouse.session import configure, freed_exchanges, sized_shuffles
from tallyhouse.sources.layers import read_layer
from tallyhouse.sources.publishing import publish, withdraw, write_draft
from tallyhouse.sources.scratch import discard, scratch_scope, stage

log = logging.getLogger(__name__)

SOURCES = ("order_items", "order_item_options", "date_dim")

LAYER_OF = {
    **{name: "raw" for name in SOURCES},
    **{f"{name}_clean": "silver" for name in SOURCES},
    "fact_order_line": "gold",
    "fact_order": "gold",
    "customer_daily_clv": "mart",
    "customer_clv_snapshot": "mart",
    "customer_rfm": "mart",
    "daily_sales": "mart",
    "restaurant_daily_sales": "mart",
    "item_sales": "mart",
    "restaurant_item_sales": "mart",
    "option_sales": "mart",
}
MARTS = tuple(name for name, layer in LAYER_OF.items() if layer == "mart")

# How each source is cleaned, and what is measured while its cleaned rows are written.
_CLEANERS: dict[str, tuple[Callable[[DataFrame], DataFrame], Callable[[], list[Column]]]] = {
    "order_items": (silver.clean_order_items, silver.order_items_measures),
    "order_item_options": (silver.clean_order_item_options, silver.options_measures),
    "date_dim": (silver.clean_date_dim, list),
}


def today() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%d")


def base_path(root: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{LAYER_OF[dataset]}/{dataset}"


def table_paths(root: str, datasets: tuple[str, ...] = MARTS) -> dict[str, str]:
    """Folders to register as SQL tables."""
    return {name: base_path(root, name) for name in datasets}


@dataclass
class LayeredRun:
    """Published datasets of one date, every gate result, and what was measured while each dataset was written."""

    spark: SparkSession
    root: str
    ingest_date: str
    layers: dict[str, DataFrame] = field(default_factory=dict)
    checked: dict[str, list[tuple]] = field(default_factory=dict)
    observed: dict[str, dict[str, object]] = field(default_factory=dict)

    def __getitem__(self, dataset: str) -> DataFrame:
        return self.layers[dataset]

    @property
    def gates(self) -> list[tuple]:
        return [row for dataset in LAYER_OF for row in self.checked.get(dataset, [])]

    def build(
        self,
        dataset: str,
        df: DataFrame,
        gate: Callable[[DataFrame], DataFrame] | None = None,
        measures: Sequence[Column] = (),
    ) -> DataFrame:
        """Write a draft, check its files, publish it. Each dataset has its own entries, so steps may run at once."""
        base = base_path(self.root, dataset)
        draft = write_draft(df, base, self.ingest_date, *measures)
        try:
            report = checks.written_gate(dataset, draft.observed.get("row_count"), draft.df)
            self.checked[dataset] = checks.enforce(report.unionByName(gate(draft.df)) if gate else report)
            publish(draft)
        except BaseException:
            withdraw(draft)
            raise
        log.info("published %s for %s: %s", dataset, self.ingest_date, draft.observed)
        self.observed[dataset] = draft.observed
        self.layers[dataset] = read_layer(self.spark, base, self.ingest_date)
        return self.layers[dataset]


def _together(*steps: Callable[[], None]) -> None:
    """Run steps at once, within the scratch scope of the caller; the first error is raised when all have ended."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(copy_context().run, step) for step in steps]:
            done.result()


def run_layers(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    root: str,
    ingest_date: str | None = None,
) -> LayeredRun:
    """Run everything in dependency order; a failed gate stops what depends on it.

    The date is settled once, so a run across midnight stays one run.
    """
    configure(spark)
    run = LayeredRun(spark, root, ingest_date or today())

    def clean_source(name: str) -> None:
        raw = run.build(name, sources[name])
        clean, measures = _CLEANERS[name]
        run.build(f"{name}_clean", clean(raw), partial(checks.row_count_gate, f"{name}_clean", raw), measures())

    with scratch_scope(spark, "run_layers"), freed_exchanges(spark):
        # Datasets that do not depend on each other are submitted together, which
        # keeps the cluster busy while one of them is down to its last tasks.
        _together(*[partial(clean_source, name) for name in SOURCES])
        items, options, dates = (run[f"{name}_clean"] for name in SOURCES)
        with sized_shuffles(spark, max(run.observed[name].get("row_count") or 0 for name in SOURCES)):
            _facts_and_marts(run, items, options, dates)
    return run


def _facts_and_marts(run: LayeredRun, items: DataFrame, options: DataFrame, dates: DataFrame) -> None:
    line_options = stage(gold.options_by_lineitem(options), "options_by_lineitem")
    lines = run.build(
        "fact_order_line",
        gold.fact_order_line(items, line_options),
        partial(checks.line_grain_gate, items, line_options),
        gold.line_measures(),
    )
    discard(line_options)

    def item_mart() -> None:
        mart = sales.item_sales(lines)
        run.build("item_sales", mart, partial(checks.item_sales_gate, lines))

    def restaurant_item_mart() -> None:
        mart = sales.restaurant_item_sales(lines)
        run.build("restaurant_item_sales", mart, partial(checks.restaurant_item_sales_gate, lines))

    def option_mart() -> None:
        mart = sales.option_sales(options)
        run.build("option_sales", mart, partial(checks.option_sales_gate, options))

    def order_marts() -> None:
        orders = gold.fact_order_of_written(lines)
        orders = run.build("fact_order", orders, partial(checks.order_grain_gate, lines), gold.order_measures())
        _together(
            partial(customer_marts, orders),
            partial(daily_mart, orders),
            partial(restaurant_daily_mart, orders),
        )

    def daily_mart(orders: DataFrame) -> None:
        mart = sales.daily_sales(orders, dates)
        run.build("daily_sales", mart, partial(checks.daily_sales_gate, orders, dates))

    def restaurant_daily_mart(orders: DataFrame) -> None:
        mart = sales.restaurant_daily_sales(orders, dates)
        gate = partial(checks.restaurant_daily_sales_gate, orders, dates)
        run.build("restaurant_daily_sales", mart, gate)

    def customer_marts(orders: DataFrame) -> None:
        daily = customers.customer_daily_clv(orders)
        gate = partial(checks.customer_daily_clv_gate, orders)
        daily = run.build("customer_daily_clv", daily, gate)
        snapshot = customers.customer_clv_snapshot(daily)
        gate = partial(checks.customer_clv_snapshot_gate, daily)
        snapshot = run.build("customer_clv_snapshot", snapshot, gate)
        rfm = customers.customer_rfm(snapshot)
        gate = partial(checks.customer_rfm_gate, snapshot)
        run.build("customer_rfm", rfm, gate)

    def line_marts() -> None:
        # One after the other: what each exchanges is as large as the lines and lies on the disks until it is done.
        item_mart()
        restaurant_item_mart()
        option_mart()

    _together(order_marts, line_marts)
