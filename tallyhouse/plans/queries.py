"""Every operator as a query over a folder of star-schema tables."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from datetime import UTC, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.measures import money_sum, rows
from tallyhouse.functions.names import normalize_column_names
from tallyhouse.operators import checks, customers, gold, profile, reports, sales, silver, trends
from tallyhouse.plans import layers as layered
from tallyhouse.plans.profiling import profile_run
from tallyhouse.session import configure, freed_exchanges
from tallyhouse.sources import catalog, csv_files, star_schema
from tallyhouse.sources.layers import land_raw, partition_filter, read_layer, write_layer
from tallyhouse.sources.scratch import scratch_path, stage

RUN_DATE, OTHER_DATE = "2026-05-27", "2026-06-04"
RUN_TIME = datetime(2026, 5, 27, 6, 0, tzinfo=UTC)

Query = Callable[[SparkSession, str], DataFrame]

# What the marts and their gates read of the facts and the cleaned options. Tables staged for them hold these columns.
MART_COLUMNS = {
    "fact_order_line": (
        *("order_id", "restaurant_id", "user_id", "item_category", "item_name", "item_price", "item_quantity"),
        *("gross_item_revenue", "option_revenue", "discount_amount", "net_line_revenue"),
        *("option_row_count", "has_options", "has_discount"),
    ),
    "fact_order": (
        *("order_id", "restaurant_id", "order_date", "user_id"),
        *("line_item_count", "distinct_line_item_count", "total_item_quantity"),
        *("gross_item_revenue", "option_revenue", "discount_amount", "net_order_revenue", "option_row_count"),
        *("is_loyalty", "has_options", "has_discount", "has_user_id", "all_line_keys_valid"),
    ),
    "options_clean": (
        *("order_id", "lineitem_id", "option_group_name", "option_name", "option_price", "option_quantity"),
        *("option_revenue", "is_discount", "discount_amount", "is_valid_option_key"),
    ),
}

# What orders are built from besides, where both facts are wanted.
ORDER_COLUMNS = (
    *("lineitem_id", "app_name", "creation_time_utc", "order_date", "printed_card_number", "currency"),
    *("is_loyalty", "has_user_id", "is_valid_order_item_key"),
)

# What several marts are built from, staged once where all marts are wanted.
SHARED = (*MART_COLUMNS, "options_by_lineitem", "customer_clv_snapshot")


class Frames:
    """Sources, layers and marts over one folder, each built when first asked for.

    ``shared`` names the datasets to stage, for queries that read them more than once; ``columns`` those of
    their columns that are read, where not all are.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        shared: Collection[str] = (),
        columns: Mapping[str, Sequence[str]] | None = None,
    ):
        self.spark, self.folder, self.shared = configure(spark), folder, frozenset(shared)
        self.columns = columns or {}

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        return stage(df.select(*self.columns.get(name, ["*"])), name) if name in self.shared else df

    @cached_property
    def raw_items(self) -> DataFrame:
        return star_schema.order_items(self.spark, self.folder)

    @cached_property
    def raw_options(self) -> DataFrame:
        return star_schema.order_item_options(self.spark, self.folder)

    @cached_property
    def raw_dates(self) -> DataFrame:
        return star_schema.date_dim(self.spark, self.folder)

    @property
    def sources(self) -> dict[str, DataFrame]:
        return {
            "order_items": self.raw_items,
            "order_item_options": self.raw_options,
            "date_dim": self.raw_dates,
        }

    @property
    def files(self) -> dict[str, DataFrame]:
        return {f"{name}.csv": df for name, df in self.sources.items()}

    @cached_property
    def items(self) -> DataFrame:
        return self._keep(silver.clean_order_items(self.raw_items), "order_items_clean")

    @cached_property
    def options(self) -> DataFrame:
        return self._keep(silver.clean_order_item_options(self.raw_options), "options_clean")

    @cached_property
    def dates(self) -> DataFrame:
        return silver.clean_date_dim(self.raw_dates)

    @cached_property
    def line_options(self) -> DataFrame:
        return self._keep(gold.options_by_lineitem(self.options), "options_by_lineitem")

    @cached_property
    def built_lines(self) -> DataFrame:
        return gold.fact_order_line(self.items, self.line_options)

    @cached_property
    def lines(self) -> DataFrame:
        return self._keep(self.built_lines, "fact_order_line")

    @cached_property
    def orders(self) -> DataFrame:
        # Lines that are not staged are partitioned by order as they are built; staged ones are combined as they are read.
        staged = "fact_order_line" in self.shared and {*ORDER_COLUMNS} <= {*self.lines.columns}
        orders = gold.fact_order_of_written(self.lines) if staged else gold.fact_order(self.built_lines)
        return self._keep(orders, "fact_order")

    # Marts with several distinct counts read their fact twice.

    def _written(self, df: DataFrame, name: str) -> DataFrame:
        return df if name in self.shared else stage(df.select(*MART_COLUMNS[name]), name)

    @cached_property
    def written_lines(self) -> DataFrame:
        return self._written(self.lines, "fact_order_line")

    @cached_property
    def written_orders(self) -> DataFrame:
        return self._written(self.orders, "fact_order")

    @cached_property
    def written_options(self) -> DataFrame:
        return self._written(self.options, "options_clean")

    @cached_property
    def cumulative(self) -> DataFrame:
        spend = customers.daily_customer_spend(customers.customer_orders(self.orders))
        return customers.customer_cumulative(spend)

    @cached_property
    def customer_daily_clv(self) -> DataFrame:
        return self._keep(customers.customer_daily_clv(self.orders), "customer_daily_clv")

    @cached_property
    def customer_clv_snapshot(self) -> DataFrame:
        # The snapshot uses running totals only, not the daily quartiles.
        running = self.customer_daily_clv if "customer_daily_clv" in self.shared else self.cumulative
        return self._keep(customers.customer_clv_snapshot(running), "customer_clv_snapshot")

    @cached_property
    def customer_rfm(self) -> DataFrame:
        return customers.customer_rfm(self.customer_clv_snapshot)

    @cached_property
    def daily_sales(self) -> DataFrame:
        return sales.daily_sales(self.written_orders, self.dates)

    @cached_property
    def restaurant_daily_sales(self) -> DataFrame:
        return sales.restaurant_daily_sales(self.written_orders, self.dates)

    @cached_property
    def item_sales(self) -> DataFrame:
        return sales.item_sales(self.written_lines)

    @cached_property
    def restaurant_item_sales(self) -> DataFrame:
        return sales.restaurant_item_sales(self.written_lines)

    @cached_property
    def option_sales(self) -> DataFrame:
        return sales.option_sales(self.written_options)

    def mart(self, name: str) -> DataFrame:
        return getattr(self, name)

    def staged_mart(self, name: str) -> DataFrame:
        return self.mart(name) if name in self.shared else stage(self.mart(name), name)

    def path(self, name: str) -> str:
        return scratch_path(self.spark, name)

    def reconcilable(self) -> dict[str, DataFrame]:
        marts = {name: self.staged_mart(name) for name in layered.MARTS if name != "customer_daily_clv"}
        facts = {"fact_order_line": self.lines, "fact_order": self.orders}
        return facts | marts | {"order_item_options_clean": self.options}


def _plain(build: Callable[[Frames], DataFrame]) -> Query:
    return lambda spark, folder: build(Frames(spark, folder))


def _shared(build: Callable[[Frames], DataFrame], *staged: str) -> Query:
    return lambda spark, folder: build(Frames(spark, folder, shared=staged))


def _for_marts(build: Callable[[Frames], DataFrame], *more: str) -> Query:
    """All marts from one staged table of each fact, and of what else several of them are built from."""
    columns = MART_COLUMNS | {"fact_order_line": (*MART_COLUMNS["fact_order_line"], *ORDER_COLUMNS)}
    return lambda spark, folder: build(Frames(spark, folder, shared=(*SHARED, *more), columns=columns))


# --- sources and sinks ---------------------------------------------------------


def _land_raw(f: Frames) -> DataFrame:
    base = f.path("raw")
    land_raw(f.raw_items, base, RUN_DATE)
    return read_layer(f.spark, base, RUN_DATE)


def _write_layer(f: Frames) -> DataFrame:
    """Two dates, the first written twice: each ends up with one full copy."""
    base, items = f.path("layer"), f.items
    for date in (RUN_DATE, OTHER_DATE, RUN_DATE):
        write_layer(items, base, date)
    return f.spark.read.parquet(base).groupBy("ingest_date").agg(
        rows("row_count"), money_sum("gross_item_revenue")
    )


def _read_layer(f: Frames) -> DataFrame:
    base = f.path("layer")
    for date in (RUN_DATE, OTHER_DATE):
        write_layer(f.options, base, date)
    return read_layer(f.spark, base, RUN_DATE)


def _partition_filter(f: Frames) -> DataFrame:
    base, mart = f.path("daily_sales"), stage(f.daily_sales, "daily_sales")
    for date in (RUN_DATE, OTHER_DATE):
        write_layer(mart, base, date)
    return partition_filter(f.spark.read.parquet(base), RUN_DATE)


def _csv_copy(f: Frames) -> str:
    """The sources as CSV files with shouting headers, as exports have them."""
    folder = f.path("csv")
    for name, df in f.files.items():
        upper = df.toDF(*[column.upper().replace("_", " ") for column in df.columns])
        with freed_exchanges(f.spark):
            upper.write.csv(f"{folder}/{name}", header=True, escape='"')
    return folder


def _read_csv_source(f: Frames) -> DataFrame:
    return csv_files.read_csv_source(f.spark, f"{_csv_copy(f)}/order_item_options.csv")


def _load_sources(f: Frames) -> DataFrame:
    loaded = csv_files.load_sources(f.spark, _csv_copy(f))
    return profile.union_all(
        [
            df.agg(rows("row_count")).select(
                F.lit(name).alias("file"), "row_count", F.lit(len(df.columns)).alias("column_count")
            )
            for name, df in loaded.items()
        ]
    )


def _write_report(f: Frames) -> DataFrame:
    summary = profile.validate_keys(f.spark, f.files)
    path = csv_files.write_report(summary, f.path("reports"), "key_validation", RUN_TIME)
    return f.spark.read.csv(path, header=True)


def _register(f: Frames, datasets: dict[str, DataFrame]) -> str:
    database = f"orders_{f.path('db').rsplit('-', 1)[1]}"
    root = f.path("tables")
    bases = {name: f"{root}/{name}" for name in datasets}
    for name, df in datasets.items():
        write_layer(df, bases[name], OTHER_DATE)
    catalog.register_tables(f.spark, database, bases, location=f"{root}/database")
    for name, df in datasets.items():
        write_layer(df, bases[name], RUN_DATE)
    catalog.add_date(f.spark, database, bases, RUN_DATE)
    return database


def _register_tables(f: Frames) -> DataFrame:
    """A report over registered tables, filtered to one date."""
    marts = {"item_sales": stage(f.item_sales, "item_sales")}
    database = _register(f, marts)
    return reports.report_on_tables(f.spark, database, "top_items", RUN_DATE)


def _show_tables(f: Frames) -> DataFrame:
    database = _register(f, {name: f.staged_mart(name) for name in layered.MARTS})
    return catalog.show_tables(f.spark, database)


def _normalize(f: Frames) -> DataFrame:
    shouting = f.raw_options.toDF(*[f" {c.upper().replace('_', ' ')} " for c in f.raw_options.columns])
    return normalize_column_names(shouting)


def _run_layers(f: Frames) -> DataFrame:
    run = layered.run_layers(f.spark, f.sources, f.path("run"), RUN_DATE)
    return profile.union_all(
        [
            df.agg(rows("row_count")).select(F.lit(name).alias("dataset"), "row_count")
            for name, df in run.layers.items()
        ]
    )


def _profile_run(f: Frames) -> DataFrame:
    """Load CSV sources, write the five reports, and list how many rows each has."""
    sources = csv_files.load_sources(f.spark, _csv_copy(f))
    paths = profile_run(f.spark, sources, f.path("reports"), RUN_TIME)
    return profile.union_all(
        [
            f.spark.read.csv(path, header=True)
            .agg(rows("row_count"))
            .select(F.lit(name).alias("report"), "row_count")
            for name, path in paths.items()
        ]
    )


# --- further metrics -------------------------------------------------------------


def _loyalty_days(f: Frames) -> DataFrame:
    """Customers per day from their bitmaps."""
    days = trends.loyalty_days(f.written_orders)
    return days.groupBy("is_member", "cohort_month", "order_date").agg(
        F.sum(F.bitmap_count("customers")).alias("customers"),
        F.sum("order_count").alias("order_count"),
        money_sum("net_revenue"),
    )


# --- gates ---------------------------------------------------------------------


def _row_count_gate(f: Frames) -> DataFrame:
    clean = {"order_items": f.items, "order_item_options": f.options, "date_dim": f.dates}
    return profile.union_all(
        [
            checks.row_count_gate(f"{name}_clean", stage(raw, name), stage(clean[name], f"{name}_clean"))
            for name, raw in f.sources.items()
        ]
    )


def _gate_report(f: Frames) -> DataFrame:
    marts = {name: f.staged_mart(name) for name in layered.MARTS}
    return profile.union_all(
        [
            checks.customer_daily_clv_gate(f.orders, marts["customer_daily_clv"]),
            checks.customer_clv_snapshot_gate(marts["customer_daily_clv"], marts["customer_clv_snapshot"]),
            checks.customer_rfm_gate(marts["customer_clv_snapshot"], marts["customer_rfm"]),
            checks.daily_sales_gate(f.orders, f.dates, marts["daily_sales"]),
            checks.restaurant_daily_sales_gate(f.orders, f.dates, marts["restaurant_daily_sales"]),
            checks.item_sales_gate(f.lines, marts["item_sales"]),
            checks.restaurant_item_sales_gate(f.lines, marts["restaurant_item_sales"]),
            checks.option_sales_gate(f.options, marts["option_sales"]),
        ]
    )


# --- profiling -----------------------------------------------------------------


def _per_file(build: Callable[[str, DataFrame], DataFrame]) -> Query:
    return _plain(lambda f: profile.union_all([build(file, df) for file, df in f.files.items()]))


def _numeric(f: Frames) -> DataFrame:
    columns = {
        profile.ITEMS: ("item_price", "item_quantity"),
        profile.OPTIONS: ("option_price", "option_quantity"),
    }
    return profile.union_all(
        [profile.check_numeric(file, f.files[file], c) for file, names in columns.items() for c in names]
    )


def _non_positive(f: Frames) -> DataFrame:
    items, options = f.files[profile.ITEMS], f.files[profile.OPTIONS]
    return profile.union_all(
        [
            profile.check_non_positive(profile.ITEMS, items, "item_price"),
            profile.check_non_positive(profile.ITEMS, items, "item_quantity"),
            profile.check_non_positive(profile.OPTIONS, options, "option_price", allow_negative=True),
            profile.check_non_positive(profile.OPTIONS, options, "option_quantity"),
        ]
    )


QUERIES: dict[str, Query] = {
    # sources and sinks
    "land_raw": _plain(_land_raw),
    "write_layer": _plain(_write_layer),
    "read_layer": _plain(_read_layer),
    "read_csv_source": _plain(_read_csv_source),
    "load_sources": _plain(_load_sources),
    "write_report": _plain(_write_report),
    "register_tables": _plain(_register_tables),
    "show_tables": _for_marts(_show_tables, "customer_daily_clv"),
    "partition_filter": _plain(_partition_filter),
    "normalize_column_names": _plain(_normalize),
    "run_layers": _plain(_run_layers),
    # cleaned layer
    "clean_order_items": _plain(lambda f: f.items),
    "order_items_quality": _plain(lambda f: silver.order_items_quality(f.items)),
    "clean_order_item_options": _plain(lambda f: f.options),
    "options_quality": _plain(lambda f: silver.options_quality(f.options)),
    "duplicate_option_keys": _plain(lambda f: silver.duplicate_option_keys(f.options)),
    "clean_date_dim": _plain(lambda f: f.dates),
    "date_dim_quality": _plain(lambda f: silver.date_dim_quality(f.dates)),
    "row_count_gate": _plain(_row_count_gate),
    # facts
    "options_by_lineitem": _plain(lambda f: f.line_options),
    "fact_order_line": _plain(lambda f: f.lines),
    "unmatched_option_lines": _plain(lambda f: gold.unmatched_option_lines(f.items, f.line_options)),
    "fact_order_line_totals": _plain(lambda f: gold.fact_order_line_totals(f.lines)),
    "line_grain_gate": _shared(
        lambda f: checks.line_grain_gate(f.items, f.line_options, f.lines),
        *("order_items_clean", "options_by_lineitem", "fact_order_line"),
    ),
    "fact_order": _plain(lambda f: f.orders),
    "fact_order_totals": _plain(lambda f: gold.fact_order_totals(f.orders)),
    "order_grain_gate": _shared(lambda f: checks.order_grain_gate(f.lines, f.orders), "fact_order"),
    # customer marts
    "customer_orders": _plain(lambda f: customers.customer_orders(f.orders)),
    "customer_orders_summary": _plain(
        lambda f: customers.customer_orders_summary(customers.customer_orders(f.orders))
    ),
    "daily_customer_spend": _plain(
        lambda f: customers.daily_customer_spend(customers.customer_orders(f.orders))
    ),
    "customer_cumulative": _plain(lambda f: f.cumulative),
    "customer_daily_clv": _plain(lambda f: f.customer_daily_clv),
    "customer_daily_clv_summary": _plain(
        lambda f: customers.customer_daily_clv_summary(f.customer_daily_clv)
    ),
    "customer_latest_row": _plain(lambda f: customers.customer_latest_row(f.cumulative)),
    "customer_clv_snapshot": _plain(lambda f: f.customer_clv_snapshot),
    "clv_snapshot_summary": _plain(
        lambda f: customers.clv_snapshot_summary(f.customer_clv_snapshot)
    ),
    "clv_tier_counts": _plain(lambda f: customers.clv_tier_counts(f.customer_clv_snapshot)),
    "rfm_as_of_date": _plain(lambda f: customers.rfm_as_of_date(f.customer_clv_snapshot)),
    "rfm_base": _plain(lambda f: customers.rfm_base(f.customer_clv_snapshot)),
    "rfm_scores": _plain(lambda f: customers.rfm_scores(f.customer_clv_snapshot)),
    "customer_rfm": _plain(lambda f: f.customer_rfm),
    "rfm_summary": _plain(lambda f: customers.rfm_summary(f.customer_rfm)),
    "rfm_segment_counts": _plain(lambda f: customers.rfm_segment_counts(f.customer_rfm)),
    # sales marts
    "daily_sales_base": _plain(lambda f: sales.daily_sales_base(f.written_orders)),
    "daily_sales": _plain(lambda f: f.daily_sales),
    "date_coverage": _plain(lambda f: sales.date_coverage(sales.daily_sales_base(f.written_orders), f.dates)),
    "daily_sales_summary": _plain(lambda f: sales.daily_sales_summary(f.daily_sales)),
    "restaurant_daily_sales_base": _plain(lambda f: sales.restaurant_daily_sales_base(f.written_orders)),
    "restaurant_daily_sales": _plain(lambda f: f.restaurant_daily_sales),
    "restaurant_daily_sales_summary": _plain(
        lambda f: sales.restaurant_daily_sales_summary(f.restaurant_daily_sales)
    ),
    "item_sales": _plain(lambda f: f.item_sales),
    "item_sales_summary": _plain(lambda f: sales.item_sales_summary(f.item_sales)),
    "top_item": _plain(lambda f: sales.top_item(f.item_sales)),
    "restaurant_item_sales": _plain(lambda f: f.restaurant_item_sales),
    "restaurant_item_sales_summary": _plain(
        lambda f: sales.restaurant_item_sales_summary(f.restaurant_item_sales)
    ),
    "top_restaurant_item": _plain(lambda f: sales.top_restaurant_item(f.restaurant_item_sales)),
    "option_sales": _plain(lambda f: f.option_sales),
    "option_sales_summary": _plain(lambda f: sales.option_sales_summary(f.option_sales)),
    "top_option_by_revenue": _plain(lambda f: sales.top_option_by_revenue(f.option_sales)),
    "top_option_by_quantity": _plain(lambda f: sales.top_option_by_quantity(f.option_sales)),
    # further metrics
    "sales_trends": _plain(lambda f: trends.sales_trends(f.lines, f.dates)),
    "churn_risk": _plain(lambda f: trends.churn_risk(f.written_orders)),
    "location_ranking": _plain(lambda f: trends.location_ranking(f.orders)),
    "loyalty_days": _plain(_loyalty_days),
    "loyalty_cohorts": _plain(lambda f: trends.loyalty_cohorts(trends.loyalty_days(f.written_orders))),
    "discount_effectiveness": _plain(lambda f: trends.discount_effectiveness(f.lines)),
    # reports
    **{
        name: _plain(lambda f, name=name, mart=spec.mart: reports.report(name, f.mart(mart)))
        for name, spec in reports.REPORTS.items()
    },
    # gates and reconciliation
    "gate_report": _for_marts(_gate_report, "customer_daily_clv"),
    "reconcile_marts": _for_marts(lambda f: checks.reconcile_marts(f.reconcilable())),
    "option_revenue_gap": _plain(lambda f: checks.option_revenue_gap(f.items, f.line_options)),
    # profiling
    "profile_summary": _per_file(profile.profile_summary),
    "profile_columns": _per_file(profile.profile_columns),
    "validate_key": _plain(lambda f: profile.validate_keys(f.spark, f.files)),
    "check_numeric": _plain(_numeric),
    "check_non_positive": _plain(_non_positive),
    "relationship_options_items": _plain(
        lambda f: profile.relationship_options_items(f.raw_options, f.raw_items)
    ),
    "relationship_orders_dates": _plain(
        lambda f: profile.relationship_orders_dates(f.raw_items, f.raw_dates)
    ),
    "check_missing": _plain(lambda f: profile.check_missing(profile.ITEMS, f.raw_items)),
    "check_timestamp": _plain(lambda f: profile.check_timestamp(profile.ITEMS, f.raw_items)),
    "order_date_range": _plain(lambda f: profile.order_date_range(profile.ITEMS, f.raw_items)),
    "currency_distribution": _plain(
        lambda f: profile.currency_distribution(profile.ITEMS, f.raw_items)
    ),
    "currency_values": _plain(lambda f: profile.value_distribution(f.raw_items, "currency")),
    "loyalty_values": _plain(lambda f: profile.value_distribution(f.raw_items, "is_loyalty")),
    "loyalty_distribution": _plain(
        lambda f: profile.loyalty_distribution(profile.ITEMS, f.raw_items)
    ),
    "discount_option_rows": _plain(
        lambda f: profile.discount_option_rows(profile.OPTIONS, f.raw_options)
    ),
    "check_date_key": _plain(lambda f: profile.check_date_key(profile.DATES, f.raw_dates)),
    "data_quality_report": _plain(lambda f: profile.data_quality_report(f.files)),
    "business_snapshot": _plain(lambda f: profile.business_snapshot(f.raw_items, f.raw_options)),
    "profile_run": _plain(_profile_run),
}
