"""SQL equivalents of the queries, for DuckDB over the same source tables.

Each oracle is one statement: the named steps it needs as common table
expressions, then the final select. Ratios are computed in whole cents, as DuckDB
divides decimals in floating point.
"""

from __future__ import annotations

import re

from tallyhouse.operators.trends import TREND_COLUMNS, TREND_LEVELS

# --- exact ratios --------------------------------------------------------------


def _cents(value: str) -> str:
    return f"cast(({value}) * 100 as hugeint)"


def _half_up(numerator: str, denominator: str) -> str:
    """Integer quotient rounded half away from zero; null for a zero denominator."""
    return (
        f"(cast(sign({numerator}) as int) * ((2 * abs({numerator}) + {denominator}) // "
        f"(2 * {denominator})))"
    )


def _scaled(integer: str, digits: int, kind: str) -> str:
    unit = f"0.{'0' * (digits - 1)}1"
    return f"cast(cast({integer} as decimal(18,0)) * {unit} as {kind})"


def money_per(money: str, count: str) -> str:
    return _scaled(_half_up(_cents(money), f"cast({count} as hugeint)"), 2, "decimal(14,2)")


def count_per(count: str, per: str) -> str:
    number = f"(cast({count} as hugeint) * 100)"
    return _scaled(_half_up(number, f"cast({per} as hugeint)"), 2, "decimal(14,2)")


def rate(part: str, whole: str) -> str:
    number = f"(cast({part} as hugeint) * 10000)"
    return _scaled(_half_up(number, f"cast({whole} as hugeint)"), 4, "decimal(14,4)")


def pct(part: str, whole: str, digits: int) -> str:
    number = f"(cast({part} as hugeint) * {100 * 10**digits})"
    quotient = _half_up(number, f"cast({whole} as hugeint)")
    return _scaled(quotient, digits, f"decimal({digits + 5},{digits})")


def mean_money(price: str) -> str:
    """Mean at six decimals first, then at two, as Spark's decimal average goes."""
    micros = f"(cast(sum({price}) * 100 as hugeint) * 10000)"
    six = _half_up(micros, f"cast(count({price}) as hugeint)")
    return _scaled(_half_up(six, "cast(10000 as hugeint)"), 2, "decimal(14,2)")


# --- steps ---------------------------------------------------------------------

LINE_ID = "concat_ws('-', cast(l_linenumber as varchar), cast(l_partkey as varchar), cast(l_suppkey as varchar))"

STEPS: dict[str, str] = {}

STEPS["raw_items"] = f"""
select 'demo' as app_name,
       'R' || cast(l_orderkey % 28 as varchar) as restaurant_id,
       cast(o_orderdate as timestamp) as creation_time_utc,
       cast(l_orderkey as varchar) as order_id,
       case when l_orderkey % 11 <> 0 then cast(o_custkey as varchar) end as user_id,
       case when l_orderkey % 3 = 0 then 'card-' || cast(o_custkey as varchar) end as printed_card_number,
       case when l_orderkey % 13 <> 0 then c_mktsegment = 'BUILDING' end as is_loyalty,
       case when l_orderkey % 17 = 0 then 'EUR' else 'USD' end as currency,
       {LINE_ID} as lineitem_id,
       p_type as item_category,
       p_name as item_name,
       cast(p_retailprice as decimal(12,2)) as item_price,
       cast(l_quantity as integer) as item_quantity
from lineitem
left join orders on l_orderkey = o_orderkey
left join part on l_partkey = p_partkey
left join customer on o_custkey = c_custkey
"""

STEPS["add_ons"] = f"""
select cast(l_orderkey as varchar) as order_id,
       case when l_orderkey % 97 = 0 then 'x' || {LINE_ID} else {LINE_ID} end as lineitem_id,
       'Add-on ' || l_returnflag as option_group_name,
       'Tier ' || cast(cast(round(l_tax * 100) as integer) as varchar) as option_name,
       cast(cast(round(l_tax * 100) as integer) as decimal(12,2)) as option_price,
       cast(1 + l_linenumber % 3 as integer) as option_quantity,
       l_linenumber = 7 and l_partkey % 10 = 0 as repeated
from lineitem
where l_tax > 0
"""

STEPS["raw_options"] = f"""
select * exclude (repeated) from add_ons
union all
select * exclude (repeated) from add_ons where repeated
union all
select cast(l_orderkey as varchar), {LINE_ID}, 'Discount',
       'Off ' || cast(cast(round(l_discount * 100) as integer) as varchar),
       cast(-cast(round(l_discount * 100) as integer) as decimal(12,2)), 1
from lineitem
where l_discount > 0.055
"""

STEPS["raw_dates"] = """
select strftime(d, '%d-%m-%Y') as date_key,
       cast(year(d) as integer) as year,
       cast(month(d) as integer) as month,
       cast(weekofyear(d) as integer) as week,
       dayname(d) as day_of_week,
       dayofweek(d) in (0, 6) as is_weekend,
       month(d) = 12 and day(d) = 25 as is_holiday,
       case when month(d) = 12 and day(d) = 25 then 'Christmas Day' end as holiday_name
from (select distinct cast(o_orderdate as date) as d from orders) where d <> last_day(d)
"""

STEPS["items"] = """
select *,
       cast(creation_time_utc as date) as order_date,
       cast(item_price * item_quantity as decimal(14,2)) as gross_item_revenue,
       order_id is not null and lineitem_id is not null as is_valid_order_item_key,
       user_id is not null as has_user_id
from raw_items
"""

STEPS["options"] = """
select *,
       cast(option_price * option_quantity as decimal(14,2)) as option_revenue,
       option_price < 0 as is_discount,
       case when option_price < 0 then abs(cast(option_price * option_quantity as decimal(14,2)))
            else cast(0 as decimal(14,2)) end as discount_amount,
       order_id is not null and lineitem_id is not null as is_valid_option_key,
       concat_ws('|', order_id, lineitem_id, option_group_name, option_name) as candidate_option_key
from raw_options
"""

STEPS["dates"] = """
select cast(strptime(date_key, '%d-%m-%Y') as date) as date_key,
       year, month, week, day_of_week, is_weekend, is_holiday, holiday_name,
       cast(day(strptime(date_key, '%d-%m-%Y')) as integer) as day_of_month,
       cast(quarter(strptime(date_key, '%d-%m-%Y')) as integer) as quarter,
       monthname(strptime(date_key, '%d-%m-%Y')) as month_name,
       true as is_valid_date_key
from raw_dates
"""

STEPS["line_options"] = """
select order_id, lineitem_id,
       cast(sum(option_revenue) as decimal(14,2)) as option_revenue,
       cast(sum(discount_amount) as decimal(14,2)) as discount_amount,
       count(*) as option_row_count,
       true as has_options,
       bool_or(is_discount) as has_discount
from options
group by order_id, lineitem_id
"""

STEPS["lines"] = """
select i.order_id, i.lineitem_id, app_name, restaurant_id, creation_time_utc, order_date, user_id,
       printed_card_number, is_loyalty, currency, item_category, item_name, item_price,
       item_quantity, gross_item_revenue,
       coalesce(o.option_revenue, 0) as option_revenue,
       coalesce(o.discount_amount, 0) as discount_amount,
       coalesce(o.option_row_count, 0) as option_row_count,
       coalesce(o.has_options, false) as has_options,
       coalesce(o.has_discount, false) as has_discount,
       is_valid_order_item_key, has_user_id,
       cast(gross_item_revenue + coalesce(o.option_revenue, 0) as decimal(14,2)) as net_line_revenue
from items i
left join line_options o on i.order_id = o.order_id and i.lineitem_id = o.lineitem_id
"""

STEPS["unmatched"] = """
select * from line_options o
where not exists (
    select 1 from items i where i.order_id = o.order_id and i.lineitem_id = o.lineitem_id
)
"""


def _earliest(column: str) -> str:
    order = f"row(creation_time_utc is null, creation_time_utc, lineitem_id is null, lineitem_id, {column})"
    return f"arg_min({column}, {order}) filter (where {column} is not null) as {column}"


def _money_sums(*columns: str) -> str:
    return ",\n       ".join(
        f"cast(sum({c.split(' as ')[0]}) as decimal(14,2)) as {c.split(' as ')[-1]}" for c in columns
    )


STEPS["fact_orders"] = f"""
select order_id,
       {_earliest("app_name")},
       {_earliest("restaurant_id")},
       min(creation_time_utc) as order_created_at_utc,
       {_earliest("order_date")},
       {_earliest("user_id")},
       {_earliest("printed_card_number")},
       {_earliest("currency")},
       count(*) as line_item_count,
       count(distinct lineitem_id) as distinct_line_item_count,
       cast(sum(item_quantity) as bigint) as total_item_quantity,
       {_money_sums("gross_item_revenue", "option_revenue", "discount_amount", "net_line_revenue as net_order_revenue")},
       cast(sum(option_row_count) as bigint) as option_row_count,
       bool_or(is_loyalty) as is_loyalty,
       bool_or(has_options) as has_options,
       bool_or(has_discount) as has_discount,
       bool_or(has_user_id) as has_user_id,
       bool_and(is_valid_order_item_key) as all_line_keys_valid
from lines
group by order_id
"""

STEPS["cust_orders"] = """
select user_id, order_id, order_date, restaurant_id, is_loyalty, gross_item_revenue,
       option_revenue, discount_amount, net_order_revenue
from fact_orders
where user_id is not null
"""

STEPS["spend"] = f"""
select user_id, order_date,
       count(distinct order_id) as daily_order_count,
       count(distinct restaurant_id) as daily_restaurant_count,
       {_money_sums("gross_item_revenue as daily_gross_item_revenue", "option_revenue as daily_option_revenue", "discount_amount as daily_discount_amount", "net_order_revenue as daily_net_revenue")},
       bool_or(is_loyalty) as is_loyalty_customer_day
from cust_orders
group by user_id, order_date
"""

STEPS["cumulative"] = """
select *, cast(date_diff('day', first_order_date, latest_order_date) + 1 as integer) as customer_lifetime_days
from (
    select *,
           cast(sum(daily_order_count) over so_far as bigint) as cumulative_order_count,
           cast(sum(daily_net_revenue) over so_far as decimal(14,2)) as cumulative_net_revenue,
           min(order_date) over (partition by user_id) as first_order_date,
           max(order_date) over (partition by user_id) as latest_order_date
    from spend
    window so_far as (partition by user_id order by order_date
                      rows between unbounded preceding and current row)
)
"""

TIER = "case clv_quartile when 4 then 'high' when 3 then 'medium_high' when 2 then 'medium_low' else 'low' end as clv_tier"

STEPS["daily_clv"] = f"""
select *, {TIER}
from (
    select *, cast(ntile(4) over (
        order by cumulative_net_revenue nulls first, order_date nulls first, user_id nulls first
    ) as integer) as clv_quartile
    from cumulative
)
"""

STEPS["latest_row"] = """
select user_id, first_order_date, latest_order_date, customer_lifetime_days,
       cumulative_order_count as lifetime_order_count,
       cumulative_net_revenue as lifetime_net_revenue,
       daily_order_count as latest_daily_order_count,
       daily_net_revenue as latest_daily_net_revenue,
       daily_restaurant_count as latest_daily_restaurant_count,
       is_loyalty_customer_day as latest_is_loyalty_customer_day
from cumulative
qualify row_number() over (
    partition by user_id order by order_date desc nulls last, cumulative_net_revenue desc nulls last
) = 1
"""

STEPS["snapshot"] = f"""
select *, {TIER}
from (
    select *, cast(ntile(4) over (
        order by lifetime_net_revenue nulls first, user_id nulls first
    ) as integer) as clv_quartile
    from latest_row
)
"""

STEPS["as_of"] = "select max(latest_order_date) as rfm_as_of_date from snapshot"

STEPS["rfm_rows"] = """
select user_id, first_order_date, latest_order_date, customer_lifetime_days, lifetime_order_count,
       lifetime_net_revenue, clv_quartile, clv_tier,
       cast(date_diff('day', latest_order_date, (select rfm_as_of_date from as_of)) as integer) as recency_days
from snapshot
"""

STEPS["scores"] = """
select *, cast(recency_score + frequency_score + monetary_score as double) as rfm_score,
       recency_score + frequency_score + monetary_score as rfm_total_score,
       cast(recency_score as varchar) || cast(frequency_score as varchar) || cast(monetary_score as varchar) as rfm_code
from (
    select *,
           cast(5 - ntile(4) over (order by recency_days nulls first, user_id) as integer) as recency_score,
           cast(ntile(4) over (order by lifetime_order_count nulls first, user_id) as integer) as frequency_score,
           cast(ntile(4) over (order by lifetime_net_revenue nulls first, user_id) as integer) as monetary_score
    from rfm_rows
)
"""

STEPS["rfm"] = """
select *,
       case when recency_score >= 4 and frequency_score >= 4 and monetary_score >= 4 then 'champions'
            when recency_score >= 3 and frequency_score >= 3 and monetary_score >= 3 then 'loyal_high_value'
            when recency_score >= 4 and frequency_score <= 2 then 'new_or_promising'
            when recency_score <= 2 and frequency_score >= 3 and monetary_score >= 3 then 'at_risk_high_value'
            when recency_score <= 2 and frequency_score <= 2 then 'hibernating'
            else 'needs_attention' end as rfm_segment,
       (select rfm_as_of_date from as_of) as rfm_as_of_date
from scores
"""


def _daily(keys: str, restaurants: bool) -> str:
    restaurant_count = "count(distinct restaurant_id) as restaurant_count," if restaurants else ""
    return f"""
select *,
       {money_per("net_revenue", "order_count")} as avg_order_value,
       {count_per("total_item_quantity", "order_count")} as avg_items_per_order,
       {rate("orders_with_options", "order_count")} as option_attach_rate,
       {rate("orders_with_user_id", "order_count")} as customer_identification_rate
from (
    select {keys},
           count(distinct order_id) as order_count,
           count(distinct user_id) as customer_count,
           {restaurant_count}
           cast(sum(line_item_count) as bigint) as line_item_count,
           cast(sum(distinct_line_item_count) as bigint) as distinct_line_item_count,
           cast(sum(total_item_quantity) as bigint) as total_item_quantity,
           {_money_sums("gross_item_revenue", "option_revenue", "discount_amount", "net_order_revenue as net_revenue")},
           cast(sum(option_row_count) as bigint) as option_row_count,
           count(*) filter (where has_options) as orders_with_options,
           count(*) filter (where has_discount) as orders_with_discount,
           count(*) filter (where has_user_id) as orders_with_user_id,
           count(*) filter (where not all_line_keys_valid) as orders_with_invalid_line_keys
    from fact_orders
    group by {keys}
)
"""


STEPS["daily_base"] = _daily("order_date", restaurants=True)
STEPS["restaurant_daily_base"] = _daily("restaurant_id, order_date", restaurants=False)


def _calendar(base: str) -> str:
    return f"""
select s.*,
       coalesce(d.year, cast(year(order_date) as integer)) as year,
       coalesce(d.month, cast(month(order_date) as integer)) as month,
       coalesce(d.month_name, monthname(order_date)) as month_name,
       coalesce(d.week, cast(weekofyear(order_date) as integer)) as week,
       coalesce(d.day_of_week, dayname(order_date)) as day_of_week,
       coalesce(d.day_of_month, cast(day(order_date) as integer)) as day_of_month,
       coalesce(d.quarter, cast(quarter(order_date) as integer)) as quarter,
       coalesce(d.is_weekend, dayofweek(order_date) in (0, 6)) as is_weekend,
       coalesce(d.is_holiday, false) as is_holiday,
       d.holiday_name as holiday_name,
       d.date_key is null as used_derived_date_attributes
from {base} s
left join dates d on s.order_date = d.date_key
"""


STEPS["daily"] = _calendar("daily_base")
STEPS["restaurant_daily"] = _calendar("restaurant_daily_base")


def _item_mart(keys: str, restaurants: bool) -> str:
    restaurant_count = "count(distinct restaurant_id) as restaurant_count," if restaurants else ""
    return f"""
select *,
       {money_per("net_revenue", "line_item_count")} as avg_net_revenue_per_line,
       {money_per("net_revenue", "total_item_quantity")} as avg_net_revenue_per_unit,
       {rate("line_items_with_options", "line_item_count")} as option_attach_rate,
       {rate("line_items_with_discount", "line_item_count")} as discount_attach_rate
from (
    select {keys},
           count(distinct order_id) as order_count,
           {restaurant_count}
           count(*) as line_item_count,
           cast(sum(item_quantity) as bigint) as total_item_quantity,
           {mean_money("item_price")} as avg_item_price,
           cast(min(item_price) as decimal(14,2)) as min_item_price,
           cast(max(item_price) as decimal(14,2)) as max_item_price,
           {_money_sums("gross_item_revenue", "option_revenue", "discount_amount", "net_line_revenue as net_revenue")},
           cast(sum(option_row_count) as bigint) as option_row_count,
           count(*) filter (where has_options) as line_items_with_options,
           count(*) filter (where has_discount) as line_items_with_discount,
           count(distinct user_id) as customer_count
    from lines
    group by {keys}
)
"""


STEPS["item_mart"] = _item_mart("item_category, item_name", restaurants=True)
STEPS["restaurant_item_mart"] = _item_mart("restaurant_id, item_category, item_name", restaurants=False)

STEPS["option_mart"] = f"""
select *,
       {money_per("option_revenue", "option_row_count")} as avg_option_revenue_per_row,
       {money_per("option_revenue", "total_option_quantity")} as avg_option_revenue_per_unit,
       {rate("discount_row_count", "option_row_count")} as discount_row_rate,
       {rate("valid_option_key_row_count", "option_row_count")} as valid_option_key_rate
from (
    select option_group_name, option_name,
           count(*) as option_row_count,
           count(distinct order_id) as order_count,
           count(distinct concat_ws('||', order_id, lineitem_id)) as line_item_count,
           cast(sum(option_quantity) as bigint) as total_option_quantity,
           {mean_money("option_price")} as avg_option_price,
           cast(min(option_price) as decimal(14,2)) as min_option_price,
           cast(max(option_price) as decimal(14,2)) as max_option_price,
           {_money_sums("option_revenue", "discount_amount")},
           count(*) filter (where is_discount) as discount_row_count,
           count(*) filter (where is_valid_option_key) as valid_option_key_row_count
    from options
    group by option_group_name, option_name
)
"""

_STEP_NAME = re.compile(r"\b(?:from|join)\s+(\w+)")


def _needed(sql: str, seen: list[str]) -> None:
    for name in _STEP_NAME.findall(sql):
        if name in STEPS and name not in seen:
            _needed(STEPS[name], seen)
            seen.append(name)


def statement(final: str) -> str:
    """The final select behind the steps it reads, directly or not."""
    needed: list[str] = []
    _needed(final, needed)
    if not needed:
        return final.strip()
    steps = ",\n".join(f"{name} as ({STEPS[name].strip()})" for name in needed)
    return f"with {steps}\n{final.strip()}"



# --- final selects -------------------------------------------------------------

FINALS: dict[str, str] = {}

# sources and sinks
FINALS["land_raw"] = "select * from raw_items"
FINALS["write_layer"] = """
select ingest_date, count(*) as row_count,
       cast(sum(gross_item_revenue) as decimal(14,2)) as gross_item_revenue
from items, (values ('2026-05-27'), ('2026-06-04')) as runs(ingest_date)
group by ingest_date
"""
FINALS["read_layer"] = "select * from options"
FINALS["read_csv_source"] = """
select order_id, lineitem_id, option_group_name, option_name,
       cast(option_price as varchar) as option_price,
       cast(option_quantity as varchar) as option_quantity
from raw_options
"""
FINALS["load_sources"] = """
select 'order_items.csv' as file, count(*) as row_count, 13 as column_count from raw_items
union all
select 'order_item_options.csv', count(*), 6 from raw_options
union all
select 'date_dim.csv', count(*), 8 from raw_dates
"""
FINALS["partition_filter"] = "select *, '2026-05-27' as ingest_date from daily"
FINALS["normalize_column_names"] = "select * from raw_options"

_RUN_COUNTS = {
    "order_items": "raw_items",
    "order_item_options": "raw_options",
    "date_dim": "raw_dates",
    "order_items_clean": "items",
    "order_item_options_clean": "options",
    "date_dim_clean": "dates",
    "fact_order_line": "lines",
    "fact_order": "fact_orders",
    "customer_daily_clv": "daily_clv",
    "customer_clv_snapshot": "snapshot",
    "customer_rfm": "rfm",
    "daily_sales": "daily",
    "restaurant_daily_sales": "restaurant_daily",
    "item_sales": "item_mart",
    "restaurant_item_sales": "restaurant_item_mart",
    "option_sales": "option_mart",
}
FINALS["run_layers"] = "\nunion all\n".join(
    f"select '{dataset}' as dataset, count(*) as row_count from {step}"
    for dataset, step in _RUN_COUNTS.items()
)

# cleaned layer
FINALS["clean_order_items"] = "select * from items"
FINALS["order_items_quality"] = """
select count(*) as row_count,
       count(*) filter (where not is_valid_order_item_key) as invalid_key_count,
       count(*) filter (where not has_user_id) as missing_user_id_count,
       count(*) filter (where creation_time_utc is null) as invalid_timestamp_count
from items
"""
FINALS["clean_order_item_options"] = "select * from options"
FINALS["options_quality"] = """
select count(*) as row_count,
       count(*) filter (where not is_valid_option_key) as invalid_key_count,
       count(*) filter (where is_discount) as discount_row_count,
       count(*) filter (where option_price is null) as null_option_price_count,
       count(*) filter (where option_quantity is null) as null_option_quantity_count
from options
"""
FINALS["duplicate_option_keys"] = """
select count(*) as duplicate_key_groups, cast(coalesce(sum(copies - 1), 0) as bigint) as duplicate_key_rows
from (
    select count(*) as copies from options
    group by order_id, lineitem_id, option_group_name, option_name
    having count(*) > 1
)
"""
FINALS["clean_date_dim"] = "select * from dates"
FINALS["date_dim_quality"] = """
select cast(sum(copies) as bigint) as row_count,
       cast(coalesce(sum(copies) filter (where date_key is null), 0) as bigint) as invalid_date_key_count,
       count(*) filter (where date_key is not null and copies > 1) as duplicate_date_key_groups
from (select date_key, count(*) as copies from dates group by date_key)
"""


def _gate(dataset: str, check: str, expected: str, actual: str, ok: str = "=", severity: str = "error") -> str:
    comparison = "actual >= expected" if ok == ">=" else "actual is not distinct from expected"
    return f"""
select '{dataset}' as dataset, '{check}' as check_name, '{severity}' as severity,
       expected, actual, coalesce({comparison}, false) as ok
from (select cast(({expected}) as decimal(28,2)) as expected, cast(({actual}) as decimal(28,2)) as actual)
"""


def _gates(*rows: str) -> str:
    return "\nunion all\n".join(row.strip() for row in rows)


def _count(step: str) -> str:
    return f"select count(*) from {step}"


def _sum(column: str, step: str) -> str:
    return f"select sum({column}) from {step}"


FINALS["row_count_gate"] = _gates(
    *[
        _gate(f"{name}_clean", "row count preserved", _count(raw), _count(clean))
        for name, raw, clean in (
            ("order_items", "raw_items", "items"),
            ("order_item_options", "raw_options", "options"),
            ("date_dim", "raw_dates", "dates"),
        )
    ]
)

# facts
FINALS["options_by_lineitem"] = "select * from line_options"
FINALS["fact_order_line"] = "select * from lines"
FINALS["unmatched_option_lines"] = "select * from unmatched"
FINALS["fact_order_line_totals"] = f"""
select count(*) as line_count,
       count(*) filter (where has_options) as lines_with_options,
       count(*) filter (where has_discount) as lines_with_discount,
       {_money_sums("gross_item_revenue as total_gross_item_revenue", "option_revenue as total_option_revenue", "discount_amount as total_discount_amount", "net_line_revenue as total_net_line_revenue")}
from lines
"""
FINALS["line_grain_gate"] = _gates(
    _gate("fact_order_line", "row count preserved", _count("items"), _count("lines")),
    _gate(
        "fact_order_line",
        "option revenue attached once",
        "select (select sum(option_revenue) from line_options) - coalesce((select sum(option_revenue) from unmatched), 0)",
        _sum("option_revenue", "lines"),
        severity="warn",
    ),
)
FINALS["fact_order"] = "select * from fact_orders"
FINALS["fact_order_totals"] = f"""
select count(*) as order_count,
       count(*) filter (where has_user_id) as orders_with_user_id,
       count(*) filter (where has_options) as orders_with_options,
       count(*) filter (where has_discount) as orders_with_discount,
       count(*) filter (where not all_line_keys_valid) as orders_with_invalid_line_keys,
       {_money_sums("gross_item_revenue as total_gross_item_revenue", "option_revenue as total_option_revenue", "discount_amount as total_discount_amount", "net_order_revenue as total_net_order_revenue")}
from fact_orders
"""


def _distinct(columns: str, step: str) -> str:
    return f"select count(*) from (select distinct {columns} from {step})"


def _not_empty(dataset: str, step: str, side: str = "target") -> str:
    return _gate(dataset, f"{side} is not empty", "1", _count(step), ok=">=")


def _unique(dataset: str, columns: str, step: str) -> str:
    return _gate(dataset, "grain is unique", _count(step), _distinct(columns, step))


FINALS["order_grain_gate"] = _gates(
    _not_empty("fact_order", "fact_orders"), _unique("fact_order", "order_id", "fact_orders")
)

# customer marts
FINALS["customer_orders"] = "select * from cust_orders"
FINALS["customer_orders_summary"] = f"""
select count(*) as order_count, {_money_sums("net_order_revenue as total_net_order_revenue")} from cust_orders
"""
FINALS["daily_customer_spend"] = "select * from spend"
FINALS["customer_cumulative"] = "select * from cumulative"
FINALS["customer_daily_clv"] = "select * from daily_clv"
FINALS["customer_daily_clv_summary"] = f"""
select count(*) as row_count, count(distinct user_id) as distinct_customer_count,
       {_money_sums("daily_net_revenue as total_daily_net_revenue")},
       max(cumulative_net_revenue) as max_cumulative_net_revenue
from daily_clv
"""
FINALS["customer_latest_row"] = "select * from latest_row"
FINALS["customer_clv_snapshot"] = "select * from snapshot"
FINALS["clv_snapshot_summary"] = f"""
select count(*) as row_count, count(distinct user_id) as distinct_customer_count,
       {_money_sums("lifetime_net_revenue as total_lifetime_net_revenue")},
       max(lifetime_net_revenue) as max_lifetime_net_revenue
from snapshot
"""


def _label_counts(column: str, labels: tuple[str, ...], step: str) -> str:
    values = ", ".join(f"('{label}')" for label in labels)
    return f"""
select labels.label as {column}, count(rows.label) as customer_count
from (values {values}) as labels(label)
left join (select {column} as label from {step}) as rows on rows.label = labels.label
group by labels.label
"""


FINALS["clv_tier_counts"] = _label_counts(
    "clv_tier", ("low", "medium_low", "medium_high", "high"), "snapshot"
)
FINALS["rfm_as_of_date"] = "select rfm_as_of_date from as_of"
FINALS["rfm_base"] = "select * from rfm_rows"
FINALS["rfm_scores"] = "select * from scores"
FINALS["customer_rfm"] = "select * from rfm"
FINALS["rfm_summary"] = f"""
select count(*) as row_count, count(distinct user_id) as distinct_customer_count,
       {_money_sums("lifetime_net_revenue as total_lifetime_net_revenue")}
from rfm
"""
FINALS["rfm_segment_counts"] = _label_counts(
    "rfm_segment",
    (
        "champions",
        "loyal_high_value",
        "new_or_promising",
        "at_risk_high_value",
        "needs_attention",
        "hibernating",
    ),
    "rfm",
)

# sales marts
FINALS["daily_sales_base"] = "select * from daily_base"
FINALS["daily_sales"] = "select * from daily"
FINALS["date_coverage"] = """
select min(order_date) as min_order_date, max(order_date) as max_order_date,
       (select min(date_key) from dates) as min_date_key,
       (select max(date_key) from dates) as max_date_key,
       count(*) filter (where used_derived_date_attributes) as unmatched_date_count
from daily
"""


def _daily_summary(step: str, maximum: str, extra: str = "") -> str:
    return f"""
select count(*) as row_count, {extra}
       cast(sum(order_count) as bigint) as total_order_count,
       {_money_sums("net_revenue as total_net_revenue")},
       max(net_revenue) as {maximum},
       min(order_date) as min_order_date, max(order_date) as max_order_date,
       count(*) filter (where used_derived_date_attributes) as unmatched_date_count
from {step}
"""


FINALS["daily_sales_summary"] = _daily_summary("daily", "max_daily_net_revenue")
FINALS["restaurant_daily_sales_base"] = "select * from restaurant_daily_base"
FINALS["restaurant_daily_sales"] = "select * from restaurant_daily"
FINALS["restaurant_daily_sales_summary"] = _daily_summary(
    "restaurant_daily",
    "max_restaurant_daily_net_revenue",
    "count(distinct restaurant_id) as restaurant_count,",
)


def _item_summary(step: str, keys: str, extra: str = "") -> str:
    return f"""
select count(*) as row_count,
       ({_distinct(keys, step)}) as distinct_group_count, {extra}
       cast(sum(line_item_count) as bigint) as total_line_items,
       cast(sum(total_item_quantity) as bigint) as total_item_quantity,
       {_money_sums("net_revenue as total_net_revenue")}
from {step}
"""


def _top(step: str, columns: str, measure: str, keys: str, n: int) -> str:
    return f"select {columns} from {step} order by {measure} desc, {keys} limit {n}"


_ITEM, _RESTAURANT_ITEM = "item_category, item_name", "restaurant_id, item_category, item_name"
_OPTION = "option_group_name, option_name"

FINALS["item_sales"] = "select * from item_mart"
FINALS["item_sales_summary"] = _item_summary("item_mart", _ITEM)
FINALS["top_item"] = _top(
    "item_mart", f"{_ITEM}, net_revenue, line_item_count", "net_revenue", _ITEM, 1
)
FINALS["restaurant_item_sales"] = "select * from restaurant_item_mart"
FINALS["restaurant_item_sales_summary"] = _item_summary(
    "restaurant_item_mart",
    _RESTAURANT_ITEM,
    "count(distinct restaurant_id) as restaurant_count,",
)
FINALS["top_restaurant_item"] = _top(
    "restaurant_item_mart",
    f"{_RESTAURANT_ITEM}, net_revenue, line_item_count",
    "net_revenue",
    _RESTAURANT_ITEM,
    1,
)
FINALS["option_sales"] = "select * from option_mart"
FINALS["option_sales_summary"] = f"""
select count(*) as row_count,
       ({_distinct(_OPTION, "option_mart")}) as distinct_group_count,
       cast(sum(option_row_count) as bigint) as total_option_rows,
       cast(sum(total_option_quantity) as bigint) as total_option_quantity,
       {_money_sums("option_revenue as total_option_revenue", "discount_amount as total_discount_amount")}
from option_mart
"""
FINALS["top_option_by_revenue"] = _top(
    "option_mart", f"{_OPTION}, option_revenue, total_option_quantity", "option_revenue", _OPTION, 1
)
FINALS["top_option_by_quantity"] = _top(
    "option_mart", f"{_OPTION}, total_option_quantity, option_revenue", "total_option_quantity", _OPTION, 1
)

# reports
FINALS["top_items"] = _top(
    "item_mart",
    f"{_ITEM}, net_revenue, total_item_quantity, line_item_count, avg_net_revenue_per_line",
    "net_revenue",
    _ITEM,
    10,
)
FINALS["register_tables"] = FINALS["top_items"]
FINALS["show_tables"] = """
select table_name
from (values ('customer_daily_clv'), ('customer_clv_snapshot'), ('customer_rfm'), ('daily_sales'),
             ('restaurant_daily_sales'), ('item_sales'), ('restaurant_item_sales'), ('option_sales'))
     as registered(table_name)
"""
FINALS["top_restaurants"] = f"""
select restaurant_id,
       cast(sum(order_count) as bigint) as total_orders,
       cast(sum(net_revenue) as decimal(24,2)) as total_net_revenue,
       {mean_money("avg_order_value")} as avg_daily_aov
from restaurant_daily
group by restaurant_id
order by total_net_revenue desc, restaurant_id
limit 10
"""
FINALS["daily_revenue_trend"] = """
select order_date, order_count, customer_count, net_revenue, avg_order_value from daily order by order_date
"""
FINALS["customers_by_rfm_segment"] = """
select rfm_segment, count(*) as customer_count,
       cast(sum(lifetime_net_revenue) as decimal(24,2)) as segment_lifetime_net_revenue
from rfm
group by rfm_segment
order by segment_lifetime_net_revenue desc, rfm_segment
"""
FINALS["top_options"] = _top(
    "option_mart",
    f"{_OPTION}, option_revenue, total_option_quantity, option_row_count",
    "option_revenue",
    _OPTION,
    10,
)
FINALS["top_restaurant_items"] = _top(
    "restaurant_item_mart",
    f"{_RESTAURANT_ITEM}, net_revenue, total_item_quantity, line_item_count, "
    "avg_net_revenue_per_line, avg_net_revenue_per_unit",
    "net_revenue",
    _RESTAURANT_ITEM,
    10,
)


def _validation(step: str, **columns: str) -> str:
    parts = []
    for alias, source in columns.items():
        if source == "*":
            parts.append(f"count(*) as {alias}")
        elif "revenue" in alias or "amount" in alias:
            parts.append(f"cast(sum({source}) as decimal(24,2)) as {alias}")
        else:
            parts.append(f"cast(sum({source}) as bigint) as {alias}")
    return f"select {', '.join(parts)} from {step}"


for _name, _step in (("daily_sales", "daily"), ("restaurant_daily_sales", "restaurant_daily")):
    FINALS[f"validate_{_name}"] = _validation(
        _step, total_orders="order_count", total_net_revenue="net_revenue"
    )
FINALS["validate_clv_snapshot"] = _validation(
    "snapshot", customer_count="*", total_lifetime_net_revenue="lifetime_net_revenue"
)
for _name, _step, _counted in (
    ("item_sales", "item_mart", "item_count"),
    ("restaurant_item_sales", "restaurant_item_mart", "restaurant_item_count"),
):
    FINALS[f"validate_{_name}"] = _validation(
        _step,
        **{_counted: "*"},
        total_line_items="line_item_count",
        total_item_quantity="total_item_quantity",
        total_net_revenue="net_revenue",
    )
FINALS["validate_option_sales"] = _validation(
    "option_mart",
    option_count="*",
    total_option_rows="option_row_count",
    total_option_quantity="total_option_quantity",
    total_option_revenue="option_revenue",
    total_discount_amount="discount_amount",
)
FINALS["validate_rfm_grain"] = """
select count(*) as rfm_row_count, count(distinct user_id) as distinct_customer_count,
       cast(sum(lifetime_net_revenue) as decimal(24,2)) as total_lifetime_net_revenue
from rfm
"""


# gates and reconciliation
def _one_row_per_user(dataset: str, source: str, step: str) -> list[str]:
    return [
        _not_empty(dataset, source, "source"),
        _not_empty(dataset, step),
        _unique(dataset, "user_id", step),
    ]


def _day_gates(dataset: str, step: str, *extra: str) -> list[str]:
    repeated = "select count(*) from (select date_key from dates group by date_key having count(*) > 1)"
    return [
        _gate(dataset, "fact_order is not empty", "1", _count("fact_orders"), ok=">="),
        _gate(dataset, "date_dim is not empty", "1", _count("dates"), ok=">="),
        _gate(dataset, "date_dim keys are unique", "0", repeated),
        _not_empty(dataset, step),
        _gate(
            dataset,
            "net_revenue preserved",
            _sum("net_order_revenue", "fact_orders"),
            _sum("net_revenue", step),
        ),
        *extra,
        _gate(
            dataset,
            "all days are in date_dim",
            "0",
            f"select count(*) from {step} where used_derived_date_attributes",
            severity="warn",
        ),
    ]


def _kept(dataset: str, source: str, target: str, **metrics: tuple[str, str]) -> list[str]:
    return [
        _gate(dataset, f"{name} preserved", f"select {old} from {source}", f"select {new} from {target}")
        for name, (old, new) in metrics.items()
    ]


def _group_gates(dataset: str, source: str, step: str, keys: str, **metrics: tuple[str, str]) -> list[str]:
    return [
        _not_empty(dataset, source, "source"),
        _not_empty(dataset, step),
        _unique(dataset, keys, step),
        *_kept(dataset, source, step, **metrics),
    ]


_ITEM_TOTALS = {
    "net_revenue": ("sum(net_line_revenue)", "sum(net_revenue)"),
    "line_item_count": ("count(*)", "sum(line_item_count)"),
    "item_quantity": ("sum(item_quantity)", "sum(total_item_quantity)"),
}
_OPTION_TOTALS = {
    "option_revenue": ("sum(option_revenue)", "sum(option_revenue)"),
    "discount_amount": ("sum(discount_amount)", "sum(discount_amount)"),
    "option_quantity": ("sum(option_quantity)", "sum(total_option_quantity)"),
}
_ORDER_COUNTS = _gate(
    "restaurant_daily_sales",
    "order_count preserved",
    "select count(distinct order_id) from fact_orders",
    _sum("order_count", "restaurant_daily"),
)

FINALS["gate_report"] = _gates(
    _not_empty("customer_daily_clv", "daily_clv"),
    *_kept(
        "customer_daily_clv",
        "cust_orders",
        "daily_clv",
        net_revenue=("sum(net_order_revenue)", "sum(daily_net_revenue)"),
    ),
    *_one_row_per_user("customer_clv_snapshot", "daily_clv", "snapshot"),
    *_one_row_per_user("customer_rfm", "snapshot", "rfm"),
    *_day_gates("daily_sales", "daily"),
    *_day_gates("restaurant_daily_sales", "restaurant_daily", _ORDER_COUNTS),
    *_group_gates("item_sales", "lines", "item_mart", _ITEM, **_ITEM_TOTALS),
    *_group_gates("restaurant_item_sales", "lines", "restaurant_item_mart", _RESTAURANT_ITEM, **_ITEM_TOTALS),
    *_group_gates("option_sales", "options", "option_mart", _OPTION, **_OPTION_TOTALS),
)


def _reconciled(mart: str, step: str, source: str, metrics: dict[str, tuple[str, str]]) -> list[str]:
    return [
        f"""
select '{mart}' as mart, '{metric}' as metric, source_total, mart_total,
       source_total is not distinct from mart_total as is_match
from (select cast((select {old} from {source}) as decimal(28,2)) as source_total,
             cast((select {new} from {step}) as decimal(28,2)) as mart_total)
"""
        for metric, (old, new) in metrics.items()
    ]


_RECONCILED_ORDERS = {
    "total_orders": ("count(distinct order_id)", "sum(order_count)"),
    "net_revenue": ("sum(net_order_revenue)", "sum(net_revenue)"),
}
_RECONCILED_LINES = {
    "line_items": ("count(*)", "sum(line_item_count)"),
    "item_quantity": ("sum(item_quantity)", "sum(total_item_quantity)"),
    "net_revenue": ("sum(net_line_revenue)", "sum(net_revenue)"),
}
_RECONCILED_CUSTOMERS = {
    "customers": ("count(distinct user_id)", "count(*)"),
    "lifetime_revenue": ("sum(net_order_revenue)", "sum(lifetime_net_revenue)"),
}
_RECONCILED_OPTIONS = {
    "option_rows": ("count(*)", "sum(option_row_count)"),
    "option_quantity": ("sum(option_quantity)", "sum(total_option_quantity)"),
    "option_revenue": ("sum(option_revenue)", "sum(option_revenue)"),
}
FINALS["reconcile_marts"] = _gates(
    *_reconciled("daily_sales", "daily", "fact_orders", _RECONCILED_ORDERS),
    *_reconciled("restaurant_daily_sales", "restaurant_daily", "fact_orders", _RECONCILED_ORDERS),
    *_reconciled("item_sales", "item_mart", "lines", _RECONCILED_LINES),
    *_reconciled("restaurant_item_sales", "restaurant_item_mart", "lines", _RECONCILED_LINES),
    *_reconciled("customer_clv_snapshot", "snapshot", "cust_orders", _RECONCILED_CUSTOMERS),
    *_reconciled("customer_rfm", "rfm", "cust_orders", _RECONCILED_CUSTOMERS),
    *_reconciled("option_sales", "option_mart", "options", _RECONCILED_OPTIONS),
)
FINALS["option_revenue_gap"] = """
select total_option_revenue, attached_option_revenue,
       cast(total_option_revenue - attached_option_revenue as decimal(14,2)) as option_revenue_gap,
       unmatched_option_lines, unmatched_option_revenue
from (
    select (select cast(sum(option_revenue) as decimal(14,2)) from options) as total_option_revenue,
           (select cast(sum(option_revenue) as decimal(14,2)) from lines) as attached_option_revenue,
           (select count(*) from unmatched) as unmatched_option_lines,
           (select cast(coalesce(sum(option_revenue), 0) as decimal(14,2)) from unmatched) as unmatched_option_revenue
)
"""

# profiling
_FILES = {
    "order_items.csv": (
        "raw_items",
        "app_name restaurant_id creation_time_utc order_id user_id printed_card_number is_loyalty "
        "currency lineitem_id item_category item_name item_price item_quantity".split(),
    ),
    "order_item_options.csv": (
        "raw_options",
        "order_id lineitem_id option_group_name option_name option_price option_quantity".split(),
    ),
    "date_dim.csv": (
        "raw_dates",
        "date_key year month week day_of_week is_weekend is_holiday holiday_name".split(),
    ),
}


def _column_profile(step: str, columns: list[str]) -> str:
    return " union all ".join(
        f"select '{c}' as column_name, count(*) as n, count(*) - count({c}) as nulls, "
        f"count(distinct {c}) as varied from {step}"
        for c in columns
    )


def _file_summary(file: str, step: str, columns: list[str]) -> str:
    null_pct = pct("nulls", "n", 2)
    return f"""
select '{file}' as file,
       (select count(*) from {step}) as rows,
       cast({len(columns)} as bigint) as cols,
       (select count(*) from {step}) - (select count(*) from (select distinct * from {step})) as duplicate_full_rows,
       string_agg(column_name || '=' || cast(null_pct as varchar) || '%', '; ' order by null_rank)
           filter (where null_rank <= 8) as top_null_cols,
       string_agg(column_name || '=' || cast(varied as varchar), '; ' order by varied_rank)
           filter (where varied_rank <= 8) as top_cardinality_cols
from (
    select *, row_number() over (order by null_pct desc, column_name) as null_rank,
           row_number() over (order by varied desc, column_name) as varied_rank
    from (select *, {null_pct} as null_pct from ({_column_profile(step, columns)}))
)
"""


def _file_columns(file: str, step: str, columns: list[str]) -> str:
    profile = f"select *, {pct('nulls', 'n', 3)} as null_pct from ({_column_profile(step, columns)})"
    return f"""
select '{file}' as file, measure, cast(position as integer) as position, column_name,
       cast(value as decimal(20,3)) as value
from (
    select 'null_pct' as measure, column_name, null_pct as value,
           row_number() over (order by null_pct desc, column_name) as position
    from ({profile})
    union all
    select 'distinct_count', column_name, varied,
           row_number() over (order by varied desc, column_name)
    from ({profile})
)
where position <= 15
"""


FINALS["profile_summary"] = _gates(*[_file_summary(file, *spec) for file, spec in _FILES.items()])
FINALS["profile_columns"] = _gates(*[_file_columns(file, *spec) for file, spec in _FILES.items()])


def _key_check(file: str, step: str, keys: list[str]) -> str:
    any_null = " or ".join(f"{key} is null" for key in keys)
    ratio = _scaled(
        _half_up("(cast(unique_key_count as hugeint) * 1000000)", "cast(row_count as hugeint)"),
        6,
        "decimal(9,6)",
    )
    return f"""
select '{file}' as file, '{"|".join(keys)}' as candidate_key,
       case when duplicate_key_count = 0 and null_key_rows = 0 then 'PASS' else 'WARN' end as status,
       row_count, unique_key_count, duplicate_key_count, null_key_rows,
       {ratio} as uniqueness_ratio,
       case when duplicate_key_count = 0 and null_key_rows = 0 then 'Every row has a key of its own'
            else concat_ws('; ',
                case when duplicate_key_count > 0 then format('{{:,}}', duplicate_key_count) || ' rows repeat a key' end,
                case when null_key_rows > 0 then format('{{:,}}', null_key_rows) || ' rows lack a part of the key' end)
       end as notes
from (
    select cast(sum(copies) as bigint) as row_count, count(*) as unique_key_count,
           cast(sum(copies - 1) as bigint) as duplicate_key_count,
           cast(coalesce(sum(copies) filter (where {any_null}), 0) as bigint) as null_key_rows
    from (select {", ".join(keys)}, count(*) as copies from {step} group by {", ".join(keys)})
)
"""


_KEYS = {
    "order_items.csv": ["order_id", "lineitem_id"],
    "order_item_options.csv": ["order_id", "lineitem_id", "option_group_name", "option_name"],
    "date_dim.csv": ["date_key"],
}
FINALS["validate_key"] = _gates(
    *[_key_check(file, _FILES[file][0], keys) for file, keys in _KEYS.items()]
)
FINALS["write_report"] = f"""
select file, candidate_key, status, cast(row_count as varchar) as row_count,
       cast(unique_key_count as varchar) as unique_key_count,
       cast(duplicate_key_count as varchar) as duplicate_key_count,
       cast(null_key_rows as varchar) as null_key_rows,
       cast(uniqueness_ratio as varchar) as uniqueness_ratio, notes
from ({FINALS["validate_key"]})
"""


def _check_row(file: str, name: str, affected: str, status: str, notes: str) -> str:
    step = _FILES[file][0]
    return f"""
select '{file}' as file, '{name}' as check_name, {status} as status, affected_rows, {notes} as notes
from (select cast({affected} as bigint) as affected_rows from {step})
"""


def _zero(then: str, otherwise: str) -> str:
    return f"case when affected_rows = 0 then '{then}' else '{otherwise}' end"


def _numeric_row(file: str, column: str) -> str:
    return _check_row(
        file,
        f"numeric_{column}",
        f"count(*) filter (where {column} is not null and try_cast({column} as double) is null)",
        _zero("PASS", "FAIL"),
        _zero("Every value present is a number", "There are values that do not read as a number"),
    )


def _non_positive_rows(file: str, column: str, allow_negative: bool = False) -> list[str]:
    note = f"{column} below zero"
    if allow_negative:
        note += "; discounts are written that way"
    return [
        _check_row(
            file,
            f"zero_{column}",
            f"count(*) filter (where {column} = 0)",
            _zero("PASS", "WARN"),
            f"'{column} equal to zero'",
        ),
        _check_row(
            file,
            f"negative_{column}",
            f"count(*) filter (where {column} < 0)",
            "'PASS'" if allow_negative else _zero("PASS", "WARN"),
            f"'{note}'",
        ),
    ]


_ITEMS_FILE, _OPTIONS_FILE = "order_items.csv", "order_item_options.csv"
_NUMERIC = [
    _numeric_row(_ITEMS_FILE, "item_price"),
    _numeric_row(_ITEMS_FILE, "item_quantity"),
    _numeric_row(_OPTIONS_FILE, "option_price"),
    _numeric_row(_OPTIONS_FILE, "option_quantity"),
]
_NON_POSITIVE = [
    *_non_positive_rows(_ITEMS_FILE, "item_price"),
    *_non_positive_rows(_ITEMS_FILE, "item_quantity"),
    *_non_positive_rows(_OPTIONS_FILE, "option_price", allow_negative=True),
    *_non_positive_rows(_OPTIONS_FILE, "option_quantity"),
]
_MISSING = [
    _check_row(
        _ITEMS_FILE,
        f"missing_{column}",
        f"count(*) filter (where {column} is null)",
        _zero("PASS", "WARN"),
        f"'{column} without a value'",
    )
    for column in ("user_id", "restaurant_id", "order_id", "lineitem_id", "creation_time_utc")
]
_TIMESTAMP = _check_row(
    _ITEMS_FILE,
    "valid_creation_time_utc",
    "count(*) filter (where creation_time_utc is null)",
    _zero("PASS", "WARN"),
    "'Timestamps absent or unreadable'",
)
_RANGE = f"""
select '{_ITEMS_FILE}' as file, 'order_date_range' as check_name, 'INFO' as status,
       count(creation_time_utc) as affected_rows,
       'From ' || strftime(min(creation_time_utc), '%Y-%m-%d %H:%M:%S') || '+00:00 to '
           || strftime(max(creation_time_utc), '%Y-%m-%d %H:%M:%S') || '+00:00' as notes
from raw_items
"""


def _distribution(column: str, check: str, many: str) -> str:
    return f"""
select '{_ITEMS_FILE}' as file, '{check}' as check_name,
       case when count(*) > 1 then '{many}' else 'INFO' end as status,
       cast(coalesce(sum(copies), 0) as bigint) as affected_rows,
       'Distinct values: ' || format('{{:,}}', count(*)) as notes
from (select {column} as shown_value, count(*) as copies from raw_items where {column} is not null group by {column})
"""


_CURRENCY = _distribution("currency", "currency_distribution", "WARN")
_LOYALTY = _distribution("is_loyalty", "loyalty_distribution", "INFO")
_DISCOUNT = _check_row(
    _OPTIONS_FILE,
    "discount_option_rows",
    "count(*) filter (where option_price < 0)",
    _zero("WARN", "INFO"),
    "'Options priced below zero, which lower the bill'",
)
_DATE_KEY = """
select 'date_dim.csv' as file, 'valid_date_key' as check_name,
       case when invalid + repeated = 0 then 'PASS' else 'WARN' end as status,
       invalid + repeated as affected_rows,
       'Rows with an unreadable date_key: ' || format('{:,}', invalid)
           || '; rows that repeat one: ' || format('{:,}', repeated) as notes
from (
    select count(*) filter (where try_strptime(date_key, '%d-%m-%Y') is null) as invalid,
           count(*) - count(distinct date_key) as repeated
    from raw_dates
)
"""
FINALS["check_numeric"] = _gates(*_NUMERIC)
FINALS["check_non_positive"] = _gates(*_NON_POSITIVE)
FINALS["check_missing"] = _gates(*_MISSING)
FINALS["check_timestamp"] = _TIMESTAMP
FINALS["order_date_range"] = _RANGE
FINALS["currency_distribution"] = _CURRENCY
FINALS["loyalty_distribution"] = _LOYALTY
FINALS["currency_values"] = """
select currency as value, count(*) as row_count from raw_items where currency is not null group by currency
"""
FINALS["loyalty_values"] = """
select case when is_loyalty then 'True' else 'False' end as value, count(*) as row_count
from raw_items where is_loyalty is not null group by is_loyalty
"""
FINALS["discount_option_rows"] = _DISCOUNT
FINALS["check_date_key"] = _DATE_KEY
FINALS["data_quality_report"] = _gates(
    *_NUMERIC, *_NON_POSITIVE, *_MISSING, _TIMESTAMP, _RANGE, _CURRENCY, _LOYALTY, _DISCOUNT, _DATE_KEY
)
FINALS["relationship_options_items"] = f"""
select 'order_item_options -> order_items' as relationship, 'order_id|lineitem_id' as join_columns,
       case when unmatched_rows = 0 then 'PASS' else 'WARN' end as status,
       left_rows, left_rows - unmatched_rows as matched_rows, unmatched_rows,
       {pct("unmatched_rows", "left_rows", 4)} as unmatched_pct,
       case when unmatched_rows = 0 then 'All option rows belong to an order line'
            else 'There are option rows without an order line' end as notes
from (
    select count(*) as left_rows, count(*) filter (where k.hit is null) as unmatched_rows
    from raw_options o
    left join (select distinct order_id, lineitem_id, true as hit from raw_items) k
      on o.order_id is not distinct from k.order_id and o.lineitem_id is not distinct from k.lineitem_id
)
"""
FINALS["relationship_orders_dates"] = f"""
select 'order_items order_date -> date_dim' as relationship,
       'DATE(creation_time_utc)|date_key' as join_columns,
       case when unmatched_rows = 0 and invalid = 0 then 'PASS' else 'WARN' end as status,
       left_rows, checked - unmatched_rows as matched_rows, unmatched_rows,
       {pct("unmatched_rows", "checked", 4)} as unmatched_pct,
       'Lines without a readable time: ' || format('{{:,}}', invalid)
           || '; lines on days outside the calendar: ' || format('{{:,}}', unmatched_rows) as notes
from (
    select count(*) as left_rows, count(creation_time_utc) as checked,
           count(*) - count(creation_time_utc) as invalid,
           count(*) filter (where creation_time_utc is not null and k.day is null) as unmatched_rows
    from raw_items i
    left join (select distinct cast(strptime(date_key, '%d-%m-%Y') as date) as day from raw_dates) k
      on cast(i.creation_time_utc as date) = k.day
)
"""
FINALS["business_snapshot"] = """
select count(distinct order_id) as unique_orders, count(distinct user_id) as unique_customers,
       count(distinct restaurant_id) as unique_restaurants, count(distinct item_category) as unique_categories,
       cast(sum(item_price * item_quantity) as decimal(20,2)) as gross_item_revenue,
       (select cast(sum(option_price * option_quantity) as decimal(20,2)) from raw_options) as net_option_revenue,
       (select cast(sum(option_price * option_quantity) as decimal(20,2)) from raw_options
        where option_price < 0) as discount_option_value
from raw_items
"""
FINALS["profile_run"] = f"""
select report, cast(row_count as bigint) as row_count
from (
    select 'data_profile_summary' as report, count(*) as row_count from ({FINALS["profile_summary"]})
    union all
    select 'key_validation', count(*) from ({FINALS["validate_key"]})
    union all
    select 'relationship_validation', count(*)
    from ({FINALS["relationship_options_items"]} union all {FINALS["relationship_orders_dates"]})
    union all
    select 'data_quality_checks', count(*) from ({FINALS["data_quality_report"]})
    union all
    select 'metric_readiness', 9
)
"""

# further metrics
_TREND = ", ".join(TREND_COLUMNS)


def _change(now: str, before: str) -> str:
    ratio = _half_up(f"({_cents(f'{now} - {before}')} * 10000)", _cents(before))
    return f"case when {before} > 0 then {_scaled(ratio, 4, 'decimal(14,4)')} end"


FINALS["sales_trends"] = f"""
select *, {_change("net_revenue", "last_year_net_revenue")} as revenue_change
from (
    select *,
           case when year is not null then cast(sum(net_revenue) over (
               partition by grouping_id, {", ".join(c for c in TREND_COLUMNS if c != "year")}
               order by year range between 1 preceding and 1 preceding) as decimal(14,2)) end as last_year_net_revenue
    from (
        select {_TREND}, cast(grouping({_TREND}) as bigint) as grouping_id,
               coalesce(nullif(concat_ws('+', {", ".join(f"case when grouping({c}) = 0 then '{c}' end" for c in TREND_COLUMNS)}), ''), 'total') as level,
               count(*) as line_count, cast(sum(item_quantity) as bigint) as item_quantity,
               cast(sum(net_line_revenue) as decimal(14,2)) as net_revenue
        from (
            select cast(year(order_date) as integer) as year, cast(month(order_date) as integer) as month,
                   cast(weekofyear(order_date) as integer) as week, coalesce(d.is_holiday, false) as is_holiday,
                   item_category, restaurant_id, item_quantity, net_line_revenue
            from lines l left join dates d on l.order_date = d.date_key
        )
        group by grouping sets ({", ".join(f"({', '.join(level)})" for level in TREND_LEVELS)})
    )
)
"""
FINALS["churn_risk"] = f"""
select *,
       case when longest_gap_days is null then 'single_visit'
            when days_since_last_order > 2 * longest_gap_days then 'lapsed'
            when days_since_last_order > longest_gap_days then 'at_risk'
            when recent_net_revenue * 2 < earlier_net_revenue then 'declining'
            else 'active' end as churn_risk
from (
    select user_id, last_order_date,
           cast(date_diff('day', last_order_date, (select max(order_date) from spend)) as integer) as days_since_last_order,
           order_days, {count_per("gap_days", "gaps")} as average_gap_days, longest_gap_days,
           recent_net_revenue, earlier_net_revenue,
           {_change("recent_net_revenue", "earlier_net_revenue")} as spend_change
    from (
        select user_id, max(order_date) as last_order_date, count(*) as order_days,
               sum(gap) as gap_days, count(gap) as gaps, cast(max(gap) as integer) as longest_gap_days,
               cast(sum(daily_net_revenue) filter (where age <= 5) as decimal(14,2)) as recent_net_revenue,
               cast(sum(daily_net_revenue) filter (where age between 6 and 10) as decimal(14,2)) as earlier_net_revenue
        from (
            select *, row_number() over newest as age,
                   date_diff('day', lead(order_date) over newest, order_date) as gap
            from spend where order_date is not null
            window newest as (partition by user_id order by order_date desc)
        )
        group by user_id
    )
)
"""
FINALS["location_ranking"] = f"""
select *,
       rank() over (order by net_revenue desc nulls last) as revenue_rank,
       dense_rank() over (order by net_revenue desc nulls last) as revenue_dense_rank,
       rank() over (order by order_count desc nulls last) as order_rank,
       dense_rank() over (order by order_count desc nulls last) as order_dense_rank
from (
    select *, {money_per("net_revenue", "order_count")} as avg_order_value
    from (
        select restaurant_id, count(order_id) as order_count, count(distinct user_id) as customer_count,
               {_money_sums("net_order_revenue as net_revenue")}
        from fact_orders group by restaurant_id
    )
)
"""
STEPS["members"] = """
select user_id, coalesce(bool_or(is_loyalty), false) as is_member,
       cast(date_trunc('month', min(order_date)) as date) as cohort_month
from cust_orders where order_date is not null group by user_id
"""
FINALS["loyalty_days"] = f"""
select is_member, cohort_month, order_date, count(*) as customers, cast(sum(daily_order_count) as bigint) as order_count,
       {_money_sums("daily_net_revenue as net_revenue")}
from spend join members using (user_id) where order_date is not null
group by is_member, cohort_month, order_date
"""
FINALS["loyalty_cohorts"] = f"""
select *, {rate("customers", "cohort_size")} as repeat_rate, {money_per("net_revenue", "customers")} as net_revenue_per_customer
from (
    select *, max(customers) filter (where months_since = 0) over (partition by is_member, cohort_month) as cohort_size
    from (
        select is_member, cohort_month,
               cast(12 * (year(order_date) - year(cohort_month)) + month(order_date) - month(cohort_month) as integer) as months_since,
               count(distinct user_id) as customers, cast(sum(daily_order_count) as bigint) as order_count,
               {_money_sums("daily_net_revenue as net_revenue")}
        from spend join members using (user_id) where order_date is not null
        group by all
    )
)
"""


def _same_mix(measure: str) -> str:
    """Ten-thousandths of what the discounted lines would have brought at the full-price average."""
    return _half_up(f"(discounted_lines * cast({measure} * 100 as hugeint) * 100)", "cast(nullif(full_lines, 0) as hugeint)")


FINALS["discount_effectiveness"] = f"""
select *, cast(avg_net_discounted - avg_net_full_price as decimal(14,2)) as net_effect,
       cast(avg_quantity_discounted - avg_quantity_full_price as decimal(14,2)) as quantity_effect
from (
    select item_category, is_total, matched_strata, unmatched_strata, matched_discounted_lines, unmatched_discounted_lines,
           {_scaled(_half_up("net_cents", "nullif(matched_discounted_lines, 0)"), 2, "decimal(14,2)")} as avg_net_discounted,
           {_scaled(_half_up("full_net", "(100 * nullif(matched_discounted_lines, 0))"), 2, "decimal(14,2)")} as avg_net_full_price,
           {_scaled(_half_up("(quantity * 100)", "nullif(matched_discounted_lines, 0)"), 2, "decimal(14,2)")} as avg_quantity_discounted,
           {_scaled(_half_up("full_quantity", "(100 * nullif(matched_discounted_lines, 0))"), 2, "decimal(14,2)")} as avg_quantity_full_price
    from (
        select item_category, grouping(item_category) = 1 as is_total,
               count(*) filter (where matched) as matched_strata, count(*) filter (where not matched) as unmatched_strata,
               cast(coalesce(sum(discounted_lines) filter (where matched), 0) as bigint) as matched_discounted_lines,
               cast(coalesce(sum(discounted_lines) filter (where not matched), 0) as bigint) as unmatched_discounted_lines,
               cast(sum(discounted_net * 100) filter (where matched) as hugeint) as net_cents,
               sum({_same_mix("full_net")}) filter (where matched) as full_net,
               sum(discounted_quantity) filter (where matched) as quantity,
               sum({_same_mix("full_quantity")}) filter (where matched) as full_quantity
        from (
            select *, discounted_lines > 0 and full_lines > 0 as matched
            from (
                select restaurant_id, item_category, item_name,
                       count(*) filter (where has_discount) as discounted_lines,
                       count(*) filter (where not has_discount) as full_lines,
                       coalesce(sum(net_line_revenue) filter (where has_discount), 0) as discounted_net,
                       coalesce(sum(net_line_revenue) filter (where not has_discount), 0) as full_net,
                       coalesce(sum(item_quantity) filter (where has_discount), 0) as discounted_quantity,
                       coalesce(sum(item_quantity) filter (where not has_discount), 0) as full_quantity
                from lines group by restaurant_id, item_category, item_name
            )
        )
        group by rollup (item_category)
    )
)
"""

ORACLES: dict[str, str] = {name: statement(final) for name, final in FINALS.items()}
