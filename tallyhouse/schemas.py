"""Column lists of the three sources, as raw tables name them after clean-up."""

from __future__ import annotations

# Source columns and candidate keys.
ORDER_ITEM_COLUMNS = (
    "app_name",
    "restaurant_id",
    "creation_time_utc",
    "order_id",
    "user_id",
    "printed_card_number",
    "is_loyalty",
    "currency",
    "lineitem_id",
    "item_category",
    "item_name",
    "item_price",
    "item_quantity",
)
OPTION_COLUMNS = (
    "order_id",
    "lineitem_id",
    "option_group_name",
    "option_name",
    "option_price",
    "option_quantity",
)
DATE_COLUMNS = (
    "date_key",
    "year",
    "month",
    "week",
    "day_of_week",
    "is_weekend",
    "is_holiday",
    "holiday_name",
)
LINE_KEY = ("order_id", "lineitem_id")
OPTION_KEY = ("order_id", "lineitem_id", "option_group_name", "option_name")
ID_COLUMNS = ("restaurant_id", "order_id", "user_id", "printed_card_number", "lineitem_id")
PARTITION = "ingest_date"
