"""Small hand-made sources covering the awkward cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ITEM_SCHEMA = (
    "app_name string, restaurant_id string, creation_time_utc string, order_id string, "
    "user_id string, printed_card_number string, is_loyalty string, currency string, "
    "lineitem_id string, item_category string, item_name string, item_price string, "
    "item_quantity string"
)
OPTION_SCHEMA = (
    "order_id string, lineitem_id string, option_group_name string, option_name string, "
    "option_price string, option_quantity string"
)
DATE_SCHEMA = (
    "date_key string, year string, month string, week string, day_of_week string, "
    "is_weekend string, is_holiday string, holiday_name string"
)

_DEFAULT_ITEM = {
    "app_name": "app",
    "restaurant_id": "R1",
    "creation_time_utc": "2023-02-21T22:40:01.000Z",
    "order_id": "o1",
    "user_id": "u1",
    "printed_card_number": None,
    "is_loyalty": "true",
    "currency": "USD",
    "lineitem_id": "l1",
    "item_category": "Bowls",
    "item_name": "Rice",
    "item_price": "10.00",
    "item_quantity": "1",
}
_DEFAULT_OPTION = {
    "order_id": "o1",
    "lineitem_id": "l1",
    "option_group_name": "Sauce",
    "option_name": "Hot",
    "option_price": "1.00",
    "option_quantity": "1",
}


def _frame(spark: SparkSession, schema: str, default: dict, rows: list[dict]) -> DataFrame:
    for row in rows:
        assert set(row) <= set(default), set(row) - set(default)
    return spark.createDataFrame([tuple((default | row).values()) for row in rows], schema)


def items(spark: SparkSession, *rows: dict) -> DataFrame:
    return _frame(spark, ITEM_SCHEMA, _DEFAULT_ITEM, list(rows))


def options(spark: SparkSession, *rows: dict) -> DataFrame:
    return _frame(spark, OPTION_SCHEMA, _DEFAULT_OPTION, list(rows))


def dates(spark: SparkSession, *keys: str | None) -> DataFrame:
    rows = [(key, "2023", "2", "8", "Tuesday", "false", "false", None) for key in keys]
    return spark.createDataFrame(rows, DATE_SCHEMA)


def one(df: DataFrame) -> dict:
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0].asDict(recursive=True)


def by(df: DataFrame, *keys: str) -> dict:
    rows = {tuple(row[key] for key in keys): row.asDict(recursive=True) for row in df.collect()}
    return {key[0] if len(keys) == 1 else key: row for key, row in rows.items()}
