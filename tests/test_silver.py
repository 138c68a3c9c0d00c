from datetime import date, datetime
from decimal import Decimal

import pytest

from tallyhouse.functions.names import normalize_column_names
from tallyhouse.operators import silver
from tests.support import samples
from tests.support.samples import by, one


def test_names_are_trimmed_lower_snake_case(spark):
    df = spark.createDataFrame([(1, 2)], [" ORDER ID ", "Item_Name"])
    assert normalize_column_names(df).columns == ["order_id", "item_name"]


def test_colliding_names_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], ["Order ID", "order_id"])
    with pytest.raises(ValueError, match="order_id"):
        normalize_column_names(df)


def test_items_are_typed_and_no_row_is_lost(spark):
    raw = samples.items(
        spark,
        {"lineitem_id": "good", "item_quantity": "2.0"},
        {"lineitem_id": "bad", "creation_time_utc": "garbage", "item_price": "abc", "is_loyalty": "maybe"},
        {"lineitem_id": None, "order_id": None, "user_id": None, "is_loyalty": "TRUE", "item_quantity": None},
    )
    rows = by(silver.clean_order_items(raw), "lineitem_id")
    assert len(rows) == 3
    good = rows["good"]
    assert good["creation_time_utc"] == datetime(2023, 2, 21, 22, 40, 1)
    assert good["order_date"] == date(2023, 2, 21)
    assert good["gross_item_revenue"] == Decimal("20.00")
    assert good["is_valid_order_item_key"] and good["has_user_id"]
    bad = rows["bad"]
    assert bad["creation_time_utc"] is None and bad["order_date"] is None
    assert bad["item_price"] is None and bad["gross_item_revenue"] is None
    assert bad["is_loyalty"] is None
    keyless = rows[None]
    assert keyless["is_loyalty"] is True and keyless["item_quantity"] is None
    assert not keyless["is_valid_order_item_key"] and not keyless["has_user_id"]
    assert one(silver.order_items_quality(silver.clean_order_items(raw))) == {
        "row_count": 3,
        "invalid_key_count": 1,
        "missing_user_id_count": 1,
        "invalid_timestamp_count": 1,
    }


def test_whole_numbers_in_text_are_cut_not_rounded(spark):
    raw = samples.items(
        spark,
        *[
            {"lineitem_id": value, "item_quantity": value}
            for value in ("2.999", "-2.7", " 3 ", "x", "99999999999")
        ],
    )
    rows = by(silver.clean_order_items(raw), "lineitem_id")
    assert {key: row["item_quantity"] for key, row in rows.items()} == {
        "2.999": 2,
        "-2.7": -2,
        " 3 ": 3,
        "x": None,
        "99999999999": None,
    }


def test_upper_case_headers_are_accepted(spark):
    raw = samples.items(spark, {})
    shouting = raw.toDF(*[name.upper() for name in raw.columns])
    assert one(silver.clean_order_items(shouting))["order_id"] == "o1"


def test_options_keep_repeats_and_flag_discounts(spark):
    raw = samples.options(
        spark,
        {"option_price": "-2.50", "option_quantity": "2"},
        {"option_price": "-2.50", "option_quantity": "2"},
        {"option_name": "Mild", "option_price": None},
        {"order_id": None, "option_name": None, "option_quantity": "x"},
    )
    clean = silver.clean_order_item_options(raw)
    assert clean.count() == 4
    discount = clean.where("is_discount").first()
    assert discount["option_revenue"] == Decimal("-5.00")
    assert discount["discount_amount"] == Decimal("5.00")
    assert discount["candidate_option_key"] == "o1|l1|Sauce|Hot"
    unpriced = clean.where("option_name = 'Mild'").first()
    assert unpriced["is_discount"] is None and unpriced["discount_amount"] == Decimal("0.00")
    # concat_ws skips nulls
    assert clean.where("order_id is null").first()["candidate_option_key"] == "l1|Sauce"
    assert one(silver.options_quality(clean)) == {
        "row_count": 4,
        "invalid_key_count": 1,
        "discount_row_count": 2,
        "null_option_price_count": 1,
        "null_option_quantity_count": 1,
    }
    assert one(silver.duplicate_option_keys(clean)) == {
        "duplicate_key_groups": 1,
        "duplicate_key_rows": 1,
    }


def test_no_duplicate_keys_gives_zero_not_null(spark):
    clean = silver.clean_order_item_options(samples.options(spark, {}))
    assert one(silver.duplicate_option_keys(clean)) == {
        "duplicate_key_groups": 0,
        "duplicate_key_rows": 0,
    }


def test_date_keys_in_all_formats(spark):
    raw = samples.dates(spark, "01-02-2023", "2023-02-03", "garbage", None, "03-02-2023")
    clean = silver.clean_date_dim(raw)
    found = [row["date_key"] for row in clean.collect()]
    assert found == [date(2023, 2, 1), date(2023, 2, 3), None, None, date(2023, 2, 3)]
    first = clean.first()
    assert (first["day_of_month"], first["quarter"], first["month_name"]) == (1, 1, "February")
    assert one(silver.date_dim_quality(clean)) == {
        "row_count": 5,
        "invalid_date_key_count": 2,
        "duplicate_date_key_groups": 1,
    }


def test_date_keys_that_are_dates_already(spark):
    raw = samples.dates(spark, "2023-02-03").withColumn("date_key", spark.range(1).selectExpr("date'2023-02-03' d").scalar())
    assert one(silver.clean_date_dim(raw))["date_key"] == date(2023, 2, 3)
