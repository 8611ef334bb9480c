import json

import pytest

from souqframe.functions import (
    arabic_to_western,
    clean_text,
    normalize_currency_text,
    normalize_numeric_text,
    numeric_amount,
    remove_currency,
)
from souqframe.operators import lookups, reports
from souqframe.operators.validation import apply_all_quality_rules
from tests.conftest import raw_orders


@pytest.mark.parametrize(
    ("function", "text", "expected"),
    [
        (clean_text, "  a \t b  ", "a b"),
        (arabic_to_western, "السعر ١٥٠٠٠ ريال", "السعر 15000 ريال"),
        (normalize_numeric_text, " ١٬٢٣٤٫٥ ", "1234.5"),
        (normalize_currency_text, " y.R. ", "YER"),
        (normalize_currency_text, "ريال يمني", "YER"),
        (normalize_currency_text, " US  D", "US D"),
        (remove_currency, "1500 YER x", "1500x"),
        (remove_currency, "١٠٠٠ ريال يمني", "1000"),
        (numeric_amount, "161,000.00", 161000),
        (numeric_amount, "n/a", 0),
        (numeric_amount, None, 0),
    ],
)
def test_helpers(spark, function, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(function("t")).first()[0] == expected


def _with_items(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "items_json string")


def test_products_fall_back_and_nothing_is_capped(spark):
    items = [
        {"name": "a", "qty": "٢", "total": "10"},
        {"name": "", "product_name": "a", "quantity": "3", "price": "1.5"},
        {"item_name": "b", "qty": "2.5", "unit_price": "x"},
        {"qty": "", "total": ""},
    ]
    orders = _with_items(spark, json.dumps(items), '{"name":"alone","qty":"1"}', "{bad", "[]", "[{'name':'c'}]", None)
    rows = {row[0]: (row[1], row[2]) for row in reports.product_sales(orders).collect()}
    assert rows == {"a": (5, 11.5), "b": (1, 0.0), reports.UNNAMED_PRODUCT: (1, 0.0)}


def test_registry(spark):
    assert len(reports.REPORTS_REGISTRY) == 5
    with pytest.raises(ValueError, match="sales_by_city"):
        reports.run_report("nothing", None)


@pytest.fixture(scope="module")
def orders(spark):
    changes = [
        {"order_id": f"O{n}", "customer_id": f"C{n % 3}", "delivery_cost": str(n), "order_date": f"2024-01-0{n}",
         "customer_email": f"u{n}@x.co"}
        for n in range(1, 8)
    ]
    return apply_all_quality_rules(raw_orders(spark, changes))


def test_lookups(orders):
    ids = lambda df: [row["order_id"] for row in df.collect()]
    assert ids(lookups.query_orders_by_customer(orders, "C1", 2)) == ["O7", "O4"]
    assert ids(lookups.query_orders_by_city_and_status(orders, "X", "DELIVERED", 3)) == ["O1", "O2", "O3"]
    assert ids(lookups.query_orders_by_date_range(orders, "2024-01-02", "2024-01-03")) == ["O2", "O3"]
    assert ids(lookups.query_orders_by_email_or_phone(orders, "u5@x.co")) == ["O5"]
    assert ids(lookups.query_high_value_orders(orders, 25.001, 10)) == ["O7", "O6"]
    assert ids(lookups.query_high_value_orders(orders, 26, 10)) == ["O7", "O6"]


def test_lookup_filters_reach_the_scan(orders, tmp_path, spark):
    path = str(tmp_path / "orders")
    orders.write.parquet(path)
    plan = lookups.query_high_value_orders(spark.read.parquet(path), 10)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "GreaterThanOrEqual(amount" in text and "TakeOrderedAndProject" in text
    report = reports.get_sales_by_city(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<city:string,amount:decimal(28,2)>" in report


def test_averages_round_halves_to_even(spark):
    amounts = [("x", "0.50"), ("x", "0.51"), ("y", "40.00"), ("y", "0.25"), ("z", "0.01"), ("z", "0.02")]
    rows = spark.createDataFrame(amounts, "city string, total_amount string")
    sales = reports.get_sales_by_city(rows.withColumn("amount", numeric_amount("total_amount"))).collect()
    found = [(row[0], row["total_orders"], row["total_revenue"], row["avg_order_value"]) for row in sales]
    assert found == [("y", 2, 40.25, 20.12), ("x", 2, 1.01, 0.5), ("z", 2, 0.03, 0.02)]


def test_very_large_quantities_and_amounts_are_not_lost(spark):
    item = json.dumps([{"name": "n", "qty": "9000000000000000000", "total": "1"}])
    rows = spark.createDataFrame([(item, "9,000,000,000,000,000,000.00")] * 2, "items_json string, total_amount string")
    sold = reports.get_top_products(rows).first()
    assert (sold["total_quantity_sold"], sold["total_revenue"]) == (2**63 - 1, 2.0)
    assert str(rows.select(numeric_amount("total_amount")).first()[0]) == "9000000000000000000.00"
