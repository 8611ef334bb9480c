"""The five lookups over accepted orders.

Each is a filter that reaches the Parquet scan, then a top-N that every task cuts down before anything
is moved. Where the lookup itself has no order, the order id decides, so results can be repeated; pass
`ordered=False` to take the first matches found and stop scanning there.
"""

from decimal import ROUND_CEILING, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _some(orders: DataFrame, limit: int, ordered: bool) -> DataFrame:
    return (orders.orderBy("order_id") if ordered else orders).limit(limit)


def query_orders_by_customer(
    orders: DataFrame, customer_id: str = "CUST-1001", limit: int = 10
) -> DataFrame:
    """a customer's orders, last ones first."""
    return (
        orders.where(F.col("customer_id") == customer_id)
        .orderBy(F.desc("order_date"), "order_id")
        .limit(limit)
    )


def query_orders_by_city_and_status(
    orders: DataFrame,
    city: str = "Sana'a",
    status: str = "DELIVERED",
    limit: int = 10,
    ordered: bool = True,
) -> DataFrame:
    """a city's orders with one status."""
    return _some(orders.where((F.col("city") == city) & (F.col("status") == status)), limit, ordered)


def query_orders_by_date_range(
    orders: DataFrame,
    start_date: str = "2024-01-01",
    end_date: str = "2024-12-31",
    limit: int = 10,
    ordered: bool = True,
) -> DataFrame:
    """the orders of a period, both ends included."""
    return _some(orders.where(F.col("order_date").between(start_date, end_date)), limit, ordered)


def has_contact(contact_value: str) -> Column:
    return (F.col("customer_email") == contact_value) | (F.col("customer_phone") == contact_value)


def query_orders_by_email_or_phone(
    orders: DataFrame,
    contact_value: str = "user@example.com",
    limit: int = 10,
    ordered: bool = True,
) -> DataFrame:
    """the orders with this e-mail address or phone number."""
    return _some(orders.where(has_contact(contact_value)), limit, ordered)


def query_high_value_orders(
    orders: DataFrame, min_amount: float = 500.0, limit: int = 10
) -> DataFrame:
    """the orders of at least this amount, highest first."""
    # In cents, like the amounts, so that the comparison reaches the scan.
    least = Decimal(str(min_amount)).quantize(Decimal("0.01"), ROUND_CEILING)
    return (
        orders.where(F.col("amount") >= F.lit(least))
        .orderBy(F.desc("amount"), "order_id")
        .limit(limit)
    )
