"""The five reports over accepted orders (G1-G6) and the daily sums."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souqframe.functions.amounts import rounded_average
from souqframe.functions.text import arabic_to_western

# What a product without a name is called, and how its numbers have to be written.
UNNAMED_PRODUCT = "منتج غير معروف"
INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# The names a line item may use, preferred ones first.
NAME_FIELDS = ["name", "product_name", "item_name"]
QUANTITY_FIELDS = ["qty", "quantity"]
REVENUE_FIELDS = ["total", "price", "unit_price"]

_ITEMS = "array<struct<{}>>".format(
    ",".join(f"{name}:string" for name in NAME_FIELDS + QUANTITY_FIELDS + REVENUE_FIELDS)
)

MOST = 2**63 - 1


def _money(total: Column) -> Column:
    return F.round(total, 2).cast("double")


def _sales_by(orders: DataFrame, key: str, total: str) -> DataFrame:
    amount = F.sum("amount")
    rows = F.count(F.lit(1))
    return orders.groupBy(key).agg(
        rows.alias("total_orders"),
        _money(amount).alias(total),
        rounded_average(amount, rows).alias("avg_order_value"),
    )


def get_sales_by_city(orders: DataFrame) -> DataFrame:
    """G1: orders, revenue and average by city, highest revenue first."""
    return _sales_by(orders, "city", "total_revenue").orderBy(F.desc("total_revenue"), "city")


def product_lines(orders: DataFrame, *also: str) -> DataFrame:
    """Product, quantity and revenue of every line item, with the columns `also` of its order."""

    def first_filled(line: Column, names: list[str]) -> Column:
        return F.coalesce(*[F.nullif(line[name], F.lit("")) for name in names])

    items = F.from_json("items_json", _ITEMS, {"allowSingleQuotes": "false"})
    line = F.col("line")
    quantity = arabic_to_western(first_filled(line, QUANTITY_FIELDS))
    revenue = arabic_to_western(first_filled(line, REVENUE_FIELDS))
    return (
        orders.where(F.col("items_json").rlike(r"^\s*\["))
        .select(F.explode(items).alias("line"), *also)
        .where(line.isNotNull())
        .select(
            *also,
            F.coalesce(first_filled(line, NAME_FIELDS), F.lit(UNNAMED_PRODUCT)).alias("product_name"),
            F.coalesce(
                F.when(quantity.rlike(INTEGER_PATTERN), F.trim(quantity).try_cast("decimal(28,0)")), F.lit(1)
            ).alias("quantity"),
            F.coalesce(
                F.when(revenue.rlike(NUMBER_PATTERN), F.trim(revenue).try_cast("decimal(28,6)")),
                F.lit(0).cast("decimal(28,6)"),
            ).alias("revenue"),
        )
    )


def product_sums(lines: DataFrame, sign: str | None = None) -> DataFrame:
    """Lines, quantity and revenue by product; with `sign`, a column of 1 and -1, what they add and take off."""

    def signed(value: Column | str) -> Column:
        return F.sum(F.when(F.col(sign) < 0, -F.col(value)).otherwise(F.col(value))) if sign else F.sum(value)

    return lines.groupBy("product_name").agg(
        (F.sum(sign) if sign else F.count(F.lit(1))).cast("long").alias("lines"),
        signed("quantity").cast("decimal(38,0)").alias("quantity"),
        signed("revenue").cast("decimal(38,6)").alias("revenue"),
    )


def _sold(sums: DataFrame) -> DataFrame:
    """Quantity and revenue of each product. A quantity above the largest long is given as that."""
    return sums.select(
        "product_name",
        F.least("quantity", F.lit(MOST).cast("decimal(38,0)")).cast("long").alias("total_quantity_sold"),
        _money(F.col("revenue")).alias("total_revenue"),
    )


def top_of_sums(sums: DataFrame, limit: int) -> DataFrame:
    """The products sold most, from their sums."""
    return _sold(sums).orderBy(F.desc("total_quantity_sold"), "product_name").limit(limit)


def product_sales(orders: DataFrame) -> DataFrame:
    """What every product sold, over every line item."""
    return _sold(product_sums(product_lines(orders)))


def get_top_products(orders: DataFrame, limit: int = 10) -> DataFrame:
    """The products sold most, over every line item."""
    return top_of_sums(product_sums(product_lines(orders)), limit)


def get_top_customers(orders: DataFrame, limit: int = 10) -> DataFrame:
    """The customers that spent most."""
    return (
        _sales_by(orders, "customer_id", "total_spent")
        .orderBy(F.desc("total_spent"), "customer_id")
        .limit(limit)
    )


def get_sales_by_period(orders: DataFrame) -> DataFrame:
    """Orders, revenue and average by day, last day first."""
    return _sales_by(orders, "order_date", "total_revenue").orderBy(F.desc("order_date"))


def get_orders_by_status(orders: DataFrame) -> DataFrame:
    """Orders and revenue by status, most frequent first."""
    return (
        orders.groupBy("status")
        .agg(F.count(F.lit(1)).alias("order_count"), _money(F.sum("amount")).alias("total_amount"))
        .orderBy(F.desc("order_count"), "status")
    )


REPORTS_REGISTRY: dict[str, Callable[[DataFrame], DataFrame]] = {
    "sales_by_city": get_sales_by_city,
    "top_products": get_top_products,
    "top_customers": get_top_customers,
    "sales_by_period": get_sales_by_period,
    "orders_by_status": get_orders_by_status,
}


def run_report(report_name: str, orders: DataFrame) -> DataFrame:
    """A report by its name."""
    if report_name not in REPORTS_REGISTRY:
        raise ValueError(f"no report '{report_name}'; there are {', '.join(REPORTS_REGISTRY)}")
    return REPORTS_REGISTRY[report_name](orders)


def newer_than(orders: DataFrame, watermark: float) -> DataFrame:
    """the orders ingested after the watermark; all of them while there is none (0)."""
    return orders.where(F.col("at_ingested") > watermark) if watermark > 0 else orders


def daily_sums(orders: DataFrame, watermark: float = 0.0) -> DataFrame:
    """G9 over F10 and F11: orders, revenue and last ingestion by day; orders without a day are out."""
    return (
        newer_than(orders, watermark)
        .where(F.col("order_date").isNotNull())
        .groupBy("order_date")
        .agg(
            F.count(F.lit(1)).alias("inc_orders"),
            F.sum("amount").alias("inc_revenue"),
            F.max("at_ingested").alias("latest_ingested"),
        )
    )


def system_counts(validated: DataFrame, quarantine: DataFrame) -> DataFrame:
    """How many orders are stored where, in one row."""
    both = validated.select(F.lit(1).alias("v")).unionAll(quarantine.select(F.lit(0).alias("v")))
    return both.agg(
        F.count_if(F.col("v") == 1).alias("validated_orders_count"),
        F.count_if(F.col("v") == 0).alias("quarantine_orders_count"),
        F.count(F.lit(1)).alias("total_processed_orders"),
    ).withColumn("system_health", F.lit("HEALTHY"))
