"""Raw orders derived from the star-schema tables, with known faults built in.

The order files this engine is for are not part of the test data, so tests, checks and the bench take
their raw orders from here. Which fault an order has depends on its key alone.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souqframe.functions.text import ARABIC_DIGITS, WESTERN_DIGITS
from souqframe.schemas import ORDER_FIELDS

FIRST_INGESTED = 1704067200


def _arabic(text: Column) -> Column:
    return F.translate(text, WESTERN_DIGITS, ARABIC_DIGITS)


def _pick(selector: Column, values: list) -> Column:
    """values[selector], as one expression."""
    choice = F.lit(None).cast("string")
    for position, value in reversed(list(enumerate(values))):
        value = F.lit(value) if isinstance(value, str) else value
        choice = F.when(selector == position, value).otherwise(choice)
    return choice


def _two_places(value: Column) -> Column:
    """The same text as `format_string("%.2f", value)`, which takes several times as long."""
    rounded = value.try_cast("decimal(38,2)").cast("string")
    # What rounds to zero keeps its sign there, and nulls and numbers that are none have a name.
    return F.coalesce(F.when(F.abs(value) >= 0.01, rounded), F.format_string("%.2f", value))


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its items as JSON text: an order is one record, however many lines it has.

    Numbers and names go through the shuffles, and the texts are made behind them.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity"
    )
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_retailprice")
    quantity = F.col("l_quantity").cast("long").cast("string")
    item = F.concat(
        F.lit('{"sku":"P-'),
        F.col("l_partkey").cast("string"),
        F.lit('","name":"'),
        F.col("p_name"),
        F.lit('","qty":"'),
        F.when(F.col("l_orderkey") % 8 == 0, _arabic(quantity)).otherwise(quantity),
        F.lit('","unit_price":"'),
        _two_places(F.col("p_retailprice")),
        F.lit('","total":"'),
        _two_places(F.col("l_quantity") * F.col("p_retailprice")),
        F.lit('"}'),
    )
    in_order = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "item")))
    return (
        lines.where(F.col("l_orderkey").isNotNull())
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .drop("p_partkey")
        .repartition("l_orderkey")
        .withColumn("item", item)
        .where(F.col("item").isNotNull())
        .groupBy("l_orderkey")
        .agg(F.concat(F.lit("["), F.array_join(in_order["item"], ","), F.lit("]")).alias("items"))
    )


def dirty_order_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seventeen text fields, with `number_row_source` and `at_ingested`."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_name", "c_nationkey"
    )
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    # The items come last: they are the most to move.
    joined = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(_items(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    )

    k, ck = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    name = F.concat(F.lit("ORD-"), k.cast("string"))
    p8 = F.lpad(((F.col("o_custkey") * 7919) % 100000000).cast("string"), 8, "0")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    price = _two_places(F.col("o_totalprice"))
    fields = {
        "order_id": F.when(k % 401 == 0, "")
        .when(k % 97 == 0, F.concat(F.lit("  "), name, F.lit(" ")))
        .otherwise(name),
        "customer_id": F.when(k % 53 == 0, "").otherwise(F.concat(F.lit("CUST-"), ck)),
        "customer_name": F.concat("c_name", F.lit("  X")),
        "customer_phone": F.when(k % 61 == 0, "123").otherwise(
            _pick(
                k % 5,
                [
                    F.concat(F.lit("+967 7"), p8),
                    F.concat(F.lit("009677"), p8),
                    F.concat(F.lit("07"), p8),
                    F.concat(F.lit("7-"), p8),
                    _arabic(F.concat(F.lit("07"), p8)),
                ],
            )
        ),
        "customer_email": F.when(k % 71 == 0, "no-at-sign")
        .when(k % 4 == 0, F.concat(F.lit(" user"), ck, F.lit("..x@@example.com")))
        .otherwise(F.concat(F.lit("user"), ck, F.lit("@example.com"))),
        "city": F.col("n_name"),
        "district": F.concat(F.lit("D"), (k % 7).cast("string")),
        "delivery_type": F.lit("Standard"),
        "payment_method": F.lit("Cash"),
        "payment_status": _pick(k % 3, ["PAID", "pending", "Confirmed"]),
        "currency": _pick(k % 5, ["YER", "ريال يمني", "ر.ي", "YER ", "USD"]),
        "status": _pick(k % 6, ["DELIVERED", "confirmed", "pending", "Shipped", "مؤكد", "returned"]),
        "order_date": F.when(k % 103 == 0, F.lit(None))
        .when(k % 89 == 0, "2024-02-30")
        .when(k % 83 == 0, "30/02/2024")
        .otherwise(
            _pick(
                k % 6,
                [
                    iso,
                    F.date_format("o_orderdate", "dd/MM/yyyy"),
                    F.date_format("o_orderdate", "dd-MM-yyyy"),
                    F.date_format("o_orderdate", "yyyy/MM/dd"),
                    F.concat(iso, F.lit("T10:11:12")),
                    _arabic(iso),
                ],
            )
        ),
        "delivery_cost": F.when(k % 43 == 0, "-500")
        .when(k % 47 == 0, "free")
        .otherwise(
            _pick(
                k % 9,
                ["1500", "١٠٠٠ ريال", "خمسة", "2,000", "1000 YER", "0", "صفر", "١٬٥٠٠٫٥", ""],
            )
        ),
        "payment_amount": F.concat(price, F.lit(" YER")),
        "total_amount": price,
        "items_json": F.when(k % 59 == 0, "{invalid_json_corrupted")
        .when(k % 67 == 0, "[]")
        .otherwise(F.coalesce("items", F.lit("[]"))),
    }
    return joined.select(
        *[fields[field].alias(field) for field in ORDER_FIELDS],
        k.alias("number_row_source"),
        (k + FIRST_INGESTED).cast("double").alias("at_ingested"),
    )


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as raw orders: envelope and nested record."""
    return dirty_order_fields(spark, sf_dir).select(
        "at_ingested",
        F.lit("pyspark").alias("engine_used"),
        F.lit("orders.parquet").alias("file_source"),
        F.lit("derived-orders").alias("id_run"),
        "number_row_source",
        F.struct(*ORDER_FIELDS).alias("record_raw"),
    )
