"""The two summary tables and how they are kept up to date.

Both follow the changes that the order table notes with every upsert: what an order counted before is
taken off its old day and products, what it counts now is put on its new ones. So a refresh costs what
has changed, an order that comes again is never counted twice, and one that changes its day moves. How
far a summary has got is part of its own commit; a refresh that dies can be repeated.
"""

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souqframe.operators.reports import daily_sums, product_lines, product_sums, top_of_sums
from souqframe.plans.warehouse import Warehouse
from souqframe.schemas import DAILY_SALES_SCHEMA, PRODUCT_SUMS_SCHEMA
from souqframe.sources.workspace import workspace

DAILY_SALES = "daily_sales_summary"
TOP_PRODUCTS = "top_products_summary"
PRODUCTS_KEPT = 50


def get_last_watermark(warehouse: Warehouse, view: str) -> float:
    """K8: the last ingestion time a view has seen, 0 for a new one."""
    seen = warehouse.watermarks.read().where(F.col("mv_name") == view).first()
    return seen["last_at_ingested"] if seen else 0.0


def set_last_watermark(warehouse: Warehouse, view: str, at_ingested: float) -> None:
    """K8: notes the last ingestion time a view has seen; an earlier one than noted changes nothing."""
    warehouse.watermarks.note(view, at_ingested)


def signed_daily_sums(changes: DataFrame) -> DataFrame:
    """What the signed changes add to and take from each day."""
    put_in = F.col("sign") > 0
    return (
        changes.where(F.col("order_date").isNotNull())
        .groupBy("order_date")
        .agg(
            F.sum("sign").alias("inc_orders"),
            F.sum(F.when(put_in, F.col("amount")).otherwise(-F.col("amount"))).alias("inc_revenue"),
            F.max(F.when(put_in, F.col("at_ingested"))).alias("latest_ingested"),
        )
    )


def merge_daily_sums(view: DataFrame, sums: DataFrame, now: float) -> DataFrame:
    """K6: the view with the sums added; days without orders go."""
    return (
        view.unionByName(
            sums.select(
                "order_date",
                F.col("inc_orders").alias("total_orders"),
                F.col("inc_revenue").alias("total_revenue"),
                F.lit(now).alias("last_updated"),
            )
        )
        .groupBy("order_date")
        .agg(
            F.sum("total_orders").alias("total_orders"),
            F.sum("total_revenue").cast("decimal(28,2)").alias("total_revenue"),
            F.max("last_updated").alias("last_updated"),
        )
        .where(F.col("total_orders") > 0)
        .select(DAILY_SALES_SCHEMA.fieldNames())
    )


def _outcome(view: str, updated: int, incremental: bool) -> dict:
    return {
        "view_name": view,
        "status": "SUCCESS" if updated else "NO_NEW_DATA",
        "updated_documents": updated,
        "incremental": incremental,
    }


def _put_daily_sums(warehouse: Warehouse, sums: DataFrame, upto: int, add: bool) -> int:
    """Adds the sums to the view, or puts them in its place; gives the number of days. They hold orders up to a commit."""
    view = warehouse.daily_sales
    # A row per day, written down: the orders or changes are read once.
    folder = f"{workspace(warehouse.spark)}/sums"
    sums.write.parquet(folder)
    sums = warehouse.spark.read.schema(sums.schema).parquet(folder)
    updated, newest = sums.agg(F.count(F.lit(1)), F.max("latest_ingested")).first()
    before = view.read() if add else warehouse.spark.createDataFrame([], DAILY_SALES_SCHEMA)
    view.overwrite(merge_daily_sums(before, sums, time.time()), source_gen=upto)
    if newest is not None:
        set_last_watermark(warehouse, DAILY_SALES, newest)
    return updated


def refresh_daily_sales_summary(warehouse: Warehouse, incremental: bool = True) -> dict:
    """M1: brings the daily sums up to date, from the changes or, for a new view, from all orders."""
    orders, view = warehouse.validated, warehouse.daily_sales
    # Rows and number of the same commit: one that comes meanwhile belongs to the next refresh.
    stored, upto = orders.read_with_gen()
    done = view.source_gen()
    if upto == (done if incremental else 0):
        return _outcome(DAILY_SALES, 0, incremental)
    add = incremental and done > 0
    sums = signed_daily_sums(orders.signed_changes(done, upto)) if add else daily_sums(stored)
    return _outcome(DAILY_SALES, _put_daily_sums(warehouse, sums, upto, add), incremental)


def add_daily_changes(warehouse: Warehouse, changes: DataFrame) -> int:
    """M1 from a stream: adds signed changes, which bring the number of their commit, to the daily sums.

    The view's own commit says up to which commit it has counted. Changes of commits up to that one have
    come before, by this stream or by a refresh, and change nothing.
    """
    new = changes.where(F.col("gen") > warehouse.daily_sales.source_gen())
    upto = new.agg(F.max("gen")).first()[0]
    return 0 if upto is None else _put_daily_sums(warehouse, signed_daily_sums(new), upto, add=True)


def _add_product_changes(warehouse: Warehouse, changes: DataFrame, upto: int) -> None:
    """Adds what the changed orders' items sell more or less than before to the sums of their products."""
    folder = f"{workspace(warehouse.spark)}/products"
    product_sums(product_lines(changes, "sign"), "sign").write.parquet(folder)
    more = warehouse.spark.read.schema(PRODUCT_SUMS_SCHEMA).parquet(folder)
    stood = warehouse.product_sums.read().join(more.select("product_name"), "product_name", "left_semi")
    sums = stood.unionByName(more).groupBy("product_name").agg(
        *[
            F.sum(field.name).cast(field.dataType).alias(field.name)
            for field in PRODUCT_SUMS_SCHEMA
            if field.name != "product_name"
        ]
    )
    warehouse.product_sums.upsert(sums, newest_by=["product_name"], source_gen=upto)


def refresh_top_products_summary(warehouse: Warehouse, incremental: bool = True) -> dict:
    """M2: the fifty products sold most, cut from sums by product that follow the changes of the orders.

    An order that changes adds its new items and takes off its old ones, so a refresh costs what has
    changed and a look at the sums. Without `incremental` the sums are worked out anew.
    """
    orders, sums, view = warehouse.validated, warehouse.product_sums, warehouse.top_products
    (stored, upto), now = orders.read_with_gen(), time.time()
    done = sums.source_gen()
    if incremental and upto and upto == done == view.source_gen():
        return _outcome(TOP_PRODUCTS, 0, incremental)
    if incremental and done:
        if upto > done:
            _add_product_changes(warehouse, orders.signed_changes(done, upto), upto)
    else:
        folder = f"{workspace(warehouse.spark)}/products"
        product_sums(product_lines(stored)).write.parquet(folder)
        sums.overwrite(warehouse.spark.read.schema(PRODUCT_SUMS_SCHEMA).parquet(folder), source_gen=upto)
    top = top_of_sums(sums.read().where(F.col("lines") > 0), PRODUCTS_KEPT)
    view.overwrite(top.withColumn("last_updated", F.lit(now)), source_gen=upto)
    updated = view.row_count()
    if updated:
        set_last_watermark(warehouse, TOP_PRODUCTS, now)
    return _outcome(TOP_PRODUCTS, updated, incremental)


def refresh_all_materialized_views(warehouse: Warehouse, incremental: bool = True) -> dict:
    """M3: both views."""
    return {
        DAILY_SALES: refresh_daily_sales_summary(warehouse, incremental),
        TOP_PRODUCTS: refresh_top_products_summary(warehouse, incremental),
        "timestamp": time.time(),
    }


def get_materialized_view_data(warehouse: Warehouse, view: str, limit: int = 20) -> DataFrame:
    """The first rows of a view by its key."""
    tables = {DAILY_SALES: warehouse.daily_sales, TOP_PRODUCTS: warehouse.top_products}
    if view not in tables:
        raise ValueError(f"no view '{view}'; there are {', '.join(tables)}")
    return tables[view].read().orderBy(tables[view].key).limit(limit)
