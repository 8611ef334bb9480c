"""The tables of one installation."""

from pyspark.sql import DataFrame, SparkSession

from souqframe.schemas import (
    CLEAN_SCHEMA,
    DAILY_SALES_SCHEMA,
    JOB_LOG_SCHEMA,
    PRODUCT_SUMS_SCHEMA,
    QUARANTINE_SCHEMA,
    RAW_SCHEMA,
    RECORD_KEY,
    TOP_PRODUCTS_SCHEMA,
)
from souqframe.sources.raw_orders import read_orders_raw
from souqframe.sources.tables import KeyedTable
from souqframe.sources.watermarks import Watermarks


class Warehouse:
    """Raw, validated and quarantined orders, summary tables, watermarks and the job log."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.raw_path = f"{self.root}/orders_raw"
        self.job_log_path = f"{self.root}/job_logs"
        self.validated = KeyedTable(
            spark, f"{self.root}/orders_validated", CLEAN_SCHEMA, "order_id",
            tracked=("order_date", "amount", "at_ingested", "items_json"), buckets=buckets,
        )
        self.quarantine = KeyedTable(
            spark, f"{self.root}/orders_quarantine", QUARANTINE_SCHEMA, RECORD_KEY, buckets=buckets
        )
        self.daily_sales = KeyedTable(
            spark, f"{self.root}/mv_daily_sales_summary", DAILY_SALES_SCHEMA, "order_date", buckets=1
        )
        self.top_products = KeyedTable(
            spark, f"{self.root}/mv_top_products_summary", TOP_PRODUCTS_SCHEMA, "product_name", buckets=1
        )
        self.product_sums = KeyedTable(
            spark, f"{self.root}/mv_product_sums", PRODUCT_SUMS_SCHEMA, "product_name", buckets=1
        )
        self.watermarks = Watermarks(spark, f"{self.root}/mv_watermarks")

    def raw(self, id_run: str | None = None) -> DataFrame:
        """Raw orders, of one run or of all."""
        return read_orders_raw(self.spark, self.raw_path, id_run)

    def job_logs(self) -> DataFrame:
        return self.spark.read.schema(JOB_LOG_SCHEMA).parquet(self.job_log_path)

    def reset(self) -> None:
        """K9: empties the three order tables."""
        nothing = self.spark.createDataFrame([], RAW_SCHEMA)
        nothing.write.mode("overwrite").partitionBy("id_run").parquet(self.raw_path)
        self.validated.clear()
        self.quarantine.clear()
