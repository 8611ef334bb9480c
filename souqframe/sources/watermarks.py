"""How far the views have got (K8)."""

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souqframe.schemas import WATERMARK_SCHEMA
from souqframe.sources.workspace import exists


class Watermarks:
    """A list that is only added to. A view's watermark is the highest ingestion time noted for it, so a write is
    one small file, and it does not matter which of two writers comes first."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def note(self, view: str, at_ingested: float) -> None:
        row = [(view, float(at_ingested), time.time())]
        self.spark.createDataFrame(row, WATERMARK_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        """One row for each view."""
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], WATERMARK_SCHEMA)
        noted = self.spark.read.schema(WATERMARK_SCHEMA).parquet(self.path)
        return noted.groupBy("mv_name").agg(
            F.max("last_at_ingested").alias("last_at_ingested"), F.max("updated_at").alias("updated_at")
        )
