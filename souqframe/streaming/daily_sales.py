"""The daily sums kept up to date by a stream (M1)."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from souqframe.plans.views import add_daily_changes
from souqframe.plans.warehouse import Warehouse
from souqframe.sources.workspace import make_folder


def change_stream(warehouse: Warehouse) -> DataFrame:
    """The changes of the order table as a stream: what was put in (sign 1) and taken out (-1), with the commit.

    A commit's changes appear as one folder, after the commit, so a micro-batch has them all or none.
    """
    orders = warehouse.validated
    changes = f"{orders.path}/changes"
    make_folder(warehouse.spark, changes)  # nothing stored yet
    schema = T.StructType([*orders.change_schema.fields, T.StructField("gen", T.LongType())])
    return warehouse.spark.readStream.schema(schema).parquet(changes)


def stream_daily_sales(
    warehouse: Warehouse, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Adds the changes of every new commit of the order table to the daily sums.

    Only changed rows are read, and of them the sums by day go into the view. A micro-batch that runs
    twice, or whose commits a refresh has counted meanwhile, changes nothing. By default it takes what
    is there and stops; pass a `trigger` such as `{"processingTime": "1 minute"}` to keep it running.
    """

    def add(batch: DataFrame, _batch_id: int) -> None:
        add_daily_changes(warehouse, batch)

    return (
        change_stream(warehouse)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
