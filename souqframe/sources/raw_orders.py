"""Reading raw orders (S1-S7) and appending them to the raw table."""

import time
from math import ceil
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from souqframe.schemas import ENVELOPE_FIELDS, ORDER_FIELDS, RAW_SCHEMA
from souqframe.sources.records import leading_records, read_records
from souqframe.sources.workspace import exists, shuffles_freed, workspace

# Doubled quotes inside a quoted field are how the order files carry JSON.
_QUOTES = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
_CSV = {"header": True, **_QUOTES}
BROKEN = "_broken"  # the text of a record that has more or fewer fields than the header
POSITION = "_position"  # where a record stands in its file, if that is known


def read_orders_raw(spark: SparkSession, path: str, id_run: str | None = None) -> DataFrame:
    """The raw table, or one run of it (a partition, so the others are not read)."""
    raw = spark.read.schema(RAW_SCHEMA).parquet(path)
    return raw if id_run is None else raw.where(F.col("id_run") == id_run)


def read_order_csv(spark: SparkSession, path: str, multi_line: bool = False, broken: bool = False) -> DataFrame:
    """An order file as text columns, found by the names in its header.

    Nothing is inferred, so the file is read once. A field that is empty or absent is an empty text.
    With `multi_line`, quoted fields may hold line breaks: see `read_records`. With `broken`, a record
    that has more or fewer fields than the header also comes as text; it is read as far as it goes.
    """
    if "*" not in path and not exists(spark, path):
        raise FileNotFoundError(f"no order file at {path}")
    header = spark.read.options(**_CSV).csv(path).columns
    if not header:
        raise ValueError(f"{path} has no header")
    if multi_line:
        return _parsed(read_records(spark, path), header, broken)
    schema = ", ".join(f"`{name}` string" for name in [*header, *([BROKEN] if broken else [])])
    rows = (
        spark.read.schema(schema)
        .options(**_CSV, columnNameOfCorruptRecord=BROKEN, enforceSchema=False)
        .csv(path)
    )
    return rows.select(
        *_fields(header), F.col("_metadata.file_path").alias("file_source"), *([BROKEN] if broken else [])
    )


def _fields(header: list[str], of: str = "") -> list[Column]:
    return [
        (F.coalesce(F.col(f"{of}`{name}`"), F.lit("")) if name in header else F.lit("")).alias(name)
        for name in ORDER_FIELDS
    ]


def _parsed(records: DataFrame, header: list[str], broken: bool) -> DataFrame:
    """The fields of records that come as text, with file and position."""
    schema = ", ".join(f"`{name}` string" for name in [*header, BROKEN])
    options = {**_QUOTES, "columnNameOfCorruptRecord": BROKEN}
    parsed = F.from_csv("record", schema, {key: str(value) for key, value in options.items()})
    return records.withColumn("_parsed", parsed).select(
        *_fields(header, "_parsed."),
        "file_source",
        POSITION,
        *([F.col(f"_parsed.{BROKEN}").alias(BROKEN)] if broken else []),
    )


def with_envelope(
    rows: DataFrame, id_run: str, engine_used: str = "pyspark", at_ingested: float | None = None
) -> DataFrame:
    """The envelope around the nested record, with one ingestion time for the whole run.

    Row numbers rise through each file but have gaps; see `exact_row_numbers`.
    """
    number = F.col(POSITION) if POSITION in rows.columns else F.monotonically_increasing_id()
    return rows.select(
        F.lit(time.time() if at_ingested is None else at_ingested).alias("at_ingested"),
        F.lit(engine_used).alias("engine_used"),
        "file_source",
        F.lit(id_run).alias("id_run"),
        number.alias("number_row_source"),
        F.struct(*ORDER_FIELDS).alias("record_raw"),
    )


def exact_row_numbers(raw: DataFrame) -> DataFrame:
    """S6, exact: rows numbered 1, 2, 3, ... within each file.

    The rising numbers are written down first, so that what follows does not depend on how a second
    scan would split the files. Their upper bits name the task that read the row; a running sum over
    the tasks of a file, one small row for each, gives where every task's rows begin.
    """
    spark, folder = raw.sparkSession, workspace(raw.sparkSession)
    raw.withColumn("_task", F.shiftright("number_row_source", 33)).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    earlier_tasks = (
        Window.partitionBy("file_source").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        rows.groupBy("file_source", "_task")
        .agg(F.count("*").alias("_rows"), F.min("number_row_source").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier_tasks), F.lit(0)))
        .drop("_rows")
    )
    # As a written table its size is known, so it is broadcast only if it is small.
    starts.write.parquet(f"{folder}/starts")
    return (
        rows.join(spark.read.parquet(f"{folder}/starts"), ["file_source", "_task"])
        .withColumn("number_row_source", F.expr("number_row_source - _first + _before + 1"))
        .select(*ENVELOPE_FIELDS, "record_raw")
    )


def append_raw(raw: DataFrame, path: str) -> int:
    """K1: adds raw orders to the raw table, one folder for each run; gives the rows written."""
    written = Observation()
    with shuffles_freed(raw.sparkSession):
        raw.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("append").partitionBy(
            "id_run"
        ).parquet(path)
    return written.get["rows"]


def load_csv_to_raw(
    spark: SparkSession,
    file_path: str,
    raw_path: str,
    id_run: str | None = None,
    batch_size: int = 1000,
    exact_rows: bool = False,
    multi_line: bool = False,
) -> dict:
    """Appends an order file to the raw table without cleaning anything.

    Records with more or fewer fields than the header are loaded as far as they go, counted as `broken`,
    and their text is stored next to the raw table, by run.
    `batch_size` only counts the batches reported; Spark sizes its own writes.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be greater than zero")
    id_run = id_run or str(uuid4())
    started = time.perf_counter()
    rows, seen = read_order_csv(spark, file_path, multi_line, broken=True), Observation()
    counted = rows.observe(seen, F.count(BROKEN).alias("broken"))
    raw = with_envelope(counted, id_run)
    loaded = append_raw(exact_row_numbers(raw) if exact_rows else raw, raw_path)
    broken = seen.get["broken"]
    if broken:
        store_broken(rows, id_run, broken_path(raw_path))
    seconds = time.perf_counter() - started
    return {
        "id_run": id_run,
        "loaded_raw": loaded,
        "broken": broken,
        "batches": ceil(loaded / batch_size),
        "seconds_elapsed": seconds,
        "throughput": loaded / seconds if seconds > 0 else 0,
        "batch_size": batch_size,
    }


def count_order_csv(spark: SparkSession, path: str, expected_rows: int | None = None) -> dict:
    """Counts an order file and checks the count where one is expected."""
    started = time.perf_counter()
    rows = read_order_csv(spark, path).count()
    seconds = time.perf_counter() - started
    if expected_rows is not None and rows != expected_rows:
        raise RuntimeError(f"expected {expected_rows:,} rows but found {rows:,}")
    return {"rows": rows, "seconds": seconds, "throughput": rows / seconds if seconds > 0 else 0}


def broken_path(raw_path: str) -> str:
    """Where the texts of a raw table's broken records are."""
    return f"{raw_path.rstrip('/')}_broken"


def store_broken(rows: DataFrame, id_run: str, path: str) -> None:
    """The text of broken records, one folder for each run. Reads the file once more, so only if there are some."""
    # Only a record that is parsed as a whole tells whether it is broken.
    parsed = F.length(F.concat(*ORDER_FIELDS)) >= 0
    rows.where(parsed & F.col(BROKEN).isNotNull()).select(
        "file_source", F.col(BROKEN).alias("record"), F.lit(id_run).alias("id_run")
    ).write.mode("append").partitionBy("id_run").parquet(path)


def first_rows(raw: DataFrame, rows: int) -> DataFrame:
    """The first rows of a file as text columns, from raw orders with exact row numbers.

    A filter on the row number, so nothing is sorted or sent through one task.
    """
    if rows <= 0:
        raise ValueError("rows must be greater than zero")
    return raw.where(F.col("number_row_source") <= rows).select("record_raw.*")


def write_order_csv(orders: DataFrame, path: str) -> None:
    """Orders as CSV files that `read_order_csv` reads back as they were, outer blanks included."""
    written = orders.write.mode("overwrite").options(
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    with shuffles_freed(orders.sparkSession):
        written.csv(path)


def create_sample(
    spark: SparkSession, input_file: str, output_path: str, rows: int, exactly: bool = False
) -> int:
    """Copies the first rows of an order file, header included.

    With `exactly`, a file that has fewer rows is an error and nothing is written. Only the first splits
    of the file are read, as many as it takes: see `leading_records`.
    """
    if rows <= 0:
        raise ValueError("rows must be greater than zero")
    header = spark.read.options(**_CSV).csv(input_file).columns
    records, found = leading_records(spark, input_file, rows)
    if exactly and found < rows:
        raise RuntimeError(f"expected {rows:,} rows but found only {found:,}")
    sample, written = _parsed(records, header, broken=False).select(*ORDER_FIELDS), Observation()
    write_order_csv(sample.observe(written, F.count(F.lit(1)).alias("rows")), output_path)
    return written.get["rows"]
