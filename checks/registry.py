"""Every operator as a query over the given tables: (spark, folder of tables) -> DataFrame."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.dirty_orders import dirty_order_fields, dirty_orders
from souqframe import functions as T
from souqframe.functions.text import ARABIC_DIGITS, WESTERN_DIGITS
from souqframe.operators import cleaning, lookups, outcomes, reports, validation
from souqframe.plans import elt, jobs, views
from souqframe.plans.warehouse import Warehouse
from souqframe.schemas import ORDER_FIELDS, RECORD_KEY
from souqframe.sources import layout, raw_orders
from souqframe.sources.workspace import shuffles_freed, workspace
from souqframe.streaming.daily_sales import stream_daily_sales

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.apply_all_quality_rules(dirty_orders(spark, sf_dir))


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes.validated_orders(_cleaned(spark, sf_dir))


def _stored(df: DataFrame) -> DataFrame:
    """Written down, for queries that need the same rows several times."""
    path = f"{workspace(df.sparkSession)}/rows"
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _new_warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, f"{workspace(spark)}/warehouse")


def _second_batch(accepted: DataFrame) -> DataFrame:
    """Every third order again: later, with another day and amount."""
    k = F.col("number_row_source")
    day = F.lpad((k % 28 + 1).cast("string"), 2, "0")
    return accepted.where(k % 3 == 0).withColumns(
        {
            "order_date": F.concat(F.lit("2030-01-"), day),
            "amount": (F.col("amount") + 1).cast("decimal(28,2)"),
            "at_ingested": F.col("at_ingested") + 100000000,
        }
    )


# --- helpers, sources ------------------------------------------------------------------------------


@query
def helper_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1-H5, P5 over the customers."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    key = F.col("c_custkey")
    balance = F.col("c_acctbal").cast("decimal(18,2)").cast("string")
    arabic = F.translate(balance, WESTERN_DIGITS, ARABIC_DIGITS)
    currency = (
        F.when(key % 4 == 0, " y.R. ")
        .when(key % 4 == 1, "ريال  سعودي")
        .when(key % 4 == 2, "ر.ي")
        .otherwise(F.col("c_mktsegment"))
    )
    suffix = F.when(key % 3 == 0, " yer x").when(key % 3 == 1, " ريال يمني").otherwise(" Y.R. ")
    return customer.select(
        "c_custkey",
        T.clean_text(F.concat("c_name", F.lit("  \tX "))).alias("clean_text"),
        T.arabic_to_western(arabic).alias("arabic_to_western"),
        T.normalize_numeric_text(
            F.concat(F.lit(" "), F.translate(arabic, ".", "٫"), F.lit("٬٠,٠ "))
        ).alias("normalize_numeric_text"),
        T.normalize_currency_text(currency).alias("normalize_currency_text"),
        T.remove_currency(F.concat(key.cast("string"), suffix)).alias("remove_currency"),
        T.numeric_amount(F.when(key % 5 == 0, "n/a").otherwise(F.format_number("c_acctbal", 2)))
        .cast("double")
        .alias("numeric_amount"),
    )


@query
def raw_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders appended to the raw table, read back and flattened."""
    path = f"{workspace(spark)}/orders_raw"
    raw_orders.append_raw(dirty_orders(spark, sf_dir), path)
    return validation.flatten_raw(raw_orders.read_orders_raw(spark, path, "derived-orders"))


def _order_csv(spark: SparkSession, sf_dir: str) -> str:
    path = f"{workspace(spark)}/orders.csv"
    raw_orders.write_order_csv(dirty_order_fields(spark, sf_dir).select(ORDER_FIELDS), path)
    return path


@query
def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order fields wrapped as raw orders of one run."""
    fields = dirty_order_fields(spark, sf_dir).select(ORDER_FIELDS).withColumn("file_source", F.lit("orders.csv"))
    wrapped = raw_orders.with_envelope(fields, "wrapped")
    return wrapped.select("id_run", "file_source", "engine_used", "record_raw.*")


@query
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV, loaded into the raw table, read back."""
    path = f"{workspace(spark)}/orders_raw"
    loaded = raw_orders.load_csv_to_raw(spark, _order_csv(spark, sf_dir), path)
    return raw_orders.read_orders_raw(spark, path, loaded["id_run"]).select("record_raw.*")


@query
def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with line breaks and quotes in their names, written as CSV and read split by split."""
    k = F.col("number_row_source")
    longer = F.concat("customer_name", F.lit('\nline "two", of '), k.cast("string"))
    fields = dirty_order_fields(spark, sf_dir)
    fields = fields.withColumn("customer_name", F.when(k % 3 == 0, longer).otherwise(F.col("customer_name")))
    folder = workspace(spark)
    raw_orders.write_order_csv(fields.select(ORDER_FIELDS), f"{folder}/orders.csv")
    loaded = raw_orders.load_csv_to_raw(spark, f"{folder}/orders.csv", f"{folder}/raw", multi_line=True)
    return raw_orders.read_orders_raw(spark, f"{folder}/raw", loaded["id_run"]).select("record_raw.*")


@query
def broken_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with too few or too many fields, kept apart; the others are loaded all the same."""
    k = F.col("o_orderkey").cast("string")
    few = F.concat(F.lit("ORD-"), k, F.lit(",CUST,only"))
    many = F.concat(F.lit("ORD-"), k, F.lit(",x" * 18))
    right = F.concat(F.lit("ORD-"), k, F.lit(",y" * 16))
    line = F.when(F.col("o_orderkey") % 50 == 0, few).when(F.col("o_orderkey") % 77 == 0, many).otherwise(right)
    folder, orders = workspace(spark), spark.read.parquet(f"{sf_dir}/orders.parquet")
    # One column, named like the whole header and written as it is.
    orders.select(line.alias(",".join(ORDER_FIELDS))).write.options(header=True, quote="\0", sep="\1").csv(
        f"{folder}/orders.csv"
    )
    loaded = raw_orders.load_csv_to_raw(spark, f"{folder}/orders.csv", f"{folder}/raw")
    kept = spark.read.parquet(raw_orders.broken_path(f"{folder}/raw"))
    return kept.select(
        "record",
        F.lit(loaded["loaded_raw"]).cast("long").alias("loaded"),
        F.lit(loaded["broken"]).cast("long").alias("broken"),
    )


@query
def csv_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the rows of an order file."""
    counted = raw_orders.count_order_csv(spark, _order_csv(spark, sf_dir))
    return spark.createDataFrame([(counted["rows"],)], "n_rows long")


@query
def csv_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of an order file that is in order, copied."""
    folder = workspace(spark)
    ordered = dirty_order_fields(spark, sf_dir).orderBy("number_row_source")
    raw_orders.write_order_csv(ordered.select(ORDER_FIELDS), f"{folder}/orders.csv")
    raw_orders.create_sample(spark, f"{folder}/orders.csv", f"{folder}/sample.csv", 1000, exactly=True)
    return raw_orders.read_order_csv(spark, f"{folder}/sample.csv").select("order_id", "items_json")


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = dirty_orders(spark, sf_dir).orderBy("number_row_source")
    rows = ordered.select("record_raw.*", "file_source")
    return raw_orders.exact_row_numbers(raw_orders.with_envelope(rows, "numbered"))


@query
def exact_row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows numbered 1, 2, 3, ... in the order in which they stand."""
    return _numbered(spark, sf_dir).select("number_row_source", "record_raw.order_id")


@query
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first thousand rows."""
    return raw_orders.first_rows(_numbered(spark, sf_dir), 1000).select("order_id", "items_json")


# --- the nine rules --------------------------------------------------------------------------------


def _after_rule(number: int, fields: list[str]) -> Query:
    """The values after the first `number` rules."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        flat = validation.flatten_raw(dirty_orders(spark, sf_dir))
        return cleaning.apply_rules(flat, cleaning.NINE_RULES[:number]).select(
            "number_row_source", *fields
        )

    return run


for _number, _rule in enumerate(cleaning.NINE_RULES, start=1):
    _fields = [repair.field for repair in _rule.repairs]
    _QUERIES[_rule.name] = _after_rule(_number, _fields + ([cleaning.TOTAL_ERROR] if _rule.prepare else []))


@query
def audit_trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: every correction with its place in the trail."""
    return _cleaned(spark, sf_dir).select(
        "number_row_source", F.posexplode("corrections").alias("position", "c")
    ).select("number_row_source", "position", "c.*")


@query
def correction_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6: the entry for a changed balance of every customer."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    entry = T.correction_struct("balance", F.col("c_custkey"), F.col("c_custkey") + 1, "RULE")
    return customer.select("c_custkey", entry.alias("c")).select("c_custkey", "c.*")


# --- validation, classification, outcomes ----------------------------------------------------------


@query
def validation_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1-V8: every reason with its place in the list."""
    return _cleaned(spark, sf_dir).select(
        "number_row_source", F.posexplode("quarantine_reasons").alias("position", "reason")
    )


@query
def quality_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome of every order."""
    return _cleaned(spark, sf_dir).select(
        "number_row_source",
        "quality_status",
        F.size("corrections").alias("corrections"),
        F.size("quarantine_reasons").alias("reasons"),
        F.col("amount").cast("double").alias("amount"),
    )


@query
def validated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6."""
    return _accepted(spark, sf_dir).select("quality_status", *ORDER_FIELDS)


@query
def quarantined_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7, with the quarantine's key."""
    rejected = outcomes.quarantined_orders(_cleaned(spark, sf_dir))
    return outcomes.with_record_key(rejected).select(RECORD_KEY, *ORDER_FIELDS)


@query
def correction_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8."""
    return outcomes.correction_examples(_cleaned(spark, sf_dir)).withColumn(
        "corrections", F.size("corrections")
    )


@query
def quarantine_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9."""
    return outcomes.quarantine_examples(_cleaned(spark, sf_dir)).select(
        "order_id", "customer_id", "quality_status", F.array_join("quarantine_reasons", ",").alias("reasons")
    )


@query
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G7."""
    return outcomes.quality_summary(_cleaned(spark, sf_dir))


@query
def quarantine_reason_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G8."""
    return outcomes.quarantine_reason_summary(_cleaned(spark, sf_dir))


@query
def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts taken while the cleaned orders are written."""
    counts = elt.clean_to_table(dirty_orders(spark, sf_dir), f"{workspace(spark)}/cleaned")
    return spark.createDataFrame(
        [counts], "raw long, processed long, validated long, quarantined long"
    )


# --- reports ---------------------------------------------------------------------------------------


def _report(name: str) -> Query:
    return lambda spark, sf_dir: reports.run_report(name, _accepted(spark, sf_dir))


for _name in reports.REPORTS_REGISTRY:
    _QUERIES[_name] = _report(_name)


# --- lookups ---------------------------------------------------------------------------------------


def _found(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id", "customer_id", "city", "status", "order_date", "customer_email", "customer_phone",
        F.col("amount").cast("double").alias("amount"),
    )


@query
def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1."""
    return _found(lookups.query_orders_by_customer(_accepted(spark, sf_dir), "CUST-7"))


@query
def orders_by_city_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2."""
    return _found(
        lookups.query_orders_by_city_and_status(_accepted(spark, sf_dir), "NATION_3", "DELIVERED")
    )


@query
def orders_by_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3."""
    return _found(
        lookups.query_orders_by_date_range(_accepted(spark, sf_dir), "1997-01-01", "1997-03-31")
    )


@query
def orders_by_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4."""
    return _found(
        lookups.query_orders_by_email_or_phone(_accepted(spark, sf_dir), "user7@example.com")
    )


@query
def high_value_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5."""
    return _found(lookups.query_high_value_orders(_accepted(spark, sf_dir)))


# --- stored tables ---------------------------------------------------------------------------------


@query
def upsert_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All accepted orders, then a third of them again with other values."""
    warehouse, accepted = _new_warehouse(spark), _stored(_accepted(spark, sf_dir))
    warehouse.validated.upsert(accepted, stored=True)
    warehouse.validated.upsert(_second_batch(accepted), stored=True)
    return warehouse.validated.read().select(
        "order_id", "order_date", F.col("amount").cast("double").alias("amount"), "at_ingested"
    )


@query
def repeated_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch twice leaves the table as it was, one row per order."""
    warehouse, accepted = _new_warehouse(spark), _stored(_accepted(spark, sf_dir))
    warehouse.validated.upsert(accepted, stored=True)
    same = outcomes.upsert_is_idempotent(warehouse.validated, accepted, stored=True)
    outcomes.check_stored_counts(warehouse.validated, accepted.select("order_id").distinct().count())
    return warehouse.validated.read().agg(
        F.lit(same).alias("idempotent"),
        F.count(F.lit(1)).alias("orders"),
        F.count_distinct("order_id").alias("order_ids"),
    )


@query
def quarantine_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3, K4: quarantined orders stored twice, those without an id each on their own."""
    warehouse = _new_warehouse(spark)
    rejected = outcomes.with_record_key(outcomes.quarantined_orders(_cleaned(spark, sf_dir)))
    rejected = _stored(rejected)
    warehouse.quarantine.upsert(rejected, stored=True)
    warehouse.quarantine.upsert(rejected, stored=True)
    return warehouse.quarantine.read().groupBy(RECORD_KEY).agg(F.count(F.lit(1)).alias("row_count"))


@query
def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which orders of the whole batch are not in the validated table."""
    warehouse, cleaned = _new_warehouse(spark), _stored(_cleaned(spark, sf_dir))
    warehouse.validated.upsert(outcomes.validated_orders(cleaned), stored=True)
    return outcomes.missing_keys(cleaned, warehouse.validated.read())


@query
def csv_elt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From an order file to the stored tables."""
    warehouse = _new_warehouse(spark)
    path, expected = _order_csv(spark, sf_dir), dirty_orders(spark, sf_dir).count()
    result = elt.run_csv_elt(warehouse, path, expected_rows=expected)
    stored = reports.system_counts(warehouse.validated.read(), warehouse.quarantine.read())
    return stored.select(
        F.lit(result["raw"]).cast("long").alias("raw"),
        F.lit(result["processed"]).cast("long").alias("processed"),
        F.col("validated_orders_count").alias("validated"),
        F.col("quarantine_orders_count").alias("quarantined"),
    )


@query
def exclusive_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 twice: every order is quarantined for want of items, then comes with its items."""
    warehouse = _new_warehouse(spark)
    raw = dirty_orders(spark, sf_dir)
    empty = raw.withColumn("record_raw", F.col("record_raw").withField("items_json", F.lit("[]")))
    elt.run_elt(warehouse, empty, exclusive=True)
    elt.run_elt(warehouse, raw, exclusive=True)
    validated = warehouse.validated.read().select(
        F.lit(True).alias("validated"), F.col("order_id").alias(RECORD_KEY)
    )
    return validated.unionAll(warehouse.quarantine.read().select(F.lit(False), RECORD_KEY))


@query
def elt_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What both tables hold of every order after a run."""
    warehouse = _new_warehouse(spark)
    elt.run_elt(warehouse, dirty_orders(spark, sf_dir))
    quarantine = warehouse.quarantine.read()
    both = warehouse.validated.read().select(F.col("order_id").alias(RECORD_KEY), "*").unionByName(quarantine)
    return both.select(
        RECORD_KEY, "quality_status", *ORDER_FIELDS,
        F.size("corrections").alias("corrections"),
        F.array_join("quarantine_reasons", ",").alias("reasons"),
        F.col("amount").cast("double").alias("amount"),
    )


@query
def reset_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: all order tables emptied, then every third order stored again."""
    warehouse = _new_warehouse(spark)
    raw_orders.append_raw(dirty_orders(spark, sf_dir), warehouse.raw_path)
    cleaned = _stored(validation.apply_all_quality_rules(warehouse.raw()))
    accepted = outcomes.validated_orders(cleaned)
    warehouse.validated.upsert(accepted, stored=True)
    warehouse.quarantine.upsert(outcomes.with_record_key(outcomes.quarantined_orders(cleaned)), stored=True)
    warehouse.reset()
    left = warehouse.raw().count() + warehouse.validated.read().count() + warehouse.quarantine.read().count()
    warehouse.validated.upsert(accepted.where(F.col("number_row_source") % 3 == 0), stored=True)
    return warehouse.validated.read().select("order_id", F.lit(left).cast("long").alias("left_by_reset"))


@query
def everything(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run from an order file; what it stored, reported and logged."""
    warehouse = _new_warehouse(spark)
    result = elt.run_everything(warehouse, _order_csv(spark, sf_dir))
    done, by_city = result["elt"], result["reports"]["sales_by_city"]
    counts = {
        "loaded": result["ingested"]["loaded_raw"],
        "validated": done["validated"],
        "quarantined": done["quarantined"],
        "in_report": by_city.agg(F.sum("total_orders")).first()[0],
        "in_days": warehouse.daily_sales.read().agg(F.sum("total_orders")).first()[0],
        "lookups": result["layouts"].count(),
        "jobs_done": sum(job["status"] == jobs.SUCCESS for job in result["jobs"]),
        "jobs_logged": result["job_logs"].count(),
    }
    schema = ", ".join(f"{name} long" for name in counts)
    return spark.createDataFrame([tuple(counts.values())], schema).withColumn(
        "idempotent", F.lit(result["idempotent"])
    )


# --- summary tables, jobs, layouts -----------------------------------------------------------------


def _daily(view: DataFrame) -> DataFrame:
    return view.select(
        "order_date", "total_orders", F.col("total_revenue").cast("double").alias("total_revenue")
    )


@query
def daily_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10, F11, G9."""
    return reports.daily_sums(_accepted(spark, sf_dir), 1704067900.0).withColumn(
        "inc_revenue", F.col("inc_revenue").cast("double")
    )


@query
def mv_daily_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, full."""
    warehouse = _new_warehouse(spark)
    warehouse.validated.upsert(_accepted(spark, sf_dir))
    views.refresh_daily_sales_summary(warehouse, incremental=False)
    return _daily(warehouse.daily_sales.read())


def _refreshed_twice(spark: SparkSession, sf_dir: str, refresh: Callable[[Warehouse], None]) -> Warehouse:
    warehouse, accepted = _new_warehouse(spark), _stored(_accepted(spark, sf_dir))
    warehouse.validated.upsert(accepted, stored=True)
    refresh(warehouse)
    warehouse.validated.upsert(_second_batch(accepted), stored=True)
    refresh(warehouse)
    return warehouse


@query
def mv_daily_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, K5, K6: refreshed after each of two batches, the second of which moves orders to other days."""
    warehouse = _refreshed_twice(spark, sf_dir, views.refresh_daily_sales_summary)
    return _daily(warehouse.daily_sales.read())


@query
def mv_daily_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 as a stream, stopped and taken up again between the batches."""
    checkpoint = f"{workspace(spark)}/checkpoint"

    def refresh(warehouse: Warehouse) -> None:
        stream_daily_sales(warehouse, checkpoint).awaitTermination()

    return _daily(_refreshed_twice(spark, sf_dir, refresh).daily_sales.read())


@query
def mv_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8."""
    warehouse = _refreshed_twice(spark, sf_dir, views.refresh_daily_sales_summary)
    return warehouse.watermarks.read().select("mv_name", "last_at_ingested")


@query
def mv_top_products_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 after two batches; the second one leaves every third order its first two items only."""
    warehouse, accepted = _new_warehouse(spark), _stored(_accepted(spark, sf_dir))
    warehouse.validated.upsert(accepted, stored=True)
    views.refresh_top_products_summary(warehouse)
    ends = F.length("items_json") - F.length(F.translate("items_json", "}", ""))
    first_two = F.concat(F.substring_index("items_json", "}", 2), F.lit("}]"))
    fewer = accepted.where(F.col("number_row_source") % 3 == 0).withColumns(
        {
            "items_json": F.when(ends >= 2, first_two).otherwise(F.col("items_json")),
            "at_ingested": F.col("at_ingested") + 100000000,
        }
    )
    warehouse.validated.upsert(fewer, stored=True)
    views.refresh_top_products_summary(warehouse)
    return warehouse.top_products.read().drop("last_updated")


@query
def mv_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2, S8."""
    warehouse = _new_warehouse(spark)
    warehouse.validated.upsert(_accepted(spark, sf_dir))
    views.refresh_top_products_summary(warehouse)
    return views.get_materialized_view_data(warehouse, views.TOP_PRODUCTS, views.PRODUCTS_KEPT).drop(
        "last_updated"
    )


def _filled_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    warehouse, cleaned = _new_warehouse(spark), _stored(_cleaned(spark, sf_dir))
    warehouse.validated.upsert(outcomes.validated_orders(cleaned), stored=True)
    warehouse.quarantine.upsert(outcomes.with_record_key(outcomes.quarantined_orders(cleaned)), stored=True)
    return warehouse


@query
def system_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G10."""
    warehouse = _filled_warehouse(spark, sf_dir)
    return reports.system_counts(warehouse.validated.read(), warehouse.quarantine.read())


@query
def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both jobs, and what the log says of them."""
    warehouse = _filled_warehouse(spark, sf_dir)
    for name in jobs.JOBS_REGISTRY:
        jobs.run_job_by_name(warehouse, name)

    def detail(path: str) -> Column:
        return F.get_json_object("details", path).cast("long")

    return jobs.get_job_logs(warehouse).select(
        "job_name",
        "status",
        detail("$.validated_orders_count").alias("validated"),
        detail("$.quarantine_orders_count").alias("quarantined"),
        detail("$.daily_sales_summary.updated_documents").alias("days"),
        detail("$.top_products_summary.updated_documents").alias("products"),
    )


@query
def layout_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three lookups on the plain table and on a sorted copy."""
    folder, files = workspace(spark), 8
    # The plain table has as many files at least, if nothing is rejected, and the layouts are made from it.
    most = -(-spark.read.parquet(f"{sf_dir}/orders.parquet").count() // files)
    with shuffles_freed(spark):
        _accepted(spark, sf_dir).write.option("maxRecordsPerFile", max(1, most)).parquet(f"{folder}/plain")
    paths = layout.write_layouts(spark.read.parquet(f"{folder}/plain"), folder, files)
    compared = layout.lookups("CUST-7", "NATION_3", "DELIVERED")
    found = layout.compare_layouts(spark, f"{folder}/plain", paths, compared)
    return found.select(
        "query_id",
        "layout",
        F.col("before_rows_stored").alias("rows_stored"),
        "before_rows_returned",
        "after_rows_returned",
        (F.col("after_rows_examined") < F.col("before_rows_examined")).alias("fewer_rows_examined"),
        (F.col("after_files_examined") < F.col("before_files_examined")).alias("fewer_files_examined"),
    )


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders cleaned, and the accepted ones summed by city."""
    return reports.get_sales_by_city(_accepted(spark, sf_dir))


