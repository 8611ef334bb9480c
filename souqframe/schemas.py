"""Column lists and schemas shared by every table."""

from pyspark.sql import types as T

# The header of a raw order file, in file order.
ORDER_FIELDS = [
    "order_id",
    "customer_id",
    "customer_name",
    "customer_phone",
    "customer_email",
    "city",
    "district",
    "delivery_type",
    "payment_method",
    "payment_status",
    "currency",
    "status",
    "order_date",
    "delivery_cost",
    "payment_amount",
    "total_amount",
    "items_json",
]

ENVELOPE_FIELDS = [
    "at_ingested",
    "engine_used",
    "file_source",
    "id_run",
    "number_row_source",
]

_ENVELOPE = [
    T.StructField("at_ingested", T.DoubleType()),
    T.StructField("engine_used", T.StringType()),
    T.StructField("file_source", T.StringType()),
    T.StructField("id_run", T.StringType()),
    T.StructField("number_row_source", T.LongType()),
]
_ORDER = [T.StructField(name, T.StringType()) for name in ORDER_FIELDS]

# One entry of the audit trail.
CORRECTION = T.StructType(
    [
        T.StructField("field", T.StringType()),
        T.StructField("original_value", T.StringType()),
        T.StructField("corrected_value", T.StringType()),
        T.StructField("rule_code", T.StringType()),
    ]
)
CORRECTION_SCHEMA = T.ArrayType(CORRECTION)

# Raw table: the envelope around the untouched record.
RAW_SCHEMA = T.StructType([*_ENVELOPE, T.StructField("record_raw", T.StructType(_ORDER))])

# Money, wherever it is summed or compared.
AMOUNT = T.DecimalType(28, 2)

# Cleaned orders: what the rules put out, and what both stored tables hold.
CLEAN_SCHEMA = T.StructType(
    [
        *_ENVELOPE,
        *_ORDER,
        T.StructField("corrections", CORRECTION_SCHEMA),
        T.StructField("quarantine_reasons", T.ArrayType(T.StringType())),
        T.StructField("quality_status", T.StringType()),
        T.StructField("amount", AMOUNT),
    ]
)

# The quarantine also takes orders without an id, so it has a key of its own.
RECORD_KEY = "record_key"
QUARANTINE_SCHEMA = T.StructType([T.StructField(RECORD_KEY, T.StringType()), *CLEAN_SCHEMA.fields])

DAILY_SALES_SCHEMA = T.StructType(
    [
        T.StructField("order_date", T.StringType()),
        T.StructField("total_orders", T.LongType()),
        T.StructField("total_revenue", T.DecimalType(28, 2)),
        T.StructField("last_updated", T.DoubleType()),
    ]
)

TOP_PRODUCTS_SCHEMA = T.StructType(
    [
        T.StructField("product_name", T.StringType()),
        T.StructField("total_quantity_sold", T.LongType()),
        T.StructField("total_revenue", T.DoubleType()),
        T.StructField("last_updated", T.DoubleType()),
    ]
)

# What the product report is made of: kept up to date by what each change adds and takes off.
PRODUCT_SUMS_SCHEMA = T.StructType(
    [
        T.StructField("product_name", T.StringType()),
        T.StructField("lines", T.LongType()),
        T.StructField("quantity", T.DecimalType(38, 0)),
        T.StructField("revenue", T.DecimalType(38, 6)),
    ]
)

WATERMARK_SCHEMA = T.StructType(
    [
        T.StructField("mv_name", T.StringType()),
        T.StructField("last_at_ingested", T.DoubleType()),
        T.StructField("updated_at", T.DoubleType()),
    ]
)

JOB_LOG_SCHEMA = T.StructType(
    [
        T.StructField("job_name", T.StringType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("end_time", T.StringType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("details", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("created_at", T.DoubleType()),
    ]
)
