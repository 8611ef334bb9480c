"""Validation (V1-V8), classification (C1) and the whole clean-up of raw orders."""

from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from souqframe.functions.amounts import numeric_amount
from souqframe.operators.cleaning import NINE_RULES, TOTAL_ERROR, apply_rules
from souqframe.schemas import CLEAN_SCHEMA, ENVELOPE_FIELDS

# What a field has to look like.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
PHONE_PATTERN = r"^9677\d{8}$"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
PRICE_PATTERN = r"^-?\d+(\.\d+)?$"

# The three outcomes.
VALID, CORRECTED, QUARANTINE = "valid", "corrected", "quarantine"
ACCEPTED = [VALID, CORRECTED]


def _missing(field: str) -> Column:
    return F.coalesce(F.trim(field), F.lit("")) == ""


def _filled_but_not(field: str, pattern: str) -> Column:
    return (F.trim(field) != "") & ~F.col(field).rlike(pattern)


def quarantine_reasons(strict_dates: bool = False) -> Column:
    """V1-V8: the reasons against an order, in a fixed order, each at most once.

    A date that looks right but does not exist (2024-02-30) passes, as does a missing one, unless
    `strict_dates` is set.
    """
    bad_date = ~F.col("order_date").rlike(DATE_PATTERN)
    if strict_dates:
        real = F.try_to_timestamp("order_date", F.lit("yyyy-MM-dd")).isNotNull()
        bad_date = F.coalesce(bad_date, F.lit(True)) | ~real
    none = F.array().cast("array<string>")

    def reason(against: Column, name: Column | str) -> Column:
        code = F.lit(name) if isinstance(name, str) else name
        return F.when(against, F.array(code)).otherwise(none)

    return F.concat(
        reason(_missing("order_id"), "MISSING_ORDER_ID"),
        reason(_missing("customer_id"), "MISSING_CUSTOMER_ID"),
        reason(_filled_but_not("customer_email", EMAIL_PATTERN), "INVALID_EMAIL"),
        reason(_filled_but_not("customer_phone", PHONE_PATTERN), "INVALID_PHONE"),
        reason(bad_date, "INVALID_IMPOSSIBLE_DATE"),
        reason(F.col(TOTAL_ERROR).isNotNull(), F.col(TOTAL_ERROR)),
        reason(_filled_but_not("delivery_cost", PRICE_PATTERN), "UNKNOWN_PRICE"),
    )


def apply_validation(df: DataFrame, strict_dates: bool = False) -> DataFrame:
    """Adds `quarantine_reasons` to orders that have been through the rules."""
    return df.withColumn("quarantine_reasons", quarantine_reasons(strict_dates))


def quality_status() -> Column:
    """Quarantine where there is a reason, else corrected where there is a correction."""
    return (
        F.when(F.size("quarantine_reasons") > 0, QUARANTINE)
        .when(F.size("corrections") > 0, CORRECTED)
        .otherwise(VALID)
    )


def flatten_raw(raw: DataFrame) -> DataFrame:
    """The fields of the raw record beside the envelope."""
    return raw.select(*ENVELOPE_FIELDS, "record_raw.*")


def outcome_counts() -> list[Column]:
    """The counts that have to add up."""
    status = F.col("quality_status")
    return [
        F.count(F.lit(1)).alias("processed"),
        F.count_if(status.isin(ACCEPTED)).alias("validated"),
        F.count_if(status == QUARANTINE).alias("quarantined"),
    ]


def apply_all_quality_rules(
    raw: DataFrame, strict_dates: bool = False, counts: Observation | None = None
) -> DataFrame:
    """Raw orders in, cleaned, audited, validated and classified orders out, one row for each.

    The outcomes are counted on the way, into `counts` where it is given. Spark does not move filters
    past a count, and here it must not: a filter on the outcome would be turned into one on the raw
    fields, which works out all the rules a second time.
    """
    return (
        raw.transform(flatten_raw)
        .transform(apply_rules, NINE_RULES)
        .transform(apply_validation, strict_dates)
        .withColumn("quality_status", quality_status())
        .withColumn("amount", numeric_amount("total_amount"))
        .select(CLEAN_SCHEMA.fieldNames())
        .observe(counts or Observation(f"cleaned-{uuid4().hex}"), *outcome_counts())
    )
