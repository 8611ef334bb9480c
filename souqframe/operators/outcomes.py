"""What came out of the clean-up: the split (F6, F7), samples (F8, F9), summaries (G7, G8), checks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souqframe.operators.validation import ACCEPTED, QUARANTINE
from souqframe.schemas import CLEAN_SCHEMA, RECORD_KEY
from souqframe.sources.tables import KeyedTable


def validated_orders(cleaned: DataFrame) -> DataFrame:
    """the accepted orders."""
    return cleaned.where(F.col("quality_status").isin(ACCEPTED))


def quarantined_orders(cleaned: DataFrame) -> DataFrame:
    """the orders with a reason against them."""
    return cleaned.where(F.col("quality_status") == QUARANTINE)


def with_record_key(quarantined: DataFrame) -> DataFrame:
    """The quarantine's key: the order id or, for orders without one, the place in the source.

    Without it all the orders that lack an id would fall on one key, and on one row.
    """
    place = F.concat_ws("#", "file_source", F.col("number_row_source").cast("string"))
    return quarantined.select(
        F.coalesce(F.nullif("order_id", F.lit("")), place).alias(RECORD_KEY),
        *CLEAN_SCHEMA.fieldNames(),
    )


def _first(rows: DataFrame, limit: int, ordered: bool) -> DataFrame:
    return (rows.orderBy("order_id", "number_row_source") if ordered else rows).limit(limit)


def correction_examples(cleaned: DataFrame, limit: int = 10, ordered: bool = True) -> DataFrame:
    """F8: some orders that were corrected, the first ones by id; or, read no further than that, the first ones found."""
    corrected = cleaned.where(F.size("corrections") > 0)
    return _first(corrected, limit, ordered).select("order_id", "quality_status", "corrections")


def quarantine_examples(cleaned: DataFrame, limit: int = 10, ordered: bool = True) -> DataFrame:
    """some quarantined orders, the first ones by id; or, read no further than that, the first ones found."""
    return _first(quarantined_orders(cleaned), limit, ordered).select(
        "order_id", "customer_id", "quality_status", "quarantine_reasons"
    )


def quality_summary(cleaned: DataFrame) -> DataFrame:
    """Orders by outcome."""
    return cleaned.groupBy("quality_status").count().orderBy("quality_status")


def quarantine_reason_summary(cleaned: DataFrame) -> DataFrame:
    """How often each reason was given, most frequent first."""
    return (
        cleaned.select(F.explode("quarantine_reasons").alias("reason"))
        .groupBy("reason")
        .count()
        .orderBy(F.desc("count"), "reason")
    )


def check_counts(raw: int, processed: int, validated: int, quarantined: int) -> None:
    """No order may get lost or doubled on the way."""
    if raw != processed:
        raise RuntimeError(f"{raw:,} raw orders went in but {processed:,} came out")
    if validated + quarantined != processed:
        raise RuntimeError(
            f"{validated:,} validated and {quarantined:,} quarantined are not {processed:,} processed"
        )


def check_stored_counts(table: KeyedTable, expected: int) -> None:
    """C4: the table holds exactly this many orders."""
    stored = table.read().count()
    if stored != expected:
        raise RuntimeError(f"{table.path} holds {stored:,} orders instead of {expected:,}")


def missing_keys(batch: DataFrame, stored: DataFrame, key: str = "order_id") -> DataFrame:
    """The batch's keys that are not stored, each once; empty when all is well.

    The table is first cut down to the batch's keys: where those are few, Spark broadcasts them and
    the table is not shuffled.
    """
    wanted = batch.select(key).where(F.col(key).isNotNull()).distinct()
    found = stored.select(key).join(wanted, key, "left_semi")
    return wanted.join(found, key, "left_anti")


def check_stored_keys(batch: DataFrame, table: KeyedTable) -> None:
    """Every key of the batch is in the table."""
    absent = missing_keys(batch, table.read(), table.key).take(5)
    if absent:
        raise RuntimeError(f"not stored in {table.path}: {[row[0] for row in absent]} ...")


def fingerprint(rows: DataFrame) -> tuple:
    """Row count and sum of row hashes: equal for equal contents, in whatever order."""
    columns = sorted(rows.columns)
    return tuple(
        rows.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
        ).first()
    )


def upsert_is_idempotent(table: KeyedTable, batch: DataFrame, stored: bool = False) -> bool:
    """Upserts a batch that is already in the table once more and compares the contents."""
    before = fingerprint(table.read())
    table.upsert(batch, stored=stored)
    return fingerprint(table.read()) == before
