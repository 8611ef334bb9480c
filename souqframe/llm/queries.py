"""The thirteen operators and the pipeline as queries over the given tables, and SQL for those that it can express."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souqframe.llm import (
    bpe,
    decontaminate,
    hard_negatives,
    language_id,
    licenses,
    line_dedup,
    near_dedup,
    quality_classifier,
    quality_rules,
    secret_scan,
    sequence_score,
    token_alignment,
    token_counts,
)
from souqframe.llm.oracle import ORACLE_SQL
from souqframe.sources.workspace import workspace

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WORDS, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def vocabulary() -> tuple[str, str]:
    """Path of the rank file and the pattern that belongs to it."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every text and back."""
    return bpe.encode_texts(_table(spark, sf_dir, "documents"), *vocabulary())


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that each text contains."""
    found = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_ids", (F.size("item_ids") == 0).alias("kept"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text, with its site's and section's."""
    documents, labels = (_table(spark, sf_dir, name) for name in ("documents", "labels"))
    return quality_classifier.classify_quality(documents, labels, workspace(spark))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every text and the verdict of the rules."""
    documents, labels = (_table(spark, sf_dir, name) for name in ("documents", "labels"))
    judged, measures, verdict = quality_rules.apply_quality_rules(
        documents, labels, workspace(spark), keep=["doc_id"]
    )
    columns = [f"{measures}.{name}" for name in [*quality_rules.BASE, "base_failed"]]
    return judged.select("doc_id", *columns, F.col(verdict).alias("kept"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicates, by shingles of four words."""
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), workspace(spark), width=4)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy longest-match pieces of every text."""
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), *vocabulary())


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without its site's boilerplate lines."""
    left, n_lines, n_dropped = line_dedup.drop_boilerplate(_table(spark, sf_dir, "documents"), workspace(spark))
    return left.select(
        "doc_id",
        F.col(n_lines).alias("n_lines"),
        F.col(n_dropped).alias("n_dropped"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from four fifths of them."""
    documents = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    profiles = language_id.learn_profiles(documents.where(~held_out))
    return language_id.identify_languages(documents, profiles).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text."""
    documents = _table(spark, sf_dir, "documents")
    found = secret_scan.scan_secrets(documents, secret_scan.train_field(documents))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named in every text."""
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all of them; every seventh label is moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(
        _table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, workspace(spark), label=label
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers cut every text, and how usual their pairs of ids are."""
    import public_tokenizers

    return token_alignment.align_tokenizers(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path(WORDS),
        public_tokenizers.path(PIECES),
        workspace(spark),
    )


def op13_sequence_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How likely every text is, learned from nine tenths of them."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(True))
    return sequence_score.score_texts(_table(spark, sf_dir, "documents"), held_out, workspace(spark))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py, one after the other."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    functions = [
        op1_bpe,
        op2_decontamination,
        op3_quality_classifier,
        op4_quality_rules,
        op5_near_dedup,
        op6_token_counts,
        op7_line_dedup,
        op8_language_id,
        op9_secret_scan,
        op10_license_scan,
        op11_hard_negatives,
        op12_token_alignment,
        op13_sequence_score,
        pipeline,
    ]
    return {function.__name__: function for function in functions}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
