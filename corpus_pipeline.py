"""Training corpus from documents: rules, boilerplate lines, near-duplicates, benchmark passages, token ids."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souqframe.llm import bpe, decontaminate, line_dedup, near_dedup, quality_rules
from souqframe.llm.queries import vocabulary
from souqframe.sources.workspace import workspace


def reject_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged, _, verdict = quality_rules.apply_quality_rules(docs, labels, workspace(spark))
    return judged.where(F.col(verdict)).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their site; n_chars is counted anew.

    A page all of whose lines with a word would go stays as it is: copies of a page on a large share of a
    site make all its lines boilerplate, and near-dedup then leaves one of them.
    """
    left, _, _ = line_dedup.drop_boilerplate(docs, workspace(spark), spare_whole=True)
    return left.select(*docs.columns).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.drop_near_duplicates(docs, workspace(spark))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contaminated(docs, items, keep=docs.columns)
    return found.where(F.size("item_ids") == 0).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, checked by decoding them."""
    return bpe.encode_texts(docs, *vocabulary(), keep=["doc_id", "lang", "source"], with_ids=True)


STAGES = [
    ("quality rules", reject_by_rules),
    ("line dedup", drop_lines),
    ("near-dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("byte-level BPE", encode),
]

# Trained cutoffs, similarity components, edit distance and BPE are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents; each one's result is written to the shared folder and read again."""
    folder = workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/stage{number}"
        made = stage(spark, docs, sf_dir)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
