"""Benchmark passages found by a join of piece hashes, for test sets that are too large to send around.

The method is that of decontaminate.py: an item with up to e changed words has at least one of its e + 1
pieces unchanged. Here pieces and stretches of text meet by a 64-bit hash in a shuffle. Texts are read
once: each task hashes all stretches that are as long as some piece and keeps those whose hash a bitmap
of fixed size holds, a few per text. Hits are joined with the pieces, candidates get the words of their
items, and the edit distance decides, so neither equal hashes nor the bitmap change the result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType
from xxhash import xxh3_64_intdigest

from souqframe.llm.decontaminate import errors_of, occurs, pieces_of, words_of

BITS = 26  # of a hash that name its place in the bitmap: 8 MB
MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def stretch_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each `length` words in a row."""
    count = max(0, len(hashes) - length + 1)
    mixed = np.full(count, np.uint64(length))
    for step in range(length):
        mixed = (mixed ^ hashes[step : step + count]) * MIX
        mixed ^= mixed >> np.uint64(32)
    return mixed


PIECES = StructType(
    [
        StructField("hash", LongType()),
        StructField("length", IntegerType()),
        StructField("first", IntegerType()),
        StructField("item", LongType()),
    ]
)


def _pieces(items: DataFrame, most_changed: float) -> DataFrame:
    """hash, length and first word of each piece of each item; items have item (a number of their own) and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(text)
                if not words:
                    continue
                for first, piece in pieces_of(words, errors_of(words, most_changed)):
                    value = stretch_hashes(word_hashes(piece), len(piece))[0]
                    rows.append((int(value.view(np.int64)), len(piece), first, item))
            columns = zip(*rows, strict=True) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, to_arrow_schema(PIECES), strict=True)], PIECES.names
            )

    return items.select("item", "text").mapInArrow(run, PIECES)


def _bitmap(pieces: DataFrame) -> np.ndarray:
    """Which leading bits of a hash any piece has: a bit for each, put together where the pieces are."""
    place = F.shiftrightunsigned("hash", 64 - BITS).cast("long") + 1  # Spark counts from 1
    parts = (
        pieces.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        .collect()
    )
    whole = np.zeros((1 << BITS) // 8, np.uint8)
    for row in parts:  # 4096 bytes each
        at = (row["bucket"] - 1) * 4096
        whole[at : at + 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return whole


def _hits(df: DataFrame, text: str, keep: list[str], bitmap: np.ndarray, lengths: list[int]) -> DataFrame:
    """Every row with a number, its kept columns, the stretches that may be pieces, and its text if there are any."""
    inner = df.select(
        F.struct(*[F.col(f"`{name}`") for name in keep]).alias("kept"), F.col(f"`{text}`").cast("string").alias("text")
    )
    hit = StructType([StructField("hash", LongType()), StructField("place", IntegerType())])
    schema = StructType(
        [
            StructField("row", LongType()),
            inner.schema["kept"],
            StructField("hits", ArrayType(hit)),
            StructField("text", StringType()),
        ]
    )
    arrow = to_arrow_schema(schema)
    sent = df.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, number = sent.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            found, texts = [], []
            for value in batch.column(1):
                hashes, hits = word_hashes(words_of(value.as_py())), []
                for length in lengths:
                    mixed = stretch_hashes(hashes, length)
                    place = (mixed >> np.uint64(64 - BITS)).astype(np.int64)
                    at = np.flatnonzero(bits[place >> 3] >> (place & 7).astype(np.uint8) & 1)
                    hits += zip(mixed[at].view(np.int64).tolist(), at.tolist(), strict=True)
                found.append([{"hash": h, "place": p} for h, p in hits])
                texts.append(value.as_py() if hits else None)
            numbers = pa.array(range(number, number + len(batch)), pa.int64())
            number += len(batch)
            yield pa.RecordBatch.from_arrays(
                [numbers, batch.column(0), pa.array(found, arrow.field("hits").type), pa.array(texts, pa.string())],
                schema=arrow,
            )

    return inner.mapInArrow(run, schema)


def _verified(candidates: DataFrame, most_changed: float) -> DataFrame:
    """row and id of the candidates whose items occur; each row comes with its text and all items that may."""
    schema = StructType([StructField("row", LongType()), StructField("id", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row, text, items in zip(*(batch.column(n) for n in ("row", "text", "items")), strict=True):
                words = words_of(text.as_py())
                for item in items.as_py():
                    own = words_of(item["text"])
                    if occurs(own, errors_of(own, most_changed), sorted(set(item["starts"])), words):
                        rows.append((row.as_py(), item["id"]))
            columns = zip(*rows, strict=True) if rows else [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["row", "id"])

    return candidates.select("row", "text", "items").mapInArrow(run, schema)


def contaminated_by_join(
    df: DataFrame, items: DataFrame, folder: str, text: str, keep: list[str], most_changed: float
) -> DataFrame:
    """The columns `keep` of every row and item_ids; items have id and text, neither of them null."""
    spark = df.sparkSession

    def stored(table: DataFrame, name: str) -> DataFrame:
        table.write.parquet(f"{folder}/{name}")
        return spark.read.schema(table.schema).parquet(f"{folder}/{name}")

    items = stored(items.withColumn("item", F.monotonically_increasing_id()), "items")
    pieces = stored(_pieces(items, most_changed), "pieces")
    lengths = sorted(row[0] for row in pieces.select("length").distinct().collect())
    rows = stored(_hits(df, text, keep, _bitmap(pieces), lengths), "rows")

    hits = rows.where(F.size("hits") > 0).select("row", F.explode("hits").alias("hit")).select("row", "hit.*")
    starts = (
        hits.join(pieces.select("hash", "first", "item"), "hash")
        .groupBy("row", "item")
        .agg(F.collect_set(F.col("place") - F.col("first")).alias("starts"))
    )
    # A text has no more candidates than hits.
    of_row = (
        starts.join(items, "item")
        .groupBy("row")
        .agg(F.collect_list(F.struct("id", "text", "starts")).alias("items"))
    )
    verified = _verified(rows.select("row", "text").join(of_row, "row"), most_changed)
    found = verified.groupBy("row").agg(F.array_sort(F.collect_set("id")).alias("item_ids"))
    joined = rows.select("row", "kept").join(found, "row", "left")
    none = F.array().cast("array<bigint>")
    return joined.select("kept.*", F.coalesce("item_ids", none).alias("item_ids"))
