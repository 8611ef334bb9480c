"""How likely texts are under a hidden Markov model of the corpus.

A word is drawn in two steps: the latent state gives one of CLASSES classes, the class gives the word.
The classes are hashes of the words, so the model that is sent around has a fixed size whatever the
vocabulary; the words within the classes are counted over the whole vocabulary, which is shuffled and
never sent. The second step does not depend on the state, so the probability of a text is that of its
classes, by the forward recursion, times that of its words within their classes: nothing is approximated.

Texts are split into words once and written down in chunks with the numbers of their words. Each round of
Baum-Welch reads all chunks, and only expected counts, one row a task and class, leave the tasks.
"""

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from souqframe.llm import hidden_markov as markov
from souqframe.llm.chunks import ChunkNumbers, Numbering, answers, compact, gather, numbers_in, one_list, with_totals

CLASSES = 1 << 15
STATES = 8
ROUNDS = 5  # of Baum-Welch
ADDED = 0.1  # to the count of each word and of one that is not known
CHUNK = 1 << 20  # tokens of a chunk, about; a text is never split
ROWS = 1 << 15  # rows of results at once

RESULTS = [
    StructField("n_tokens", LongType()),
    StructField("n_known", LongType()),
    StructField("train_tokens", LongType()),
    StructField("base_score", DoubleType()),
    StructField("score", DoubleType()),
]


def words_of(text: bytes) -> list[bytes]:
    """What is between blanks, A-Z in lower case; on UTF-8 both change nothing but ASCII."""
    return text.lower().split()


class _Words:
    """The words of some texts by their numbers, and how often each stands in texts to learn from."""

    def __init__(self):
        self.numbers, self.texts, self.taught = Numbering(), [], []

    def add(self, text: bytes, taught: bool) -> int:
        self.texts.append(self.numbers.of(words_of(text)))
        self.taught.append(taught)
        return len(self.texts[-1]) + 1

    def row(self, classes: int) -> dict:
        learned = [text for text, taught in zip(self.texts, self.taught, strict=True) if taught]
        counts = np.bincount(np.concatenate([*learned, np.empty(0, np.int32)]), minlength=len(self.numbers))
        return {
            "lengths": [len(text) for text in self.texts],
            "taught": self.taught,
            "ids": compact(np.concatenate(self.texts)),
            "words": list(self.numbers),
            "counts": counts,
            "classes": compact(np.fromiter(map(crc32, self.numbers), np.int64, len(self.numbers)) % classes),
        }


def _chunked(df: DataFrame, text: str, keep: list[str], held_out: Column, classes: int) -> DataFrame:
    inner = df.select(
        F.struct(*[F.col(f"`{name}`") for name in keep], held_out.alias("held_out")).alias("kept"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("text"),
        (~held_out).alias("taught"),
    )
    schema = StructType(
        [
            StructField("chunk", LongType()),
            StructField("kept", ArrayType(inner.schema["kept"].dataType)),
            StructField("lengths", ArrayType(IntegerType())),
            StructField("taught", ArrayType(BooleanType())),
            StructField("ids", BinaryType()),
            StructField("words", ArrayType(BinaryType())),
            StructField("counts", ArrayType(LongType())),
            StructField("classes", BinaryType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = ChunkNumbers()
        for collector, kept in gather(batches, CHUNK, _Words):
            row = {"chunk": number(), **collector.row(classes)}
            columns = [
                one_list(kept, field.type) if field.name == "kept" else pa.array([row[field.name]], field.type)
                for field in arrow
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return inner.mapInArrow(run, schema)


def _sequences(batch: pa.RecordBatch, classes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, dict]]:
    """Of each chunk: the classes of its texts with an end behind each, their lengths, which teach, the columns."""
    for number in range(len(batch)):
        row = {name: batch.column(name)[number] for name in batch.schema.names}
        lengths = row["lengths"].values.to_numpy()
        ids, class_of = numbers_in(row["ids"]), numbers_in(row["classes"]).astype(np.int32)
        symbols = np.insert(class_of[ids], lengths.cumsum(), classes)
        taught = row["taught"].values.to_numpy(zero_copy_only=False)
        yield symbols, lengths + 1, taught, row | {"ids": ids, "classes": class_of}


def _train(chunks: DataFrame, symbol_counts: np.ndarray, states: int, rounds: int) -> markov.Model:
    """Baum-Welch over all texts that teach. A round's counts are a row for each class: of fixed size."""
    spark, classes = chunks.sparkSession, len(symbol_counts) - 1
    model = markov.start(symbol_counts, states)
    names = [f"s{state}" for state in range(states)]
    schema = StructType([StructField("symbol", LongType()), *[StructField(name, FloatType()) for name in names]])
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            counter = markov.Counter(sent.value, classes + 1)
            for batch in batches:
                for symbols, lengths, taught, _ in _sequences(batch, classes):
                    counter.add(symbols[np.repeat(taught, lengths)], lengths[taught])
            counts = counter.result()
            # Symbols, then a row for the first states and one for each state that is moved from.
            rows = np.concatenate([counts.symbols, counts.first[None, :], counts.moves]).astype(np.float32)
            used = np.flatnonzero(rows.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), *[pa.array(rows[used, state]) for state in range(states)]], ["symbol", *names]
            )

        counted = chunks.select("lengths", "taught", "ids", "classes").mapInArrow(run, schema)
        summed = counted.groupBy("symbol").agg(*[F.sum(name).alias(name) for name in names]).toArrow()
        rows = np.zeros((classes + 2 + states, states))
        place = summed["symbol"].to_numpy()
        for state, name in enumerate(names):
            rows[place, state] = summed[name].to_numpy()
        model = markov.estimate(markov.Counts(rows[classes + 1], rows[classes + 2 :], rows[: classes + 1]))
        sent.unpersist()
    return model


def score_texts(
    df: DataFrame,
    held_out: Column,
    folder: str,
    text: str = "text",
    keep: list[str] | None = None,
    classes: int = CLASSES,
    states: int = STATES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """The log10 probability of every whole text, with its end, under a model of the texts that are not held out.

    Gives the columns `keep` (default doc_id), held_out, n_tokens (words and one end), n_known (tokens of
    the texts learned from), train_tokens, base_score (independent words, ADDED to each count) and score
    (the hidden Markov model). A word that was never learned counts as one unknown word of its class.

    `held_out` must not be null. A null text counts as an empty one, whose only token is the end. Rows that
    come again teach and are scored as often. Other columns are not read, and of `keep` those named like
    a result are left out. With nothing to learn from, all classes are equally likely. An empty table
    gives no rows. `folder` is where the chunks and the words' counts are written.
    """
    spark = df.sparkSession
    new = {field.name.lower() for field in RESULTS} | {"held_out"}
    keep = [name for name in keep or ["doc_id"] if name.lower() not in new]
    made = _chunked(df, text, keep, held_out, classes)
    made.write.parquet(f"{folder}/chunks")
    chunks = spark.read.schema(made.schema).parquet(f"{folder}/chunks")

    entries = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "entry")).select(
        "chunk", "place", F.col("entry.words").alias("word"), F.col("entry.counts").alias("n")
    )
    with_totals(entries, ["word"], "n").select(
        "chunk", "place", F.col("total").alias("n"), "first", (F.crc32("word") % classes).alias("class")
    ).write.parquet(f"{folder}/totals")
    totals = spark.read.parquet(f"{folder}/totals").where("n > 0")

    # A row for each class, and one number of texts.
    by_class = totals.where("first").groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words"))
    found = by_class.toArrow()
    of_class, words_of_class = np.zeros(classes + 1), np.zeros(classes + 1)
    of_class[found["class"].to_numpy()] = found["n"].to_numpy()
    words_of_class[found["class"].to_numpy()] = found["words"].to_numpy()
    texts = chunks.select(F.expr("size(filter(taught, t -> t))").alias("n")).agg(F.sum("n")).first()[0] or 0
    of_class[classes], words_of_class[classes] = texts, texts > 0
    total, kinds = int(of_class.sum()), int(words_of_class.sum())

    model = _train(chunks, of_class, states, rounds)
    known = answers(totals, ["n"])
    sent = spark.sparkContext.broadcast((model, of_class + ADDED * (words_of_class + 1)))
    everything, end_known = total + ADDED * (kinds + 1), texts > 0
    end_score = math.log10((texts + ADDED) / everything)
    kept_schema = made.schema["kept"].dataType.elementType
    schema = StructType([*kept_schema.fields, *RESULTS])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, of_class = sent.value
        for batch in batches:
            for symbols, lengths, _, row in _sequences(batch, classes):
                ids, class_of = row["ids"], row["classes"]
                counts = np.zeros(len(class_of))
                if row["places"].is_valid:
                    counts[row["places"].values.to_numpy()] = row["n"].values.to_numpy()
                text = np.repeat(np.arange(len(lengths)), lengths - 1)

                def summed(values: np.ndarray, text=text, ids=ids, texts=len(lengths)) -> np.ndarray:
                    return np.bincount(text, values[ids], texts)

                base = summed(np.log10((counts + ADDED) / everything)) + end_score
                within = summed(np.log10((counts + ADDED) / of_class[class_of]))
                results = [
                    lengths.astype(np.int64),
                    summed((counts > 0).astype(float)).astype(np.int64) + end_known,
                    np.full(len(lengths), total, np.int64),
                    base,
                    markov.likelihoods(model, symbols, lengths) / math.log(10) + within,
                ]
                columns = [*row["kept"].values.flatten(), *[pa.array(values) for values in results]]
                whole = pa.RecordBatch.from_arrays(columns, schema=arrow)
                for at in range(0, len(whole), ROWS):
                    yield whole.slice(at, ROWS)

    read = chunks.select("chunk", "kept", "lengths", "taught", "ids", "classes").join(known, "chunk", "left")
    return read.drop("chunk").mapInArrow(run, schema)
