"""Hard negatives by a vertical scan with bounds (branch and bound on decomposed data).

Vectors are stored in blocks, turned around: a column for each dimension, with its least and greatest
value. An anchor reads the columns of a block in the order of its own components, largest magnitude
first, and adds what each contributes to the candidates' partial scores. What the columns that are left
can still add lies between bounds from their least and greatest values, so after some columns most
candidates are out of reach: of the best so far, or of every window that is asked for. Only the others
are read on, until their scores are exact.

The stated queries, the anchors, go against all blocks in groups of SENT components, one group after the other:
what is sent around has a fixed size, and nothing is paired but an anchor and a block, inside a task.
"""

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

POSITIVES = NEGATIVES = 5
LOWEST, HIGHEST = 80, 100  # per cent of the positive's score that a negative's may have
SCALE = 256
MOST = 1 << 17  # components from here on are an error: inner products of 8191 dimensions would not fit a long
SENT = 1 << 20  # components of the anchors that are sent to the executors at once, about
BLOCK = 8192  # rows of a block
STEP = 8  # columns that are added between two looks at the bounds
FEW = 64  # candidates that are not worth bounds any more

NONE = np.iinfo(np.int64).min

BLOCKS = StructType(
    [
        StructField("ids", BinaryType()),
        StructField("labels", BinaryType()),
        StructField("columns", ArrayType(BinaryType())),
        StructField("lowest", ArrayType(IntegerType())),
        StructField("highest", ArrayType(IntegerType())),
    ]
)


@dataclass(frozen=True)
class Block:
    """Rows by label: ids, labels, and a column of each dimension with its least and greatest value."""

    ids: np.ndarray
    labels: np.ndarray
    columns: list[np.ndarray]
    lowest: np.ndarray
    highest: np.ndarray

    def of_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.labels, [label, label + 1]))


@dataclass(frozen=True)
class Anchor:
    """An anchor as it is sent: its place in the group, its own row, and its windows' greatest scores, if known."""

    place: int
    id: int
    label: int
    vector: np.ndarray
    windows: np.ndarray


class Order:
    """The dimensions in which an anchor reads a block, and what is left to come behind each."""

    def __init__(self, vector: np.ndarray, block: Block):
        # Where one vector is longer than the other, the components that are missing count as 0.
        size = min(len(vector), len(block.columns))
        self.dimensions = np.argsort(-np.abs(vector[:size]), kind="stable")
        factors = vector[self.dimensions]
        one, other = factors * block.lowest[self.dimensions], factors * block.highest[self.dimensions]
        rest = np.zeros((2, size + 1), np.int64)
        rest[0, :size] = np.minimum(one, other)[::-1].cumsum()[::-1]
        rest[1, :size] = np.maximum(one, other)[::-1].cumsum()[::-1]
        self.least, self.most = rest
        self.factors = factors


def scan(anchor: Anchor, block: Block, alive: np.ndarray, in_reach) -> tuple[np.ndarray, np.ndarray]:
    """Rows of `alive` whose scores may matter, with their exact scores.

    `in_reach(low, high)` says of bounds on the scores which of the rows may still matter.
    """
    order = Order(anchor.vector, block)
    scores = np.zeros(len(alive), np.int64)
    for done in range(0, len(order.dimensions), STEP):
        whole = len(alive) == len(block.ids)
        for at in range(done, min(done + STEP, len(order.dimensions))):
            column = block.columns[order.dimensions[at]]
            scores += order.factors[at] * (column if whole else column[alive])
        after = min(done + STEP, len(order.dimensions))
        if FEW < len(alive) and after < len(order.dimensions):
            left = in_reach(scores + order.least[after], scores + order.most[after])
            if not left.all():
                alive, scores = alive[left], scores[left]
    return alive, scores


def _best(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """The places of the `count` highest scores; of equal ones, those with the smaller ids."""
    if len(scores) > 4 * count:
        border = np.partition(scores, len(scores) - count)[len(scores) - count]
        places = np.flatnonzero(scores >= border)
        return places[np.lexsort((ids[places], -scores[places]))[:count]]
    return np.lexsort((ids, -scores))[:count]


class Best:
    """The best rows that a task has found for one purpose, best first."""

    def __init__(self, count: int):
        self.count, self.scores, self.ids = count, np.empty(0, np.int64), np.empty(0, np.int64)

    def border(self) -> int:
        """A score below which nothing matters any more."""
        return int(self.scores[-1]) if len(self.scores) == self.count else NONE

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        places = _best(scores, ids, self.count)
        self.scores, self.ids = scores[places], ids[places]


def find_positives(anchor: Anchor, block: Block, best: Best) -> None:
    """Adds the block's rows of the anchor's label that may be among its best."""
    part = block.of_label(anchor.label)
    alive = np.arange(part.start, part.stop)
    alive = alive[block.ids[alive] != anchor.id]
    if not len(alive):
        return

    def in_reach(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        # As many rows are sure to get this much or more.
        sure = np.partition(low, len(low) - best.count)[len(low) - best.count] if len(low) >= best.count else NONE
        return high >= max(sure, best.border())

    alive, scores = scan(anchor, block, alive, in_reach)
    best.add(scores, block.ids[alive])


def find_negatives(anchor: Anchor, block: Block, best: dict[int, Best]) -> None:
    """Adds the block's rows of other labels that may be among the best of a window; `best` is by its upper end."""
    part = block.of_label(anchor.label)
    alive = np.concatenate([np.arange(part.start), np.arange(part.stop, len(block.ids))])
    alive = alive[block.ids[alive] != anchor.id]
    if not len(alive) or not len(best):
        return

    def in_reach(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        found = np.zeros(len(low), bool)
        for top, held in best.items():
            inside = low[high <= top]
            sure = NONE
            if len(inside) >= held.count:
                sure = int(np.partition(inside, len(inside) - held.count)[len(inside) - held.count])
            found |= (low <= top) & (high >= max(_least(top), held.border(), sure))
        return found

    alive, scores = scan(anchor, block, alive, in_reach)
    ids = block.ids[alive]
    for top, held in best.items():
        inside = (scores <= top) & (scores >= max(_least(top), held.border()))
        if inside.any():
            held.add(scores[inside], ids[inside])


def _least(top: int) -> int:
    """The least whole score of the window below a positive's."""
    return -(-LOWEST * top // HIGHEST)


def _blocks(batch: pa.RecordBatch) -> Iterator[Block]:
    for row in batch.to_pylist():
        yield Block(
            np.frombuffer(row["ids"], np.int64),
            np.frombuffer(row["labels"], np.int64),
            [np.frombuffer(column, np.int32) for column in row["columns"]],
            np.array(row["lowest"], np.int64),
            np.array(row["highest"], np.int64),
        )


def _turned(ids: np.ndarray, labels: np.ndarray, vectors: list[np.ndarray]) -> dict:
    """One stored block. Vectors that are shorter than the longest one end in zeros."""
    order = np.lexsort((ids, labels))
    matrix = np.zeros((len(vectors), max(map(len, vectors))), np.int32)
    for row, place in enumerate(order.tolist()):
        matrix[row, : len(vectors[place])] = vectors[place]
    return {
        "ids": ids[order].tobytes(),
        "labels": labels[order].tobytes(),
        "columns": [column.tobytes() for column in matrix.T],
        "lowest": matrix.min(axis=0).tolist(),
        "highest": matrix.max(axis=0).tolist(),
    }


def _turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def block() -> pa.RecordBatch:
        ids, labels, vectors = zip(*held, strict=True)
        held.clear()
        turned = _turned(np.array(ids, np.int64), np.array(labels, np.int64), vectors)
        return pa.RecordBatch.from_pylist([turned], pa.schema(
            [("ids", pa.binary()), ("labels", pa.binary()), ("columns", pa.list_(pa.binary())),
             ("lowest", pa.list_(pa.int32())), ("highest", pa.list_(pa.int32()))]
        ))

    for batch in batches:
        vectors = batch.column("vector")
        values, reach = vectors.flatten().to_numpy(), vectors.offsets.to_numpy()
        reach = reach - reach[0]
        ids, labels = (batch.column(name).to_numpy().tolist() for name in ("id", "label"))
        for row in range(len(batch)):
            held.append((ids[row], labels[row], values[reach[row] : reach[row + 1]]))
            if len(held) == BLOCK:
                yield block()
    if held:
        yield block()


def eligible(df: DataFrame, id: str, label: Column, vector: str) -> DataFrame:
    """id, label and whole-number vector of the rows that take part."""
    rows = df.select(
        F.col(f"`{id}`").cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    too_large = F.raise_error(F.lit(f"a component of a vector is {MOST} or more")).cast("int")
    whole = F.transform(
        "vector", lambda x: F.when(F.abs(x) < MOST, F.floor(x * SCALE).cast("int")).otherwise(too_large)
    )
    return rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite).withColumn("vector", whole)


FOUND = StructType(
    [
        StructField("place", IntegerType()),
        StructField("top", LongType()),
        StructField("score", LongType()),
        StructField("id", LongType()),
    ]
)


def _rows_of(found: Iterator[tuple[int, int | None, Best]]) -> pa.RecordBatch:
    rows = [
        (place, top, score, id)
        for place, top, best in found
        for score, id in zip(best.scores.tolist(), best.ids.tolist(), strict=True)
    ]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], FOUND.fieldNames()
    )


def _scan_positives(blocks: DataFrame, sent) -> DataFrame:
    """The best rows of each anchor's own label, of all tasks: as many rows a task and anchor as positives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(POSITIVES) for _ in sent.value]
        for batch in batches:
            for block in _blocks(batch):
                for anchor in sent.value:
                    find_positives(anchor, block, best[anchor.place])
        yield _rows_of((place, None, held) for place, held in enumerate(best))

    return blocks.mapInArrow(run, FOUND)


def _scan_negatives(blocks: DataFrame, sent) -> DataFrame:
    """The best rows of other labels in each window of an anchor, of all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [{top: Best(NEGATIVES) for top in anchor.windows.tolist()} for anchor in sent.value]
        for batch in batches:
            for block in _blocks(batch):
                for anchor in sent.value:
                    find_negatives(anchor, block, best[anchor.place])
        yield _rows_of((place, top, held) for place, tops in enumerate(best) for top, held in tops.items())

    return blocks.mapInArrow(run, FOUND)


def _ranked(found: DataFrame, count: int) -> DataFrame:
    """The first `count` rows of each anchor and window; a task sends that many at most, so groups stay small."""
    order = Window.partitionBy("place", "top").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


def mine_hard_negatives(
    df: DataFrame, anchors: Column, folder: str, id: str = "vec_id", label: Column | None = None, vector: str = "embedding"
) -> DataFrame:
    """For each anchor and each of its POSITIVES best rows of the same label, the best NEGATIVES of other labels.

    Scores are inner products of the components times SCALE, rounded down; higher ones come first, then
    smaller ids. A negative's score is at most its positive's and LOWEST per cent of it at least, so a
    positive below 0 has none. `rank` counts from 1 among the rows returned for an anchor and a positive.

    `anchors` is a condition on the result of `eligible`: id, label, vector. Rows with a null id, label or
    vector, or a component that is null or not finite, take no part; a component of MOST or more is an
    error. A vector that is shorter than another one counts as if it ended in zeros, an empty one has
    score 0. Rows of the anchor's own id are neither its positives nor its negatives. Other rows that come
    again take as many places; an anchor that comes again is asked once. Other columns are not read. With
    no rows or anchors nothing comes out.
    """
    spark = df.sparkSession
    rows = eligible(df, id, F.col("label") if label is None else label, vector)
    rows.mapInArrow(_turn, BLOCKS).write.parquet(f"{folder}/blocks")
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    rows.where(anchors).distinct().write.parquet(f"{folder}/anchors")
    asked = spark.read.schema(rows.schema).parquet(f"{folder}/anchors")
    size = asked.agg(F.sum(F.size("vector") + 8)).first()[0]
    groups = -(-(size or 0) // SENT)
    whole = None
    for group in range(groups):
        # About as many components each: a group of anchors reaches the driver, not all of them.
        of_group = asked.where(F.pmod(F.xxhash64("id", "label", "vector"), F.lit(groups)) == group)
        taken = sorted(tuple(row) for row in of_group.collect())
        made = [
            Anchor(place, id, label, np.array(vector, np.int64), np.empty(0, np.int64))
            for place, (id, label, vector) in enumerate(taken)
        ]
        sent = spark.sparkContext.broadcast(made)
        path = f"{folder}/positives/{group}"
        _ranked(_scan_positives(blocks, sent), POSITIVES).write.parquet(path)
        positives = spark.read.parquet(path)
        tops: dict[int, set[int]] = {}
        for row in positives.select("place", "score").distinct().collect():
            tops.setdefault(row["place"], set()).add(row["score"])
        sent.unpersist()
        made = [replace(anchor, windows=np.array(sorted(tops.get(anchor.place, ())), np.int64)) for anchor in made]
        sent = spark.sparkContext.broadcast(made)
        path = f"{folder}/negatives/{group}"
        _ranked(_scan_negatives(blocks, sent), NEGATIVES).write.parquet(path)
        sent.unpersist()
        names = spark.createDataFrame([(place, id) for place, (id, *_) in enumerate(taken)], "place int, anchor_id long")
        found = (
            positives.select("place", F.col("score").alias("top"), F.col("id").alias("positive_id"))
            .join(spark.read.parquet(path), ["place", "top"])
            .join(names, "place")
            .select(
                "anchor_id",
                "positive_id",
                "rank",
                F.col("id").alias("negative_id"),
                F.col("top").alias("positive_score"),
                F.col("score").alias("negative_score"),
            )
        )
        whole = found if whole is None else whole.unionAll(found)
    return spark.createDataFrame([], RESULT) if whole is None else whole
