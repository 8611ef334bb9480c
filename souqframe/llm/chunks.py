"""Texts gathered into chunks that name each thing in them once, so that tables are joined by chunk and thing.

What a join has to move is then a row for each chunk and thing (a word, a pair of ids), not one for each
place where it stands: a word that is in every text costs a row a chunk.
"""

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class Numbering(defaultdict):
    """Numbers things in the order in which they first come."""

    def __init__(self):
        super().__init__()
        self.default_factory = self.__len__

    def of(self, things) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, things), np.int32, len(things))


class ChunkNumbers:
    """A number for each chunk that a task makes; the same again if the task is repeated."""

    def __init__(self):
        self.next = TaskContext.get().partitionId() << 32

    def __call__(self) -> int:
        self.next += 1
        return self.next - 1


def gather(batches: Iterator[pa.RecordBatch], limit: int, new: Callable) -> Iterator[tuple]:
    """Feeds texts to collectors that `new` makes; gives (collector, kept rows) whenever one is full.

    Column 0 of the batches is passed on for the texts of a chunk, the other ones are given to
    `collector.add` row by row, which returns by how much the chunk has grown.
    """
    collector, kept, size = new(), [], 0
    for batch in batches:
        first = 0
        columns = batch.columns
        for place, row in enumerate(zip(*columns[1:], strict=True)):
            size += collector.add(*[value.as_py() for value in row])
            if size >= limit:
                kept.append(columns[0].slice(first, place + 1 - first))
                yield collector, pa.concat_arrays(kept)
                collector, kept, size, first = new(), [], 0, place + 1
        if first < len(batch):
            kept.append(columns[0].slice(first))
    if kept:
        yield collector, pa.concat_arrays(kept)


def one_list(values: pa.Array, kind: pa.ListType) -> pa.Array:
    """A list column with one row that holds all the values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values, type=kind)


def compact(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on as bytes: two each if all are small, else four behind a byte that says so."""
    small = not len(numbers) or numbers.max() < 1 << 16
    return numbers.astype(np.uint16).tobytes() if small else b"4" + numbers.astype(np.uint32).tobytes()


def numbers_in(stored: pa.Scalar) -> np.ndarray:
    """What `compact` was given."""
    held = stored.as_buffer()
    return np.frombuffer(held[1:], np.uint32) if len(held) % 2 else np.frombuffer(held, np.uint16)


def with_totals(entries: DataFrame, key: list[str], amount: str) -> DataFrame:
    """Entries with `total`, the sum of `amount` over all chunks for the same thing, and whether they are its `first`.

    Entries have chunk, place and key, and are shuffled once. A thing has one row a chunk at most, so
    however usual it is, its share of the rows is one in as many as a chunk has things.
    """
    same = Window.partitionBy(*key)
    return entries.withColumns(
        {"total": F.sum(amount).over(same), "first": F.min("chunk").over(same) == F.col("chunk")}
    )


def answers(totals: DataFrame, values: list[str]) -> DataFrame:
    """For each chunk, the `places` of its things and a list of each of `values`, in the same order."""
    found = totals.groupBy("chunk").agg(F.collect_list(F.struct("place", *values)).alias("found"))
    return found.select(
        "chunk", F.col("found.place").alias("places"), *[F.col(f"found.{name}").alias(name) for name in values]
    )
