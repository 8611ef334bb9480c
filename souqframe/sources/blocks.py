"""Whole rows sent through a shuffle in blocks, packed by columns.

An order takes some 640 bytes as a row of a shuffle, but a quarter of that in a Parquet file: its texts repeat
much from row to row. So each task puts the rows that go to the same task together, a bounded part of its input
at a time, and sends them as one small Parquet file.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HELD = 64 << 20  # bytes of rows that a task puts together before it sends them
_PLACE, _BLOCK = "_place", "_block"
_BLOCKS = f"{_PLACE} int, kind int, {_BLOCK} binary"
Batches = Iterator[pa.RecordBatch]


def _packed(rows: pa.Table) -> bytes:
    packed = pa.BufferOutputStream()
    with pa.CompressedOutputStream(packed, "zstd") as stream:
        pq.write_table(rows, stream, compression="none", write_statistics=False, store_schema=False)
    return packed.getvalue().to_pybytes()


def _unpacked(block: pa.BinaryScalar) -> pa.Table:
    with pa.input_stream(block.as_buffer(), compression="zstd") as stream:
        return pq.ParquetFile(pa.BufferReader(stream.read())).read(use_threads=False)


def _blocks(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One block for the rows of each place and kind."""
    rows = pa.Table.from_batches(held)
    place, kind = rows.column(_PLACE).to_numpy(), rows.column("_kind").to_numpy()
    order = np.lexsort((kind, place))
    rows, place, kind = rows.drop_columns([_PLACE, "_kind"]).take(pa.array(order)), place[order], kind[order]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 0) | (np.diff(kind) != 0)]))
    blocks = [_packed(rows.slice(low, high - low)) for low, high in zip(first, [*first[1:], len(place)], strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(place[first], pa.int32()), pa.array(kind[first], pa.int32()), pa.array(blocks, pa.binary())],
        [_PLACE, "kind", _BLOCK],
    )


def _pack(batches: Batches) -> Batches:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= HELD:
            yield _blocks(held)
            held, size = [], 0
    if held:
        yield _blocks(held)


def _unpack(batches: Batches) -> Batches:
    for batch in batches:
        for block in batch.column(_BLOCK):
            yield from _unpacked(block).to_batches()


def _meet(key: str, flag: str) -> Callable[[Batches], Batches]:
    """Rows of kind 1 as they come, their keys noted; then those of kind 0, packed until now, told by these keys."""

    def unpack(batches: Batches) -> Batches:
        keys, waiting = [], []
        for batch in batches:
            for kind, block in zip(batch.column("kind").to_pylist(), batch.column(_BLOCK), strict=True):
                if not kind:
                    waiting.append(pa.scalar(block.as_py(), pa.binary()))  # the batch itself need not be kept
                    continue
                rows = _unpacked(block)
                keys += rows.column(key).chunks
                yield from rows.append_column(flag, pa.array(np.zeros(rows.num_rows, bool))).to_batches()
        known = pa.chunked_array(keys, pa.string())
        while waiting:
            rows = _unpacked(waiting.pop())
            yield from rows.append_column(flag, pc.is_in(rows.column(key), known)).to_batches()

    return unpack


def send_packed(rows: DataFrame, tasks: int, task: Column) -> DataFrame:
    """The rows, each in the task whose number `task` gives."""
    sent = rows.withColumns({_PLACE: task, "_kind": F.lit(0)}).mapInArrow(_pack, _BLOCKS)
    return sent.repartitionById(tasks, _PLACE).mapInArrow(_unpack, rows.schema)


def send_to_meet(rows: DataFrame, tasks: int, task: Column, coming: Column, key: str, flag: str) -> DataFrame:
    """The same, with a column `flag` that says of a row that does not come whether one with its key does.

    The key is a string, and no task may get more rows than its memory holds packed.
    """
    sent = rows.withColumns({_PLACE: task, "_kind": coming.cast("int")}).mapInArrow(_pack, _BLOCKS)
    schema = T.StructType([*rows.schema.fields, T.StructField(flag, T.BooleanType())])
    return sent.repartitionById(tasks, _PLACE).mapInArrow(_meet(key, flag), schema)
