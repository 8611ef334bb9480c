"""Records of text files that may hold line breaks inside quotes, read split by split.

Whether a split of a file starts inside quotes depends on all quotes before it. So the quotes of each
split are counted first, a number a split, and a prefix sum over a file's splits tells each one how it
starts. Then every split puts its own lines together to records. What is left at its ends, the end of a
record that began before and the begin of one that goes on, is joined across splits.

A quote that does not open or close a field must be doubled, as CSV asks for.
"""

from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, TaskContext
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 32  # of a record's position that count lines within a split

RECORDS = "record string, file_source string, _position long"
_PIECES = T.StructType(
    [
        T.StructField("file_source", T.StringType()),
        T.StructField("split", T.LongType()),
        T.StructField("line", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("record", T.StringType()),
    ]
)
WHOLE, BEGUN, GOING, ENDED = "whole", "begun", "going", "ended"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with file and split; a split is named by the place where it starts."""
    return spark.read.text(path, lineSep="\n").select(
        "value",
        F.col("_metadata.file_path").alias("file_source"),
        F.col("_metadata.file_block_start").alias("split"),
    )


def split_starts(lines: DataFrame) -> DataFrame:
    """One row for each split: its place among those of its file, and whether it starts inside quotes."""
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    before = Window.partitionBy("file_source").orderBy("split")
    return (
        lines.groupBy("file_source", "split")
        .agg(F.sum(quotes).alias("quotes"))
        .select(
            "file_source",
            "split",
            (F.row_number().over(before) - 1).alias("place"),
            (F.coalesce(F.sum("quotes").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2 == 1)
            .alias("inside"),
        )
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each split in the order in which lines come: whole ones, and what is left at both ends.

    Lines of a split come one after the other. `open` has the lines of a record that is not closed yet.
    """
    split = None  # file, split
    inside, line, open_, first, kind = False, 0, [], 0, WHOLE

    def piece(kind: str, at: int, parts: list[str]) -> tuple:
        return (*split, at, kind, "\n".join(parts))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(_PIECES)
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _PIECES.names)

    for batch in batches:
        rows = []
        values = batch.column("value")
        odd = (pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2).astype(bool)
        files, splits = batch.column("file_source").to_pylist(), batch.column("split").to_pylist()
        starts = batch.column("inside").to_pylist()
        for place, value in enumerate(values.to_pylist()):
            if split != (files[place], splits[place]):
                if open_:
                    rows.append(piece(kind if kind == GOING else BEGUN, first, open_))
                split, line, open_ = (files[place], splits[place]), 0, []
                inside = starts[place]
                kind = GOING if inside else WHOLE
            if not open_:
                first = line
            open_.append(value)
            inside ^= bool(odd[place])
            line += 1
            if not inside:
                rows.append(piece(ENDED if kind == GOING else WHOLE, first, open_))
                open_, kind = [], WHOLE
        yield batch_of(rows)
    if open_:
        yield batch_of([piece(kind if kind == GOING else BEGUN, first, open_)])


def read_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """The records of text files: record, file_source and a position that rises through each file.

    With `header`, the first record of each file is left out, and so are blank lines. A record that
    is still open at the end of its file is one as well.
    """
    lines = _lines(spark, path)
    # A few bytes for each split of the files.
    starts = F.broadcast(split_starts(lines))
    told = lines.join(starts, ["file_source", "split"], "left").select("value", "file_source", "split", "inside")
    pieces = told.mapInArrow(_pieces, _PIECES).join(starts.drop("inside"), ["file_source", "split"])
    position = F.shiftleft(F.col("place").cast("long"), BITS) + F.col("line")
    pieces = pieces.select("record", "file_source", position.alias("_position"), "kind")
    # A piece goes on with the next one of its file, until one ends; two pieces a split at most.
    before = Window.partitionBy("file_source").orderBy("_position")
    parts = pieces.where(F.col("kind") != WHOLE).withColumn(
        "of", F.last(F.when(F.col("kind") == BEGUN, F.col("_position")), ignorenulls=True).over(before)
    )
    joined = parts.groupBy("file_source", "of").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("_position", "record"))), lambda part: part["record"]), "\n"
        ).alias("record")
    )
    records = pieces.where(F.col("kind") == WHOLE).select("record", "file_source", "_position").unionAll(
        joined.select("record", "file_source", F.col("of").alias("_position"))
    )
    records = records.withColumn("record", F.rtrim("record", F.lit("\r"))).where(F.col("record") != "")
    return records.where(F.col("_position") > 0) if header else records


def _leading(lines: DataFrame, partitions: int) -> DataFrame:
    """The rows of the first partitions only; no task runs for the others."""
    spark = lines.sparkSession
    context = spark.sparkContext
    wanted = spark._jvm.PythonUtils.toSeq(list(range(partitions))).toSet()  # a set is a function of its members
    rows = lines._jdf.javaToPython().rdd()
    pruned = spark._jvm.org.apache.spark.rdd.PartitionPruningRDD.create(rows, wanted).toJavaRDD()
    return spark.createDataFrame(RDD(pruned, context, BatchedSerializer(CPickleSerializer())), lines.schema)


def leading_records(spark: SparkSession, path: str, count: int) -> tuple[DataFrame, int]:
    """The first `count` records of an order file, none with line breaks, and how many there are of them.

    An order file that was written in parts is a folder; its parts follow each other by name. The first
    parts are looked at, twice as many each time, until they have enough.
    """
    files, taken = sorted(unquote(file) for file in spark.read.text(path).inputFiles()), 1
    while True:
        records, found = _leading_records(spark, files[:taken] or [path], count)
        if found >= count or taken >= len(files):
            return records, found
        taken *= 2


def _leading_records(spark: SparkSession, files: list[str], count: int) -> tuple[DataFrame, int]:
    """The first `count` records of some files in their order.

    The lines of the first splits are counted, of twice as many each time, until there are enough; what
    the splits before it have tells each one how many it gives. No other split is read, and no row
    reaches the driver. The first line of a file is its header.
    """
    # Reading them together would not keep their order.
    lines = reduce(DataFrame.unionAll, [_lines(spark, file) for file in files]).where(F.trim("value") != "")
    named = lines.select("file_source", "split").rdd

    def counted(part: Iterator) -> list[int]:
        return [sum(not header for header in _headers((row.file_source, row.split) for row in part))]

    counts: list[int] = []
    while sum(counts) < count and len(counts) < named.getNumPartitions():
        asked = range(len(counts), min(named.getNumPartitions(), 2 * len(counts) + 1))
        counts += spark.sparkContext.runJob(named, counted, list(asked))
    while counts and sum(counts[:-1]) >= count:
        counts.pop()
    gives = [min(own, count - sum(counts[:place])) for place, own in enumerate(counts)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        left, line, before = gives[partition], 0, None
        for batch in batches:
            if not left:
                break
            names = list(zip(batch.column("file_source").to_pylist(), batch.column("split").to_pylist(), strict=True))
            header = np.fromiter(_headers(names, before), bool, len(names))
            before = names[-1] if names else before
            places = np.flatnonzero(~header)[:left]
            taken = batch.take(pa.array(places))
            position = (partition << BITS) + line + places
            left, line = left - len(places), line + len(names)
            yield pa.RecordBatch.from_arrays(
                [pc.utf8_rtrim(taken.column("value"), "\r"), taken.column("file_source"), pa.array(position)],
                ["record", "file_source", "_position"],
            )

    return _leading(lines, len(counts)).mapInArrow(cut, RECORDS), sum(gives)


def _headers(names, before: tuple | None = None) -> Iterator[bool]:
    """Of each line, by its file and split: whether it is the first one of its file."""
    for name in names:
        yield name != before and name[1] == 0
        before = name
