"""Table layouts for lookups (K10) and what they save.

A copy of the orders that is sorted by the looked-up column takes the place of an index on it: the least
and greatest value of every file are kept beside it, and a lookup reads only the files whose bounds hold
its value.
"""

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souqframe.sources.blocks import send_packed
from souqframe.sources.workspace import shuffles_freed


@dataclass(frozen=True)
class Layout:
    name: str
    description: str
    columns: tuple[str, ...]
    descending: frozenset[str] = frozenset()

    @property
    def leading(self) -> str:
        """The column that a lookup names to leave files out."""
        return self.columns[0]

    @property
    def order(self) -> list[Column]:
        return [F.desc(name) if name in self.descending else F.asc(name) for name in self.columns]

    def before(self, cut: tuple) -> Column:
        """Whether a row sorts before the one with the values of `cut`; nulls are the least values."""
        is_before = F.lit(False)
        for name, value in reversed(list(zip(self.columns, cut, strict=True))):
            column, same = F.col(name), F.col(name).eqNullSafe(F.lit(value))
            if name in self.descending:
                less = column.isNotNull() if value is None else F.coalesce(column > value, F.lit(False))
            else:
                less = F.lit(False) if value is None else column.isNull() | (column < value)
            is_before = less | (same & is_before)
        return is_before

    def place(self, cuts: list[tuple], first: int = 0) -> Column:
        """How many of the sorted cuts are not behind a row: as many comparisons as their count has bits."""
        if not cuts:
            return F.lit(first)
        half = len(cuts) // 2
        return F.when(self.before(cuts[half]), self.place(cuts[:half], first)).otherwise(
            self.place(cuts[half + 1 :], first + half + 1)
        )


def layouts() -> dict[str, Layout]:
    """The layouts on offer, by name.

    Each ends with the order id: rows are cut into files along the whole sort order, so a customer, a
    status or a city that holds a third of all orders is spread over many files and tasks.
    """
    offered = [
        Layout(
            "customer_order_date",
            "a customer's orders, last ones first",
            ("customer_id", "order_date", "order_id"),
            frozenset({"order_date"}),
        ),
        Layout("status", "orders with one status", ("status", "order_id")),
        Layout("city", "orders of one city", ("city", "order_id")),
    ]
    return {layout.name: layout for layout in offered}


ROWS = 250_000  # of a file: as many as a task sorts in memory
SAMPLED = 100  # rows of each file to be, for where it begins


def _cuts(orders: DataFrame, chosen: Layout, count: int, files: int) -> list[tuple]:
    """Where the files begin: the sort columns of some SAMPLED rows a file, those whose hash is low, tell."""
    share = min(1.0, SAMPLED * files / max(1, count))
    low = F.pmod(F.xxhash64(*chosen.columns), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = [tuple(row) for row in orders.where(low).select(*chosen.columns).orderBy(*chosen.order).collect()]
    places = [sample[len(sample) * part // files] for part in range(1, files)] if sample else []
    return [cut for cut in dict.fromkeys(places) if cut != sample[0]]


def write_layout(orders: DataFrame, path: str, name: str, files: int | None = None) -> None:
    """Writes a copy of the orders in the named layout, and a row for each file with its first column's bounds.

    There are `files` files, or more if they would have over ROWS rows.
    """
    if name not in layouts():
        raise ValueError(f"no layout '{name}'; there are {', '.join(layouts())}")
    chosen, count = layouts()[name], orders.count()
    cuts = _cuts(orders, chosen, count, max(files or 1, -(-count // ROWS)))
    ranged = send_packed(orders, len(cuts) + 1, chosen.place(cuts))
    with shuffles_freed(orders.sparkSession):
        ranged.sortWithinPartitions(*chosen.order).write.mode("overwrite").parquet(path)
    first, stored = chosen.leading, orders.sparkSession.read.schema(orders.schema).parquet(path)
    stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(first).alias("low"), F.max(first).alias("high"), F.count(F.lit(1)).alias("rows")
    ).coalesce(1).write.mode("overwrite").parquet(bounds_path(path))


def bounds_path(path: str) -> str:
    """Where the bounds of a layout's files are."""
    return f"{path.rstrip('/')}_bounds"


def read_layout(spark: SparkSession, path: str, schema: T.StructType, value: str | None = None) -> DataFrame:
    """A layout, or only those of its files that can hold rows with a value in its leading column."""
    if value is None:
        return spark.read.schema(schema).parquet(path)
    bounds = spark.read.parquet(bounds_path(path))
    holding = bounds.where((F.col("low") <= value) & (F.col("high") >= value)).select("file").collect()
    if not holding:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*sorted(row["file"] for row in holding))


def layout_paths(folder: str) -> dict[str, str]:
    """Where `write_layouts` puts each copy."""
    return {name: f"{folder}/{name}" for name in layouts()}


def write_layouts(orders: DataFrame, folder: str, files: int | None = None) -> dict[str, str]:
    """All the layouts; gives their paths."""
    paths = layout_paths(folder)
    for name, path in paths.items():
        write_layout(orders, path, name, files)
    return paths


@dataclass(frozen=True)
class Lookup:
    query_id: str
    layout: str
    equals: dict[str, str]

    def condition(self) -> Column:
        found = F.lit(True)
        for column, value in self.equals.items():
            found &= F.col(column) == value
        return found

    def leading_value(self) -> str:
        return self.equals[layouts()[self.layout].leading]


def lookups(
    customer_id: str = "CUST-1001", city: str = "Sana'a", status: str = "DELIVERED"
) -> list[Lookup]:
    """The three lookups that are compared. Their ids."""
    return [
        Lookup("Q1_customer_orders", "customer_order_date", {"customer_id": customer_id}),
        Lookup("Q2_city_status", "city", {"city": city, "status": status}),
        Lookup("Q3_status_filter", "status", {"status": status}),
    ]


@dataclass(frozen=True)
class Scan:
    """What the scans of an executed query have counted: files and rows read, rows it returned, and how long it took."""

    files_examined: int
    rows_examined: int
    rows_returned: int
    ms: float


def measured(query: DataFrame) -> Scan:
    """Runs a query without sending its rows anywhere, and takes the counts from the scan nodes of its plan."""
    execution, started = query._jdf.queryExecution(), time.perf_counter()
    returned = execution.toRdd().count()
    ms = round((time.perf_counter() - started) * 1000, 1)
    leaves = execution.executedPlan().collectLeaves()
    counted = {"numFiles": 0, "numOutputRows": 0}
    for place in range(leaves.size()):
        metrics = leaves.apply(place).metrics()
        for name in counted:
            if metrics.contains(name):
                counted[name] += metrics.apply(name).value()
    return Scan(counted["numFiles"], counted["numOutputRows"], returned, ms)


COMPARED = (
    "query_id string, layout string, before_files long, before_files_examined long, before_rows_stored long, "
    "before_rows_examined long, before_rows_returned long, before_scan string, before_ms double, after_files long, "
    "after_files_examined long, after_rows_stored long, after_rows_examined long, after_rows_returned long, "
    "after_scan string, after_ms double, rows_examined_reduction long, reduction_pct double"
)


def compare_layouts(spark: SparkSession, plain_path: str, paths: dict[str, str], compared: list[Lookup]) -> DataFrame:
    """Every lookup run on the plain table and on its layout, one row each, with what the scans counted.

    `reduction_pct` is the share of examined rows that the layout saves.
    """
    plain = spark.read.parquet(plain_path)
    schema, rows = plain.schema, []
    for lookup in compared:
        path = paths[lookup.layout]
        sides = {
            "before": (plain, plain),
            "after": (read_layout(spark, path, schema), read_layout(spark, path, schema, lookup.leading_value())),
        }
        row: dict = {"query_id": lookup.query_id, "layout": lookup.layout}
        for side, (whole, part) in sides.items():
            scan, files = measured(part.where(lookup.condition())), len(whole.inputFiles())
            row |= {
                f"{side}_files": files,
                f"{side}_files_examined": scan.files_examined,
                f"{side}_rows_stored": whole.count(),
                f"{side}_rows_examined": scan.rows_examined,
                f"{side}_rows_returned": scan.rows_returned,
                f"{side}_scan": "SKIPS FILES" if scan.files_examined < files else "FULL SCAN",
                f"{side}_ms": scan.ms,
            }
        saved = row["before_rows_examined"] - row["after_rows_examined"]
        row["rows_examined_reduction"] = saved
        row["reduction_pct"] = round(100 * saved / max(1, row["before_rows_examined"]), 2)
        rows.append(row)
    return spark.createDataFrame(rows, COMPARED)
