import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from souqframe.operators.validation import apply_all_quality_rules
from souqframe.sources import blocks, layout
from souqframe.sources.tables import KeyedTable
from souqframe.sources.workspace import shuffles_freed
from tests.conftest import raw_orders


def cleaned(spark, count):
    changes = [
        {"order_id": f"O{n:04d}", "customer_id": None if n % 11 == 0 else f"C{n % 7}", "delivery_cost": "خمسة",
         "order_date": None if n % 5 == 0 else f"{n % 28 + 1:02d}/01/2024", "items_json": "[]" if n % 3 else "[{}]"}
        for n in range(count)
    ]
    return apply_all_quality_rules(raw_orders(spark, changes))


def test_rows_come_as_they_were_each_in_its_task(spark):
    rows = cleaned(spark, 300).withColumn("nothing", F.lit(None).cast("array<struct<a:date,b:binary>>"))
    rows = rows.withColumn("x", F.when(F.col("number_row_source") % 2 == 0, F.lit(float("nan"))))
    sent = blocks.send_packed(rows, 5, (F.col("number_row_source") % 5).cast("int"))
    assert sent.schema == rows.schema
    assert sorted(map(str, sent.collect())) == sorted(map(str, rows.collect()))
    tasks = sent.select(F.spark_partition_id().alias("task"), (F.col("number_row_source") % 5).alias("asked"))
    assert sorted(map(tuple, tasks.distinct().collect())) == [(n, n) for n in range(5)]


def test_a_task_holds_a_bounded_part(monkeypatch):
    monkeypatch.setattr(blocks, "HELD", 2000)
    batch = pa.RecordBatch.from_pydict(
        {"v": [f"{n}" * 9 for n in range(100)], "_place": pa.array([n % 3 for n in range(100)], pa.int32()),
         "_kind": pa.array([n % 2 for n in range(100)], pa.int32())}
    )
    sent = list(blocks._pack(iter([batch] * 8)))
    assert len(sent) > 2 and all(block.num_rows == 6 for block in sent)
    assert sum(part.num_rows for part in blocks._unpack(iter(sent))) == 800


def test_what_stands_meets_what_comes(spark):
    stands = spark.range(100).select(F.format_string("k%d", "id").alias("k"), F.lit(False).alias("comes"))
    comes = spark.range(90, 120).select(F.format_string("k%d", "id").alias("k"), F.lit(True).alias("comes"))
    task = F.pmod(F.xxhash64("k"), F.lit(4)).cast("int")
    met = blocks.send_to_meet(comes.unionAll(stands), 4, task, F.col("comes"), "k", "met")
    rows = {(row["k"], row["comes"]): row["met"] for row in met.collect()}
    assert len(rows) == 130
    assert {key for key, told in rows.items() if told} == {(f"k{n}", False) for n in range(90, 100)}


def shuffled(rows):
    """Bytes that the shuffle of a query wrote."""
    spark = rows.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = rows.select("*")._jdf.queryExecution()
        execution.toRdd().count()
        nodes, found = [execution.executedPlan()], 0
        while nodes:
            node = nodes.pop()
            if node.metrics().contains("shuffleBytesWritten"):
                found += node.metrics().apply("shuffleBytesWritten").value()
            nodes += [node.children().apply(place) for place in range(node.children().size())]
        return found
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_many_rows_of_a_table_take_less_than_half_the_bytes(spark, tmp_path, monkeypatch):
    from souqframe.schemas import CLEAN_SCHEMA
    from souqframe.sources import tables

    spark.createDataFrame(cleaned(spark, 2000).collect(), CLEAN_SCHEMA).write.parquet(str(tmp_path / "rows"))
    rows, sent, write = spark.read.parquet(str(tmp_path / "rows")), [], KeyedTable._write

    def seen(self, state, touched, dealt, *more):
        sent.append(shuffled(dealt))
        return write(self, state, touched, dealt, *more)

    monkeypatch.setattr(KeyedTable, "_write", seen)
    for most in (10_000, 100):
        monkeypatch.setattr(tables, "SENT", most)
        keyed = KeyedTable(spark, str(tmp_path / f"table{most}"), CLEAN_SCHEMA, "order_id", buckets=3)
        keyed.upsert(rows, stored=True)
        assert keyed.row_count() == 2000
    assert 0 < sent[1] < sent[0] / 2


@pytest.mark.parametrize("name", ["customer_order_date", "status", "city"])
def test_files_of_a_layout_follow_each_other_in_its_order(spark, tmp_path, name):
    path = str(tmp_path / name)
    orders = cleaned(spark, 400).where("order_id != 'O0007'")
    layout.write_layout(orders, path, name, files=6)
    files = sorted(spark.read.parquet(path).inputFiles())
    assert 4 <= len(files) <= 6
    columns = layout.layouts()[name].columns
    rows = [tuple(row) for file in files for row in spark.read.parquet(file).select(*columns).collect()]
    assert rows == [tuple(row) for row in orders.orderBy(*layout.layouts()[name].order).select(*columns).collect()]


def shuffle_files(spark):
    """The shuffle files that there are, with their sizes."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [files.apply(place) for place in range(files.size())]
    return {file.getName(): file.length() for file in files if "shuffle" in file.getName()}


def test_rows_that_were_moved_leave_no_shuffle_files(spark, tmp_path, warehouse):
    def left():
        return sum(size for name, size in shuffle_files(spark).items() if name not in before)

    cleaned(spark, 2000).write.parquet(str(tmp_path / "rows"))
    orders, before = spark.read.parquet(str(tmp_path / "rows")), shuffle_files(spark)
    warehouse.validated.upsert(orders, stored=True)
    layout.write_layout(orders, str(tmp_path / "city"), "city", files=3)
    until = time.time() + 20  # Spark deletes them behind the query
    while left() > 20_000 and time.time() < until:
        time.sleep(0.2)
    assert left() < 20_000  # counts and samples, some bytes a task
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    with pytest.raises(ValueError), shuffles_freed(spark):
        raise ValueError
    assert spark.conf.get(name, None) == was


def test_a_table_is_cleared_without_moving_rows(spark, tmp_path, warehouse):
    warehouse.validated.upsert(cleaned(spark, 30))
    gen = warehouse.validated.clear()
    assert gen == 2 and warehouse.validated.read().isEmpty() and warehouse.validated.row_count() == 0
    assert not (tmp_path / "warehouse" / "orders_validated" / "data" / "gen=2").exists()
    signs = warehouse.validated.signed_changes(0, 2).groupBy("gen", "sign").count().collect()
    assert sorted(map(tuple, signs)) == [(1, 1, 30), (2, -1, 30)]
    assert warehouse.validated.clear() == 2
    warehouse.validated.upsert(cleaned(spark, 10))
    assert warehouse.validated.row_count() == 10
