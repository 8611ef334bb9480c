from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souqframe.operators.outcomes import fingerprint, upsert_is_idempotent
from souqframe.sources.tables import KeyedTable, newest_per_key

SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("value", T.LongType()),
        T.StructField("at", T.DoubleType()),
    ]
)


def table(spark, tmp_path, **options):
    return KeyedTable(spark, str(tmp_path / "table"), SCHEMA, "id", **options)


def batch(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def contents(keyed):
    return {row["id"]: row["value"] for row in keyed.read().collect()}


def test_upsert_replaces_and_keeps(spark, tmp_path):
    keyed = table(spark, tmp_path, buckets=3)
    keyed.upsert(batch(spark, ("a", 1, 1.0), ("b", 2, 1.0), ("c", 3, 1.0)), ["at"])
    keyed.upsert(batch(spark, ("b", 20, 2.0), ("d", 4, 2.0)), ["at"])
    assert contents(keyed) == {"a": 1, "b": 20, "c": 3, "d": 4}
    assert keyed.duplicate_keys().isEmpty()


def test_newest_row_of_a_key_wins_and_rows_without_key_are_left_out(spark, tmp_path):
    keyed = table(spark, tmp_path)
    keyed.upsert(batch(spark, ("a", 1, 3.0), ("a", 2, 9.0), ("a", 3, 5.0), (None, 4, 9.0)), ["at"])
    assert contents(keyed) == {"a": 2}


def test_same_batch_twice(spark, tmp_path):
    keyed, rows = table(spark, tmp_path), batch(spark, ("a", 1, 1.0), ("b", 2, 1.0))
    keyed.upsert(rows, ["at"])
    before = fingerprint(keyed.read())
    keyed.upsert(rows, ["at"])
    assert fingerprint(keyed.read()) == before


def test_a_job_that_died_leaves_no_trace(spark, tmp_path, monkeypatch):
    keyed = table(spark, tmp_path, tracked=("value",))
    keyed.upsert(batch(spark, ("a", 1, 1.0), ("b", 2, 1.0)), ["at"])
    with monkeypatch.context() as dying:
        dying.setattr(KeyedTable, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            keyed.upsert(batch(spark, ("a", 100, 2.0), ("z", 5, 2.0)), ["at"])
    assert contents(keyed) == {"a": 1, "b": 2}
    gen = keyed.upsert(batch(spark, ("b", 3, 2.0)), ["at"])
    assert contents(keyed) == {"a": 1, "b": 3}
    assert [tuple(row) for row in keyed.changes(gen - 1, gen).collect()] == [("b", 2, 3)]


def test_changes_of_several_commits(spark, tmp_path):
    keyed = table(spark, tmp_path, tracked=("value",))
    keyed.upsert(batch(spark, ("a", 1, 1.0)), ["at"])
    keyed.upsert(batch(spark, ("a", 2, 2.0), ("b", 7, 2.0)), ["at"])
    keyed.delete(spark.createDataFrame([("b",), ("nobody",)], "id string"))
    changes = [tuple(row) for row in keyed.changes(0, keyed.last_gen()).collect()]
    assert sorted(map(repr, changes)) == sorted(
        map(repr, [("a", None, 1), ("a", 1, 2), ("b", None, 7), ("b", 7, None)])
    )
    assert contents(keyed) == {"a": 2}


def test_overwrite_clear_and_vacuum(spark, tmp_path):
    keyed = table(spark, tmp_path, buckets=2)
    keyed.overwrite(batch(spark, ("a", 1, 1.0)), source_gen=4)
    keyed.overwrite(batch(spark, ("b", 2, 1.0)), source_gen=5)
    assert contents(keyed) == {"b": 2} and keyed.source_gen() == 5
    assert keyed.vacuum() == [1] and contents(keyed) == {"b": 2}
    keyed.clear()
    assert contents(keyed) == {}


def numbered(spark, first, end, at=1.0):
    return spark.range(first, end).select(
        F.format_string("k%06d", "id").alias("id"), F.col("id").alias("value"), F.lit(at).alias("at")
    )


def test_buckets_stay_where_they_were_cut(spark, tmp_path):
    table(spark, tmp_path, buckets=5).upsert(numbered(spark, 0, 100), ["at"])
    again = table(spark, tmp_path, buckets=2)
    lows = [bucket.low for bucket in again._state().buckets]
    assert lows == [None, "k000020", "k000040", "k000060", "k000080"]
    again.upsert(numbered(spark, 50, 150, at=2.0), ["at"])
    assert [bucket.low for bucket in again._state().buckets] == lows
    assert len(contents(again)) == again.row_count() == 150


def folder_size(path):
    return sum(file.stat().st_size for file in path.rglob("*.parquet"))


@pytest.mark.parametrize("partitions", ["1", "4", "13"])
def test_new_ids_rewrite_few_buckets_one_file_each(spark, tmp_path, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        keyed = table(spark, tmp_path, buckets=40, rows_per_bucket=1000)
        keyed.upsert(numbered(spark, 0, 20_000), ["at"])
        keyed.upsert(numbered(spark, 20_000, 20_050), ["at"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    whole, rewritten = (folder_size(tmp_path / "table" / "data" / f"gen={gen}") for gen in (1, 2))
    assert rewritten < 0.05 * whole
    for bucket in keyed._state().buckets:
        folder = tmp_path / "table" / "data" / f"gen={bucket.gen}" / f"run={bucket.run}" / "state=kept"
        assert len(list((folder / f"bucket={bucket.number}").glob("*.parquet"))) == 1
    assert len(contents(keyed)) == 20_050


def test_a_bucket_that_grows_is_cut(spark, tmp_path):
    keyed = table(spark, tmp_path, buckets=2, rows_per_bucket=100)
    for first in range(0, 900, 300):
        keyed.upsert(numbered(spark, first, first + 300), ["at"])
    buckets = keyed._state().buckets
    assert len(buckets) >= 6 and max(bucket.rows for bucket in buckets) <= 250
    assert keyed.read().count() == keyed.row_count() == 900 and keyed.duplicate_keys().isEmpty()
    keyed.upsert(numbered(spark, 100, 800, at=5.0).withColumn("value", F.lit(-1)), ["at"])
    assert keyed.read().where("value = -1").count() == 700 and keyed.row_count() == 900


def test_one_percent_of_distinct_keys_is_not_sorted(spark, tmp_path, monkeypatch):
    keyed, plans = table(spark, tmp_path, buckets=4), []
    keyed.upsert(numbered(spark, 0, 2000), ["at"])
    winners, count = keyed._winners(numbered(spark, 0, 20), ["at"], 2)
    assert count == 20
    plans.append(winners._jdf.queryExecution().executedPlan().toString())
    assert "Sort" not in plans[0] and "Exchange" not in plans[0]


@pytest.mark.parametrize("sent, written", [(100, 2), (1, 2000)])
def test_of_a_batch_with_few_repeated_keys_only_those_are_written_again(spark, tmp_path, monkeypatch, sent, written):
    from souqframe.sources import tables

    monkeypatch.setattr(tables, "SENT", sent)
    twice = numbered(spark, 5, 7, at=3.0).withColumn("value", F.lit(-1))
    rows, count = table(spark, tmp_path)._winners(numbered(spark, 0, 2000).unionAll(twice), ["at"], 1)
    assert count == rows.count() == rows.select("id").distinct().count() == 2000
    assert sorted(row["id"] for row in rows.where("value = -1").collect()) == ["k000005", "k000006"]
    folders = list((tmp_path / "table" / "repeated").glob("*/rows"))
    assert [spark.read.parquet(str(folder)).count() for folder in folders] == [written]


def test_the_second_of_two_writers_fails(spark, tmp_path, monkeypatch):
    one, other = table(spark, tmp_path, tracked=("value",)), table(spark, tmp_path, tracked=("value",))
    one.upsert(batch(spark, ("a", 1, 1.0)), ["at"])
    commit = KeyedTable._commit

    def late(self, gen, *more):
        with monkeypatch.context() as undone:
            undone.setattr(KeyedTable, "_commit", commit)
            other.upsert(batch(spark, ("b", 2, 1.0)), ["at"])
        commit(self, gen, *more)

    monkeypatch.setattr(KeyedTable, "_commit", late)
    with pytest.raises(Exception, match="already exists"):
        one.upsert(batch(spark, ("c", 3, 1.0)), ["at"])
    monkeypatch.undo()
    assert contents(one) == {"a": 1, "b": 2}
    assert [row["id"] for row in one.signed_changes(1, 2).collect()] == ["b"]


@pytest.mark.parametrize("fault", ["lost", "doubled"])
def test_a_lost_or_doubled_row_is_noticed(spark, tmp_path, monkeypatch, fault):
    keyed = table(spark, tmp_path, buckets=1)
    keyed.upsert(numbered(spark, 0, 50), ["at"])
    rows = keyed._rows

    def wrong(state, only=None):
        found = rows(state, only)
        return found.where("id != 'k000007'") if fault == "lost" else found.unionAll(found.where("id = 'k000007'"))

    monkeypatch.setattr(keyed, "_rows", wrong)
    with pytest.raises(RuntimeError, match="51 rows became|50 rows became|rows became"):
        keyed.upsert(numbered(spark, 60, 61), ["at"])
    monkeypatch.undo()
    assert len(contents(keyed)) == 50


def test_what_was_written_is_read_back(spark, tmp_path, monkeypatch):
    keyed, write = table(spark, tmp_path, buckets=1), DataFrameWriter.parquet

    def losing(self, path, *more, **options):
        write(self, path, *more, **options)
        if "/data/" in path:
            for file in Path(path).rglob("*.parquet"):
                file.unlink()

    monkeypatch.setattr(DataFrameWriter, "parquet", losing)
    with pytest.raises(RuntimeError, match="not the 50 written"):
        keyed.upsert(numbered(spark, 0, 50), ["at"])
    monkeypatch.undo()
    assert keyed.last_gen() == 0


def test_changes_of_a_writer_that_died_after_its_commit_appear(spark, tmp_path, monkeypatch):
    keyed = table(spark, tmp_path, tracked=("value",))
    with monkeypatch.context() as dying:
        dying.setattr(KeyedTable, "_publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            keyed.upsert(batch(spark, ("a", 1, 1.0)), ["at"])
    assert keyed.last_gen() == 1
    assert [tuple(row) for row in keyed.signed_changes(0, 1).collect()] == [("a", 1, 1, 1)]


def test_small_upsert_leaves_other_buckets_alone(spark, tmp_path):
    keyed = table(spark, tmp_path, buckets=8)
    rows = spark.range(200).select(
        F.concat(F.lit("k"), "id").alias("id"), F.col("id").alias("value"), F.lit(1.0).alias("at")
    )
    keyed.upsert(rows, ["at"])
    keyed.upsert(batch(spark, ("k7", 0, 2.0)), ["at"])
    owners = keyed._state().owners
    assert len(owners[2]) == 1 and len(owners[1]) == 7
    assert len(contents(keyed)) == 200 and contents(keyed)["k7"] == 0


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        F.col("id").alias("value"),
        F.col("id").cast("double").alias("at"),
    )
    newest = newest_per_key(rows, "id", ["at"])
    assert newest.where("id = 'hot'").first()["value"] == 2997
    assert newest.count() == 2001
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange")


def test_idempotency_check(spark, tmp_path, warehouse):
    from souqframe.operators.validation import apply_all_quality_rules
    from tests.conftest import raw_orders

    cleaned = apply_all_quality_rules(raw_orders(spark, [{"order_id": f"O{n}"} for n in range(20)]))
    warehouse.validated.upsert(cleaned)
    assert upsert_is_idempotent(warehouse.validated, cleaned)


def test_many_rows_that_leave_meet_what_comes_in_one_shuffle(spark, tmp_path, monkeypatch):
    from souqframe.sources import tables

    monkeypatch.setattr(tables, "SENT", 0)
    keyed, plans, write = table(spark, tmp_path, tracked=("value",), buckets=5), [], KeyedTable._write

    def seen(self, state, touched, dealt, *more):
        plans.append(dealt._jdf.queryExecution().executedPlan().toString())
        return write(self, state, touched, dealt, *more)

    monkeypatch.setattr(KeyedTable, "_write", seen)
    keyed.upsert(numbered(spark, 0, 500), ["at"])
    keyed.upsert(numbered(spark, 300, 700, at=2.0).withColumn("value", F.lit(-1)), ["at"])
    assert "Join" not in plans[1] and plans[1].count("Exchange") == 1
    keyed.delete(numbered(spark, 0, 100).unionAll(numbered(spark, 600, 900)))
    rows = contents(keyed)
    assert rows == {f"k{n:06d}": n if n < 300 else -1 for n in range(100, 600)}
    changed = keyed.signed_changes(1, 3).groupBy("gen", "sign").count().collect()
    assert sorted(map(tuple, changed)) == [(2, -1, 200), (2, 1, 400), (3, -1, 200)]


@pytest.mark.parametrize("stored", [False, True])
def test_a_batch_is_worked_out_once(spark, tmp_path, stored):
    worked_out = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def key(number):
        worked_out.add(1)
        return f"k{number:03d}"

    rows = spark.range(100).select(key("id").alias("id"), F.col("id").alias("value"), F.lit(1.0).alias("at"))
    keyed = table(spark, tmp_path, buckets=4)
    keyed.upsert(rows, ["at"], stored=stored)
    assert len(contents(keyed)) == 100
    assert stored or worked_out.value == 100


@pytest.mark.parametrize("sent", [100, 0])
def test_what_leaves_with_a_batch_is_one_commit(spark, tmp_path, monkeypatch, sent):
    from souqframe.sources import tables

    monkeypatch.setattr(tables, "SENT", sent)
    keyed = table(spark, tmp_path, tracked=("value",), buckets=4)
    keyed.upsert(numbered(spark, 0, 40), ["at"])
    keys = numbered(spark, 10, 25).unionAll(numbered(spark, 90, 95)).select("id")
    later = numbered(spark, 20, 30, at=2.0).withColumn("value", F.lit(-1).cast("long"))
    assert keyed.upsert(later, ["at"], leaving=keys) == 2
    expected = {f"k{n:06d}": -1 if 20 <= n < 30 else n for n in range(40) if not 10 <= n < 20}
    assert contents(keyed) == expected and keyed.row_count() == 30
    changed = keyed.signed_changes(1, 2).groupBy("sign").count().collect()
    assert sorted(map(tuple, changed)) == [(-1, 20), (1, 10)]
    assert keyed.upsert(numbered(spark, 0, 0), ["at"], leaving=keys) == 3
    assert sorted(contents(keyed)) == [f"k{n:06d}" for n in [*range(10), *range(25, 40)]]
