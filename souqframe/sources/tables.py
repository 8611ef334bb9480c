"""Keyed Parquet tables: at most one row per key, upserts that can be repeated (U1: K2-K6, K9).

A table is a folder:

    data/gen=7/run=a/state=kept/bucket=3/   all current rows of the buckets that commit 7 rewrote
    data/gen=7/run=a/state=gone/bucket=3/   of the rows it took out: key and tracked columns
    incoming/                               the rows to put in, until it is done
    changes/gen=7/                          key and tracked columns of both, with a sign
    commits/7.json                          the buckets as of commit 7: where each begins, who holds it, its rows

A bucket is a range of keys, cut where a sample of the first keys says. Keys that are close to each other,
such as the next order ids, fall into few buckets, and only those are rewritten; one that has grown too
large is cut as it is rewritten. Rows count from the moment their commit file appears. A job that dies
before that leaves the table as it was. Of two writers at a time the second one fails: each has folders
of its own, and no commit file is written twice.
"""

import json
from bisect import bisect_left
from dataclasses import astuple, dataclass, replace
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souqframe.sources.blocks import send_packed, send_to_meet
from souqframe.sources.workspace import create_text, exists, names_in, read_text, remove, rename, shuffles_freed

# What makes one row of a batch newer than another with the same key.
NEWEST_BY = ["at_ingested", "number_row_source", "file_source", "id_run"]

ROWS = 250_000  # of a bucket; one with twice as many is cut
SAMPLED = 100  # keys of each bucket to be, for where it begins
SENT = 100_000  # keys that leave are sent to all tasks; more of them meet the rows that stand in their buckets


def newest_per_key(batch: DataFrame, key: str, newest_by: list[str]) -> DataFrame:
    """The newest row of every key; rows without a key are left out.

    An aggregate, not a window: each task first reduces its own rows to one per key, so a key that
    holds a third of the batch sends one row per task through the shuffle.
    """
    newest = F.max_by(F.struct(*batch.columns), F.struct(*newest_by))
    return (
        batch.where(F.col(key).isNotNull()).groupBy(key).agg(newest.alias("_row")).select("_row.*")
    )


def winners(batch: DataFrame, key: str, newest_by: list[str], folder: str) -> tuple[DataFrame, int]:
    """The newest row of every key of a batch that is cheap to read, and how many that are.

    The keys alone are counted first. Where each comes once, as in most batches, the rows are not
    shuffled; else only the rows of those that come again are reduced to the newest. These are written
    down, as they are read several times; with more than SENT such keys, all winners are, so that the
    others are not shuffled as often to tell them apart.
    """
    batch = batch.where(F.col(key).isNotNull())
    keys = batch.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    spark = batch.sparkSession
    with shuffles_freed(spark):
        count, repeated = keys.agg(F.count(F.lit(1)), F.count_if(F.col("n") > 1)).first()
    if not repeated:
        return batch, count
    # Written down: its size is known then, and Spark broadcasts it if it is small.
    with shuffles_freed(spark):
        keys.where("n > 1").select(key).write.parquet(f"{folder}/keys")
    again = spark.read.parquet(f"{folder}/keys")
    few = repeated <= SENT
    again = F.broadcast(again) if few else again
    newest = newest_per_key(batch.join(again, key, "left_semi").select(batch.columns), key, newest_by)
    once = batch.join(again, key, "left_anti").select(batch.columns)
    with shuffles_freed(spark):
        (newest if few else once.unionAll(newest)).write.parquet(f"{folder}/rows")
    stored = spark.read.schema(batch.schema).parquet(f"{folder}/rows")
    return once.unionAll(stored) if few else stored, count


@dataclass(frozen=True)
class Bucket:
    """Keys from `low` (None: from the first) up to the next bucket's, in the folder of commit `gen` and its run."""

    number: int
    low: str | None
    gen: int
    run: str
    rows: int


@dataclass(frozen=True)
class State:
    """What the last commit says: its number, how far a summary has got, the buckets by their keys."""

    last_gen: int = 0
    source_gen: int = 0
    buckets: tuple[Bucket, ...] = ()

    @property
    def owners(self) -> dict[int, list[int]]:
        """The buckets that each commit still holds."""
        held: dict[int, list[int]] = {}
        for bucket in self.buckets:
            held.setdefault(bucket.gen, []).append(bucket.number)
        return held

    def bucket_of(self, key: Column | str) -> Column:
        """The number of a key's bucket: as many comparisons as the buckets' count has bits."""

        def place(buckets: tuple[Bucket, ...]) -> Column:
            if len(buckets) == 1:
                return F.lit(buckets[0].number)
            half = len(buckets) // 2
            return F.when(F.col(key) < buckets[half].low, place(buckets[:half])).otherwise(place(buckets[half:]))

        return place(self.buckets)


def _cuts(keys: list[str], parts: int) -> list[str]:
    """Where to cut sorted keys so that the parts have about as many each; equal keys stay together."""
    places = sorted({keys[len(keys) * part // parts] for part in range(1, parts)}) if keys else []
    return [key for key in places if key > keys[0]]


class KeyedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: str,
        tracked: tuple[str, ...] = (),
        buckets: int | None = None,
        rows_per_bucket: int = ROWS,
    ):
        """The key is a string. `buckets` counts for a new table only; left out, it is the session's shuffle
        partitions, or more if `rows_per_bucket` asks for it."""
        self.spark, self.path, self.schema, self.key = spark, path, schema, key
        self.tracked = tracked
        self._new_buckets, self._rows_per_bucket = buckets, rows_per_bucket

    # --- what is committed -------------------------------------------------------------------

    def _committed(self) -> list[int]:
        return sorted(int(name.split(".")[0]) for name in names_in(self.spark, f"{self.path}/commits"))

    def _state(self) -> State:
        """Where the table stands: one small file, which has a line for each bucket."""
        gens = self._committed()
        if not gens:
            return State()
        held = json.loads(read_text(self.spark, f"{self.path}/commits/{gens[-1]}.json"))
        self._publish(gens[-1], held["run"])  # if the writer died in between
        return State(gens[-1], held["source_gen"], tuple(Bucket(*bucket) for bucket in held["buckets"]))

    def row_count(self) -> int:
        """The number of rows, as the last commit has it."""
        return sum(bucket.rows for bucket in self._state().buckets)

    def last_gen(self) -> int:
        """The number of the last commit, 0 for a new table."""
        return self._state().last_gen

    def source_gen(self) -> int:
        """How far into the table it is made from a summary table has got."""
        return self._state().source_gen

    # --- reading -----------------------------------------------------------------------------

    @property
    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])

    def _rows(self, state: State, only: set[int] | None = None) -> DataFrame:
        """The current rows with their bucket; the folders read are those of the buckets."""
        data = f"{self.path}/data"
        folders = [
            f"{data}/gen={bucket.gen}/run={bucket.run}/state=kept/bucket={bucket.number}"
            for bucket in self.buckets_of(state, only)
            if bucket.rows
        ]
        if not folders:
            return self.spark.createDataFrame([], self._stored)
        rows = self.spark.read.schema(self._stored).option("basePath", data).parquet(*folders)
        return rows.select(*self._stored.fieldNames())

    @staticmethod
    def buckets_of(state: State, only: set[int] | None) -> list[Bucket]:
        return [bucket for bucket in state.buckets if only is None or bucket.number in only]

    def read(self) -> DataFrame:
        """The rows as of the last commit."""
        return self._rows(self._state()).drop("bucket")

    def read_with_gen(self) -> tuple[DataFrame, int]:
        """The rows as of the last commit, and its number: both from one look at the commits."""
        state = self._state()
        return self._rows(state).drop("bucket"), state.last_gen

    @property
    def change_schema(self) -> T.StructType:
        tracked = [self.schema[name] for name in (self.key, *self.tracked)]
        return T.StructType([*tracked, T.StructField("sign", T.IntegerType())])

    def signed_changes(self, after: int, upto: int) -> DataFrame:
        """Key and tracked columns of the rows that commits (after, upto] put in (sign 1) and took out (-1)."""
        changes = f"{self.path}/changes"
        present = {int(name.split("=")[1]) for name in names_in(self.spark, changes)} if self.tracked else set()
        gens = [gen for gen in sorted(present) if after < gen <= upto]
        schema = T.StructType([*self.change_schema.fields, T.StructField("gen", T.LongType())])
        if not gens:
            return self.spark.createDataFrame([], schema)
        folders = [f"{changes}/gen={gen}" for gen in gens]
        return self.spark.read.schema(schema).option("basePath", changes).parquet(*folders)

    def changes(self, after: int, upto: int) -> DataFrame:
        """The tracked columns, as old_* and new_*, of every row changed by commits (after, upto]."""
        signed = self.signed_changes(after, upto)
        sides = [
            signed.where(F.col("sign") == sign).select(
                "gen", self.key, *[F.col(name).alias(f"{side}_{name}") for name in self.tracked]
            )
            for sign, side in ((-1, "old"), (1, "new"))
        ]
        return sides[0].join(sides[1], ["gen", self.key], "full").drop("gen")

    # --- writing -----------------------------------------------------------------------------

    def _fingerprint(self) -> Column:
        """What a row adds to a sum that does not depend on order: its key and the numbers that are tracked."""
        numbers = [name for name in self.tracked if not isinstance(self.schema[name].dataType, T.StringType)]
        return F.xxhash64(self.key, *numbers).cast("decimal(38,0)")

    def _winners(self, batch: DataFrame, newest_by: list[str], gen: int) -> tuple[DataFrame, int]:
        """One row of each key, and how many that are."""
        batch = batch.select(self.schema.fieldNames()).where(F.col(self.key).isNotNull())
        return winners(batch, self.key, newest_by, f"{self.path}/repeated/gen={gen}-{uuid4().hex[:12]}")

    def _sampled(self, rows: DataFrame, count: int, parts: int) -> list[str]:
        """Some SAMPLED keys for each part, in order: those whose hash is below a share of all hashes."""
        share = min(1.0, SAMPLED * parts / max(1, count))
        below = F.pmod(F.xxhash64(self.key), F.lit(1 << 30)) < int(share * (1 << 30))
        return sorted(row[0] for row in rows.where(below).select(self.key).distinct().collect())

    def _first_buckets(self, rows: DataFrame, count: int, gen: int) -> State:
        """The buckets of a new table."""
        parts = self._new_buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        parts = max(parts, -(-count // self._rows_per_bucket))
        lows = [None, *(_cuts(self._sampled(rows, count, parts), parts) if parts > 1 else [])]
        return State(gen - 1, 0, tuple(Bucket(number, low, gen, "", 0) for number, low in enumerate(lows)))

    def _cut(self, state: State, sizes: dict[int, int], rows: DataFrame) -> tuple[State, set[int]]:
        """The buckets with those cut that are to have more than twice the rows they should; the new ones' numbers."""
        large = {number: size for number, size in sizes.items() if size > 2 * self._rows_per_bucket}
        if not large:
            return state, set()
        parts = {number: -(-size // self._rows_per_bucket) for number, size in large.items()}
        inside = rows.where(F.col("bucket").isin(list(large)))
        keys = self._sampled(inside, sum(large.values()), sum(parts.values()))
        made, free = [], max(bucket.number for bucket in state.buckets) + 1
        for bucket, behind in zip(state.buckets, [*state.buckets[1:], None], strict=True):
            made.append(bucket)
            if bucket.number in large:
                first = bisect_left(keys, bucket.low) if bucket.low is not None else 0
                last = len(keys) if behind is None else bisect_left(keys, behind.low)
                for low in _cuts(keys[first:last], parts[bucket.number]):
                    made.append(replace(bucket, number=free, low=low, rows=0))
                    free += 1
        new = {bucket.number for bucket in made} - {bucket.number for bucket in state.buckets}
        return replace(state, buckets=tuple(made)), new

    def upsert(
        self, batch: DataFrame, newest_by: list[str] | None = None, source_gen: int = 0, stored: bool = False,
        leaving: DataFrame | None = None,
    ) -> int:
        """The batch's rows replace those with the same key; the rest of the table stays, but for `leaving` keys.

        Gives the number of the commit, which for a summary table notes how far it has got. The batch is
        written down first, as it is needed for its keys and its rows, unless `stored` says that it comes from
        files that stay and takes little to make from them. Then the buckets that its keys fall into are read
        once and written anew, by a shuffle on the bucket, so that each is one file. What was written is read
        again and counted before it counts.
        """
        state = self._state()
        gen = state.last_gen + 1
        staged = f"{self.path}/incoming/gen={gen}-{uuid4().hex[:12]}"
        if not stored:
            with shuffles_freed(self.spark):
                batch.select(self.schema.fieldNames()).write.parquet(staged)
            batch = self.spark.read.schema(self.schema).parquet(staged)
        rows, count = self._winners(batch, newest_by or NEWEST_BY, gen)
        if not count:
            remove(self.spark, staged)
            if leaving is not None and not source_gen:
                return self.delete(leaving)
            if source_gen > state.source_gen:
                self._commit(gen, source_gen, list(state.buckets), "")
            return max(state.last_gen, gen if source_gen > state.source_gen else 0)
        if not state.buckets:
            state = self._first_buckets(rows, count, gen)
        fresh = rows.withColumn("bucket", state.bucket_of(self.key))
        sizes = dict(map(tuple, fresh.groupBy("bucket").count().collect()))
        if sum(sizes.values()) != count:
            raise RuntimeError(f"the batch has {sum(sizes.values()):,} rows instead of {count:,}")
        gone, found = self._present(state, leaving) if leaving is not None else (None, {})
        sizes = dict.fromkeys(found, 0) | sizes
        self._rewrite(state, fresh, gone if found else None, sizes, count + sum(found.values()), source_gen)
        remove(self.spark, staged)
        return gen

    def delete(self, keys: DataFrame) -> int:
        """Takes the rows with these keys out of the table."""
        state = self._state()
        gone, found = self._present(state, keys)
        if not found:
            return state.last_gen
        return self._rewrite(state, None, gone, dict.fromkeys(found, 0), sum(found.values()))

    def _present(self, state: State, keys: DataFrame) -> tuple[DataFrame, dict[int, int]]:
        """Those of the keys that are in the table, and how many each bucket has of them."""
        keys = keys.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        present = self._rows(state).select(self.key, "bucket").join(keys, self.key, "left_semi")
        # Written down, because it is read several times.
        folder = f"{self.path}/leaving/gen={state.last_gen + 1}-{uuid4().hex[:12]}"
        with shuffles_freed(self.spark):
            present.write.parquet(folder)
        present = self.spark.read.schema(present.schema).parquet(folder)
        return present.select(self.key), dict(map(tuple, present.groupBy("bucket").count().collect()))

    def _rewrite(
        self, state: State, fresh: DataFrame | None, gone: DataFrame | None, sizes: dict[int, int], count: int,
        source_gen: int = 0,
    ) -> int:
        """Writes the buckets of `sizes` anew: `fresh` and the rows whose keys are not among its and the `gone` ones.

        These are `count` keys together.
        """
        touched, before = set(sizes), self._rows(state, set(sizes))
        stood = {bucket.number: bucket.rows for bucket in self.buckets_of(state, touched)}
        if fresh is not None:
            known = before.select(self.key, "bucket").unionAll(fresh.select(self.key, "bucket"))
            state, new = self._cut(state, {number: stood[number] + size for number, size in sizes.items()}, known)
            touched |= new
        names = self.schema.names
        moved = sum(stood.values()) + sum(sizes.values())
        if not any(stood.values()) and fresh is not None:
            dealt = self._dealt(state, touched, fresh.select(*names, F.lit("kept").alias("state")), moved)
        elif count <= SENT:
            leaving = reduce(DataFrame.unionAll, [keys.select(self.key) for keys in (fresh, gone) if keys is not None])
            sent = F.broadcast(leaving.distinct().withColumn("_leaves", F.lit(True)))
            rows = before.join(sent, self.key, "left").select(*self._told(F.col("_leaves").isNotNull()))
            if fresh is not None:
                rows = rows.unionAll(fresh.select(*names, F.lit("kept")))
            dealt = self._dealt(state, touched, rows, moved)
        else:
            # One shuffle, on the bucket, in which the rows that stand meet those that come with their key.
            sides = []
            if fresh is not None:
                sides.append(fresh.select(*names, F.lit("fresh").alias("_was")))
            if gone is not None:
                nothing = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema if f.name != self.key}
                sides.append(gone.select(*[nothing.get(name, F.col(name)) for name in names], F.lit("gone").alias("_was")))
            coming = reduce(DataFrame.unionAll, sides)
            rows = before.select(*names, F.lit("stood").alias("_was")).unionAll(coming)
            tasks, comes = self._tasks(state, touched), F.col("_was") != "stood"
            met = send_to_meet(rows, len(touched), tasks.bucket_of(self.key), comes, self.key, "_leaves")
            met = met.where(F.col("_was") != "gone").withColumn("bucket", state.bucket_of(self.key))
            dealt = met.select(*self._told(F.col("_leaves")), "bucket")
        return self._write(state, touched, dealt, moved, fresh, source_gen)

    def _told(self, leaves: Column) -> list[Column]:
        """A row with its state; of those that leave the key and the tracked columns are enough."""
        small = {self.key, *self.tracked}
        return [
            *[F.col(name) if name in small else F.when(~leaves, F.col(name)).alias(name) for name in self.schema.names],
            F.when(leaves, "gone").otherwise("kept").alias("state"),
        ]

    @staticmethod
    def _tasks(state: State, touched: set[int]) -> State:
        """The buckets numbered by tasks: each touched one has a task of its own."""
        place = {number: index for index, number in enumerate(sorted(touched))}
        return replace(state, buckets=tuple(replace(b, number=place.get(b.number, 0)) for b in state.buckets))

    def _dealt(self, state: State, touched: set[int], rows: DataFrame, count: int = 0) -> DataFrame:
        """The rows with their bucket, those of each touched bucket in a task of their own; many are sent in blocks."""
        task = self._tasks(state, touched).bucket_of(self.key)
        if count > SENT:
            return send_packed(rows, len(touched), task).withColumn("bucket", state.bucket_of(self.key))
        told = rows.withColumns({"bucket": state.bucket_of(self.key), "_task": task})
        return told.repartitionById(len(touched), "_task").drop("_task")

    def _write(
        self, state: State, touched: set[int], dealt: DataFrame, expected: int | None, fresh: DataFrame | None,
        source_gen: int = 0,
    ) -> int:
        """Writes the touched buckets, one task each, reads them again and counts (C4, C5), then commits.

        Counts and order-free sums of row hashes are taken as the rows are written. What is read again must
        have the same; and where `expected` says how many rows there were, none may be lost or doubled.
        """
        gen, run = state.last_gen + 1, uuid4().hex[:12]
        folder = f"{self.path}/data/gen={gen}/run={run}"
        kept, seen = F.col("state") == "kept", Observation()
        told = dealt.observe(
            seen,
            F.count_if(kept).alias("kept"),
            F.count_if(~kept).alias("gone"),
            F.sum(F.when(kept, self._fingerprint())).alias("sum"),
        )
        with shuffles_freed(self.spark):
            told.write.partitionBy("state", "bucket").parquet(folder)
        counted, found = seen.get, []
        if exists(self.spark, f"{folder}/state=kept"):
            written = self.spark.read.schema(self._stored).parquet(f"{folder}/state=kept")
            by_bucket = written.groupBy("bucket").agg(F.count(F.lit(1)), F.sum(self._fingerprint()))
            found = by_bucket.collect()
        stored = sum(row[1] for row in found)
        if expected is not None and counted["kept"] + counted["gone"] != expected:
            raise RuntimeError(f"{expected:,} rows became {counted['kept']:,} kept and {counted['gone']:,} gone ones")
        if (stored, sum(row[2] for row in found)) != (counted["kept"], counted["sum"] or 0):
            raise RuntimeError(f"{folder} holds {stored:,} rows that are not the {counted['kept']:,} written")
        if self.tracked:
            self._note_changes(f"{folder}/state=gone", fresh, f"{self.path}/unpublished/gen={gen}/run={run}")
        sizes = {row["bucket"]: row[1] for row in found}
        buckets = [
            replace(bucket, gen=gen, run=run, rows=sizes.get(bucket.number, 0)) if bucket.number in touched else bucket
            for bucket in state.buckets
        ]
        self._commit(gen, source_gen, buckets, run)
        self._publish(gen, run)
        return gen

    def _note_changes(self, gone: str, fresh: DataFrame | None, folder: str) -> None:
        columns, sides = [self.key, *self.tracked], []
        if exists(self.spark, gone):
            out = self.spark.read.schema(self._stored).parquet(gone)
            sides.append(out.select(*columns, F.lit(-1).alias("sign")))
        if fresh is not None:
            sides.append(fresh.select(*columns, F.lit(1).alias("sign")))
        reduce(DataFrame.unionAll, sides).write.parquet(folder)

    def _commit(self, gen: int, source_gen: int, buckets: list[Bucket], run: str) -> None:
        held = {"source_gen": source_gen, "run": run, "buckets": [astuple(bucket) for bucket in buckets]}
        create_text(self.spark, f"{self.path}/commits/{gen}.json", json.dumps(held))

    def _publish(self, gen: int, run: str) -> None:
        """Shows the changes of a commit to those who follow them, all at once."""
        hidden, shown = f"{self.path}/unpublished/gen={gen}/run={run}", f"{self.path}/changes/gen={gen}"
        if self.tracked and run and exists(self.spark, hidden):
            rename(self.spark, hidden, shown)

    def overwrite(self, rows: DataFrame, source_gen: int = 0) -> int:
        """Replaces the whole table; the rows must have distinct keys. For summary tables."""
        if self.tracked:
            raise ValueError("a table that tracks changes is not overwritten: use upsert or delete")
        state = self._state()
        if not state.buckets:
            state = self._first_buckets(rows, rows.count(), 1)
        rows = rows.select(*self.schema.names, F.lit("kept").alias("state"))
        touched = {bucket.number for bucket in state.buckets}
        return self._write(state, touched, self._dealt(state, touched, rows), None, None, source_gen)

    def clear(self) -> int:
        """K9: empties the table; what was in it goes into the changes."""
        if self.tracked:
            return self._clear_tracked()
        return self.overwrite(self.spark.createDataFrame([], self.schema))

    def _clear_tracked(self) -> int:
        """All rows leave, so none is moved: their keys and tracked columns are noted, read again and counted."""
        state = self._state()
        count, gen, run = sum(bucket.rows for bucket in state.buckets), state.last_gen + 1, uuid4().hex[:12]
        if not count:
            return state.last_gen
        folder, rows = f"{self.path}/unpublished/gen={gen}/run={run}", self._rows(state)
        rows.select(self.key, *self.tracked, F.lit(-1).alias("sign")).write.parquet(folder)
        noted = self.spark.read.schema(self.change_schema).parquet(folder).count()
        if noted != count:
            raise RuntimeError(f"{count:,} rows were to leave but {noted:,} were noted")
        self._commit(gen, 0, [replace(bucket, gen=gen, run=run, rows=0) for bucket in state.buckets], run)
        self._publish(gen, run)
        return gen

    def duplicate_keys(self) -> DataFrame:
        """K4: keys with more than one row; always empty."""
        return self.read().groupBy(self.key).count().where("count > 1")

    def vacuum(self) -> list[int]:
        """Deletes the rows that no current bucket needs; gives the commits they came from."""
        owners, data = self._state().owners, f"{self.path}/data"
        stored = [int(name.split("=")[1]) for name in names_in(self.spark, data)]
        unused = sorted(gen for gen in stored if gen not in owners)
        for gen in unused:
            remove(self.spark, f"{data}/gen={gen}")
        for scratch in ("incoming", "repeated", "leaving"):
            remove(self.spark, f"{self.path}/{scratch}")
        return unused
