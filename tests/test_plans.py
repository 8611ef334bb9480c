import random

import pytest
from pyspark.sql import functions as F

from souqframe.operators import outcomes
from souqframe.operators.reports import daily_sums, get_top_products
from souqframe.operators.validation import apply_all_quality_rules
from souqframe.plans import elt, jobs, views
from souqframe.schemas import ORDER_FIELDS
from checks.dirty_orders import dirty_order_fields
from souqframe.sources.raw_orders import write_order_csv
from souqframe.streaming.daily_sales import stream_daily_sales
from tests.conftest import SF, raw_orders


def daily(warehouse):
    rows = warehouse.daily_sales.read().collect()
    return {row["order_date"]: (row["total_orders"], row["total_revenue"]) for row in rows}


def recomputed(warehouse):
    rows = daily_sums(warehouse.validated.read()).collect()
    return {row["order_date"]: (row["inc_orders"], row["inc_revenue"]) for row in rows}


def random_batch(spark, dice, number):
    changes = [
        {"order_id": f"O{dice.randrange(30)}", "order_date": f"2024-01-{dice.randrange(1, 9):02d}",
         "delivery_cost": str(dice.randrange(50))}
        for _ in range(20)
    ]
    return apply_all_quality_rules(raw_orders(spark, changes, first_ingested=1000.0 * number))


@pytest.mark.parametrize("seed", [1, 2])
def test_refreshed_by_changes_equals_worked_out_anew(spark, warehouse, seed):
    dice = random.Random(seed)
    for number in range(3):
        warehouse.validated.upsert(random_batch(spark, dice, number))
        if number != 1:
            assert views.refresh_daily_sales_summary(warehouse)["status"] == "SUCCESS"
    assert daily(warehouse) == recomputed(warehouse)
    assert views.refresh_daily_sales_summary(warehouse)["status"] == "NO_NEW_DATA"
    latest = warehouse.validated.read().agg(F.max("at_ingested")).first()[0]
    assert views.get_last_watermark(warehouse, views.DAILY_SALES) == latest


def test_deleted_orders_leave_their_day(spark, warehouse):
    warehouse.validated.upsert(random_batch(spark, random.Random(3), 1))
    views.refresh_daily_sales_summary(warehouse)
    some = warehouse.validated.read().where("order_date < '2024-01-05'").select("order_id")
    warehouse.validated.delete(some)
    views.refresh_daily_sales_summary(warehouse)
    assert daily(warehouse) == recomputed(warehouse) and min(daily(warehouse)) >= "2024-01-05"


def test_stream_takes_up_where_it_stopped(spark, warehouse, tmp_path):
    dice = random.Random(4)
    for number in range(2):
        warehouse.validated.upsert(random_batch(spark, dice, number))
        stream_daily_sales(warehouse, str(tmp_path / "checkpoint")).awaitTermination()
        assert daily(warehouse) == recomputed(warehouse)


def test_views_by_name(spark, warehouse):
    assert views.refresh_daily_sales_summary(warehouse)["status"] == "NO_NEW_DATA"
    warehouse.validated.upsert(random_batch(spark, random.Random(5), 1))
    both = views.refresh_all_materialized_views(warehouse, incremental=False)
    assert {both[name]["status"] for name in (views.DAILY_SALES, views.TOP_PRODUCTS)} == {"SUCCESS"}
    assert views.get_materialized_view_data(warehouse, views.DAILY_SALES, 2).count() == 2
    with pytest.raises(ValueError):
        views.get_materialized_view_data(warehouse, "nothing")


def test_jobs_are_logged(spark, warehouse, monkeypatch):
    assert len(jobs.JOBS_REGISTRY) == 2
    assert jobs.run_job_by_name(warehouse, "periodic_system_audit_job")["status"] == "SUCCESS"

    def broken(_):
        raise RuntimeError("no such table")

    monkeypatch.setattr(jobs, "refresh_all_materialized_views", broken)
    failed = jobs.run_refresh_mv_job(warehouse)
    assert (failed["status"], failed["error"]) == ("FAILED", "no such table")
    logs = jobs.get_job_logs(warehouse, 5).collect()
    assert [row["status"] for row in logs] == ["FAILED", "SUCCESS"]
    with pytest.raises(ValueError):
        jobs.run_job_by_name(warehouse, "nothing")


def test_everything_from_a_file(spark, warehouse, tmp_path):
    path = str(tmp_path / "orders.csv")
    write_order_csv(dirty_order_fields(spark, SF).select(ORDER_FIELDS), path)
    result = elt.run_everything(warehouse, path)
    orders = result["elt"]
    assert orders["raw"] == orders["processed"] == result["ingested"]["loaded_raw"] == 1500
    assert orders["validated"] + orders["quarantined"] == 1500
    assert result["idempotent"]
    assert [job["status"] for job in result["jobs"]] == ["SUCCESS", "SUCCESS"]
    assert result["layouts"].count() == 3 and result["job_logs"].count() == 2
    assert sum(row["total_orders"] for row in result["reports"]["sales_by_city"].collect()) == orders["validated"]
    assert daily(warehouse) == recomputed(warehouse)
    warehouse.reset()
    assert warehouse.raw().isEmpty() and warehouse.validated.read().isEmpty()
    assert warehouse.quarantine.read().isEmpty()


def test_unexpected_count_stores_nothing(spark, warehouse):
    with pytest.raises(RuntimeError, match="expected 3"):
        elt.run_elt(warehouse, raw_orders(spark, [{}, {"order_id": "O2"}]), expected_rows=3)
    assert warehouse.validated.last_gen() == 0


def test_exclusive_run_moves_orders(spark, warehouse):
    broken = raw_orders(spark, [{"order_id": "A", "items_json": "[]"}, {"order_id": "B"}])
    elt.run_elt(warehouse, broken, exclusive=True)
    fixed = raw_orders(
        spark,
        [{"order_id": "A"}, {"order_id": "B", "items_json": "[]"}, {"order_id": "C", "items_json": "[]"},
         {"order_id": "C"}],
    )
    elt.run_elt(warehouse, fixed, exclusive=True)
    assert sorted(row["order_id"] for row in warehouse.validated.read().collect()) == ["A", "C"]
    assert [row["order_id"] for row in warehouse.quarantine.read().collect()] == ["B"]


def test_stored_counts_and_keys_are_checked(spark, warehouse):
    cleaned = apply_all_quality_rules(raw_orders(spark, [{"order_id": "A"}, {"order_id": "B"}]))
    warehouse.validated.upsert(cleaned.where("order_id = 'A'"))
    outcomes.check_stored_counts(warehouse.validated, 1)
    with pytest.raises(RuntimeError, match="instead of 2"):
        outcomes.check_stored_counts(warehouse.validated, 2)
    with pytest.raises(RuntimeError, match="B"):
        outcomes.check_stored_keys(cleaned, warehouse.validated)
    outcomes.check_counts(raw=3, processed=3, validated=2, quarantined=1)
    with pytest.raises(RuntimeError):
        outcomes.check_counts(raw=3, processed=3, validated=2, quarantined=2)


def test_without_exclusive_both_tables_keep_the_order(spark, warehouse):
    elt.run_elt(warehouse, raw_orders(spark, [{"order_id": "A", "items_json": "[]"}]))
    elt.run_elt(warehouse, raw_orders(spark, [{"order_id": "A"}]))
    assert warehouse.validated.read().count() == warehouse.quarantine.read().count() == 1


def test_a_commit_during_a_refresh_is_counted_once(spark, warehouse, monkeypatch):
    elt.run_elt(warehouse, raw_orders(spark, [{"order_id": "A"}]))
    read = warehouse.validated.read_with_gen

    def read_and_commit():
        found = read()
        monkeypatch.undo()
        elt.run_elt(warehouse, raw_orders(spark, [{"order_id": "B"}], first_ingested=2000.0))
        return found

    monkeypatch.setattr(warehouse.validated, "read_with_gen", read_and_commit)
    views.refresh_daily_sales_summary(warehouse)
    views.refresh_daily_sales_summary(warehouse)
    row = warehouse.daily_sales.read().first()
    assert (row["total_orders"], str(row["total_revenue"])) == (2, "50.00")


def test_a_stream_may_start_before_the_first_order_is_stored(spark, warehouse, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    stream_daily_sales(warehouse, checkpoint).awaitTermination()
    assert warehouse.daily_sales.read().count() == 0
    elt.run_elt(warehouse, raw_orders(spark, [{"order_id": "A"}]))
    stream_daily_sales(warehouse, checkpoint).awaitTermination()
    assert warehouse.daily_sales.read().count() == 1


def products(warehouse):
    rows = warehouse.top_products.read().collect()
    return sorted((row["product_name"], row["total_quantity_sold"], row["total_revenue"]) for row in rows)


@pytest.mark.parametrize("seed", [6, 7])
def test_product_sums_follow_moves_and_removals(spark, warehouse, seed):
    dice = random.Random(seed)

    def items():
        lines = [
            f'{{"name":"p{dice.randrange(70)}","qty":"{dice.randrange(1, 9)}","total":"{dice.randrange(900) / 100}"}}'
            for _ in range(dice.randrange(1, 5))
        ]
        return f"[{','.join(lines)}]"

    for number in range(3):
        changes = [{"order_id": f"O{dice.randrange(60)}", "items_json": items()} for _ in range(50)]
        warehouse.validated.upsert(apply_all_quality_rules(raw_orders(spark, changes, first_ingested=1000.0 * number)))
        if number == 1:
            some = warehouse.validated.read().where("order_id like 'O1%'").select("order_id")
            warehouse.validated.delete(some)
        assert views.refresh_top_products_summary(warehouse)["status"] == "SUCCESS"
        anew = get_top_products(warehouse.validated.read(), views.PRODUCTS_KEPT).collect()
        assert products(warehouse) == sorted(tuple(row) for row in anew)
    assert views.refresh_top_products_summary(warehouse)["status"] == "NO_NEW_DATA"


def test_a_replayed_batch_of_the_stream_changes_nothing(spark, warehouse, monkeypatch):
    warehouse.validated.upsert(random_batch(spark, random.Random(8), 1))
    monkeypatch.setattr(views, "refresh_daily_sales_summary", None)  # the stream does without it
    changes = warehouse.validated.signed_changes(0, 1)
    assert views.add_daily_changes(warehouse, changes) > 0
    before, gen = daily(warehouse), warehouse.daily_sales.last_gen()
    assert views.add_daily_changes(warehouse, changes) == 0
    assert daily(warehouse) == before == recomputed(warehouse) and warehouse.daily_sales.last_gen() == gen


def test_stream_and_refresh_take_turns(spark, warehouse, tmp_path):
    dice, checkpoint = random.Random(9), str(tmp_path / "checkpoint")
    for number in range(4):
        warehouse.validated.upsert(random_batch(spark, dice, number))
        if number % 2:
            views.refresh_daily_sales_summary(warehouse)
        stream_daily_sales(warehouse, checkpoint).awaitTermination()
        assert daily(warehouse) == recomputed(warehouse)


def test_watermarks_only_rise(warehouse):
    assert views.get_last_watermark(warehouse, "v") == 0
    for at in (5.0, 3.0):
        views.set_last_watermark(warehouse, "v", at)
    views.set_last_watermark(warehouse, "w", 1.0)
    assert views.get_last_watermark(warehouse, "v") == 5.0
    assert warehouse.watermarks.read().count() == 2
