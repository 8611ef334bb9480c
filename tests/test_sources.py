import csv

import pytest

from souqframe.schemas import ORDER_FIELDS
from souqframe.sources import layout, raw_orders
from tests.conftest import BASE


def write_csv(path, rows, header=ORDER_FIELDS, bom=False):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as file:
        writer = csv.DictWriter(file, header)
        writer.writeheader()
        writer.writerows([{name: row[name] for name in header} for row in rows])
    return str(path)


def test_csv_keeps_json_blanks_and_empty_fields(spark, tmp_path):
    rows = [{**BASE, "customer_name": " N  ", "order_date": ""}, {**BASE, "city": "Sana'a, \"old\""}]
    path = write_csv(tmp_path / "in.csv", rows, bom=True)
    read = raw_orders.read_order_csv(spark, path).select(ORDER_FIELDS).collect()
    assert [row.asDict() for row in read] == rows


def test_csv_columns_are_found_by_name(spark, tmp_path):
    header = list(reversed(ORDER_FIELDS))
    header.remove("district")
    path = write_csv(tmp_path / "in.csv", [BASE], header)
    assert raw_orders.read_order_csv(spark, path).select(ORDER_FIELDS).first().asDict() == {**BASE, "district": ""}


def test_quoted_line_breaks_on_request(spark, tmp_path):
    path = write_csv(tmp_path / "in.csv", [{**BASE, "customer_name": "two\nlines"}, BASE])
    read = raw_orders.read_order_csv(spark, path, multi_line=True).collect()
    assert [row["customer_name"] for row in read] == ["two\nlines", "N"]


def test_load_reports_and_appends(spark, tmp_path):
    path = write_csv(tmp_path / "in.csv", [{**BASE, "order_id": f"O{n}"} for n in range(25)])
    raw_path = str(tmp_path / "raw")
    first = raw_orders.load_csv_to_raw(spark, path, raw_path, batch_size=10, exact_rows=True)
    second = raw_orders.load_csv_to_raw(spark, path, raw_path, "second")
    assert (first["loaded_raw"], first["batches"], first["batch_size"]) == (25, 3, 10)
    assert second["id_run"] == "second"
    assert raw_orders.read_orders_raw(spark, raw_path).count() == 50
    one_run = raw_orders.read_orders_raw(spark, raw_path, first["id_run"])
    numbers = one_run.orderBy("number_row_source").select("number_row_source", "record_raw.order_id").collect()
    assert [tuple(row) for row in numbers] == [(n + 1, f"O{n}") for n in range(25)]


def test_load_refuses_bad_arguments(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        raw_orders.load_csv_to_raw(spark, str(tmp_path / "none.csv"), str(tmp_path / "raw"))
    with pytest.raises(ValueError):
        raw_orders.load_csv_to_raw(spark, "x", "y", batch_size=0)


def test_exact_numbers_over_many_splits(spark, tmp_path):
    path = write_csv(tmp_path / "in.csv", [{**BASE, "order_id": f"O{n}"} for n in range(3000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        raw = raw_orders.with_envelope(raw_orders.read_order_csv(spark, path), "r")
        assert raw.rdd.getNumPartitions() > 4
        numbered = raw_orders.exact_row_numbers(raw).select("number_row_source", "record_raw.order_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((row[0], row[1]) for row in numbered) == [(n + 1, f"O{n}") for n in range(3000)]


def test_sample_is_the_first_rows(spark, tmp_path):
    path = write_csv(tmp_path / "in.csv", [{**BASE, "order_id": f"O{n}"} for n in range(50)])
    out = str(tmp_path / "out")
    assert raw_orders.create_sample(spark, path, out, 7) == 7
    ids = [row["order_id"] for row in raw_orders.read_order_csv(spark, out).collect()]
    assert sorted(ids) == sorted(f"O{n}" for n in range(7))
    with pytest.raises(RuntimeError):
        raw_orders.create_sample(spark, path, str(tmp_path / "more"), 51, exactly=True)
    with pytest.raises(RuntimeError):
        raw_orders.count_order_csv(spark, path, expected_rows=51)
    assert raw_orders.count_order_csv(spark, path, expected_rows=50)["rows"] == 50


def test_layout_reads_fewer_rows(spark, tmp_path):
    from souqframe.operators.validation import apply_all_quality_rules
    from tests.conftest import raw_orders as make

    rows = make(spark, [{"order_id": f"O{n}", "customer_id": f"C{n % 40:02d}"} for n in range(400)])
    plain = str(tmp_path / "plain")
    apply_all_quality_rules(rows).repartition(4).write.parquet(plain)
    paths = layout.write_layouts(spark.read.parquet(plain), str(tmp_path / "layouts"), files=4)
    compared = layout.compare_layouts(spark, plain, paths, layout.lookups("C07", "X", "DELIVERED"))
    by_customer = compared.where("query_id = 'Q1_customer_orders'").first()
    assert by_customer["before_rows_examined"] == 400 and by_customer["after_rows_examined"] < 200
    assert by_customer["before_rows_returned"] == by_customer["after_rows_returned"] == 10
    assert by_customer["after_scan"] == "SKIPS FILES"
    with pytest.raises(ValueError):
        layout.write_layout(spark.read.parquet(plain), plain + "-x", "nothing")


def test_hot_value_is_spread_over_files(spark, tmp_path):
    from souqframe.operators.validation import apply_all_quality_rules
    from tests.conftest import raw_orders as make

    rows = make(spark, [{"order_id": f"O{n:03d}", "customer_id": "HOT"} for n in range(300)])
    path = str(tmp_path / "laid-out")
    layout.write_layout(apply_all_quality_rules(rows), path, "customer_order_date", files=4)
    files = spark.read.parquet(path).selectExpr("_metadata.file_path as f").groupBy("f").count().collect()
    assert len(files) == 4 and max(row["count"] for row in files) < 150


def split_small(spark, size="20000"):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_line_breaks_in_quotes_over_many_splits(spark, tmp_path):
    # Names with breaks, quotes and a field longer than several splits.
    rows = [
        {**BASE, "order_id": f"O{n}", "customer_name": f'a "{n}"\nb, {n}\n\n"' * (n % 4), "city": "x\n" * (3000 * (n % 97 == 5))}
        for n in range(800)
    ]
    path = write_csv(tmp_path / "in.csv", rows)
    whole = spark.read.options(**raw_orders._CSV, multiLine=True).csv(path)
    expected = sorted(tuple(value or "" for value in row) for row in whole.select(ORDER_FIELDS).collect())
    split_small(spark, "5000")
    try:
        read = raw_orders.read_order_csv(spark, path, multi_line=True)
        assert spark.read.text(path).rdd.getNumPartitions() > 50
        found = read.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(tuple(row[name] for name in ORDER_FIELDS) for row in found) == expected
    assert len(expected) == 800
    in_order = sorted(found, key=lambda row: row["_position"])
    assert [row["order_id"] for row in in_order] == [f"O{n}" for n in range(800)]


def test_an_open_quote_at_the_end_of_a_file(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(",".join(ORDER_FIELDS) + '\nO1,C1\n\nO2,"never\nclosed\n')
    rows = raw_orders.read_order_csv(spark, str(path), multi_line=True, broken=True).collect()
    assert [row["order_id"] for row in rows] == ["O1", "O2"] and all(row["_broken"] for row in rows)
    empty = tmp_path / "empty.csv"
    empty.write_text(",".join(ORDER_FIELDS) + "\n")
    assert raw_orders.read_order_csv(spark, str(empty), multi_line=True).collect() == []


@pytest.mark.parametrize("multi_line", [False, True])
def test_broken_records_are_counted_and_kept_apart(spark, tmp_path, multi_line):
    path = write_csv(tmp_path / "in.csv", [{**BASE, "order_id": f"O{n}"} for n in range(4)])
    with open(path, "a", newline="") as file:
        file.write("O4,C4\r\n" + ",".join(["O5"] * 19) + "\r\n")
    raw_path = str(tmp_path / "raw")
    loaded = raw_orders.load_csv_to_raw(spark, path, raw_path, "r", multi_line=multi_line)
    assert (loaded["loaded_raw"], loaded["broken"]) == (6, 2)
    kept = spark.read.parquet(raw_orders.broken_path(raw_path)).collect()
    assert sorted(row["record"] for row in kept) == ["O4,C4", ",".join(["O5"] * 19)]
    raw = raw_orders.read_orders_raw(spark, raw_path).where("record_raw.order_id = 'O4'").first()
    assert raw["record_raw"]["customer_id"] == "C4" and raw["record_raw"]["city"] == ""
    good = raw_orders.load_csv_to_raw(spark, write_csv(tmp_path / "good.csv", [BASE]), raw_path, multi_line=multi_line)
    assert good["broken"] == 0


def test_sample_reads_the_first_splits_only(spark, tmp_path):
    from souqframe.sources.records import leading_records

    path = write_csv(tmp_path / "in.csv", [{**BASE, "order_id": f"O{n}"} for n in range(3000)])
    split_small(spark)
    try:
        splits = spark.read.text(path).rdd.getNumPartitions()
        records, found = leading_records(spark, path, 250)
        assert found == 250 and records.rdd.getNumPartitions() < splits / 4
        out = str(tmp_path / "out")
        assert raw_orders.create_sample(spark, path, out, 250) == 250
        assert leading_records(spark, path, 5000)[1] == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    ids = [row["order_id"] for row in raw_orders.read_order_csv(spark, out).collect()]
    assert sorted(ids) == sorted(f"O{n}" for n in range(250))


def test_sample_of_a_file_in_parts(spark, tmp_path):
    path = tmp_path / "parts"
    path.mkdir()
    # Later parts are larger: read together, Spark takes those first.
    for part in range(5):
        rows = [{**BASE, "order_id": f"O{part}-{n}"} for n in range(10 * (part + 1))]
        write_csv(path / f"part-0000{part}.csv", rows)
    out = str(tmp_path / "out")
    assert raw_orders.create_sample(spark, str(path), out, 35, exactly=True) == 35
    ids = sorted(row["order_id"] for row in raw_orders.read_order_csv(spark, out).collect())
    assert ids == sorted(f"O{part}-{n}" for part, n in [(p, n) for p in range(5) for n in range(10 * (p + 1))][:35])
    assert raw_orders.create_sample(spark, str(path), out, 1000) == 150


def test_large_layouts_have_more_files(spark, tmp_path, monkeypatch):
    from souqframe.operators.validation import apply_all_quality_rules
    from tests.conftest import raw_orders as make

    monkeypatch.setattr(layout, "ROWS", 20)
    rows = make(spark, [{"order_id": f"O{n:03d}"} for n in range(200)])
    layout.write_layout(apply_all_quality_rules(rows), str(tmp_path / "city"), "city", files=4)
    read = spark.read.parquet(str(tmp_path / "city"))
    assert read.count() == 200 and len(read.inputFiles()) >= 9
