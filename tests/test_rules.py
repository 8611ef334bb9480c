import pytest
from pyspark.sql import functions as F

from souqframe.operators import cleaning
from souqframe.operators.validation import apply_all_quality_rules
from tests.conftest import BASE, raw_orders

TOTAL = "TOTAL_ORDER_RECALCULATION"
ITEM = '[{{"sku":"s","name":"n","qty":"{}","unit_price":"{}","total":"20"}}]'

# change, what the changed field and the total come to (None: not looked at), status, codes
CASES = [
    ({}, {}, "valid", []),
    ({"total_amount": "25"}, {"total_amount": "25.00"}, "corrected", [TOTAL]),
    ({"delivery_cost": "١٠٠٠ ريال"}, {"delivery_cost": "1000", "total_amount": "1,020.00"}, "corrected",
     ["ARABIC_NUMBERS", "CURRENCY_REMOVAL", TOTAL]),
    ({"delivery_cost": "خمسة"}, {"delivery_cost": "5"}, "corrected", ["PRICE_IN_WORDS"]),
    ({"delivery_cost": "2,000"}, {"delivery_cost": "2000", "total_amount": "2,020.00"}, "corrected",
     ["THOUSANDS_SEPARATOR", TOTAL]),
    ({"delivery_cost": "١٬٥٠٠٫٥"}, {"delivery_cost": "1500.5", "total_amount": "1,520.50"}, "corrected",
     ["ARABIC_NUMBERS", "THOUSANDS_SEPARATOR", TOTAL]),
    ({"delivery_cost": ""}, {"delivery_cost": ""}, "quarantine", ["INVALID_DELIVERY_COST"]),
    ({"delivery_cost": "free"}, {}, "quarantine", ["INVALID_DELIVERY_COST", "UNKNOWN_PRICE"]),
    ({"delivery_cost": "-500"}, {}, "quarantine", ["AMBIGUOUS_NEGATIVE_VALUE"]),
    ({"customer_phone": "+967 712-345-678"}, {"customer_phone": "967712345678"}, "corrected", ["PHONE_NORMALIZATION"]),
    ({"customer_phone": "٠٧١٢٣٤٥٦٧٨"}, {"customer_phone": "967712345678"}, "corrected", ["PHONE_NORMALIZATION"]),
    ({"customer_phone": "00967712345678"}, {"customer_phone": "967712345678"}, "corrected", ["PHONE_NORMALIZATION"]),
    ({"customer_phone": "712345678"}, {"customer_phone": "967712345678"}, "corrected", ["PHONE_NORMALIZATION"]),
    ({"customer_phone": "123"}, {"customer_phone": "123"}, "quarantine", ["INVALID_PHONE"]),
    ({"customer_phone": ""}, {}, "valid", []),
    ({"customer_email": " a..b@@c.co "}, {"customer_email": "a.b@c.co"}, "corrected", ["EMAIL_NORMALIZATION"]),
    ({"customer_email": "nope"}, {}, "quarantine", ["INVALID_EMAIL"]),
    ({"order_date": "15/02/2024"}, {"order_date": "2024-02-15"}, "corrected", ["DATE_NORMALIZATION"]),
    ({"order_date": "15-02-2024 10:11:12"}, {"order_date": "2024-02-15"}, "corrected", ["DATE_NORMALIZATION"]),
    ({"order_date": "2024/02/15"}, {"order_date": "2024-02-15"}, "corrected", ["DATE_NORMALIZATION"]),
    ({"order_date": "2024-02-15T10:11:12"}, {"order_date": "2024-02-15"}, "corrected", ["DATE_NORMALIZATION"]),
    ({"order_date": "٢٠٢٤-٠٢-١٥"}, {"order_date": "2024-02-15"}, "corrected", ["DATE_NORMALIZATION"]),
    ({"order_date": "30/02/2024"}, {"order_date": "30/02/2024"}, "quarantine", ["INVALID_IMPOSSIBLE_DATE"]),
    ({"order_date": "2024-02-30"}, {"order_date": "2024-02-30"}, "valid", []),
    ({"order_date": "2024-2-5"}, {}, "quarantine", ["INVALID_IMPOSSIBLE_DATE"]),
    ({"order_date": None}, {"order_date": None}, "valid", []),
    ({"order_date": ""}, {}, "quarantine", ["INVALID_IMPOSSIBLE_DATE"]),
    ({"status": " Pending "}, {"status": "قيد الانتظار"}, "corrected", ["SPACES_SYNONYMS"]),
    ({"customer_name": "Returned"}, {"customer_name": "مرتجع"}, "corrected", ["SPACES_SYNONYMS"]),
    ({"customer_name": "\tA  B"}, {"customer_name": " A B"}, "corrected", ["SPACES_SYNONYMS"]),
    ({"currency": "y.r."}, {"currency": "YER"}, "corrected", ["CURRENCY_NORMALIZATION"]),
    ({"order_id": "  "}, {"order_id": ""}, "quarantine", ["MISSING_ORDER_ID"]),
    ({"customer_id": None}, {"customer_id": None}, "quarantine", ["MISSING_CUSTOMER_ID"]),
    ({"items_json": "{bad"}, {"items_json": "{bad"}, "quarantine", ["CORRUPTED_ITEMS_JSON"]),
    ({"items_json": "[]"}, {}, "quarantine", ["EMPTY_ITEMS"]),
    ({"items_json": '{"qty":"2","unit_price":"10"}'}, {"total_amount": "25.00"}, "valid", []),
    ({"items_json": ITEM.format("0", "10")}, {}, "quarantine", ["AMBIGUOUS_NEGATIVE_VALUE"]),
    ({"items_json": ITEM.format("x", "10")}, {}, "quarantine", ["AMBIGUOUS_NEGATIVE_VALUE"]),
    ({"items_json": ITEM.format("٢", "1,000")}, {"total_amount": "2,005.00"}, "corrected", [TOTAL]),
    ({"customer_id": "", "customer_phone": "1", "order_date": "x", "delivery_cost": "free"}, {}, "quarantine",
     ["MISSING_CUSTOMER_ID", "INVALID_PHONE", "INVALID_IMPOSSIBLE_DATE", "INVALID_DELIVERY_COST", "UNKNOWN_PRICE"]),
]


@pytest.fixture(scope="module")
def cleaned(spark):
    raw = raw_orders(spark, [change for change, *_ in CASES])
    return apply_all_quality_rules(raw).orderBy("number_row_source").collect()


@pytest.mark.parametrize("number", range(len(CASES)))
def test_edge_case(cleaned, number):
    _, values, status, codes = CASES[number]
    row = cleaned[number]
    assert {field: row[field] for field in values} == values
    assert row["quality_status"] == status
    given = row["quarantine_reasons"] if status == "quarantine" else [c["rule_code"] for c in row["corrections"]]
    assert given == codes


def test_every_row_comes_out_once(cleaned):
    assert [row["number_row_source"] for row in cleaned] == list(range(1, len(CASES) + 1))


def test_strict_dates_reject_missing_and_impossible_ones(spark):
    raw = raw_orders(spark, [{"order_date": "2024-02-30"}, {"order_date": None}, {}])
    rows = apply_all_quality_rules(raw, strict_dates=True).orderBy("number_row_source").collect()
    assert [row["quality_status"] for row in rows] == ["quarantine", "quarantine", "valid"]


def test_one_rule_adds_to_the_trail_it_finds(spark):
    df = spark.createDataFrame([{**BASE, "customer_phone": "0712345678", "customer_email": "a@@b.co"}])
    row = cleaning.rule_email(cleaning.rule_phone(df)).first()
    assert [c["rule_code"] for c in row["corrections"]] == ["PHONE_NORMALIZATION", "EMAIL_NORMALIZATION"]


def test_own_audit_entry(spark):
    df = cleaning.rule_phone(spark.createDataFrame([{**BASE, "customer_phone": "0712345678"}]))
    df = cleaning.add_audit(df, F.col("city"), F.upper(F.lit("y")), "city", "MINE")
    entry = df.first()["corrections"][-1]
    assert tuple(entry) == ("city", "X", "Y", "MINE")


def test_cleaning_what_is_clean_changes_only_the_total(spark):
    once = apply_all_quality_rules(raw_orders(spark, [{"delivery_cost": "2,000", "status": "shipped"}]))
    raw = once.select(
        "at_ingested", "engine_used", "file_source", "id_run", "number_row_source",
        F.struct(*BASE).alias("record_raw"),
    )
    first, second = once.first(), apply_all_quality_rules(raw).first()
    assert {field: first[field] for field in BASE} == {field: second[field] for field in BASE}
    assert {c["field"] for c in second["corrections"]} == {"total_amount"}


def test_rules_shuffle_nothing_and_run_once(spark):
    plan = apply_all_quality_rules(raw_orders(spark, [{}])).where("quality_status = 'valid'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text
    assert text.count("from_json") == 1


def test_broken_items_have_the_same_reason_without_ansi(spark):
    rows = [{"items_json": "{broken"}, {"items_json": "[]"}]
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            found = [r["quarantine_reasons"] for r in apply_all_quality_rules(raw_orders(spark, rows)).collect()]
            assert "CORRUPTED_ITEMS_JSON" in found[0] and "EMPTY_ITEMS" in found[1]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
