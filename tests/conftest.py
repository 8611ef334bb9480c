import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from souqframe.plans.warehouse import Warehouse
from souqframe.schemas import ORDER_FIELDS, RAW_SCHEMA
from souqframe.session import local_session

SF = "/root/testdata/sf0.001"

# A row that passes every check without a correction.
BASE = dict(
    zip(
        ORDER_FIELDS,
        ["ORD-1", "CUST-1", "N", "967712345678", "a@b.co", "X", "D", "S", "Cash", "PAID", "YER",
         "DELIVERED", "2024-02-15", "5", "25", "25.00",
         '[{"sku":"s","name":"n","qty":"2","unit_price":"10","total":"20"}]'],
    )
)


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def raw_orders(spark, changes, first_ingested=1000.0):
    """Raw orders made of the base row, each with some fields changed."""
    rows = [
        (first_ingested + number, "test", "orders.csv", "run", number, {**BASE, **change})
        for number, change in enumerate(changes, start=1)
    ]
    return spark.createDataFrame(rows, RAW_SCHEMA)
