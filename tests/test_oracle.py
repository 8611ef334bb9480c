"""Some of the registered queries against DuckDB; `python -m checks.compare` runs all of them."""

import pytest

from checks import oracle, registry
from checks.compare import duck, rows_of
from tests.conftest import SF

SOME = [
    "helper_functions", "raw_envelope", "csv_round_trip", "exact_row_numbers", "rule_date", "rule_total_order",
    "audit_trail", "validation_reasons", "quarantined_orders", "sales_by_city", "top_products", "top_customers",
    "high_value_orders", "upsert_two_batches", "mv_daily_incremental",
]


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", SOME)
def test_same_rows(spark, connection, name):
    df = registry.queries()[name](spark, SF)
    result = connection.execute(oracle.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(row) for row in df.collect()]) == rows_of(names, result.fetchall())


def test_every_query_has_its_sql():
    assert set(oracle.oracle_sql()) == set(registry.queries())
