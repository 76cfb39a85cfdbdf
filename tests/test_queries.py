import pytest
from compare import DATA, database, spark_rows, sql_rows

import __spark_entry__ as driver
from propfold.plans.oracles import statements
from propfold.plans.queries import registered

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


def test_every_query_has_its_sql():
    assert set(registered()) == set(statements())
    assert set(statements()) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_its_sql(spark, db, name):
    columns, rows = spark_rows(driver.queries()[name](spark, FOLDER))
    expected_columns, expected = sql_rows(db, driver.oracle_sql()[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows


def test_entry(spark):
    result = driver.entry(spark)
    assert "valor_total" in result.columns
    assert result.count() > 0
