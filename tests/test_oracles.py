"""Every query against DuckDB on the smallest tables; the others must give rows."""

import pytest

import oracle
from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, duck, name):
    spark_side, duck_side = oracle.compare(queries()[name](spark, SF), duck, oracle_sql()[name])
    assert spark_side == duck_side


def test_entry_has_rows(spark):
    assert entry(spark).count() == 3


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
