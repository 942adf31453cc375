"""Every query with an SQL equivalent against DuckDB, at the smallest scale."""

import pytest

import __spark_entry__
from checks.compare import differences
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, sf_dir, name):
    rows, difference = differences(spark, con, name, sf_dir)
    assert rows > 0 or name == "empty_feature_table"
    assert not difference


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns[:4] == [
        "date",
        "item_id",
        "store_id",
        "total_quantity",
    ]
    assert set(__spark_entry__.queries()) >= set(QUERIES)
    assert set(__spark_entry__.oracle_sql()) >= set(ORACLES)
