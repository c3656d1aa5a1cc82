"""Every registered query against its DuckDB equivalent, and the counts recorded in FIXTURES.md."""

import pytest

import __spark_entry__ as contract
from verification.compare import connect, differences
from verification.oracle import ORACLES
from verification.registry import QUERIES, lake

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    assert differences(spark, duck, name, SMALL) == []


def test_entry(spark):
    assert contract.entry(spark).count() == 5


def test_recorded_counts(spark):
    made = lake(spark, MIDDLE)
    silver = made.table("silver")
    assert made.table("bronze").count() == 15_000 and silver.count() == 13_813
    assert silver.select("collision_id").distinct().count() == 13_812
    assert silver.filter("latitude IS NULL").count() == 204
    assert made.table("dim_time").count() == 13_471 and made.table("dim_location").count() == 3_370
    assert made.table("dim_vehicle").count() == 8 and made.table("dim_factor").count() == 8
    assert made.table("fact_collisions").filter("location_key IS NULL").count() == 3_059
