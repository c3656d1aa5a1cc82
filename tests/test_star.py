"""Dimensions, fact and presentation table."""

import pytest
from pyspark.sql import functions as F

from starfold import (
    Limits,
    build_fact,
    build_factor_dim,
    build_location_dim,
    build_time_dim,
    build_vehicle_dim,
    clean,
    present,
)
from starfold.rules import COUNTS, FACT_KEYS
from starfold.sources import stage
from verification.binding import raw_collisions

SF = "/root/testdata/sf0.001"
LARGE = Limits(broadcast_rows=0, one_task_rows=0, hot_keys=64, hot_rows=10)


@pytest.fixture(scope="module")
def silver(spark):
    return stage(clean(raw_collisions(spark, SF)))


@pytest.fixture(scope="module")
def dims(silver):
    return {
        "dim_time": stage(build_time_dim(silver)),
        "dim_location": stage(build_location_dim(silver)),
        "dim_vehicle": stage(build_vehicle_dim(silver)),
        "dim_factor": stage(build_factor_dim(silver)),
    }


def test_columns(dims):
    assert dims["dim_time"].columns == [
        "time_key", "crash_date", "crash_time_str", "year", "month", "day", "day_of_week", "day_name", "month_name",
        "quarter", "hour", "time_category", "is_weekend",
    ]
    assert dims["dim_location"].columns == [
        "location_key", "borough", "zip_code", "latitude", "longitude", "location_name",
    ]
    assert dims["dim_vehicle"].columns == ["vehicle_key", "vehicle_type_code", "vehicle_type_name"]
    assert dims["dim_factor"].columns == ["factor_key", "contributing_factor", "factor_category"]
    for df, key in zip(dims.values(), ("time_key", "location_key", "vehicle_key", "factor_key")):
        assert dict(df.dtypes)[key] == "int"


def test_natural_keys_are_unique_and_keys_dense(dims):
    for df, natural in zip(
        dims.values(),
        (["crash_date", "crash_time_str"], ["borough", "zip_code", "latitude", "longitude"], ["vehicle_type_code"],
         ["contributing_factor"]),
    ):
        n = df.count()
        assert df.select(natural).distinct().count() == n
        assert df.agg(F.min(df.columns[0]), F.max(df.columns[0]), F.count_distinct(df.columns[0])).first()[:] == (1, n, n)


def test_no_location_without_coordinates(dims):
    assert dims["dim_location"].filter("latitude IS NULL OR longitude IS NULL").count() == 0


def test_dims_do_not_depend_on_input_order(silver, dims):
    shuffled = silver.repartition(13, "longitude")
    assert build_location_dim(shuffled).exceptAll(dims["dim_location"]).count() == 0
    assert build_factor_dim(shuffled, limits=LARGE).exceptAll(dims["dim_factor"]).count() == 0
    assert build_time_dim(shuffled, limits=LARGE).exceptAll(dims["dim_time"]).count() == 0
    assert build_vehicle_dim(shuffled, limits=LARGE).exceptAll(dims["dim_vehicle"]).count() == 0


@pytest.mark.parametrize("null_safe", [False, True])
def test_fact_rows_and_plans(silver, dims, rows, null_safe):
    small = build_fact(silver, dims, null_safe=null_safe)
    assert small.columns == ["collision_id", *FACT_KEYS, *COUNTS, "total_persons_affected", "severity_category"]
    assert small.count() == silver.count()
    assert rows(small) == rows(build_fact(silver, dims, null_safe=null_safe, limits=LARGE))


def test_null_parts_of_the_natural_key(silver, dims):
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    gaps = silver.filter(located & (F.col("borough").isNull() | F.col("zip_code").isNull())).count()
    nowhere = silver.filter(~located).count()
    assert gaps > 0 and nowhere > 0
    plain, safe = build_fact(silver, dims), build_fact(silver, dims, null_safe=True)
    assert plain.filter("location_key IS NULL").count() == gaps + nowhere
    assert safe.filter("location_key IS NULL").count() == nowhere
    assert safe.filter("time_key IS NULL").count() == 0 < plain.filter("time_key IS NULL").count()


def test_code_dim_folds_both_roles(spark, rows):
    df = spark.createDataFrame(
        [("Van", "Bus"), ("Bus", None), (None, "xyz"), ("van", "Van")], "vehicle_type_code_1 string, vehicle_type_code_2 string"
    )
    assert rows(build_vehicle_dim(df)) == [
        (1, "Bus", "Bus"), (2, "Van", "Van"), (3, "van", "Van"), (4, "xyz", "xyz"),
    ]


@pytest.fixture(scope="module")
def view(silver, dims):
    fact = stage(build_fact(silver, dims))
    return fact, stage(present(fact, dims))


def test_presentation(view, dims, rows):
    fact, wide = view
    assert len(wide.columns) == 46 and wide.count() == fact.count()
    assert rows(wide, *FACT_KEYS) == rows(fact, *FACT_KEYS)
    assert dict(wide.dtypes)["ROAD_CONDITION_CD"] == "string"
    assert {r[0] for r in wide.select("ACCIDENT_TYPE").distinct().collect()} <= {"FATAL", "INJURY", "PROPERTY_DAMAGE_ONLY"}
    assert wide.filter("location_key IS NULL AND BOROUGH IS NOT NULL").count() == 0
    assert rows(wide) == rows(present(fact, dims, limits=LARGE))


def test_roles_of_one_dimension_are_kept_apart(view):
    _, wide = view
    assert wide.filter("VEHICLE_TYPE_CODE_1 <> VEHICLE_TYPE_CODE_2").count() > 0
    same = wide.filter("primary_vehicle_key = secondary_vehicle_key AND VEHICLE_TYPE_CODE_1 <> VEHICLE_TYPE_CODE_2")
    assert same.count() == 0
