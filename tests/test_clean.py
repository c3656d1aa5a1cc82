import hashlib

import pytest
from pyspark.sql import functions as F

from starfold import CleanSpec, clean, reject_counts
from starfold.rules import RAW_FIELDS

BASE = {
    "CRASH DATE": "01/02/2020", "CRASH TIME": "2:39", "BOROUGH": "B", "ZIP CODE": "1", "LATITUDE": 40.7,
    "LONGITUDE": -74.0, "LOCATION": None, **{n: 0 for n, k in RAW_FIELDS if k == "int"},
    "CONTRIBUTING FACTOR VEHICLE 1": "f", "CONTRIBUTING FACTOR VEHICLE 2": None,
    "VEHICLE TYPE CODE 1": "v", "VEHICLE TYPE CODE 2": None,
}


def frame(spark, *changes):
    schema = ", ".join(f"`{n}` {k}" for n, k in RAW_FIELDS)
    return spark.createDataFrame([tuple({**BASE, **c}[n] for n, _ in RAW_FIELDS) for c in changes], schema)


INJURED, KILLED = "NUMBER OF PERSONS INJURED", "NUMBER OF PERSONS KILLED"
NOWHERE = {"LATITUDE": None, "LONGITUDE": None}


@pytest.mark.parametrize(
    ("change", "kept"),
    [
        ({"LATITUDE": 40.3}, 1), ({"LATITUDE": 41.1}, 1), ({"LATITUDE": 40.29}, 0), ({"LATITUDE": 41.11}, 0),
        ({"LONGITUDE": -74.5}, 1), ({"LONGITUDE": -73.4}, 1), ({"LONGITUDE": -74.51}, 0), ({"LONGITUDE": -73.39}, 0),
        ({"LATITUDE": None}, 0), ({"LONGITUDE": None}, 0), (NOWHERE, 0), ({**NOWHERE, INJURED: 1}, 1),
        ({**NOWHERE, KILLED: 1}, 1), ({**NOWHERE, INJURED: None, KILLED: None}, 0), ({**NOWHERE, INJURED: None, KILLED: 1}, 1),
        ({INJURED: None, KILLED: None}, 1), ({"LATITUDE": 0.0, INJURED: 2}, 1),
        ({"CRASH DATE": "13/45/2021"}, 0), ({"CRASH DATE": "1/5/2021"}, 0), ({"CRASH DATE": None}, 0),
        ({"CRASH DATE": "2021-01-05"}, 0), ({"CRASH DATE": "13/45/2021", KILLED: 1}, 0), ({"CRASH TIME": "junk"}, 1),
    ],
)
def test_keep_rule(spark, change, kept):
    df = frame(spark, change)
    assert clean(df).count() == kept
    counts = {r["outcome"]: r["rows"] for r in reject_counts(df).collect()}
    assert counts.get("kept", 0) == kept and sum(counts.values()) == 1


def test_blank_strings(spark):
    row = clean(frame(spark, {"BOROUGH": "  X ", "ZIP CODE": "  ", "VEHICLE TYPE CODE 1": ""})).first()
    assert (row["borough"], row["zip_code"], row["vehicle_type_code_1"]) == ("X", None, None)


def test_row_id_skips_nulls(spark):
    got = [r["collision_id"] for r in clean(frame(spark, {}, {**NOWHERE, "CRASH TIME": None, KILLED: 1})).collect()]
    texts = ["01/02/2020|2:39|40.7|-74.0", "01/02/2020"]
    assert sorted(got) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in texts)


def test_extra_id_columns_tell_rows_apart(spark):
    df = frame(spark, {INJURED: 1}, {INJURED: 2})
    assert clean(df).select("collision_id").distinct().count() == 1
    assert clean(df, CleanSpec(id_extra=(INJURED,))).select("collision_id").distinct().count() == 2


def test_silver_columns(spark):
    out = clean(frame(spark, {}))
    assert len(out.columns) == 19 and out.columns[:3] == ["collision_id", "crash_date", "crash_time_str"]
    assert dict(out.dtypes)["crash_date"] == "date"
    assert out.filter(F.col("LOCATION".lower()).isNull() if "location" in out.columns else F.lit(True)).count() == 1
