import pytest
from pyspark.sql import functions as F

from starfold import rules
from starfold.functions import blank_to_null, calendar_columns, classify, draw, hour_of, joined_name, severity, time_band


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_blank_to_null(spark):
    df = spark.createDataFrame([("  a ",), ("   ",), ("",), (None,), ("b",)], "s string")
    assert one(df, blank_to_null(F.col("s"))) == ["a", None, None, None, "b"]


@pytest.mark.parametrize(
    ("code", "name"),
    [
        ("4 dr SEDAN", "Sedan"), ("Pick-up Truck", "Truck"), ("Box Truck Van", "Truck"), ("School Bus", "Bus"),
        ("MOPED", "Motorcycle/Moped"), ("Motorbike", "Bicycle"), ("E-Bike", "Bicycle"), ("Van", "Van"),
        ("taxi", "Taxi"), ("Station Wagon/Sport Utility Vehicle", "Station Wagon/Sport Utility Vehicle"),
        ("Busy sedan", "Sedan"),
    ],
)
def test_vehicle_rules(spark, code, name):
    df = spark.createDataFrame([(code,)], "c string")
    assert one(df, classify(F.col("c"), rules.VEHICLE_RULES)) == [name]


@pytest.mark.parametrize(
    ("factor", "category"),
    [
        ("Unspecified", "Unspecified"), ("Driverless/Runaway Vehicle", "Driver Behavior"),
        ("Following Too Closely", "Driver Behavior"), ("Unsafe Speed", "Driver Behavior"),
        ("Pavement Slippery", "Road/Weather"), ("Brakes Defective", "Vehicle Issue"),
        ("Other Vehicular", "Other"), ("Pedestrian/Bicyclist Error", "Pedestrian/Cyclist"), ("Glare", "Other"),
    ],
)
def test_factor_rules(spark, factor, category):
    df = spark.createDataFrame([(factor,)], "c string")
    assert one(df, classify(F.col("c"), rules.FACTOR_RULES, rules.FACTOR_DEFAULT)) == [category]


def test_classify_without_rules(spark):
    assert one(spark.range(1), classify(F.lit("x"), [])) == ["x"]


def test_time_bands_at_their_edges(spark):
    hours = [0, 5, 6, 8, 9, 11, 12, 14, 15, 17, 18, 20, 21, 23, None, 24, -1]
    labels = ["00:00-05:59", "06:00-08:59", "09:00-11:59", "12:00-14:59", "15:00-17:59", "18:00-20:59"]
    expected = [label for label in labels for _ in range(2)] + ["21:00-23:59"] * 5
    df = spark.createDataFrame([(i, h) for i, h in enumerate(hours)], "i int, h int").orderBy("i")
    assert one(df, time_band(F.col("h"))) == expected


def test_hour_of_bad_clocks(spark):
    clocks = ["2:39", "14:39", "00:01", "", "noon", "x9:00", None, "99999999999:00", "7"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(clocks)], "i int, c string").orderBy("i")
    assert one(df, hour_of(F.col("c"))) == [2, 14, 0, None, None, None, None, None, None]


def test_severity_truth_table(spark):
    cases = {
        (1, 0): "Fatal", (1, 1): "Fatal", (1, None): "Fatal", (0, 1): "Injury", (None, 1): "Injury",
        (0, 0): "Property Damage Only", (0, None): "Property Damage Only", (None, 0): "Property Damage Only",
        (None, None): "Property Damage Only",
    }
    df = spark.createDataFrame([(i, *k) for i, k in enumerate(cases)], "i int, k int, j int").orderBy("i")
    assert one(df, severity(F.col("k"), F.col("j"))) == list(cases.values())


def test_calendar(spark):
    df = spark.sql("SELECT date'2021-09-11' d, '2:39' t UNION ALL SELECT NULL, NULL").orderBy(F.desc_nulls_last("d"))
    columns = calendar_columns("d", "t")
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in columns.items()]).collect()]
    assert list(columns) == [
        "year", "month", "day", "day_of_week", "day_name", "month_name", "quarter", "hour", "time_category",
        "is_weekend",
    ]
    assert got[0] == (2021, 9, 11, 7, "Saturday", "September", 3, 2, "00:00-05:59", True)
    assert got[1] == (None,) * 8 + ("21:00-23:59", False)


def test_location_name(spark):
    df = spark.createDataFrame([(1, "A", "1"), (2, "A", None), (3, None, "1")], "i int, b string, z string").orderBy("i")
    assert one(df, joined_name(("b", "z"), "Unknown")) == ["A, 1", "A", "Unknown"]


def test_draws_are_uniform_and_repeatable(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("s"))
    u = df.select(draw(F.col("s"), "a").alias("u"), draw(F.col("s"), "b").alias("v"), draw(F.col("s"), "a", "1").alias("w"))
    stats = u.agg(F.avg("u"), F.min("u"), F.max("u"), F.corr("u", "v"), F.corr("u", "w"), F.stddev("u")).first()
    assert abs(stats[0] - 0.5) < 0.01 and stats[1] >= 0 and stats[2] < 1
    assert abs(stats[3]) < 0.03 and abs(stats[4]) < 0.03 and abs(stats[5] - 12**-0.5) < 0.01
    again = df.repartition(3).select(draw(F.col("s"), "a").alias("u"))
    assert u.select("u").exceptAll(again).count() == 0
