"""Raw collision rows derived from the supplied tables, one per order (see FIXTURES.md).

All values are integer arithmetic on the order key, so the same rows can be
derived by Spark and by DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.operators import lookup
from starfold.rules import RAW_FIELDS

VEHICLES = (
    "Sedan", "Pick-up Truck", "School Bus", "MOPED", "E-Bike", "Van", "Taxi",
    "Station Wagon/Sport Utility Vehicle", " ",
)
FACTORS = (
    "Driver Inattention/Distraction", "Following Too Closely", "Pavement Slippery", "Brakes Defective",
    "Pedestrian Error", "Unspecified", "Other Vehicular", "", "Driverless/Runaway Vehicle",
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    placed = lookup(
        orders, load(spark, sf_dir, "customer"), {"o_custkey": "c_custkey"}, {"c_custkey": "c", "c_nationkey": "nationkey"}
    )
    in_nation = lookup(
        placed, load(spark, sf_dir, "nation"), {"nationkey": "n_nationkey"}, {"n_nationkey": "n", "n_regionkey": "regionkey"}
    )
    rows = lookup(
        in_nation, load(spark, sf_dir, "region"), {"regionkey": "r_regionkey"}, {"r_regionkey": "r", "r_name": "r_name"}
    ).filter(F.col("r").isNotNull())
    k, c = F.col("o_orderkey"), F.col("c")

    def every(m: int, r: int = 0):
        return k % m == r

    def pick(values, index):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))

    def within(values, index):
        return F.when(index < len(values), pick(values, F.least(index, F.lit(len(values) - 1))))

    pedestrians = F.when(every(10, 1), 1).otherwise(0)
    cyclists = F.when(every(12, 1), 1).otherwise(0)
    motorists = F.when(every(7), (k % 5).cast("int")).otherwise(0)
    killed = F.when(every(31), None).when(every(101), 1).otherwise(0)
    clock = F.concat(((k * 7) % 24).cast("string"), F.lit(":"), F.lpad(((k * 13) % 60).cast("string"), 2, "0"))
    columns = {
        "CRASH DATE": F.when(every(97), "13/45/2021").otherwise(F.date_format("o_orderdate", "MM/dd/yyyy")),
        "CRASH TIME": F.when(~every(53), clock),
        "BOROUGH": F.when(every(11), "   ")
        .when(every(13), None)
        .otherwise(F.concat(F.lit("  "), "r_name", F.lit(" "))),
        "ZIP CODE": F.when(every(17), "").otherwise((10000 + F.col("n")).cast("string")),
        "LATITUDE": F.when(every(19), None)
        .when(every(23), F.lit(0.0))
        .otherwise((4030 + c % 80).cast("double") / F.lit(100.0)),
        "LONGITUDE": F.when(~every(19), (-7450 + c % 110).cast("double") / F.lit(100.0)),
        "LOCATION": F.lit(None),
        "NUMBER OF PERSONS INJURED": F.when(~every(29), pedestrians + cyclists + motorists),
        "NUMBER OF PERSONS KILLED": killed,
        "NUMBER OF PEDESTRIANS INJURED": pedestrians,
        "NUMBER OF PEDESTRIANS KILLED": F.lit(0),
        "NUMBER OF CYCLIST INJURED": cyclists,
        "NUMBER OF CYCLIST KILLED": F.lit(0),
        "NUMBER OF MOTORIST INJURED": motorists,
        "NUMBER OF MOTORIST KILLED": F.coalesce(killed, F.lit(0)),
        "CONTRIBUTING FACTOR VEHICLE 1": pick(FACTORS, (k * 7 + 1) % 9),
        "CONTRIBUTING FACTOR VEHICLE 2": within(FACTORS, (k * 3 + 4) % 13),
        "VEHICLE TYPE CODE 1": pick(VEHICLES, k % 9),
        "VEHICLE TYPE CODE 2": within(VEHICLES, (k * 5 + 2) % 11),
    }
    return rows.select(*[columns[name].cast(kind).alias(name) for name, kind in RAW_FIELDS])
