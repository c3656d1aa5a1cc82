import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starfold import Limits, dense_key, number_copies
from starfold.sources import stage


def pairs(spark, n):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.concat(F.lit("k"), (F.col("id") * 7919) % n)).alias("a"),
        F.col("id").cast("int").alias("b"),
    )


def windowed(df, order):
    by = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.select(F.row_number().over(by).alias("key"), *df.columns)


MANY = Limits(one_task_rows=0)


@pytest.mark.parametrize("limits", [Limits(), MANY])
@pytest.mark.parametrize("n", [0, 1, 5, 5000])
def test_equals_row_number(spark, n, limits):
    df = pairs(spark, n)
    got = dense_key(df, ["a", "b"], "key", limits=limits)
    assert got.columns == ["key", "a", "b"] and dict(got.dtypes)["key"] == "int"
    assert got.exceptAll(windowed(df, ["a", "b"])).count() == 0 and got.count() == n


def test_a_low_bound_saves_the_stored_copy(spark):
    df = pairs(spark, 500)
    got = dense_key(df, ["a", "b"], "key", at_most=500)
    assert "FileScan" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.exceptAll(windowed(df, ["a", "b"])).count() == 0


def test_input_order_and_partitions_do_not_matter(spark):
    df = pairs(spark, 3000)
    first = dense_key(df, ["a", "b"], "key", limits=MANY)
    for other in (df.repartition(1), df.orderBy(F.desc("b")), df.repartition(23)):
        assert dense_key(other, ["a", "b"], "key", limits=MANY).exceptAll(first).count() == 0


def test_no_single_partition_exchange_over_the_rows(spark):
    plan = dense_key(pairs(spark, 100), ["a", "b"], "key", limits=MANY)._jdf.queryExecution().executedPlan().toString()
    after = plan.split("SinglePartition")
    assert len(after) == 2 and "ReadSchema: struct<__pos:bigint>" in after[1]  # the per-partition counts alone
    assert "functions=[partial_count(1)]" in after[1] and "BroadcastHashJoin" in plan


def copies_frame(spark, n=4000):
    """A third of all rows share one identity; a part of those are wholly identical."""
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") / 2).cast("int"))).alias("who"),
        F.when(F.col("id") % 6 == 0, 1).when(F.col("id") % 15 == 3, None).otherwise((F.col("id") % 50).cast("int")).alias("x"),
        (F.col("id") % 2).cast("int").alias("y"),
    )


@pytest.mark.parametrize("limits", [Limits(), Limits(hot_keys=64, hot_rows=100, one_task_rows=0)])
def test_number_copies_equals_row_number(spark, limits):
    df = stage(copies_frame(spark).repartition(5))
    by = Window.partitionBy("who").orderBy(F.col("x").asc_nulls_first(), F.col("y").asc_nulls_first())
    expected = df.select("*", F.row_number().over(by).cast("bigint").alias("copy_no"))
    got = number_copies(df, "who", ["x", "y"], limits=limits)
    assert got.exceptAll(expected).count() == 0 and got.count() == df.count()


def test_hot_identity_is_not_put_in_one_task(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = stage(copies_frame(spark, 20000).repartition(5))
        got = stage(number_copies(df, "who", ["x", "y"], limits=Limits(hot_keys=64, hot_rows=100, one_task_rows=0)))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = got.filter("who = 'hot'").groupBy(F.input_file_name()).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] < df.count() / 3 / 2 and sizes[1] > 2
