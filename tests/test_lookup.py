import itertools

import pytest
from pyspark.sql import functions as F

from starfold import Limits, hot_hashes, lookup
from starfold.operators import skew
from starfold.sources import stage

LARGE = Limits(broadcast_rows=0, hot_keys=64, hot_rows=100)
LARGE_COLD = Limits(broadcast_rows=0)


@pytest.fixture(scope="module")
def left(spark):
    """A third of the rows hold one key, a third hold a NULL part, the rest are spread; some have no partner."""
    i = F.col("id")
    return stage(
        spark.range(6000).select(
            F.when(i % 3 == 0, "hot").when(i % 3 == 1, None).otherwise(F.concat(F.lit("k"), i % 500)).alias("a"),
            F.when(i % 3 == 0, 1).otherwise((i % 7).cast("int")).alias("b"),
            i.alias("n"),
        )
    )


@pytest.fixture(scope="module")
def right(spark):
    i = F.col("id")
    keyed = spark.range(0, 500, 2).select(F.concat(F.lit("k"), i).alias("ra"))
    full = keyed.crossJoin(spark.range(7).select(i.cast("int").alias("rb")))
    more = spark.sql("SELECT 'hot' ra, 1 rb UNION ALL SELECT NULL, 2 UNION ALL SELECT NULL, 3")
    return stage(full.unionByName(more).select("ra", "rb", F.xxhash64("ra", "rb").alias("v"), F.lit(None).cast("int").alias("w")))


def brute(left, right, null_safe):
    table = {(r.ra, r.rb): (r.v, r.w) for r in right.collect()}
    out = []
    for r in left.collect():
        known = null_safe or (r.a is not None and r.b is not None)
        out.append((r.a, r.b, r.n, *(table.get((r.a, r.b), (None, None)) if known else (None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize(
    ("limits", "null_safe"), list(itertools.product([Limits(), LARGE, LARGE_COLD], [False, True]))
)
def test_all_plans_agree_with_brute_force(left, right, rows, limits, null_safe):
    got = lookup(left, right, {"a": "ra", "b": "rb"}, {"v": "value", "w": "other"}, null_safe=null_safe, limits=limits)
    assert got.columns == ["a", "b", "n", "value", "other"]
    assert rows(got) == brute(left, right, null_safe)


def test_hot_keys_found(left):
    hot = hot_hashes(left, {"k": ["a", "b"]}, LARGE)["k"]
    assert left.filter(F.xxhash64("a", "b").isin(*hot)).filter("a = 'hot'").count() == 2000
    assert hot_hashes(left, {"k": ["a", "b"]}, Limits())["k"] == []  # too few rows to matter


def test_hot_keys_are_found_across_key_types(spark):
    """A hot int key is spread when the dimension's key is bigint: both sides hash the same type."""
    left = stage(spark.range(6000).repartition(16).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).cast("int").alias("a")))
    right = stage(spark.range(6000).select(F.col("id").alias("ra"), (F.col("id") * 2).alias("v")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = lookup(left, right, {"a": "ra"}, {"v": "value"}, limits=LARGE)
        assert got.filter("value = 2 * a").count() == 6000
        assert got.filter("a = 7").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 1600  # of 3000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sketches_are_merged_in_groups(spark):
    """No exchange of the scan brings the sketches of all input tasks to one task."""
    df = stage(spark.range(0, 40_000, 1, 200).select(F.when(F.col("id") % 5 == 0, 3).otherwise(F.col("id")).alias("a")))
    plans = []
    original = skew.stage
    skew.stage = lambda frame, label: plans.append(frame._jdf.queryExecution().executedPlan().toString()) or original(frame, label)
    try:
        hot = hot_hashes(df, {"k": ["a"]}, Limits(hot_keys=16, hot_rows=100), groups=8)["k"]
    finally:
        skew.stage = original
    assert [r[0] for r in df.filter(F.xxhash64("a").isin(*hot)).distinct().collect()] == [3]
    assert len(plans) == 1 and "SinglePartition" not in plans[0] and "hashpartitioning(" in plans[0]


def test_a_wide_small_side_is_not_broadcast(spark, left, right):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def plan(limits):
            return lookup(left, right, {"a": "ra", "b": "rb"}, {"v": "value"}, hot=[], limits=limits)

        narrow = plan(Limits(broadcast_bytes=100))
        assert "BroadcastHashJoin" not in narrow._jdf.queryExecution().executedPlan().toString()
        assert narrow.exceptAll(plan(Limits())).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_and_null_keys_are_spread(spark, left, right):
    """Neither the third with one key nor the third with NULLs ends in one task of the shuffle join."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = left.repartition(16)
        got = lookup(stage(many), right, {"a": "ra", "b": "rb"}, {"v": "value"}, limits=LARGE)
        for part in ("a = 'hot'", "a IS NULL"):
            largest = got.filter(part).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
            assert largest < 1200, part
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_side_is_broadcast_and_large_side_is_not(spark, left, right):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def plan(limits):
            df = lookup(left, right, {"a": "ra", "b": "rb"}, {"v": "value"}, hot=[], limits=limits)
            return df._jdf.queryExecution().executedPlan().toString()

        assert "BroadcastHashJoin" in plan(Limits())
        assert "SortMergeJoin" in plan(LARGE) and "BroadcastHashJoin" not in plan(LARGE)
        assert "__lane" in plan(LARGE).split("Exchange hashpartitioning(")[1].split(")")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
