import pytest
from pyspark.sql import functions as F

from starfold import Limits, Measure, claim_rollup, hash_sample, histogram, smallest, star_rollup, with_share
from starfold.sources import stage

LARGE = Limits(broadcast_rows=0, hot_keys=64, hot_rows=50)


@pytest.fixture(scope="module")
def star(spark):
    """Fact with a hot key, NULL keys, orphans, NULL measures and one id shared by a third of all rows."""
    i = F.col("id")
    fact = spark.range(3000).select(
        F.when(i % 3 == 0, "same").otherwise(F.concat(F.lit("id"), (i / 2).cast("int"))).alias("collision_id"),
        F.when(i % 3 == 1, 1).when(i % 11 == 0, None).otherwise((i % 60).cast("int")).alias("location_key"),
        F.when(i % 5 == 0, None).otherwise((i % 4).cast("int")).alias("persons_injured"),
        (i % 2).cast("int").alias("persons_killed"),
        F.when(i % 2 == 1, "Fatal").otherwise("Injury").alias("severity_category"),
    )
    dim = spark.range(50).select(
        i.cast("int").alias("location_key"),
        F.when(i % 7 == 0, None).otherwise(F.concat(F.lit("b"), i % 3)).alias("borough"),
    )
    claims = spark.range(900).select(
        i.cast("string").alias("claim_id"),
        F.when(i % 3 == 0, "same").otherwise(F.concat(F.lit("id"), i)).alias("collision_id"),
        ((i % 977) * 1.37).cast("decimal(18,2)").cast("double").alias("claim_amount"),
    )
    tables = {"f": stage(fact), "d": stage(dim), "c": stage(claims)}
    for name, df in tables.items():
        df.createOrReplaceTempView(f"rollup_{name}")
    return tables


MEASURES = (
    Measure("n", "count", "collision_id"),
    Measure("s", "sum", "persons_injured"),
    Measure("m", "mean", "persons_injured + persons_killed", 4),
    Measure("z", "sum", "CAST(NULL AS INT)"),
)


@pytest.mark.parametrize("limits", [Limits(), LARGE])
def test_star_rollup_equals_sql(spark, star, rows, limits):
    got = star_rollup(star["f"], star["d"], "location_key", "location_key", ("borough", "severity_category"), MEASURES, limits=limits)
    expected = spark.sql("""SELECT borough, severity_category, count(collision_id), sum(persons_injured),
        round(avg(persons_injured + persons_killed), 4), sum(CAST(NULL AS INT))
        FROM rollup_f f JOIN rollup_d d ON f.location_key = d.location_key GROUP BY 1, 2""")
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("limits", [Limits(), LARGE])
def test_star_rollup_where(spark, star, rows, limits):
    where = F.col("borough").isNotNull()
    got = star_rollup(star["f"], star["d"], "location_key", "location_key", ("borough",), MEASURES[:1], where=where, limits=limits)
    expected = spark.sql("""SELECT borough, count(collision_id) FROM rollup_f f
        JOIN rollup_d d ON f.location_key = d.location_key WHERE borough IS NOT NULL GROUP BY 1""")
    assert rows(got) == rows(expected)


def test_large_dimension_is_joined_after_aggregation(spark, star):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = star_rollup(star["f"], star["d"], "location_key", "location_key", ("borough",), MEASURES, limits=LARGE)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below_join = plan.split("SortMergeJoin")[1]
    assert "partial_count" in below_join and below_join.index("Exchange") < below_join.index("partial_count")


@pytest.mark.parametrize("limits", [Limits(), LARGE])
@pytest.mark.parametrize("keep", [True, False])
@pytest.mark.parametrize("ids", [True, False])
def test_claim_rollup_equals_the_full_join(spark, star, rows, limits, keep, ids):
    got = claim_rollup(
        star["f"], star["c"], ("borough", "severity_category"), dim=star["d"], fact_key="location_key",
        dim_key="location_key", where=F.col("borough").isNotNull(), keep_unclaimed=keep, count_ids=ids, limits=limits,
    )
    join = "LEFT" if keep else ""
    distinct = "count(DISTINCT f.collision_id), " if ids else ""
    expected = spark.sql(f"""SELECT borough, severity_category, {distinct}count(claim_id),
        sum(CAST(claim_amount AS DECIMAL(18,2))),
        CAST(sum(CAST(claim_amount AS DECIMAL(18,2))) AS DOUBLE) / count(claim_amount),
        CAST(min(claim_amount) AS DECIMAL(18,2)), CAST(max(claim_amount) AS DECIMAL(18,2))
        FROM rollup_f f JOIN rollup_d d ON f.location_key = d.location_key
        {join} JOIN rollup_c c ON f.collision_id = c.collision_id
        WHERE borough IS NOT NULL GROUP BY 1, 2""")
    assert rows(got) == rows(expected)
    assert sum(r["claim_count"] for r in got.collect()) > 100_000  # the pairs of the shared id are all counted


def test_claim_rollup_without_any_claim(spark, star, rows):
    none = star["c"].filter("false")
    by_fact = claim_rollup(star["f"], star["c"], ("severity_category",), limits=LARGE)
    assert rows(by_fact) == rows(claim_rollup(star["f"], star["c"], ("severity_category",)))
    kept = claim_rollup(star["f"], none, ("severity_category",), keep_unclaimed=True).collect()
    assert {(r["claim_count"], r["total"], r["mean"]) for r in kept} == {(0, None, None)}
    assert claim_rollup(star["f"], none, ("severity_category",)).count() == 0


def test_share(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    grouped = df.groupBy("k").agg(F.count("k").alias("n"))
    assert rows(with_share(grouped, "n", df)) == sorted([("a", 2, 50.0), ("b", 1, 25.0), (None, 0, 0.0)], key=repr)


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(i, 5) for i in range(40)], "k int, n int").repartition(8)
    order = [F.desc("n"), F.asc("k")]
    for crowded in (False, True):
        assert [r["k"] for r in smallest(df, order, 7, crowded=crowded).orderBy("k").collect()] == list(range(7))


@pytest.mark.parametrize("k", [1, 100, 1000, 10_000])
def test_hash_sample_equals_a_full_sort(spark, rows, k):
    df = stage(spark.range(4000).select(F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("who"), "id"))
    draw = F.expr("cast(conv(substring(sha2(concat(who, ':sample'), 256), 1, 8), 16, 10) as bigint)")
    expected = df.orderBy(draw, "who", "id").limit(k)
    assert rows(hash_sample(df, "who", k, ("id",))) == rows(expected)
    assert rows(hash_sample(df, "who", k, ("id",), rows=100_000_000)) == rows(expected)  # a bad guess costs passes only


@pytest.mark.parametrize("n", [30, 4000, 100_000])
def test_hash_sample_with_null_identities(spark, rows, n):
    df = stage(spark.range(n).select(F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("who"), "id"))
    draw = F.expr("cast(conv(substring(sha2(concat(coalesce(who, ''), ':sample'), 256), 1, 8), 16, 10) as bigint)")
    expected = rows(df.orderBy(draw, "who", "id").limit(10))
    for guess in (None, 10, 10_000_000):
        assert rows(hash_sample(df, "who", 10, ("id",), rows=guess)) == expected


def test_histogram_of_finite_values(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 1.0, 2.0, float("nan"), float("inf"), float("-inf"), None]], "v double")
    assert [(r["bin"], r["low"], r["high"], r["rows"]) for r in histogram(df, "v", 2).orderBy("bin").collect()] == [(1, 0.0, 1.0, 1), (2, 1.0, 2.0, 2)]


def test_histogram(spark, rows):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 1, 5, 9.99, 10]] + [(None,)], "v double")
    got = {r["bin"]: r["rows"] for r in histogram(df, "v", 10).collect()}
    assert got == {1: 1, 2: 2, 3: 0, 4: 0, 5: 0, 6: 1, 7: 0, 8: 0, 9: 0, 10: 2}
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert {r["bin"]: r["rows"] for r in histogram(flat, "v", 4).collect()} == {1: 2, 2: 0, 3: 0, 4: 0}
    assert histogram(flat.filter("false"), "v", 4).count() == 0
