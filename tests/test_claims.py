import math

import pytest
from pyspark.sql import functions as F

from starfold import Limits, claims_by_severity, claims_profile, generate_claims
from starfold.sources import stage

N = 30_000


@pytest.fixture(scope="module")
def fact(spark):
    """A tenth fatal, three tenths injury, the rest property damage or unknown counts."""
    i = F.col("id")
    killed = F.when(i % 10 == 0, (i % 3 + 1).cast("int")).when(i % 10 == 9, None).otherwise(0)
    injured = F.when((i % 10).between(1, 3), (i % 4 + 1).cast("int")).when(i % 20 == 19, None).otherwise(0)
    return stage(
        spark.range(N)
        .select(F.sha2(i.cast("string"), 256).alias("collision_id"), killed.alias("persons_killed"), injured.alias("persons_injured"))
        .select(
            "*",
            (F.col("persons_killed") + F.col("persons_injured")).alias("total_persons_affected"),
            F.when(F.col("persons_killed") > 0, "Fatal").when(F.col("persons_injured") > 0, "Injury").otherwise("Property Damage Only").alias("severity_category"),
        )
    )


@pytest.fixture(scope="module")
def claims(fact):
    return stage(generate_claims(fact))


def near(share, p, n):
    return abs(share - p) < 4 * math.sqrt(p * (1 - p) / n)


def test_rates(fact, claims):
    facts = {r[0]: r[1] for r in fact.groupBy("severity_category").count().collect()}
    made = {r[0]: r[1] for r in claims.groupBy("severity_category").count().collect()}
    assert made["Fatal"] == facts["Fatal"]
    assert near(made["Injury"] / facts["Injury"], 0.85, facts["Injury"])
    assert near(made["Property Damage Only"] / facts["Property Damage Only"], 0.30, facts["Property Damage Only"])
    n = claims.count()
    assert near(claims.filter("claim_status = 'OPEN'").count() / n, 0.35, n)


def test_amounts_within_bounds(claims):
    killed, injured, a = F.col("persons_killed"), F.col("persons_injured"), F.col("claim_amount")
    base = F.when(killed > 0, 50000 + 200000 * killed).when(injured > 0, 10000 + 15000 * injured)
    low, high = F.coalesce(base, F.lit(3000)) * 0.7, F.coalesce(base, F.lit(10000)) * 1.5
    assert claims.filter((a < low - 0.01) | (a > high + 0.01)).count() == 0
    assert claims.filter(F.round(a, 2) != a).count() == 0


def test_days(claims):
    days = F.col("days_to_close")
    assert claims.filter((F.col("claim_status") == "OPEN") != days.isNull()).count() == 0
    for severity, low, high in (("Fatal", 180, 545), ("Injury", 60, 240), ("Property Damage Only", 30, 90)):
        least, most = claims.filter(F.col("severity_category") == severity).agg(F.min(days), F.max(days)).first()
        assert low <= least < low + 5 and high - 5 < most < high


def test_ids_are_unique_and_carried(fact, claims):
    assert claims.select("claim_id").distinct().count() == claims.count()
    assert claims.join(fact, "collision_id", "left_anti").count() == 0


def test_same_result_for_any_partitioning(fact, claims):
    again = generate_claims(stage(fact.repartition(3, "persons_injured")))
    assert again.exceptAll(claims).count() == 0 and again.count() == claims.count()
    other = generate_claims(fact, seed="2")
    assert other.join(claims, "claim_id").count() == 0


@pytest.mark.parametrize("limits", [Limits(), Limits(hot_keys=64, hot_rows=100)])
def test_rows_sharing_an_id_draw_on_their_own(fact, limits):
    """A third of all rows share one id: their claims have ids of their own and the usual rate."""
    shared = stage(fact.withColumn("collision_id", F.when(F.xxhash64("collision_id") % 3 == 0, "one").otherwise(F.col("collision_id"))))
    made = generate_claims(shared, limits=limits)
    assert made.select("claim_id").distinct().count() == made.count()
    kind = (F.col("collision_id") == "one") & (F.col("severity_category") == "Injury")
    n = shared.filter(kind).count()
    assert n > 2000 and near(made.filter(kind).count() / n, 0.85, n)


def test_profile(fact, claims):
    p = claims_profile(claims, fact).first()
    assert p["total_claims"] == claims.count() == p["open_claims"] + p["closed_claims"]
    assert p["claims_per_collision"] == round(p["total_claims"] / N, 2)
    assert p["min_claim_amount"] <= p["avg_claim_amount"] <= p["max_claim_amount"]
    by = {r["severity_category"]: r for r in claims_by_severity(claims).collect()}
    assert sum(r["claim_count"] for r in by.values()) == p["total_claims"]
    total = sum(r["total_claim_amount"] for r in by.values())
    assert abs(total / p["total_claims"] - p["avg_claim_amount"]) < 1e-6


def test_no_claims(fact, claims):
    empty = claims_profile(claims.filter("false"), fact.filter("false")).first()
    assert empty["total_claims"] == 0 and empty["avg_claim_amount"] is None and empty["claims_per_collision"] is None


def test_no_python_in_the_plan(fact):
    assert "Python" not in generate_claims(fact)._jdf.queryExecution().executedPlan().toString()
