"""Synthetic insurance claims, reproducible from the fact table and a seed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.functions import draw
from starfold.operators.copies import number_copies
from starfold.operators.skew import LIMITS, Limits
from starfold.rules import ClaimRules

_CARRIED = ("persons_injured", "persons_killed", "total_persons_affected", "severity_category")
MONEY = "decimal(18,2)"


def _number(value: float) -> Column:
    return F.lit(float(value))


def generate_claims(
    fact: DataFrame,
    seed: str = "",
    rules: ClaimRules = ClaimRules(),
    *,
    hot: Sequence[int] | None = None,
    limits: Limits = LIMITS,
) -> DataFrame:
    """At most one claim per fact row; likelier, dearer and slower to close the worse the outcome.

    Every draw hashes the row's identity: collision id, plus a number for the
    second and later rows with the same id, so claim ids are unique and draws
    independent. Results do not change with partitioning, retries or reruns. ``hot`` gives the
    hashes of hot collision ids when they are known.
    """
    rows = number_copies(fact.select("collision_id", *_CARRIED), "collision_id", _CARRIED, hot=hot, limits=limits)
    who = F.coalesce("collision_id", F.lit(""))
    who = F.when(F.col("copy_no") == 1, who).otherwise(F.concat_ws("#", who, F.col("copy_no").cast("string")))
    rows = rows.select("*", who.alias("__who"))
    killed, injured, affected = F.col("persons_killed"), F.col("persons_injured"), F.col("total_persons_affected")

    def u(purpose: str) -> Column:
        return draw(F.col("__who"), purpose, seed)

    def line(ab: tuple[float, float], x: Column) -> Column:
        return _number(ab[0]) + _number(ab[1]) * x

    rate = (
        F.when(killed > 0, 1.0)
        .when(injured > 0, rules.p_injured)
        .when(affected > 0, rules.p_affected)
        .otherwise(rules.p_other)
    )
    base = (
        F.when(killed > 0, line(rules.base_killed, killed))
        .when(injured > 0, line(rules.base_injured, injured))
        .otherwise(line(rules.base_other, u("base")))
    )
    amount = base * line(rules.factor, u("factor"))
    open_ = u("status") < rules.p_open
    days = (
        F.when(killed > 0, line(rules.days_killed, u("days")))
        .when(injured > 0, line(rules.days_injured, u("days")))
        .when(F.col("__amount") > rules.large_amount, line(rules.days_large, u("days")))
        .otherwise(line(rules.days_other, u("days")))
    )
    return (
        rows.filter(u("has") < rate)
        .select("*", amount.alias("__amount"), open_.alias("__open"))
        .select(
            F.sha2(F.concat(F.col("__who"), F.lit(":claim" + (f":{seed}" if seed else ""))), 256).alias("claim_id"),
            "collision_id",
            F.round("__amount", 2).alias("claim_amount"),
            F.when(F.col("__open"), "OPEN").otherwise("CLOSED").alias("claim_status"),
            F.when(~F.col("__open"), days).alias("days_to_close"),
            *_CARRIED,
        )
    )


def money(col: str) -> Column:
    """A two-digit amount as an exact decimal, so that sums do not depend on their order."""
    return F.col(col).cast(MONEY)


def claims_profile(claims: DataFrame, fact: DataFrame) -> DataFrame:
    """One row: counts by status, amount statistics, mean days to close, claims per fact row."""
    total = F.count(F.lit(1))
    exact_days = F.col("days_to_close").cast("decimal(18,6)")
    profile = claims.agg(
        total.alias("total_claims"),
        F.count_if(F.col("claim_status") == "OPEN").alias("open_claims"),
        F.count_if(F.col("claim_status") == "CLOSED").alias("closed_claims"),
        (F.sum(money("claim_amount")).cast("double") / F.nullif(F.count("claim_amount"), F.lit(0))).alias("avg_claim_amount"),
        F.min("claim_amount").alias("min_claim_amount"),
        F.max("claim_amount").alias("max_claim_amount"),
        (F.sum(exact_days).cast("double") / F.nullif(F.count("days_to_close"), F.lit(0))).alias("avg_days_to_close"),
    )
    facts = fact.agg(F.count(F.lit(1)).alias("n")).scalar()
    per_fact = F.round(F.col("total_claims") / F.nullif(facts, F.lit(0)), 2)
    return profile.select("*", per_fact.alias("claims_per_collision"))


def claims_by_severity(claims: DataFrame) -> DataFrame:
    amount = F.sum(money("claim_amount")).cast("double")
    return (
        claims.groupBy("severity_category")
        .agg(
            F.count(F.lit(1)).alias("claim_count"),
            (amount / F.nullif(F.count("claim_amount"), F.lit(0))).alias("avg_claim_amount"),
            amount.alias("total_claim_amount"),
        )
        .orderBy("severity_category")
    )
