"""Chart-ready datasets. All are aggregated in Spark over full tables; an empty input gives no rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.operators.claims import money
from starfold.operators.lookup import lookup
from starfold.operators.rollup import Measure, claim_rollup, rollup
from starfold.operators.sample import hash_sample, histogram
from starfold.plans.catalog import AMOUNT, CASUALTIES, COUNT, Gold, by_factor, by_location, by_time, claims_by_area, metric_rows

SAMPLE_ROWS = 10_000
HISTOGRAM_BINS = 30
TOP_FACTORS = 15


def r01_points(g: Gold, k: int = SAMPLE_ROWS) -> DataFrame:
    """A repeatable sample of located rows for a point map."""
    place = {"location_key": "__place", "borough": "borough", "zip_code": "zip_code", "latitude": "latitude", "longitude": "longitude"}
    fact = g.fact_collisions.filter(F.col("location_key").isNotNull())
    columns = ("collision_id", "location_key", "persons_injured", "persons_killed", "severity_category")
    located = lookup(fact.select(*columns), g.dim_location, {"location_key": "location_key"}, place, limits=g.limits)
    located = located.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    ties = ("location_key", "persons_injured", "persons_killed", "severity_category")
    return hash_sample(located, "collision_id", k, ties, rows=fact.count()).select(
        "borough",
        "zip_code",
        "latitude",
        "longitude",
        "collision_id",
        F.coalesce("persons_injured", F.lit(0)).alias("persons_injured"),
        "persons_killed",
        "severity_category",
    )


def r02_monthly(g: Gold) -> DataFrame:
    rows = by_time(g, ("year", "month", "month_name"), CASUALTIES)
    return rows.select("*", F.make_date("year", "month", F.lit(1)).alias("date")).orderBy("year", "month")


def r03_hourly(g: Gold) -> DataFrame:
    return by_time(g, ("hour",), (COUNT,), F.col("hour").isNotNull()).orderBy("hour")


def r04_weekday(g: Gold) -> DataFrame:
    known = F.col("day_name").isNotNull()
    return by_time(g, ("day_name", "day_of_week"), (COUNT,), known).orderBy("day_of_week")


def _claim_bars(rows: DataFrame, by: str) -> DataFrame:
    return rows.select(
        by,
        "claim_count",
        F.col("total").cast("double").alias("total_amount"),
        F.col("mean").alias("avg_amount"),
    )


def r05_claims_borough(g: Gold) -> DataFrame:
    return _claim_bars(claims_by_area(g, ("borough",)), "borough").orderBy(F.desc("total_amount"), "borough")


def r06_claims_severity(g: Gold) -> DataFrame:
    """Grouped by the fact's severity; the claims carry a column of that name too."""
    rows = claim_rollup(g.fact_collisions, g.claims(), ("severity_category",), limits=g.limits)
    return _claim_bars(rows, "severity_category")


def r07_claim_status(g: Gold) -> DataFrame:
    rows = rollup(
        g.claims(),
        ("claim_status",),
        (Measure("claim_count", "count", "claim_id"), Measure("total_amount", "sum", AMOUNT)),
    )
    return rows.select("claim_status", "claim_count", F.col("total_amount").cast("double").alias("total_amount"))


def r08_days_histogram(g: Gold, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """All closed claims, in equal intervals of days to close."""
    return histogram(g.claims().filter(F.col("claim_status") == "CLOSED"), "days_to_close", bins).orderBy("bin")


def r09_severity(g: Gold) -> DataFrame:
    return rollup(g.fact_collisions, ("severity_category",), (COUNT,))


def r10_severity_borough(g: Gold) -> DataFrame:
    """Long form: one row per borough and severity series."""
    return by_location(g, ("borough", "severity_category"), (COUNT,), F.col("borough").isNotNull())


def r11_top_factors(g: Gold, k: int = TOP_FACTORS) -> DataFrame:
    rows = by_factor(g, ("contributing_factor",), (COUNT,))
    return rows.orderBy(F.desc("collision_count"), "contributing_factor").limit(k)


def r12_summary(g: Gold) -> DataFrame:
    """Six formatted numbers; row counts, and 0 where there is nothing to sum."""
    facts = g.fact_collisions.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("persons_injured"), F.lit(0)).alias("injured"),
        F.coalesce(F.sum("persons_killed"), F.lit(0)).alias("killed"),
    )
    amount = money("claim_amount")
    claims = g.claims().agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(amount).cast("double"), F.lit(0.0)).alias("total"),
        F.coalesce(F.sum(amount).cast("double") / F.nullif(F.count(amount), F.lit(0)), F.lit(0.0)).alias("mean"),
    )

    def dollars(name: str):
        return F.concat(F.lit("$"), F.format_number(name, 2))

    return metric_rows(
        facts,
        {
            "Total Collisions": F.format_number("n", 0),
            "Total Injuries": F.format_number("injured", 0),
            "Total Fatalities": F.format_number("killed", 0),
        },
    ).unionByName(
        metric_rows(
            claims,
            {
                "Total Claims": F.format_number("n", 0),
                "Total Claim Amount": dollars("total"),
                "Avg Claim Amount": dollars("mean"),
            },
        )
    )


REPORTS: dict[str, Callable[[Gold], DataFrame]] = {
    f.__name__: f
    for f in (
        r01_points,
        r02_monthly,
        r03_hourly,
        r04_weekday,
        r05_claims_borough,
        r06_claims_severity,
        r07_claim_status,
        r08_days_histogram,
        r09_severity,
        r10_severity_borough,
        r11_top_factors,
        r12_summary,
    )
}
