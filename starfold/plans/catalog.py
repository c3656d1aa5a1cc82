"""The named queries over a star schema.

``CATALOG`` maps a name to a function of ``Gold``. Each returns a DataFrame with
a total order: ties of the ranking column are broken by the group columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, fields

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.operators.claims import MONEY, money
from starfold.operators.rollup import Measure, claim_rollup, rollup, star_rollup, with_share
from starfold.operators.skew import LIMITS, Limits
from starfold.rules import SEVERITY
from starfold.sources.tables import register_views


@dataclass(frozen=True)
class Gold:
    """The stored tables the queries read."""

    fact_collisions: DataFrame
    dim_time: DataFrame
    dim_location: DataFrame
    dim_vehicle: DataFrame
    dim_factor: DataFrame
    fact_claims: DataFrame | None = None
    limits: Limits = LIMITS

    def tables(self) -> dict[str, DataFrame | None]:
        return {f.name: getattr(self, f.name) for f in fields(self) if f.name != "limits"}

    def register(self) -> list[str]:
        """Make the tables available to ``spark.sql`` under their names."""
        return register_views(self.tables())

    def claims(self) -> DataFrame:
        if self.fact_claims is None:
            raise LookupError("fact_claims has not been built")
        return self.fact_claims


COUNT = Measure("collision_count", "count", "collision_id")
INJURED = Measure("total_injured", "sum", "persons_injured")
KILLED = Measure("total_killed", "sum", "persons_killed")
CASUALTIES = (COUNT, INJURED, KILLED)
AMOUNT = f"CAST(claim_amount AS {MONEY})"
_CLAIM_MEASURES = (
    Measure("claim_count", "count", "claim_id"),
    Measure("avg_claim_amount", "mean", AMOUNT, 2),
    Measure("total_claim_amount", "sum", AMOUNT),
)


def mean_affected(name: str, digits: int | None = 2) -> Measure:
    """Mean of injured + killed; rows where either is unknown do not count."""
    return Measure(name, "mean", "persons_injured + persons_killed", digits)


def _ranked(df: DataFrame, by: str, ties: Iterable[str], k: int | None = None) -> DataFrame:
    ordered = df.orderBy(F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in ties])
    return ordered if k is None else ordered.limit(k)


def by_location(g: Gold, by, measures, where: Column | None = None) -> DataFrame:
    return star_rollup(
        g.fact_collisions, g.dim_location, "location_key", "location_key", by, measures, where=where, limits=g.limits
    )


def by_time(g: Gold, by, measures, where: Column | None = None) -> DataFrame:
    return star_rollup(g.fact_collisions, g.dim_time, "time_key", "time_key", by, measures, where=where, limits=g.limits)


def by_factor(g: Gold, by, measures) -> DataFrame:
    return star_rollup(
        g.fact_collisions, g.dim_factor, "primary_factor_key", "factor_key", by, measures, limits=g.limits
    )


def by_vehicle(g: Gold, by, measures) -> DataFrame:
    return star_rollup(
        g.fact_collisions, g.dim_vehicle, "primary_vehicle_key", "vehicle_key", by, measures, limits=g.limits
    )


def claims_by_area(g: Gold, by, **options) -> DataFrame:
    return claim_rollup(
        g.fact_collisions, g.claims(), by, dim=g.dim_location, fact_key="location_key", dim_key="location_key",
        where=F.col("borough").isNotNull(), limits=g.limits, **options,
    )


def _cents(col: str, name: str) -> Column:
    return F.round(F.col(col).cast("double"), 2).alias(name)


def q01_hotspots_location(g: Gold) -> DataFrame:
    area = ("borough", "zip_code", "location_name")
    rows = by_location(g, area, (*CASUALTIES, mean_affected("avg_persons_affected", None)))
    return _ranked(rows, "collision_count", area, 20)


def q02_hotspots_borough(g: Gold) -> DataFrame:
    measures = (*CASUALTIES, mean_affected("avg_persons_affected"))
    return _ranked(by_location(g, ("borough",), measures, F.col("borough").isNotNull()), "collision_count", ("borough",))


def q03_worst_hours(g: Gold) -> DataFrame:
    by = ("hour", "time_category")
    rows = by_time(g, by, (*CASUALTIES, mean_affected("avg_severity")), F.col("hour").isNotNull())
    return _ranked(rows, "collision_count", by)


def q04_worst_day_hours(g: Gold) -> DataFrame:
    by = ("day_name", "hour")
    known = F.col("hour").isNotNull() & F.col("day_name").isNotNull()
    return _ranked(by_time(g, by, CASUALTIES, known), "collision_count", by, 20)


def q05_monthly_trend(g: Gold) -> DataFrame:
    rows = by_time(g, ("year", "month", "month_name"), (*CASUALTIES, mean_affected("avg_severity")))
    return rows.orderBy(F.desc("year"), F.desc("month"))


def q06_yearly_totals(g: Gold) -> DataFrame:
    return by_time(g, ("year",), (*CASUALTIES, mean_affected("avg_severity"))).orderBy(F.desc("year"))


def q07_claims_borough(g: Gold) -> DataFrame:
    rows = claims_by_area(g, ("borough",), keep_unclaimed=True, count_ids=True).select(
        "borough",
        "collision_count",
        "claim_count",
        _cents("mean", "avg_claim_amount"),
        _cents("total", "total_claim_amount"),
        _cents("lowest", "min_claim_amount"),
        _cents("highest", "max_claim_amount"),
    )
    return _ranked(rows, "total_claim_amount", ("borough",))


def q08_claims_borough_severity(g: Gold) -> DataFrame:
    rows = claims_by_area(g, ("borough", "severity_category")).select(
        "borough",
        "severity_category",
        "claim_count",
        _cents("mean", "avg_claim_amount"),
        _cents("total", "total_claim_amount"),
    )
    return rows.orderBy("borough", F.col("total_claim_amount").desc(), "severity_category")


def q09_top_factors(g: Gold) -> DataFrame:
    by = ("contributing_factor", "factor_category")
    return _ranked(by_factor(g, by, (*CASUALTIES, mean_affected("avg_severity"))), "collision_count", by, 20)


def q10_factor_categories(g: Gold) -> DataFrame:
    by = ("factor_category",)
    return _ranked(by_factor(g, by, (*CASUALTIES, mean_affected("avg_severity"))), "collision_count", by)


def q11_vehicle_types(g: Gold) -> DataFrame:
    by = ("vehicle_type_name",)
    return _ranked(by_vehicle(g, by, (*CASUALTIES, mean_affected("avg_severity"))), "collision_count", by)


def q12_vehicle_claims(g: Gold) -> DataFrame:
    by = ("vehicle_type_name",)
    rows = claim_rollup(
        g.fact_collisions, g.claims(), by, dim=g.dim_vehicle, fact_key="primary_vehicle_key", dim_key="vehicle_key",
        keep_unclaimed=True, count_ids=True, limits=g.limits,
    ).select(
        "vehicle_type_name",
        "collision_count",
        "claim_count",
        _cents("mean", "avg_claim_amount"),
        _cents("total", "total_claim_amount"),
    )
    return _ranked(rows, "total_claim_amount", by)


def q13_severity_share(g: Gold) -> DataFrame:
    rows = rollup(g.fact_collisions, ("severity_category",), CASUALTIES)
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITY]), F.col("severity_category"))
    return with_share(rows, "collision_count", g.fact_collisions).orderBy(rank, "severity_category")


def q14_severity_by_band(g: Gold) -> DataFrame:
    rows = by_time(g, ("time_category", "severity_category"), (COUNT,))
    return rows.orderBy("time_category", F.desc("collision_count"), "severity_category")


def q15_claim_status_share(g: Gold) -> DataFrame:
    claims = g.claims()
    rows = rollup(claims, ("claim_status",), _CLAIM_MEASURES)
    return with_share(rows.select(*_status_columns()), "claim_count", claims)


def _status_columns() -> list[Column | str]:
    return ["claim_status", "claim_count", "avg_claim_amount", _cents("total_claim_amount", "total_claim_amount")]


def q16_days_to_close(g: Gold) -> DataFrame:
    days = F.col("days_to_close")
    exact = Measure("avg", "mean", "CAST(days_to_close AS DECIMAL(18,6))", 2)
    return (
        g.claims()
        .filter(F.col("claim_status") == "CLOSED")
        .groupBy("claim_status")
        .agg(
            F.count("claim_id").alias("claim_count"),
            *exact.partial(),
            F.min(days).alias("min_days"),
            F.max(days).alias("max_days"),
        )
        .select("claim_status", "claim_count", exact.finish().alias("avg_days_to_close"), "min_days", "max_days")
    )


def q17_claims_severity(g: Gold) -> DataFrame:
    rows = claim_rollup(g.fact_collisions, g.claims(), ("severity_category",), limits=g.limits).select(
        "severity_category",
        "claim_count",
        _cents("mean", "avg_claim_amount"),
        _cents("lowest", "min_claim_amount"),
        _cents("highest", "max_claim_amount"),
        _cents("total", "total_claim_amount"),
    )
    return _ranked(rows, "avg_claim_amount", ("severity_category",))


def q18_weekend(g: Gold) -> DataFrame:
    return by_time(g, ("is_weekend",), (*CASUALTIES, mean_affected("avg_severity"))).orderBy("is_weekend")


def q19_summary(g: Gold) -> DataFrame:
    """Six metrics as text, from one aggregate over each of the two facts."""
    facts = g.fact_collisions.agg(
        F.count_distinct("collision_id").alias("n"),
        F.sum("persons_injured").alias("injured"),
        F.sum("persons_killed").alias("killed"),
    )
    amount = money("claim_amount")
    claims = g.claims().agg(
        F.count_distinct("claim_id").alias("n"),
        F.sum(amount).alias("total"),
        F.count(amount).alias("amounts"),
    )
    mean = F.round(F.col("total").cast("double") / F.nullif("amounts", F.lit(0)), 2).cast("decimal(18,2)")
    return metric_rows(
        facts,
        {"Total Collisions": F.col("n"), "Total Injuries": F.col("injured"), "Total Fatalities": F.col("killed")},
    ).unionByName(
        metric_rows(claims, {"Total Claims": F.col("n"), "Total Claim Amount": F.col("total"), "Avg Claim Amount": mean})
    )


def metric_rows(one_row: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """Turn columns of a single row into (metric, value) rows of text."""
    pairs = [F.struct(F.lit(name).alias("metric"), c.cast("string").alias("value")) for name, c in metrics.items()]
    return one_row.select(F.inline(F.array(*pairs)))


CATALOG: dict[str, Callable[[Gold], DataFrame]] = {
    f.__name__: f
    for f in (
        q01_hotspots_location,
        q02_hotspots_borough,
        q03_worst_hours,
        q04_worst_day_hours,
        q05_monthly_trend,
        q06_yearly_totals,
        q07_claims_borough,
        q08_claims_borough_severity,
        q09_top_factors,
        q10_factor_categories,
        q11_vehicle_types,
        q12_vehicle_claims,
        q13_severity_share,
        q14_severity_by_band,
        q15_claim_status_share,
        q16_days_to_close,
        q17_claims_severity,
        q18_weekend,
        q19_summary,
    )
}


def run_catalog(
    gold: Gold,
    show: Callable[[str, DataFrame], None],
    catalog: Mapping[str, Callable[[Gold], DataFrame]] = CATALOG,
) -> dict[str, str]:
    """Hand every query's result to ``show``; a failing query does not stop the rest. Returns name -> error."""
    failed = {}
    for name, query in catalog.items():
        try:
            show(name, query(gold))
        except (PySparkException, LookupError) as error:
            failed[name] = str(error)
    return failed
