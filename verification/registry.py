"""The registered queries: every operator over the supplied tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.functions import calendar_columns
from starfold.operators import (
    Limits,
    build_code_dim,
    build_location_dim,
    build_time_dim,
    claims_by_severity,
    claims_profile,
    dense_key,
    histogram,
    lookup,
    orphan_keys,
    present,
    reject_counts,
    rollup,
    row_id,
    smallest,
    summarize,
    with_share,
)
from starfold.operators.rollup import Measure
from starfold.plans import CATALOG, REPORTS, Gold, Lake, open_gold, open_table
from starfold.plans.pipeline import Rules
from starfold.sources import current_version, read_csv, schema_rows, scratch_dir, stage, to_pandas, union_all, write_csv
from verification.binding import load, raw_collisions

Query = Callable[[SparkSession, str], DataFrame]

_lakes: dict[tuple[str, str], Lake] = {}


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The layered tables of one input folder: built on first use, once per application."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _lakes:
        root = f"{scratch_dir(spark)}/starfold/lake-{uuid.uuid4().hex}"
        _lakes[at] = Lake(spark, root, lambda: raw_collisions(spark, sf_dir))
    return _lakes[at]


def _table(name: str) -> Query:
    return lambda spark, sf_dir: lake(spark, sf_dir).table(name)


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows written as CSV and read back by header name."""
    path = f"{scratch_dir(spark)}/starfold/csv-{uuid.uuid4().hex}"
    write_csv(raw_collisions(spark, sf_dir), path)
    return read_csv(spark, path)


def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_counts(lake(spark, sf_dir).table("bronze"))


def silver_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row ids of all raw rows, with the number of rows sharing each."""
    ids = lake(spark, sf_dir).table("bronze").select(
        row_id(["CRASH DATE", "CRASH TIME", "LATITUDE", "LONGITUDE"]).alias("collision_id")
    )
    return ids.groupBy("collision_id").agg(F.count(F.lit(1)).alias("rows"))


def dim_key_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense key over the distinct (part, supplier) pairs of all line items, by the plan for many rows."""
    pairs = load(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    return dense_key(pairs, ["l_partkey", "l_suppkey"], "pair_key", limits=Limits(one_task_rows=0))


def fact_collisions_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake(spark, sf_dir).fact(null_safe=True)


def present_view_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The presentation table of the fact whose NULL key parts find their dimension rows."""
    return present(stage(fact_collisions_nullsafe(spark, sf_dir), "nullsafe"), lake(spark, sf_dir).dims())


def fact_collisions_large_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact by the plan for dimensions too large to broadcast; hot keys are kept with silver."""
    return lake(spark, sf_dir).fact(limits=Limits(broadcast_rows=0, hot_keys=64, hot_rows=10))


def dim_location_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The location dimension by the plan for more rows than one task may sort."""
    return build_location_dim(lake(spark, sf_dir).table("silver"), limits=Limits(one_task_rows=0))


def claims_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = lake(spark, sf_dir).gold()
    return claims_profile(gold.claims(), gold.fact_collisions)


def claims_by_severity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims_by_severity(lake(spark, sf_dir).table("fact_claims"))


def k_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake(spark, sf_dir).checks()


def k_checks_without_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake(spark, sf_dir).checks(claims=False)


def k_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize(lake(spark, sf_dir).checks())


def _catalog(name: str) -> Query:
    return lambda spark, sf_dir: CATALOG[name](lake(spark, sf_dir).on_demand())


def _report(name: str) -> Query:
    return lambda spark, sf_dir: REPORTS[name](lake(spark, sf_dir).on_demand())


# --- stored lakes, views, inspection ----------------------------------------------


def _root(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/starfold/lake-{uuid.uuid4().hex}"


def lake_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake over CSV files as its readers see it: built, a rebuild that fails half-way, new files taken up, nothing new.

    ``rebuilt`` counts the tables that the published version has from another build than before.
    """
    root, raw = _root(spark), raw_collisions(spark, sf_dir)
    timed = F.col("CRASH TIME").isNotNull()
    broken = Rules(factors=(("(", "no regular expression"),))
    write_csv(raw.filter(timed), f"{root}/landing/first")
    seen, rows = {}, []
    for step, rules in (("1 built", Rules()), ("2 broken off", broken), ("3 resumed", Rules()), ("4 unchanged", Rules())):
        if rules is broken:
            write_csv(raw.filter(~timed), f"{root}/landing/second")
        try:
            Lake.from_csv(spark, f"{root}/tables", f"{root}/landing/*", resume=True, rules=rules).gold()
        except (PySparkException, Py4JError):
            if rules is not broken:
                raise
        tables = current_version(spark, f"{root}/tables")["tables"]
        gold = open_gold(spark, f"{root}/tables")
        builds = {name: table["id"] for name, table in tables.items()}
        changed = sum(seen.get(name) != key for name, key in builds.items())
        rows.append((step, open_table(spark, f"{root}/tables", "silver").count(), gold.fact_collisions.count(), changed))
        seen = builds
    return spark.createDataFrame(rows, "step string, silver_rows long, fact_rows long, rebuilt long")


def _relations(gold: Gold) -> DataFrame:
    """Registered relation names and their rows, counted by SQL."""
    spark = gold.fact_collisions.sparkSession
    return union_all(spark.sql(f"SELECT '{name}' AS relation, count(*) AS rows FROM {name}") for name in gold.register())


def gold_without_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations of a stored star schema whose claims were never built."""
    root = _root(spark)
    Lake(spark, root, lambda: raw_collisions(spark, sf_dir)).gold(claims=False)
    return _relations(open_gold(spark, root))


def gold_stale_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations of a stored star schema whose claims were made from another build of the fact."""
    root = _root(spark)
    Lake(spark, root, lambda: raw_collisions(spark, sf_dir)).gold()
    Lake(spark, root, lambda: raw_collisions(spark, sf_dir), resume=True, null_safe=True).gold(claims=False)
    return _relations(open_gold(spark, root))


GOLD_SQL = """SELECT d.is_weekend, f.severity_category, count(*) AS collisions, count(DISTINCT f.location_key) AS places,
  CAST(sum(c.claims) AS BIGINT) AS claims, CAST(sum(c.amount) AS DOUBLE) AS amount
FROM fact_collisions f JOIN dim_time d ON f.time_key = d.time_key
  LEFT JOIN (SELECT collision_id, count(*) AS claims, sum(CAST(claim_amount AS DECIMAL(18,2))) AS amount
    FROM fact_claims GROUP BY collision_id) c ON f.collision_id = c.collision_id
GROUP BY d.is_weekend, f.severity_category"""


def gold_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over the registered views."""
    lake(spark, sf_dir).gold().register()
    return spark.sql(GOLD_SQL)


INSPECTED = ("orders", "lineitem", "events", "documents", "labels")


def table_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the stored tables as rows."""
    return union_all(
        schema_rows(load(spark, sf_dir, name)).select(F.lit(name).alias("table"), "position", "name", "type", "nullable")
        for name in INSPECTED
    )


def bounded_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 orders by date, collected; a date shared across the cut is ordered by the other columns."""
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    return spark.createDataFrame(to_pandas(orders, 100, ["o_orderdate"]), orders.schema)


# --- the operators on other tables ----------------------------------------------


def tpch_star_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customer, nation and region looked up by key."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    with_customer = lookup(
        orders,
        load(spark, sf_dir, "customer"),
        {"o_custkey": "c_custkey"},
        {"c_mktsegment": "segment", "c_nationkey": "nationkey"},
    )
    with_nation = lookup(
        with_customer,
        load(spark, sf_dir, "nation"),
        {"nationkey": "n_nationkey"},
        {"n_name": "nation", "n_regionkey": "regionkey"},
    )
    return lookup(
        with_nation, load(spark, sf_dir, "region"), {"regionkey": "r_regionkey"}, {"r_name": "region"}
    ).drop("nationkey", "regionkey")


PART_RULES = (("(?i)brass|copper|tin|nickel|steel", "Metal"), ("(?i)^brand", "Brand"))


def tpch_code_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes folded from two part columns, classified in rule order."""
    part = load(spark, sf_dir, "part")
    return build_code_dim(part, ("p_type", "p_brand"), "code", "code_class", "code_key", PART_RULES, "Other")


def events_calendar_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar dimension over the minutes in which events happened."""
    moments = load(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("event_date"), F.date_format("ts", "H:mm").alias("event_clock")
    )
    return build_time_dim(moments, "event_date", "event_clock", "moment_key")


def events_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar functions used without a dimension: event counts and values by weekday and band."""
    events = load(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("d"), F.date_format("ts", "H:mm").alias("t"), F.col("value")
    )
    columns = calendar_columns("d", "t")
    banded = events.select(columns["day_name"].alias("day_name"), columns["time_category"].alias("time_category"), "value")
    return rollup(banded, ("day_name", "time_category"), (Measure("events", "count", "1"),))


def fk_orphans_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part keys of line items that no part of size 25 or less has."""
    parts = load(spark, sf_dir, "part").filter(F.col("p_size") <= 25)
    return orphan_keys(load(spark, sf_dir, "lineitem"), parts, "l_partkey", "p_partkey")


def orders_share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    rows = rollup(orders, ("o_orderpriority",), (Measure("order_count", "count", "o_orderkey"),))
    return with_share(rows, "order_count", orders)


def events_value_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(load(spark, sf_dir, "events"), "value", 30).select("bin", "rows")


def topk_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 parts of highest price; equal prices in key order."""
    part = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    return smallest(part, [F.desc("p_retailprice"), F.asc("p_partkey")], 20)


QUERIES: dict[str, Query] = {
    "bronze_roundtrip": bronze_roundtrip,
    "silver_clean": _table("silver"),
    "silver_rejects": silver_rejects,
    "silver_id": silver_id,
    "dim_time": _table("dim_time"),
    "dim_location": _table("dim_location"),
    "dim_vehicle": _table("dim_vehicle"),
    "dim_factor": _table("dim_factor"),
    "dim_key_scale": dim_key_scale,
    "fact_collisions": _table("fact_collisions"),
    "fact_collisions_nullsafe": fact_collisions_nullsafe,
    "fact_collisions_large_dims": fact_collisions_large_dims,
    "dim_location_large": dim_location_large,
    "present_view": _table("presentation"),
    "present_view_nullsafe": present_view_nullsafe,
    "claims": _table("fact_claims"),
    "claims_profile": claims_profile_query,
    "claims_by_severity": claims_by_severity_query,
    **{name: _catalog(name) for name in CATALOG},
    "k_checks": k_checks,
    "k_checks_without_claims": k_checks_without_claims,
    "k_summary": k_summary,
    **{name: _report(name) for name in REPORTS},
    "lake_versions": lake_versions,
    "gold_without_claims": gold_without_claims,
    "gold_stale_claims": gold_stale_claims,
    "gold_sql": gold_sql,
    "table_schemas": table_schemas,
    "bounded_collect": bounded_collect,
    "tpch_star_fact": tpch_star_fact,
    "tpch_code_dim": tpch_code_dim,
    "events_calendar_dim": events_calendar_dim,
    "events_by_band": events_by_band,
    "fk_orphans_lineitem": fk_orphans_lineitem,
    "orders_share_of_total": orders_share_of_total,
    "events_value_histogram": events_value_histogram,
    "topk_parts": topk_parts,
}
