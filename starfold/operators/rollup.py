"""Aggregates of a fact table by dimension attributes.

Measures are declared as counts, sums and means, all of which can be computed in
two steps. That lets the fact be aggregated by its key before it is joined to a
large dimension: what is shuffled is then one row per key and task, a key that
holds a third of all rows included, and both join sides have unique keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.operators.claims import money
from starfold.operators.lookup import lookup
from starfold.operators.skew import LIMITS, Limits, hot_hashes, may_broadcast
from starfold.sources.tables import stored_rows


@dataclass(frozen=True)
class Measure:
    """``kind`` is ``count`` (non-null), ``sum`` or ``mean`` of an SQL expression; ``digits`` rounds a mean."""

    name: str
    kind: str
    expr: str
    digits: int | None = None

    def partial(self) -> list[Column]:
        value = F.expr(self.expr)
        if self.kind == "count":
            return [F.count(value).alias(self.name)]
        if self.kind == "sum":
            return [F.sum(value).alias(self.name)]
        return [F.sum(value).alias(f"{self.name}__s"), F.count(value).alias(f"{self.name}__n")]

    def parts(self) -> list[str]:
        return [f"{self.name}__s", f"{self.name}__n"] if self.kind == "mean" else [self.name]

    def finish(self) -> Column:
        if self.kind != "mean":
            return F.col(self.name)
        total, n = self.parts()
        mean = F.col(total).cast("double") / F.nullif(F.col(n), F.lit(0))
        return (mean if self.digits is None else F.round(mean, self.digits)).alias(self.name)


def rollup(df: DataFrame, by: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """``by`` and measures of one table."""
    parts = [p for m in measures for p in m.partial()]
    return df.groupBy(*by).agg(*parts).select(*by, *[m.finish() for m in measures])


def star_rollup(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    by: Sequence[str],
    measures: Sequence[Measure],
    *,
    where: Column | None = None,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Measures of ``fact`` by attributes of an inner-joined dimension, and of the fact itself.

    ``by`` columns the dimension lacks are taken from the fact. ``where``
    filters the dimension. A small dimension is broadcast and the fact
    aggregated once; a large one is joined after aggregating the fact by key.
    ``dim_key`` is unique; ``fact_key`` is not a ``by`` column.
    """
    rows = dim if where is None else dim.filter(where)
    own = [c for c in by if c not in dim.columns]
    narrow = rows.select(F.col(dim_key).alias("__key"), *[c for c in by if c not in own])
    if may_broadcast(dim, [dim_key, *[c for c in by if c not in own]], limits):
        return rollup(fact.join(F.broadcast(narrow), F.col(fact_key) == F.col("__key")), by, measures)
    per_key = (
        fact.filter(F.col(fact_key).isNotNull())
        .groupBy(F.col(fact_key).alias("__fact_key"), *own)
        .agg(*[p for m in measures for p in m.partial()])
    )
    joined = per_key.join(narrow, F.col("__fact_key") == F.col("__key"))
    merged = joined.groupBy(*by).agg(*[F.sum(p).alias(p) for m in measures for p in m.parts()])
    return merged.select(*by, *[m.finish() for m in measures])


def claim_rollup(
    fact: DataFrame,
    claims: DataFrame,
    by: Sequence[str],
    *,
    dim: DataFrame | None = None,
    fact_key: str | None = None,
    dim_key: str | None = None,
    where: Column | None = None,
    keep_unclaimed: bool = False,
    count_ids: bool = False,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Claim counts and amounts by fact or dimension attributes, over all (fact, claim) pairs of one id.

    Ids repeat on both sides, so the pairs of one id can be many. They are never
    formed: claims are reduced to one row per id and looked up like a
    dimension. ``keep_unclaimed`` makes it a left join. ``count_ids`` adds
    ``collision_count``, the distinct ids of a group; the fact is then reduced to
    one row per (id, group) first, which weighs as many pairs as it had rows.

    Columns: ``claim_count``, ``total``, ``mean``, ``lowest``, ``highest``;
    amounts are exact decimals, the mean is a double.
    """
    rows = fact.select("collision_id", *by) if dim is None else None
    if dim is not None:
        chosen = dim if where is None else dim.filter(where)
        taken = {dim_key: "__dim_key", **{c: c for c in by if c in dim.columns}}
        narrow = fact.filter(F.col(fact_key).isNotNull()).select(
            "collision_id", fact_key, *[c for c in by if c not in dim.columns]
        )
        rows = lookup(narrow, chosen, {fact_key: dim_key}, taken, bound=(dim, list(taken)), limits=limits)
        rows = rows.filter(F.col("__dim_key").isNotNull())
    amount = money("claim_amount")
    per_id = claims.groupBy(F.col("collision_id").alias("__id")).agg(
        F.count("claim_id").alias("__n"),
        F.count("claim_amount").alias("__amounts"),
        F.sum(amount).alias("__sum"),
        F.min(amount).alias("__low"),
        F.max(amount).alias("__high"),
    )
    if count_ids:
        weight = F.col("__rows")
        groups = rows.groupBy("collision_id", *by).agg(F.count(F.lit(1)).alias("__rows"))
        kind = "left" if keep_unclaimed else "inner"
        pairs = groups.join(per_id, F.col("collision_id") == F.col("__id"), kind)
    else:
        weight = F.lit(1).cast("bigint")
        bound = claims, ("collision_id", "claim_id", "claim_amount")
        hot = None
        if not may_broadcast(*bound, limits):
            hot = hot_hashes(fact, {"id": ["collision_id"]}, limits, rows=stored_rows(fact))["id"]
        values = {c: c for c in ("__n", "__amounts", "__sum", "__low", "__high")}
        pairs = lookup(
            rows.select("collision_id", *by), per_id, {"collision_id": "__id"}, values,
            hot=hot, bound=bound, limits=limits,
        )
        if not keep_unclaimed:
            pairs = pairs.filter(F.col("__n").isNotNull())
    sums = [
        F.coalesce(F.sum(weight * F.col("__n")), F.lit(0)).alias("claim_count"),
        F.sum(weight * F.col("__sum")).alias("total"),
        F.sum(weight * F.col("__amounts")).alias("__amounts"),
        F.min("__low").alias("lowest"),
        F.max("__high").alias("highest"),
    ]
    ids = [F.count("collision_id").alias("collision_count")] if count_ids else []
    mean = (F.col("total").cast("double") / F.nullif("__amounts", F.lit(0))).alias("mean")
    return (
        pairs.groupBy(*by)
        .agg(*ids, *sums)
        .select(*by, *(["collision_count"] if count_ids else []), "claim_count", "total", mean, "lowest", "highest")
    )


def with_share(grouped: DataFrame, count: str, table: DataFrame, out: str = "percentage", digits: int = 2) -> DataFrame:
    """Add each group's share, in percent, of all rows of ``table``."""
    total = table.agg(F.count(F.lit(1)).alias("n")).scalar()
    share = F.round(F.col(count) * F.lit(100.0) / total, digits)
    return grouped.select("*", share.alias(out))
