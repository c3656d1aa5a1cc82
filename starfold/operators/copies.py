"""Numbering the rows that share an identity."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starfold.operators.keys import dense_key
from starfold.operators.skew import LIMITS, Limits, hot_hashes, key_hash
from starfold.sources.tables import stored_rows


def copy_limits(spark: SparkSession, limits: Limits = LIMITS) -> Limits:
    """Limits by which an identity is hot when a window over it would overfill a task."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return replace(limits, hot_keys=max(limits.hot_keys, partitions // 2))


def number_copies(
    df: DataFrame,
    identity: str,
    order: Sequence[str],
    out: str = "copy_no",
    *,
    hot: Sequence[int] | None = None,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Add ``out`` = 1..n within each ``identity``, in the order of ``order`` (NULLs first).

    Equal to ``row_number() OVER (PARTITION BY identity ORDER BY order)`` up to
    rows equal in all of these columns. ``df`` is a stored table. A window puts
    each group in one task, so hot identities are numbered apart: sorted in
    parallel over all tasks, then counted from the first row of each. Hot is an
    identity with over twice the rows of a mean shuffle partition; ``hot`` gives their hashes when they are known
    (a profile of ``df`` by ``copy_limits``).
    """
    window = Window.partitionBy(identity).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    numbered = F.row_number().over(window).cast("bigint").alias(out)
    if hot is None:
        hot = hot_hashes(df, {"id": [identity]}, copy_limits(df.sparkSession, limits), rows=stored_rows(df))["id"]
    if not hot:
        return df.select("*", numbered)
    is_hot = key_hash([F.col(identity)]).isin(*hot)
    cold = df.filter(~is_hot).select("*", numbered)
    # the physical row position tells apart identical rows and is fixed by the stored order of dense_key
    spread = df.filter(is_hot).select("*", F.monotonically_increasing_id().alias("__tie"))
    ranked = dense_key(spread, [identity, *order, "__tie"], "__rank", "bigint", limits=limits)
    first = ranked.groupBy(F.col(identity).alias("__id")).agg(F.min("__rank").alias("__first"))
    counted = ranked.join(F.broadcast(first), F.col(identity).eqNullSafe(F.col("__id"))).select(
        *df.columns, (F.col("__rank") - F.col("__first") + 1).alias(out)
    )
    return cold.unionByName(counted)
