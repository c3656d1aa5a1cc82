"""Dense surrogate keys 1..n in the order of a natural key, without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starfold.operators.skew import LIMITS, Limits
from starfold.sources.tables import fits, stage

_ROW_BITS = 33  # monotonically_increasing_id keeps the row index within a partition in these low bits


def dense_key(
    df: DataFrame,
    order: Sequence[str],
    key: str,
    key_type: str = "int",
    *,
    at_most: int | None = None,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Prepend ``key``: the integers ``row_number() OVER (ORDER BY order)`` gives, NULLs first.

    Up to ``limits.one_task_rows`` rows that window is used as it is. ``at_most``
    is a known bound on the number of rows; without one that is low enough, the
    rows are stored and counted. The window sends every row to one task, so more
    rows are range-partitioned and sorted in parallel, each row's (partition,
    index) is stored with it, and the offset of every partition, one row per
    partition, is broadcast. Storing makes the positions final: range bounds are
    sampled, so computing them again could move rows.

    ``order`` has to be unique per row for the keys to be reproducible.
    """
    by = [F.col(c).asc_nulls_first() for c in order]
    numbered = F.row_number().over(Window.orderBy(*by)).cast(key_type).alias(key)
    if at_most is not None and at_most <= limits.one_task_rows:
        return df.select(numbered, *df.columns)
    stored = stage(df, f"rows-{key}")
    if fits(stored, limits.one_task_rows):
        return stored.select(numbered, *df.columns)
    positioned = stage(
        stored.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .select("*", F.monotonically_increasing_id().alias("__pos")),
        f"key-{key}",
    )
    partition = F.shiftright("__pos", _ROW_BITS).alias("__part")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        positioned.groupBy(partition)
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    )
    index = F.col("__pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        positioned.select("*", partition)
        .join(F.broadcast(offsets), "__part")
        .select((F.col("__base") + index + 1).cast(key_type).alias(key), *df.columns)
    )
