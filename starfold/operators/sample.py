"""Row samples and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starfold.functions.draws import SPAN, draw_int

_LANES = 64


def smallest(df: DataFrame, order: Sequence[Column], k: int, *, crowded: bool = False) -> DataFrame:
    """The first ``k`` rows by ``order``.

    Spark keeps the best k of every task and brings them to one: fine for a
    top-20. ``crowded`` puts one step between, at most k rows for each of 64
    lanes, for large k over many tasks.
    """
    if crowded:
        lane = F.pmod(F.spark_partition_id(), F.lit(_LANES)).alias("__lane")
        rank = F.row_number().over(Window.partitionBy("__lane").orderBy(*order))
        df = df.select("*", lane).select("*", rank.alias("__rank")).filter(F.col("__rank") <= k).drop("__lane", "__rank")
    return df.orderBy(*order).limit(k)


def hash_sample(
    df: DataFrame, identity: str, k: int, ties: Sequence[str] = (), seed: str = "", rows: int | None = None
) -> DataFrame:
    """A repeatable sample of ``k`` rows (all of them when fewer): those with the smallest hash draw.

    Rows without an identity share the draw of an empty one.

    Draws are uniform, so the rows below a cut of a few times k/n hold the k
    smallest almost surely. The cut is a filter on the identity alone, which
    moves below any join in ``df``. It is checked by a count and widened, in the
    end dropped, when it holds too few, so the result is always that of a full
    sort. ``rows`` is a guess at the size of ``df``, to save counting it.
    """
    n = df.count() if rows is None else rows
    drawn = df.select("*", draw_int(F.coalesce(F.col(identity), F.lit("")), "sample", seed).alias("__draw"))
    chosen, held = drawn, n
    for spare in (2, 16):
        if n <= 2 * spare * k:
            break
        under = drawn.filter(F.col("__draw") < int(spare * k / n * SPAN))
        found = under.count()
        if found >= k:
            chosen, held = under, found
            break
    order = [F.col("__draw"), F.col(identity), *[F.col(c).asc_nulls_first() for c in ties]]
    return smallest(chosen, order, k, crowded=held > 100 * k).drop("__draw")


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Counts of ``value`` in ``bins`` equal intervals from its minimum to its maximum, empty ones included.

    The last interval holds the maximum. NULL, NaN and infinite values are in no
    interval. Two aggregations; only ``bins`` rows are shuffled per task.
    """
    finite = ~F.isnan("v") & (F.abs("v") != float("inf"))
    known = df.select(F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull() & finite)
    ends = known.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if ends["lo"] is None:
        return known.sparkSession.createDataFrame([], "bin int, low double, high double, rows bigint")
    lo, hi = float(ends["lo"]), float(ends["hi"])
    width = (hi - lo) / bins
    if width == 0:
        index: Column = F.lit(1)
    else:
        index = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width)) + 1, F.lit(bins))
    counted = known.groupBy(index.cast("int").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    every = known.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    edge = lambda i: F.lit(lo) + F.lit(width) * i
    return every.join(counted, F.col("bin") == F.col("b"), "left").select(
        "bin",
        edge(F.col("bin") - 1).alias("low"),
        edge(F.col("bin")).alias("high"),
        F.coalesce("n", F.lit(0)).alias("rows"),
    )
