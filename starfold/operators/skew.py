"""Finding the few keys that hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.sources.tables import stage, stored_rows


@dataclass(frozen=True)
class Limits:
    """Size limits of the physical choices. They change plans, never results.

    broadcast_rows: a dimension of more rows is never broadcast.
    one_task_rows: more rows are never sorted in one task.
    hot_keys: a key is hot when it holds more than 1/hot_keys of all rows, so
        there can be no more than ``hot_keys`` hot keys.
    hot_rows: and at least this many rows, so small inputs have no hot keys.
    broadcast_bytes: nor is one of more bytes, as far as the plan can tell.
    """

    broadcast_rows: int = 500_000
    one_task_rows: int = 1_000_000
    hot_keys: int = 2048
    hot_rows: int = 1_000_000
    broadcast_bytes: int = 256 << 20


LIMITS = Limits()


#: Groups of input partitions whose sketches are merged apart, and items tracked for each hot key allowed.
MERGE_GROUPS, TRACKED = 256, 4


def key_hash(columns: Sequence[Column]) -> Column:
    return F.xxhash64(*columns)


def cast_keys(right: DataFrame, on: Mapping[str, str]) -> list[Column]:
    """The left key columns of a join in the types of the right ones, so that equal keys have equal hashes."""
    types = dict(right.dtypes)
    return [F.col(left).cast(types[name]) for left, name in on.items()]


def small_enough(df: DataFrame, limits: Limits = LIMITS) -> bool:
    """Whether a selection of a stored table may be broadcast, by the plan's size of its columns.

    Stored columns are compressed; a row in memory is taken as four times its share of the files.
    """
    return 4 * int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= limits.broadcast_bytes


def hot_hashes(
    df: DataFrame,
    keys: Mapping[str, Sequence[str | Column]],
    limits: Limits = LIMITS,
    *,
    rows: int | None = None,
    groups: int = MERGE_GROUPS,
) -> dict[str, list[int]]:
    """Hashes of the hot keys of each named key set.

    First a frequent-items sketch (``approx_top_k``) per task; sketches are merged by groups of
    input partitions, so no task receives one from every other. A key over the
    threshold in the whole is over it in one group at least, so the groups'
    lists together hold every hot key. A second scan, made only when they hold any,
    counts these candidates exactly. At most ``hot_keys`` integers per key set come
    to the driver. ``rows``, when known, saves the scan of a table too small to have hot keys.
    """
    if not keys or (rows is not None and rows < limits.hot_rows):
        return {name: [] for name in keys}
    columns = {name: [F.col(c) if isinstance(c, str) else c for c in own] for name, own in keys.items()}
    hashed = df.select(*[key_hash(own).alias(name) for name, own in columns.items()])
    lane = F.pmod(F.spark_partition_id(), F.lit(groups))
    lists = hashed.groupBy(lane.alias("__lane")).agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.expr(f"approx_top_k(`{name}`, {limits.hot_keys}, {limits.hot_keys * TRACKED})").alias(name) for name in keys],
    )
    lists = stage(lists, "hot-keys")  # a row per group
    total = lists.agg(F.sum("__rows")).first()[0] or 0
    least = max(limits.hot_rows, total / limits.hot_keys)
    if total < limits.hot_rows:
        return {name: [] for name in keys}
    listed = F.array(*[F.struct(F.lit(i).alias("__set"), F.col(name).alias("__list")) for i, name in enumerate(keys)])
    items = lists.select("__rows", F.explode(listed).alias("s")).select("__rows", "s.__set", F.explode("s.__list").alias("e"))
    items = items.filter(F.col("e.count") >= F.col("__rows") / limits.hot_keys)
    items = items.select("__set", F.col("e.item").alias("__item")).distinct()
    found = {name: [] for name in keys}
    if items.isEmpty():
        return found
    each = F.array(*[F.struct(F.lit(i).alias("__set"), F.col(name).alias("__item")) for i, name in enumerate(keys)])
    met = hashed.select(F.explode(each).alias("e")).select("e.*").join(F.broadcast(items), ["__set", "__item"])
    counted = met.groupBy("__set", "__item").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    names = list(keys)
    for row in counted.collect():
        found[names[row["__set"]]].append(row["__item"])
    return found


def may_broadcast(table: DataFrame, columns: Sequence[str], limits: Limits = LIMITS) -> bool:
    """The one decision whether a join side is sent to all tasks, by rows and by bytes.

    The side is ``columns`` of a stored table, or has at most a row for each of its rows, made of these columns.
    """
    return stored_rows(table) <= limits.broadcast_rows and small_enough(table.select(*columns), limits)
