"""Left lookup of a dimension's columns, safe against hot and NULL keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.operators.skew import LIMITS, Limits, cast_keys, hot_hashes, key_hash, may_broadcast


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    *,
    null_safe: bool = False,
    hot: Sequence[int] | None = None,
    bound: tuple[DataFrame, Sequence[str]] | None = None,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Add ``take`` (right column -> new name) to every row of ``left``; NULL where nothing matches.

    ``on`` maps left key columns to right ones; the right key is unique, so the
    number of rows never changes. ``null_safe`` lets NULL match NULL. ``hot``
    gives the hot key hashes when known (``hot_hashes``); otherwise ``left`` is
    profiled. ``right`` is a stored table; else ``bound`` names one that has at least as
    many rows, and its columns that ``right`` is made of.

    - A right side of at most ``limits.broadcast_rows`` rows and ``limits.broadcast_bytes``
      bytes is broadcast (``may_broadcast``).
    - A larger one is joined by shuffle, after the hot keys: their right rows,
      no more than the hot keys in number, are broadcast. Rows already answered
      that way, and rows whose NULL key cannot match, get their own input
      partition number as an extra join key. It spreads them over all tasks,
      identical rows too, and matches nothing. One pass over ``left``.
    """
    lkeys, rkeys = list(on), list(on.values())
    names = [f"__k{i}" for i in range(len(rkeys))]
    narrow = right.select(
        *[F.col(r).alias(n) for r, n in zip(rkeys, names)],
        *[F.col(c).alias(f"__v{i}") for i, c in enumerate(take)],
    )
    values = [f"__v{i}" for i in range(len(take))]

    def same(pairs: Sequence[tuple[str, str]]) -> Column:
        tests = [F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b) for a, b in pairs]
        return reduce(lambda x, y: x & y, tests)

    if may_broadcast(*(bound or (right, list(dict.fromkeys([*rkeys, *take])))), limits):
        joined = left.join(F.broadcast(narrow), same(list(zip(lkeys, names))), "left")
        return joined.select(*left.columns, *[F.col(v).alias(n) for v, n in zip(values, take.values())])

    if hot is None:
        hot = hot_hashes(left, {"keys": cast_keys(right, on)}, limits)["keys"]
    left_hash = key_hash(cast_keys(right, on))
    right_hash = key_hash([F.col(n) for n in names])

    apart = F.lit(False)
    if not null_safe:
        apart = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in lkeys])
    if hot:
        apart = apart | left_hash.isin(*hot)
    # 0 for rows to be matched; the right side's zero is written so that it stays a join key
    marked = left.select("*", F.when(apart, F.spark_partition_id() + 1).otherwise(0).alias("__lane"))
    rest = narrow.select("*", F.pmod(right_hash, F.lit(1)).cast("int").alias("__zero"))
    if hot:
        few = narrow.filter(right_hash.isin(*hot)).select(
            *[F.col(c).alias(f"__h{c}") for c in [*names, *values]]
        )
        marked = marked.join(F.broadcast(few), same([(k, f"__h{n}") for k, n in zip(lkeys, names)]), "left")
    joined = marked.join(rest, same(list(zip(lkeys, names))) & (F.col("__lane") == F.col("__zero")), "left")
    answers = [F.coalesce(F.col(f"__h{v}"), F.col(v)) if hot else F.col(v) for v in values]
    return joined.select(*left.columns, *[a.alias(n) for a, n in zip(answers, take.values())])
