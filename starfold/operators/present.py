"""The wide, denormalised presentation table with standard column names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold import rules
from starfold.functions import severity
from starfold.operators.lookup import lookup
from starfold.operators.skew import LIMITS, Limits, cast_keys, hot_hashes, may_broadcast
from starfold.sources.tables import stored_rows

# dimension, its key, fact key, renamed columns: a dimension used in two roles appears twice
ROLES = (
    ("dim_vehicle", "vehicle_key", "primary_vehicle_key", rules.PRESENT_VEHICLE_1),
    ("dim_vehicle", "vehicle_key", "secondary_vehicle_key", rules.PRESENT_VEHICLE_2),
    ("dim_factor", "factor_key", "primary_factor_key", rules.PRESENT_FACTOR_1),
    ("dim_factor", "factor_key", "secondary_factor_key", rules.PRESENT_FACTOR_2),
    ("dim_time", "time_key", "time_key", rules.PRESENT_TIME),
    ("dim_location", "location_key", "location_key", rules.PRESENT_LOCATION),
)


def present(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    *,
    roles: Sequence[tuple[str, str, str, Sequence[tuple[str, str]]]] = ROLES,
    ids: Sequence[tuple[str, str]] = rules.PRESENT_IDS,
    measures: Sequence[tuple[str, str]] = rules.PRESENT_MEASURES,
    placeholders: Sequence[str] = rules.PRESENT_PLACEHOLDERS,
    hot: Mapping[str, Sequence[int]] | None = None,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Fact joined with every dimension role: renamed columns, then the fact's keys.

    By default 40 renamed columns and 6 keys. ``ids`` and ``measures`` are fact
    columns; ``placeholders`` are NULL text columns. ``hot`` gives the hot fact keys when they are
    known (``surrogate_hot_keys``); otherwise the fact is profiled if some dimension is large.
    """
    if hot is None:
        wanted = {
            key: cast_keys(dims[dim], {key: dim_key})
            for dim, dim_key, key, columns in roles
            if not may_broadcast(dims[dim], [dim_key, *[source for source, _ in columns]], limits)
        }
        hot = hot_hashes(fact, wanted, limits, rows=stored_rows(fact) if wanted else None)
    rows = fact
    for dim, dim_key, fact_key, columns in roles:
        # prefixed, since the standard names differ from the key names only in case
        take = {source: f"p_{name}" for source, name in columns}
        rows = lookup(rows, dims[dim], {fact_key: dim_key}, take, hot=hot.get(fact_key, []), limits=limits)

    columns = {key: [F.col(f"p_{name}").alias(name) for _, name in named] for _, _, key, named in roles}
    keys = [k for k in rules.FACT_KEYS if k in columns] + [k for k in columns if k not in rules.FACT_KEYS]
    kind = severity(F.col("persons_killed"), F.col("persons_injured"), rules.SEVERITY_UPPER)
    return rows.select(
        *[F.col(source).alias(name) for source, name in ids],
        *[c for key in keys for c in columns[key]],
        *[F.col(source).alias(name) for source, name in measures],
        kind.alias(rules.PRESENT_TYPE),
        *[F.lit(None).cast("string").alias(name) for name in placeholders],
        *keys,
    )
