"""Silver rows -> fact rows: natural keys replaced by surrogate keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.functions import severity
from starfold.operators.lookup import lookup
from starfold.operators.skew import LIMITS, Limits, cast_keys, hot_hashes, key_hash, may_broadcast
from starfold.rules import COUNTS, FACT_KEYS
from starfold.sources.tables import stored_rows

# dimension, fact key, {silver column: dimension column}; the code lookups come first because
# they turn wide strings into integers before anything has to be shuffled
LOOKUPS = (
    ("dim_vehicle", "primary_vehicle_key", {"vehicle_type_code_1": "vehicle_type_code"}),
    ("dim_vehicle", "secondary_vehicle_key", {"vehicle_type_code_2": "vehicle_type_code"}),
    ("dim_factor", "primary_factor_key", {"contributing_factor_vehicle_1": "contributing_factor"}),
    ("dim_factor", "secondary_factor_key", {"contributing_factor_vehicle_2": "contributing_factor"}),
    ("dim_time", "time_key", {"crash_date": "crash_date", "crash_time_str": "crash_time_str"}),
    (
        "dim_location",
        "location_key",
        {"borough": "borough", "zip_code": "zip_code", "latitude": "latitude", "longitude": "longitude"},
    ),
)


def _needed(dim: DataFrame, on: Mapping[str, str]) -> list[str]:
    return [dim.columns[0], *on.values()]


def natural_hot_keys(
    silver: DataFrame,
    dims: Mapping[str, DataFrame],
    more: Mapping[str, Sequence[str]] | None = None,
    *,
    lookups: Sequence[tuple[str, str, Mapping[str, str]]] = LOOKUPS,
    limits: Limits = LIMITS,
) -> dict[str, list[int]]:
    """Hashes of the hot natural keys of each fact key, and of further key sets (``more``), by one profile of silver."""
    wanted = {fact_key: cast_keys(dims[dim], on) for dim, fact_key, on in lookups}
    wanted |= more or {}
    return hot_hashes(silver, wanted, limits, rows=stored_rows(silver) if wanted else None)


def surrogate_hot_keys(
    hot: Mapping[str, Sequence[int]],
    dims: Mapping[str, DataFrame],
    *,
    lookups: Sequence[tuple[str, str, Mapping[str, str]]] = LOOKUPS,
) -> dict[str, list[int]]:
    """Hashes of the surrogate keys that hot natural keys became: what is hot in the fact, without another profile of it.

    Only the dimensions are read; as many integers come back as there are hot natural keys.
    """
    found: dict[str, list[int]] = {fact_key: [] for _, fact_key, _ in lookups}
    for dim, fact_key, on in lookups:
        if hot.get(fact_key):
            key, natural = dims[dim].columns[0], key_hash([F.col(c) for c in on.values()])
            rows = dims[dim].filter(natural.isin(*hot[fact_key])).select(key_hash([F.col(key)]).alias("h"))
            found[fact_key] = [r["h"] for r in rows.collect()]
    return found


def build_fact(
    silver: DataFrame,
    dims: Mapping[str, DataFrame],
    *,
    null_safe: bool = False,
    lookups: Sequence[tuple[str, str, Mapping[str, str]]] = LOOKUPS,
    identity: str = "collision_id",
    measures: Sequence[str] = COUNTS,
    injured: str = "persons_injured",
    killed: str = "persons_killed",
    hot: Mapping[str, Sequence[int]] | None = None,
    limits: Limits = LIMITS,
) -> DataFrame:
    """One fact row per silver row, from stored silver and dimension tables.

    The surrogate key of a dimension is its first column. ``null_safe=False``
    compares natural keys with ``=``: a NULL part (no zip code, say) leaves the
    key NULL. ``null_safe=True`` finds those rows of the time and location
    dimensions too. ``hot`` gives the hot natural keys of each fact key when they are known
    (``natural_hot_keys``); otherwise silver is profiled if some dimension is large.
    """
    if hot is None:
        large = [role for role in lookups if not may_broadcast(dims[role[0]], _needed(dims[role[0]], role[2]), limits)]
        hot = natural_hot_keys(silver, dims, lookups=large, limits=limits)

    rows = silver
    for i, (dim, fact_key, on) in enumerate(lookups):
        rows = lookup(
            rows, dims[dim], on, {dims[dim].columns[0]: fact_key},
            null_safe=null_safe, hot=hot.get(fact_key, []), limits=limits,
        )
        later = {c for _, _, columns in lookups[i + 1 :] for c in columns}
        rows = rows.drop(*[c for c in on if c not in later])
    keys = [fact_key for _, fact_key, _ in lookups]
    return rows.select(
        identity,
        *[k for k in FACT_KEYS if k in keys],
        *[k for k in keys if k not in FACT_KEYS],
        *measures,
        (F.col(injured) + F.col(killed)).alias("total_persons_affected"),
        severity(F.col(killed), F.col(injured)).alias("severity_category"),
    )
