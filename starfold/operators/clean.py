"""Raw -> silver: blanks to NULL, dates parsed, unusable rows dropped, row id added."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.functions import blank_to_null
from starfold.rules import BLANKABLE, SILVER_NAMES, Bounds


@dataclass(frozen=True)
class CleanSpec:
    """What to clean. The defaults describe the collision table."""

    date: str = "CRASH DATE"
    date_format: str = "MM/dd/yyyy"
    date_name: str = "crash_date"
    blankable: Sequence[str] = BLANKABLE
    latitude: str = "LATITUDE"
    longitude: str = "LONGITUDE"
    bounds: Bounds = field(default_factory=Bounds)
    casualties: Sequence[str] = ("NUMBER OF PERSONS INJURED", "NUMBER OF PERSONS KILLED")
    id_name: str = "collision_id"
    id_columns: Sequence[str] = ("CRASH DATE", "CRASH TIME", "LATITUDE", "LONGITUDE")
    id_extra: Sequence[str] = ()  # further columns to tell rows apart
    names: Sequence[tuple[str, str]] = SILVER_NAMES


def _parsed_date(spec: CleanSpec) -> Column:
    return F.try_to_date(F.col(spec.date), spec.date_format)


def _keep(spec: CleanSpec) -> Column:
    """Valid coordinates, or somebody hurt. Never NULL."""
    box = spec.bounds
    located = F.col(spec.latitude).between(box.lat_low, box.lat_high) & F.col(spec.longitude).between(
        box.lon_low, box.lon_high
    )
    verdict = F.coalesce(located, F.lit(False))
    for name in spec.casualties:
        verdict = verdict | F.coalesce(F.col(name) > 0, F.lit(False))
    return verdict


def row_id(columns: Sequence[str]) -> Column:
    """SHA-256 of the ``|``-joined values; NULL values are skipped."""
    return F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]), 256)


def clean(df: DataFrame, spec: CleanSpec = CleanSpec()) -> DataFrame:
    """Silver rows of a raw table: one narrow pass, no shuffle."""
    kept = df.withColumn(spec.date_name, _parsed_date(spec)).filter(F.col(spec.date_name).isNotNull() & _keep(spec))
    blank = set(spec.blankable)
    renamed = [(blank_to_null(F.col(src)) if src in blank else F.col(src)).alias(dst) for src, dst in spec.names]
    identity = row_id([*spec.id_columns, *spec.id_extra]).alias(spec.id_name)
    return kept.select(identity, spec.date_name, *renamed)


def reject_counts(df: DataFrame, spec: CleanSpec = CleanSpec()) -> DataFrame:
    """Number of raw rows by outcome of ``clean``: ``kept``, ``bad_date`` or ``no_location_or_casualty``."""
    outcome = (
        F.when(_parsed_date(spec).isNull(), "bad_date")
        .when(~_keep(spec), "no_location_or_casualty")
        .otherwise("kept")
    )
    return df.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))
