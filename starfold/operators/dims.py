"""Dimension tables: distinct natural keys, derived attributes, dense surrogate key.

Each distinct runs as a partial aggregation before its shuffle, so a natural key
repeated in a third of all rows costs one row per task. The input is a stored
table, or columns of one: its row count bounds the size of the dimension.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.functions import calendar_columns, classify, joined_name
from starfold.operators.keys import dense_key
from starfold.operators.skew import LIMITS, Limits
from starfold.rules import FACTOR_DEFAULT, FACTOR_RULES, LAST_BAND, TIME_BANDS, UNKNOWN_LOCATION, VEHICLE_RULES
from starfold.sources.tables import stored_rows


def build_time_dim(
    df: DataFrame,
    date: str = "crash_date",
    clock: str = "crash_time_str",
    key: str = "time_key",
    *,
    bands: Sequence[tuple[int, int, str]] = TIME_BANDS,
    last_band: str = LAST_BAND,
    key_type: str = "int",
    limits: Limits = LIMITS,
) -> DataFrame:
    """One row per (date, clock string), with calendar attributes."""
    moments = df.select(date, clock).distinct()
    attributes = [c.alias(name) for name, c in calendar_columns(date, clock, bands, last_band).items()]
    keyed = dense_key(moments, [date, clock], key, key_type, at_most=stored_rows(df), limits=limits)
    return keyed.select(key, date, clock, *attributes)


def build_location_dim(
    df: DataFrame,
    area: Sequence[str] = ("borough", "zip_code"),
    latitude: str = "latitude",
    longitude: str = "longitude",
    key: str = "location_key",
    unknown: str = UNKNOWN_LOCATION,
    *,
    key_type: str = "int",
    limits: Limits = LIMITS,
) -> DataFrame:
    """One row per (area columns, coordinates) with both coordinates known, and a display name."""
    natural = [*area, latitude, longitude]
    places = df.select(*natural).filter(F.col(latitude).isNotNull() & F.col(longitude).isNotNull()).distinct()
    named = joined_name(area, unknown).alias("location_name")
    keyed = dense_key(places, natural, key, key_type, at_most=stored_rows(df), limits=limits)
    return keyed.select(key, *natural, named)


def build_code_dim(
    df: DataFrame,
    roles: Sequence[str],
    code: str,
    label: str,
    key: str,
    rules: Sequence[tuple[str, str]],
    default: Column | str | None = None,
    *,
    key_type: str = "int",
    limits: Limits = LIMITS,
) -> DataFrame:
    """One row per code found in any of the role columns, with its class. The roles are read in one pass."""
    codes = df.select(F.explode(F.array(*roles)).alias(code)).filter(F.col(code).isNotNull()).distinct()
    classed = classify(F.col(code), rules, default).alias(label)
    keyed = dense_key(codes, [code], key, key_type, at_most=len(roles) * stored_rows(df), limits=limits)
    return keyed.select(key, code, classed)


def build_vehicle_dim(
    df: DataFrame,
    rules: Sequence[tuple[str, str]] = VEHICLE_RULES,
    *,
    key_type: str = "int",
    limits: Limits = LIMITS,
) -> DataFrame:
    return build_code_dim(
        df,
        ("vehicle_type_code_1", "vehicle_type_code_2"),
        "vehicle_type_code",
        "vehicle_type_name",
        "vehicle_key",
        rules,
        key_type=key_type,
        limits=limits,
    )


def build_factor_dim(
    df: DataFrame,
    rules: Sequence[tuple[str, str]] = FACTOR_RULES,
    default: str = FACTOR_DEFAULT,
    *,
    key_type: str = "int",
    limits: Limits = LIMITS,
) -> DataFrame:
    return build_code_dim(
        df,
        ("contributing_factor_vehicle_1", "contributing_factor_vehicle_2"),
        "contributing_factor",
        "factor_category",
        "factor_key",
        rules,
        default,
        key_type=key_type,
        limits=limits,
    )
