"""Calendar attributes of a date and of a clock string such as ``"9:05"``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starfold.rules import LAST_BAND, TIME_BANDS, WEEKEND_DAYS


def hour_of(clock: Column) -> Column:
    """Hour before the first colon; NULL when there is none or it is no integer."""
    return F.regexp_extract(clock, r"^(\d+):", 1).try_cast("int")


def time_band(hour: Column, bands: Sequence[tuple[int, int, str]] = TIME_BANDS, last: str = LAST_BAND) -> Column:
    """Label of the band holding ``hour``; NULL and out-of-band hours get ``last``."""
    first, *rest = bands
    chain = F.when(hour.between(first[0], first[1]), first[2])
    for low, high, label in rest:
        chain = chain.when(hour.between(low, high), label)
    return chain.otherwise(last)


def calendar_columns(
    date: str, clock: str | None = None, bands: Sequence[tuple[int, int, str]] = TIME_BANDS, last: str = LAST_BAND
) -> dict[str, Column]:
    """Name -> column for the calendar attributes, in table order."""
    d = F.col(date)
    columns = {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_week": F.dayofweek(d),
        "day_name": F.date_format(d, "EEEE"),
        "month_name": F.date_format(d, "MMMM"),
        "quarter": F.quarter(d),
    }
    if clock is not None:
        hour = hour_of(F.col(clock))
        columns["hour"] = hour
        columns["time_category"] = time_band(hour, bands, last)
    weekend = F.dayofweek(d).isin(*WEEKEND_DAYS)
    columns["is_weekend"] = F.coalesce(weekend, F.lit(False))
    return columns
