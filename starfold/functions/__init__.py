"""Column functions: all built-ins, evaluated inside the JVM."""

from starfold.functions.calendar import calendar_columns, hour_of, time_band
from starfold.functions.draws import draw, draw_int
from starfold.functions.severity import severity
from starfold.functions.text import blank_to_null, classify, joined_name

__all__ = [
    "blank_to_null",
    "calendar_columns",
    "classify",
    "draw",
    "draw_int",
    "hour_of",
    "joined_name",
    "severity",
    "time_band",
]
