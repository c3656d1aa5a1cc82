"""Collision-domain defaults, as plain data.

Every operator takes its rules as arguments, so any table can be modelled; the
values below are the defaults.

Fixed values: the names, bounds, patterns, band edges and rates in this module
have to be exactly these for results to be right.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- raw layer: header name -> type -----------------------------------------
RAW_FIELDS = (
    ("CRASH DATE", "string"),
    ("CRASH TIME", "string"),
    ("BOROUGH", "string"),
    ("ZIP CODE", "string"),
    ("LATITUDE", "double"),
    ("LONGITUDE", "double"),
    ("LOCATION", "string"),
    ("NUMBER OF PERSONS INJURED", "int"),
    ("NUMBER OF PERSONS KILLED", "int"),
    ("NUMBER OF PEDESTRIANS INJURED", "int"),
    ("NUMBER OF PEDESTRIANS KILLED", "int"),
    ("NUMBER OF CYCLIST INJURED", "int"),
    ("NUMBER OF CYCLIST KILLED", "int"),
    ("NUMBER OF MOTORIST INJURED", "int"),
    ("NUMBER OF MOTORIST KILLED", "int"),
    ("CONTRIBUTING FACTOR VEHICLE 1", "string"),
    ("CONTRIBUTING FACTOR VEHICLE 2", "string"),
    ("VEHICLE TYPE CODE 1", "string"),
    ("VEHICLE TYPE CODE 2", "string"),
)

# --- silver layer: header name -> snake-case name ----------------------------
SILVER_NAMES = (
    ("CRASH TIME", "crash_time_str"),
    ("BOROUGH", "borough"),
    ("ZIP CODE", "zip_code"),
    ("LATITUDE", "latitude"),
    ("LONGITUDE", "longitude"),
    ("NUMBER OF PERSONS INJURED", "persons_injured"),
    ("NUMBER OF PERSONS KILLED", "persons_killed"),
    ("NUMBER OF PEDESTRIANS INJURED", "pedestrians_injured"),
    ("NUMBER OF PEDESTRIANS KILLED", "pedestrians_killed"),
    ("NUMBER OF CYCLIST INJURED", "cyclist_injured"),
    ("NUMBER OF CYCLIST KILLED", "cyclist_killed"),
    ("NUMBER OF MOTORIST INJURED", "motorist_injured"),
    ("NUMBER OF MOTORIST KILLED", "motorist_killed"),
    ("CONTRIBUTING FACTOR VEHICLE 1", "contributing_factor_vehicle_1"),
    ("CONTRIBUTING FACTOR VEHICLE 2", "contributing_factor_vehicle_2"),
    ("VEHICLE TYPE CODE 1", "vehicle_type_code_1"),
    ("VEHICLE TYPE CODE 2", "vehicle_type_code_2"),
)
BLANKABLE = (
    "BOROUGH",
    "ZIP CODE",
    "CONTRIBUTING FACTOR VEHICLE 1",
    "CONTRIBUTING FACTOR VEHICLE 2",
    "VEHICLE TYPE CODE 1",
    "VEHICLE TYPE CODE 2",
)
COUNTS = (
    "persons_injured",
    "persons_killed",
    "pedestrians_injured",
    "pedestrians_killed",
    "cyclist_injured",
    "cyclist_killed",
    "motorist_injured",
    "motorist_killed",
)

# --- time bands: first hour, last hour, label; anything else -> LAST_BAND -----
TIME_BANDS = (
    (0, 5, "00:00-05:59"),
    (6, 8, "06:00-08:59"),
    (9, 11, "09:00-11:59"),
    (12, 14, "12:00-14:59"),
    (15, 17, "15:00-17:59"),
    (18, 20, "18:00-20:59"),
)
LAST_BAND = "21:00-23:59"
WEEKEND_DAYS = (1, 7)  # 1 = Sunday

# --- ordered classification rules, first match wins --------------------------
VEHICLE_RULES = (
    ("(?i)sedan", "Sedan"),
    ("(?i)truck", "Truck"),
    ("(?i)bus", "Bus"),
    ("(?i)motorcycle|moped", "Motorcycle/Moped"),
    ("(?i)bicycle|bike", "Bicycle"),
    ("(?i)van", "Van"),
    ("(?i)taxi", "Taxi"),
)
FACTOR_RULES = (
    ("(?i)unspecified", "Unspecified"),
    ("(?i)driver|following|speed|aggressive", "Driver Behavior"),
    ("(?i)pavement|road|weather", "Road/Weather"),
    ("(?i)vehicle|brake|tire", "Vehicle Issue"),
    ("(?i)pedestrian|bicyclist", "Pedestrian/Cyclist"),
)
FACTOR_DEFAULT = "Other"
UNKNOWN_LOCATION = "Unknown"

# --- severity labels: fatal, injury, else -------------------------------------
SEVERITY = ("Fatal", "Injury", "Property Damage Only")
SEVERITY_UPPER = ("FATAL", "INJURY", "PROPERTY_DAMAGE_ONLY")

# --- presentation table: source column -> standard name ------------------------
PRESENT_IDS = (
    ("collision_id", "ACCIDENT_NUMBER"),
    ("collision_id", "COLLISION_ID"),
)
PRESENT_TIME = (
    ("crash_date", "ACCIDENT_DATE"),
    ("year", "YEAR"),
    ("month", "MONTH"),
    ("month_name", "MONTH_NAME"),
    ("day", "DAY"),
    ("day_of_week", "ACC_DAY_OF_WEEK"),
    ("day_name", "DAY_OF_WEEK_NAME"),
    ("quarter", "QUARTER"),
    ("hour", "ACCIDENT_TIME"),
    ("time_category", "TIME_CATEGORY"),
    ("is_weekend", "IS_WEEKEND"),
)
PRESENT_LOCATION = (
    ("borough", "BOROUGH"),
    ("zip_code", "ZIP_CODE"),
    ("latitude", "LATITUDE"),
    ("longitude", "LONGITUDE"),
    ("location_name", "ACCIDENT_LOCATION"),
)
PRESENT_VEHICLE_1 = (
    ("vehicle_type_code", "VEHICLE_TYPE_CODE_1"),
    ("vehicle_type_name", "VEHICLE_TYPE_NAME_1"),
)
PRESENT_VEHICLE_2 = (
    ("vehicle_type_code", "VEHICLE_TYPE_CODE_2"),
    ("vehicle_type_name", "VEHICLE_TYPE_NAME_2"),
)
PRESENT_FACTOR_1 = (
    ("contributing_factor", "CONTRIBUTING_FACTOR_1"),
    ("factor_category", "FACTOR_CATEGORY_1"),
)
PRESENT_FACTOR_2 = (
    ("contributing_factor", "CONTRIBUTING_FACTOR_2"),
    ("factor_category", "FACTOR_CATEGORY_2"),
)
PRESENT_MEASURES = (
    ("persons_injured", "PERSON_INJURY_CNT"),
    ("persons_killed", "PERSON_FATALITY_CNT"),
    ("pedestrians_injured", "PEDESTRIAN_INJURY_CNT"),
    ("pedestrians_killed", "PEDESTRIAN_FATALITY_CNT"),
    ("cyclist_injured", "CYCLIST_INJURY_CNT"),
    ("cyclist_killed", "CYCLIST_FATALITY_CNT"),
    ("motorist_injured", "MOTORIST_INJURY_CNT"),
    ("motorist_killed", "MOTORIST_FATALITY_CNT"),
    ("total_persons_affected", "TOTAL_PERSONS_AFFECTED_CNT"),
    ("severity_category", "ACC_SEVERITY_CD"),
)
PRESENT_TYPE = "ACCIDENT_TYPE"
PRESENT_PLACEHOLDERS = ("ROAD_CONDITION_CD", "WEATHER_CONDITION_CD", "ROAD_SURFACE_CD")
FACT_KEYS = (
    "time_key",
    "location_key",
    "primary_vehicle_key",
    "secondary_vehicle_key",
    "primary_factor_key",
    "secondary_factor_key",
)


@dataclass(frozen=True)
class Bounds:
    """Inclusive coordinate box of a valid location."""

    lat_low: float = 40.3
    lat_high: float = 41.1
    lon_low: float = -74.5
    lon_high: float = -73.4


@dataclass(frozen=True)
class ClaimRules:
    """Rates and amounts of the synthetic claims. ``(a, b)`` means ``a + b * x``."""

    p_injured: float = 0.85
    p_affected: float = 0.60
    p_other: float = 0.30
    base_killed: tuple[int, int] = (50000, 200000)  # x = persons killed
    base_injured: tuple[int, int] = (10000, 15000)  # x = persons injured
    base_other: tuple[int, int] = (3000, 7000)  # x = uniform draw
    factor: tuple[float, float] = (0.7, 0.8)  # x = uniform draw
    p_open: float = 0.35
    days_killed: tuple[int, int] = (180, 365)
    days_injured: tuple[int, int] = (60, 180)
    large_amount: int = 50000
    days_large: tuple[int, int] = (90, 120)
    days_other: tuple[int, int] = (30, 60)
