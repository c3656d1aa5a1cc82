"""Names and rules written out once more, so that an entry changed in the rules is noticed."""

from starfold import rules
from verification.oracle import ORACLES
from verification.registry import QUERIES

PRESENTED = [
    "ACCIDENT_NUMBER=collision_id", "COLLISION_ID=collision_id",
    "ACCIDENT_DATE=crash_date", "YEAR=year", "MONTH=month", "MONTH_NAME=month_name", "DAY=day", "ACC_DAY_OF_WEEK=day_of_week",
    "DAY_OF_WEEK_NAME=day_name", "QUARTER=quarter", "ACCIDENT_TIME=hour", "TIME_CATEGORY=time_category", "IS_WEEKEND=is_weekend",
    "BOROUGH=borough", "ZIP_CODE=zip_code", "LATITUDE=latitude", "LONGITUDE=longitude", "ACCIDENT_LOCATION=location_name",
    "VEHICLE_TYPE_CODE_1=vehicle_type_code", "VEHICLE_TYPE_NAME_1=vehicle_type_name",
    "VEHICLE_TYPE_CODE_2=vehicle_type_code", "VEHICLE_TYPE_NAME_2=vehicle_type_name",
    "CONTRIBUTING_FACTOR_1=contributing_factor", "FACTOR_CATEGORY_1=factor_category",
    "CONTRIBUTING_FACTOR_2=contributing_factor", "FACTOR_CATEGORY_2=factor_category",
    "PERSON_INJURY_CNT=persons_injured", "PERSON_FATALITY_CNT=persons_killed",
    "PEDESTRIAN_INJURY_CNT=pedestrians_injured", "PEDESTRIAN_FATALITY_CNT=pedestrians_killed",
    "CYCLIST_INJURY_CNT=cyclist_injured", "CYCLIST_FATALITY_CNT=cyclist_killed",
    "MOTORIST_INJURY_CNT=motorist_injured", "MOTORIST_FATALITY_CNT=motorist_killed",
    "TOTAL_PERSONS_AFFECTED_CNT=total_persons_affected", "ACC_SEVERITY_CD=severity_category",
]


def test_presentation_names():
    pairs = [
        *rules.PRESENT_IDS, *rules.PRESENT_TIME, *rules.PRESENT_LOCATION, *rules.PRESENT_VEHICLE_1, *rules.PRESENT_VEHICLE_2,
        *rules.PRESENT_FACTOR_1, *rules.PRESENT_FACTOR_2, *rules.PRESENT_MEASURES,
    ]
    assert [f"{name}={source}" for source, name in pairs] == PRESENTED
    assert rules.PRESENT_TYPE == "ACCIDENT_TYPE"
    assert list(rules.PRESENT_PLACEHOLDERS) == ["ROAD_CONDITION_CD", "WEATHER_CONDITION_CD", "ROAD_SURFACE_CD"]
    assert list(rules.FACT_KEYS) == [
        "time_key", "location_key", "primary_vehicle_key", "secondary_vehicle_key", "primary_factor_key", "secondary_factor_key"
    ]


def test_classification_rules():
    assert list(rules.VEHICLE_RULES) == [
        ("(?i)sedan", "Sedan"), ("(?i)truck", "Truck"), ("(?i)bus", "Bus"), ("(?i)motorcycle|moped", "Motorcycle/Moped"),
        ("(?i)bicycle|bike", "Bicycle"), ("(?i)van", "Van"), ("(?i)taxi", "Taxi"),
    ]
    assert list(rules.FACTOR_RULES) == [
        ("(?i)unspecified", "Unspecified"), ("(?i)driver|following|speed|aggressive", "Driver Behavior"),
        ("(?i)pavement|road|weather", "Road/Weather"), ("(?i)vehicle|brake|tire", "Vehicle Issue"),
        ("(?i)pedestrian|bicyclist", "Pedestrian/Cyclist"),
    ]
    assert rules.FACTOR_DEFAULT == "Other" and rules.UNKNOWN_LOCATION == "Unknown"
    assert rules.SEVERITY == ("Fatal", "Injury", "Property Damage Only")
    assert rules.SEVERITY_UPPER == ("FATAL", "INJURY", "PROPERTY_DAMAGE_ONLY")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
