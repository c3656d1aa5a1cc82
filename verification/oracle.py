"""DuckDB SQL giving, from the supplied tables, what each registered query gives."""

from __future__ import annotations

from starfold.rules import (
    COUNTS,
    FACT_KEYS,
    FACTOR_RULES,
    PRESENT_FACTOR_1,
    PRESENT_FACTOR_2,
    PRESENT_IDS,
    PRESENT_LOCATION,
    PRESENT_MEASURES,
    PRESENT_PLACEHOLDERS,
    PRESENT_TIME,
    PRESENT_TYPE,
    PRESENT_VEHICLE_1,
    PRESENT_VEHICLE_2,
    RAW_FIELDS,
    VEHICLE_RULES,
)
from verification.binding import FACTORS, VEHICLES
from verification.registry import GOLD_SQL, INSPECTED


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _case(column: str, rules, default: str) -> str:
    arms = " ".join(f"WHEN regexp_matches({column}, '{p[4:]}', 'i') THEN '{label}'" for p, label in rules)
    return f"CASE {arms} ELSE {default} END"


_RAW = f"""raw AS MATERIALIZED (
  SELECT
    CASE WHEN k % 97 = 0 THEN '13/45/2021' ELSE strftime(o_orderdate, '%m/%d/%Y') END AS "CRASH DATE",
    CASE WHEN k % 53 <> 0 THEN CAST((k * 7) % 24 AS VARCHAR) || ':' || lpad(CAST((k * 13) % 60 AS VARCHAR), 2, '0') END
      AS "CRASH TIME",
    CASE WHEN k % 11 = 0 THEN '   ' WHEN k % 13 = 0 THEN NULL ELSE '  ' || r_name || ' ' END AS "BOROUGH",
    CASE WHEN k % 17 = 0 THEN '' ELSE CAST(10000 + n_nationkey AS VARCHAR) END AS "ZIP CODE",
    CASE WHEN k % 19 = 0 THEN NULL WHEN k % 23 = 0 THEN 0.0::DOUBLE
      ELSE (4030 + c_custkey % 80)::DOUBLE / 100.0::DOUBLE END AS "LATITUDE",
    CASE WHEN k % 19 <> 0 THEN (-7450 + c_custkey % 110)::DOUBLE / 100.0::DOUBLE END AS "LONGITUDE",
    CAST(NULL AS VARCHAR) AS "LOCATION",
    CASE WHEN k % 29 <> 0 THEN ped + cyc + mot END AS "NUMBER OF PERSONS INJURED",
    killed AS "NUMBER OF PERSONS KILLED",
    ped AS "NUMBER OF PEDESTRIANS INJURED",
    CAST(0 AS INTEGER) AS "NUMBER OF PEDESTRIANS KILLED",
    cyc AS "NUMBER OF CYCLIST INJURED",
    CAST(0 AS INTEGER) AS "NUMBER OF CYCLIST KILLED",
    mot AS "NUMBER OF MOTORIST INJURED",
    coalesce(killed, 0) AS "NUMBER OF MOTORIST KILLED",
    {_list(FACTORS)}[(k * 7 + 1) % 9 + 1] AS "CONTRIBUTING FACTOR VEHICLE 1",
    CASE WHEN (k * 3 + 4) % 13 < 9 THEN {_list(FACTORS)}[(k * 3 + 4) % 13 + 1] END AS "CONTRIBUTING FACTOR VEHICLE 2",
    {_list(VEHICLES)}[k % 9 + 1] AS "VEHICLE TYPE CODE 1",
    CASE WHEN (k * 5 + 2) % 11 < 9 THEN {_list(VEHICLES)}[(k * 5 + 2) % 11 + 1] END AS "VEHICLE TYPE CODE 2"
  FROM (
    SELECT o_orderkey AS k, o_orderdate, c_custkey, n_nationkey, r_name,
      CAST(CASE WHEN o_orderkey % 10 = 1 THEN 1 ELSE 0 END AS INTEGER) AS ped,
      CAST(CASE WHEN o_orderkey % 12 = 1 THEN 1 ELSE 0 END AS INTEGER) AS cyc,
      CAST(CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey % 5 ELSE 0 END AS INTEGER) AS mot,
      CAST(CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 101 = 0 THEN 1 ELSE 0 END AS INTEGER) AS killed
    FROM orders JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey))"""

_DATED = """dated AS (
  SELECT *, CAST(try_strptime("CRASH DATE", '%m/%d/%Y') AS DATE) AS crash_date,
    coalesce("LATITUDE" BETWEEN 40.3 AND 41.1 AND "LONGITUDE" BETWEEN -74.5 AND -73.4, false)
      OR coalesce("NUMBER OF PERSONS INJURED" > 0, false) OR coalesce("NUMBER OF PERSONS KILLED" > 0, false) AS usable,
    sha256(concat_ws('|', "CRASH DATE", "CRASH TIME", CAST("LATITUDE" AS VARCHAR), CAST("LONGITUDE" AS VARCHAR)))
      AS collision_id
  FROM raw)"""

_SILVER = """silver AS MATERIALIZED (
  SELECT collision_id, crash_date, "CRASH TIME" AS crash_time_str,
    nullif(trim("BOROUGH"), '') AS borough, nullif(trim("ZIP CODE"), '') AS zip_code,
    "LATITUDE" AS latitude, "LONGITUDE" AS longitude,
    "NUMBER OF PERSONS INJURED" AS persons_injured, "NUMBER OF PERSONS KILLED" AS persons_killed,
    "NUMBER OF PEDESTRIANS INJURED" AS pedestrians_injured, "NUMBER OF PEDESTRIANS KILLED" AS pedestrians_killed,
    "NUMBER OF CYCLIST INJURED" AS cyclist_injured, "NUMBER OF CYCLIST KILLED" AS cyclist_killed,
    "NUMBER OF MOTORIST INJURED" AS motorist_injured, "NUMBER OF MOTORIST KILLED" AS motorist_killed,
    nullif(trim("CONTRIBUTING FACTOR VEHICLE 1"), '') AS contributing_factor_vehicle_1,
    nullif(trim("CONTRIBUTING FACTOR VEHICLE 2"), '') AS contributing_factor_vehicle_2,
    nullif(trim("VEHICLE TYPE CODE 1"), '') AS vehicle_type_code_1,
    nullif(trim("VEHICLE TYPE CODE 2"), '') AS vehicle_type_code_2
  FROM dated WHERE crash_date IS NOT NULL AND usable)"""


def _calendar(date: str, clock: str) -> str:
    hour = f"TRY_CAST(nullif(regexp_extract({clock}, '^(\\d+):', 1), '') AS INTEGER)"
    return f"""
    CAST(year({date}) AS INTEGER) AS year, CAST(month({date}) AS INTEGER) AS month,
    CAST(day({date}) AS INTEGER) AS day, CAST(dayofweek({date}) + 1 AS INTEGER) AS day_of_week,
    strftime({date}, '%A') AS day_name, strftime({date}, '%B') AS month_name,
    CAST(quarter({date}) AS INTEGER) AS quarter, {hour} AS hour,
    CASE WHEN {hour} BETWEEN 0 AND 5 THEN '00:00-05:59' WHEN {hour} BETWEEN 6 AND 8 THEN '06:00-08:59'
      WHEN {hour} BETWEEN 9 AND 11 THEN '09:00-11:59' WHEN {hour} BETWEEN 12 AND 14 THEN '12:00-14:59'
      WHEN {hour} BETWEEN 15 AND 17 THEN '15:00-17:59' WHEN {hour} BETWEEN 18 AND 20 THEN '18:00-20:59'
      ELSE '21:00-23:59' END AS time_category,
    coalesce(dayofweek({date}) IN (0, 6), false) AS is_weekend"""


def _key(order: str) -> str:
    by = ", ".join(f"{c.strip()} NULLS FIRST" for c in order.split(","))
    return f"CAST(row_number() OVER (ORDER BY {by}) AS INTEGER)"


_DIMS = f"""dim_time AS MATERIALIZED (
  SELECT {_key("crash_date, crash_time_str")} AS time_key, crash_date, crash_time_str,
    {_calendar("crash_date", "crash_time_str")}
  FROM (SELECT DISTINCT crash_date, crash_time_str FROM silver)),
dim_location AS MATERIALIZED (
  SELECT {_key("borough, zip_code, latitude, longitude")} AS location_key, borough, zip_code, latitude, longitude,
    CASE WHEN borough IS NULL THEN 'Unknown' ELSE concat_ws(', ', borough, zip_code) END AS location_name
  FROM (SELECT DISTINCT borough, zip_code, latitude, longitude FROM silver
    WHERE latitude IS NOT NULL AND longitude IS NOT NULL)),
dim_vehicle AS MATERIALIZED (
  SELECT {_key("c")} AS vehicle_key, c AS vehicle_type_code, {_case("c", VEHICLE_RULES, "c")} AS vehicle_type_name
  FROM (SELECT vehicle_type_code_1 AS c FROM silver UNION SELECT vehicle_type_code_2 FROM silver) WHERE c IS NOT NULL),
dim_factor AS MATERIALIZED (
  SELECT {_key("c")} AS factor_key, c AS contributing_factor, {_case("c", FACTOR_RULES, "'Other'")} AS factor_category
  FROM (SELECT contributing_factor_vehicle_1 AS c FROM silver UNION SELECT contributing_factor_vehicle_2 FROM silver)
  WHERE c IS NOT NULL)"""

_SEVERITY = "CASE WHEN persons_killed > 0 THEN '{}' WHEN persons_injured > 0 THEN '{}' ELSE '{}' END"


def _fact(name: str, same: str) -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT s.collision_id, t.time_key, l.location_key, v1.vehicle_key AS primary_vehicle_key,
    v2.vehicle_key AS secondary_vehicle_key, f1.factor_key AS primary_factor_key,
    f2.factor_key AS secondary_factor_key, {", ".join("s." + c for c in COUNTS)},
    persons_injured + persons_killed AS total_persons_affected,
    {_SEVERITY.format("Fatal", "Injury", "Property Damage Only")} AS severity_category
  FROM silver s
    LEFT JOIN dim_time t ON s.crash_date {same} t.crash_date AND s.crash_time_str {same} t.crash_time_str
    LEFT JOIN dim_location l ON s.borough {same} l.borough AND s.zip_code {same} l.zip_code
      AND s.latitude {same} l.latitude AND s.longitude {same} l.longitude
    LEFT JOIN dim_vehicle v1 ON s.vehicle_type_code_1 = v1.vehicle_type_code
    LEFT JOIN dim_vehicle v2 ON s.vehicle_type_code_2 = v2.vehicle_type_code
    LEFT JOIN dim_factor f1 ON s.contributing_factor_vehicle_1 = f1.contributing_factor
    LEFT JOIN dim_factor f2 ON s.contributing_factor_vehicle_2 = f2.contributing_factor)"""


def _u(purpose: str) -> str:
    return f"(CAST(('0x' || substr(sha256(who || ':{purpose}'), 1, 8)) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE)"


_CLAIMS = f"""claims AS MATERIALIZED (
  SELECT sha256(who || ':claim') AS claim_id, collision_id, round(amount, 2) AS claim_amount,
    CASE WHEN is_open THEN 'OPEN' ELSE 'CLOSED' END AS claim_status,
    CASE WHEN is_open THEN NULL
      WHEN persons_killed > 0 THEN 180::DOUBLE + 365::DOUBLE * {_u("days")}
      WHEN persons_injured > 0 THEN 60::DOUBLE + 180::DOUBLE * {_u("days")}
      WHEN amount > 50000 THEN 90::DOUBLE + 120::DOUBLE * {_u("days")}
      ELSE 30::DOUBLE + 60::DOUBLE * {_u("days")} END AS days_to_close,
    persons_injured, persons_killed, total_persons_affected, severity_category
  FROM (
    SELECT *, {_u("status")} < 0.35::DOUBLE AS is_open,
      (CASE WHEN persons_killed > 0 THEN 50000::DOUBLE + 200000::DOUBLE * persons_killed
        WHEN persons_injured > 0 THEN 10000::DOUBLE + 15000::DOUBLE * persons_injured
        ELSE 3000::DOUBLE + 7000::DOUBLE * {_u("base")} END)
      * (0.7::DOUBLE + 0.8::DOUBLE * {_u("factor")}) AS amount
    FROM (
      SELECT *, CASE WHEN copy_no = 1 THEN collision_id ELSE collision_id || '#' || copy_no END AS who
      FROM (SELECT *, row_number() OVER (PARTITION BY collision_id ORDER BY persons_injured NULLS FIRST,
          persons_killed NULLS FIRST, total_persons_affected NULLS FIRST, severity_category NULLS FIRST) AS copy_no
        FROM fact))
    WHERE {_u("has")} < CASE WHEN persons_killed > 0 THEN 1.0::DOUBLE WHEN persons_injured > 0 THEN 0.85::DOUBLE
      WHEN total_persons_affected > 0 THEN 0.6::DOUBLE ELSE 0.3::DOUBLE END))"""

_CHAIN = {
    "raw": _RAW,
    "dated": _DATED,
    "silver": _SILVER,
    "dims": _DIMS,
    "fact": _fact("fact", "="),
    "claims": _CLAIMS,
}


def _with(last: str, select: str) -> str:
    """``select`` over the chain of tables up to ``last``."""
    names = list(_CHAIN)
    return "WITH " + ",\n".join(_CHAIN[n] for n in names[: names.index(last) + 1]) + "\n" + select


def _gold(select: str) -> str:
    return _with("claims", select)


def _gold_relations() -> str:
    names = {"fact_collisions": "fact", **{name: name for name in ("dim_time", "dim_location", "dim_vehicle", "dim_factor")}}
    counts = (f"""SELECT '{view}' AS relation, count(*) AS "rows" FROM {table}""" for view, table in names.items())
    return _with("fact", " UNION ALL ".join(counts))


_CASUALTY = (
    "count(collision_id) AS collision_count, CAST(sum(persons_injured) AS BIGINT) AS total_injured, "
    "CAST(sum(persons_killed) AS BIGINT) AS total_killed"
)


def _mean(name: str) -> str:
    return f"round(avg(persons_injured + persons_killed), 2) AS {name}"


_TIME = "fact JOIN dim_time USING (time_key)"
_PLACE = "fact JOIN dim_location USING (location_key)"
_FACTOR = "fact JOIN dim_factor ON primary_factor_key = factor_key"
_VEHICLE = "fact JOIN dim_vehicle ON primary_vehicle_key = vehicle_key"
_AMOUNT = "CAST(claim_amount AS DECIMAL(18,2))"
_AVG_AMOUNT = f"CAST(sum({_AMOUNT}) AS DOUBLE) / count(claim_amount)"
_SUM_AMOUNT = f"CAST(sum({_AMOUNT}) AS DOUBLE)"
# claims with the fact's severity and area, all pairs of one id
_PAIRS = """(SELECT fact.collision_id AS fact_id, fact.severity_category AS severity_category, location_key,
  primary_vehicle_key, claim_id, claim_amount FROM fact {} JOIN claims ON fact.collision_id = claims.collision_id)"""


def _renamed(prefix: str, columns) -> list[str]:
    return [f'{prefix}.{source} AS "{name}"' for source, name in columns]


_PRESENT = ",\n    ".join(
    [
        *_renamed("fact", PRESENT_IDS),
        *_renamed("t", PRESENT_TIME),
        *_renamed("l", PRESENT_LOCATION),
        *_renamed("v1", PRESENT_VEHICLE_1),
        *_renamed("v2", PRESENT_VEHICLE_2),
        *_renamed("f1", PRESENT_FACTOR_1),
        *_renamed("f2", PRESENT_FACTOR_2),
        *_renamed("fact", PRESENT_MEASURES),
        f'{_SEVERITY.format("FATAL", "INJURY", "PROPERTY_DAMAGE_ONLY")} AS "{PRESENT_TYPE}"',
        *[f'CAST(NULL AS VARCHAR) AS "{name}"' for name in PRESENT_PLACEHOLDERS],
        *[f"fact.{key}" for key in FACT_KEYS],
    ]
)


def _rule(name: str, table: str, predicate: str) -> str:
    return f"""SELECT '{name}' AS "check", count(*) FILTER (NOT ({predicate})) AS failed, count(*) AS total,
  count(*) FILTER (({predicate}) IS NULL) AS null_count FROM {table}"""


def _unique(name: str, table: str, key: str) -> str:
    return f"""SELECT '{name}', count(*) FILTER (n > 1), CAST(coalesce(sum(n), 0) AS BIGINT),
  CAST(coalesce(sum(n) FILTER ({key} IS NULL), 0) AS BIGINT)
  FROM (SELECT {key}, count(*) AS n FROM {table} GROUP BY {key})"""


def _reference(name: str, child: str, parent: str, key: str) -> str:
    return f"""SELECT '{name}', count(*) FILTER (p IS NULL), count(*), count(*) FILTER (k IS NULL)
  FROM (SELECT DISTINCT {key} AS k FROM {child}) LEFT JOIN (SELECT DISTINCT {key} AS p FROM {parent}) ON k = p"""


def _row_counts(name: str, small: str, large: str) -> str:
    return f"""SELECT '{name}', greatest((SELECT count(*) FROM {small}) - (SELECT count(*) FROM {large}), 0),
  (SELECT count(*) FROM {small}), 0"""


_FACT_CHECKS = [
    _rule("K01 fact_collisions.collision_id not null", "fact", "collision_id IS NOT NULL"),
    _rule("K02 fact_collisions counts not negative", "fact", " AND ".join(f"{c} >= 0" for c in COUNTS)),
    _unique("K07 dim_time.time_key unique", "dim_time", "time_key"),
    _unique("K08 dim_location.location_key unique", "dim_location", "location_key"),
    _unique("K09 dim_vehicle.vehicle_key unique", "dim_vehicle", "vehicle_key"),
    _unique("K10 dim_factor.factor_key unique", "dim_factor", "factor_key"),
    _rule("K11 dim_time.time_key not null", "dim_time", "time_key IS NOT NULL"),
    _rule("K12 dim_location.location_key not null", "dim_location", "location_key IS NOT NULL"),
    _reference("K13 fact_collisions.time_key in dim_time", "fact", "dim_time", "time_key"),
    _reference("K14 fact_collisions.location_key in dim_location", "fact", "dim_location", "location_key"),
    _row_counts("K16 fact_collisions rows within silver rows", "fact", "silver"),
    _rule(
        "K18 fact_collisions total is the sum of its parts", "fact",
        "total_persons_affected = persons_injured + persons_killed",
    ),
    _rule(
        "K19 fact_collisions severity agrees with counts", "fact",
        "(persons_killed > 0 AND severity_category = 'Fatal') OR (persons_killed = 0 AND persons_injured > 0 AND "
        "severity_category = 'Injury') OR (persons_killed = 0 AND persons_injured = 0 AND "
        "severity_category = 'Property Damage Only')",
    ),
]
_CLAIM_CHECKS = [
    _rule("K03 fact_claims.claim_id not null", "claims", "claim_id IS NOT NULL"),
    _rule("K04 fact_claims.claim_amount not negative", "claims", "claim_amount >= 0"),
    _rule("K05 fact_claims.claim_status known", "claims", "claim_status IN ('OPEN', 'CLOSED')"),
    _rule(
        "K06 fact_claims.days_to_close null only when open", "claims",
        "(claim_status = 'OPEN' AND days_to_close IS NULL) OR (claim_status = 'CLOSED' AND days_to_close IS NOT NULL)",
    ),
    _reference("K15 fact_claims.collision_id in fact_collisions", "claims", "fact", "collision_id"),
    _row_counts("K17 fact_claims rows within fact_collisions rows", "claims", "fact"),
]


def _checks(parts: list[str], select: str) -> str:
    rows = "\nUNION ALL ".join(parts)
    return _gold(f"""SELECT {select} FROM (SELECT "check", failed, total, null_count, failed = 0 AS passed,
  CAST(NULL AS VARCHAR) AS error FROM ({rows}))""")


def _dollars(expression: str) -> str:
    return f"format('${{:,.2f}}', {expression})"


_PRESENTED = f"""SELECT {_PRESENT}
  FROM fact LEFT JOIN dim_time t ON fact.time_key = t.time_key
    LEFT JOIN dim_location l ON fact.location_key = l.location_key
    LEFT JOIN dim_vehicle v1 ON fact.primary_vehicle_key = v1.vehicle_key
    LEFT JOIN dim_vehicle v2 ON fact.secondary_vehicle_key = v2.vehicle_key
    LEFT JOIN dim_factor f1 ON fact.primary_factor_key = f1.factor_key
    LEFT JOIN dim_factor f2 ON fact.secondary_factor_key = f2.factor_key"""

ORACLES: dict[str, str] = {
    # an empty CSV field is NULL
    "bronze_roundtrip": _with(
        "raw",
        "SELECT "
        + ", ".join(f"""nullif("{n}", '') AS "{n}\"""" if kind == "string" else f'"{n}"' for n, kind in RAW_FIELDS)
        + " FROM raw",
    ),
    "silver_clean": _with("silver", "SELECT * FROM silver"),
    "silver_rejects": _with(
        "dated",
        """SELECT CASE WHEN crash_date IS NULL THEN 'bad_date' WHEN NOT usable THEN 'no_location_or_casualty'
  ELSE 'kept' END AS outcome, count(*) AS "rows" FROM dated GROUP BY 1""",
    ),
    "silver_id": _with("dated", 'SELECT collision_id, count(*) AS "rows" FROM dated GROUP BY 1'),
    **{name: _with("dims", f"SELECT * FROM {name}") for name in ("dim_time", "dim_location", "dim_vehicle", "dim_factor")},
    "dim_location_large": _with("dims", "SELECT * FROM dim_location"),
    "dim_key_scale": f"""SELECT {_key("l_partkey, l_suppkey")} AS pair_key, l_partkey, l_suppkey
  FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)""",
    "fact_collisions": _with("fact", "SELECT * FROM fact"),
    "fact_collisions_large_dims": _with("fact", "SELECT * FROM fact"),
    "fact_collisions_nullsafe": _with("dims", "")
    + ", "
    + _fact("nullsafe", "IS NOT DISTINCT FROM")
    + "\nSELECT * FROM nullsafe",
    "present_view": _with(
        "fact",
        _PRESENTED,
    ),
    "present_view_nullsafe": _with("dims", "") + ", " + _fact("fact", "IS NOT DISTINCT FROM") + "\n" + _PRESENTED,
    "claims": _gold("SELECT * FROM claims"),
    "claims_profile": _gold(
        f"""SELECT count(*) AS total_claims, count(*) FILTER (claim_status = 'OPEN') AS open_claims,
  count(*) FILTER (claim_status = 'CLOSED') AS closed_claims, {_AVG_AMOUNT} AS avg_claim_amount,
  min(claim_amount) AS min_claim_amount, max(claim_amount) AS max_claim_amount,
  CAST(sum(CAST(days_to_close AS DECIMAL(18,6))) AS DOUBLE) / count(days_to_close) AS avg_days_to_close,
  round(count(*)::DOUBLE / (SELECT count(*) FROM fact), 2) AS claims_per_collision FROM claims"""
    ),
    "claims_by_severity": _gold(
        f"""SELECT severity_category, count(*) AS claim_count, {_AVG_AMOUNT} AS avg_claim_amount,
  {_SUM_AMOUNT} AS total_claim_amount FROM claims GROUP BY 1"""
    ),
    "q01_hotspots_location": _gold(
        f"""SELECT borough, zip_code, location_name, {_CASUALTY}, avg(persons_injured + persons_killed)
  AS avg_persons_affected FROM {_PLACE} GROUP BY 1, 2, 3
  ORDER BY collision_count DESC, borough NULLS FIRST, zip_code NULLS FIRST, location_name NULLS FIRST LIMIT 20"""
    ),
    "q02_hotspots_borough": _gold(
        f"""SELECT borough, {_CASUALTY}, {_mean("avg_persons_affected")} FROM {_PLACE}
  WHERE borough IS NOT NULL GROUP BY 1"""
    ),
    "q03_worst_hours": _gold(
        f"""SELECT hour, time_category, {_CASUALTY}, {_mean("avg_severity")} FROM {_TIME}
  WHERE hour IS NOT NULL GROUP BY 1, 2"""
    ),
    "q04_worst_day_hours": _gold(
        f"""SELECT day_name, hour, {_CASUALTY} FROM {_TIME} WHERE hour IS NOT NULL AND day_name IS NOT NULL
  GROUP BY 1, 2 ORDER BY collision_count DESC, day_name, hour LIMIT 20"""
    ),
    "q05_monthly_trend": _gold(
        f"SELECT year, month, month_name, {_CASUALTY}, {_mean('avg_severity')} FROM {_TIME} GROUP BY 1, 2, 3"
    ),
    "q06_yearly_totals": _gold(f"SELECT year, {_CASUALTY}, {_mean('avg_severity')} FROM {_TIME} GROUP BY 1"),
    "q07_claims_borough": _gold(
        f"""SELECT borough, count(DISTINCT fact_id) AS collision_count, count(claim_id) AS claim_count,
  round({_AVG_AMOUNT}, 2) AS avg_claim_amount, {_SUM_AMOUNT} AS total_claim_amount,
  min(claim_amount) AS min_claim_amount, max(claim_amount) AS max_claim_amount
  FROM {_PAIRS.format("LEFT")} JOIN dim_location USING (location_key) WHERE borough IS NOT NULL GROUP BY 1"""
    ),
    "q08_claims_borough_severity": _gold(
        f"""SELECT borough, severity_category, count(claim_id) AS claim_count, round({_AVG_AMOUNT}, 2) AS avg_claim_amount,
  {_SUM_AMOUNT} AS total_claim_amount
  FROM {_PAIRS.format("")} JOIN dim_location USING (location_key) WHERE borough IS NOT NULL GROUP BY 1, 2"""
    ),
    "q09_top_factors": _gold(
        f"""SELECT contributing_factor, factor_category, {_CASUALTY}, {_mean("avg_severity")} FROM {_FACTOR} GROUP BY 1, 2
  ORDER BY collision_count DESC, contributing_factor, factor_category LIMIT 20"""
    ),
    "q10_factor_categories": _gold(
        f"SELECT factor_category, {_CASUALTY}, {_mean('avg_severity')} FROM {_FACTOR} GROUP BY 1"
    ),
    "q11_vehicle_types": _gold(
        f"SELECT vehicle_type_name, {_CASUALTY}, {_mean('avg_severity')} FROM {_VEHICLE} GROUP BY 1"
    ),
    "q12_vehicle_claims": _gold(
        f"""SELECT vehicle_type_name, count(DISTINCT fact_id) AS collision_count, count(claim_id) AS claim_count,
  round({_AVG_AMOUNT}, 2) AS avg_claim_amount, {_SUM_AMOUNT} AS total_claim_amount
  FROM {_PAIRS.format("LEFT")} JOIN dim_vehicle ON primary_vehicle_key = vehicle_key GROUP BY 1"""
    ),
    "q13_severity_share": _gold(
        f"""SELECT severity_category, {_CASUALTY},
  round(count(collision_id) * 100.0::DOUBLE / (SELECT count(*) FROM fact), 2) AS percentage FROM fact GROUP BY 1"""
    ),
    "q14_severity_by_band": _gold(
        f"SELECT time_category, severity_category, count(collision_id) AS collision_count FROM {_TIME} GROUP BY 1, 2"
    ),
    "q15_claim_status_share": _gold(
        f"""SELECT claim_status, count(claim_id) AS claim_count, round({_AVG_AMOUNT}, 2) AS avg_claim_amount,
  {_SUM_AMOUNT} AS total_claim_amount,
  round(count(claim_id) * 100.0::DOUBLE / (SELECT count(*) FROM claims), 2) AS percentage FROM claims GROUP BY 1"""
    ),
    "q16_days_to_close": _gold(
        """SELECT claim_status, count(claim_id) AS claim_count, round(avg(days_to_close), 2) AS avg_days_to_close,
  min(days_to_close) AS min_days, max(days_to_close) AS max_days FROM claims WHERE claim_status = 'CLOSED' GROUP BY 1"""
    ),
    "q17_claims_severity": _gold(
        f"""SELECT severity_category, count(claim_id) AS claim_count, round({_AVG_AMOUNT}, 2) AS avg_claim_amount,
  min(claim_amount) AS min_claim_amount, max(claim_amount) AS max_claim_amount,
  {_SUM_AMOUNT} AS total_claim_amount FROM {_PAIRS.format("")} GROUP BY 1"""
    ),
    "q18_weekend": _gold(f"SELECT is_weekend, {_CASUALTY}, {_mean('avg_severity')} FROM {_TIME} GROUP BY 1"),
    "q19_summary": _gold(
        f"""SELECT 'Total Collisions' AS metric, CAST(count(DISTINCT collision_id) AS VARCHAR) AS value FROM fact
UNION ALL SELECT 'Total Claims', CAST(count(DISTINCT claim_id) AS VARCHAR) FROM claims
UNION ALL SELECT 'Total Claim Amount', CAST(sum({_AMOUNT}) AS VARCHAR) FROM claims
UNION ALL SELECT 'Avg Claim Amount', CAST(CAST(round({_AVG_AMOUNT}, 2) AS DECIMAL(18,2)) AS VARCHAR) FROM claims
UNION ALL SELECT 'Total Injuries', CAST(sum(persons_injured) AS VARCHAR) FROM fact
UNION ALL SELECT 'Total Fatalities', CAST(sum(persons_killed) AS VARCHAR) FROM fact"""
    ),
    "k_checks": _checks(_FACT_CHECKS + _CLAIM_CHECKS, "*"),
    "k_checks_without_claims": _checks(_FACT_CHECKS, "*"),
    "k_summary": _checks(
        _FACT_CHECKS + _CLAIM_CHECKS,
        "count(*) AS total_checks, count(*) FILTER (passed) AS passed_checks, "
        "count(*) FILTER (NOT passed) AS failed_checks",
    ),
    "r01_points": _gold(
        f"""SELECT borough, zip_code, latitude, longitude, collision_id, coalesce(persons_injured, 0) AS persons_injured,
  persons_killed, severity_category FROM {_PLACE} WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  ORDER BY CAST(('0x' || substr(sha256(collision_id || ':sample'), 1, 8)) AS BIGINT), collision_id, location_key,
    fact.persons_injured NULLS FIRST, persons_killed NULLS FIRST, severity_category LIMIT 10000"""
    ),
    "r02_monthly": _gold(
        f"""SELECT year, month, month_name, {_CASUALTY}, make_date(year, month, 1) AS date FROM {_TIME} GROUP BY 1, 2, 3"""
    ),
    "r03_hourly": _gold(
        f"SELECT hour, count(collision_id) AS collision_count FROM {_TIME} WHERE hour IS NOT NULL GROUP BY 1"
    ),
    "r04_weekday": _gold(
        f"SELECT day_name, day_of_week, count(collision_id) AS collision_count FROM {_TIME} GROUP BY 1, 2"
    ),
    "r05_claims_borough": _gold(
        f"""SELECT borough, count(claim_id) AS claim_count, {_SUM_AMOUNT} AS total_amount, {_AVG_AMOUNT} AS avg_amount
  FROM {_PAIRS.format("")} JOIN dim_location USING (location_key) WHERE borough IS NOT NULL GROUP BY 1"""
    ),
    "r06_claims_severity": _gold(
        f"""SELECT severity_category, count(claim_id) AS claim_count, {_SUM_AMOUNT} AS total_amount,
  {_AVG_AMOUNT} AS avg_amount FROM {_PAIRS.format("")} GROUP BY 1"""
    ),
    "r07_claim_status": _gold(
        f"SELECT claim_status, count(claim_id) AS claim_count, {_SUM_AMOUNT} AS total_amount FROM claims GROUP BY 1"
    ),
    "r08_days_histogram": _gold(
        """SELECT CAST(i AS INTEGER) AS bin, lo + w * (i - 1) AS low, lo + w * i AS high, coalesce(n, 0) AS "rows"
  FROM (SELECT min(days_to_close) AS lo, (max(days_to_close) - min(days_to_close)) / 30 AS w FROM claims
    WHERE claim_status = 'CLOSED') CROSS JOIN range(1, 31) AS r(i)
  LEFT JOIN (SELECT least(CAST(floor((days_to_close - lo) / w) AS INTEGER) + 1, 30) AS b, count(*) AS n
    FROM claims CROSS JOIN (SELECT min(days_to_close) AS lo, (max(days_to_close) - min(days_to_close)) / 30 AS w
      FROM claims WHERE claim_status = 'CLOSED')
    WHERE claim_status = 'CLOSED' GROUP BY 1) ON b = i"""
    ),
    "r09_severity": _gold("SELECT severity_category, count(collision_id) AS collision_count FROM fact GROUP BY 1"),
    "r10_severity_borough": _gold(
        f"""SELECT borough, severity_category, count(collision_id) AS collision_count FROM {_PLACE}
  WHERE borough IS NOT NULL GROUP BY 1, 2"""
    ),
    "r11_top_factors": _gold(
        f"""SELECT contributing_factor, count(collision_id) AS collision_count FROM {_FACTOR} GROUP BY 1
  ORDER BY collision_count DESC, contributing_factor LIMIT 15"""
    ),
    "r12_summary": _gold(
        f"""SELECT 'Total Collisions' AS metric, format('{{:,}}', count(*)) AS value FROM fact
UNION ALL SELECT 'Total Injuries', format('{{:,}}', CAST(coalesce(sum(persons_injured), 0) AS BIGINT)) FROM fact
UNION ALL SELECT 'Total Fatalities', format('{{:,}}', CAST(coalesce(sum(persons_killed), 0) AS BIGINT)) FROM fact
UNION ALL SELECT 'Total Claims', format('{{:,}}', count(*)) FROM claims
UNION ALL SELECT 'Total Claim Amount', {_dollars(_SUM_AMOUNT)} FROM claims
UNION ALL SELECT 'Avg Claim Amount', {_dollars(_AVG_AMOUNT)} FROM claims"""
    ),
    # readers see the rows with a time of day until the second folder of files is taken up
    "lake_versions": _with(
        "dated",
        """SELECT step, CASE WHEN late THEN n ELSE timed END AS silver_rows, CASE WHEN late THEN n ELSE timed END AS fact_rows,
  rebuilt::BIGINT AS rebuilt FROM (SELECT count(*) AS n, count("CRASH TIME") AS timed FROM dated WHERE crash_date IS NOT NULL AND usable),
  (VALUES ('1 built', false, 8), ('2 broken off', false, 0), ('3 resumed', true, 8), ('4 unchanged', true, 0)) AS v(step, late, rebuilt)""",
    ),
    **{name: _gold_relations() for name in ("gold_without_claims", "gold_stale_claims")},
    "gold_sql": _gold(GOLD_SQL.replace("fact_collisions", "fact").replace("fact_claims", "claims")),
    "table_schemas": f"""SELECT table_name AS "table", ordinal_position AS position, column_name AS name,
  CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS type,
  true AS nullable FROM information_schema.columns WHERE table_name IN {INSPECTED}""",
    "bounded_collect": """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
  ORDER BY 3, 1, 2 LIMIT 100""",
    "tpch_star_fact": """SELECT o_orderkey, o_custkey, o_totalprice, c_mktsegment AS segment, n_name AS nation, r_name AS region
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey""",
    "tpch_code_dim": f"""SELECT {_key("code")} AS code_key, code,
  CASE WHEN regexp_matches(code, 'brass|copper|tin|nickel|steel', 'i') THEN 'Metal'
    WHEN regexp_matches(code, '^brand', 'i') THEN 'Brand' ELSE 'Other' END AS code_class
  FROM (SELECT p_type AS code FROM part UNION SELECT p_brand FROM part) WHERE code IS NOT NULL""",
    "events_calendar_dim": f"""SELECT {_key("event_date, event_clock")} AS moment_key, event_date, event_clock,
  {_calendar("event_date", "event_clock")}
  FROM (SELECT DISTINCT CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS VARCHAR) || ':' || strftime(ts, '%M')
    AS event_clock FROM events)""",
    "events_by_band": f"""SELECT day_name, time_category, count(*) AS events FROM (SELECT {_calendar("d", "t")}
  FROM (SELECT CAST(ts AS DATE) AS d, CAST(hour(ts) AS VARCHAR) || ':' || strftime(ts, '%M') AS t FROM events))
  GROUP BY 1, 2""",
    "fk_orphans_lineitem": """SELECT DISTINCT l_partkey FROM lineitem
  WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)""",
    "orders_share_of_total": """SELECT o_orderpriority, count(o_orderkey) AS order_count,
  round(count(o_orderkey) * 100.0::DOUBLE / (SELECT count(*) FROM orders), 2) AS percentage FROM orders GROUP BY 1""",
    "events_value_histogram": """SELECT CAST(i AS INTEGER) AS bin, coalesce(n, 0) AS "rows" FROM range(1, 31) AS r(i)
  LEFT JOIN (SELECT least(CAST(floor((value - lo) / w) AS INTEGER) + 1, 30) AS b, count(*) AS n
    FROM events CROSS JOIN (SELECT min(value) AS lo, (max(value) - min(value)) / 30 AS w FROM events) GROUP BY 1)
  ON b = i""",
    "topk_parts": """SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20""",
}
