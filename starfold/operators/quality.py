"""Data-quality checks. Each gives one row: check, failed, total, null_count, passed, error."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.rules import COUNTS, SEVERITY
from starfold.sources.tables import union_all

COLUMNS = ("check", "failed", "total", "null_count", "passed", "error")


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _row(name: str, failed: str, total: str, nulls: str, error: str | None = None) -> str:
    """SQL struct of one result row."""
    return (
        f"named_struct('check', {_quote(name)}, 'failed', CAST({failed} AS BIGINT), 'total', CAST({total} AS BIGINT), "
        f"'null_count', CAST({nulls} AS BIGINT), 'passed', coalesce({failed} = 0, false), "
        f"'error', CAST({'NULL' if error is None else _quote(error)} AS STRING))"
    )


def _as_rows(totals: DataFrame, results: Sequence[str]) -> DataFrame:
    return totals.selectExpr(f"inline(array({', '.join(results)}))")


def rules_in_one_scan(df: DataFrame, rules: Mapping[str, Column | str]) -> DataFrame:
    """The rows of ``check_rules`` as one aggregation, not yet run."""
    counts = [F.expr("count(1) AS total")]
    results = []
    for i, (name, rule) in enumerate(rules.items()):
        predicate = F.expr(rule) if isinstance(rule, str) else rule
        try:
            df.select(predicate)
        except AnalysisException as error:
            results.append(_row(name, "NULL", "total", "NULL", error.getCondition() or "ANALYSIS_ERROR"))
            continue
        counts += [F.count_if(~predicate).alias(f"f{i}"), F.count_if(predicate.isNull()).alias(f"n{i}")]
        results.append(_row(name, f"f{i}", "total", f"n{i}"))
    return _as_rows(df.agg(*counts), results)


def check_rules(df: DataFrame, rules: Mapping[str, Column | str]) -> DataFrame:
    """Row predicates (columns or SQL text), all of them in one scan.

    A row fails where the predicate is FALSE; NULL counts as a pass and is
    reported in ``null_count``. A predicate that cannot be analysed, because of
    a missing column for one, gives a failed check with the error's name. So does
    one that fails on some row (a division by zero, a bad cast): then, and only
    then, the rules are run one by one to tell which.
    """
    return _with_culprits(df, rules, rules_in_one_scan(df, rules))


def _query_error(error: PySparkException) -> str | None:
    """Name of an error in the data or the rule; None for any other, such as a lost executor."""
    state = error.getSqlState() or ""
    return error.getCondition() if state.startswith(("22", "42")) else None


def _with_culprits(df: DataFrame, rules: Mapping[str, Column | str], checked: DataFrame) -> DataFrame:
    """The rows of ``checked``, computed; on a query error, those of each rule by itself."""
    session = df.sparkSession
    try:
        return session.createDataFrame(checked.collect(), checked.schema)  # a row per rule
    except PySparkException as error:
        name = _query_error(error)
        if name is None:
            raise
    if len(rules) > 1:
        return union_all([check_rules(df, {rule: predicate}) for rule, predicate in rules.items()])
    only = _row(next(iter(rules)), "NULL", "total", "NULL", name)
    return _as_rows(df.agg(F.expr("count(1) AS total")), [only])


def check_key(df: DataFrame, key: str, unique: str | None = None, not_null: str | None = None) -> DataFrame:
    """Key checks named ``unique`` (key values that occur more than once) and ``not_null``, in one aggregation."""
    per_key = df.groupBy(F.col(key).alias("k")).agg(F.expr("count(1) AS n"))
    totals = per_key.selectExpr(
        "count_if(n > 1) AS repeated", "coalesce(sum(n), 0) AS total", "coalesce(sum(if(k IS NULL, n, 0)), 0) AS nulls"
    )
    results = [] if unique is None else [_row(unique, "repeated", "total", "nulls")]
    if not_null is not None:
        results.append(_row(not_null, "nulls", "total", "0"))
    return _as_rows(totals, results)


def orphan_keys(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Distinct child keys without a parent row; a NULL key is always one. Shuffles distinct keys only."""
    keys = child.select(F.col(key)).distinct()
    known = parent.select(F.col(parent_key or key).alias("__parent")).distinct()
    return keys.join(known, F.col(key) == F.col("__parent"), "left_anti")


def check_reference(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    name: str,
    *,
    parent_key: str | None = None,
    ignore_null: bool = False,
) -> DataFrame:
    """Number of distinct child keys without a parent row, out of all distinct child keys.

    NULL counts as a missing key unless ``ignore_null``; ``null_count`` tells
    whether it occurs.
    """
    keys = child.select(F.col(key).alias("k")).distinct()
    known = parent.select(F.col(parent_key or key).alias("p")).distinct()
    missing = "p IS NULL AND k IS NOT NULL" if ignore_null else "p IS NULL"
    totals = keys.join(known, F.col("k") == F.col("p"), "left").selectExpr(
        f"count_if({missing}) AS missing", "count(1) AS total", "count_if(k IS NULL) AS nulls"
    )
    return _as_rows(totals, [_row(name, "missing", "total", "nulls")])


def check_row_counts(smaller: DataFrame, larger: DataFrame, name: str) -> DataFrame:
    """``count(smaller) <= count(larger)``; ``failed`` is the surplus."""
    limit = larger.agg(F.expr("count(1) AS n")).scalar()
    totals = smaller.agg(F.expr("count(1) AS total")).select("total", limit.alias("most"))
    return _as_rows(totals, [_row(name, "greatest(total - most, 0)", "total", "0")])


def fact_rules(counts: Sequence[str] = COUNTS) -> dict[str, str]:
    fatal, hurt, other = (_quote(label) for label in SEVERITY)
    return {
        "K01 fact_collisions.collision_id not null": "collision_id IS NOT NULL",
        "K02 fact_collisions counts not negative": " AND ".join(f"{name} >= 0" for name in counts),
        "K18 fact_collisions total is the sum of its parts": "total_persons_affected = persons_injured + persons_killed",
        "K19 fact_collisions severity agrees with counts": (
            f"(persons_killed > 0 AND severity_category = {fatal})"
            f" OR (persons_killed = 0 AND persons_injured > 0 AND severity_category = {hurt})"
            f" OR (persons_killed = 0 AND persons_injured = 0 AND severity_category = {other})"
        ),
    }


def claim_rules() -> dict[str, str]:
    return {
        "K03 fact_claims.claim_id not null": "claim_id IS NOT NULL",
        "K04 fact_claims.claim_amount not negative": "claim_amount >= 0",
        "K05 fact_claims.claim_status known": "claim_status IN ('OPEN', 'CLOSED')",
        "K06 fact_claims.days_to_close null only when open": (
            "(claim_status = 'OPEN' AND days_to_close IS NULL) OR (claim_status = 'CLOSED' AND days_to_close IS NOT NULL)"
        ),
    }


def run_checks(tables: Mapping[str, DataFrame | None], *, ignore_null_keys: bool = False) -> DataFrame:
    """All checks of the star schema as rows: 19 of them, or 13 when there is no ``fact_claims``.

    Fact and claims are scanned once each for all their row rules. Rows come in
    no particular order: sorting so few would cost more than some of the checks.
    """
    fact, claims = tables["fact_collisions"], tables.get("fact_claims")
    time, location = tables["dim_time"], tables["dim_location"]
    frames = [
        check_rules(fact, fact_rules()),
        check_key(time, "time_key", "K07 dim_time.time_key unique", "K11 dim_time.time_key not null"),
        check_key(
            location, "location_key",
            "K08 dim_location.location_key unique", "K12 dim_location.location_key not null",
        ),
        check_key(tables["dim_vehicle"], "vehicle_key", "K09 dim_vehicle.vehicle_key unique"),
        check_key(tables["dim_factor"], "factor_key", "K10 dim_factor.factor_key unique"),
        check_reference(
            fact, time, "time_key", "K13 fact_collisions.time_key in dim_time", ignore_null=ignore_null_keys
        ),
        check_reference(
            fact, location, "location_key", "K14 fact_collisions.location_key in dim_location",
            ignore_null=ignore_null_keys,
        ),
        check_row_counts(fact, tables["silver"], "K16 fact_collisions rows within silver rows"),
    ]
    if claims is not None:
        frames += [
            check_rules(claims, claim_rules()),
            check_reference(
                claims, fact, "collision_id", "K15 fact_claims.collision_id in fact_collisions",
                ignore_null=ignore_null_keys,
            ),
            check_row_counts(claims, fact, "K17 fact_claims rows within fact_collisions rows"),
        ]
    return union_all(frames)


def summarize(checks: DataFrame) -> DataFrame:
    """One row: total, passed and failed checks. Skipped checks are no rows, so they do not count."""
    return checks.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if("passed").alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
    )


def exit_code(checks: DataFrame) -> int:
    """0 when every check passed, else 1."""
    return 1 if summarize(checks).first()["failed_checks"] else 0
