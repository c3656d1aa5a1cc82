import pytest
from pyspark.sql import functions as F

from starfold import check_reference, check_rules, exit_code, run_checks, summarize

FACT = (
    "collision_id string, time_key int, location_key int, persons_injured int, persons_killed int, "
    "pedestrians_injured int, pedestrians_killed int, cyclist_injured int, cyclist_killed int, motorist_injured int, "
    "motorist_killed int, total_persons_affected int, severity_category string"
)
CLAIMS = "claim_id string, collision_id string, claim_amount double, claim_status string, days_to_close double"
GOOD = {
    "fact_collisions": [
        ("a", 1, 1, 1, 0, 0, 0, 0, 0, 1, 0, 1, "Injury"),
        ("b", 2, 1, 0, 1, 0, 0, 0, 0, 0, 1, 1, "Fatal"),
        ("c", 2, 2, 0, 0, 0, 0, 0, 0, 0, 0, 0, "Property Damage Only"),
    ],
    "fact_claims": [("x", "a", 10.0, "OPEN", None), ("y", "b", 0.0, "CLOSED", 3.5)],
    "dim_time": [(1,), (2,)],
    "dim_location": [(1,), (2,)],
    "dim_vehicle": [(1,), (2,)],
    "dim_factor": [(1,), (2,)],
    "silver": [(1,), (2,), (3,)],
}
SCHEMAS = {
    "fact_collisions": FACT, "fact_claims": CLAIMS, "dim_time": "time_key int", "dim_location": "location_key int",
    "dim_vehicle": "vehicle_key int", "dim_factor": "factor_key int", "silver": "n int",
}


def tables(spark, **changes):
    return {name: spark.createDataFrame(changes.get(name, rows), SCHEMAS[name]) for name, rows in GOOD.items()}


def results(df):
    return {r["check"][:3]: r for r in df.collect()}


def test_sound_tables_pass_all_checks(spark):
    checks = run_checks(tables(spark))
    got = results(checks)
    assert sorted(got) == [f"K{i:02d}" for i in range(1, 20)] and all(r["passed"] for r in got.values())
    assert summarize(checks).first()[:] == (19, 19, 0) and exit_code(checks) == 0


def changed(name, index, column, value):
    rows = [list(r) for r in GOOD[name]]
    names = [c.split()[0] for c in SCHEMAS[name].split(", ")]
    rows[index][names.index(column)] = value
    return {name: [tuple(r) for r in rows]}


BROKEN = {
    "K01": changed("fact_collisions", 2, "collision_id", None),
    "K02": changed("fact_collisions", 0, "cyclist_killed", -1),
    "K03": changed("fact_claims", 0, "claim_id", None),
    "K04": changed("fact_claims", 0, "claim_amount", -0.01),
    "K05": changed("fact_claims", 0, "claim_status", "PENDING"),
    "K06": changed("fact_claims", 0, "days_to_close", 1.0),
    "K07": {"dim_time": [(1,), (2,), (2,)]},
    "K08": {"dim_location": [(1,), (2,), (1,)]},
    "K09": {"dim_vehicle": [(1,), (1,)]},
    "K10": {"dim_factor": [(1,), (1,)]},
    "K11": {"dim_time": [(1,), (2,), (None,)]},
    "K12": {"dim_location": [(1,), (2,), (None,)]},
    "K13": {"dim_time": [(1,)]},
    "K14": changed("fact_collisions", 0, "location_key", None),
    "K15": changed("fact_claims", 0, "collision_id", "zz"),
    "K16": {"silver": [(1,)]},
    "K17": {"fact_claims": [(str(i), "a", 1.0, "OPEN", None) for i in range(4)]},
    "K18": changed("fact_collisions", 0, "total_persons_affected", 2),
    "K19": changed("fact_collisions", 0, "severity_category", "Fatal"),
}


@pytest.mark.parametrize("check", BROKEN)
def test_each_check_can_fail(spark, check):
    got = results(run_checks(tables(spark, **BROKEN[check])))
    assert not got[check]["passed"] and got[check]["failed"] >= 1 and len(got) == 19
    others = {name for name, r in got.items() if not r["passed"]} - {check}
    assert others <= {"K05": {"K06"}}.get(check, set()), others


def test_without_claims_six_checks_are_skipped(spark):
    sound = tables(spark)
    sound["fact_claims"] = None
    checks = run_checks(sound)
    assert summarize(checks).first()["total_checks"] == 13
    assert not {"K03", "K04", "K05", "K06", "K15", "K17"} & set(results(checks))


def test_null_predicate_passes_and_is_reported(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "n int")
    row = check_rules(df, {"r": F.col("n") >= 0}).first()
    assert (row["failed"], row["total"], row["null_count"], row["passed"]) == (1, 3, 1, False)


def test_a_rule_that_cannot_be_analysed_fails_alone(spark):
    got = {r["check"]: r for r in check_rules(spark.range(2), {"ok": F.col("id") >= 0, "bad": F.col("nope") > 0}).collect()}
    assert check_rules(spark.range(2), {"it's": "id >= 0"}).first()["check"] == "it's"
    assert got["ok"]["passed"] and not got["bad"]["passed"]
    assert got["bad"]["failed"] is None and "UNRESOLVED_COLUMN" in got["bad"]["error"]


def test_null_foreign_keys_can_be_ignored(spark):
    child = spark.createDataFrame([(1,), (None,), (9,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    strict = check_reference(child, parent, "k", "x").first()
    lax = check_reference(child, parent, "k", "x", ignore_null=True).first()
    assert (strict["failed"], strict["total"], strict["null_count"]) == (2, 3, 1) and lax["failed"] == 1


def test_exit_code_of_a_failure(spark):
    assert exit_code(run_checks(tables(spark, **BROKEN["K01"]))) == 1


def test_rules_of_a_table_share_one_scan(spark, tmp_path):
    from starfold import write_table
    from starfold.operators.quality import fact_rules, rules_in_one_scan

    fact = write_table(tables(spark)["fact_collisions"], str(tmp_path / "fact"))
    plan = rules_in_one_scan(fact, fact_rules())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_a_rule_that_fails_on_a_row_is_one_failed_check(spark):
    df = spark.createDataFrame([(0,), (1,)], "x int")
    got = {r["check"]: r for r in check_rules(df, {"ok": "x is not null", "bad": "1 / x > 0", "cast": "cast('a' || x as int) > 0"}).collect()}
    assert got["ok"]["passed"] and got["ok"]["total"] == 2 and got["ok"]["error"] is None
    assert (got["bad"]["passed"], got["bad"]["total"], got["bad"]["error"]) == (False, 2, "DIVIDE_BY_ZERO")
    assert got["cast"]["error"] == "CAST_INVALID_INPUT"
