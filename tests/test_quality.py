"""Checks, profiles and freshness."""

import datetime as dt

from pyspark.sql import functions as F

from immolens.operators.quality import (
    STAGING_CHECKS, Check, freshness, null_counts, profile, run_checks, snapshot_loaded_at,
)


def test_not_null_and_between(spark):
    df = spark.createDataFrame([(None, 4.0), (10.0, 5.0), (-1.0, None)], "price_eur double, surface_m2 double")
    res = {(r["column"], r["check"]): (r["failures"], r["status"]) for r in run_checks(df, "t", [
        Check("price_eur", "not_null"), Check("price_eur", "between", min_value=0),
        Check("surface_m2", "between", min_value=5)]).collect()}
    assert res[("price_eur", "not_null")] == (1, "fail")
    assert res[("price_eur", "between[0,]")] == (1, "fail")      # -1 fails, null does not
    assert res[("surface_m2", "between[5,]")] == (1, "fail")     # 4 fails, 5 passes


def test_staging_suite_one_row_per_check(spark):
    df = spark.createDataFrame([("1", 10.0, 20.0, 0.5, dt.date(2025, 1, 1))],
                               "id_annonce string, price_eur double, surface_m2 double, price_m2 double, "
                               "date_scraping date")
    out = run_checks(df, "stg", STAGING_CHECKS).collect()
    assert len(out) == len(STAGING_CHECKS) and all(r["status"] == "pass" for r in out)


def test_freshness_thresholds(spark):
    df = spark.createDataFrame([(dt.date(2025, 2, 1),)], "date_scraping date")
    loaded = snapshot_loaded_at()
    status = {h: freshness(df, loaded, dt.datetime(2025, 2, 1) + dt.timedelta(hours=h)).collect()[0]["status"]
              for h in (47, 49, 97)}
    assert status == {47: "pass", 49: "warn", 97: "error"}
    empty = spark.createDataFrame([], "date_scraping date")
    assert freshness(empty, loaded, "2025-02-01 00:00:00").collect()[0]["status"] == "error"


def test_freshness_ignores_session_time_zone(spark):
    df = spark.createDataFrame([(dt.date(2025, 2, 1),)], "date_scraping date")
    tz = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        age = freshness(df, snapshot_loaded_at(), "2025-02-02 00:00:00").collect()[0]["age_hours"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", tz)
    assert age == 24.0


def test_null_counts_and_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert tuple(null_counts(df).collect()[0]) == (1, 2)
    prof = [tuple(r) for r in profile(df).collect()]
    assert prof == [("a", "int", 3, 1), ("b", "string", 3, 2)]
    plan = profile(df.where(F.lit(True)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
