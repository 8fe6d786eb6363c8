"""Hand-made tables for the semantic decisions S1-S27 (FIXTURES.md §5)."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow import schema as S
from civicflow.functions.quantiles import grouped_quantiles
from civicflow.operators import cleaning as C
from civicflow.operators import diagnostics as D
from civicflow.operators import explore as X
from civicflow.plans import performance as P

RAW9 = T.StructType([f for f in S.RAW.fields if f.name in (
    "unique_key", "created_date", "closed_date", "complaint_type", "borough", "zip_code",
    "latitude", "longitude", "status")])


def ts(*a):
    return dt.datetime(*a)


def raw(spark, rows):
    """rows: (key, created, closed, type, borough, zip, lat, lon, status)"""
    return spark.createDataFrame(rows, RAW9)


def tickets(n=120, status="Closed"):
    out = []
    for i in range(n):
        c = ts(2023, 3, 1 + i % 28, i % 24, 0)
        out.append((i, c, c + dt.timedelta(hours=1 + i % 50), "Rodent", "QUEENS",
                    None if i % 7 == 0 else 11101, 40.7, -73.9, status))
    return out


def test_status_language_equal_output(spark):
    """English and Portuguese status give the same results."""
    en = C.clean_pipeline(raw(spark, tickets(status="Closed")))
    pt = C.clean_pipeline(raw(spark, tickets(status="Fechado")))
    for fn in (P.slowest_types, P.borough_performance, P.resolution_percentages):
        a = fn(en, min_cases=1) if fn is not P.borough_performance else fn(en)
        b = fn(pt, min_cases=1) if fn is not P.borough_performance else fn(pt)
        assert sorted(a.collect()) == sorted(b.collect())
    assert en.filter(F.col("response_time_days").isNull()).count() == 0


def test_null_time_kept_by_outlier_rule_and_nan_is_null(spark):
    """Unknown time survives P7; NaN is not produced, NULL is."""
    rows = [(1, ts(2023, 1, 1), None, "Rodent", "BRONX", None, 40.8, -73.9, "Closed"),
            (2, ts(2023, 1, 1), ts(2023, 6, 1), "Rodent", "BRONX", None, 40.8, -73.9, "Closed"),
            (3, ts(2023, 1, 1), ts(2023, 1, 2), "Rodent", "BRONX", None, 40.8, -73.9, "Open")]
    out = C.clean_pipeline(raw(spark, rows)).orderBy("unique_key").collect()
    assert [r.unique_key for r in out] == [1, 3]
    assert out[0].response_time_days is None and out[1].response_time_days is None
    assert C.count_outliers(C.calculate_response_time(C.normalize_dates(raw(spark, rows)))) \
        .first().outliers_removed == 1


def test_zip_default_matches_upper_case_borough(spark):
    """S3: defaults keyed on upper-case names still apply after title-casing."""
    rows = [(1, ts(2023, 1, 1), None, "Rodent", "STATEN ISLAND", None, 40.6, -74.1, "Open")]
    assert C.clean_pipeline(raw(spark, rows)).first().zip_code == 10301


def test_bounds_hours_and_days(spark):
    """17:59 is business hours, 18:00 is not; bucket edges."""
    rows = [(h, ts(2023, 1, 2, h, 59 if h == 17 else 0), ts(2023, 1, 2, h, 59 if h == 17 else 0)
             + dt.timedelta(days=d), "Rodent", "BRONX", 1, 40.8, -73.9, "Closed")
            for h, d in ((5, 1), (6, 2), (11, 7), (12, 30), (17, 30.01), (18, 0.5), (23, 90))]
    out = {r.unique_key: r for r in C.with_resolution_bucket(C.clean_pipeline(raw(spark, rows))).collect()}
    assert out[17].is_business_hours and not out[18].is_business_hours
    assert [out[h].created_period for h in (5, 6, 11, 12, 17, 18, 23)] == [
        "Madrugada", "Manhã", "Manhã", "Tarde", "Tarde", "Noite", "Noite"]
    assert [out[h].resolution_period for h in (5, 6, 11, 12, 17, 18)] == [
        "24h", "48h", "7d", "30d", "30d+", "24h"]
    assert 23 in out  # exactly 90 days is not an outlier
    neg = [(1, ts(2023, 1, 2), ts(2023, 1, 1), "Rodent", "BRONX", 1, 40.8, -73.9, "Closed")]
    clean = C.clean_pipeline(raw(spark, neg))
    assert clean.count() == 1 and C.model_rows(clean).count() == 0


def test_moving_average_uses_calendar_days(spark):
    """A gap shrinks the RANGE frame instead of reaching back 7 rows."""
    days = [1, 2, 3, 10, 11]
    rows = [(d, ts(2023, 1, d), ts(2023, 1, d) + dt.timedelta(days=d), "Rodent", "BRONX", 1,
             40.8, -73.9, "Closed") for d in days]
    out = {r.date.day: r for r in P.moving_average(C.clean_pipeline(raw(spark, rows))).collect()}
    assert out[10].moving_avg_7d == pytest.approx(10.0)      # 1-3 Jan outside the frame
    assert out[11].moving_avg_7d == pytest.approx(10.5)
    assert out[3].moving_avg_7d == pytest.approx(2.0)


def test_growth_zero_previous_is_null(spark):
    """Previous count 0 is impossible per month, but try_divide covers it; first is NULL."""
    rows = [(i, ts(2023, 1 + i % 2, 5), None, "Rodent", "BRONX", 1, 40.8, -73.9, "Open")
            for i in range(5)]
    out = P.monthly_trend(C.clean_pipeline(raw(spark, rows))).collect()
    assert out[0].complaints_growth_pct is None and out[0].prev_month_complaints is None
    assert out[1].complaints_growth_pct == pytest.approx(-33.33)


def test_average_rank_ties_and_null(spark):
    """Tied means share the average rank; NULL stays NULL."""
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 2.0), ("d", None)],
                               "borough string, avg_response_days double")
    out = {r.borough: r.rk for r in df.select("borough", P.average_rank("avg_response_days")
                                              .alias("rk")).collect()}
    assert out == {"a": 1.5, "b": 1.5, "c": 3.0, "d": None}


def test_scorecard_zero_closed_and_unknown_times(spark):
    """No closed tickets -> mean 0; closed with unknown times -> NULL."""
    rows = [(1, ts(2023, 1, 1), None, "Rodent", "BRONX", 1, 40.8, -73.9, "Open"),
            (2, ts(2023, 1, 1), None, "Rodent", "QUEENS", 1, 40.8, -73.9, "Closed")]
    out = {r.borough: r for r in D.borough_scorecard(C.clean_pipeline(raw(spark, rows))).collect()}
    assert out["Bronx"].avg_response_days == 0.0
    assert out["Queens"].avg_response_days is None
    assert out["Queens"].performance == S.GRADE_CRITICAL


def test_unmapped_type_goes_to_default_category(spark):
    rows = [(1, ts(2023, 1, 1), None, "Snow Removal", "BRONX", 1, 40.8, -73.9, "Open"),
            (2, ts(2023, 1, 1), None, "Tree Care", "BRONX", 1, 40.8, -73.9, "Open")]
    out = {r.unique_key: r for r in C.clean_pipeline(raw(spark, rows)).collect()}
    assert out[1].complaint_category == S.DEFAULT_CATEGORY
    assert out[1].complaint_type == "Snow Removal"
    assert out[2].complaint_category == "Meio Ambiente"


def test_weekday_histogram_zero_fills(spark):
    rows = [(1, ts(2023, 1, 2), None, "Rodent", "BRONX", 1, 40.8, -73.9, "Open")]  # Monday
    out = X.weekday_histogram(C.clean_pipeline(raw(spark, rows))).collect()
    assert [r["count"] for r in out] == [1, 0, 0, 0, 0, 0, 0]
    assert out[0].created_weekday == "Segunda-feira"


def test_distribution_sums_to_100(spark):
    df = C.clean_pipeline(raw(spark, tickets(200)))
    assert sum(r.pct for r in X.distribution(df, "borough").collect()) == pytest.approx(100.0)


@pytest.mark.parametrize("accuracy", [100, 100_000])
def test_exact_quantiles_match_builtin_percentile(spark, accuracy):
    """The bracketed exact quantile equals Spark's exact ``percentile``,
    including a hot group far larger than ``accuracy`` (bracket path)."""
    rnd = random.Random(7)
    rows = [("hot", rnd.random() * 100) for _ in range(20000)]
    rows += [("cold", float(rnd.randint(0, 5))) for _ in range(37)]
    rows += [(None, rnd.gauss(0, 1)) for _ in range(11)]
    rows += [("hot", None)] * 5
    df = spark.createDataFrame(rows, "g string, v double").repartition(8)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    ours = {r.g: [r[f"q{i}"] for i in range(len(probs))]
            for r in grouped_quantiles(df, ["g"], "v", probs, accuracy=accuracy).collect()}
    ref = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", probs).alias("p")).collect()}
    assert set(ours) == set(ref)
    for g in ref:
        for a, b in zip(ours[g], ref[g]):
            assert math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12), (g, a, b)


def test_seeded_sample_is_fixed_size_and_repeatable(spark):
    df = spark.range(50000).withColumnRenamed("id", "unique_key")
    a = X.seeded_sample(df, n=500, seed=42)
    b = X.seeded_sample(df.repartition(13), n=500, seed=42)
    ka = sorted(r.unique_key for r in a.collect())
    assert len(ka) == 500 and ka == sorted(r.unique_key for r in b.collect())


def test_durations_are_wall_clock_in_any_session_zone(spark):
    """NTZ dates: a ticket spanning a DST change keeps its wall-clock length."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        rows = [(1, ts(2023, 3, 12, 1, 0), ts(2023, 3, 12, 3, 0), "Rodent", "BRONX", 1,
                 40.8, -73.9, "Closed")]
        r = C.clean_pipeline(raw(spark, rows)).first()
        assert r.response_time_hours == pytest.approx(2.0)
        assert r.created_hour == 1 and r.created_weekday == "Domingo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_approx_quantiles_are_close_and_one_pass(spark):
    """approx=True: one sketch aggregate, answers within the rank error."""
    rnd = random.Random(3)
    df = spark.createDataFrame([("a" if i % 3 else "b", rnd.random() * 10) for i in range(6000)],
                               "g string, v double")
    exact = {r.g: r.q0 for r in grouped_quantiles(df, ["g"], "v", [0.5]).collect()}
    approx_df = grouped_quantiles(df, ["g"], "v", [0.5], approx=True)
    plan = approx_df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Window" not in plan
    approx = {r.g: r.q0 for r in approx_df.collect()}
    for g in exact:
        assert abs(exact[g] - approx[g]) < 0.05
