"""I/O round trips, model behaviour on planted signal, and plan shape checks."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from civicflow import schema as S
from civicflow.operators import cleaning as C
from civicflow.plans import model as M
from civicflow.plans.catalog import SPARK, SQL
from civicflow.sources import export_results, read_clean, read_raw, requests_ev, write_table
from civicflow.sources.tickets import write_with_count


def _tmp():
    return tempfile.mkdtemp(prefix="civicflow-test-")


def test_csv_round_trip_parses_dates(spark):
    d = _tmp()
    raw = requests_ev(spark, SF_SMALL)
    full = raw.select(*[F.col(f.name) if f.name in raw.columns else F.lit(None).cast(f.dataType)
                        .alias(f.name) for f in S.RAW.fields])
    write_table(full.withColumn("created_date", F.date_format("created_date", "yyyy-MM-dd HH:mm:ss"))
                .withColumn("closed_date", F.date_format("closed_date", "yyyy-MM-dd HH:mm:ss")),
                f"{d}/raw_csv", fmt="csv")
    back = read_raw(spark, f"{d}/raw_csv", fmt="csv")
    assert dict(back.dtypes)["created_date"] == "timestamp_ntz"
    assert back.count() == raw.count()


def test_missing_file_raises(spark):
    with pytest.raises(FileNotFoundError):
        read_raw(spark, "/nonexistent/path.parquet")


def test_write_with_count_and_export(spark):
    d = _tmp()
    clean = C.clean_pipeline(requests_ev(spark, SF_SMALL))
    n = write_with_count(clean, f"{d}/clean", partition_by=["created_year", "created_month"])
    assert n == clean.count() == read_clean(spark, f"{d}/clean").count()
    from civicflow.plans.performance import run_all
    res = run_all(read_clean(spark, f"{d}/clean"))
    written = export_results(res, d)
    assert set(written) == set(res)


def test_strict_date_parse_raises(spark):
    df = spark.createDataFrame([("x", "not a date")], "unique_key string, created_date string")
    with pytest.raises(Exception):
        C.parse_dates(df, strict=True).collect()
    assert C.parse_dates(df, strict=False).first().created_date is None


def _signal(spark, n=3000):
    """Duration depends on type and hour."""
    rnd = random.Random(1)
    types = ["Rodent", "Graffiti", "Heat/Hot Water", "PLUMBING"]
    rows = []
    for i in range(n):
        t = types[i % 4]
        h = rnd.randint(0, 23)
        days = (1 + 3 * (i % 4)) * (1.5 if 9 <= h <= 17 else 1.0) + rnd.random() * 0.2
        c = dt.datetime(2023, 1 + i % 12, 1 + i % 28, h)
        rows.append((i, c, c + dt.timedelta(days=days), t, "BRONX", 10451, 40.8, -73.9, "Closed"))
    from test_semantics import raw
    return C.clean_pipeline(raw(spark, rows))


def test_forest_beats_mean_and_persists(spark):
    df = _signal(spark)
    res = M.train_random_forest(df, num_trees=10, max_depth=6, cv_folds=2)
    test = res.test_metrics.first()
    assert test.r2 > 0.8 and res.cv_mae is not None and res.cv_mae < 1.0
    top = [r.feature for r in M.top_features(res.importance, 2).collect()]
    assert "complaint_category" in top or "created_hour" in top
    p = os.path.join(_tmp(), "model")
    M.save_model(res, p)
    scored = M.score(M.load_model(spark, p), df)
    assert scored.count() == df.count()
    assert scored.filter(F.col("predicted_days") < 0.1).count() == 0


def test_unseen_labels_get_code_zero(spark):
    df = _signal(spark)
    data = M.prepare(df)
    enc = M.encode(data)
    other = M.engineer_features(df.withColumn("borough", F.lit("Atlantis")))
    codes = enc.transform(other).select("borough_code").distinct().collect()
    assert [r.borough_code for r in codes] == [0.0]


def test_linear_baseline_runs(spark):
    res = M.train_linear_regression(_signal(spark))
    assert res.test_metrics.first().r2 > 0.3


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["Q1_slowest_types", "Q4_borough_performance",
                                  "A10_density_grid_ev", "Q5_monthly_trend_ord"])
def test_no_python_udf_and_pruned_scan(spark, name):
    plan = SPARK[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    phys = _plan(SPARK[name](spark, SF_SMALL))
    # lineitem / events are never read whole: only the needed columns
    assert "l_extendedprice" not in phys and "l_quantity" not in phys
    assert "c_acctbal" not in phys and "c_name" not in phys


def test_windows_run_above_aggregates(spark):
    """Unpartitioned windows (Q2, Q4, Q5) sit above an aggregate."""
    for name in ("Q2_moving_average_ord", "Q4_borough_performance", "Q5_monthly_trend_ord"):
        plan = SPARK[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        i, j = plan.find("Window"), plan.find("Aggregate")
        assert 0 <= i < j, name


def test_sql_registry_names_do_not_collide():
    assert len(SQL) == len(set(SQL)) and len(SPARK) >= 70


def test_page_compositions_run(spark):
    from civicflow.plans import pages
    clean = C.clean_pipeline(requests_ev(spark, SF_SMALL))
    for fn in (pages.all_aggregates, pages.overview_page, pages.response_page,
               pages.diagnostics_page, pages.sql_page):
        for name, df in fn(clean).items():
            assert df.collect() is not None, name
    from civicflow.operators import explore as X
    for rep in (X.cleaning_report(clean), X.summary_report(clean)):
        for name, df in rep.items():
            assert df.collect() is not None, name
    t = pages.temporal_page(clean, borough="Manhattan", category="Todas")
    assert sum(r["count"] for r in t["weekday"].collect()) == \
        clean.filter(F.col("borough") == "Manhattan").count()
    out = pages.save_data(clean, os.path.join(_tmp(), "saved"))
    assert out["rows"] == out["profile"].first().total_records


def test_clean_csv_round_trip_keeps_types(spark):
    d = _tmp()
    clean = C.clean_pipeline(requests_ev(spark, SF_SMALL))
    full = clean.select(*[F.col(f.name) if f.name in clean.columns
                          else F.lit(None).cast(f.dataType).alias(f.name) for f in S.CLEAN.fields])
    write_table(full, f"{d}/clean_csv", fmt="csv")
    back = read_clean(spark, f"{d}/clean_csv", fmt="csv")
    types = dict(back.dtypes)
    assert types["created_date"] == "timestamp_ntz" and types["closed_date"] == "timestamp_ntz"
    assert types["is_priority"] == "boolean" and types["response_time_days"] == "double"
    cols = ["unique_key", "created_date", "closed_date", "response_time_days", "complaint_category"]
    assert sorted(back.select(*cols).collect()) == sorted(full.select(*cols).collect())


def test_jobs_clean_sql_model(spark):
    from civicflow import jobs
    d = _tmp()
    rep = jobs.clean_job(spark, SF_SMALL, f"{d}/ev", "ev")
    assert rep["rows_written"] == C.clean_pipeline(requests_ev(spark, SF_SMALL)).count()
    timed = C.calculate_response_time(C.normalize_dates(requests_ev(spark, SF_SMALL)))
    assert rep["outliers_removed"] == C.count_outliers(timed).first()[0]
    rep10 = jobs.clean_job(spark, SF_SMALL, f"{d}/ev10", "ev", max_days=10)
    assert rep10["outliers_removed"] == C.count_outliers(timed, 10).first()[0] > 0
    jobs.clean_job(spark, SF_SMALL, f"{d}/ord", "ord")
    written = jobs.sql_job(spark, f"{d}/ev", f"{d}/sql", monthly_path=f"{d}/ord")
    assert len(written) == 6 and not any(v.startswith("error") for v in written.values())
    assert spark.read.option("header", True).csv(written["temporal_analysis"]).count() > 1
    out = jobs.model_job(spark, f"{d}/ev", f"{d}/model", f"{d}/m", num_trees=5, max_depth=4,
                         cv_folds=2)
    assert {r["metric"] for r in out["report"]} == {"mae", "rmse", "r2", "size"}
    assert M.load_model(spark, f"{d}/model") is not None


def test_filters_and_columns_reach_the_clean_scan(spark):
    """On the materialised clean table, Q1's status / known-time filters are
    pushed into the Parquet scan and only the needed columns are read."""
    from civicflow.plans import performance as P
    d = _tmp()
    write_table(C.clean_pipeline(requests_ev(spark, SF_SMALL)), f"{d}/ev")
    plan = P.slowest_types(read_clean(spark, f"{d}/ev"))._jdf.queryExecution() \
        .executedPlan().toString()
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln]
    assert scans and all("PushedFilters: [" in ln and "status" in ln.split("PushedFilters")[1]
                         for ln in scans)
    assert all("latitude" not in ln.split("ReadSchema")[1] for ln in scans)


def test_checkpoint_folder_is_reused_and_shared_paths_live_in_it(spark):
    from civicflow.session import ensure_checkpoint_dir, shared_path
    first = ensure_checkpoint_dir(spark)
    assert first and ensure_checkpoint_dir(spark) == first
    assert shared_path(spark, "x").startswith(first)


def test_forest_queries_fit_the_tables_as_they_are(spark, monkeypatch):
    """A later call in the session fits again and returns the new numbers."""
    fits = iter([1.5, 2.5])
    monkeypatch.setattr(M, "train_random_forest", lambda df, cv_folds: M.TrainResult(
        None, "Random Forest", None, None, 7, 3, cv_mae=next(fits)))
    monkeypatch.setattr(M, "save_model", lambda result, path: path)
    got = [SPARK["M9_cv_mae_forest_ev"](spark, SF_SMALL).first().cv_mae for _ in range(2)]
    assert got == [1.5, 2.5]
