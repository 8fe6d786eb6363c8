"""Replaced tables, observed cleaning, stored sketches and clustered files."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from civicflow import jobs
from civicflow.operators import cleaning as C
from civicflow.operators import explore as X
from civicflow.operators.observed import observe_cleaning
from civicflow.sources import read_clean, requests_ev, requests_ord
from civicflow.sources import sketches as K
from civicflow.sources.tickets import drop_old_loads, load_table, table_location, write_table, write_with_count
from conftest import SF_SMALL

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("storage") / "clean")
    write_table(C.clean_pipeline(requests_ev(spark, SF)), path, partition_by=["created_year", "created_month"])
    return read_clean(spark, path)


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    """Tickets of many months."""
    path = str(tmp_path_factory.mktemp("storage") / "orders")
    write_table(C.clean_pipeline(requests_ord(spark, SF)), path)
    return read_clean(spark, path)


def _scan_metric(df, name="numOutputRows"):
    """A number of the scan of an executed plan without joins."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while (kind := plan.getClass().getSimpleName()) != "FileSourceScanExec":
        if "Adaptive" in kind:
            plan = plan.executedPlan()
        elif "QueryStage" in kind:
            plan = plan.plan()
        else:
            plan = plan.children().head()
    return plan.metrics().apply(name).value()


# -- IO5 -----------------------------------------------------------------------

def test_readers_keep_the_old_load(spark, tmp_path):
    at = str(tmp_path / "t")
    first = load_table(spark, spark.range(10), "swap_me", durable=True, location=at)
    rows = first.toLocalIterator()
    seen = [next(rows).id]  # a reader in the middle of the old load
    second = load_table(spark, spark.range(100, 103), "swap_me", durable=True, location=at)
    assert sorted(r.id for r in second.collect()) == sorted(r.id for r in spark.table("swap_me").collect()) == [100, 101, 102]
    assert sorted(seen + [r.id for r in rows]) == list(range(10))
    assert len(glob.glob(f"{at}/load-*")) == 2
    assert len(drop_old_loads(spark, "swap_me")) == 1 and len(glob.glob(f"{at}/load-*")) == 1
    assert spark.table("swap_me").count() == 3
    spark.sql("DROP TABLE swap_me")


def test_a_failed_load_leaves_the_table(spark, tmp_path):
    at = str(tmp_path / "t")
    load_table(spark, spark.range(5), "keep_me", durable=True, location=at)
    where = table_location(spark, "keep_me")
    bad = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("broken row"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken row"):
        load_table(spark, bad, "keep_me", durable=True, location=at)
    assert table_location(spark, "keep_me") == where and spark.table("keep_me").count() == 5
    spark.sql("DROP TABLE keep_me")


def test_a_load_may_read_the_table_it_replaces(spark, tmp_path):
    at = str(tmp_path / "t")
    load_table(spark, spark.range(6), "grow_me", durable=True, location=at)
    load_table(spark, spark.table("grow_me").filter("id > 2"), "grow_me", durable=True, location=at)
    assert sorted(r.id for r in spark.table("grow_me").collect()) == [3, 4, 5]
    other = load_table(spark, spark.range(2).select(F.col("id").cast("string").alias("name")), "grow_me", durable=True, location=at)
    assert other.columns == ["name"] and spark.table("grow_me").count() == 2
    spark.sql("DROP TABLE grow_me")


# -- the observed cleaning ------------------------------------------------------

def test_clean_job_reports_what_the_operators_say(spark, tmp_path):
    out = str(tmp_path / "ev")
    got = jobs.clean_job(spark, SF_SMALL, out)
    raw = requests_ev(spark, SF_SMALL)
    clean = C.clean_pipeline(raw)
    assert got["nulls_before"] == {r.column_name: r.null_count for r in X.null_census(raw).collect()}
    assert got["nulls_after"] == {r.column_name: r.null_count for r in X.null_census(clean).collect()}
    assert got["null_total_before"] == X.null_total(raw).first()[0] and got["null_total_after"] == X.null_total(clean).first()[0]
    assert got["rows_written"] == clean.count() == read_clean(spark, out).count() and got["rows_read"] == raw.count()
    timed = C.calculate_response_time(C.normalize_dates(raw))
    assert got["outliers_removed"] == C.count_outliers(timed).first()[0]
    want = X.dataset_profile(clean).first().asDict()
    assert got["profile"] == {k: str(want[k]) for k in got["profile"]} and set(want) == set(got["profile"])
    times = X.closed_time_stats(clean).first().asDict()
    summary = X.summary_stats(clean).first().asDict()
    for k, v in times.items():
        assert got["response_time"][k] == pytest.approx(v), k
    assert got["response_time"]["std_days"] == pytest.approx(summary["std_days"])
    for k, v in got["summary"].items():
        assert v == summary[k], k


def test_points_stand_in_the_writing_stage(spark):
    """No shuffle after the first observation: its tasks count once whatever is lost."""
    observed = observe_cleaning(requests_ev(spark, SF_SMALL))
    plan = observed.clean._jdf.queryExecution().optimizedPlan().toString().splitlines()
    points = [i for i, line in enumerate(plan) if "CollectMetrics" in line]
    shuffle = [i for i, line in enumerate(plan) if "RebalancePartitions" in line]
    assert len(points) == 3 and len(shuffle) == 1 and max(points) < shuffle[0]
    assert not any("Join" in line or "Aggregate" in line for line in plan[:shuffle[0]])


def test_an_empty_view_has_a_report(spark, tmp_path):
    observed = observe_cleaning(requests_ev(spark, SF_SMALL).filter("unique_key < 0"))
    write_table(observed.clean, str(tmp_path / "none"), partition_by=["created_year", "created_month"], rebalance=False)
    report = observed.report()
    assert report["rows_written"] == report["rows_read"] == report["null_total_before"] == 0
    assert report["profile"]["pct_closed"] is None


def test_counted_write_counts_after_the_shuffle(spark, clean, tmp_path):
    n = write_with_count(clean, str(tmp_path / "w"), partition_by=["created_year", "created_month"])
    assert n == clean.count()


# -- stored sketches -------------------------------------------------------------

def test_stored_distinct_counts_are_near(spark, orders, tmp_path):
    path = K.write_sketches(orders, str(tmp_path / "s"))
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c in K.COLUMNS if c in orders.columns]).first().asDict()
    got = {r.column_name: r.n_distinct for r in K.distinct_estimates(spark, path).collect()}
    assert set(got) == set(exact)
    for c, n in exact.items():
        assert abs(got[c] - n) <= 0.02 * n, c
    months = [(r[0], r[1]) for r in orders.select(*K.MONTH).distinct().orderBy(*K.MONTH).limit(2).collect()]
    part = orders.join(spark.createDataFrame(months, "created_year int, created_month int"), K.MONTH)
    few = {r.column_name: r.n_distinct for r in K.distinct_estimates(spark, path, months).collect()}
    n = part.agg(F.count_distinct("unique_key")).first()[0]
    assert abs(few["unique_key"] - n) <= 0.02 * n


def test_adding_a_month_reads_and_writes_that_month_only(spark, orders, tmp_path):
    clean_path, path = str(tmp_path / "c"), str(tmp_path / "s")
    year, month = orders.select(*K.MONTH).distinct().orderBy(*K.MONTH).first()
    last = (F.col("created_year") == year) & (F.col("created_month") == month)
    write_table(orders.filter(~last), clean_path, partition_by=K.MONTH)
    K.write_sketches(read_clean(spark, clean_path), path)
    stamp = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*/*/*.parquet")}
    before = {r.column_name: r.n_distinct for r in K.distinct_estimates(spark, path).collect()}
    orders.filter(last).write.mode("append").partitionBy(*K.MONTH).parquet(clean_path)
    # The scan of an update prunes to one folder.
    month_rows = spark.read.parquet(clean_path).filter(last)
    files = glob.glob(f"{clean_path}/created_year={year}/created_month={month}/*.parquet")
    assert _scan_metric(K.sketch_months(month_rows), "numFiles") == len(files) >= 1
    assert _scan_metric(K.sketch_months(month_rows), "numPartitions") == 1
    K.update_month(spark, clean_path, path, year, month)
    now = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*/*/*.parquet")}
    assert {f: t for f, t in now.items() if f in stamp} == stamp and len(now) == len(stamp) + 1
    after = {r.column_name: r.n_distinct for r in K.distinct_estimates(spark, path).collect()}
    n = orders.agg(F.count_distinct("unique_key")).first()[0]
    assert before["unique_key"] < after["unique_key"] and abs(after["unique_key"] - n) <= 0.02 * n
    K.update_month(spark, clean_path, path, year, month)  # again: replaced, not added
    assert {r.column_name: r.n_distinct for r in K.distinct_estimates(spark, path).collect()} == after


def test_counting_reads_sketches_only(spark, orders, tmp_path):
    path = K.write_sketches(orders, str(tmp_path / "s"))
    assert sum(os.path.getsize(f) for f in glob.glob(f"{path}/*/*/*.parquet")) < 100 * 5 * (1 << K.LG_K)
    assert K.merged(spark, path).agg(F.sum("tickets")).first()[0] == orders.count()


# -- clustered files ----------------------------------------------------------------

def test_a_selection_skips_row_groups(spark, clean, tmp_path):
    one = clean.repartition(1)
    plain = write_table(one.sortWithinPartitions(F.md5(F.col("unique_key").cast("string"))), str(tmp_path / "plain"), block_bytes=64 << 10)
    sorted_ = write_table(one, str(tmp_path / "sorted"), cluster_by=["borough", "complaint_category"], block_bytes=64 << 10)
    total = clean.count()
    rows = {}
    for name, path in (("plain", plain), ("sorted", sorted_)):
        chosen = C.filter_selection(read_clean(spark, path), "Queens", "Ruído").select("unique_key")
        rows[name] = (_scan_metric(chosen), chosen.count())
    assert rows["plain"][1] == rows["sorted"][1] > 0
    assert rows["sorted"][0] < 0.5 * total and rows["sorted"][0] < 0.6 * rows["plain"][0]


def test_clustered_files_keep_folders_and_rows(spark, clean, tmp_path):
    path = write_table(clean, str(tmp_path / "c"), partition_by=K.MONTH, cluster_by=["borough", "complaint_category"])
    back = read_clean(spark, path)
    assert back.count() == clean.count()
    for f in glob.glob(f"{path}/*/*/*.parquet")[:3]:
        got = [(r.borough or "", r.complaint_category) for r in spark.read.parquet(f).coalesce(1).collect()]
        assert got == sorted(got)
