"""Diagnostics, the sample and the summary read their tickets once."""

import random

import pytest
from pyspark.sql import functions as F

from civicflow.operators import diagnostics as D
from civicflow.operators import explore as X
from civicflow.plans import pages
from civicflow.sources import read_clean, requests_ev
from civicflow.operators import cleaning as C
from civicflow.sources.tickets import write_table
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("one_scan") / "clean")
    write_table(C.clean_pipeline(requests_ev(spark, SF_SMALL)), path)
    return read_clean(spark, path)


def scans(df):
    """File scans of the plan as run (as planned, where an empty result left none in it)."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final, _, first = plan.partition("== Initial Plan ==")
    return final.count("FileScan") or first.count("FileScan")


@pytest.mark.parametrize("fn", [D.headline_kpis, D.borough_scorecard, D.category_attention, D.recommendations, D.system_score])
def test_each_diagnostic_scans_once(clean, fn):
    assert scans(fn(clean)) == 1


def test_page_scans_once(spark, clean):
    page = pages.diagnostics_page(clean)
    try:
        for name, df in page.items():
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "InMemoryTableScan" in plan, name
        # One cached relation, filled by one scan.
        relation = page["rates"]._jdf.queryExecution().withCachedData().toString()
        assert relation.partition("== Initial Plan ==")[0].count("FileScan") == 1
        for name, fn in (("kpis", D.headline_kpis), ("boroughs", D.borough_scorecard), ("attention", D.category_attention),
                         ("recommendations", D.recommendations), ("score", D.system_score)):
            assert page[name].collect() == fn(clean).collect(), name
    finally:
        page["rates"].unpersist()


def test_rates_by_hand(spark):
    rows = [("A", "x", "Closed", 1.0, True), ("A", "y", "Open", 9.0, True), ("A", "x", "Fechado", None, None),
            (None, "x", "Closed", 3.0, False), ("B", None, "Open", None, False)]
    df = spark.createDataFrame(rows, "borough string, complaint_category string, status string, response_time_days double, is_priority boolean")
    got = {(r.level, r.borough, r.complaint_category): tuple(r[3:]) for r in D.rate_table(df).collect()}
    assert got == {
        ("total", None, None): (5, 3, 4.0, 2, 2, 1),
        ("borough", "A", None): (3, 2, 1.0, 1, 2, 1), ("borough", None, None): (1, 1, 3.0, 1, 0, 0), ("borough", "B", None): (1, 0, None, 0, 0, 0),
        ("category", None, "x"): (3, 3, 4.0, 2, 1, 1), ("category", None, "y"): (1, 0, None, 0, 1, 0), ("category", None, None): (1, 0, None, 0, 0, 0)}
    none = df.filter("borough = 'Z'")
    assert D.headline_kpis(none).collect()[0].total_records == 0
    assert [r.rule_id for r in D.recommendations(none).collect()] == ["ml_triage"]
    assert D.borough_scorecard(none).collect() == [] == D.category_attention(none).collect()


def test_sample_scans_once_and_is_the_smallest_hashes(spark, clean):
    import hashlib
    df = clean.repartition(7, F.rand(3))
    keys = [r.unique_key for r in clean.select("unique_key").collect()]
    ranked = sorted((hashlib.md5(f"42:{k}".encode()).hexdigest(), k) for k in keys)
    for n in (1, 100, len(keys), len(keys) + 5):
        assert [r.unique_key for r in X.seeded_sample(df, n).collect()] == [k for _, k in ranked[:n]]
    assert scans(X.seeded_sample(clean, 50)) == 1
    events = X.seeded_sample(C.clean_pipeline(requests_ev(spark, SF_SMALL)), 50)
    events.collect()
    plan = events._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert sum("FileScan" in x and "event" in x for x in plan.splitlines()) == 1


def test_sample_merges_in_rounds(spark):
    """The first sorts run in the tasks; the global order sees the merged rows only."""
    df = spark.range(0, 20_000, 1, 40).withColumn("unique_key", F.col("id"))
    out = X.seeded_sample(df, 30)
    assert out.count() == 30
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    lines = [x.strip(" :+-") for x in plan.splitlines()]
    sorts = [x for x in lines if x.startswith("Sort ")]
    assert [x.rstrip().endswith("false") or ", false" in x for x in sorts].count(True) == 2
    assert any(x.startswith("RepartitionByExpression") for x in lines)


def test_repeated_keys_in_the_sample(spark):
    rnd = random.Random(2)
    df = spark.createDataFrame([(rnd.randrange(20), i) for i in range(500)], "unique_key int, v int").repartition(9)
    got = [r.unique_key for r in X.seeded_sample(df, 120).collect()]
    assert len(got) == 120 and got == [r.unique_key for r in X.seeded_sample(df.coalesce(2), 120).collect()]
