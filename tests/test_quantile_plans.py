"""Plans of the operators that need exact quantiles, with joins above the broadcast threshold."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from civicflow.functions import quantiles as Q
from civicflow.functions.quantiles import ValueCounts, bucket, grouped_quantiles
from civicflow.operators import cleaning as C
from civicflow.operators import explore as X
from civicflow.plans import performance as P
from civicflow.sources import read_clean, requests_ev

CONF = {"spark.sql.autoBroadcastJoinThreshold": "100", "spark.sql.adaptive.autoBroadcastJoinThreshold": "100"}
OPERATORS = {
    "Q1": lambda df: P.slowest_types(df, min_cases=5), "Q1b": lambda df: P.slowest_types(df, min_cases=20), "Q6": P.priority_analysis,
    "A3": X.box_summary, "A16": X.response_kpis, "A18": X.closed_time_stats, "A12": X.summary_stats,
}


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("q") / "clean")
    C.clean_pipeline(requests_ev(spark, SF_SMALL)).write.parquet(path)
    return path


@pytest.mark.parametrize("name", OPERATORS)
def test_one_scan_and_no_raw_exchange(spark, clean, name):
    old = {k: spark.conf.get(k, None) for k in CONF}
    try:
        for k, v in CONF.items():
            spark.conf.set(k, v)
        df = OPERATORS[name](read_clean(spark, clean))
        assert df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    final = plan.split("+- == Initial Plan ==")[0]
    # A12's weekday, hour and month modes and date range are a second, one-row aggregate.
    assert len(re.findall(r"FileScan parquet", final)) == (2 if name == "A12" else 1), final
    assert "CartesianProduct" not in final
    # Below the lowest exchange there is a partial aggregate: no raw row is shuffled.
    lines = final.splitlines()
    for i, line in enumerate(lines):
        if "FileScan parquet" in line:
            above = [x for x in reversed(lines[:i]) if len(x) - len(x.lstrip(" :+-|")) < len(line) - len(line.lstrip(" :+-|"))]
            exchange = next(j for j, x in enumerate(above) if "Exchange" in x)
            assert any("HashAggregate" in x or "ObjectHashAggregate" in x or "SortAggregate" in x for x in above[:exchange]), final


def test_missing_rank_raises(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0)], "g string, v double")

    class Broken(ValueCounts):
        def _pick(self, hist, probs, few):
            return super()._pick(hist, probs, few).filter("_v = 123.0")

    for by in (["g"], []):
        with pytest.raises(Exception, match="a rank was not found"):
            Broken(df, by, "v").quantiles([0.5], ["q"]).collect()


def test_buckets_keep_the_order(spark):
    values = [-1e300, -7.5, -1e-300, 0.0, 1e-300, 1e-9, 0.1, 0.1000001, 1.0, 1.5, 7.0, 1e9, 1e300]
    got = [r.b for r in spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", bucket(F.col("v")).alias("b")).orderBy("v").collect()]
    assert got == sorted(got)


def test_no_rows_and_null_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None), ("x", None)], "g string, v double")
    got = grouped_quantiles(df, ["g"], "v", [0.5], ["q"], extra={"rows": "rows", "n": "n"}).collect()
    assert [tuple(r) for r in got] == [(None, 2, 1, 1.0)]
    one = grouped_quantiles(df.limit(0), [], "v", [0.5], ["q"], extra={"rows": "rows", "m": "mean"}).collect()
    assert [tuple(r) for r in one] == [(0, None, None)]


def test_ten_million_values_in_one_bucket(spark, monkeypatch):
    """No window sees over 1 % of the values, and the ranks are exact."""
    n = 10_000_000
    lo, width = 10.0, 10.0 / (4 * Q.PER_E)  # one bucket is about 10 / 4096 wide
    df = spark.range(0, n, 1, 16).select((F.lit(lo) + (F.col("id") * 7919 % n) * (width / n)).alias("v"))
    assert df.select(bucket(F.col("v")).alias("b")).distinct().count() <= 2
    seen = []
    chosen = Q.ValueCounts._part_of_rank

    def watched(self, near, few):
        out = chosen(self, near, few)
        seen.extend([near, out])
        return out
    monkeypatch.setattr(Q.ValueCounts, "_part_of_rank", watched)
    got = grouped_quantiles(df, [], "v", [0.5, 0.9], ["a", "b"]).first()
    values = sorted(lo + (i * 7919 % n) * (width / n) for i in range(n))
    for p, q in ((0.5, got.a), (0.9, got.b)):
        at = p * (n - 1)
        a, b = values[int(at)], values[-int(-at // 1)] if at != int(at) else values[int(at)]
        assert q == pytest.approx((1 - at % 1) * a + at % 1 * b, abs=1e-15)
    near, last = seen
    assert near.groupBy("_i").count().agg(F.max("count")).first()[0] > n // 3  # the bucket itself
    assert near.select("_i", "_part").distinct().groupBy("_i").count().agg(F.max("count")).first()[0] <= n // 100
    assert last.groupBy("_i").count().agg(F.max("count")).first()[0] <= n // 100


def test_clustered_values_in_one_bucket(spark):
    """Values that lie ever closer together, in two groups."""
    values = [1000.0 + 0.2 * 4.0 ** -(i % 24) + i * 2.0 ** -42 for i in range(5000)]
    df = spark.createDataFrame([(("a", "b")[i % 2], v) for i, v in enumerate(values)] + [(None, 3.0)], "g string, v double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    names = [f"q{i}" for i in range(7)]
    got = {r.g: [r[x] for x in names] for r in grouped_quantiles(df, ["g"], "v", probs, names).collect()}
    want = {r.g: list(r.q) for r in df.groupBy("g").agg(F.percentile("v", probs).alias("q")).collect()}
    assert got.keys() == want.keys()
    for g in got:
        assert got[g] == pytest.approx(want[g], rel=1e-15)
