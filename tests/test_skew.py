"""A hot key holding a third of all rows is split across tasks, results unchanged."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from civicflow.operators import cleaning as C
from civicflow.plans import performance as P
from civicflow.sources import requests_ev

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def hot_fixture(spark):
    """sf0.001 tables with the events rewritten so one user owns a third of them.

    In several files, as a large table is: a skewed partition is split along
    the tasks that wrote it.
    """
    d = tempfile.mkdtemp(prefix="civicflow-hot-")
    for t in ("customer", "nation", "region"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    hot = ev.select(F.min("user_id")).first()[0]
    ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(hot))
                  .otherwise(F.col("user_id"))).repartition(8).write.parquet(f"{d}/events.parquet")
    return d


def test_hot_user_join_is_split_and_exact(spark, hot_fixture):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    base = sorted(P.borough_performance(C.clean_pipeline(requests_ev(spark, hot_fixture))).collect())
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        raw = requests_ev(spark, hot_fixture)
        raw.collect()
        plan = raw._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "skew=true" in plan, plan
        got = sorted(P.borough_performance(C.clean_pipeline(requests_ev(spark, hot_fixture))).collect())
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == base


def test_hot_order_brings_one_row_per_ship_date(spark, tmp_path):
    """One order owns a third of the lines; before the join it has a row per ship date."""
    from civicflow.sources import requests_ord
    d = str(tmp_path)
    for t in ("customer", "nation", "region", "orders"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    hot = li.select(F.min("l_orderkey")).first()[0]
    li = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") % 3 == 0, F.lit(hot)).otherwise(F.col("l_orderkey")))
    for _ in range(4):
        li = li.unionByName(li)
    li.write.parquet(f"{d}/lineitem.parquet")
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        df = requests_ord(spark, d)
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    orders = spark.read.parquet(f"{d}/orders.parquet").filter(F.col("o_orderkey") == hot)
    want = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).filter("l_shipdate >= o_orderdate") \
        .agg(F.min("l_shipdate")).first()[0]
    assert [r.closed_date for r in rows if r.unique_key == hot] == [want]
    before_join = plan.split("SortMergeJoin")[-1]
    assert "HashAggregate" in before_join and "l_shipdate" in before_join
    dates = lines.filter(F.col("l_orderkey") == hot).select("l_shipdate").distinct().count()
    assert dates < 0.1 * lines.count()
