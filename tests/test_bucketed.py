"""Bucketed fact tables: the order view needs no join shuffle and is unchanged."""

import tempfile

from conftest import SF_SMALL
from civicflow.sources import requests_ord
from civicflow.sources.bucketed import requests_ord_bucketed, write_bucketed


def test_bucketed_order_view_has_no_join_shuffle(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        names = write_bucketed(spark, SF_SMALL, buckets=4,
                               location=tempfile.mkdtemp(prefix="civicflow-bkt-"))
        view = requests_ord_bucketed(spark, SF_SMALL, names)
        got = sorted(view.collect())
        plan = view._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert "hashpartitioning(o_orderkey" not in plan
        assert "hashpartitioning(l_orderkey" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == sorted(requests_ord(spark, SF_SMALL).collect())
