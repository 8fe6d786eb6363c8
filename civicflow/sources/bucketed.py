"""Fact tables stored bucketed on their join keys (co-located joins).

Rebuilding the order view joins ``orders`` with ``lineitem`` on the order key
and the result with ``customer`` on the customer key.  Stored once with the
same number of buckets on the order key, later builds read each bucket pair
together and the large orders-lineitem join needs no shuffle; with customer
bucketed on its key only the (one row per order) side of the second join
moves.  Tables are written under the
shared checkpoint folder (or a given location) and registered in the
session catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_path
from .bindings import ord_view, table

# table -> (bucket and sort key, columns the views read)
LAYOUT = {
    "orders": ("o_orderkey", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                              "o_orderpriority"]),
    "lineitem": ("l_orderkey", ["l_orderkey", "l_shipdate"]),
    "customer": ("c_custkey", ["c_custkey", "c_nationkey", "c_mktsegment"]),
}


def write_bucketed(spark: SparkSession, sf_dir: str, buckets: int, prefix: str = "cf",
                   location: str | None = None) -> dict[str, str]:
    """Write orders / lineitem / customer bucketed and sorted on their keys."""
    base = location or shared_path(spark, "bucketed")
    names = {}
    for t, (key, cols) in LAYOUT.items():
        name = f"{prefix}_{t}"
        table(spark, sf_dir, t).select(*cols).write.mode("overwrite") \
            .bucketBy(buckets, key).sortBy(key) \
            .option("path", f"{base.rstrip('/')}/{name}").saveAsTable(name)
        names[t] = name
    return names


def requests_ord_bucketed(spark: SparkSession, sf_dir: str, names: dict[str, str]) -> DataFrame:
    """The order view over bucketed tables (nation / region from ``sf_dir``)."""
    return ord_view(orders=spark.table(names["orders"]),
                    lineitem=spark.table(names["lineitem"]),
                    customer=spark.table(names["customer"]),
                    nation=table(spark, sf_dir, "nation"),
                    region=table(spark, sf_dir, "region"))
