"""Ticket views derived from the given fixture tables.

``requests_ev``  one ticket per event (events + customer + nation + region).
``requests_ord`` one ticket per order with at least one line.

Join strategy: ``nation`` (25 rows) and ``region`` (5 rows) have a size fixed
by the TPC-H schema, so they are broadcast explicitly.  ``customer``,
``orders`` and ``lineitem`` grow with the data and are never hinted: Spark
broadcasts them only when their measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at runtime), and
otherwise uses a shuffle join whose skewed partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import literal_map

# --------------------------------------------------------------------------
# Fixed values of the fixture binding (FIXTURES.md §3).
# --------------------------------------------------------------------------
REGION_TO_BOROUGH = {
    "AMERICA": "MANHATTAN",
    "MIDDLE EAST": "BROOKLYN",
    "ASIA": "QUEENS",
    "AFRICA": "BRONX",
    "EUROPE": "STATEN ISLAND",
}

# event_type -> complaint type for k mod 4 = 0, 1, 2, 3
EVENT_TYPE_DIMENSION = {
    "click": ["Noise - Residential", "Noise - Street/Sidewalk", "Noise - Commercial",
              "Heat/Hot Water"],
    "error": ["PAINT/PLASTER", "DOOR/WINDOW", "APPLIANCE", "PLUMBING"],
    "purchase": ["Street Condition", "Street Light Condition", "Traffic Signal Condition",
                 "UNSANITARY CONDITION"],
    "signup": ["Dirty Conditions", "Rodent", "Graffiti", "Blocked Driveway"],
    "view": ["Illegal Parking", "Air Quality", "Water System", "Animal Abuse"],
}

ORDER_STATUS = {"F": "Closed", "O": "Open", "P": "Pending"}
PRIORITY_ORDER_CLASSES = ["1-URGENT", "2-HIGH"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def geo_dimension(nation: DataFrame, region: DataFrame) -> DataFrame:
    """(n_nationkey, borough): 25 rows by the TPC-H schema, hence broadcast."""
    r = region.select("r_regionkey",
                      literal_map(REGION_TO_BOROUGH)[F.col("r_name")].alias("borough"))
    n = nation.select("n_nationkey", "n_regionkey")
    return F.broadcast(n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
                       .select("n_nationkey", "borough"))


def attach_borough(df: DataFrame, nation: DataFrame, region: DataFrame,
                   nation_col: str = "c_nationkey") -> DataFrame:
    """Attach ``borough`` through the broadcast nation dimension (no shuffle)."""
    geo = geo_dimension(nation, region)
    return df.join(geo, df[nation_col] == geo.n_nationkey, "left").drop("n_nationkey")


def requests_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tickets, one per event (binding EV), from the fixture folder."""
    t = {n: table(spark, sf_dir, n) for n in ("events", "customer", "nation", "region")}
    return ev_view(**t)


def ev_view(events: DataFrame, customer: DataFrame, nation: DataFrame,
            region: DataFrame) -> DataFrame:
    """Raw tickets, one per event, from the four tables."""
    # As a generator's output k is read once a row: filters on the ticket's status
    # are pushed below a projection, with its expression copied into each of them.
    ev = events.select("event_id", "ts", "user_id", "event_type", "value",
                       F.explode(F.array(F.get_json_object("props", "$.k").cast("int"))).alias("k"))
    # Join the customer projection first: its size estimate is then the plain
    # scan size, so a small customer table is broadcast at planning time and
    # a large one gets a (skew-aware) sort-merge join.
    cust = customer.select("c_custkey", "c_nationkey")
    j = attach_borough(ev.join(cust, ev.user_id == cust.c_custkey, "left"), nation, region)
    eid = F.col("event_id")
    k = F.col("k")
    closed = k < 75
    status = (F.when(closed, "Closed").when(k < 85, "Open")
              .when(k < 95, "Pending").otherwise("In Progress"))
    secs = F.round(F.col("value") * F.lit(3600.0)).cast("long")
    types = F.create_map(*[x for et, arr in EVENT_TYPE_DIMENSION.items()
                           for x in (F.lit(et), F.array(*[F.lit(t) for t in arr]))])
    return j.select(
        eid.alias("unique_key"),
        F.col("ts").alias("created_date"),
        F.when(closed, F.timestamp_add("SECOND", secs, F.col("ts"))).alias("closed_date"),
        F.element_at(types[F.col("event_type")], (k % 4) + 1).alias("complaint_type"),
        F.col("borough"),
        F.when(eid % 11 == 0, F.lit(None)).otherwise(10001 + eid % 90).cast("int")
        .alias("zip_code"),
        F.when(eid % 97 == 0, F.lit(None)).otherwise(
            F.round(F.lit(40.4774) + (eid * 7919 % 10000) / F.lit(10000.0) * F.lit(0.44), 6))
        .alias("latitude"),
        F.when(eid % 89 == 0, F.lit(None)).otherwise(
            F.round(F.lit(-74.2591) + (eid * 6007 % 10000) / F.lit(10000.0) * F.lit(0.55), 6))
        .alias("longitude"),
        status.alias("status"),
    )


def requests_ord(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tickets, one per order with at least one line (binding OR)."""
    t = {n: table(spark, sf_dir, n) for n in ("orders", "lineitem", "customer", "nation", "region")}
    return ord_view(**t)


def ord_view(orders: DataFrame, lineitem: DataFrame, customer: DataFrame,
             nation: DataFrame, region: DataFrame) -> DataFrame:
    """One ticket per order from the five tables.

    The closing date needs the order date, so lines are joined to orders
    first.  Lines are reduced to distinct (order, ship date) before the join,
    partly in each task, so an order with very many lines brings one row for
    each date it shipped on.  The aggregation groups on ``o_orderkey`` plus
    attributes that depend on it and reuses the join's partitioning.  With
    tables bucketed on the join keys (``sources.bucketed``) neither the
    reduction nor the joins shuffle.
    """
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    lines = lineitem.select("l_orderkey", "l_shipdate").distinct()
    per_order = o.join(lines, o.o_orderkey == lines.l_orderkey).groupBy(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    ).agg(F.min(F.when(F.col("l_shipdate") >= F.col("o_orderdate"), F.col("l_shipdate")))
          .alias("closed_date"))
    cust = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    j = attach_borough(per_order.join(cust, per_order.o_custkey == cust.c_custkey, "left"),
                       nation, region)
    return j.select(
        F.col("o_orderkey").alias("unique_key"),
        F.col("o_orderdate").alias("created_date"),
        F.col("closed_date"),
        F.col("c_mktsegment").alias("complaint_type"),
        F.col("borough"),
        literal_map(ORDER_STATUS)[F.col("o_orderstatus")].alias("status"),
        F.col("o_orderpriority").isin(PRIORITY_ORDER_CLASSES).alias("is_priority"),
    )
