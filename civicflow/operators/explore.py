"""Exploration and profiling aggregates.

Every result is a small per-group DataFrame computed with partial+final hash
aggregation; nothing is collected.  Following the EDA convention (S20), NULL
keys are dropped from value counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.expressions import is_closed, round_opt, weekday_index
from ..functions.quantiles import ValueCounts, grouped_quantiles

DAYS = "response_time_days"


def exact_avg_days(days: str = DAYS, start: str = "created_date", end: str = "closed_date"):
    """Mean response days from the integer sum of microsecond durations.

    Equal to the mean of ``days`` up to rounding, but the integer sum makes
    it independent of the order rows are added in (partition count, task
    timing), so re-runs and other engines give the same bits.
    """
    known = F.col(days).isNotNull()
    micros = F.when(known, F.timestamp_diff("MICROSECOND", F.col(start), F.col(end)))
    return F.try_divide(F.sum(micros), F.count(micros)) / F.lit(8.64e10)


def closed_rows(df: DataFrame) -> DataFrame:
    return df.filter(is_closed("status"))


def top_counts(df: DataFrame, col: str, n: int = 15) -> DataFrame:
    """A1: the ``n`` most frequent values (ties by value), as a top-k."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.col("count").desc(), F.col(col).asc()).limit(n)


def distribution(df: DataFrame, col: str, denominator: str = "rows") -> DataFrame:
    """A2: value counts with percent share.

    ``denominator="rows"`` divides by all rows (NULL keys included, as the
    cleaning report does); ``"values"`` by the non-NULL ones.  The table is
    aggregated once; the total is a window sum over the aggregated rows, one
    for each distinct value.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if denominator == "values":
        counts = counts.filter(F.col(col).isNotNull())
    total = F.sum("count").over(Window.partitionBy())
    out = counts.withColumn("pct", F.col("count") * F.lit(100.0) / total)
    return out.filter(F.col(col).isNotNull()).orderBy(F.col("count").desc(), F.col(col).asc())


def box_summary(df: DataFrame, by: str = "complaint_category", value: str = DAYS,
                digits: int | None = None, approx: bool = False) -> DataFrame:
    """A3: min, quartiles, max, 1.5 IQR fences, whiskers and outlier count."""
    cols = ["min", "q1", "median", "q3", "max", "lower_fence", "upper_fence",
            "lower_whisker", "upper_whisker"]
    iqr = F.col("q3") - F.col("q1")
    fences = {"lower_fence": F.col("q1") - F.lit(1.5) * iqr, "upper_fence": F.col("q3") + F.lit(1.5) * iqr}
    extra = {"n": "n", "min": "min", "max": "max"}
    probs, names = [0.25, 0.5, 0.75], ["q1", "median", "q3"]
    counts = ValueCounts(closed_rows(df), [by], value)
    if approx:
        stats = grouped_quantiles(closed_rows(df), [by], value, probs, names, approx=True, extra=extra)
    else:
        stats = counts.quantiles(probs, names).select(by, *extra, *names)
    stats = stats.withColumns(fences)
    # Whiskers and outliers come from the same value counts as the quartiles.
    v, c, low, high = F.col("c._v"), F.col("c._c"), F.col("s.lower_fence"), F.col("s.upper_fence")
    out = counts.counts.alias("c").join(stats.alias("s"), F.col("c._g.g0").eqNullSafe(F.col(f"s.{by}"))).groupBy(
        *[F.col(f"s.{x}").alias(x) for x in (by, "n", *cols[:7])]).agg(
        F.coalesce(F.sum(F.when((v < low) | (v > high), c)), F.lit(0)).alias("n_outliers"),
        F.min(F.when(v >= low, v)).alias("lower_whisker"),
        F.max(F.when(v <= high, v)).alias("upper_whisker"))
    return out.select(by, "n", *[round_opt(F.col(c), digits).alias(c) for c in cols],
                      "n_outliers").orderBy(by)


def weekday_histogram(df: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """A4: tickets per weekday, Monday first, zero filled.

    The spine is keyed on the weekday number; the label is a lookup.
    """
    labels = list(labels or S.WEEKDAY_TRANSLATION.values())
    spark = df.sparkSession
    spine = spark.range(7).select(F.col("id").cast("int").alias("weekday_num"))
    spine = spine.withColumn("created_weekday",
                             F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("weekday_num") + 1))
    counts = df.groupBy(weekday_index("created_date").alias("weekday_num")) \
        .agg(F.count(F.lit(1)).alias("count"))
    # Both sides have seven rows at most.
    return spine.join(F.broadcast(counts), "weekday_num", "left") \
        .select("weekday_num", "created_weekday", F.coalesce("count", F.lit(0)).alias("count")) \
        .orderBy("weekday_num")


def hour_histogram(df: DataFrame) -> DataFrame:
    """A5: tickets per hour of day, by hour."""
    return df.filter(F.col("created_hour").isNotNull()).groupBy("created_hour") \
        .agg(F.count(F.lit(1)).alias("count")).orderBy("created_hour")


def month_histogram(df: DataFrame) -> DataFrame:
    """Tickets per month with the month label."""
    labels = F.array(*[F.lit(m) for m in S.MONTH_LABELS])
    return df.filter(F.col("created_month").isNotNull()).groupBy("created_month") \
        .agg(F.count(F.lit(1)).alias("count")) \
        .withColumn("month_label", F.element_at(labels, F.col("created_month"))) \
        .select("created_month", "month_label", "count").orderBy("created_month")


def period_histogram(df: DataFrame) -> DataFrame:
    """Tickets per day period."""
    return df.filter(F.col("created_period").isNotNull()).groupBy("created_period") \
        .agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), "created_period")


def category_values() -> list[str]:
    return list(S.CATEGORY_MAPPING.keys())


def borough_category_matrix(df: DataFrame, categories: Sequence[str] | None = None,
                            digits: int | None = None) -> DataFrame:
    """Mean response days, boroughs as rows, categories as columns.

    The category list is given, so the pivot needs no extra distinct pass.
    """
    cats = list(categories or category_values())
    base = closed_rows(df).filter(F.col(DAYS).isNotNull() & F.col("borough").isNotNull())
    wide = base.groupBy("borough").pivot("complaint_category", cats).avg(DAYS)
    return wide.select("borough", *[round_opt(F.col(f"`{c}`"), digits).alias(c) for c in cats]) \
        .orderBy("borough")


def borough_category_long(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Long form of A8."""
    base = closed_rows(df).filter(F.col(DAYS).isNotNull())
    return base.groupBy("borough", "complaint_category") \
        .agg(round_opt(F.avg(DAYS), digits).alias("avg_response_days")) \
        .filter(F.col("borough").isNotNull() & F.col("complaint_category").isNotNull()) \
        .orderBy("borough", "complaint_category")


def density_grid(df: DataFrame, cell: float = 0.01, digits: int | None = None) -> DataFrame:
    """A10: lat/lon cells with ticket count and mean response time (all rows)."""
    base = df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    lat_cell = F.floor(F.col("latitude") / F.lit(float(cell)))
    lon_cell = F.floor(F.col("longitude") / F.lit(float(cell)))
    g = base.groupBy(lat_cell.alias("lat_cell"), lon_cell.alias("lon_cell")).agg(
        F.count(F.lit(1)).alias("n_tickets"),
        exact_avg_days().alias("avg_response_days"),
    )
    return g.select(
        "lat_cell", "lon_cell",
        ((F.col("lat_cell") + F.lit(0.5)) * F.lit(float(cell))).alias("lat_center"),
        ((F.col("lon_cell") + F.lit(0.5)) * F.lit(float(cell))).alias("lon_center"),
        "n_tickets", round_opt(F.col("avg_response_days"), digits).alias("avg_response_days"),
    )


_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id: the row's number within its task
MERGE_TASKS = 64


def _smallest(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The ``n`` first rows of every task's own rows."""
    ranked = df.sortWithinPartitions(*order).withColumn("_i", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    return ranked.filter(F.col("_i") < n).drop("_i")


def seeded_sample(df: DataFrame, n: int = 5000, seed: int = 42, key: str = "unique_key") -> DataFrame:
    """A fixed-size, repeatable sample: the ``n`` rows with the smallest
    ``md5(seed:key)`` (ties by key); all rows where there are no more than ``n``.

    Independent of partitioning, in one pass over the input.  Every task keeps
    its own ``n`` smallest; these meet in ``MERGE_TASKS`` tasks, which keep
    theirs again, and only their rows are ordered at the end.  So no task gets
    ``n`` rows from every other one.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    scored = df.withColumn("_h", F.coalesce(h, F.lit("")))
    order = ["_h", key]
    kept = _smallest(scored, order, n).repartition(MERGE_TASKS, "_h")
    return _smallest(kept, order, n).orderBy(*order).limit(n).select(*df.columns)


def summary_stats(df: DataFrame, digits: int | None = None, approx: bool = False) -> DataFrame:
    """One row of headline statistics.

    Busiest weekday / hour / month use ``mode`` with the deterministic
    tie-break (lowest value); their cardinality is fixed (7, 24, 12).
    """
    closed = is_closed("status")
    days_closed = F.when(closed, F.col(DAYS))
    agg = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(closed).alias("closed_records"),
        F.count_if(~F.coalesce(closed, F.lit(False))).alias("open_records"),
        F.min("created_date").alias("date_start"),
        F.max("created_date").alias("date_end"),
        F.avg(days_closed).alias("mean_days"),
        F.min(days_closed).alias("min_days"),
        F.max(days_closed).alias("max_days"),
        F.stddev_samp(days_closed).alias("std_days"),
        F.mode("created_weekday", True).alias("busiest_weekday"),
        F.mode("created_hour", True).alias("busiest_hour"),
        F.mode("created_month", True).alias("busiest_month"),
    )
    # Two tables of one row each.
    median = grouped_quantiles(closed_rows(df).select(DAYS), [], DAYS, [0.5], ["median_days"], approx=approx)
    return agg.crossJoin(F.broadcast(median)).select(
        "total_records", "closed_records", "open_records", "date_start", "date_end",
        *[round_opt(F.col(c), digits).alias(c)
          for c in ("mean_days", "median_days", "min_days", "max_days", "std_days")],
        "busiest_weekday", "busiest_hour", "busiest_month")


def summary_report(df: DataFrame, digits: int | None = None) -> dict[str, DataFrame]:
    """A12 with its grouped parts (top-5 types, borough counts)."""
    return {
        "summary": summary_stats(df, digits),
        "top_complaint_types": top_counts(df, "complaint_type", 5),
        "borough_distribution": distribution(df, "borough"),
    }


def daily_counts(df: DataFrame) -> DataFrame:
    """Tickets per calendar day."""
    return df.groupBy(F.to_date("created_date").alias("date")) \
        .agg(F.count(F.lit(1)).alias("count")).orderBy("date")


def dataset_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """Rows, date range, closed count and share, distinct boroughs and types.

    ``approx=True`` swaps the exact distinct counts for HyperLogLog sketches.
    """
    distinct = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    closed = F.count_if(is_closed("status"))
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min("created_date").alias("date_start"),
        F.max("created_date").alias("date_end"),
        closed.alias("closed_records"),
        distinct("borough").alias("n_boroughs"),
        distinct("complaint_type").alias("n_complaint_types"),
    ).withColumn("pct_closed", F.try_divide(F.col("closed_records") * F.lit(100.0),
                                            F.col("total_records").cast("double")))


def overview_kpis(df: DataFrame) -> DataFrame:
    """Total, closure rate, mean time of closed tickets, distinct types."""
    closed = is_closed("status")
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.try_divide(F.count_if(closed) * F.lit(100.0), F.count(F.lit(1)).cast("double"))
        .alias("closure_rate"),
        F.avg(F.when(closed, F.col(DAYS))).alias("avg_response_days"),
        F.count_distinct("complaint_type").alias("n_complaint_types"),
    )


def response_kpis(df: DataFrame, digits: int | None = None, approx: bool = False) -> DataFrame:
    """Mean, median and max response days of closed tickets."""
    out = grouped_quantiles(closed_rows(df), [], DAYS, [0.5], ["median_days"], approx=approx,
                            extra={"mean_days": "mean", "max_days": "max"})
    return out.select(round_opt(F.col("mean_days"), digits).alias("mean_days"),
                      round_opt(F.col("median_days"), digits).alias("median_days"),
                      "max_days")


def null_census(df: DataFrame) -> DataFrame:
    """NULL count per column, long form (column_name, null_count)."""
    cols = df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    stack = "stack({n}, {pairs}) as (column_name, null_count)".format(
        n=len(cols), pairs=", ".join(f"'{c}', c{i}" for i, c in enumerate(cols)))
    return counts.selectExpr(stack)


def null_total(df: DataFrame) -> DataFrame:
    """Total NULL cells (the before/after figure of the cleaning log)."""
    return null_census(df).agg(F.sum("null_count").alias("total_nulls"))


def closed_time_stats(df: DataFrame, digits: int | None = None, approx: bool = False) -> DataFrame:
    """A18 part: count, mean, median, min, max of closed response times."""
    out = grouped_quantiles(closed_rows(df), [], DAYS, [0.5], ["median_days"], approx=approx,
                            extra={"closed_records": "rows", "mean_days": "mean", "min_days": "min", "max_days": "max"})
    return out.select("closed_records",
                      *[round_opt(F.col(c), digits).alias(c)
                        for c in ("mean_days", "median_days", "min_days", "max_days")])


def cleaning_report(df: DataFrame, digits: int | None = None) -> dict[str, DataFrame]:
    """Profile, status / borough shares, top-5 types, closed-time stats."""
    return {
        "profile": dataset_profile(df),
        "status": distribution(df, "status"),
        "borough": distribution(df, "borough"),
        "top_types": distribution(df, "complaint_type").limit(5),
        "response_time": closed_time_stats(df, digits),
    }


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a column (NULL kept), sorted."""
    return df.select(col).distinct().orderBy(F.col(col).asc_nulls_first())
