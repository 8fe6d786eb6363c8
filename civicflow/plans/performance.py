"""Analytic performance queries (Q1-Q7) over the clean ticket table.

Each query is a lazy DataFrame.  Aggregations are partial+final hash
aggregates; the windows without PARTITION BY (W1, W2, W4) run only on the
already-aggregated rows (days, boroughs, months), whose count does not grow
with the ticket volume.  ``by=`` turns them into partitioned windows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import is_closed, resolution_bucket, round_opt, safe_pct
from ..functions.quantiles import grouped_quantiles

DAYS = "response_time_days"


def closed_known(df: DataFrame) -> DataFrame:
    return df.filter(is_closed("status") & F.col(DAYS).isNotNull())


def slowest_types(df: DataFrame, limit: int = 10, min_cases: int = 50,
                  digits: int | None = 2, approx: bool = False) -> DataFrame:
    """Slowest complaint types among closed tickets with a known time.

    ``min_cases=20`` gives the dashboard form (Q1b); there the count is of
    known times, which equals the row count after the known-time filter.
    The median is exact; ``approx=True`` takes the one-pass sketch instead.
    """
    base = closed_known(df).select("complaint_type", DAYS)
    agg = grouped_quantiles(
        base, ["complaint_type"], DAYS, [0.5], ["_median"], approx=approx,
        extra={"total_complaints": "n", "_avg": "mean", "_max": "max"}, having=F.col("n") >= min_cases)
    out = agg.select(
        "complaint_type", "total_complaints",
        round_opt(F.col("_avg"), digits).alias("avg_response_days"),
        round_opt(F.col("_median"), digits).alias("median_response_days"),
        round_opt(F.col("_max"), digits).alias("max_response_days"),
    )
    return out.orderBy(F.col("avg_response_days").desc_nulls_last(),
                       F.col("complaint_type").asc()).limit(limit)


def moving_average(df: DataFrame, window_days: int = 7, by: Sequence[str] | None = None,
                   digits: int | None = None) -> DataFrame:
    """Q2: daily mean response time and its calendar-day moving average.

    The frame is ``RANGE`` over day numbers, so missing days shrink the
    window instead of stretching it.
    """
    by = list(by or [])
    daily = closed_known(df).groupBy(*by, F.to_date("created_date").alias("date")) \
        .agg(F.avg(DAYS).alias("daily_avg_response"))
    w = Window.partitionBy(*by).orderBy(F.unix_date("date")) \
        .rangeBetween(-(window_days - 1), 0)
    name = f"moving_avg_{window_days}d"
    out = daily.withColumn(name, F.avg("daily_avg_response").over(w))
    out = out.select(*by, "date",
                     round_opt(F.col("daily_avg_response"), digits).alias("daily_avg_response"),
                     round_opt(F.col(name), digits).alias(name))
    return out.orderBy(*by, "date")


def resolution_percentages(df: DataFrame, min_cases: int = 100,
                           null_times: str = "exclude", digits: int | None = 2,
                           by: str = "complaint_category") -> DataFrame:
    """Cumulative share resolved within 24h, 48h and 7 days.

    ``null_times="exclude"`` (SQL form) drops closed tickets without a time;
    ``"unresolved"`` (dashboard form, S19) keeps them in the denominator.
    """
    base = df.filter(is_closed("status"))
    if null_times == "exclude":
        base = base.filter(F.col(DAYS).isNotNull())
    elif null_times != "unresolved":
        raise ValueError("null_times must be 'exclude' or 'unresolved'")
    bucket = F.when(F.col(DAYS).isNotNull(), resolution_bucket(DAYS))
    base = base.select(by, bucket.alias("resolution_period"))
    within = {
        "pct_resolved_24h": ["24h"],
        "pct_resolved_48h": ["24h", "48h"],
        "pct_resolved_7d": ["24h", "48h", "7d"],
    }
    agg = base.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_closed"),
        *[F.count_if(F.col("resolution_period").isin(v)).alias(f"_{k}") for k, v in within.items()],
    ).filter(F.col("total_closed") >= min_cases)
    out = agg.select(by, "total_closed", *[
        round_opt(safe_pct(f"_{k}", "total_closed"), digits).alias(k) for k in within])
    return out.orderBy(F.col("pct_resolved_24h").desc_nulls_last(), F.col(by).asc())


def borough_performance(df: DataFrame, digits: int | None = 2) -> DataFrame:
    """Q4: per borough totals, closure rate, mean time and a row-number rank.

    Rank orders by the rounded mean, NULL first (as SQLite does), borough as
    the tie-break.
    """
    closed = is_closed("status")
    agg = df.groupBy("borough").agg(
        F.count(F.lit(1)).alias("total_complaints"),
        F.count_if(closed).alias("closed_complaints"),
        F.avg(F.when(closed, F.col(DAYS))).alias("_avg"),
    )
    out = agg.select(
        "borough", "total_complaints", "closed_complaints",
        round_opt(safe_pct("closed_complaints", "total_complaints"), digits).alias("closure_rate_pct"),
        round_opt(F.col("_avg"), digits).alias("avg_response_days"),
    )
    w = Window.orderBy(F.col("avg_response_days").asc_nulls_first(), F.col("borough").asc_nulls_first())
    return out.withColumn("performance_rank", F.row_number().over(w)).orderBy("performance_rank")


def borough_performance_dashboard(df: DataFrame, digits: int | None = 2) -> DataFrame:
    """Dashboard form; mean over every known time, average rank with ties.

    A NULL mean gets a NULL rank and does not shift the others.
    """
    agg = df.groupBy("borough").agg(
        F.count("unique_key").alias("total_complaints"),
        F.count_if(is_closed("status")).alias("closed_complaints"),
        F.avg(DAYS).alias("_avg"),
    )
    out = agg.select(
        "borough", "total_complaints", "closed_complaints",
        round_opt(F.col("_avg"), digits).alias("avg_response_days"),
        round_opt(safe_pct("closed_complaints", "total_complaints"), digits).alias("closure_rate_pct"),
    )
    return out.withColumn("performance_rank", average_rank("avg_response_days"))


def average_rank(c: str) -> F.Column:
    """Average-method rank (W3): rank + (ties - 1) / 2, NULL stays NULL."""
    order = Window.orderBy(F.col(c).asc_nulls_last())
    ties = Window.partitionBy(c)
    return F.when(F.col(c).isNotNull(),
                  F.rank().over(order).cast("double")
                  + (F.count(F.lit(1)).over(ties) - 1).cast("double") / F.lit(2.0))


def monthly_trend(df: DataFrame, digits: int | None = 2,
                  by: Sequence[str] | None = None) -> DataFrame:
    """Q5: monthly volume, mean time, previous month and growth percent."""
    by = list(by or [])
    c = F.col("created_date")
    monthly = df.groupBy(*by, F.date_format(c, "yyyy").alias("year"),
                         F.date_format(c, "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("monthly_complaints"),
        F.avg(F.when(is_closed("status"), F.col(DAYS))).alias("_avg"),
    )
    w = Window.partitionBy(*by).orderBy("year", "month")
    prev = F.lag("monthly_complaints", 1).over(w)
    out = monthly.select(
        *by, "year", "month", "monthly_complaints",
        round_opt(F.col("_avg"), digits).alias("avg_response_days"),
        prev.alias("prev_month_complaints"),
    )
    out = out.withColumn("complaints_growth_pct", round_opt(safe_pct(
        F.col("monthly_complaints") - F.col("prev_month_complaints"),
        "prev_month_complaints"), digits))
    return out.orderBy(*by, "year", "month")


def priority_analysis(df: DataFrame, digits: int | None = 2, approx: bool = False) -> DataFrame:
    """Q6: priority x business-hours among closed tickets with a known time.

    Honest names (S8): the mean is ``avg_response_days``, the largest value
    ``max_response_days``; the true median and 90th percentile are added.
    """
    keys = ["is_priority", "is_business_hours"]
    base = closed_known(df).select(*keys, DAYS)
    agg = grouped_quantiles(
        base, keys, DAYS, [0.5, 0.9], ["_median", "_p90"], approx=approx,
        extra={"total_complaints": "n", "_avg": "mean", "max_response_days": "max"})
    out = agg.select(
        *keys, "total_complaints",
        round_opt(F.col("_avg"), digits).alias("avg_response_days"),
        "max_response_days",
        round_opt(F.col("_median"), digits).alias("median_response_days"),
        round_opt(F.col("_p90"), digits).alias("p90_response_days"),
    )
    return out.orderBy(F.col("is_priority").desc(), F.col("is_business_hours").desc())


QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "slowest_types": slowest_types,
    "moving_average": moving_average,
    "resolution_percentages": resolution_percentages,
    "borough_performance": borough_performance,
    "temporal_analysis": monthly_trend,
    "priority_analysis": priority_analysis,
}


class QueryError(RuntimeError):
    """Some queries could not be planned; ``results`` has the others."""

    def __init__(self, results: dict[str, DataFrame], failed: dict[str, str]):
        super().__init__(f"queries failed: {failed}")
        self.results, self.failed = results, failed


def run_all(df: DataFrame, monthly_input: DataFrame | None = None) -> dict[str, DataFrame]:
    """Q7: every query over one clean table.

    A query that cannot be planned does not void the others: after the rest
    is planned, ``QueryError`` carries them and names it.  The frames are
    lazy; a failure while one runs shows where it is used (``export_results``
    writes the others first).  Nothing is cached: the input is a stored table.
    ``monthly_input`` lets the monthly trend run on another view.
    """
    results: dict[str, DataFrame] = {}
    failed: dict[str, str] = {}
    for name, fn in QUERIES.items():
        inp = monthly_input if (name == "temporal_analysis" and monthly_input is not None) else df
        try:
            results[name] = fn(inp)
        except Exception as exc:
            failed[name] = f"{type(exc).__name__}: {exc}"
    if failed:
        raise QueryError(results, failed)
    return results


ROW_KEYS = {
    "slowest_types": ["complaint_type"], "moving_average": ["date"],
    "resolution_percentages": ["complaint_category"], "borough_performance": ["borough"],
    "temporal_analysis": ["year", "month"], "priority_analysis": ["is_priority", "is_business_hours"],
}


def long_form(results: dict[str, DataFrame], digits: int = 6) -> DataFrame:
    """Every value of every result as (query, row_key, metric, value)."""
    parts = []
    for name, df in results.items():
        keys = ROW_KEYS[name]
        key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
        values = [F.struct(F.lit(c).alias("metric"), F.round(F.col(c).cast("double"), digits).alias("value"))
                  for c in df.columns if c not in keys]
        parts.append(df.select(F.lit(name).alias("query"), key.alias("row_key"),
                               F.explode(F.array(*values)).alias("x")).select("query", "row_key", "x.*"))
    return reduce(lambda x, y: x.unionByName(y), parts)


def run_dashboard(df: DataFrame) -> dict[str, DataFrame]:
    """Dashboard forms."""
    return {
        "slowest_types": slowest_types(df, min_cases=20),
        "borough_performance": borough_performance_dashboard(df),
        "resolution_percentages": resolution_percentages(df, min_cases=30,
                                                         null_times="unresolved"),
    }
