"""Scorecards and rule-based diagnostics (D1-D5), all from one scan.

One aggregate by (borough, category) reads the tickets; its few rows are then
rolled up to boroughs, categories and the total by grouping sets.  Every
scorecard is worked out from that rate table, so ``rate_table`` may be built
once and given to all of them in place of the tickets.  Thresholds are
arguments.  Means follow S27: 0 when a group has no closed ticket, NULL when
its closed tickets have no known time (every threshold test on NULL is then
false, as in the reference).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.expressions import is_closed, num_text, pct_text

DAYS = "response_time_days"
TOTAL, BOROUGH, CATEGORY = "total", "borough", "category"
_SUMS = ("total_calls", "closed_calls", "closed_days", "timed_calls", "priority_calls", "priority_closed")
RATES = ["level", "borough", "complaint_category", *_SUMS]


def rate_table(df: DataFrame) -> DataFrame:
    """Counts and sums of the tickets by borough, by category and in total.

    ``level`` tells the three apart (a NULL borough or category is a group of
    its own).  One scan with partial aggregation, then one roll-up of at most
    boroughs x categories rows.  A table without one of the group columns or
    the priority flag counts as one with NULLs there.
    """
    if df.columns == RATES:
        return df
    absent = {"borough": "string", "complaint_category": "string", "is_priority": "boolean"}
    df = df.withColumns({c: F.lit(None).cast(t) for c, t in absent.items() if c not in df.columns})
    closed = is_closed("status")
    prio = F.coalesce(F.col("is_priority"), F.lit(False))
    cells = df.groupBy("borough", "complaint_category").agg(
        F.count(F.lit(1)).alias("total_calls"),
        F.count_if(closed).alias("closed_calls"),
        F.sum(F.when(closed, F.col(DAYS))).alias("closed_days"),
        F.count(F.when(closed, F.col(DAYS))).alias("timed_calls"),
        F.count_if(prio).alias("priority_calls"),
        F.count_if(prio & closed).alias("priority_closed"))
    borough, category = F.col("borough"), F.col("complaint_category")
    up = cells.groupingSets([[borough], [category], []], borough, category).agg(
        F.grouping_id().alias("gid"), *[F.sum(c).alias(c) for c in _SUMS])
    level = F.when(F.col("gid") == 1, BOROUGH).when(F.col("gid") == 2, CATEGORY).otherwise(TOTAL)
    # Without tickets grouping sets give no total; counts are 0 then.
    total = F.col("level") == TOTAL
    return up.withColumn("level", level).select(*RATES).unionByName(_no_tickets(df)).groupBy(*RATES[:3]).agg(
        *[F.sum(c).alias(c) for c in _SUMS]).withColumns(
        {c: F.when(total, F.coalesce(F.col(c), F.lit(0))).otherwise(F.col(c)) for c in _SUMS if c != "closed_days"})


def _no_tickets(df: DataFrame) -> DataFrame:
    """A total of nothing."""
    zero = [F.lit(0).cast("long").alias(c) if c != "closed_days" else F.lit(None).cast("double").alias(c) for c in _SUMS]
    return df.sparkSession.range(1).select(
        F.lit(TOTAL).alias("level"), F.lit(None).cast("string").alias("borough"),
        F.lit(None).cast("string").alias("complaint_category"), *zero)


def _closed_mean() -> Column:
    return F.when(F.col("closed_calls") == 0, F.lit(0.0)).otherwise(F.try_divide("closed_days", "timed_calls"))


def _closure_rate() -> Column:
    return F.try_divide(F.col("closed_calls") * F.lit(100.0), F.col("total_calls").cast("double"))


def headline_kpis(df: DataFrame, closure_target: float = 70.0,
                  time_target: float = 2.0) -> DataFrame:
    """Volume, closure rate, mean time, priority closure rate, deltas."""
    agg = rate_table(df).filter(F.col("level") == TOTAL).select(
        F.col("total_calls").alias("total_records"), F.col("closed_calls").alias("closed_records"),
        _closure_rate().alias("closure_rate"), _closed_mean().alias("avg_response_days"),
        F.col("priority_calls").alias("priority_total"), "priority_closed")
    prate = F.when(F.col("priority_total") > 0,
                   F.col("priority_closed") * F.lit(100.0) / F.col("priority_total")) \
        .otherwise(F.lit(0.0))
    return agg.withColumns({
        "priority_rate": prate,
        "closure_delta": F.col("closure_rate") - F.lit(float(closure_target)),
        "time_delta": F.lit(float(time_target)) - F.col("avg_response_days"),
    }).select("total_records", "closed_records", "closure_rate", "avg_response_days",
              "priority_total", "priority_closed", "priority_rate", "closure_delta", "time_delta")


def grade(rate: Column, mean: Column) -> Column:
    """Borough grade by (closure %, mean days) bands."""
    return (F.when((rate >= 75) & (mean <= 2.0), S.GRADE_EXCELLENT)
            .when((rate >= 70) & (mean <= 3.0), S.GRADE_GOOD)
            .when((rate >= 60) & (mean <= 5.0), S.GRADE_FAIR)
            .otherwise(S.GRADE_CRITICAL))


def _group_rates(df: DataFrame, level: str, key: str) -> DataFrame:
    return rate_table(df).filter(F.col("level") == level).select(
        key, "total_calls", "closed_calls", _closed_mean().alias("avg_response_days"),
        _closure_rate().alias("closure_rate"))


def borough_scorecard(df: DataFrame, text: bool = True) -> DataFrame:
    """Per borough totals, closure %, mean time and grade (+ display text)."""
    out = _group_rates(df, BOROUGH, "borough")
    out = out.withColumn("performance", grade(F.col("closure_rate"), F.col("avg_response_days")))
    if text:
        out = out.withColumns({"closure_rate_text": pct_text("closure_rate"),
                               "avg_response_text": num_text("avg_response_days")})
    return out.orderBy("borough")


def category_attention(df: DataFrame, min_cases: int = 50, closure_target: float = 70.0,
                       time_target: float = 3.0, high_closure: float = 60.0,
                       high_time: float = 5.0) -> DataFrame:
    """D3: categories needing attention, worst first."""
    out = _group_rates(df, CATEGORY, "complaint_category")
    rate, mean = F.col("closure_rate"), F.col("avg_response_days")
    out = out.filter(_needs_attention(rate, mean, min_cases, closure_target, time_target))
    high = (rate < high_closure) | (mean > high_time)
    out = out.withColumns({
        "urgency": F.when(high, S.URGENCY_HIGH).otherwise(S.URGENCY_MEDIUM),
        "severity": F.when(high, 2).otherwise(1),
        "main_problem": F.when(rate < closure_target, S.PROBLEM_LOW_RATE)
        .otherwise(S.PROBLEM_HIGH_TIME),
    })
    return out.orderBy(F.col("severity").desc(), F.col("closure_rate").asc(),
                       F.col("complaint_category").asc())


def _needs_attention(rate: Column, mean: Column, min_cases: int, closure_target: float, time_target: float) -> Column:
    return (F.col("total_calls") >= min_cases) & ((rate < closure_target) | (mean > time_target))


def recommendations(df: DataFrame, closure_goal: float = 75.0, time_goal: float = 2.5,
                    borough_floor: float = 70.0, min_cases: int = 50, closure_target: float = 70.0,
                    time_target: float = 3.0, high_closure: float = 60.0, high_time: float = 5.0) -> DataFrame:
    """Triggered recommendation rules as rows (rule_no, rule_id, subject).

    One aggregate over the rate table gives every rule's input: the total's
    rates, the worst borough, and the first category of D3.  Rule 3 compares
    rates as shown, rounded to one decimal: 69.96 % is 70.0 %.
    """
    rate, mean = F.col("rate"), F.col("mean")
    rates = rate_table(df).withColumns({"rate": _closure_rate(), "mean": _closed_mean()})
    total, borough, category = (F.col("level") == x for x in (TOTAL, BOROUGH, CATEGORY))
    high = (rate < high_closure) | (mean > high_time)
    attention = category & _needs_attention(rate, mean, min_cases, closure_target, time_target)
    glob = rates.agg(
        F.max(F.when(total, rate)).alias("closure_rate"), F.max(F.when(total, mean)).alias("avg_days"),
        F.min(F.when(borough, F.struct(F.round(rate, 1).alias("rate"), "borough"))).alias("worst"),
        F.min(F.when(attention, F.struct(F.when(high, 0).otherwise(1), rate, "complaint_category"))).alias("first"),
    )

    def rule(no, rid, subject, fire):
        return F.struct(F.lit(no).alias("rule_no"), F.lit(rid).alias("rule_id"),
                        subject.cast("string").alias("subject"), fire.alias("fire"))
    none = F.lit(None)
    rules = glob.select(F.explode(F.array(
        rule(1, "closure_followup", none, F.col("closure_rate") < closure_goal),
        rule(2, "time_taskforce", none, F.col("avg_days") > time_goal),
        rule(3, "borough_focus", F.col("worst.borough"), F.col("worst.rate") < borough_floor),
        rule(4, "critical_category", F.col("first.complaint_category"), F.col("first").isNotNull()),
        rule(5, "ml_triage", none, F.lit(True)),
    )).alias("r")).select("r.*")
    return rules.filter(F.coalesce(F.col("fire"), F.lit(False))).drop("fire").orderBy("rule_no")


def system_score(df: DataFrame) -> DataFrame:
    """0-100 score from closure, mean time, volume and priority, with label."""
    k = headline_kpis(df)
    rate, mean = F.col("closure_rate"), F.col("avg_response_days")
    vol, prate = F.col("total_records"), F.col("priority_rate")
    closure_pts = (F.when(rate >= 75, 25).when(rate >= 70, 20).when(rate >= 65, 15)
                   .when(rate >= 60, 10).otherwise(0))
    time_pts = (F.when(mean <= 1.5, 25).when(mean <= 2.0, 20).when(mean <= 3.0, 15)
                .when(mean <= 5.0, 10).otherwise(0))
    volume_pts = F.when(vol >= 10000, 25).when(vol >= 5000, 20).when(vol >= 1000, 15).otherwise(0)
    prio_pts = F.when(prate >= 80, 25).when(prate >= 70, 20).when(prate >= 60, 15).otherwise(0)
    out = k.select("closure_rate", "avg_response_days", "total_records", "priority_rate",
                   closure_pts.alias("closure_points"), time_pts.alias("time_points"),
                   volume_pts.alias("volume_points"), prio_pts.alias("priority_points"))
    score = F.col("closure_points") + F.col("time_points") + F.col("volume_points") \
        + F.col("priority_points")
    out = out.withColumn("score", score)
    return out.withColumn("status", F.when(score >= 90, S.SYSTEM_EXCELLENT)
                          .when(score >= 75, S.SYSTEM_GOOD).when(score >= 60, S.SYSTEM_FAIR)
                          .otherwise(S.SYSTEM_CRITICAL))
