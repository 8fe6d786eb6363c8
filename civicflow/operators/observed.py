"""The cleaning report observed on the cleaning chain itself.

Three observation points sit on one chain: the raw rows, the rows before the
outlier filter, and the clean rows.  Whatever action runs the chain (usually
the write) fills them, so the report costs no further pass.

A task that runs again after its first success would be counted twice where
the points lie before a shuffle (lost shuffle files bring such a run).  So the
rows are dealt out by month first, and all points stand in the stage that
writes, whose tasks count once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.expressions import is_closed
from . import cleaning as C

DAYS = "response_time_days"


def census(columns: list[str], prefix: str) -> list[Column]:
    """A17 as aggregates: rows, and NULLs of every column."""
    return [F.count(F.lit(1)).alias(f"{prefix}_rows")] + [
        F.count_if(F.col(f"`{c}`").isNull()).alias(f"{prefix}{i}") for i, c in enumerate(columns)]


def profile() -> list[Column]:
    """A14 and the parts of A12 and A18 that are sums: bounded state for each task.

    Boroughs and types are dictionary columns; their few values are gathered
    for an exact number of distinct ones.
    """
    closed = is_closed("status")
    days = F.when(closed, F.col(DAYS))
    return [
        F.count(F.lit(1)).alias("total_records"),
        F.min("created_date").alias("date_start"), F.max("created_date").alias("date_end"),
        F.count_if(closed).alias("closed_records"),
        F.count_if(~F.coalesce(closed, F.lit(False))).alias("open_records"),
        F.size(F.collect_set("borough")).alias("n_boroughs"),
        F.size(F.collect_set("complaint_type")).alias("n_complaint_types"),
        F.avg(days).alias("mean_days"), F.min(days).alias("min_days"), F.max(days).alias("max_days"),
        F.stddev_samp(days).alias("std_days"),
        F.mode("created_weekday", True).alias("busiest_weekday"),
        F.mode("created_hour", True).alias("busiest_hour"),
        F.mode("created_month", True).alias("busiest_month"),
    ]


@dataclass
class ObservedCleaning:
    """The clean rows and the points that an action on them fills."""
    clean: DataFrame
    raw_columns: list[str]
    points: tuple[Observation, Observation, Observation]

    def report(self) -> dict:
        """Waits for an action on ``clean`` and returns its numbers."""
        raw, removed, clean = (p.get for p in self.points)
        before = {c: raw[f"raw{i}"] for i, c in enumerate(self.raw_columns)}
        after = {c: clean[f"clean{i}"] for i, c in enumerate(self.clean.columns)}
        profile_keys = ("total_records", "date_start", "date_end", "closed_records", "n_boroughs", "n_complaint_types")
        share = clean["closed_records"] * 100.0 / clean["total_records"] if clean["total_records"] else None
        return {
            "rows_read": raw["raw_rows"], "rows_written": clean["clean_rows"], "outliers_removed": removed["outliers"],
            "nulls_before": before, "nulls_after": after,
            "null_total_before": sum(before.values()), "null_total_after": sum(after.values()),
            "profile": {k: clean[k] for k in profile_keys} | {"pct_closed": share},
            "response_time": {k: clean[k] for k in ("closed_records", "mean_days", "min_days", "max_days", "std_days")},
            "summary": {k: clean[k] for k in ("open_records", "busiest_weekday", "busiest_hour", "busiest_month")},
        }


def observe_cleaning(raw: DataFrame, max_days: float = 90) -> ObservedCleaning:
    """P18 on ``raw``, dealt out by creation month, with its observation points.

    The clean rows are ready to be written partitioned by year and month
    without another shuffle (``write_table(..., rebalance=False)``).
    """
    points = tuple(Observation(f"cleaning_{name}") for name in ("raw", "outliers", "clean"))
    month = {"_year": F.year("created_date"), "_month": F.month("created_date")}
    dealt = raw.withColumns(month).hint("rebalance", *month).drop(*month)
    dealt = dealt.observe(points[0], *census(raw.columns, "raw"))
    timed = C.calculate_response_time(C.normalize_dates(dealt))
    timed = timed.observe(points[1], F.count_if(C.outlier_predicate(max_days)).alias("outliers"))
    clean = (timed.transform(C.translate_data)
                  .transform(C.clean_outliers, max_days)
                  .transform(C.standardize_categories)
                  .transform(C.handle_missing_values)
                  .transform(C.add_derived_features))
    clean = clean.observe(points[2], *census(clean.columns, "clean"), *profile())
    return ObservedCleaning(clean, list(raw.columns), points)
