"""Named result sets of the reference's entry points, as dicts of lazy DataFrames.

Each function only composes operators of the library; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import cleaning as C
from ..operators import diagnostics as D
from ..operators import explore as X
from ..sources.tickets import write_with_count
from . import performance as P


def all_aggregates(df: DataFrame, top_n: int = 15, cell: float = 0.01) -> dict[str, DataFrame]:
    """Every exploration aggregate behind the charts."""
    return {
        "complaints_by_type": X.top_counts(df, "complaint_type", top_n),
        "complaints_by_borough": X.distribution(df, "borough"),
        "response_time_by_category": X.box_summary(df),
        "weekday": X.weekday_histogram(df),
        "hour": X.hour_histogram(df),
        "month": X.month_histogram(df),
        "period": X.period_histogram(df),
        "borough_category_matrix": X.borough_category_matrix(df),
        "density_grid": X.density_grid(df, cell),
        "summary": X.summary_stats(df),
    }


def overview_page(df: DataFrame) -> dict[str, DataFrame]:
    """Overview: KPIs, borough shares, top-10 types."""
    return {
        "kpis": X.overview_kpis(df),
        "boroughs": X.distribution(df, "borough"),
        "top_types": X.top_counts(df, "complaint_type", 10),
    }


def temporal_page(df: DataFrame, borough: str | None = None,
                  category: str | None = None) -> dict[str, DataFrame]:
    """Temporal page: filter choices, daily series, weekday and hour patterns."""
    sel = C.filter_selection(df, borough, category)
    return {
        "boroughs": X.distinct_values(df, "borough"),
        "categories": X.distinct_values(df, "complaint_category"),
        "daily": X.daily_counts(sel),
        "weekday": X.weekday_histogram(sel),
        "hour": X.hour_histogram(sel),
    }


def response_page(df: DataFrame) -> dict[str, DataFrame]:
    """Response page: KPIs, box summary, borough x category matrix."""
    return {
        "kpis": X.response_kpis(df),
        "box": X.box_summary(df),
        "matrix": X.borough_category_matrix(df),
    }


def diagnostics_page(df: DataFrame) -> dict[str, DataFrame]:
    """Diagnostics page (D1-D5): the rate table is worked out once and all five read it.

    It has a row for each borough, each category and the total, and stays
    cached (``page["rates"].unpersist()`` releases it).
    """
    rates = D.rate_table(df).cache()
    return {
        "kpis": D.headline_kpis(rates),
        "boroughs": D.borough_scorecard(rates),
        "attention": D.category_attention(rates),
        "recommendations": D.recommendations(rates),
        "score": D.system_score(rates),
        "rates": rates,
    }


def sql_page(df: DataFrame) -> dict[str, DataFrame]:
    """The dashboard's query forms."""
    return P.run_dashboard(df)


def save_data(df: DataFrame, path: str, fmt: str = "parquet") -> dict:
    """Write a ticket table and return its profile (IO3 + A14): one write job
    with the row count observed on it, then one aggregate for the profile."""
    rows = write_with_count(df, path, fmt)
    return {"rows": rows, "profile": X.dataset_profile(df)}
