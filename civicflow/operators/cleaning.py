"""Cleaning and enrichment.

Every step is a narrow ``DataFrame -> DataFrame`` transform (row-wise
expressions or filters), so the whole pipeline is one stage with no shuffle
and also accepts a streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.expressions import (
    category_of, day_period, duration_hours, is_closed, literal_map, translate,
    weekday_index, weekday_name,
)

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_dates(df: DataFrame, strict: bool = True,
                cols: tuple[str, ...] = ("created_date", "closed_date")) -> DataFrame:
    """Text to NTZ timestamp.  ``strict`` raises on bad text; else NULL."""
    out = {}
    for c in cols:
        if c not in df.columns or df.schema[c].dataType.typeName() != "string":
            continue
        text = F.col(c)
        if strict:
            out[c] = F.to_timestamp_ntz(text)
        else:
            out[c] = text.try_cast("timestamp_ntz")
    return df.withColumns(out) if out else df


def normalize_dates(df: DataFrame) -> DataFrame:
    """Parse dates, add year/month/day/weekday/hour and the day period."""
    df = parse_dates(df)
    c = F.col("created_date")
    df = df.withColumns({
        "created_year": F.year(c),
        "created_month": F.month(c),
        "created_day": F.dayofmonth(c),
        "created_weekday": weekday_name(c),
        "created_hour": F.hour(c),
    })
    return df.withColumn("created_period", day_period("created_hour"))


def calculate_response_time(df: DataFrame) -> DataFrame:
    """Response time in hours and days for closed tickets, else NULL."""
    hours = F.when(is_closed("status"), duration_hours("created_date", "closed_date"))
    return df.withColumn("response_time_hours", hours) \
        .withColumn("response_time_days", F.col("response_time_hours") / F.lit(24.0))


def translate_data(df: DataFrame) -> DataFrame:
    """P5: borough, type, status and weekday to Portuguese, fallback to input."""
    mapping = {
        "borough": S.BOROUGH_TRANSLATION,
        "complaint_type": S.COMPLAINT_TYPE_TRANSLATION,
        "status": S.STATUS_TRANSLATION,
        "created_weekday": S.WEEKDAY_TRANSLATION,
    }
    return df.withColumns({c: translate(c, m) for c, m in mapping.items() if c in df.columns})


def outlier_predicate(max_days: float = 90) -> Column:
    return F.col("response_time_days") > F.lit(float(max_days))


def clean_outliers(df: DataFrame, max_days: float = 90) -> DataFrame:
    """Drop rows over ``max_days``; unknown times are kept."""
    return df.filter(~F.coalesce(outlier_predicate(max_days), F.lit(False)))


def count_outliers(df: DataFrame, max_days: float = 90) -> DataFrame:
    """Number of rows P7 removes, as a one-row DataFrame."""
    return df.agg(F.count_if(outlier_predicate(max_days)).alias("outliers_removed"))


def standardize_categories(df: DataFrame) -> DataFrame:
    """Translated type to category, default ``Outros``."""
    return df.withColumn("complaint_category", category_of("complaint_type"))


def fill_zip(df: DataFrame) -> DataFrame:
    """P10: null zip from the borough default, matched on upper case (S3)."""
    if "zip_code" not in df.columns:
        return df
    default = literal_map(S.BOROUGH_ZIP_DEFAULTS)[F.upper(F.col("borough"))]
    return df.withColumn("zip_code", F.coalesce(F.col("zip_code"), default.cast("int")))


def drop_missing_coordinates(df: DataFrame) -> DataFrame:
    """Drop rows with any null coordinate (columns that exist)."""
    subset = [c for c in ("latitude", "longitude") if c in df.columns]
    return df.dropna(how="any", subset=subset) if subset else df


def handle_missing_values(df: DataFrame) -> DataFrame:
    """P10 + P11."""
    return drop_missing_coordinates(fill_zip(df))


def add_derived_features(df: DataFrame) -> DataFrame:
    """Weekend, quarter, business hours, priority.

    A view that already carries ``is_priority`` (the order binding) keeps it;
    otherwise priority is membership of the translated type.
    """
    c = F.col("created_date")
    weekend = weekday_index(c) >= 5
    hour = F.col("created_hour") if "created_hour" in df.columns else F.hour(c)
    cols = {
        "is_weekend": weekend,
        "quarter": F.quarter(c),
        "is_business_hours": hour.between(9, 17) & ~weekend,
    }
    if "is_priority" not in df.columns:
        cols["is_priority"] = F.col("complaint_type").isin(S.PRIORITY_TYPES)
    return df.withColumns(cols)


def model_rows(df: DataFrame, max_days: float = 90) -> DataFrame:
    """Closed, known and ``0 < days <= max_days``."""
    d = F.col("response_time_days")
    return df.filter(is_closed("status") & d.isNotNull() & (d > 0) & (d <= F.lit(float(max_days))))


def filter_selection(df: DataFrame, borough: str | None = None,
                     category: str | None = None) -> DataFrame:
    """Optional equality filters; ``None`` / ``"all"`` means no filter."""
    all_words = {None, "all", "Todos", "Todas"}
    if borough not in all_words:
        df = df.filter(F.col("borough") == borough)
    if category not in all_words:
        df = df.filter(F.col("complaint_category") == category)
    return df


def clean_pipeline(df: DataFrame, max_days: float = 90) -> DataFrame:
    """The eight cleaning steps in their fixed order."""
    return (df.transform(normalize_dates)
              .transform(calculate_response_time)
              .transform(translate_data)
              .transform(clean_outliers, max_days)
              .transform(standardize_categories)
              .transform(handle_missing_values)
              .transform(add_derived_features))


# ---- small scalar operators used by the dashboard and the model ----------

def with_resolution_bucket(df: DataFrame, days: str = "response_time_days") -> DataFrame:
    """P19 as a column."""
    from ..functions.expressions import resolution_bucket
    return df.withColumn("resolution_period", resolution_bucket(days))


def response_class(pred: str | Column) -> Column:
    """Predicted days to class fast (<=1) / moderate (<=7) / slow."""
    p = F.col(pred) if isinstance(pred, str) else pred
    return F.when(p <= 1, "fast").when(p <= 7, "moderate").otherwise("slow")


def off_hours(hour: str | Column = "created_hour") -> Column:
    """Hour < 6 or hour > 22."""
    h = F.col(hour) if isinstance(hour, str) else hour
    return (h < 6) | (h > 22)


def floor_prediction(pred: str | Column, floor: float = 0.1, default: float = 3.0) -> Column:
    """``max(floor, p)``, ``default`` when no prediction."""
    p = F.col(pred) if isinstance(pred, str) else pred
    return F.when(p.isNull() | F.isnan(p), F.lit(default)).otherwise(F.greatest(F.lit(floor), p))
