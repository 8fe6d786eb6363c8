"""Registered cleaning operators (P1-P23) and SQL-family I/O (IO6, IO7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expressions import is_closed
from ..operators import cleaning as C
from ..sources.bindings import requests_ev, requests_ord
from ..sources.tickets import load_table, row_count, run_sql
from . import oracle_sql as O
from .registry import CK, R, SQL, ev_clean, ord_clean, register, round_doubles, sql_round


def _ev_dated(s, d):
    return C.calculate_response_time(C.normalize_dates(requests_ev(s, d)))


def _ord_dated(s, d):
    return C.calculate_response_time(C.normalize_dates(requests_ord(s, d)))


# The whole clean tables.
register("P18_clean_pipeline_ev", O.with_ev_clean("SELECT * FROM clean"))(ev_clean)
register("P18_clean_pipeline_ord", O.with_ord_clean("SELECT * FROM clean"))(ord_clean)

# Dates, parts, weekday name, period.
_DATE_COLS = ["unique_key", "created_date", "closed_date", "created_year", "created_month",
              "created_day", "created_weekday", "created_hour", "created_period"]
register("P1_P4_normalize_dates_ev",
         O.with_ev_timed(f"SELECT {', '.join(_DATE_COLS)} FROM dated"))(
    lambda s, d: C.normalize_dates(requests_ev(s, d)).select(*_DATE_COLS))
register("P1_P4_normalize_dates_ord",
         O.with_ord_timed(f"SELECT {', '.join(_DATE_COLS)} FROM dated"))(
    lambda s, d: C.normalize_dates(requests_ord(s, d)).select(*_DATE_COLS))

# P5: dictionary translation with fallback.
_TR_COLS = ["unique_key", "borough", "complaint_type", "status", "created_weekday"]
register("P5_translate_ev", O.with_ev_translated(f"SELECT {', '.join(_TR_COLS)} FROM translated"))(
    lambda s, d: C.translate_data(_ev_dated(s, d)).select(*_TR_COLS))

# Response time in hours and days.
_RT_COLS = ["unique_key", "status", "response_time_hours", "response_time_days"]
register("P6_response_time_ev", O.with_ev_timed(f"SELECT {', '.join(_RT_COLS)} FROM timed"))(
    lambda s, d: _ev_dated(s, d).select(*_RT_COLS))
register("P6_response_time_ord", O.with_ord_timed(f"SELECT {', '.join(_RT_COLS)} FROM timed"))(
    lambda s, d: _ord_dated(s, d).select(*_RT_COLS))

# Outlier rule; on OR with the default 90 days, on EV with 10 days.
for _tag, _dated, _timed, _days in (("ord", _ord_dated, O.with_ord_timed, 90),
                                    ("ev", _ev_dated, O.with_ev_timed, 10)):
    register(f"P7_clean_outliers_{_tag}_{_days}d", _timed(
        f"SELECT unique_key, {R} FROM timed WHERE NOT COALESCE({R} > {_days}.0::DOUBLE, false)"))(
        lambda s, d, _f=_dated, _m=_days: C.clean_outliers(_f(s, d), _m).select("unique_key", R))
    register(f"P8_outlier_count_{_tag}_{_days}d", _timed(
        f"SELECT COUNT(CASE WHEN {R} > {_days}.0::DOUBLE THEN 1 END) AS outliers_removed FROM timed"))(
        lambda s, d, _f=_dated, _m=_days: C.count_outliers(_f(s, d), _m))

# Category roll-up (after translation, as in the pipeline).
register("P9_standardize_categories_ev", O.with_ev_clean(
    "SELECT unique_key, complaint_type, complaint_category FROM categorized"))(
    lambda s, d: C.standardize_categories(C.clean_outliers(C.translate_data(_ev_dated(s, d))))
    .select("unique_key", "complaint_type", "complaint_category"))

# Zip defaults, drop missing coordinates.
register("P10_fill_zip_ev", O.with_ev_clean(
    "SELECT unique_key, borough, zip_code FROM filled"))(
    lambda s, d: C.handle_missing_values(C.standardize_categories(
        C.clean_outliers(C.translate_data(_ev_dated(s, d))))).select("unique_key", "borough", "zip_code"))
register("P11_drop_missing_coordinates_ev", O.with_ev_raw(
    "SELECT unique_key, latitude, longitude FROM raw "
    "WHERE latitude IS NOT NULL AND longitude IS NOT NULL"))(
    lambda s, d: C.drop_missing_coordinates(requests_ev(s, d))
    .select("unique_key", "latitude", "longitude"))

# Derived flags.
_FEAT = ["unique_key", "is_weekend", "quarter", "is_business_hours", "is_priority"]
register("P12_P15_derived_features_ev", O.with_ev_clean(f"SELECT {', '.join(_FEAT)} FROM clean"))(
    lambda s, d: ev_clean(s, d).select(*_FEAT))
register("P12_P15_derived_features_ord", O.with_ord_clean(f"SELECT {', '.join(_FEAT)} FROM clean"))(
    lambda s, d: ord_clean(s, d).select(*_FEAT))

# Model rows.
_P16 = f"SELECT unique_key, {R} FROM clean WHERE {CK} AND {R} > 0 AND {R} <= 90.0::DOUBLE"
register("P16_model_rows_ev", O.with_ev_clean(_P16))(
    lambda s, d: C.model_rows(ev_clean(s, d)).select("unique_key", R))
register("P16_model_rows_ord", O.with_ord_clean(_P16))(
    lambda s, d: C.model_rows(ord_clean(s, d)).select("unique_key", R))

# Optional equality filters on borough and category.
register("P17_filter_selection_ev", O.with_ev_clean(
    "SELECT unique_key, borough, complaint_category FROM clean "
    "WHERE borough = 'Manhattan' AND complaint_category = 'Ruído'"))(
    lambda s, d: C.filter_selection(ev_clean(s, d), borough="Manhattan", category="Ruído")
    .select("unique_key", "borough", "complaint_category"))
register("P17_filter_selection_all_ev", O.with_ev_clean(
    "SELECT unique_key, borough FROM clean WHERE borough = 'Queens'"))(
    lambda s, d: C.filter_selection(ev_clean(s, d), borough="Queens", category="Todas")
    .select("unique_key", "borough"))

# Resolution bucket of closed tickets with a known time.
register("P19_resolution_bucket_ev", O.with_ev_clean(
    f"SELECT unique_key, CASE WHEN {R} <= 1 THEN '24h' WHEN {R} <= 2 THEN '48h' "
    f"WHEN {R} <= 7 THEN '7d' WHEN {R} <= 30 THEN '30d' ELSE '30d+' END AS resolution_period "
    f"FROM clean WHERE {CK}"))(
    lambda s, d: C.with_resolution_bucket(ev_clean(s, d).filter(
        is_closed("status") & F.col(R).isNotNull())).select("unique_key", "resolution_period"))

# P21-P23 applied to the observed response time: floor/default, class, context flags.
register("P21_P23_response_class_ev", O.with_ev_clean(sql_round(
    f"SELECT unique_key, CASE WHEN {R} IS NULL OR isnan({R}) THEN 3.0::DOUBLE "
    f"ELSE greatest(0.1::DOUBLE, {R}) END AS floored_days, "
    f"CASE WHEN {R} <= 1 THEN 'fast' WHEN {R} <= 7 THEN 'moderate' ELSE 'slow' END AS response_class, "
    f"is_priority, (created_hour < 6 OR created_hour > 22) AS off_hours FROM clean",
    ["floored_days"])))(
    lambda s, d: round_doubles(ev_clean(s, d).select(
        "unique_key", C.floor_prediction(R).alias("floored_days"),
        C.response_class(R).alias("response_class"), "is_priority",
        C.off_hours("created_hour").alias("off_hours"))))

# IO6: post-load row count; IO7: the SQL text of Q1 run with parameters.
register("IO6_row_count_ev", O.with_ev_clean("SELECT COUNT(*) AS row_count FROM clean"))(
    lambda s, d: row_count(ev_clean(s, d)))

_IO7_TEXT = """
SELECT borough, created_hour, COUNT(*) AS n_tickets,
       COUNT_IF(response_time_days > :slow_days) AS n_slow,
       MIN(response_time_days) AS fastest_days
FROM tickets
WHERE created_hour >= :from_hour
GROUP BY borough, created_hour
"""


def _io7(s, d):
    load_table(s, ev_clean(s, d))
    return run_sql(s, _IO7_TEXT, {"slow_days": 2.5, "from_hour": 8})


register("IO7_sql_text_hours_ev", O.with_ev_clean(
    _IO7_TEXT.replace("tickets\n", "clean\n").replace(":slow_days", "2.5::DOUBLE").replace(":from_hour", "8")))(_io7)


# P1 on text: dates rendered as text (full microseconds) and parsed back; the
# oracle is the original timestamps.
def _p1_text(s, d):
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    raw = requests_ev(s, d).select(
        "unique_key", F.date_format("created_date", fmt).alias("created_date"),
        F.date_format("closed_date", fmt).alias("closed_date"))
    return C.parse_dates(raw, strict=True)


register("P1_parse_text_dates_ev", O.with_ev_raw(
    "SELECT unique_key, created_date, closed_date FROM raw"))(_p1_text)


# IO1/IO3 and IO2/IO4: write then read back through the library's sources and
# sinks (files under the shared checkpoint folder); the oracle is the view.
def _io_path(s, tag):
    import uuid
    from ..session import ensure_checkpoint_dir, shared_path
    ensure_checkpoint_dir(s)
    return shared_path(s, f"io_check/{tag}-{uuid.uuid4().hex}")


def _raw_parquet_round_trip(s, d):
    from .. import schema as S
    from ..sources.tickets import read_raw, write_table
    raw = requests_ev(s, d)
    full = raw.select(*[F.col(f.name) if f.name in raw.columns
                        else F.lit(None).cast(f.dataType).alias(f.name) for f in S.RAW.fields])
    path = write_table(full, _io_path(s, "raw"))
    return read_raw(s, path).select(*raw.columns)


def _clean_csv_round_trip(view):
    def run(s, d):
        from ..sources.tickets import read_clean, write_table
        path = write_table(view(s, d), _io_path(s, "clean_csv"), fmt="csv")
        return read_clean(s, path, fmt="csv")
    return run


def _durable_table(s, d):
    import uuid
    from ..sources.tickets import load_table
    name = f"tickets_{uuid.uuid4().hex}"
    return load_table(s, ev_clean(s, d), name, durable=True)


def _exported(s, d):
    """IO8: all six named results written as CSV, every file read back in its declared types."""
    from ..sources.tickets import export_results
    from .performance import run_all
    results = run_all(ev_clean(s, d), monthly_input=ord_clean(s, d))
    written = export_results(results, _io_path(s, "export"))
    return {name: s.read.schema(results[name].schema).option("header", True)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path) for name, path in written.items()}


def _exported_values(s, d):
    from .performance import long_form
    return long_form(_exported(s, d))


def _replaced_table(s, d):
    """IO5: a table loaded with the closed tickets, then replaced by all of them."""
    import uuid
    from ..functions.expressions import is_closed
    from ..sources.tickets import drop_old_loads, load_table
    name = f"tickets_{uuid.uuid4().hex}"
    clean = ev_clean(s, d)
    before = load_table(s, clean.filter(is_closed("status")), name, durable=True)
    load_table(s, clean, name, durable=True)
    # The reader of the first load still finds its rows.
    old = before.groupBy("borough").agg(F.count(F.lit(1)).alias("n")).withColumn("load", F.lit("first"))
    new = s.table(name).groupBy("borough").agg(F.count(F.lit(1)).alias("n")).withColumn("load", F.lit("second"))
    return new.unionByName(old).select("load", "borough", "n")


def _observed_census(s, d):
    """A17 around the cleaning, P8 and A14, all observed on the write."""
    from ..operators.observed import observe_cleaning
    from ..sources.tickets import write_table
    observed = observe_cleaning(requests_ev(s, d))
    write_table(observed.clean, _io_path(s, "observed"), partition_by=["created_year", "created_month"], rebalance=False)
    r = observed.report()
    rows = [("before", c, n) for c, n in r["nulls_before"].items()] + [("after", c, n) for c, n in r["nulls_after"].items()]
    rows += [("before", "total", r["null_total_before"]), ("after", "total", r["null_total_after"]),
             ("rows", "read", r["rows_read"]), ("rows", "written", r["rows_written"]), ("rows", "outliers", r["outliers_removed"])]
    rows += [("profile", k, r["profile"][k]) for k in ("closed_records", "n_boroughs", "n_complaint_types")]
    return s.createDataFrame(rows, "stage string, column_name string, n long")


def _clean_by_selection(s, d):
    """P17 on files clustered by borough and category: the filter skips row groups."""
    from ..sources.tickets import read_clean, write_table
    path = write_table(ev_clean(s, d), _io_path(s, "clustered"), partition_by=["created_year", "created_month"],
                       cluster_by=["borough", "complaint_category"])
    return C.filter_selection(read_clean(s, path), "Queens", "Ruído").select("unique_key", "borough", "complaint_category")


def _stored_distinct(s, d):
    """A14 from stored monthly sketches beside the exact numbers."""
    from ..sources.sketches import COLUMNS, distinct_estimates, write_sketches
    clean = ev_clean(s, d)
    path = write_sketches(clean, _io_path(s, "sketches"))
    exact = clean.agg(*[F.count_distinct(c).alias(c) for c in COLUMNS]).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_exact")) for c in COLUMNS])).alias("e")).select("e.*")
    near = F.abs(F.col("n_distinct") - F.col("n_exact")) <= 0.02 * F.col("n_exact")
    return distinct_estimates(s, path).join(exact, "column_name").select("column_name", "n_exact", near.alias("within_2_percent"))


register("IO1_IO3_raw_parquet_round_trip_ev", O.with_ev_raw("SELECT * FROM raw"))(
    _raw_parquet_round_trip)
register("IO2_IO4_clean_csv_round_trip_ev", O.with_ev_clean("SELECT * FROM clean"))(
    _clean_csv_round_trip(ev_clean))
register("IO2_IO4_clean_csv_round_trip_ord", O.with_ord_clean("SELECT * FROM clean"))(
    _clean_csv_round_trip(ord_clean))
register("IO5_durable_table_ev", O.with_ev_clean("SELECT * FROM clean"))(_durable_table)
register("IO5_replaced_table_ev", O.with_ev_clean(
    "SELECT 'second' AS load, borough, COUNT(*) AS n FROM clean GROUP BY borough UNION ALL "
    f"SELECT 'first', borough, COUNT(*) FROM clean WHERE {O.CLOSED} GROUP BY borough"))(_replaced_table)
register("IO8_export_round_trip_ev", SQL["Q4_borough_performance"])(lambda s, d: _exported(s, d)["borough_performance"])
register("IO8_export_all_values", SQL["Q7_run_all_values"])(_exported_values)

_RAW_NAMES = ["unique_key", "created_date", "closed_date", "complaint_type", "borough", "zip_code", "latitude", "longitude", "status"]


def _nulls(stage: str, names: list[str], source: str) -> str:
    each = [f"SELECT '{stage}' AS stage, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS n FROM {source}" for c in names]
    total = " + ".join(f"COUNT(*) - COUNT({c})" for c in names)
    return "\nUNION ALL\n".join(each + [f"SELECT '{stage}', 'total', {total} FROM {source}"])


def _census_oracle() -> str:
    from .. import schema as S
    return O.with_ev_clean("\nUNION ALL\n".join([
        _nulls("before", _RAW_NAMES, "raw"), _nulls("after", _RAW_NAMES + [f.name for f in S.CLEAN_ADDED.fields], "clean"),
        "SELECT 'rows', 'read', COUNT(*) FROM raw", "SELECT 'rows', 'written', COUNT(*) FROM clean",
        "SELECT 'rows', 'outliers', COUNT(*) FROM raw WHERE date_diff('microsecond', created_date, closed_date) / 86400000000.0::DOUBLE > 90",
        f"SELECT 'profile', 'closed_records', COUNT(*) FROM clean WHERE {O.CLOSED}",
        "SELECT 'profile', 'n_boroughs', COUNT(DISTINCT borough) FROM clean",
        "SELECT 'profile', 'n_complaint_types', COUNT(DISTINCT complaint_type) FROM clean"]))


register("A14_A17_P8_observed_cleaning_ev", _census_oracle())(_observed_census)
register("P17_filter_clustered_ev", O.with_ev_clean(
    "SELECT unique_key, borough, complaint_category FROM clean WHERE borough = 'Queens' AND complaint_category = 'Ruído'"))(
    _clean_by_selection)
register("A14_A19_stored_distinct_ev", O.with_ev_clean("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS n_exact, true AS within_2_percent FROM clean"
    for c in ("borough", "complaint_type", "complaint_category", "zip_code", "unique_key"))))(_stored_distinct)
