"""Registered exploration aggregates."""

from __future__ import annotations

from .. import schema as S
from ..operators import explore as X
from ..sources.bindings import requests_ev
from . import oracle_sql as O
from .registry import CK, R, cont, ev_clean, ord_clean, register, round_doubles, sql_round

CL = O.CLOSED
Q = O.q

# A1: top-N value counts (n = 15 types; n = 10 dashboard; n = 5 in the reports).
for _n in (15, 10, 5):
    register(f"A1_top_complaint_types_{_n}_ev", O.with_ev_clean(
        f'SELECT complaint_type, COUNT(*) AS "count" FROM clean WHERE complaint_type IS NOT NULL '
        f'GROUP BY complaint_type ORDER BY "count" DESC, complaint_type LIMIT {_n}'))(
        lambda s, d, _k=_n: X.top_counts(ev_clean(s, d), "complaint_type", _k))

# A2: distributions with percent share (denominator: all rows).
for _c in ("borough", "status", "complaint_category"):
    register(f"A2_{_c}_distribution_ev", cont(O.with_ev_clean(
        f", counts AS (SELECT {_c}, COUNT(*) AS cnt FROM clean GROUP BY {_c}),\n"
        f'shares AS (SELECT {_c}, cnt AS "count", cnt * 100.0::DOUBLE / SUM(cnt) OVER () AS pct '
        f"FROM counts)\n" + sql_round(f"SELECT * FROM shares WHERE {_c} IS NOT NULL", ["pct"]))))(
        lambda s, d, _k=_c: round_doubles(X.distribution(ev_clean(s, d), _k)))

# A3: box-plot summary per category (EV) and per type (OR).
def _box_sql(by: str) -> str:
    return f""", base AS (
  SELECT {by}, {R} AS v FROM clean WHERE {CK}
),
st AS (
  SELECT {by}, COUNT(*) AS n, MIN(v) AS mn, MAX(v) AS mx,
         QUANTILE_CONT(v, 0.25) AS q1, MEDIAN(v) AS med, QUANTILE_CONT(v, 0.75) AS q3
  FROM base GROUP BY {by}
),
fe AS (
  SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS lf, q3 + 1.5::DOUBLE * (q3 - q1) AS uf FROM st
)
SELECT f.{by}, f.n,
       ROUND(f.mn, 6) AS "min", ROUND(f.q1, 6) AS q1, ROUND(f.med, 6) AS median,
       ROUND(f.q3, 6) AS q3, ROUND(f.mx, 6) AS "max",
       ROUND(f.lf, 6) AS lower_fence, ROUND(f.uf, 6) AS upper_fence,
       ROUND(MIN(CASE WHEN b.v >= f.lf THEN b.v END), 6) AS lower_whisker,
       ROUND(MAX(CASE WHEN b.v <= f.uf THEN b.v END), 6) AS upper_whisker,
       COUNT(CASE WHEN b.v < f.lf OR b.v > f.uf THEN 1 END) AS n_outliers
FROM fe f JOIN base b ON b.{by} IS NOT DISTINCT FROM f.{by}
GROUP BY f.{by}, f.n, f.mn, f.q1, f.med, f.q3, f.mx, f.lf, f.uf
ORDER BY f.{by}"""


register("A3_box_summary_category_ev", cont(O.with_ev_clean(_box_sql("complaint_category"))))(
    lambda s, d: X.box_summary(ev_clean(s, d), "complaint_category", digits=6))
register("A3_box_summary_type_ord", cont(O.with_ord_clean(_box_sql("complaint_type"))))(
    lambda s, d: X.box_summary(ord_clean(s, d), "complaint_type", digits=6))

# A4: weekday histogram on a 7-day spine, zero filled.
_SPINE = ", ".join(f"({i}, {Q(lbl)})" for i, lbl in enumerate(S.WEEKDAY_TRANSLATION.values()))
register("A4_weekday_histogram_ev", cont(O.with_ev_clean(f""", spine(weekday_num, created_weekday) AS (
  VALUES {_SPINE}
),
counts AS (
  SELECT CAST(isodow(created_date) - 1 AS INTEGER) AS weekday_num, COUNT(*) AS cnt
  FROM clean GROUP BY 1
)
SELECT s.weekday_num, s.created_weekday, COALESCE(c.cnt, 0) AS "count"
FROM spine s LEFT JOIN counts c ON s.weekday_num = c.weekday_num
ORDER BY s.weekday_num""")))(lambda s, d: X.weekday_histogram(ev_clean(s, d)))

# Hour, month (with label) and period histograms.
register("A5_hour_histogram_ev", O.with_ev_clean(
    'SELECT created_hour, COUNT(*) AS "count" FROM clean WHERE created_hour IS NOT NULL '
    'GROUP BY created_hour ORDER BY created_hour'))(lambda s, d: X.hour_histogram(ev_clean(s, d)))
_MONTH_CASE = "CASE created_month " + " ".join(
    f"WHEN {i + 1} THEN {Q(m)}" for i, m in enumerate(S.MONTH_LABELS)) + " END"
register("A6_month_histogram_ord", O.with_ord_clean(
    f'SELECT created_month, {_MONTH_CASE} AS month_label, COUNT(*) AS "count" FROM clean '
    f'WHERE created_month IS NOT NULL GROUP BY created_month ORDER BY created_month'))(
    lambda s, d: X.month_histogram(ord_clean(s, d)))
register("A7_period_histogram_ev", O.with_ev_clean(
    'SELECT created_period, COUNT(*) AS "count" FROM clean WHERE created_period IS NOT NULL '
    'GROUP BY created_period'))(lambda s, d: X.period_histogram(ev_clean(s, d)))

# Borough x category mean response time, wide and long.
_CATS = list(S.CATEGORY_MAPPING.keys())
_PIVOT_COLS = ",\n       ".join(
    f"ROUND(AVG(CASE WHEN complaint_category = {Q(c)} THEN {R} END), 6) AS \"{c}\"" for c in _CATS)
register("A8_borough_category_matrix_ev", O.with_ev_clean(
    f"SELECT borough,\n       {_PIVOT_COLS}\nFROM clean WHERE {CK} AND borough IS NOT NULL "
    f"GROUP BY borough ORDER BY borough"))(
    lambda s, d: X.borough_category_matrix(ev_clean(s, d), digits=6))
register("A9_borough_category_long_ev", O.with_ev_clean(
    f"SELECT borough, complaint_category, ROUND(AVG({R}), 6) AS avg_response_days FROM clean "
    f"WHERE {CK} AND borough IS NOT NULL AND complaint_category IS NOT NULL "
    f"GROUP BY borough, complaint_category"))(
    lambda s, d: X.borough_category_long(ev_clean(s, d), digits=6))

# A10: density grid over all rows with coordinates.
register("A10_density_grid_ev", O.with_ev_clean(sql_round(
    "SELECT CAST(floor(latitude / 0.01::DOUBLE) AS BIGINT) AS lat_cell, "
    "CAST(floor(longitude / 0.01::DOUBLE) AS BIGINT) AS lon_cell, "
    "(CAST(floor(latitude / 0.01::DOUBLE) AS BIGINT) + 0.5::DOUBLE) * 0.01::DOUBLE AS lat_center, "
    "(CAST(floor(longitude / 0.01::DOUBLE) AS BIGINT) + 0.5::DOUBLE) * 0.01::DOUBLE AS lon_center, "
    f"COUNT(*) AS n_tickets, "
    f"SUM(CASE WHEN {R} IS NOT NULL THEN date_diff('microsecond', created_date, closed_date) END) "
    f"/ COUNT({R}) / 86400000000.0::DOUBLE AS avg_response_days FROM clean "
    "WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2",
    ["lat_center", "lon_center", "avg_response_days"])))(
    lambda s, d: round_doubles(X.density_grid(ev_clean(s, d))))

# Fixed-size seeded sample by md5 of seed and key.
register("A11_seeded_sample_ev", O.with_ev_clean(
    f"SELECT unique_key, latitude, longitude, {R} FROM clean "
    "ORDER BY md5('42:' || CAST(unique_key AS VARCHAR)), unique_key LIMIT 5000"))(
    lambda s, d: X.seeded_sample(ev_clean(s, d), n=5000, seed=42)
    .select("unique_key", "latitude", "longitude", R))

# One-row summary statistics.
_MODE = ("(SELECT {c} FROM clean WHERE {c} IS NOT NULL GROUP BY {c} "
         "ORDER BY COUNT(*) DESC, {c} LIMIT 1)")
register("A12_summary_stats_ev", O.with_ev_clean(f"""
SELECT COUNT(*) AS total_records,
       COUNT(CASE WHEN {CL} THEN 1 END) AS closed_records,
       COUNT(CASE WHEN NOT COALESCE({CL}, false) THEN 1 END) AS open_records,
       MIN(created_date) AS date_start, MAX(created_date) AS date_end,
       ROUND(AVG(CASE WHEN {CL} THEN {R} END), 6) AS mean_days,
       ROUND(MEDIAN(CASE WHEN {CL} THEN {R} END), 6) AS median_days,
       ROUND(MIN(CASE WHEN {CL} THEN {R} END), 6) AS min_days,
       ROUND(MAX(CASE WHEN {CL} THEN {R} END), 6) AS max_days,
       ROUND(STDDEV_SAMP(CASE WHEN {CL} THEN {R} END), 6) AS std_days,
       {_MODE.format(c='created_weekday')} AS busiest_weekday,
       {_MODE.format(c='created_hour')} AS busiest_hour,
       {_MODE.format(c='created_month')} AS busiest_month
FROM clean"""))(lambda s, d: X.summary_stats(ev_clean(s, d), digits=6))

# Daily counts on both views.
_A13 = 'SELECT CAST(created_date AS DATE) AS date, COUNT(*) AS "count" FROM clean GROUP BY 1 ORDER BY 1'
register("A13_daily_counts_ev", O.with_ev_clean(_A13))(lambda s, d: X.daily_counts(ev_clean(s, d)))
register("A13_daily_counts_ord", O.with_ord_clean(_A13))(lambda s, d: X.daily_counts(ord_clean(s, d)))

# Profile and KPI rows.
register("A14_dataset_profile_ev", O.with_ev_clean(sql_round(f"""
SELECT COUNT(*) AS total_records, MIN(created_date) AS date_start, MAX(created_date) AS date_end,
       COUNT(CASE WHEN {CL} THEN 1 END) AS closed_records,
       COUNT(DISTINCT borough) AS n_boroughs, COUNT(DISTINCT complaint_type) AS n_complaint_types,
       COUNT(CASE WHEN {CL} THEN 1 END) * 100.0::DOUBLE / COUNT(*) AS pct_closed
FROM clean""", ["pct_closed"])))(lambda s, d: round_doubles(X.dataset_profile(ev_clean(s, d))))
register("A15_overview_kpis_ev", O.with_ev_clean(sql_round(f"""
SELECT COUNT(*) AS total_records,
       COUNT(CASE WHEN {CL} THEN 1 END) * 100.0::DOUBLE / COUNT(*) AS closure_rate,
       AVG(CASE WHEN {CL} THEN {R} END) AS avg_response_days,
       COUNT(DISTINCT complaint_type) AS n_complaint_types
FROM clean""", ["closure_rate", "avg_response_days"])))(
    lambda s, d: round_doubles(X.overview_kpis(ev_clean(s, d))))
register("A16_response_kpis_ev", O.with_ev_clean(f"""
SELECT ROUND(AVG({R}), 6) AS mean_days, ROUND(MEDIAN({R}), 6) AS median_days, MAX({R}) AS max_days
FROM clean WHERE {CL}"""))(lambda s, d: X.response_kpis(ev_clean(s, d), digits=6))

# NULL census of the raw and the clean view.
_RAW_COLS = ["unique_key", "created_date", "closed_date", "complaint_type", "borough",
             "zip_code", "latitude", "longitude", "status"]


def _census_sql(cols, src):
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count FROM {src}" for c in cols)


register("A17_null_census_raw_ev", O.with_ev_raw(_census_sql(_RAW_COLS, "raw")))(
    lambda s, d: X.null_census(requests_ev(s, d)))
_CLEAN_COLS = _RAW_COLS + [f.name for f in S.CLEAN_ADDED.fields]
register("A17_null_census_clean_ev", O.with_ev_clean(_census_sql(_CLEAN_COLS, "clean")))(
    lambda s, d: X.null_census(ev_clean(s, d).select(*_CLEAN_COLS)))
register("A17_null_total_clean_ev", O.with_ev_clean(
    "SELECT SUM(null_count)::BIGINT AS total_nulls FROM (" + _census_sql(_CLEAN_COLS, "clean") + ")"))(
    lambda s, d: X.null_total(ev_clean(s, d).select(*_CLEAN_COLS)))

# Closed response-time block of the cleaning report.
register("A18_closed_time_stats_ev", O.with_ev_clean(f"""
SELECT COUNT(*) AS closed_records, ROUND(AVG({R}), 6) AS mean_days,
       ROUND(MEDIAN({R}), 6) AS median_days, ROUND(MIN({R}), 6) AS min_days,
       ROUND(MAX({R}), 6) AS max_days
FROM clean WHERE {CL}"""))(lambda s, d: X.closed_time_stats(ev_clean(s, d), digits=6))

# Distinct values (filters of the dashboard pages).
for _c in ("borough", "complaint_category"):
    register(f"A19_distinct_{_c}_ev", O.with_ev_clean(f"SELECT DISTINCT {_c} FROM clean"))(
        lambda s, d, _k=_c: X.distinct_values(ev_clean(s, d), _k))
