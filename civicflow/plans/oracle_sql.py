"""Independent SQL (DuckDB dialect) for every registered query.

The fixture tables are pre-registered as views; each statement rebuilds the
ticket binding and the cleaning chain as CTEs and then runs the query, so it
checks the Spark code end to end.  Dictionary values come from the same fixed
tables (``schema``), the logic is written here in SQL.
"""

from __future__ import annotations

from .. import schema as S
from ..sources.bindings import (
    EVENT_TYPE_DIMENSION, ORDER_STATUS, PRIORITY_ORDER_CLASSES, REGION_TO_BOROUGH,
)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def case_map(col: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v) if isinstance(v, str) else v}"
                     for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {default} END"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def rnd(x: str, d: int) -> str:
    """Round like Spark: HALF_UP on the shortest decimal text of the double."""
    return (f"(CASE WHEN abs({x}) < 1e15 THEN "
            f"ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), {d})::DOUBLE "
            f"ELSE ROUND({x}, {d}) END)")


CLOSED = f"status IN {in_list(S.CLOSED_STATUSES)}"
DAYS = "response_time_days"

GEO = f"""
geo AS (
  SELECT n.n_nationkey, {case_map('r.r_name', REGION_TO_BOROUGH)} AS borough
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
cust AS (
  SELECT c.c_custkey, c.c_mktsegment, g.borough
  FROM customer c LEFT JOIN geo g ON c.c_nationkey = g.n_nationkey
)"""

_TDIM_ROWS = ", ".join(f"({q(et)}, {i}, {q(t)})"
                       for et, arr in EVENT_TYPE_DIMENSION.items() for i, t in enumerate(arr))

RAW_EV = f"""
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
tdim(event_type, slot, complaint_type) AS (VALUES {_TDIM_ROWS}),
raw AS (
  SELECT ev.event_id AS unique_key,
         ev.ts AS created_date,
         CASE WHEN ev.k < 75 THEN ev.ts + to_seconds(CAST(round(ev.value * 3600.0::DOUBLE) AS BIGINT)) END
           AS closed_date,
         td.complaint_type,
         cu.borough,
         CAST(CASE WHEN ev.event_id % 11 = 0 THEN NULL ELSE 10001 + ev.event_id % 90 END AS INTEGER)
           AS zip_code,
         CASE WHEN ev.event_id % 97 = 0 THEN NULL ELSE round(40.4774::DOUBLE
           + CAST(ev.event_id * 7919 % 10000 AS DOUBLE) / 10000.0::DOUBLE * 0.44::DOUBLE, 6) END
           AS latitude,
         CASE WHEN ev.event_id % 89 = 0 THEN NULL ELSE round(-74.2591::DOUBLE
           + CAST(ev.event_id * 6007 % 10000 AS DOUBLE) / 10000.0::DOUBLE * 0.55::DOUBLE, 6) END
           AS longitude,
         CASE WHEN ev.k < 75 THEN 'Closed' WHEN ev.k < 85 THEN 'Open'
              WHEN ev.k < 95 THEN 'Pending' ELSE 'In Progress' END AS status
  FROM ev
  LEFT JOIN cust cu ON ev.user_id = cu.c_custkey
  LEFT JOIN tdim td ON td.event_type = ev.event_type AND td.slot = ev.k % 4
)"""

RAW_ORD = f"""
per_order AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderdate, o.o_orderpriority,
         min(CASE WHEN l.l_shipdate >= o.o_orderdate THEN l.l_shipdate END) AS closed_date
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
  GROUP BY o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderdate, o.o_orderpriority
),
raw AS (
  SELECT p.o_orderkey AS unique_key,
         p.o_orderdate AS created_date,
         p.closed_date,
         cu.c_mktsegment AS complaint_type,
         cu.borough,
         {case_map('p.o_orderstatus', ORDER_STATUS)} AS status,
         p.o_orderpriority IN {in_list(PRIORITY_ORDER_CLASSES)} AS is_priority
  FROM per_order p LEFT JOIN cust cu ON p.o_custkey = cu.c_custkey
)"""

_CATEGORY_CASE = "CASE " + " ".join(
    f"WHEN complaint_type IN {in_list(types)} THEN {q(cat)}"
    for cat, types in S.CATEGORY_MAPPING.items() if types) + f" ELSE {q(S.DEFAULT_CATEGORY)} END"

def period_case(h: str) -> str:
    return (f"CASE WHEN {h} >= 6 AND {h} < 12 THEN {q(S.PERIOD_MORNING)} "
            f"WHEN {h} >= 12 AND {h} < 18 THEN {q(S.PERIOD_AFTERNOON)} "
            f"WHEN {h} >= 18 AND {h} < 24 THEN {q(S.PERIOD_EVENING)} ELSE {q(S.PERIOD_NIGHT)} END")


def dated_cte(src: str = "raw") -> str:
    """P1-P4 + P6 over ``src``."""
    return f"""
dated AS (
  SELECT *,
         CAST(year(created_date) AS INTEGER) AS created_year,
         CAST(month(created_date) AS INTEGER) AS created_month,
         CAST(day(created_date) AS INTEGER) AS created_day,
         dayname(created_date) AS created_weekday,
         CAST(hour(created_date) AS INTEGER) AS created_hour,
         {period_case('hour(created_date)')} AS created_period,
         CASE WHEN {CLOSED} THEN
           CAST(date_diff('microsecond', created_date, closed_date) AS DOUBLE) / 3600000000.0::DOUBLE
         END AS response_time_hours
  FROM {src}
),
timed AS (SELECT *, response_time_hours / 24.0::DOUBLE AS response_time_days FROM dated)"""


def translated_cte(src: str = "timed") -> str:
    """P5 over ``src``."""
    return f"""
translated AS (
  SELECT * REPLACE (
    COALESCE({case_map('borough', S.BOROUGH_TRANSLATION)}, borough) AS borough,
    COALESCE({case_map('complaint_type', S.COMPLAINT_TYPE_TRANSLATION)}, complaint_type) AS complaint_type,
    COALESCE({case_map('status', S.STATUS_TRANSLATION)}, status) AS status,
    COALESCE({case_map('created_weekday', S.WEEKDAY_TRANSLATION)}, created_weekday) AS created_weekday)
  FROM {src}
)"""


def clean_cte(has_geo: bool, has_priority: bool, max_days: float = 90) -> str:
    """P5-P15 after ``timed``: translate, outliers, categories, nulls, features."""
    geo_step = f"""
filled AS (
  SELECT * REPLACE (COALESCE(zip_code, {case_map('upper(borough)', S.BOROUGH_ZIP_DEFAULTS)}) AS zip_code)
  FROM categorized WHERE latitude IS NOT NULL AND longitude IS NOT NULL
)""" if has_geo else """
filled AS (SELECT * FROM categorized)"""
    prio = "" if has_priority else \
        f",\n         complaint_type IN {in_list(S.PRIORITY_TYPES)} AS is_priority"
    return translated_cte() + f""",
no_outliers AS (
  SELECT * FROM translated WHERE NOT COALESCE({DAYS} > {float(max_days)}::DOUBLE, false)
),
categorized AS (SELECT *, {_CATEGORY_CASE} AS complaint_category FROM no_outliers),""" + geo_step + f""",
clean AS (
  SELECT *,
         isodow(created_date) >= 6 AS is_weekend,
         CAST(quarter(created_date) AS INTEGER) AS quarter,
         (hour(created_date) BETWEEN 9 AND 17) AND NOT (isodow(created_date) >= 6)
           AS is_business_hours{prio}
  FROM filled
)"""


def with_ev_clean(body: str, max_days: float = 90) -> str:
    return "WITH" + GEO + "," + RAW_EV + "," + dated_cte() + "," + \
        clean_cte(True, False, max_days) + "\n" + body


def with_ord_clean(body: str, max_days: float = 90) -> str:
    return "WITH" + GEO + "," + RAW_ORD + "," + dated_cte() + "," + \
        clean_cte(False, True, max_days) + "\n" + body


def with_ev_raw(body: str) -> str:
    return "WITH" + GEO + "," + RAW_EV + "\n" + body


def with_ord_raw(body: str) -> str:
    return "WITH" + GEO + "," + RAW_ORD + "\n" + body


def with_ev_timed(body: str) -> str:
    return "WITH" + GEO + "," + RAW_EV + "," + dated_cte() + "\n" + body


def with_ord_timed(body: str) -> str:
    return "WITH" + GEO + "," + RAW_ORD + "," + dated_cte() + "\n" + body


def with_ev_translated(body: str) -> str:
    return "WITH" + GEO + "," + RAW_EV + "," + dated_cte() + "," + translated_cte() + "\n" + body


CLOSED_KNOWN = f"{CLOSED} AND {DAYS} IS NOT NULL"
