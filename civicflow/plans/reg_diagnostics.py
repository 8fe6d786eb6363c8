"""Registered diagnostics and scorecards."""

from __future__ import annotations

from .. import schema as S
from ..operators import diagnostics as D
from . import oracle_sql as O
from .registry import R, cont, ev_clean, register, round_doubles, sql_round

CL = O.CLOSED
Q = O.q
_MEAN = (f"CASE WHEN COUNT(CASE WHEN {CL} THEN 1 END) = 0 THEN 0.0::DOUBLE "
         f"ELSE AVG(CASE WHEN {CL} THEN {R} END) END")

_KPI = f""", kpi0 AS (
  SELECT COUNT(*) AS total_records,
         COUNT(CASE WHEN {CL} THEN 1 END) AS closed_records,
         {_MEAN} AS avg_response_days,
         COUNT(CASE WHEN COALESCE(is_priority, false) THEN 1 END) AS priority_total,
         COUNT(CASE WHEN COALESCE(is_priority, false) AND {CL} THEN 1 END) AS priority_closed
  FROM clean
),
kpi AS (
  SELECT total_records, closed_records,
         closed_records * 100.0::DOUBLE / NULLIF(total_records, 0) AS closure_rate,
         avg_response_days, priority_total, priority_closed,
         CASE WHEN priority_total > 0 THEN priority_closed * 100.0::DOUBLE / priority_total
              ELSE 0.0::DOUBLE END AS priority_rate
  FROM kpi0
)"""

register("D1_headline_kpis_ev", cont(O.with_ev_clean(_KPI + "\n" + sql_round(
    "SELECT *, closure_rate - 70.0::DOUBLE AS closure_delta, "
    "2.0::DOUBLE - avg_response_days AS time_delta FROM kpi",
    ["closure_rate", "avg_response_days", "priority_rate", "closure_delta", "time_delta"]))))(
    lambda s, d: round_doubles(D.headline_kpis(ev_clean(s, d))))


def _rates_cte(key: str) -> str:
    return f""", g AS (
  SELECT {key}, COUNT(*) AS total_calls, COUNT(CASE WHEN {CL} THEN 1 END) AS closed_calls,
         {_MEAN} AS avg_response_days
  FROM clean GROUP BY {key}
),
r AS (SELECT *, closed_calls * 100.0::DOUBLE / total_calls AS closure_rate FROM g)"""


_GRADE = (f"CASE WHEN closure_rate >= 75 AND avg_response_days <= 2.0 THEN {Q(S.GRADE_EXCELLENT)} "
          f"WHEN closure_rate >= 70 AND avg_response_days <= 3.0 THEN {Q(S.GRADE_GOOD)} "
          f"WHEN closure_rate >= 60 AND avg_response_days <= 5.0 THEN {Q(S.GRADE_FAIR)} "
          f"ELSE {Q(S.GRADE_CRITICAL)} END")
register("D2_borough_scorecard_ev", cont(O.with_ev_clean(_rates_cte("borough") + "\n" + sql_round(
    f"SELECT *, {_GRADE} AS performance, "
    f"printf('%.1f%%', {O.rnd('closure_rate', 1)}) AS closure_rate_text, "
    f"printf('%.1f', {O.rnd('avg_response_days', 1)}) AS avg_response_text FROM r ORDER BY borough",
    ["avg_response_days", "closure_rate"]))))(
    lambda s, d: round_doubles(D.borough_scorecard(ev_clean(s, d))))

def _attn(m: int = 50, ct: float = 70.0, tt: float = 3.0, hc: float = 60.0, ht: float = 5.0) -> str:
    """D3 body over the per-category rates ``r``."""
    high = f"closure_rate < {hc} OR avg_response_days > {ht}"
    return (f"SELECT *, CASE WHEN {high} THEN {Q(S.URGENCY_HIGH)} ELSE {Q(S.URGENCY_MEDIUM)} END "
            f"AS urgency, CASE WHEN {high} THEN 2 ELSE 1 END AS severity, "
            f"CASE WHEN closure_rate < {ct} THEN {Q(S.PROBLEM_LOW_RATE)} "
            f"ELSE {Q(S.PROBLEM_HIGH_TIME)} END AS main_problem FROM r "
            f"WHERE total_calls >= {m} AND (closure_rate < {ct} OR avg_response_days > {tt})")


_ORDER = " ORDER BY severity DESC, closure_rate, complaint_category"
register("D3_category_attention_ev", cont(O.with_ev_clean(
    _rates_cte("complaint_category") + "\n" + sql_round(
        _attn() + _ORDER, ["avg_response_days", "closure_rate"]))))(
    lambda s, d: round_doubles(D.category_attention(ev_clean(s, d))))
# With a higher closure bound both urgencies occur, most severe first.
register("D3_category_attention_urgent_ev", cont(O.with_ev_clean(
    _rates_cte("complaint_category") + "\n" + sql_round(
        _attn(ct=76.0, tt=2.0, hc=75.0) + _ORDER, ["avg_response_days", "closure_rate"]))))(
    lambda s, d: round_doubles(D.category_attention(ev_clean(s, d), closure_target=76.0,
                                                    time_target=2.0, high_closure=75.0)))
# With stricter targets the attention list is not empty on the fixture data.
register("D3_category_attention_strict_ev", cont(O.with_ev_clean(
    _rates_cte("complaint_category") + "\n" + sql_round(
        _attn(ct=76.0, tt=2.0) + _ORDER, ["avg_response_days", "closure_rate"]))))(
    lambda s, d: round_doubles(D.category_attention(ev_clean(s, d), closure_target=76.0,
                                                    time_target=2.0)))

_REC = f""", pb AS (
  SELECT borough, COUNT(*) AS n, COUNT(CASE WHEN {CL} THEN 1 END) AS c,
         SUM(CASE WHEN {CL} THEN {R} END) AS s, COUNT(CASE WHEN {CL} THEN {R} END) AS k
  FROM clean GROUP BY borough
),
tot AS (
  SELECT SUM(c) * 100.0::DOUBLE / SUM(n) AS closure_rate,
         CASE WHEN SUM(c) = 0 THEN 0.0::DOUBLE ELSE SUM(s) / NULLIF(SUM(k), 0) END AS avg_days,
         arg_min(borough, ({O.rnd('(c * 100.0::DOUBLE / n)', 1)}, borough)) AS worst_borough,
         MIN({O.rnd('(c * 100.0::DOUBLE / n)', 1)}) AS worst_rate
  FROM pb
){_rates_cte('complaint_category')},
attn AS ({{attn}} ORDER BY severity DESC, closure_rate, complaint_category LIMIT 1),
rules AS (
  SELECT 1 AS rule_no, 'closure_followup' AS rule_id, NULL::VARCHAR AS subject,
         closure_rate < {{cg}} AS fire FROM tot
  UNION ALL SELECT 2, 'time_taskforce', NULL, avg_days > {{tg}} FROM tot
  UNION ALL SELECT 3, 'borough_focus', worst_borough, worst_rate < 70.0 FROM tot
  UNION ALL SELECT 4, 'critical_category', complaint_category, true FROM attn
  UNION ALL SELECT 5, 'ml_triage', NULL, true FROM tot
)
SELECT rule_no, rule_id, subject FROM rules WHERE COALESCE(fire, false) ORDER BY rule_no"""
register("D4_recommendations_ev", cont(O.with_ev_clean(
    _REC.format(attn=_attn(), cg="75.0", tg="2.5"))))(
    lambda s, d: D.recommendations(ev_clean(s, d)))
register("D4_recommendations_strict_ev", cont(O.with_ev_clean(
    _REC.format(attn=_attn(), cg="80.0", tg="2.0"))))(
    lambda s, d: D.recommendations(ev_clean(s, d), closure_goal=80.0, time_goal=2.0))

register("D5_system_score_ev", cont(O.with_ev_clean(_KPI + "\n" + f""", pts AS (
  SELECT closure_rate, avg_response_days, total_records, priority_rate,
         CASE WHEN closure_rate >= 75 THEN 25 WHEN closure_rate >= 70 THEN 20
              WHEN closure_rate >= 65 THEN 15 WHEN closure_rate >= 60 THEN 10 ELSE 0 END AS closure_points,
         CASE WHEN avg_response_days <= 1.5 THEN 25 WHEN avg_response_days <= 2.0 THEN 20
              WHEN avg_response_days <= 3.0 THEN 15 WHEN avg_response_days <= 5.0 THEN 10 ELSE 0 END
           AS time_points,
         CASE WHEN total_records >= 10000 THEN 25 WHEN total_records >= 5000 THEN 20
              WHEN total_records >= 1000 THEN 15 ELSE 0 END AS volume_points,
         CASE WHEN priority_rate >= 80 THEN 25 WHEN priority_rate >= 70 THEN 20
              WHEN priority_rate >= 60 THEN 15 ELSE 0 END AS priority_points
  FROM kpi
)
""" + sql_round(
    f"SELECT *, closure_points + time_points + volume_points + priority_points AS score, "
    f"CASE WHEN closure_points + time_points + volume_points + priority_points >= 90 "
    f"THEN {Q(S.SYSTEM_EXCELLENT)} "
    f"WHEN closure_points + time_points + volume_points + priority_points >= 75 THEN {Q(S.SYSTEM_GOOD)} "
    f"WHEN closure_points + time_points + volume_points + priority_points >= 60 THEN {Q(S.SYSTEM_FAIR)} "
    f"ELSE {Q(S.SYSTEM_CRITICAL)} END AS status FROM pts",
    ["closure_rate", "avg_response_days", "priority_rate"]))))(
    lambda s, d: round_doubles(D.system_score(ev_clean(s, d))))
