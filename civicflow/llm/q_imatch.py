"""Query op2: I-Match fingerprints of ``documents`` and of their edited texts."""

from __future__ import annotations

from .common import table
from .imatch import FAMILIES, MAX_RATIO, MIN_RATIO, RATES, edit_likeness
from .registry import register

_SIGN = """
SELECT role, r, list(h ORDER BY s) AS sig FROM (
  SELECT role, r, s, coalesce(substr(md5(string_agg(t, ' ' ORDER BY t)
         FILTER (WHERE substr(md5(t), 4 * f + 1, 4) < lim)), 1, 8), '-') AS h
  FROM (SELECT role, r, unnest(ts) AS t FROM used), sub GROUP BY role, r, s, f, lim)
GROUP BY role, r"""

ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id) AS r FROM documents),
n AS (SELECT d.*, coalesce(lead(t) OVER (ORDER BY r), first_value(t) OVER (ORDER BY r)) AS nt FROM d),
e AS (SELECT *, substr(t, 1, length(t) - length(t) // 4) || substr(nt, 1, length(t) // 4) AS et FROM n),
tx AS (SELECT r, 'text' AS role, t FROM e UNION ALL SELECT r, 'edited', et FROM e UNION ALL SELECT r, 'next', nt FROM e),
tm AS (SELECT r, role, list_filter(list_distinct(string_split_regex(lower(t), '[^\p{{L}}\p{{N}}]+')), lambda x: x <> '') AS ts FROM tx),
df AS (SELECT t, count(*) AS c FROM (SELECT unnest(ts) AS t FROM tm WHERE role = 'text') GROUP BY t),
lex AS (SELECT t FROM df, (SELECT count(*) AS n FROM d)
        WHERE c >= 2 AND c * {MAX_RATIO} >= n AND c * {MIN_RATIO} <= n),
inl AS (SELECT r, role, list(x.t) AS ts FROM (SELECT r, role, unnest(ts) AS t FROM tm) x SEMI JOIN lex USING (t) GROUP BY r, role),
used AS (SELECT tm.r, tm.role, coalesce(inl.ts, tm.ts) AS ts FROM tm LEFT JOIN inl ON tm.r = inl.r AND tm.role = inl.role),
sub AS (SELECT f, k, f * {RATES} + k AS s, printf('%04x', 65536 >> k) AS lim
        FROM (SELECT unnest(range(0, {FAMILIES})) AS f), (SELECT unnest(range(1, {RATES} + 1)) AS k)),
sigs AS ({_SIGN}),
sg AS (SELECT used.r, used.role, coalesce(sig, list_transform(range(0, {FAMILIES * RATES}), lambda x: '-')) AS sig
       FROM used LEFT JOIN sigs ON used.r = sigs.r AND used.role = sigs.role),
w AS (SELECT e.*, a.sig AS sa, b.sig AS sb, c.sig AS sc FROM e
      JOIN sg a ON a.r = e.r AND a.role = 'text' JOIN sg b ON b.r = e.r AND b.role = 'edited'
      JOIN sg c ON c.r = e.r AND c.role = 'next'),
k AS (SELECT *, list_transform(range(1, {FAMILIES * RATES} + 1), lambda i: CASE WHEN sa[i] = sb[i] AND sa[i] <> '-' THEN 1 ELSE 0 END) AS eb,
             list_transform(range(1, {FAMILIES * RATES} + 1), lambda i: CASE WHEN sa[i] <> '-' OR sb[i] <> '-' THEN 1 ELSE 0 END) AS ob,
             list_transform(range(1, {FAMILIES * RATES} + 1), lambda i: CASE WHEN sa[i] = sc[i] AND sa[i] <> '-' THEN 1 ELSE 0 END) AS ec,
             list_transform(range(1, {FAMILIES * RATES} + 1), lambda i: CASE WHEN sa[i] <> '-' OR sc[i] <> '-' THEN 1 ELSE 0 END) AS oc FROM w)
SELECT doc_id, length(t) AS n_chars, sha256(et) AS edited_sha256, array_to_string(sa, '.') AS fingerprint,
       array_to_string(sb, '.') AS edited_fingerprint,
       CASE WHEN list_sum(ob) = 0 THEN 1.0::DOUBLE ELSE list_sum(eb)::DOUBLE / list_sum(ob)::DOUBLE END AS near_edited,
       CASE WHEN list_sum(oc) = 0 THEN 1.0::DOUBLE ELSE list_sum(ec)::DOUBLE / list_sum(oc)::DOUBLE END AS near_next
FROM k
"""


@register("op2_imatch", ORACLE)
def op2_imatch(spark, sf_dir):
    return edit_likeness(table(spark, sf_dir, "documents").select("doc_id", "text"))
