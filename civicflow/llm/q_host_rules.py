"""Query op10: host-level quality rules over ``documents``."""

from __future__ import annotations

from .common import table
from .host_rules import COUNTS, judge
from .registry import register

ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
grams AS (SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS g
          FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM d)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1),
cover AS (SELECT r, count(DISTINCT i + o) AS n FROM twice, (SELECT unnest(range(0, 5)) AS o) GROUP BY r),
c AS (SELECT d.r, doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
                  - len(list_distinct(list_filter(string_split(t, chr(10)),
                                                  lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN cover USING (r)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c),
h AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed OR n_symbols > 0.5 * n_words) AS k
      FROM f GROUP BY source),
p AS (SELECT avg(k / n) AS m, var_pop(k / n) AS v FROM h),
s AS (SELECT m, greatest(5.0, coalesce(CASE WHEN v > 0 THEN m * (1 - m) / v - 1 END, 5.0)) AS b FROM p),
bad AS (SELECT source, (k + b * m) / (n + b) >= 0.5 AS rejected FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       rejected AS host_rejected, NOT base_failed AND NOT rejected AS kept
FROM f JOIN bad ON f.source IS NOT DISTINCT FROM bad.source
"""


@register("op10_host_rules", ORACLE)
def op10_host_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return judge(docs).select("doc_id", *COUNTS, "base_failed", "host_rejected", "kept")
