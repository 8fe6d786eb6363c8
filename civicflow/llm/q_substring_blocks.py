"""Query op7: removal of repeated 20-word windows from ``documents``."""

from __future__ import annotations

from .common import table
from .registry import register
from .substring_blocks import remove_repeats

ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d)),
late AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + o AS p FROM late, (SELECT unnest(range(0, 20)) AS o)),
pos AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (SELECT pos.doc_id, string_agg(word, ' ' ORDER BY pos.p) AS t, count(*) AS n
         FROM pos LEFT JOIN gone ON pos.doc_id = gone.doc_id AND pos.p = gone.p
         WHERE gone.p IS NULL GROUP BY pos.doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""


@register("op7_substring_blocks", ORACLE)
def op7_substring_blocks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
