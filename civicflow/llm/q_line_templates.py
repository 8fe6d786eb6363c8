"""Query op1: recurring template lines dropped from ``documents``.

The hashes that name leaves, places and templates have no SQL counterpart; the
test compares with a brute-force version on real tokens.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import table
from .line_templates import drop_recurring_lines
from .registry import register


@register("op1_line_templates")
def op1_line_templates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = drop_recurring_lines(docs, counts=True)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
