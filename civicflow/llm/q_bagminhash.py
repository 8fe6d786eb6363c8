"""Query op9: near-duplicate classes of ``documents`` (weighted Jaccard of five-word shingles, 0.8).

Connected components need recursion over all similar pairs, which SQL cannot
do at this size; the test compares with all pairs on a small fixture.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .bagminhash import near_classes
from .common import table
from .registry import register


@register("op9_bagminhash")
def op9_bagminhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_classes(docs).select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))
