"""Query op8: quality scores of ``documents`` learnt from ``labels``.

A fitted model has no SQL; tests hold its accuracy on the held-out fold and
the compiled expression against the rules.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import table, write_out
from .registry import register
from .rule_ensemble import fit, held_out, statistics

THRESHOLD = 0.3


@register("op8_rule_ensemble")
def op8_rule_ensemble(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").alias("label"))
    stats = write_out(statistics(docs), "statistics")
    model = fit(stats.filter(~held_out(F.col("doc_id"))).join(labels, "doc_id"))
    return stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
