"""Corpus preparation: quality rules, line dedup, near-dedup, personal data, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and works on all rows that the stage before it kept.  All but the last return
the columns of ``documents``.  ``run`` writes every stage's result as Parquet
in the shared folder and reads it again as the next stage's input.

Defined cases, for every stage: a null text counts as empty and stays null
where the document stays; rows without an id take part as documents of their
own; repeated rows are judged alike, and near-dedup leaves one; of equally good
candidates the smallest doc_id (then the smallest digest) wins; very long texts
are read whole; an empty table gives an empty result; further columns are
passed through up to packing, whatever their names.  Ids are integers.

No stage has SQL for its whole result (hash-based templates, connected
components, check sums, tokenizer), so ``ORACLE_SQL`` is None; a test compares
each stage with a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.llm.bagminhash import keep_one
from civicflow.llm.common import prepare, table, write_out
from civicflow.llm.host_rules import keep_good
from civicflow.llm.line_templates import drop_recurring_lines
from civicflow.llm.packing import pack
from civicflow.llm.pii_anchors import redact_texts

ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the changed text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail their own rules, or whose host fails, go."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates stay in the first document only."""
    return _counted(drop_recurring_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays: the smallest doc_id."""
    return keep_one(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes ``<KIND>``."""
    return _counted(redact_texts(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of every document with their places in sequences of 1024."""
    packed = pack(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("pii", pii), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_out(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
