"""Host-level quality rules.

Each document is tested by rules over its own words and lines.  Failures are
aggregated by host, each host's failure rate is shrunk towards the corpus by an
empirical beta prior (moments of the host rates), and hosts whose shrunk rate
reaches ``host_limit`` are rejected; the verdict is joined back to documents.

Defined cases: a null text is empty (no words: it fails); a null host is a host
of its own; repeated rows are judged alike and each counts; an empty table
gives an empty result.  Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, U64, join_hash, map_arrow, sheltered, span_hashes, text_chunks, windows, words, write_out

SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
MAX_SYMBOLS_PER_WORD = 0.5
HOST_LIMIT = 0.5
MIN_STRENGTH = 5.0  # pseudo-documents: a few failures alone never reject a small host
_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def _row_sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeat_words(h: np.ndarray, row: np.ndarray, n_rows: int, k: int = 5) -> np.ndarray:
    """Words covered by ``k``-word windows that occur at least twice in their row."""
    w, at = windows(h, row, k)
    key = join_hash(w, row[at].astype(U64))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(h) + 1, dtype=np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + k, -1)
    return np.bincount(row[np.cumsum(cover[:-1]) > 0], minlength=n_rows)


def _dup_lines(texts: list[str | None]) -> np.ndarray:
    out = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        lines = text.split("\n") if text else ()
        if len(lines) > 1:
            lines = [x for x in lines if x.strip(" \t\n\x0b\x0c\r")]
            out[i] = len(lines) - len(set(lines))
    return out


@sheltered(lambda a: [a["prefix"] + c for c in COUNTS])
def rule_counts(df: DataFrame, text: str = "text", prefix: str = "", keep_text: bool = False) -> DataFrame:
    """``df`` with its text column replaced by the five rule counts (no shuffle).

    Counts are named ``prefix`` + name; an input column of that name is dropped.
    ``keep_text`` leaves the text, as the last column before the counts.
    """
    out_names = [prefix + c for c in COUNTS]
    keep = [c for c in df.columns if c != text and c not in out_names]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_chunks(batches, "__text"):
            starts, ends, row = words(data, offsets)
            h = span_hashes(data, starts, ends)
            n = part.num_rows
            values = [np.bincount(row, minlength=n),
                      _row_sums(((data & 0xC0) != 0x80) & ~IS_SPACE[data], offsets),
                      _row_sums(_IS_SYMBOL[data], offsets),
                      _dup_lines(part.column(part.num_columns - 1).to_pylist()),
                      _repeat_words(h, row, n)]
            yield pa.RecordBatch.from_arrays(
                (part.columns if keep_text else part.columns[:-1]) + [pa.array(v, pa.int64()) for v in values],
                names=keep + [text] * keep_text + out_names)

    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
                       + [f"`{text}` string"] * keep_text + [f"`{c}` bigint" for c in out_names])
    return map_arrow(src, count, schema)


def base_failed(prefix: str = "", min_words: int = MIN_WORDS, max_repeat_pct: int = MAX_REPEAT_PCT):
    n, repeats = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < min_words) | (100 * repeats > max_repeat_pct * n)


def failed_rules(max_symbols: float = MAX_SYMBOLS_PER_WORD):
    """A document counts against its host if a base rule or the symbol rule fails."""
    return base_failed() | (F.col("n_symbols") > max_symbols * F.col("n_words"))


def host_verdicts(counts: DataFrame, host: str = "source", host_limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host: documents, failures, shrunk failure rate, rejected.

    The beta prior has the moments of the host rates, each host weighing alike:
    with mean m and variance v, its strength is ``m (1 - m) / v - 1``
    pseudo-documents, and at least ``MIN_STRENGTH``.
    A host fails when (failures + strength * m) / (documents + strength) reaches
    ``host_limit``.  Rows per host are pre-aggregated before the shuffle.
    """
    hosts = counts.groupBy(F.col(f"`{host}`").alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(failed_rules().cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    prior = hosts.agg(F.avg(rate).alias("prior_mean"), F.var_pop(rate).alias("prior_var"))
    strength = F.greatest(F.lit(MIN_STRENGTH), F.coalesce(F.try_divide(
        F.col("prior_mean") * (1 - F.col("prior_mean")), F.col("prior_var")) - 1, F.lit(MIN_STRENGTH)))
    prior = prior.select("prior_mean", strength.alias("strength"))
    # One row of two numbers: the broadcast side has a fixed size.
    both = hosts.crossJoin(F.broadcast(prior))
    shrunk = (F.col("n_failed") + F.col("strength") * F.col("prior_mean")) / (
        F.col("n_docs") + F.col("strength"))
    return both.select("host", "n_docs", "n_failed", shrunk.alias("shrunk_rate"),
                       (shrunk >= host_limit).alias("host_rejected"))


@sheltered((*COUNTS, "base_failed", "host_rejected", "kept"))
def judge(df: DataFrame, text: str = "text", host: str = "source",
          host_limit: float = HOST_LIMIT) -> DataFrame:
    """Every row's counts, base verdict, host verdict and ``kept``.

    Counts are written once (numbers only), so texts are read once although
    both the host aggregate and the join back need them.  Only rejected hosts
    join back; a hot host is split by Spark's skew join.
    """
    counts = write_out(rule_counts(df, text), "host-rules")
    bad = host_verdicts(counts, host, host_limit).filter("host_rejected").select(
        F.col("host").alias("__host"), F.lit(True).alias("__rejected"))
    joined = counts.join(bad, F.col(f"`{host}`").eqNullSafe(F.col("__host")), "left")
    rejected = F.coalesce(F.col("__rejected"), F.lit(False))
    return joined.select(*counts.columns, base_failed().alias("base_failed"),
                         rejected.alias("host_rejected"),
                         (~base_failed() & ~rejected).alias("kept"))


@sheltered()
def keep_good(df: DataFrame, text: str = "text", host: str = "source",
              host_limit: float = HOST_LIMIT) -> DataFrame:
    """The rows of ``df`` that pass their own rules and whose host passes.

    Reads the texts twice instead of shuffling them: host verdicts from the
    written counts, then each row's own counts beside its unchanged columns.
    """
    counts = write_out(rule_counts(df.select(host, text), text), "host-rules")
    bad = host_verdicts(counts, host, host_limit).filter("host_rejected").select(
        F.col("host").alias("__host"))
    good = rule_counts(df, text, "__", keep_text=True).filter(~base_failed("__"))
    return good.join(bad, F.col(f"`{host}`").eqNullSafe(F.col("__host")), "left_anti").select(
        *[F.col(f"`{c}`") for c in df.columns])
