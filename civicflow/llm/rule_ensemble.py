"""Quality classifier: a sparse rule ensemble.

Statistics of each text are numbers; a forest of shallow trees is fitted to
the labels, every path from a root to a node becomes a conjunctive rule over
the statistics, a lasso logistic regression keeps few rules, and those are
compiled into one Spark column expression that scores any table of statistics.

Only rows chosen for learning are used, at most ``max_rows`` of them (the ones
with the smallest hash of doc_id: a bounded sample that does not depend on
the layout).  Statistics never include language, source, id or labels.

Defined cases: a null text is empty; null labels do not teach; documents
without a label are scored alike; repeated labels teach each; with no label at
all the score is 0.5, with one class its smoothed share; rows without an id
never teach.  Texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, join_hash, map_arrow, span_hashes, text_chunks, windows, words

STATS = ["log_words", "mean_word", "longest_word", "symbol_rate", "bang_rate", "bar_rate", "digit_rate", "upper_share",
         "stop_rate", "distinct_share", "top_share", "repeat_share", "line_words", "dup_line_share"]
MAX_ROWS = 20_000
TREES, DEPTH, LASSO = 12, 3, 0.002
SEED = 17
Rule = tuple[tuple[str, float, float], ...]  # (statistic, above, at most)


# -- statistics ----------------------------------------------------------------

def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_SYMBOL, _BANG, _BAR, _STOP = _table("#*$%&<>"), _table("!"), _table("|"), _table(".")
_DIGIT, _UPPER, _LOWER = _table("0123456789"), _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("abcdefghijklmnopqrstuvwxyz")


def _stats(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """len(STATS) x rows."""
    n = len(offsets) - 1
    starts, ends, row = words(data, offsets)
    h = span_hashes(data, starts, ends)
    count = np.bincount(row, minlength=n).astype(np.float64)
    per_word = 1 / np.maximum(count, 1)

    def sums(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)

    def largest(values: np.ndarray, r: np.ndarray) -> np.ndarray:
        out = np.zeros(n)
        np.maximum.at(out, r, values)
        return out

    size = (ends - starts).astype(np.float64)
    # Upper and lower case of two-byte letters of the Latin-1 block too.
    lead = np.concatenate([[False], data[:-1] == 0xC3]) if len(data) else np.zeros(0, bool)
    upper = sums(_UPPER[data] | (lead & (data >= 0x80) & (data <= 0x9E)))
    lower = sums(_LOWER[data] | (lead & (data >= 0x9F)))
    key = np.sort(join_hash(h, row.astype(U64)))
    order = np.lexsort((h, row))
    new = np.ones(len(order), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
    begin = np.flatnonzero(new)
    times = np.diff(np.append(begin, len(order))).astype(np.float64)
    kind_row = row[order][begin]
    w, at = windows(h, row, 5)
    key = join_hash(w, row[at].astype(U64))
    by = np.argsort(key)
    same = key[by][1:] == key[by][:-1]
    twice = np.zeros(len(key), bool)
    twice[by[1:][same]] = True
    twice[by[:-1][same]] = True
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + 5, -1)
    repeat = np.bincount(row[np.cumsum(cover[:-1]) > 0], minlength=n)
    # Lines with a word.
    bounds = np.union1d(offsets, np.flatnonzero(data == 10) + 1)
    line = np.unique(np.searchsorted(bounds[1:], starts, side="right"))
    line_h = span_hashes(data, bounds[line], np.maximum(bounds[line], bounds[line + 1] - (data[bounds[line + 1] - 1] == 10))) \
        if len(line) else np.zeros(0, U64)
    line_row = np.searchsorted(offsets[1:], bounds[line], side="right")
    lines = np.bincount(line_row, minlength=n).astype(np.float64)
    kinds = np.unique(np.stack([line_row.astype(U64), line_h], 1), axis=0)[:, 0].astype(np.int64) if len(line) else line
    differ = np.bincount(kinds, minlength=n)
    return np.stack([
        np.log1p(count), np.bincount(row, size, minlength=n) * per_word, np.log1p(largest(size, row)),
        sums(_SYMBOL[data]) * per_word, sums(_BANG[data]) * per_word, sums(_BAR[data]) * per_word,
        sums(_DIGIT[data]) * per_word, upper / np.maximum(upper + lower, 1), sums(_STOP[data]) * per_word,
        np.bincount(kind_row, minlength=n) * per_word, largest(times, kind_row) * per_word, repeat * per_word,
        np.log1p(count / np.maximum(lines, 1)), (lines - differ) / np.maximum(lines, 1)])


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with its text replaced by the statistics (no shuffle); clashing columns are dropped."""
    keep = [c for c in df.columns if c != text and c not in STATS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_chunks(batches, "__text"):
            yield pa.RecordBatch.from_arrays(
                part.columns[:-1] + [pa.array(x) for x in _stats(data, offsets)], names=keep + STATS)

    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
                       + [f"{c} double" for c in STATS])
    return map_arrow(src, run, schema)


# -- rules ---------------------------------------------------------------------

def paths(tree: str) -> set[Rule]:
    """Conjunctive rules of all nodes below the root of a printed tree."""
    found: set[Rule] = set()
    stack: list[tuple[int, dict]] = []
    for line in tree.splitlines():
        m = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            continue
        depth, name, limit = len(m[1]), STATS[int(m[2])], float(m[4])
        while stack and stack[-1][0] >= depth:
            stack.pop()
        box = dict(stack[-1][1]) if stack else {}
        low, high = box.get(name, (-np.inf, np.inf))
        box[name] = (low, min(high, limit)) if m[3] == "<=" else (max(low, limit), high)
        stack.append((depth, box))
        found.add(tuple(sorted((k, a, b) for k, (a, b) in box.items())))
    return found


def rule_column(rule: Rule) -> Column:
    parts = [F.col(k) > a for k, a, _ in rule if a > -np.inf] + [F.col(k) <= b for k, _, b in rule if b < np.inf]
    return reduce(lambda x, y: x & y, parts)


class Model:
    """Intercept and weighted rules."""

    def __init__(self, intercept: float, rules: list[tuple[Rule, float]]):
        self.intercept, self.rules = intercept, rules

    def score(self) -> Column:
        """The probability of label 1 as a column over the statistics."""
        total = reduce(lambda x, y: x + y, [F.when(rule_column(r), F.lit(w)).otherwise(F.lit(0.0)) for r, w in self.rules],
                       F.lit(float(self.intercept)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def __str__(self) -> str:
        lines = [f"{self.intercept:+.3f}"]
        for rule, w in sorted(self.rules, key=lambda x: -abs(x[1])):
            lines.append(f"{w:+.3f} if " + " and ".join(f"{a:.4g} < {k} <= {b:.4g}" for k, a, b in rule))
        return "\n".join(lines)


def fit(rows: DataFrame, label: str = "label", doc_id: str = "doc_id", max_rows: int = MAX_ROWS,
        trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> Model:
    """Learns from statistics with a 0/1 label; the sample's bound is ``max_rows``."""
    sample = rows.orderBy(F.xxhash64(F.col(doc_id)), doc_id, label, *STATS).limit(max_rows)
    sample = sample.select(F.col(label).cast("double").alias("label"), *STATS).coalesce(1).cache()
    try:
        seen = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
        n, ones = sum(seen.values()), seen.get(1.0, 0)
        if len(seen) < 2:
            share = (ones + 1) / (n + 2)
            return Model(float(np.log(share / (1 - share))), [])
        vector = sample.select("label", array_to_vector(F.array(*STATS)).alias("features"))
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, featureSubsetStrategy="onethird",
                                        subsamplingRate=0.7, maxBins=64, minInstancesPerNode=min(20, max(1, n // 50)))
        rules = sorted(set().union(*[paths(t.toDebugString) for t in forest.fit(vector).trees]))
        if not rules:
            return Model(float(np.log(ones / (n - ones))), [])
        hits = sample.select("label", array_to_vector(F.array(*[
            rule_column(r).cast("double") for r in rules])).alias("features"))
        line = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=80, standardization=True).fit(hits)
        return Model(line.intercept, [(r, float(w)) for r, w in zip(rules, line.coefficients) if abs(w) > 1e-9])
    finally:
        sample.unpersist()


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows that never teach: crc32 of the id as text divisible by ``folds`` (or no id)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(True))
