"""Exact per-group percentiles from one table of value counts.

1. One scan reduces the rows to ``(group, value) -> count`` with partial
   aggregation, so a hot group becomes at most one row per task and value.
2. Values fall in buckets of about 1/4096 relative width (the floor of a
   multiple of the logarithm, which grows with the value).  The histogram of
   buckets has a bounded number of rows per group; a running sum over it finds
   the bucket of each wanted rank, and the group's count, mean, minimum and
   maximum come from the same rows.
3. Such a bucket may still hold very many different values (microseconds).  Its
   range from smallest to largest value is cut into ``SPLIT`` equal parts; their
   histogram gives the part of the rank.  No task orders more than ``SPLIT``
   parts, or the values of one part of one bucket.
4. Only values of those parts are ordered, within (group, bucket, rank).

All steps read the same counts: Spark shuffles them once and reuses the
exchange, so the input is scanned once.  There is no sketch, no join back to
the rows and no constant join key.  A rank that is not found raises.  The table
of value counts is as large as the column where its values hardly repeat.

The value is interpolated as Spark's ``percentile`` (and SQL
``quantile_cont``) does: position ``p * (n - 1)`` between its floor and ceil.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PER_E = 4096  # buckets for each factor e
SHIFT = 4_000_000  # above PER_E * |ln| of the smallest double
SPLIT = 1 << 16
DEFAULT_ACCURACY = 100_000


def bucket(v: Column) -> Column:
    """Order-preserving bucket number of a double (0 for zero, negative below)."""
    size = F.floor(F.ln(F.abs(v)) * PER_E) + SHIFT
    return F.when(v == 0, F.lit(0)).otherwise(F.when(v > 0, size).otherwise(-size)).cast("long")


class ValueCounts:
    """Counts of the values of a column by group; see the module text.

    NULL keys form their own group.  NULL values count in ``rows`` only.
    """

    def __init__(self, df: DataFrame, by: Sequence[str], value: str):
        self.by = list(by)
        # One struct for all group columns.
        self.keys = ["_g"] if self.by else []
        group = [F.struct(*[F.col(b).alias(f"g{i}") for i, b in enumerate(self.by)]).alias("_g")] if self.by else []
        data = df.select(*group, F.col(value).cast("double").alias("_v"))
        counts = data.groupBy(*self.keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
        self.counts = counts.withColumn("_b", bucket(F.col("_v")))

    def same_group(self, a: str, b: str, *more: str) -> Column:
        """Null-safe, though nothing joined is NULL: a plain equality would filter NULLs on one side only,
        and the two sides could not share one exchange of the counts."""
        return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in [*self.keys, *more]])

    def histogram(self) -> DataFrame:
        v, c = F.col("_v"), F.col("_c")
        known = F.when(v.isNotNull(), c)
        return self.counts.groupBy(*self.keys, "_b").agg(
            F.sum(c).alias("_rows"), F.coalesce(F.sum(known), F.lit(0)).alias("_m"), F.sum(v * c).alias("_s"),
            F.min(v).alias("_lo"), F.max(v).alias("_hi"))

    def quantiles(self, probs: Sequence[float], names: Sequence[str], having: Column | None = None) -> DataFrame:
        """Group columns, ``rows``, ``n``, ``mean``, ``min``, ``max`` and a column per probability.

        Groups without a known value are left out; without group columns the
        result is always one row.  ``having`` filters groups on the statistics.
        """
        if not self.by:
            return self._overall(probs, names)
        group = Window.partitionBy(*self.keys)
        hist = self._with_group(self.histogram(), group).filter("n > 0")
        if having is not None:
            hist = hist.filter(having)
        running = F.sum("_m").over(group.orderBy(F.col("_b").asc_nulls_first()).rowsBetween(
            Window.unboundedPreceding, Window.currentRow))
        hist = hist.withColumn("_cum", running)
        # A group's last bucket with values has its statistics; a rank without a value shows as NULL beside them.
        names_ = ("rows", "n", "mean", "min", "max")
        xs = [f"_x{i}" for i in range(2 * len(probs))]
        stats = hist.filter((F.col("_cum") == F.col("n")) & (F.col("_m") > 0)).select("_g", *names_, *[
            F.lit(None).cast("double").alias(x) for x in xs])
        hit = self._pick(hist, probs, False).select("_g", *[F.lit(None).cast(hist.schema[c].dataType).alias(c) for c in names_], *[
            F.when(F.col("_i") == i, F.col("_v")).alias(x) for i, x in enumerate(xs)])
        joined = stats.unionByName(hit).groupBy("_g").agg(*[F.max(c).alias(c) for c in (*names_, *xs)])
        return joined.filter(F.col("n").isNotNull()).select(
            *[F.col(f"_g.g{i}").alias(b) for i, b in enumerate(self.by)], *names_, *self._values(probs, names, "n", ""))

    def _with_group(self, hist: DataFrame, group) -> DataFrame:
        n = F.sum("_m").over(group)
        return hist.withColumns({"rows": F.sum("_rows").over(group), "n": n, "mean": F.try_divide(F.sum("_s").over(group), n),
                                 "min": F.min("_lo").over(group), "max": F.max("_hi").over(group)})

    def _overall(self, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
        hist = self.histogram()
        n = F.coalesce(F.sum("_m"), F.lit(0))
        stats = hist.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"), n.alias("n"),
                         F.try_divide(F.sum("_s"), F.sum("_m")).alias("mean"), F.min("_lo").alias("min"), F.max("_hi").alias("max"))
        # One task orders the histogram: a bounded number of buckets.
        every = Window.partitionBy()
        cum = hist.withColumn("n", F.sum("_m").over(every)).withColumn("_cum", F.sum("_m").over(
            Window.orderBy(F.col("_b").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        found = self._pick(cum, probs, True).agg(*[
            F.max(F.when(F.col("_i") == i, F.col("_v"))).alias(f"_x{i}") for i in range(2 * len(probs))])
        # Two tables of one row each; a lost row would show as missing ranks.
        return stats.join(F.broadcast(found), F.lit(True), "left").select("rows", "n", "mean", "min", "max", *self._values(probs, names, "n", ""))

    def _pick(self, hist: DataFrame, probs: Sequence[float], few: bool) -> DataFrame:
        """The values at ranks floor and ceil of every position: numbers 0, 1 for the first, and so on (``_i``)."""
        ranks = F.array(*[F.struct(F.lit(2 * i + j).alias("i"), f(F.lit(float(p)) * (F.col("n") - 1)).cast("long").alias("k"))
                          for i, p in enumerate(probs) for j, f in enumerate((F.floor, F.ceil))])
        before = F.col("_cum") - F.col("_m")
        wanted = hist.withColumn("_r", F.explode(F.filter(ranks, lambda r: (r["k"] >= before) & (r["k"] < F.col("_cum")))))
        side = F.broadcast(wanted.alias("w")) if few else wanted.alias("w")  # few: two rows for each probability
        c, lo, hi = F.col("_v"), F.col("w._lo"), F.col("w._hi")
        part = F.when(hi > lo, F.least(F.floor((c - lo) / (hi - lo) * SPLIT), F.lit(SPLIT - 1))).otherwise(F.lit(0))
        near = self.counts.alias("c").join(side, self.same_group("c", "w", "_b")).select(
            *[F.col(f"c.{k}").alias(k) for k in self.keys], F.col("c._b").alias("_b"), F.col("w._r.i").alias("_i"),
            (F.col("w._r.k") - (F.col("w._cum") - F.col("w._m"))).alias("_k"), part.cast("int").alias("_part"), "_v", "_c")
        near = self._part_of_rank(near, few)
        w = Window.partitionBy(*self.keys, "_b", "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return near.withColumn("_end", F.sum("_c").over(w)).filter(
            (F.col("_k") < F.col("_end")) & (F.col("_k") >= F.col("_end") - F.col("_c"))).select(*self.keys, "_i", "_v")

    def _part_of_rank(self, near: DataFrame, few: bool) -> DataFrame:
        """The values in the part that holds the rank, and the rank in it."""
        rank = [*self.keys, "_b", "_i"]
        running = F.sum("_n").over(Window.partitionBy(*rank).orderBy("_part").rowsBetween(
            Window.unboundedPreceding, Window.currentRow))
        parts = near.groupBy(*rank, "_k", "_part").agg(F.sum("_c").alias("_n")).withColumn("_end", running)
        found = parts.filter((F.col("_k") < F.col("_end")) & (F.col("_k") >= F.col("_end") - F.col("_n")))
        side = F.broadcast(found.alias("p")) if few else found.alias("p")
        return near.alias("v").join(side, self.same_group("v", "p", "_b", "_i", "_part")).select(
            *[F.col(f"v.{x}").alias(x) for x in rank], (F.col("p._k") - (F.col("p._end") - F.col("p._n"))).alias("_k"), "v._v", "v._c")

    def _values(self, probs: Sequence[float], names: Sequence[str], n: str, of: str) -> list[Column]:
        out = []
        for i, (p, name) in enumerate(zip(probs, names)):
            pos = F.lit(float(p)) * (F.col(n) - 1)
            lo, hi = F.col(f"{of}_x{2 * i}"), F.col(f"{of}_x{2 * i + 1}")
            value = F.when(F.floor(pos) == F.ceil(pos), lo).otherwise(
                (F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi)
            missing = (F.col(n) > 0) & (lo.isNull() | hi.isNull())
            out.append(F.when(missing, F.raise_error(F.lit("a rank was not found"))).otherwise(value).alias(name))
        return out


STATS = {"rows", "n", "mean", "min", "max"}


def grouped_quantiles(df: DataFrame, by: Sequence[str], value: str,
                      probs: Sequence[float], names: Sequence[str] | None = None,
                      accuracy: int = DEFAULT_ACCURACY, approx: bool = False,
                      extra: Mapping[str, str] | None = None,
                      having: Column | None = None) -> DataFrame:
    """One row per group of ``by`` with a column per probability.

    NULL values are ignored (as in SQL); NULL group keys form their own group.
    Groups whose values are all NULL get no row; without ``by`` there is one
    row.  ``extra`` names further columns: output name -> one of ``rows``
    (with NULLs), ``n``, ``mean``, ``min``, ``max``.  ``having`` filters groups
    on those statistics' own names.  ``approx=True`` answers from Spark's
    fixed-size sketch in one pass (rank error at most ``n / accuracy``).
    """
    extra = dict(extra or {})
    if unknown := set(extra.values()) - STATS:
        raise ValueError(f"unknown statistics: {sorted(unknown)}")
    probs = [float(p) for p in probs]
    names = list(names) if names else [f"q{i}" for i in range(len(probs))]
    by = list(by)
    if approx:
        v = F.col(value).cast("double")
        out = df.groupBy(*by).agg(
            F.count(F.lit(1)).alias("rows"), F.count(v).alias("n"), F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"),
            F.percentile_approx(v, probs, accuracy).alias("_q"))
        if by:
            out = out.filter("n > 0")
        if having is not None:
            out = out.filter(having)
        out = out.select("*", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    else:
        out = ValueCounts(df, by, value).quantiles(probs, names, having)
    return out.select(*by, *[F.col(s).alias(o) for o, s in extra.items()], *names)
