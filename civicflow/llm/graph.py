"""Connected components of a link table, and grouped work on sorted partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, write_out


HOT_KEYS, HOT_ROWS = 10_000, 500


def join_weighted(big: DataFrame, small: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """``big`` joined with ``small`` (written, one row a key, ``weight``: its rows in ``big``).

    Keys with over 1/``HOT_KEYS`` of all rows (and over ``HOT_ROWS``) are fewer
    than ``HOT_KEYS``: they are broadcast and their rows matched where they
    are.  All others meet in a shuffle join; rows that are matched already go
    through it by a hash of the whole row, so they are spread evenly.  ``big`` is
    worked out once.  The first key is a long.
    """
    total = small.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) > max(HOT_ROWS, total // HOT_KEYS)
    values = [c for c in small.columns if c not in keys and c != weight]
    found = F.struct(F.lit(True).alias("hit"), *values)
    few = small.filter(hot).select(*keys, found.alias("__hot"))
    rest = small.filter(~hot).select(*[F.col(k).alias(f"__{k}") for k in keys], found.alias("__rest"))
    open_ = F.col("__hot").isNull()
    near = big.join(F.broadcast(few), keys, "left").withColumn(
        "__to", F.when(open_, F.col(keys[0])).otherwise(F.xxhash64(*big.columns)))
    same = (F.col("__to") == F.col(f"__{keys[0]}")) & open_
    for k in keys[1:]:
        same = same & (F.col(k) == F.col(f"__{k}"))
    got = near.join(rest, same, "left").withColumn("__got", F.coalesce("__hot", "__rest"))
    return got.filter(F.col("__got").isNotNull()).select(*big.columns, *[F.col(f"__got.{c}").alias(c) for c in values])


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node it reaches.

    Alternates two steps until nothing changes: every node points its larger
    neighbours at its smallest neighbour, then its smaller neighbours likewise.
    Each round is written to the shared folder; the driver sees a few numbers.
    A node's minimum comes from partial minima and is written first; the links
    of a node with very many neighbours get it where they are
    (``join_weighted``), so they never meet in one task.
    """
    edges = links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).filter("u < v").distinct()
    edges = write_out(edges, "edges")
    state = _state(edges)
    for _ in range(max_rounds):
        # A node's larger neighbours point at the smallest of its neighbours and itself.
        larger = edges.select(F.col("u").alias("v"), F.col("v").alias("u"))
        both = edges.select("v", "u").unionByName(larger)
        low = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"), F.count_if(F.col("u") > F.col("v")).alias("n"))
        low = write_out(low.filter("n > 0"), "minima")
        large = join_weighted(larger, low, ["v"], "n").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = write_out(large.filter("u < v").distinct(), "edges")
        # A node's smaller neighbours, and it, point at the smallest of them.
        low = write_out(large.groupBy("v").agg(F.min("u").alias("m"), F.count(F.lit(1)).alias("n")), "minima")
        small = join_weighted(large, low, ["v"], "n").select(F.explode(F.array(
            F.struct(F.col("v"), F.col("m").alias("u")),
            F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e")).select("e.*")
        edges = write_out(small.filter("u < v").distinct(), "edges")
        now = _state(edges)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return roots.unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())


def map_groups(df: DataFrame, keys: list[str], fn: Callable[[dict[str, np.ndarray | list]], list[np.ndarray] | None],
               schema: str, payload: tuple[str, ...] = ()) -> DataFrame:
    """``fn`` over each group of ``keys``, streaming through sorted partitions.

    ``fn`` gets the group's columns (arrays; lists of bytes for ``payload``)
    and returns the columns of ``schema`` or None.  One group is in memory at
    a time: callers bound the group size by splitting into blocks first.
    """
    names = [x.split()[0] for x in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        out: list[list[np.ndarray]] = []

        def work(batch: pa.RecordBatch, lo: int, hi: int) -> None:
            part = batch.slice(lo, hi - lo)
            cols = {n: part.column(i).to_pylist() if n in payload else part.column(i).to_numpy(zero_copy_only=False)
                    for i, n in enumerate(part.schema.names)}
            got = fn(cols)
            if got is not None and len(got[0]):
                out.append(got)

        def flush() -> Iterator[pa.RecordBatch]:
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=names)
                out.clear()

        def join(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

        for batch in batches:
            if batch.num_rows == 0:
                continue
            cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
            new = np.zeros(batch.num_rows, bool)
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            if held:
                old = held[-1]
                new[0] = any(old.column(old.schema.get_field_index(k))[old.num_rows - 1].as_py() != c[0]
                             for k, c in zip(keys, cols))
            cuts = np.flatnonzero(new)
            if held and len(cuts) == 0:
                held.append(batch)
                continue
            if held:
                if cuts[0] > 0:
                    held.append(batch.slice(0, int(cuts[0])))
                whole = join(held)
                work(whole, 0, whole.num_rows)
            first = int(cuts[0]) if held else 0
            bounds = [first, *[int(c) for c in cuts if c > first]]
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                work(batch, lo, hi)
            held = [batch.slice(bounds[-1])]
            yield from flush()
        if held:
            whole = join(held)
            work(whole, 0, whole.num_rows)
        yield from flush()

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartition(n, *keys).sortWithinPartitions(*keys)
    return map_arrow(dealt, run, schema)


def block_pairs(df: DataFrame, group: str, member: str, size: str, block: int) -> DataFrame:
    """Adds ``lo`` and ``hi``: groups above ``block`` rows become pairs of blocks.

    Every two members of a group meet in at least one (group, lo, hi), which
    holds about ``2 * block`` rows at most; small groups stay whole.
    """
    many = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64(member), many.cast("long")).cast("int")
    others = F.when(many == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), many - 1), lambda j: j != own))
    return df.withColumn("__own", own).withColumn("__other", F.explode(others)).withColumns({
        "lo": F.least("__own", "__other"), "hi": F.greatest("__own", "__other")}).drop("__own", "__other")


def local_roots(adjacent: np.ndarray) -> np.ndarray:
    """Smallest index that each row reaches in a symmetric boolean matrix."""
    n = len(adjacent)
    label = np.arange(n)
    while True:
        low = np.where(adjacent, label[None, :], n).min(axis=1)
        low = np.minimum(low, label)
        low = low[low]
        if (low == label).all():
            return label
        label = low
