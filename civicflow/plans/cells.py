"""A forest fitted on distinct feature vectors instead of rows.

The features are codes, hours, months and flags, so rows share few distinct
vectors (cells).  A variance tree sees of a cell only the number of its rows
drawn for the tree, their sum and their sum of squares: one pass over the rows
draws them and adds these up, for the whole forest and for the folds' forests,
and every tree is grown on its own cells in one task.  What a fit keeps and
shuffles then follows the cells, not the rows.  Where the vectors are too many
for one task, every tree is a distributed Spark ML fit on its cells.
"""

from __future__ import annotations

import functools
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import importable, shared_path
from . import forest as N
from . import trees as T

POINTS_PER_TASK = 100_000
ROWS_PER_TASK = 200_000
MAX_CELLS = 2_000_000  # vectors times folds of one tree that a task holds
MAX_VALUES = 100_000  # values of all features together
BLOCK_ROWS = 16_384
CELLS_PER_PART = 16_384


def poisson_edges() -> list[int]:
    """Edges on signed 64-bit numbers: a uniform one is under edge ``j`` as often as a Poisson(1) draw is ``j`` or less."""
    out, below = [], Fraction(0)
    for j in range(30):
        below += Fraction(math.exp(-1.0)) / math.factorial(j)
        edge = math.floor(below * (1 << 64)) - (1 << 63)
        if edge >= (1 << 63) - (1 << 11):  # what is left is under the precision of exp(-1)
            break
        out.append(edge)
    return out


def draws(num_trees: int, seed: int, key: str = "unique_key") -> Column:
    """How often each tree's bootstrap draws a row, as an array: Poisson(1) from a hash of
    seed, key and tree, so it does not depend on files, partitions or the other rows."""
    edges = poisson_edges()
    whens = " ".join(f"WHEN h < {e}L THEN {j}D" for j, e in enumerate(edges))
    return F.expr(f"transform(transform(sequence(0, {num_trees - 1}), t -> xxhash64({seed}L, `{key}`, t)), "
                  f"h -> CASE {whens} ELSE {len(edges)}D END)")


def cell_table(rows: DataFrame, label: str, num_trees: int, seed: int, key: str = "unique_key") -> DataFrame:
    """(tree, x, n, s, q): a cell's rows drawn for a tree, sum and sum of squares of their
    labels; tree ``num_trees`` takes every row once.  Added up in each task before the shuffle."""
    w = F.concat(draws(num_trees, seed, key), F.array(F.lit(1.0)))
    drawn = rows.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"),
                        F.posexplode(w).alias("tree", "w")).filter("w > 0")
    return drawn.groupBy("tree", "x").agg(F.sum("w").alias("n"), F.sum(F.expr("w * y")).alias("s"), F.sum(F.expr("w * y * y")).alias("q"))


def points(cells: DataFrame, label: str) -> DataFrame:
    """Two weighted points a cell, mean minus and plus deviation, half the rows each: together
    they have the count, sum and sum of squares of the cell's drawn rows."""
    dev = F.expr("sqrt(greatest(q / n - (s / n) * (s / n), 0D))")
    mean = F.expr("s / n")
    return cells.select("tree", array_to_vector("x").alias("features"), F.expr("n / 2").alias("weight"),
                        F.explode(F.array(mean - dev, mean + dev)).alias(label))


_XXH = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]  # primes 1, 2, 3, 5


def draw_matrix(hashed: np.ndarray, num_trees: int) -> np.ndarray:
    """``draws`` of rows whose hash of seed and key is given: one line a row, one column a tree."""
    p1, p2, p3, p5 = _XXH
    edges = np.array([e + (1 << 63) for e in poisson_edges()], dtype=np.uint64)
    trees = np.arange(num_trees, dtype=np.uint64) * p1
    out = np.empty((len(hashed), num_trees), dtype=np.uint8)
    for at in range(0, len(hashed), 256):  # as many lines as stay in the processor's cache
        h = (hashed[at:at + 256].view(np.uint64) + (p5 + np.uint64(4)))[:, None] ^ trees
        h = ((h << np.uint64(23)) | (h >> np.uint64(41))) * p2 + p3
        h ^= h >> np.uint64(33)
        h *= p2
        h ^= h >> np.uint64(29)
        h *= p3
        h ^= (h >> np.uint64(32)) ^ np.uint64(1 << 63)  # the sign turned: edges are on signed numbers
        w = (h >= edges[0]).view(np.uint8)
        for e in edges[1:4]:
            w += h >= e
        high = w == 4
        w[high] = np.searchsorted(edges, h[high], side="right")
        out[at:at + 256] = w
    return out


def feature_bins(vectors: DataFrame, max_bins: int) -> T.Bins | None:
    """The features' values from (x, rows), in at most ``max_bins`` bins each; None where they are too many."""
    counts = vectors.select("rows", F.posexplode("x").alias("feature", "value")).groupBy("feature", "value").agg(F.sum("rows").alias("rows"))
    found = counts.limit(MAX_VALUES + 1).collect()
    if len(found) > MAX_VALUES:
        return None
    by: dict[int, list] = {}
    for r in found:
        by.setdefault(r["feature"], []).append((r["value"], r["rows"]))
    bins = T.Bins.of([by[f] for f in range(len(by))], max_bins)
    return bins if math.prod(bins.sizes) < 1 << 62 else None


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _cell_codes(batches: Iterator[pa.RecordBatch], bins: T.Bins) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array(bins.codes(_vectors(b))), b.column("rows")], ["code", "rows"])


def _coded(batches: Iterator[pa.RecordBatch], bins: T.Bins, hot: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """Vectors to the number of their cell; rows of a hot cell get one of its ``salt`` values."""
    codes = np.array(sorted(hot), dtype=np.int64)
    salts = np.array([hot[c] for c in sorted(hot)], dtype=np.int64)
    for b in batches:
        if not b.num_rows:
            continue
        code = bins.codes(_vectors(b))
        salt = np.zeros(len(code), dtype=np.int64)
        if len(codes):
            at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            own = codes[at] == code
            salt[own] = (b.column("h").to_numpy()[own] >> 8) % salts[at[own]]
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(salt), b.column("fold"), b.column("h"), b.column("y")],
                                         ["code", "salt", "fold", "h", "y"])


def _summed(batches: Iterator[pa.RecordBatch], num_trees: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell and fold to each tree's (cell, fold, n, s, q), a block of rows at a time."""
    def block(rows: pa.Table) -> pa.RecordBatch:
        code, fold, h, y = (rows.column(c).to_numpy() for c in ("code", "fold", "h", "y"))
        starts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (fold[1:] != fold[:-1])])
        w = np.ones((len(h), num_trees + 1))
        w[:, :num_trees] = draw_matrix(h, num_trees)
        sums = [np.add.reduceat(w, starts, axis=0)]
        for _ in range(2):
            w *= y[:, None]
            sums.append(np.add.reduceat(w, starts, axis=0))
        code, fold = code[starts], fold[starts].astype(np.int8)
        out = {c: [] for c in ("code", "fold", "n", "s", "q")}
        for t in range(num_trees + 1):
            own = np.flatnonzero(sums[0][:, t])
            for c, v in zip(out, (code[own], fold[own], *(z[own, t] for z in sums))):
                out[c].append(v.tobytes())
        return pa.RecordBatch.from_arrays([pa.array(np.arange(num_trees + 1, dtype=np.int32)), *(pa.array(v, pa.binary()) for v in out.values())],
                                          ["tree", *out])

    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= BLOCK_ROWS:
            rows = pa.Table.from_batches(held)
            for at in range(0, n - BLOCK_ROWS + 1, BLOCK_ROWS):
                yield block(rows.slice(at, BLOCK_ROWS).combine_chunks())
            held = rows.slice(n - n % BLOCK_ROWS).to_batches()
            n %= BLOCK_ROWS
    if n:
        yield block(pa.Table.from_batches(held).combine_chunks())


_GROWN = pa.schema([("treeID", pa.int32()), T.NODE_TYPE, ("fold", pa.int32()), ("part", pa.int32()), ("predictions", pa.binary())])
_GROWN_DDL = f"treeID int, {T.NODE_DDL}, fold int, part int, predictions binary"


def _grown(table: pa.Table, bins: T.Bins, codes: np.ndarray, folds: int, tell: bool, **sizes) -> pa.Table:
    """One tree's nodes on all rows; with ``tell`` also predictions for the cells ``codes``, in parts:
    of the tree on the rows outside each fold, and at number ``folds`` of the tree on all rows."""
    def column(c, dtype):
        return np.concatenate([np.frombuffer(v, dtype=dtype) for v in table.column(c).to_pylist()])

    def rows(n, **columns):
        columns["treeID"] = pa.array(np.full(n, tree, dtype=np.int32))
        return pa.table([columns.get(f.name, pa.nulls(n, f.type)) for f in _GROWN], schema=_GROWN)

    tree = table.column("tree")[0].as_py()
    code, fold = column("code", np.int64), column("fold", np.int8).astype(np.int64)
    stats = [column(c, np.float64) for c in ("n", "s", "q")]
    if not len(code):
        return _GROWN.empty_table()
    cells, place = np.unique(code, return_inverse=True)
    key = fold * len(cells) + place
    order = np.lexsort((stats[2], stats[1], key))  # parts of a cell are added in the same order in every run
    by_fold = [np.bincount(key[order], v[order], max(1, folds) * len(cells)).reshape(-1, len(cells)) for v in stats]
    digits = bins.digits(cells)
    grown = T.grow(digits, bins, *(v.sum(axis=0) for v in by_fold), **sizes)
    nodes = T.node_table(grown)
    out = [rows(len(nodes), nodeData=nodes)]
    values = bins.values(bins.digits(codes)) if tell else None
    for k in range(folds + 1 if tell else 0):
        n, s, q = (np.delete(v, k, axis=0).sum(axis=0) if k < folds else None for v in by_fold)
        if k == folds or n.any():
            told = T.predict(grown if k == folds else T.grow(digits, bins, n, s, q, **sizes), values)
            parts = [told[at:at + CELLS_PER_PART].tobytes() for at in range(0, len(told), CELLS_PER_PART)]
            out.append(rows(len(parts), fold=pa.array(np.full(len(parts), k, dtype=np.int32)), part=pa.array(np.arange(len(parts), dtype=np.int32)),
                            predictions=pa.array(parts, pa.binary())))
    return pa.concat_tables(out)


def _averaged(table: pa.Table, num_trees: int) -> pa.Table:
    """The trees' mean prediction; the last tree, on every row once, stands for those without a drawn row."""
    told = {t: np.frombuffer(v, dtype=np.float64) for t, v in zip(table.column("treeID").to_pylist(), table.column("predictions").to_pylist())}
    every = told.pop(num_trees)
    mean = sum((told[t] for t in sorted(told)), (num_trees - len(told)) * every) / num_trees
    return pa.table([table.column("fold")[:1], table.column("part")[:1], pa.array([mean.tobytes()], pa.binary())], names=["fold", "part", "predictions"])


def _predicted(batches: Iterator[pa.RecordBatch], codes: np.ndarray, told: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each coded row's label, its prediction by the whole forest, and by the forest on the other folds' rows."""
    for b in batches:
        fold, at = b.column("fold").to_numpy(), np.searchsorted(codes, b.column("code").to_numpy())
        outside = pa.array(told[np.maximum(fold, 0), at], mask=fold < 0)
        yield pa.RecordBatch.from_arrays([b.column("y"), b.column("fold"), pa.array(told[-1, at]), outside], ["y", "fold", "whole", "outside"])


@dataclass
class Fitted:
    """A forest with what its cells tell of the rows: ``predicted`` has label, prediction and the test flag (cached until the
    caller releases it), ``errors`` each fold's mean absolute error under the forest on the other folds' rows (a fold without
    rows has none).

    Both are None where the vectors are too many and Spark ML fitted the trees.
    """
    model: RandomForestRegressionModel
    predicted: DataFrame | None = None
    errors: list[float | None] | None = None


class CellForest:
    """Fits ``estimator``'s forest on the cells of the rows; ``fit`` takes rows with a key column.

    The estimator's ``minInstancesPerNode`` counts drawn rows, as on rows.  Trees
    are grown side by side, as many as there are cores.  A tree that no row was
    drawn for (tiny tables) takes every row once.
    """

    def __init__(self, estimator: RandomForestRegressor, key: str = "unique_key"):
        self.estimator, self.key = estimator, key

    def fit(self, rows: DataFrame) -> RandomForestRegressionModel:
        return self._fit(rows.withColumns({"fold": F.lit(0), "is_test": F.lit(False)}), 0, None, False).model

    def fit_folds(self, rows: DataFrame, folds: int, min_split: int | None = None) -> Fitted:
        """The forest on the rows without ``is_test``, cut at ``min_split``, and ``folds`` forests on the rows outside each fold.

        All are grown from one pass over the rows.
        """
        return self._fit(rows.withColumn("fold", F.col("fold") % max(1, folds)), folds, min_split, True)

    def _fit(self, rows: DataFrame, folds: int, min_split: int | None, tell: bool) -> Fitted:
        spark, est = rows.sparkSession, self.estimator
        label = est.getLabelCol()
        rows = rows.select(F.xxhash64(F.lit(est.getSeed()).cast("long"), self.key).alias("h"), self.key, "features", F.col(label).cast("double").alias(label),
                           F.when(F.col("is_test"), -1).otherwise(F.col("fold")).cast("int").alias("fold"))
        vectors = rows.groupBy(vector_to_array("features").alias("x")).agg(F.count_if(F.col("fold") >= 0).alias("rows")).cache()
        try:
            size = vectors.agg(F.count(F.lit(1)).alias("cells"), F.sum("rows").alias("rows")).first()
            if not size["rows"]:
                raise ValueError("no rows to fit a forest on")
            few = size["cells"] * (folds + 1) <= MAX_CELLS
            bins = feature_bins(vectors, est.getMaxBins()) if few else None
            if bins is None:
                model = self._fit_by_tree(rows.filter("fold >= 0"))
                return Fitted(model if min_split is None else N.with_min_split(model, spark, min_split))
            importable(spark)
            cells = vectors.mapInArrow(functools.partial(_cell_codes, bins=bins), "code long, rows long").toArrow()
        finally:
            vectors.unpersist()
        codes, place = np.unique(cells.column("code").to_numpy(), return_inverse=True)
        counts = np.bincount(place, cells.column("rows").to_numpy(), len(codes)).astype(np.int64)
        salts = {int(c): -(-int(n) // ROWS_PER_TASK) for c, n in zip(codes, counts) if n > ROWS_PER_TASK}
        base = f"{shared_path(spark, 'forest')}-{uuid.uuid4().hex}"
        coded = rows.select("fold", "h", vector_to_array("features").alias("x"), F.col(label).alias("y")).mapInArrow(
            functools.partial(_coded, bins=bins, hot=salts), "code long, salt long, fold int, h long, y double")
        self._grow(coded.filter("fold >= 0"), bins, codes, size["rows"], folds, tell, min_split or 0).write.parquet(f"{base}/grown")
        grown = spark.read.schema(_GROWN_DDL).parquet(f"{base}/grown")
        fitted = Fitted(self._model(grown.filter("nodeData IS NOT NULL").select("treeID", "nodeData"), len(bins.sizes), base))
        if tell:
            told = self._predictions(grown, codes, folds)
            pred = coded.mapInArrow(functools.partial(_predicted, codes=codes, told=told), "y double, fold int, whole double, outside double")
            fitted.predicted = pred.select(F.col("y").alias(label), F.col("whole").alias("prediction"), "fold", "outside", (F.col("fold") < 0).alias("is_test")).cache()
            fitted.errors = self._fold_errors(fitted.predicted, folds)
        N.drop(spark, base)
        return fitted

    def _grow(self, coded: DataFrame, bins: T.Bins, codes: np.ndarray, n: int, folds: int, tell: bool, min_split: int) -> DataFrame:
        """``_grown`` of each tree and of a last one that takes every row once."""
        est = self.estimator
        trees = est.getNumTrees()
        sizes = {"max_depth": est.getMaxDepth(), "least": est.getMinInstancesPerNode(), "min_split": min_split}
        parts = max(coded.sparkSession.sparkContext.defaultParallelism, -(-n // ROWS_PER_TASK))
        # A cell's rows meet in one task (a hot cell's in several), so a task has few sums.
        dealt = coded.repartition(parts, "code", "salt").sortWithinPartitions("code", "fold", "h")
        sums = dealt.mapInArrow(functools.partial(_summed, num_trees=trees), "tree int, code binary, fold binary, n binary, s binary, q binary")
        return sums.repartition(trees + 1, "tree").groupBy("tree").applyInArrow(
            lambda table: _grown(table, bins, codes, folds, tell, **sizes), _GROWN_DDL)

    def _predictions(self, grown: DataFrame, codes: np.ndarray, folds: int) -> np.ndarray:
        """The forests' predictions for the cells, one line a fold and one for the whole forest."""
        trees = self.estimator.getNumTrees()
        means = grown.filter("predictions IS NOT NULL").select("treeID", "fold", "part", "predictions").groupBy("fold", "part").applyInArrow(
            lambda table: _averaged(table, trees), "fold int, part int, predictions binary").collect()
        told = np.full((folds + 1, len(codes)), np.nan)
        for r in means:
            at = r["part"] * CELLS_PER_PART
            told[r["fold"], at:at + CELLS_PER_PART] = np.frombuffer(r["predictions"], dtype=np.float64)
        return told

    def _fold_errors(self, pred: DataFrame, folds: int) -> list[float | None]:
        off = F.abs(F.col(self.estimator.getLabelCol()) - F.col("outside"))
        found = {r["fold"]: r["error"] for r in pred.filter("fold >= 0").groupBy("fold").agg(F.avg(off).alias("error")).collect()} if folds else {}
        if any(math.isnan(e) for e in found.values()):
            raise ValueError("no rows to fit a forest on")
        return [found.get(k) for k in range(folds)]

    def _model(self, nodes: DataFrame, num_features: int, base: str) -> RandomForestRegressionModel:
        spark, trees = nodes.sparkSession, self.estimator.getNumTrees()
        grown = {r["treeID"] for r in nodes.filter("nodeData.id = 0").select("treeID").collect()}
        own = nodes.filter(F.col("treeID") < trees)
        if missing := [t for t in range(trees) if t not in grown]:
            every = nodes.filter(F.col("treeID") == trees).select("nodeData")
            own = own.unionByName(every.select(F.explode(F.array(*map(F.lit, missing))).alias("treeID"), "nodeData"))
        self._leaves(spark, num_features).write().save(f"{base}/leaves")
        return N.with_nodes(spark, f"{base}/leaves", own, f"{base}/model")

    def _fit_by_tree(self, rows: DataFrame) -> RandomForestRegressionModel:
        est, spark = self.estimator, rows.sparkSession
        trees, label, seed = est.getNumTrees(), est.getLabelCol(), est.getSeed()
        cells = points(cell_table(rows, label, trees, seed, self.key), label)
        cells = cells.repartitionByRange("tree").sortWithinPartitions("tree").cache()  # a tree's points are next to each other
        try:
            sizes = {r["tree"]: r for r in cells.groupBy("tree").agg(F.count(F.lit(1)).alias("points"), F.sum("weight").alias("rows")).collect()}
            if not sizes:
                raise ValueError("no rows to fit a forest on")

            def fit_tree(t: int):
                own = t if t in sizes else trees
                parts = -(-sizes[own]["points"] // POINTS_PER_TASK)
                return self._tree(cells.filter(F.col("tree") == own).drop("tree").coalesce(parts), sizes[own]["rows"], seed + t)

            with ThreadPool(min(trees, spark.sparkContext.defaultParallelism)) as pool:
                fitted = pool.map(inheritable_thread_target(spark)(fit_tree), range(trees), chunksize=1)
        finally:
            cells.unpersist()
        return self._forest(spark, [m._java_obj.trees()[0] for m in fitted], fitted[0].numFeatures)

    def _tree(self, own: DataFrame, drawn: float, seed: int) -> RandomForestRegressionModel:
        est = self.estimator
        least = est.getMinInstancesPerNode()
        single = est.copy({
            est.numTrees: 1, est.bootstrap: False, est.seed: seed, est.weightCol: "weight", est.cacheNodeIds: False,
            # The least weight is a share of all; half a row less keeps it clear of rounding.
            est.minInstancesPerNode: 1, est.minWeightFractionPerNode: min(0.499, max(0.0, least - 0.5) / drawn),
            est.maxDepth: est.getMaxDepth() if drawn >= 2 * least else 0})
        return single.fit(own)

    def _leaves(self, spark, num_features: int) -> RandomForestRegressionModel:
        """A forest of single leaves: what is saved of it takes the grown nodes."""
        jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        calculator = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(gateway.new_array(jvm.double, 3), 0)
        leaf = jvm.org.apache.spark.ml.tree.LeafNode(0.0, 0.0, calculator)
        tree = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
        return self._forest(spark, [tree(leaf, num_features) for _ in range(self.estimator.getNumTrees())], num_features)

    def _forest(self, spark, trees: list, num_features: int) -> RandomForestRegressionModel:
        """One model of all trees, with the estimator's parameters."""
        jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        ml = jvm.org.apache.spark.ml.regression
        own = gateway.new_array(ml.DecisionTreeRegressionModel, len(trees))
        for i, tree in enumerate(trees):
            own[i] = tree
        uid = jvm.org.apache.spark.ml.util.Identifiable.randomUID("rfr")
        model = RandomForestRegressionModel(ml.RandomForestRegressionModel(uid, own, num_features))
        model = self.estimator._copyValues(model)
        model._transfer_params_to_java()
        return model
