"""Trees grown in one task each: a fixed number of jobs a fit, the same trees and errors as fitted one by one."""

import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from civicflow.plans import cells as K
from civicflow.plans import forest as N
from civicflow.plans import model as M
from civicflow.plans import trees as T
from test_cells import _frame, _rows


def _jobs(spark, run):
    """Spark jobs that ``run`` starts, and what it returns."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        out = run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")), out
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def _folded(df):
    return df.withColumns({"fold": (F.col("unique_key") % 5).cast("int"), "is_test": F.col("unique_key") % 11 == 10})


def test_jobs_do_not_follow_trees_and_folds(spark):
    """A job or more a level, tree and fold before."""
    df = _folded(_frame(spark, _rows(400, 21)))
    n, fitted = _jobs(spark, lambda: K.CellForest(M.forest(num_trees=40)).fit_folds(df, 5, N.MIN_SPLIT))
    assert fitted.model.getNumTrees == 40 and len(fitted.errors) == 5
    assert n <= 40


def test_fold_errors_equal_those_of_fitted_folds(spark):
    df = _folded(_frame(spark, _rows(300, 4)).filter("unique_key % 5 <> 4"))
    est = K.CellForest(M.forest(num_trees=3))
    got = est.fit_folds(df, 5, N.MIN_SPLIT)
    train = df.filter("NOT is_test")
    own = M.cross_validated_mae(train, est, 5, lambda m: N.with_min_split(m, spark))
    assert got.errors[4] is None and M.cross_validated_mae(train, est, 5, errors=got.errors) == pytest.approx(own, abs=1e-12)
    want = got.model.transform(df).select("is_test", M.LABEL, "prediction").collect()
    assert sorted(map(tuple, got.predicted.select("is_test", M.LABEL, "prediction").collect())) == [
        (t, y, pytest.approx(p, abs=1e-12)) for t, y, p in sorted(map(tuple, want))]


def test_grown_with_the_minimum_split_is_cut_at_it(spark):
    df = _folded(_frame(spark, _rows(300, 8)))
    est = K.CellForest(M.forest(num_trees=3))
    grown = est.fit_folds(df, 0, N.MIN_SPLIT).model
    cut = N.with_min_split(est.fit(df.filter("NOT is_test")), spark)
    assert grown.toDebugString.split("\n", 1)[1] == cut.toDebugString.split("\n", 1)[1]


def test_too_many_cells_are_fitted_by_spark(spark, monkeypatch):
    df = _folded(_frame(spark, _rows(200, 6)))
    est = K.CellForest(M.forest(num_trees=2, max_depth=5))
    train = df.filter("NOT is_test")
    small = [r.prediction for r in est.fit(train).transform(train).orderBy("unique_key").collect()]
    monkeypatch.setattr(K, "MAX_CELLS", 0)
    large = est.fit_folds(df, 5)
    assert large.errors is None and large.predicted is None
    assert [r.prediction for r in large.model.transform(train).orderBy("unique_key").collect()] == pytest.approx(small)


def test_draw_matrix_is_the_draws(spark):
    rows = spark.range(3000).select(F.xxhash64(F.lit(42).cast("long"), "id").alias("h"), K.draws(7, 42, "id").alias("w")).collect()
    got = K.draw_matrix(np.array([r.h for r in rows], dtype=np.int64), 7)
    assert got.tolist() == [[int(w) for w in r.w] for r in rows]


def test_rows_of_a_hot_cell_are_dealt_out(spark, monkeypatch):
    df = _frame(spark, [([0.0, 0.0, 0.0], float(i % 7)) for i in range(500)] + _rows(50, 2))
    est = K.CellForest(M.forest(num_trees=2))
    plain = est.fit(df).toDebugString.split("\n", 1)[1]
    monkeypatch.setattr(K, "ROWS_PER_TASK", 60)
    monkeypatch.setattr(K, "BLOCK_ROWS", 16)
    assert est.fit(df).toDebugString.split("\n", 1)[1] == plain


def _grown(x, y, max_bins=64):
    x = np.array(x, dtype=np.float64)
    bins = T.Bins.of([[(v, int(n)) for v, n in zip(*np.unique(c, return_counts=True))] for c in x.T], max_bins)
    codes = bins.codes(x)
    levels = T.grow(bins.digits(codes), bins, np.ones(len(y)), np.array(y), np.array(y) ** 2, 15, 2)
    return bins, levels, T.predict(levels, bins.values(bins.digits(codes)))


def test_missing_values_go_right(spark):
    _, levels, told = _grown([[1.0], [1.0], [2.0], [2.0], [math.nan], [math.nan]], [0.0, 0.0, 5.0, 5.0, 9.0, 9.0])
    assert told.tolist() == [0, 0, 5, 5, 9, 9]
    assert all(np.isfinite(lv[5]).all() for lv in levels)


def test_many_values_share_bins(spark):
    """More values than bins: thresholds between bins of about equal rows, and a bin is not split."""
    x = [[float(v)] for v in range(1000)]
    bins, levels, told = _grown(x, [float(v) for v in range(1000)], 32)
    assert bins.sizes == [32]
    assert {float(t) for lv in levels for t in lv[5][lv[4] >= 0]} <= {float((a + b) / 2) for a, b in zip(bins.high[0], bins.low[0][1:])}
    assert len(set(told)) == 32 and (np.bincount(bins.codes(np.array(x))) >= 30).all()


def test_equal_gains_take_the_first_feature(spark):
    _, levels, _ = _grown([[float(i % 2), float(i % 2), 3.0 * (i % 2)] for i in range(40)], [0.1 * (i % 2) + 1e-3 * i for i in range(40)])
    assert levels[0][4].tolist() == [0] and levels[0][5].tolist() == [0.5]
