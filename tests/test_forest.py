"""Minimum split by pruning, node memory, importances and the saved bundle."""

import json
import os
import random
import tempfile

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import functions as F

from civicflow.plans import bundle as B
from civicflow.plans import forest as N
from civicflow.plans import model as M
from test_io_model_plans import _signal


def _rows(n, seed, wide=9):
    rnd = random.Random(seed)
    return [([float(rnd.randrange(wide)), float(rnd.randrange(4)), float(rnd.randrange(12))], rnd.gauss(0, 1)) for _ in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame([(Vectors.dense(x), y) for x, y in rows], ["features", M.LABEL])


def grow(rows, min_split, min_leaf=2, depth=15):
    """Plain recursion: the mean of each row's leaf, by row number."""
    def variance(part):
        mean = sum(rows[i][1] for i in part) / len(part)
        return sum((rows[i][1] - mean) ** 2 for i in part)

    out = {}

    def split(part, left):
        best = None
        if left and len(part) >= min_split:
            for f in range(len(rows[0][0])):
                values = sorted({rows[i][0][f] for i in part})
                for a, b in zip(values, values[1:]):
                    low = [i for i in part if rows[i][0][f] <= (a + b) / 2]
                    high = [i for i in part if rows[i][0][f] > (a + b) / 2]
                    if min(len(low), len(high)) >= min_leaf:
                        gain = variance(part) - variance(low) - variance(high)
                        if best is None or gain > best[0] + 1e-12:
                            best = (gain, low, high)
        if best is None:
            mean = sum(rows[i][1] for i in part) / len(part)
            out.update((i, mean) for i in part)
        else:
            split(best[1], left - 1)
            split(best[2], left - 1)
    split(list(range(len(rows))), depth)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pruned_tree_equals_the_recursion(spark, seed):
    rows = _rows(50, seed)
    df = _frame(spark, rows)
    est = M.forest(num_trees=1).setBootstrap(False)
    model = N.with_min_split(est.fit(df), spark)
    got = [r.prediction for r in model.transform(df.coalesce(1)).collect()]
    want = grow(rows, N.MIN_SPLIT)
    assert got == pytest.approx([want[i] for i in range(50)])
    loose = [r.prediction for r in est.fit(df).transform(df.coalesce(1)).collect()]
    assert loose != pytest.approx(got)  # the minimum split matters on these rows


@pytest.mark.parametrize("least", [2, 5, 9, 10 ** 6])
def test_no_inner_node_is_small(spark, least):
    df = _frame(spark, _rows(400, 7))
    grown = M.forest(num_trees=6, max_depth=8).fit(df)
    cut = N.with_min_split(grown, spark, least)
    base = tempfile.mkdtemp()
    grown.write().save(f"{base}/a")
    cut.write().save(f"{base}/b")
    a = {(r.treeID, r.id): r for r in N.node_table(f"{base}/a", spark).select("treeID", "nodeData.*").collect()}
    b = {(r.treeID, r.id): r for r in N.node_table(f"{base}/b", spark).select("treeID", "nodeData.*").collect()}

    def walk(t, i, j):
        """Node i of the grown tree beside node j of the cut one; the number of nodes of both below the cut."""
        x, y = a[t, i], b[t, j]
        assert (x.prediction, x.rawCount, x.impurityStats) == (y.prediction, y.rawCount, y.impurityStats)
        if x.leftChild < 0 or x.rawCount < least:
            assert (y.leftChild, y.rightChild, y.gain, y.split.featureIndex) == (-1, -1, -1.0, -1)
            return 1
        assert y.split == x.split and y.gain == x.gain and y.leftChild == j + 1
        return 1 + walk(t, x.leftChild, y.leftChild) + walk(t, x.rightChild, y.rightChild)

    for t in range(6):
        n = walk(t, 0, 0)
        assert sorted(i for tt, i in b if tt == t) == list(range(n))
    assert cut.getNumTrees == 6 and cut.numFeatures == grown.numFeatures and cut.params == grown.params
    if least == 10 ** 6:
        assert cut.totalNumNodes == 6
    own = {r.feature: r.importance for r in N.importances(N.node_table(f"{base}/b", spark)).collect()}
    told = cut.featureImportances.toArray()
    assert all(abs(own.get(i, 0.0) - v) < 1e-9 for i, v in enumerate(told))


def test_node_memory_follows_the_open_nodes():
    small = N.node_memory_mb(150, 100, 5, 10 ** 9, 2)
    deep = N.node_memory_mb(150, 100, 15, 10 ** 9, 2)
    few = N.node_memory_mb(150, 100, 15, 400, 2)
    assert small == 16 and deep == N.MEMORY_LIMIT_MB and few < deep
    assert N.node_memory_mb(150, 100, 10, 10 ** 9, 2) == int(100 * 512 * 150 * 24 / (1 << 20)) + 1


def test_trees_do_not_depend_on_the_memory(spark):
    df = _frame(spark, _rows(300, 11))
    a, b = (M.forest(num_trees=5, max_depth=6, max_memory_mb=m).fit(df) for m in (1, 256))
    assert a.toDebugString.split("\n", 1)[1] == b.toDebugString.split("\n", 1)[1]


def test_report_has_the_folds_error(spark):
    """M14's cross-validation row is M9's number on the same rows."""
    df = _signal(spark, 600)
    sizes = dict(num_trees=4, max_depth=5)
    res = M.train_random_forest(df, cv_folds=3, **sizes)
    report = {(r.split, r.metric): r.value for r in M.model_report(res).collect()}
    data = M.prepare(df)
    train = M.encode(data.filter("NOT is_test")).transform(data).filter("NOT is_test").select("features", M.LABEL, "fold")
    # Spark draws its samples by partition: the same layout gives the same trees.
    own = M.cross_validated_mae(train, M.forest(**sizes), 3, lambda m: N.with_min_split(m, spark))
    assert report["cv", "mae"] == res.cv_mae == pytest.approx(own, rel=0.05)
    assert M.train_random_forest(df, cv_folds=0, **sizes).cv_mae is None


def _saved(spark, **kw):
    res = M.train_random_forest(_signal(spark, 400), num_trees=3, max_depth=4, cv_folds=0, **kw)
    path = f"{tempfile.mkdtemp()}/model"
    return M.save_model(res, path), res


def test_bundle_tells_what_it_was_trained_on(spark):
    path, res = _saved(spark, test_size=0.25, seed=7)
    m = B.read_manifest(spark, path)
    assert m.features == M.FEATURES and m.label == M.LABEL and m.split == {"test_size": 0.25, "seed": 7}
    assert (m.train_size, m.test_size) == (res.train_size, res.test_size)
    assert m.sizes["min_split"] == 5 and len(m.importance) == len(M.FEATURES)
    assert sorted(m.label_maps["complaint_category"]) == m.label_maps["complaint_category"]
    df = _signal(spark, 400)
    a = M.score(res.model, df).select("unique_key", "predicted_days").collect()
    b = M.score(M.load_model(spark, path), df).select("unique_key", "predicted_days").collect()
    assert sorted(a) == sorted(b)
    M.save_model(res, path)  # a second save replaces the first
    assert M.load_model(spark, path) is not None


def test_bundle_is_checked_at_load(spark, monkeypatch):
    path, _ = _saved(spark)
    with pytest.raises(FileNotFoundError):
        M.load_model(spark, f"{path}-elsewhere")
    monkeypatch.setattr(M, "FEATURES", M.FEATURES[::-1])
    with pytest.raises(B.ModelMismatch, match="features"):
        M.load_model(spark, path)
    monkeypatch.undo()
    changed = type(M.S.CLEAN)(M.S.CLEAN.fields[1:])
    with pytest.raises(B.ModelMismatch, match="inputs"):
        B.load(spark, path, list(M.FEATURES), M.LABEL, B.inputs_digest(changed))

    def rewrite(**new):
        (part,) = [f for f in os.listdir(f"{path}/manifest") if f.startswith("part-")]
        line = json.load(open(f"{path}/manifest/{part}"))
        spark.createDataFrame([(json.dumps(line | new),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
        return line
    line = rewrite(stages=["StringIndexerModel"])
    with pytest.raises(B.ModelMismatch, match="stages"):
        M.load_model(spark, path)
    maps = {k: v[::-1] for k, v in line["label_maps"].items()}
    rewrite(stages=line["stages"], label_maps=maps)
    with pytest.raises(B.ModelMismatch, match="labels"):
        M.load_model(spark, path)
    rewrite(format=99)
    with pytest.raises(B.ModelMismatch, match="format"):
        M.load_model(spark, path)


def test_unfinished_save_is_no_model(spark):
    path, _ = _saved(spark)
    os.rename(f"{path}/manifest", f"{path}/elsewhere")
    with pytest.raises(FileNotFoundError):
        M.load_model(spark, path)


def test_loaded_forest_is_a_spark_model(spark):
    path, _ = _saved(spark)
    model = M.load_model(spark, path)
    assert isinstance(model.stages[-1], RandomForestRegressionModel)
    assert model.transform(M.engineer_features(_signal(spark, 50))).filter(F.col("prediction").isNull()).count() == 0
