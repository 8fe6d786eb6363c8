"""The forest fitted on distinct feature vectors is the forest of the drawn rows."""

import random
from collections import Counter

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from civicflow.plans import cells as K
from civicflow.plans import forest as N
from civicflow.plans import model as M
from test_forest import grow

TREES = 5


def _rows(n, seed):
    rnd = random.Random(seed)
    return [([float(rnd.randrange(6)), float(rnd.randrange(3)), float(rnd.randrange(4))], rnd.gauss(3, 1)) for _ in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame([(i, Vectors.dense(x), y) for i, (x, y) in enumerate(rows)], ["unique_key", "features", M.LABEL])


def _draws(df, trees=TREES, seed=42):
    return {r.unique_key: [int(w) for w in r.w] for r in df.select("unique_key", K.draws(trees, seed).alias("w")).collect()}


@pytest.mark.parametrize("n", [60, 300])
def test_trees_equal_the_recursion_on_drawn_rows(spark, n):
    rows = _rows(n, n)
    df = _frame(spark, rows)
    model = N.with_min_split(K.CellForest(M.forest(num_trees=TREES)).fit(df), spark)
    drawn = _draws(df)
    assert model.getNumTrees == TREES
    for t, tree in enumerate(model.trees):
        own = [i for i in range(n) for _ in range(drawn[i][t])]
        want = grow([rows[i] for i in own], N.MIN_SPLIT)
        got = [tree.predict(Vectors.dense(rows[i][0])) for i in own]
        assert got == pytest.approx([want[j] for j in range(len(own))])


def test_node_table_counts_drawn_rows(spark, tmp_path):
    rows = _rows(300, 5)
    df = _frame(spark, rows)
    model = N.with_min_split(K.CellForest(M.forest(num_trees=TREES)).fit(df), spark)
    model.write().save(f"{tmp_path}/m")
    nodes = N.node_table(f"{tmp_path}/m", spark).select("treeID", "nodeData.*").collect()
    drawn = _draws(df)
    for r in nodes:
        if r.id == 0:
            y = [rows[i][1] for i in range(300) for _ in range(drawn[i][r.treeID])]
            assert r.rawCount == len(y)
            assert r.impurityStats[:3] == pytest.approx([len(y), sum(y), sum(v * v for v in y)])
        assert r.rawCount >= 2 and (r.leftChild < 0 or r.rawCount >= N.MIN_SPLIT)


def test_partitions_and_order_do_not_matter(spark):
    df = _frame(spark, _rows(400, 9))
    est = K.CellForest(M.forest(num_trees=3, max_depth=6))
    a, b = (est.fit(x).transform(df).select("unique_key", "prediction").orderBy("unique_key").collect()
            for x in (df.coalesce(1), df.orderBy(F.rand(1)).repartition(7)))
    assert [r.prediction for r in a] == pytest.approx([r.prediction for r in b])


def test_fit_sees_cells_not_rows(spark):
    """Four times the rows of the same vectors: the same cells, at most two points each."""
    few, many = (_frame(spark, _rows(500, 3) * k) for k in (1, 4))
    vectors = len({tuple(x) for x, _ in _rows(500, 3)})
    for df in (few, many):
        cells = K.cell_table(df, M.LABEL, 2, 42)
        assert cells.filter("tree = 2").count() == vectors and cells.count() <= 3 * vectors
        assert K.points(cells, M.LABEL).count() == 2 * cells.count()


def test_draws_are_poisson(spark):
    got = Counter(r.w for r in spark.range(200_000).select(K.draws(4, 42, "id")[3].alias("w")).collect())
    assert [got[j] / 200_000 for j in range(4)] == pytest.approx([0.36788, 0.36788, 0.18394, 0.06131], abs=0.005)
    w = spark.range(50_000).select(K.draws(2, 42, "id").alias("w"))
    assert abs(w.select(F.corr(F.col("w")[0], F.col("w")[1])).first()[0]) < 0.03


@pytest.mark.parametrize("n", [1, 2, 3])
def test_tiny_tables(spark, n):
    """A tree without a drawn row takes every row once; no split leaves fewer rows than the leaf minimum."""
    model = K.CellForest(M.forest(num_trees=8)).fit(_frame(spark, [([float(i)] * 3, 2.0) for i in range(n)]))
    assert model.getNumTrees == 8 and model.totalNumNodes == 8
    assert model.predict(Vectors.dense([0.0] * 3)) == pytest.approx(2.0)


def test_no_rows(spark):
    with pytest.raises(ValueError, match="no rows"):
        K.CellForest(M.forest(num_trees=2)).fit(_frame(spark, _rows(5, 1)).filter("unique_key < 0"))
