"""The forest's saved node table: minimum split size, and node memory of a fit.

Spark ML has a minimum for leaves only.  A node of fewer rows than the minimum
split has only such nodes below it, so cutting the fitted trees there gives the
trees that growing with the minimum would have given.  The node table of a saved
model is changed as a DataFrame and loaded again.
"""

from __future__ import annotations

import uuid

from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_path

MIN_SPLIT = 5
STAT_BYTES = 3 * 8  # count, sum and sum of squares of one bin
MEMORY_LIMIT_MB = 512


def node_table(model_path: str, spark) -> DataFrame:
    """(treeID, nodeData) rows of a saved forest."""
    return spark.read.parquet(f"{model_path}/data")


def prune_nodes(nodes: DataFrame, min_split: int = MIN_SPLIT) -> DataFrame:
    """Inner nodes with fewer than ``min_split`` rows become leaves; what was below them goes.

    Node numbers stay the places in preorder: a left child follows its parent,
    a right child's new number is looked up.  Rows of a node are those drawn
    for its tree, with repeats: the first of its statistics, also where the
    tree was fitted on weighted points (``cells``).
    """
    inner = (F.col("leftChild") >= 0) & (F.col("rawCount") >= min_split)
    flat = nodes.select("treeID", "nodeData.*").withColumn("rawCount", F.round(F.element_at("impurityStats", 1)).cast("long"))
    links = flat.select("treeID", "id", "leftChild", "rightChild", inner.alias("inner"))
    # A node stays if its parent stays inner; counts only fall on the way down.
    below = links.filter("inner").select("treeID", F.explode(F.array("leftChild", "rightChild")).alias("id"))
    roots = links.filter("id = 0").select("treeID", "id")
    place = F.row_number().over(Window.partitionBy("treeID").orderBy("id")) - 1
    kept = links.join(below.unionByName(roots), ["treeID", "id"], "left_semi").withColumn("place", place)
    right = kept.select("treeID", F.col("id").alias("rightChild"), F.col("place").alias("rightPlace"))
    numbered = kept.join(right, ["treeID", "rightChild"], "left").select("treeID", "id", "inner", "place", "rightPlace")
    joined = flat.join(numbered, ["treeID", "id"])

    def either(yes, no):
        return F.when(F.col("inner"), yes).otherwise(no)

    leaf_split = F.struct(F.lit(-1).alias("featureIndex"), F.array().cast("array<double>").alias("leftCategoriesOrThreshold"),
                          F.lit(-1).alias("numCategories"))
    data = F.struct(
        F.col("place").alias("id"), "prediction", "impurity", "impurityStats", "rawCount",
        either(F.col("gain"), F.lit(-1.0)).alias("gain"),
        either(F.col("place") + 1, F.lit(-1)).alias("leftChild"),
        either(F.col("rightPlace"), F.lit(-1)).alias("rightChild"),
        either(F.col("split"), leaf_split).alias("split"))
    return joined.select("treeID", data.alias("nodeData"))


def with_min_split(model: RandomForestRegressionModel, spark, min_split: int = MIN_SPLIT) -> RandomForestRegressionModel:
    """The forest with its trees cut at ``min_split`` rows, by way of the shared folder.

    Loading reads the whole model, so the folder is dropped again.
    """
    base = f"{shared_path(spark, 'forest')}-{uuid.uuid4().hex}"
    model.write().save(f"{base}/grown")
    cut = with_nodes(spark, f"{base}/grown", prune_nodes(node_table(f"{base}/grown", spark), min_split), f"{base}/cut")
    drop(spark, base)
    return cut


def with_nodes(spark, saved: str, nodes: DataFrame, path: str) -> RandomForestRegressionModel:
    """The forest saved at ``saved`` with other nodes, by way of the folder ``path``, which is dropped again."""
    nodes.write.parquet(f"{path}/data")
    spark.read.parquet(f"{saved}/treesMetadata").write.parquet(f"{path}/treesMetadata")
    spark.read.text(f"{saved}/metadata").coalesce(1).write.text(f"{path}/metadata")
    loaded = RandomForestRegressionModel.load(path)  # reads the whole model
    drop(spark, path)
    return loaded


def drop(spark, path: str) -> None:
    """Removes a folder of the shared store."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def importances(nodes: DataFrame) -> DataFrame:
    """(feature, importance) from a node table: gain times rows of each tree's splits, as shares, averaged."""
    splits = nodes.filter("nodeData.leftChild >= 0").select(
        "treeID", F.col("nodeData.split.featureIndex").alias("feature"),
        (F.col("nodeData.gain") * F.element_at("nodeData.impurityStats", 1)).alias("gain"))
    by_tree = splits.groupBy("treeID", "feature").agg(F.sum("gain").alias("gain"))
    share = by_tree.withColumn("share", F.col("gain") / F.sum("gain").over(Window.partitionBy("treeID")))
    total = share.groupBy("feature").agg(F.sum("share").alias("s"))
    return total.select("feature", (F.col("s") / F.sum("s").over(Window.partitionBy())).alias("importance"))


def node_memory_mb(bins: int, num_trees: int, max_depth: int, rows: int, min_leaf: int,
                   limit_mb: int = MEMORY_LIMIT_MB) -> int:
    """Megabytes of statistics that hold all nodes open at one level, at most ``limit_mb``.

    A level has at most ``2 ** depth`` nodes a tree, and no more than its rows
    fill.  With that much memory each level is one pass over the data; beyond
    the limit a level takes ``need / limit_mb`` passes.
    """
    open_nodes = num_trees * min(1 << max(0, max_depth - 1), max(1, rows // (2 * min_leaf)))
    need = open_nodes * bins * STAT_BYTES / (1 << 20)
    return max(16, min(limit_mb, int(need) + 1))
