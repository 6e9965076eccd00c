"""A trained forest as a table of nodes; importance and scoring over it (M3, M4).

The table has one row per node, so it can be read, checked and joined like any
other: ``tree, node, prediction, impurity, gain, weight, rows, left, right,
feature, threshold, probabilities``. Leaves have null children.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def save_forest(model: RandomForestClassificationModel, path: str) -> str:
    """Write the model; its own folder ``data`` holds the nodes."""
    model.write().overwrite().save(path)
    return path


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """Nodes of a model saved at ``path``; categorical splits are not expected,
    as all features are numbers."""
    n = F.col("nodeData")
    total = F.aggregate(n["impurityStats"], F.lit(0.0), lambda a, x: a + x)
    inner = n["leftChild"] >= 0

    def only(c: Column) -> Column:
        return F.when(inner, c)

    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        n["id"].alias("node"),
        n["prediction"].alias("prediction"),
        n["impurity"].alias("impurity"),
        only(n["gain"]).alias("gain"),
        total.alias("weight"),
        n["rawCount"].alias("rows"),
        only(n["leftChild"]).alias("left"),
        only(n["rightChild"]).alias("right"),
        only(n["split"]["featureIndex"]).alias("feature"),
        only(F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(total > 0, F.transform(n["impurityStats"], lambda x: x / total)).otherwise(F.transform(n["impurityStats"], lambda x: F.lit(0.0))).alias("probabilities"),
    )


def named(nodes: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Feature numbers with their names; a row per feature."""
    return nodes.sparkSession.createDataFrame(list(enumerate(cols)), "feature int, name string")


def importance_table(nodes: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``feature, importance``: weighted gain of the splits on a feature, as a
    share of its tree's, summed over the trees and scaled to one. Features that
    no tree splits on have 0."""
    splits = nodes.filter(F.col("feature").isNotNull())
    gained = splits.groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("won"))
    of_tree = gained.groupBy(F.col("tree").alias("_tree")).agg(F.sum("won").alias("_all"))
    shares = gained.join(of_tree, F.col("tree") == F.col("_tree")).groupBy("feature").agg(F.sum(F.try_divide("won", "_all")).alias("share"))
    total = shares.agg(F.sum("share")).scalar()
    return (
        named(nodes, cols)
        .join(shares, "feature", "left")
        .select(F.col("name").alias("feature"), F.coalesce(F.try_divide(F.col("share"), total), F.lit(0.0)).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )


def forest_shape(nodes: DataFrame, depth: int) -> DataFrame:
    """``tree, nodes, leaves, depth, rows``: size of every tree. Walks down level
    by level over the table, at most ``depth`` joins."""
    links = nodes.select("tree", F.explode(F.array("left", "right")).alias("node"), F.col("node").alias("parent")).filter(F.col("node").isNotNull())
    level = nodes.filter(F.col("node") == 0).select("tree", "node", F.lit(0).alias("depth"))
    levels = level
    for i in range(1, depth + 1):
        below = links.select("tree", F.col("node").alias("child"), F.col("parent").alias("node"))
        level = level.select("tree", "node").join(below, ["tree", "node"]).select("tree", F.col("child").alias("node"), F.lit(i).alias("depth"))
        levels = levels.unionByName(level)
    sized = nodes.join(levels, ["tree", "node"], "left")
    return sized.groupBy("tree").agg(
        F.count(F.lit(1)).alias("nodes"), F.count_if(F.col("left").isNull()).alias("leaves"), F.max("depth").alias("depth"),
        F.max(F.when(F.col("node") == 0, F.col("rows"))).alias("rows"),
    )


def score_by_nodes(df: DataFrame, nodes: DataFrame, trees: int, depth: int, key: str, features: str = "values", keep: Sequence[str] = ()) -> DataFrame:
    """``key, keep, p, prediction``: probability of class 1 by walking all trees.

    ``features`` is an array. A row takes one step per level in every tree; the
    nodes are broadcast, at most ``trees * 2 ** (depth + 1)`` rows by the model's
    parameters, so rows stay where they are until their trees are averaged.
    Value at most the threshold goes left. Ties of the two classes go to 0, as
    does a row whose leaves are all empty.
    """
    table = nodes.select("tree", "node", "left", "right", "feature", "threshold", F.get("probabilities", F.lit(1)).alias("p1"), F.get("probabilities", F.lit(0)).alias("p0"))
    start = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    at = df.select(key, *keep, features, start).withColumn("node", F.lit(0))
    for _ in range(depth):
        step = at.join(F.broadcast(table), ["tree", "node"])
        value = F.get(features, F.col("feature"))
        gone = F.when(F.col("left").isNull(), F.col("node")).when(value <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = step.select(key, *keep, features, "tree", gone.alias("node"))
    leaves = at.join(F.broadcast(table.select("tree", "node", "p0", "p1")), ["tree", "node"])
    votes = leaves.groupBy(key, *keep).agg(F.sum("p0").alias("_v0"), F.sum("p1").alias("_v1"))
    p = F.coalesce(F.try_divide(F.col("_v1"), F.col("_v0") + F.col("_v1")), F.lit(0.0))
    return votes.select(key, *keep, p.alias("p"), F.when(F.col("_v1") > F.col("_v0"), 1.0).otherwise(0.0).alias("prediction"))
