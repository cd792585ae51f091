"""Isolation forest: per-tree samples are drawn and shuffled by Spark, each tree is grown in one small group."""

from __future__ import annotations

import json
from dataclasses import dataclass
from math import ceil, log, log2, sqrt

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logquarry.fixed_values import CONTAMINATION_RANGE, ISOLATION_SAMPLE, ISOLATION_TREES, SEED
from logquarry.operators.ranking import exact_quantiles

NODE_SCHEMA = "tree int, node int, feature int, threshold double, left_child int, right_child int, path double"
EULER = 0.5772156649015329


def average_path(n: int) -> float:
    """Mean depth of an unsuccessful search in a binary search tree of n rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


def clipped_contamination(train: DataFrame, label: str = "is_anomaly", bounds=CONTAMINATION_RANGE) -> float:
    rate = train.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0
    return max(bounds[0], min(float(rate), bounds[1]))


def tree_samples(
    df: DataFrame, key: list[str], features: Column, n: int, trees: int = ISOLATION_TREES,
    sample: int = ISOLATION_SAMPLE, seed: int = SEED,
) -> DataFrame:
    """(tree, place, features): `min(sample, n)` distinct rows for every tree.

    Each row decides by hash which trees it may join, at a rate that overshoots the sample by six standard
    deviations; the lowest hashes of each tree are kept. One pass, one small shuffle, and the same rows
    whatever the partitioning. `key` must tell rows apart. Every row meets every tree, so the hashes are compared in a
    plain filter behind the explode, which Spark compiles; a lambda over the trees would be interpreted.
    """
    size = min(sample, n)
    rate = min(1.0, (size + 6.0 * sqrt(size) + 10.0) / n)
    bound = min(int(-(2**63) + rate * 2**64), 2**63 - 1)

    def draw(tree: Column) -> Column:
        return F.xxhash64(F.lit(seed), tree, F.col("_row"))

    rows = df.select(F.xxhash64(*key).alias("_row"), features.alias("features"), *key)
    met = rows.select(F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "_row", "features", *key)
    drawn = met.where(draw(F.col("tree")) <= bound)
    order = Window.partitionBy("tree").orderBy(draw(F.col("tree")), *key)
    return (
        drawn.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= size)
        .select("tree", "place", "features")
    )


def grow_tree(points: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes (node, feature, threshold, left, right, path); leaves have feature -1 and a path length."""
    nodes: list[list] = [[0, -1, 0.0, -1, -1, 0.0]]
    open_nodes = [(0, np.arange(len(points)), 0)]
    while open_nodes:
        node, rows, depth = open_nodes.pop()
        low, high = points[rows].min(axis=0), points[rows].max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(usable):
            nodes[node][5] = depth + average_path(len(rows))
            continue
        feature = int(rng.choice(usable))
        threshold = float(rng.uniform(low[feature], high[feature]))
        if threshold >= high[feature]:
            threshold = float(low[feature])
        goes_left = points[rows, feature] <= threshold
        for side, chosen in ((3, rows[goes_left]), (4, rows[~goes_left])):
            nodes[node][side] = len(nodes)
            nodes.append([len(nodes), -1, 0.0, -1, -1, 0.0])
            open_nodes.append((nodes[node][side], chosen, depth + 1))
        nodes[node][1], nodes[node][2] = feature, threshold
    return [tuple(n) for n in nodes]


def walkable(feature: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(feature, children, steps) of a tree whose rows can all be moved down together.

    A node's children stand side by side; a leaf is its own child on both sides, so that a row that has arrived stays
    there. After `steps` moves every row has.
    """
    leaf, node = feature < 0, np.arange(len(feature))
    children = np.stack([np.where(leaf, node, left), np.where(leaf, node, right)], axis=1).astype(np.intp)
    steps, reached = 0, np.flatnonzero(~leaf[:1])
    while len(reached):
        below = children[reached].ravel()
        reached, steps = below[~leaf[below]], steps + 1
    return np.maximum(feature, 0).astype(np.intp), children.ravel(), steps


@dataclass
class IsolationForest:
    """Node table (at most trees x 2 x sample rows, whatever the data size) and the decision threshold."""

    nodes: pd.DataFrame
    sample_size: int
    threshold: float | None = None
    contamination: float | None = None

    def score_column(self, features: Column) -> Column:
        """Anomaly score 2^(-mean path / c(sample)); higher is more anomalous."""
        trees = []
        for _, part in self.nodes.sort_values(["tree", "node"]).groupby("tree"):
            feature, left, right = (part[c].to_numpy() for c in ("feature", "left_child", "right_child"))
            trees.append((*walkable(feature, left, right), part["threshold"].to_numpy(), part["path"].to_numpy()))
        shared = features_context(trees)
        scale = average_path(self.sample_size) or 1.0

        @F.pandas_udf("double")
        def score(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype="float64")
            points = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
            values, first = points.ravel(), np.arange(len(points)) * points.shape[1]
            total = np.zeros(len(points))
            for feature, children, steps, threshold, path in shared.value:
                at = np.zeros(len(points), dtype=np.intp)
                for _ in range(steps):
                    goes_left = values.take(first + feature.take(at)) <= threshold.take(at)
                    at = children.take(2 * at + ~goes_left)
                total += path.take(at)
            return pd.Series(2.0 ** (-(total / len(shared.value)) / scale))

        return score(features)

    def transform(self, df: DataFrame, features: Column) -> DataFrame:
        """Add `score` and, once a threshold is set, `prediction`."""
        scored = df.withColumn("score", self.score_column(features))
        if self.threshold is None:
            return scored
        return scored.withColumn("prediction", (F.col("score") > F.lit(self.threshold)).cast("int"))

    def save(self, spark: SparkSession, path: str) -> None:
        # Sorted into one small file per model: the table is bounded by trees x sample.
        spark.createDataFrame(self.nodes, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        facts = {"sample_size": self.sample_size, "threshold": self.threshold, "contamination": self.contamination}
        spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/facts"
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IsolationForest:
        facts = json.loads(spark.read.text(f"{path}/facts").first()[0])
        nodes = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").toPandas()
        return cls(nodes, facts["sample_size"], facts["threshold"], facts["contamination"])


def features_context(trees):
    return SparkSession.getActiveSession().sparkContext.broadcast(trees)


def fit_isolation_forest(
    train: DataFrame, key: list[str], features: Column, contamination: float | None = None,
    trees: int = ISOLATION_TREES, sample: int = ISOLATION_SAMPLE, seed: int = SEED,
) -> IsolationForest:
    """Grow the trees; with `contamination` set the threshold at the exact (1 - contamination) score quantile."""
    n = train.count()
    if n == 0:
        raise ValueError("No training rows")
    size = min(sample, n)
    limit = ceil(log2(max(size, 2)))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values("place")
        tree = int(ordered["tree"].iloc[0])
        points = np.stack([np.asarray(v, dtype=np.float64) for v in ordered["features"]])
        rows = grow_tree(points, np.random.default_rng([seed, tree]), limit)
        return pd.DataFrame([(tree, *row) for row in rows], columns=NODE_COLUMNS)

    samples = tree_samples(train, key, features, n, trees, sample, seed)
    grown = samples.groupBy("tree").applyInPandas(grow, NODE_SCHEMA)
    forest = IsolationForest(grown.toPandas().sort_values(["tree", "node"], ignore_index=True), size)
    if contamination is not None:
        # One double per row, read by several passes; a lost copy is scored again from the training table.
        scores = train.select(forest.score_column(features).alias("score")).persist(StorageLevel.MEMORY_AND_DISK)
        forest.threshold = exact_quantiles(scores, ["score"], 1.0 - contamination)["score"]
        scores.unpersist()
        forest.contamination = contamination
    return forest


NODE_COLUMNS = [field.split()[0] for field in NODE_SCHEMA.split(", ")]
