"""Isolation forest: trees from hash-picked samples, scoring in Arrow batches.

Fitting never shuffles the data: one scan hashes each row with (series, time)
once per tree and keeps a tree's few candidates, of which the lowest hashes are
its sample; trees are built one per group of at most ``sample`` rows. The
same rows are chosen under any partitioning. The fitted forest is bounded by
trees x (2 x sample - 1) nodes, whatever the data size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidewatch.operators.anomaly import result_columns
from tidewatch.operators.joins import attach
from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.schemas import CONTAMINATION, EPS, FOREST_SAMPLE, FOREST_TREES, HOURLY, Panel

NODE = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("path", T.DoubleType()),
])
_UNIT = float(2**63)


def mean_path(n) -> float:
    """Expected path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _unit_hash(*columns):
    """A hash of the columns as a number in [0, 1)."""
    return F.abs(F.xxhash64(*columns).cast("double")) / F.lit(_UNIT)


def tree_samples(df: DataFrame, features, panel: Panel = HOURLY, trees: int = FOREST_TREES, sample: int = FOREST_SAMPLE, seed: int = 42) -> DataFrame:
    """``min(sample, n)`` rows without replacement for every tree, drawn from all rows: (tree, at, x).

    A row is a candidate of a tree when its hash with the tree's number is under
    four times the sample over the row count; the lowest hashes of a tree win.
    So about ``4 * trees * sample`` candidates are shuffled, whatever n is.
    """
    row_id = [*panel.keys, panel.ts]
    total = df.select(F.count(F.lit(1)).alias("_total"))
    x = F.array(*[F.col(f).cast("double") for f in features])
    rows = attach(df.select(F.xxhash64(*row_id).alias("_id"), x.alias("x")), total, [], [])
    odds = F.least(F.lit(1.0), F.lit(4.0 * sample) / F.col("_total"))
    hashes = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(t.alias("tree"), _unit_hash("_id", t, F.lit(seed)).alias("u")))
    picks = rows.withColumn("_odds", odds).select("_id", "x", F.explode(F.filter(hashes, lambda s: s["u"] < F.col("_odds"))).alias("s"))
    order = Window.partitionBy("tree").orderBy("u", "_id")
    picks = picks.select("s.tree", "s.u", "_id", "x").withColumn("at", F.row_number().over(order))
    return picks.where(F.col("at") <= sample).select("tree", "at", "x")


def _grow(pdf: pd.DataFrame, sample: int, seed: int) -> pd.DataFrame:
    tree = int(pdf["tree"].iloc[0])
    data = np.stack(pdf.sort_values("at")["x"].to_numpy())
    rng = np.random.default_rng([seed, tree])
    limit = max(1, math.ceil(math.log2(max(len(data), 2))))
    nodes, todo = [], [(data, 0)]
    parents: list[tuple[int, str] | None] = [None]
    while todo:
        rows, depth = todo.pop()
        link = parents.pop()
        index = len(nodes)
        node = {"tree": tree, "node": index, "feature": -1, "threshold": 0.0, "left": -1, "right": -1,
                "path": depth + mean_path(len(rows))}
        nodes.append(node)
        if link:
            nodes[link[0]][link[1]] = index
        low, high = rows.min(axis=0), rows.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(usable):
            continue
        f = int(rng.choice(usable))
        cut = float(rng.uniform(low[f], high[f]))
        under = rows[:, f] <= cut
        if under.all():
            cut = float(low[f])
            under = rows[:, f] <= cut
        node.update(feature=f, threshold=cut)
        for side, part in (("right", rows[~under]), ("left", rows[under])):
            todo.append((part, depth + 1))
            parents.append((index, side))
    return pd.DataFrame(nodes)


@dataclass
class IsolationForest:
    """A fitted forest. ``fit`` is a Spark job; ``score`` and ``predict`` are lazy."""

    features: list[str]
    trees: int = FOREST_TREES
    sample: int = FOREST_SAMPLE
    contamination: float = CONTAMINATION
    seed: int = 42
    nodes: pd.DataFrame | None = None
    offset: float | None = None
    rows_per_tree: int = FOREST_SAMPLE

    def fit(self, df: DataFrame, panel: Panel = HOURLY) -> "IsolationForest":
        sample, seed = self.sample, self.seed
        self.rows_per_tree = min(sample, df.count())
        picks = tree_samples(df, self.features, panel, self.trees, sample, seed)
        grown = picks.groupBy("tree").applyInPandas(lambda pdf: _grow(pdf, sample, seed), NODE)
        self.nodes = grown.orderBy("tree", "node").toPandas()  # at most trees * (2 * sample - 1) rows
        scores = self.score(df, panel)
        self.offset = exact_quantiles(scores, [], "score", {"q": self.contamination}).first()["q"]
        return self

    def _check(self):
        if self.nodes is None:
            raise RuntimeError("Isolation forest not fitted.")

    def score(self, df: DataFrame, panel: Panel = HOURLY) -> DataFrame:
        """Adds ``score``: minus 2 to the power of -(mean path / expected path); low is anomalous."""
        self._check()
        nodes = self.nodes
        size = self.rows_per_tree
        first = nodes.groupby("tree")["node"].size().cumsum().shift(fill_value=0)
        base = nodes["tree"].map(first).to_numpy()
        packed = {
            "root": first.to_numpy(),
            "feature": nodes["feature"].to_numpy(),
            "threshold": nodes["threshold"].to_numpy(),
            "left": np.where(nodes["left"] >= 0, nodes["left"] + base, np.arange(len(nodes))),
            "right": np.where(nodes["right"] >= 0, nodes["right"] + base, np.arange(len(nodes))),
            "path": nodes["path"].to_numpy(),
        }
        depth = max(1, math.ceil(math.log2(max(size, 2))))
        shared = df.sparkSession.sparkContext.broadcast(packed)
        norm = mean_path(size) or 1.0

        @F.pandas_udf("double")
        def isolation(batch: pd.Series) -> pd.Series:
            m = shared.value
            x = np.stack(batch.to_numpy()) if len(batch) else np.zeros((0, 1))
            rows = np.arange(len(x))
            total = np.zeros(len(x))
            for root in m["root"]:
                at = np.full(len(x), root)
                for _ in range(depth):
                    f = m["feature"][at]
                    value = x[rows, np.maximum(f, 0)]
                    at = np.where(value <= m["threshold"][at], m["left"][at], m["right"][at])
                total += m["path"][at]
            return pd.Series(-np.power(2.0, -total / len(m["root"]) / norm))

        return df.withColumn("score", isolation(F.array(*[F.col(f).cast("double") for f in self.features])))

    def normalised(self, df: DataFrame, panel: Panel = HOURLY) -> DataFrame:
        """Adds ``forest_score`` in [0, 1] (by the batch's own range per series) and ``forest_flag``."""
        scored = self.score(df, panel).withColumn("_decision", F.col("score") - F.lit(self.offset))
        span = scored.groupBy(*panel.keys).agg(F.min("_decision").alias("_lo"), F.max("_decision").alias("_hi"))
        rows = attach(scored, span, panel.keys, panel.ts)
        scaled = 1 - (F.col("_decision") - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + EPS)
        return (
            rows.withColumn("forest_score", scaled).withColumn("forest_flag", F.col("_decision") < 0)
            .drop("_decision", "_lo", "_hi", "score")
        )

    def predict(self, df: DataFrame, panel: Panel = HOURLY) -> DataFrame:
        """Result rows; ``actual`` is the value column when the frame has it."""
        rows = self.normalised(df, panel)
        if panel.value not in rows.columns:
            rows = rows.withColumn(panel.value, F.lit(None).cast("double"))
        return rows.select(*result_columns(panel.keys, panel.ts, panel.value, None, "forest_score", "forest_flag", "isolation_forest"))

    def save(self, spark, path: str) -> None:
        self._check()
        state = [(self.features, self.trees, self.sample, self.contamination, self.seed, self.offset, self.rows_per_tree)]
        spark.createDataFrame(self.nodes, NODE).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame(
            state, "features array<string>, trees int, sample int, contamination double, seed int, offset double, rows int"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/state")

    @classmethod
    def load(cls, spark, path: str) -> "IsolationForest":
        s = spark.read.parquet(f"{path}/state").first()
        nodes = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").toPandas()
        return cls(list(s.features), s.trees, s.sample, s.contamination, s.seed, nodes, s.offset, s.rows)
