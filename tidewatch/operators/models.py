"""Forecasters: linear family from summed products, forests and boosting from Spark ML."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F, types as T

from tidewatch.functions.scalar import non_negative
from tidewatch.operators.arrays import BUNDLE, add_arrays, by_group, doubles, matrix, nullable, runs
from tidewatch.operators.joins import attach
from tidewatch.operators.metrics import cv_summary, evaluate
from tidewatch.operators.split import cv_folds
from tidewatch.schemas import CV_GAP, CV_SPLITS, HOURLY, LASSO_ALPHA, RIDGE_ALPHA, Panel
from tidewatch.session import materialise


class Forecaster:
    """fit, predict, save, load. Predictions are never negative."""

    name = "base"
    features: list[str] | None = None

    @property
    def is_fitted(self) -> bool:
        raise NotImplementedError

    def _check_fitted(self) -> None:
        if not self.is_fitted:
            raise RuntimeError(f"{self.name} has no fitted state yet")

    def fit(self, df: DataFrame, features: list[str], target: str = "target") -> "Forecaster":
        raise NotImplementedError

    def predict(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def fit_predict(self, df: DataFrame, features: list[str], target: str = "target") -> DataFrame:
        return self.fit(df, features, target).predict(df)


# ------------------------------------------------------------ linear family

def _upper(d: int):
    return np.triu_indices(d)


def sum_products(df: DataFrame, keys, features, target: str) -> DataFrame:
    """Upper triangle of Z'Z, Z = (1, features, target), per key, as an array of sums.

    Rows of a partition are sorted by key and added up as they stream by. A key with at least half as many rows there as Z has columns
    becomes one array of products; of any other its rows are handed on as they are, which takes no more room than its products would. So
    nothing grows before the shuffle, whether there is one key or as many as rows, and a hot key is one array per task. Then rows and products
    of a key are added, first over neighbouring partitions, then over those.
    """
    keys, d = list(keys), len(features) + 2
    z = F.array(F.lit(1.0), *[F.col(c).cast("double") for c in features], F.col(target).cast("double"))
    rows = df.select(*keys, z.alias("_z"))
    rows = rows.sortWithinPartitions(*keys) if keys else rows
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField("_z", T.ArrayType(T.DoubleType()))])
    parts = rows.mapInArrow(_products(keys, d, keep_few=True), schema)
    bundled = parts.withColumn("_bundle", F.floor(F.spark_partition_id() / BUNDLE))
    names = [*keys, "_bundle"]
    schema = T.StructType([*[bundled.schema[k] for k in names], schema["_z"]])
    sums = bundled.repartition(*names).sortWithinPartitions(*names).select(*names, "_z").mapInArrow(_products(names, d, keep_few=False), schema)
    return add_arrays(sums, keys, "_z").withColumnRenamed("_z", "products")


def _products(keys: list[str], d: int, keep_few: bool):
    """For sorted keys: each key's rows (arrays of ``d``) and products (longer arrays) as one array of products.

    With ``keep_few`` the rows of a key that has fewer than ``d / 2`` of them stay rows.
    """
    top = _upper(d)

    def run(batches):
        now, total, waiting, held, like = None, None, [], 0, None

        def folded():
            x = np.concatenate(waiting) if waiting else np.zeros((0, d))
            more = (x.T @ x)[top]
            return more if total is None else total + more

        def made():
            arrays = list(np.concatenate(waiting)) if total is None and keep_few and held < d / 2 else [folded()]
            columns = [pa.array([k] * len(arrays), like.field(i).type) for i, k in enumerate(now)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([a.tolist() for a in arrays], like.field(len(keys)).type)], schema=like)

        for b in batches:
            like = b.schema
            size = np.diff(b.column("_z").offsets.to_numpy())
            for key, at, end in runs(b, keys):
                if now is not None and key != now:
                    yield made()
                    total, waiting, held = None, [], 0
                now = key
                part, few = b.column("_z").slice(at, end - at), size[at:end] == d
                if not few.all():
                    more = matrix(part.filter(pa.array(~few))).sum(0)
                    total = more if total is None else total + more
                if few.any():
                    waiting.append(matrix(part if few.all() else part.filter(pa.array(few))))
                    held += len(waiting[-1])
                if held >= 4 * d or (total is not None and held >= d):
                    total, waiting, held = folded(), [], 0
        if now is not None:
            yield made()

    return run


def _centred(products: np.ndarray, d: int):
    g = np.zeros((d, d))
    g[_upper(d)] = products
    g = g + np.triu(g, 1).T
    n, means = g[0, 0], g[0, 1:] / g[0, 0]
    c = g[1:, 1:] - n * np.outer(means, means)
    return n, means, c[:-1, :-1], c[:-1, -1]


def _least_squares(c: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least squares through the eigenvectors of the scaled matrix; collinear directions get 0."""
    size = np.sqrt(np.clip(np.diag(c), 0, None))
    live = size > 1e-9 * max(size.max(initial=0.0), 1e-300)
    out = np.zeros(len(b))
    if live.any():
        scale = size[live]
        values, vectors = np.linalg.eigh(c[np.ix_(live, live)] / np.outer(scale, scale))
        keep = values > 1e-11 * values.max()
        part = vectors[:, keep] / values[keep]
        out[live] = part @ (vectors[:, keep].T @ (b[live] / scale)) / scale
    return out


def _lasso(c: np.ndarray, b: np.ndarray, weight: float, max_iter: int, tol: float = 1e-9) -> np.ndarray:
    """Coordinate descent on the products; ``weight`` is n times alpha."""
    beta, slack = np.zeros(len(b)), b.copy()
    diagonal = np.diag(c)
    for _ in range(max_iter):
        moved = 0.0
        for j in np.flatnonzero(diagonal > 1e-12 * max(diagonal.max(initial=0.0), 1e-300)):
            pull = slack[j] + diagonal[j] * beta[j]
            new = np.sign(pull) * max(abs(pull) - weight, 0.0) / diagonal[j]
            if new != beta[j]:
                slack -= c[:, j] * (new - beta[j])
                moved = max(moved, abs(new - beta[j]) * np.sqrt(diagonal[j]))
                beta[j] = new
        if moved <= tol * np.sqrt(max(b @ b, 1e-300) / max(diagonal.max(), 1e-300)):
            break
    return beta


class LinearForecaster(Forecaster):
    """One linear model per key (or one pooled model with ``keys=()``).

    ``kind`` is ``linear_regression``, ``ridge`` (alpha on the sum of squares)
    or ``lasso`` (loss over 2n). Fitting is one pass: products are summed in
    Spark and each small system is solved where its sums are.
    """

    def __init__(self, kind: str = "linear_regression", alpha: float | None = None, keys=("series",), max_iter: int = 10_000, spread="timestamp"):
        if kind not in ("linear_regression", "ridge", "lasso"):
            raise ValueError(f"Unknown linear model: {kind}")
        self.name, self.kind = kind, kind
        self.alpha = alpha if alpha is not None else {"ridge": RIDGE_ALPHA, "lasso": LASSO_ALPHA}.get(kind, 0.0)
        self.keys, self.max_iter, self.spread = tuple(keys), max_iter, spread
        self.coefficients: DataFrame | None = None

    @property
    def is_fitted(self) -> bool:
        return self.coefficients is not None

    def solver(self):
        """From the summed products of one model to its rows, intercept and coefficients."""
        kind, alpha, max_iter = self.kind, float(self.alpha), self.max_iter

        def solve(products: np.ndarray):
            d = int((2 * len(products) + 0.25) ** 0.5)
            n, means, c, b = _centred(products, d)
            if kind == "ridge":
                beta = np.linalg.solve(c + alpha * np.eye(len(b)), b)
            elif kind == "lasso":
                beta = _lasso(c, b, n * alpha, max_iter)
            else:
                beta = _least_squares(c, b)
            return int(n), float(means[-1] - means[:-1] @ beta), list(beta)

        return solve

    def fit(self, df: DataFrame, features: list[str], target: str = "target") -> "LinearForecaster":
        self.features = list(features)
        one = self.solver()

        @F.pandas_udf("struct<n: long, intercept: double, coef: array<double>>")
        def solve(products: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([one(np.asarray(p, dtype=float)) for p in products], columns=["n", "intercept", "coef"])

        sums = sum_products(df, self.keys, features, target)
        # stored, so that the fit runs once and its size is known to the joins that use it
        self.coefficients = materialise(sums.select(*self.keys, solve("products").alias("_m")).select(*self.keys, "_m.*"), "coefficients")
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        self._check_fitted()
        rows = attach(df, self.coefficients.select(*self.keys, "intercept", "coef"), self.keys, self.spread)
        total = F.col("intercept")
        for i, c in enumerate(self.features):
            total = total + F.col("coef")[i] * F.col(c).cast("double")
        return rows.withColumn("predicted", non_negative(total)).drop("intercept", "coef")

    def coefficient_table(self) -> DataFrame:
        """One row per key and feature."""
        self._check_fitted()
        names = F.array(*[F.lit(c) for c in self.features])
        return self.coefficients.select(*self.keys, F.posexplode(F.arrays_zip(names.alias("feature"), F.col("coef"))).alias("_i", "_c")).select(
            *self.keys, F.col("_c.feature").alias("feature"), F.col("_c.coef").alias("coef")
        )

    def sparsity(self) -> DataFrame:
        """How many coefficients are exactly zero, and their share."""
        zero = F.col("coef") == 0
        return self.coefficient_table().groupBy(*self.keys).agg(
            F.sum(zero.cast("long")).alias("n_zero"), F.count(F.lit(1)).alias("n_features"),
            F.avg(zero.cast("double")).alias("sparsity"),
        )

    def save(self, path: str) -> None:
        self._check_fitted()
        meta = [F.lit(self.kind).alias("kind"), F.lit(self.alpha).alias("alpha"),
                F.array(*[F.lit(k) for k in self.keys]).cast("array<string>").alias("key_columns"),
                F.array(*[F.lit(c) for c in self.features]).alias("features")]
        self.coefficients.select("*", *meta).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> "LinearForecaster":
        table = spark.read.parquet(path)
        m = table.select("kind", "alpha", "key_columns", "features").first()
        made = cls(m.kind, m.alpha, tuple(m.key_columns))
        made.features = list(m.features)
        made.coefficients = table.drop("kind", "alpha", "key_columns", "features")
        return made


# ------------------------------------------------------------ trees

class TreeForecaster(Forecaster):
    """A pooled Spark ML tree ensemble over all series."""

    def __init__(self, name: str, regressor):
        self.name, self.regressor = name, regressor
        self.model: PipelineModel | None = None

    @property
    def is_fitted(self) -> bool:
        return self.model is not None

    def fit(self, df: DataFrame, features: list[str], target: str = "target") -> "TreeForecaster":
        self.features = list(features)
        assembler = VectorAssembler(inputCols=self.features, outputCol="_x", handleInvalid="error")
        trained = self.regressor.setFeaturesCol("_x").setLabelCol(target).setPredictionCol("_raw").fit(
            assembler.transform(df).select("_x", target)
        )
        self.model = PipelineModel([assembler, trained])
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        self._check_fitted()
        return self.model.transform(df).withColumn("predicted", non_negative("_raw")).drop("_x", "_raw")

    def importances(self, spark) -> DataFrame:
        """Feature importances, largest first."""
        self._check_fitted()
        found = [float(v) for v in self.model.stages[-1].featureImportances.toArray()]
        table = spark.createDataFrame(list(zip(self.features, found)), "feature string, importance double")
        return table.orderBy(F.desc("importance"), "feature")

    def save(self, path: str) -> None:
        self._check_fitted()
        self.model.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str, name: str = "tree") -> "TreeForecaster":
        made = cls(name, None)
        made.model = PipelineModel.load(path)
        made.features = list(made.model.stages[0].getInputCols())
        return made


def random_forest(trees: int = 200, depth: int = 15, leaf: int = 2, seed: int = 42) -> TreeForecaster:
    return TreeForecaster("random_forest", RandomForestRegressor(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, featureSubsetStrategy="all", seed=seed,
        maxMemoryInMB=512,
    ))


def boosted_a(rounds: int = 500, rate: float = 0.05, depth: int = 7, seed: int = 42) -> TreeForecaster:
    """Preset of the first boosting library: depth 7, 80 % of rows and columns."""
    return TreeForecaster("gbt_a", GBTRegressor(
        maxIter=rounds, stepSize=rate, maxDepth=depth, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed,
    ))


def boosted_b(rounds: int = 500, rate: float = 0.05, depth: int = 6, seed: int = 42) -> TreeForecaster:
    """Preset of the second: 63 leaves, that is depth 6."""
    return TreeForecaster("gbt_b", GBTRegressor(
        maxIter=rounds, stepSize=rate, maxDepth=depth, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed,
    ))


def select_features(df: DataFrame, features, target: str = "target", top_k: int = 40, trees: int = 50, depth: int = 8) -> DataFrame:
    """The ``top_k`` features by forest importance."""
    forest = random_forest(trees, depth, leaf=1).fit(df, features, target)
    return forest.importances(df.sparkSession).limit(top_k)


# ------------------------------------------------------------ evaluation

def cross_validate(models, df: DataFrame, features, panel: Panel = HOURLY, target: str = "target", n_splits=None, gap=None) -> DataFrame:
    """Fold metrics per series and model, over expanding folds.

    Linear models fit all folds in one pass, with the fold as one more key; where each
    series stands whole, also where its rows stand, and score them there.
    Trees fit once per fold; ``df`` should be materialised for those.
    """
    series = [m for m in models if isinstance(m, LinearForecaster) and panel.whole and m.keys == panel.keys]
    folds = cv_folds(df, panel, n_splits, gap) if len(series) < len(models) else None
    parts = []
    for model in models:
        if model in series:
            parts.append(_fold_metrics(_scored_series(model, df, features, panel, target, n_splits, gap), panel, target, model.name))
        elif isinstance(model, LinearForecaster):
            fresh = LinearForecaster(model.kind, model.alpha, (*model.keys, "fold"), model.max_iter, model.spread)
            fresh.fit(folds.where("role = 'train'"), features, target)
            scored = fresh.predict(folds.where("role = 'val'"))
            parts.append(_fold_metrics(scored, panel, target, model.name))
        else:
            for fold in range(5 if n_splits is None else n_splits):
                mine = folds.where(F.col("fold") == fold)
                fresh = TreeForecaster(model.name, model.regressor.copy())
                fresh.fit(mine.where("role = 'train'"), features, target)
                parts.append(_fold_metrics(fresh.predict(mine.where("role = 'val'")), panel, target, model.name))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _scored_series(model: LinearForecaster, df: DataFrame, features, panel: Panel, target: str, n_splits, gap) -> DataFrame:
    """Validation rows of every fold with ``predicted``, for rows whose series stand whole and in time order, where they stand.

    Folds are those of ``cv_folds``: a series' training rows are its first ones, so its products are summed up once, from one fold's end to the next.
    """
    k, gap = CV_SPLITS if n_splits is None else n_splits, CV_GAP if gap is None else gap
    keys, features, d, solve = list(panel.keys), list(features), len(features) + 2, model.solver()
    names = [*keys, "fold", target, "predicted"]
    schema = T.StructType([*[df.schema[c] for c in keys], T.StructField("fold", T.IntegerType()), df.schema[target], T.StructField("predicted", T.DoubleType())])
    top = _upper(d)

    def work(batch, starts):
        of = lambda c: batch.column(batch.schema.get_field_index(c))
        z = np.column_stack([np.ones(batch.num_rows), *[doubles(of(c)) for c in features], doubles(of(target))])
        picked, folds, predicted = [], [], []
        for at, end in zip(starts, np.append(starts[1:], batch.num_rows), strict=True):
            n = end - at
            size, total, upto = n // (k + 1), np.zeros((d, d)), 0
            for fold in range(k):
                first = n - (k - fold) * size
                if first - gap > upto:
                    x = z[at + upto : at + first - gap]
                    total, upto = total + x.T @ x, first - gap
                if not size:
                    continue
                rows = np.arange(at + first, at + first + size)
                picked.append(rows)
                folds.append(np.full(size, fold, np.int32))
                if upto > 0:
                    _, intercept, beta = solve(total[top])
                    predicted.append(np.maximum(intercept + z[rows, 1:-1] @ np.asarray(beta), 0.0))
                else:
                    predicted.append(np.full(size, np.nan))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        rows, score = pa.array(join(picked, np.int64)), join(predicted, float)
        columns = [*[of(c).take(rows) for c in keys], pa.array(join(folds, np.int32)), of(target).take(rows), nullable(score, ~np.isnan(score))]
        return pa.RecordBatch.from_arrays(columns, names=names)

    return by_group(df.select(*keys, *dict.fromkeys([*features, target])), keys, schema, work)


def _fold_metrics(scored: DataFrame, panel: Panel, target: str, name: str) -> DataFrame:
    return evaluate(scored, (*panel.keys, "fold"), target, "predicted").withColumn("model", F.lit(name))


def cv_results(fold_metrics: DataFrame, panel: Panel = HOURLY) -> DataFrame:
    return cv_summary(fold_metrics, (*panel.keys, "model"))


