"""Forecast accuracy, cross-validation and ranking, with a seasonal-naive forecast as the model."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import query
from catalogue.base import GRID, grid, hourly, naive, plain, r, split, sql, view
from tidewatch.operators import metrics as m
from tidewatch.operators.clean import clean
from tidewatch.operators.chunks import chunk_window, chunked, own_rows
from tidewatch.operators.split import cv_folds, temporal_split
from tidewatch.schemas import HOURLY

NAIVE_LAGS = (1, 2, 3, 24, 48, 168)


def metric_sql(prefix: str = "", y: str = "actual", p: str = "predicted") -> str:
    made = {
        "rmse": f"sqrt(avg(({y} - {p}) * ({y} - {p})))",
        "mae": f"avg(abs({y} - {p}))",
        "mape": f"avg(CASE WHEN abs({y}) > 1e-8 THEN abs(({y} - {p}) / {y}) END) * 100",
        "r2": f"1 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count(*) + 1e-8)",
        "smape": f"avg(CASE WHEN abs({y}) + abs({p}) <> 0 THEN abs({y} - {p}) / ((abs({y}) + abs({p})) / 2) END) * 100",
    }
    return ", ".join(f"{e} AS {prefix}{n}" for n, e in made.items())


def shown(names) -> str:
    return ", ".join(f"{r(n)} AS {n}" for n in names)


NAMES = list(m.METRICS)


@query("seasonal_naive", sql(f"SELECT series, timestamp, {shown(['actual', 'predicted'])} FROM p", "p"))
def seasonal_naive(spark, d):
    return naive(spark, d)


@query("forecast_metrics", sql(f"SELECT series, n_predictions, {shown(NAMES)} FROM (SELECT series, count(*) AS n_predictions, {metric_sql()} FROM p GROUP BY 1)", "p"))
def forecast_metrics(spark, d):
    return m.evaluate(naive(spark, d))


view("c", """c AS (SELECT series, timestamp, pos, n, least(greatest(CASE WHEN demand < q1 - 1.5 * (q3 - q1) THEN q1 - 1.5 * (q3 - q1)
    WHEN demand > q3 + 1.5 * (q3 - q1) THEN q3 + 1.5 * (q3 - q1) ELSE demand END, 0), 10000) AS demand
  FROM g JOIN (SELECT series, quantile_cont(demand, 0.25) AS q1, quantile_cont(demand, 0.75) AS q3 FROM g GROUP BY 1) USING (series))""", "g")


@query("forecast_error", sql(f"""SELECT series, n_predictions, {shown(['test_' + n for n in NAMES])} FROM (
  SELECT series, count(*) AS n_predictions, {metric_sql('test_', 'demand', 'predicted')} FROM (
    SELECT series, demand, lag(demand, 24) OVER (PARTITION BY series ORDER BY timestamp) AS predicted FROM c
    WHERE pos >= floor(n * (0.7::DOUBLE + 0.15::DOUBLE))) WHERE predicted IS NOT NULL GROUP BY 1)""", "c"))
def forecast_error(spark, d):
    """Grid, filling, outlier capping, split, seasonal naive and metrics of the test split."""
    cleaned = clean(hourly(spark, d), with_position=True)
    test = temporal_split(cleaned).where("split = 'test'").drop("split")
    return m.evaluate(m.seasonal_naive(test, GRID), prefix="test")


def _mase_sql(step: str) -> str:
    return sql(f"""SELECT series, {r('mae')} AS mae, {r('base')} AS naive_mae, {r('mae / base')} AS mase
FROM (SELECT series, avg(abs(actual - predicted)) AS mae FROM p GROUP BY 1)
JOIN (SELECT series, avg(abs(x)) AS base FROM (SELECT series, {step} AS x FROM s WHERE split = 'train' WINDOW w AS (PARTITION BY series ORDER BY timestamp)) GROUP BY 1) USING (series)""", "p", "s")


@query("mase", _mase_sql("demand - lag(demand) OVER w"))
def mase(spark, d):
    return m.mase(naive(spark, d), split(spark, d).where("split = 'train'"))


@query("mase_second_order", _mase_sql("demand - 2 * lag(demand) OVER w + lag(demand, 2) OVER w"))
def mase_second(spark, d):
    return m.mase(naive(spark, d), split(spark, d).where("split = 'train'"), seasonality=2)


@query("seasonal_mase", _mase_sql("demand - lag(demand, 24) OVER w"))
def seasonal_mase(spark, d):
    return m.seasonal_mase(naive(spark, d), split(spark, d).where("split = 'train'"))


view("naives", f"""naives AS (SELECT * FROM (SELECT series, timestamp, pos, n, demand AS actual, unnest({list(NAIVE_LAGS)}) AS k,
  unnest([{', '.join(f'lag(demand, {k}) OVER w' for k in NAIVE_LAGS)}]) AS predicted FROM g WINDOW w AS (PARTITION BY series ORDER BY timestamp)))""", "g")
view("scores", f"""scores AS (SELECT series, 'naive_' || k AS model, k, count(*) AS n_predictions, {metric_sql('test_')}
  FROM naives WHERE predicted IS NOT NULL AND pos >= floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) GROUP BY 1, 2, 3)""", "naives")


def naive_models(spark, d):
    """Predictions of six naive models (one per lag), on the test rows of the grid."""
    w = chunk_window(HOURLY)
    lags = F.array(*[F.struct(F.lit(k).alias("k"), F.lag("demand", k).over(w).alias("predicted")) for k in NAIVE_LAGS])
    rows = own_rows(chunked(grid(spark, d), GRID, max(NAIVE_LAGS)).withColumn("_l", lags))
    parts = temporal_split(rows).where("split = 'test'")
    return parts.select("series", "timestamp", F.col("demand").alias("actual"), F.explode("_l").alias("_p")).select(
        "series", "timestamp", "actual", F.concat(F.lit("naive_"), F.col("_p.k").cast("string")).alias("model"), "_p.predicted", "_p.k"
    ).where("predicted is not null")


def naive_scores(spark, d):
    return m.evaluate(naive_models(spark, d), ("series", "model", "k"), prefix="test")


_TEST = ["test_" + n for n in NAMES]


@query("model_ranking", sql(f"""SELECT series, model, n_predictions, {shown(_TEST)}, row_number() OVER (PARTITION BY series ORDER BY test_rmse, model) AS rank
  FROM scores""", "scores"))
def model_ranking(spark, d):
    return m.rank_models(naive_scores(spark, d)).drop("k")


@query("best_model", sql(f"""SELECT series, arg_min(model, test_rmse) AS best_model, {r('min(test_rmse)')} AS test_rmse FROM scores GROUP BY 1""", "scores"))
def best_model(spark, d):
    return m.best_model(naive_scores(spark, d), order="k")


view("foldscores", f"""foldscores AS (SELECT series, 'naive_24' AS model, fold, count(*) AS n_predictions, {metric_sql()}
  FROM (SELECT *, n - (5 - fold) * floor(n / 6)::BIGINT AS st, floor(n / 6)::BIGINT AS sz FROM naives CROSS JOIN (SELECT unnest(range(5)) AS fold) WHERE k = 24)
  WHERE pos >= st AND pos < st + sz AND predicted IS NOT NULL GROUP BY 1, 2, 3)""", "naives")


def fold_scores(spark, d):
    g = grid(spark, d)
    folds = cv_folds(m.seasonal_naive(g, GRID).withColumnRenamed("actual", "demand")).where("role = 'val'")
    return m.evaluate(folds.withColumn("model", F.lit("naive_24")), ("series", "model", "fold"), "demand")


@query("cv_fold_metrics", sql(f"SELECT series, model, fold::BIGINT AS fold, n_predictions, {shown(NAMES)} FROM foldscores", "foldscores"))
def cv_fold_metrics(spark, d):
    return fold_scores(spark, d)


@query("cv_metrics_naive", sql("SELECT series, model, " + ", ".join(
    f"{r(f'avg({n})')} AS cv_{n}_mean, {r(f'stddev_pop({n})')} AS cv_{n}_std" for n in NAMES[:4]) + " FROM foldscores GROUP BY 1, 2", "foldscores"))
def cv_metrics_naive(spark, d):
    return m.cv_summary(fold_scores(spark, d))


@query("metric_table_by_user", sql(f"""SELECT series, n_predictions, {shown(NAMES)} FROM (SELECT series, count(*) AS n_predictions, {metric_sql()} FROM (
  SELECT series, demand AS actual, lag(demand, 24) OVER (PARTITION BY series ORDER BY timestamp) AS predicted FROM ug) WHERE predicted IS NOT NULL GROUP BY 1)""", "ug"))
def metric_table_by_user(spark, d):
    return m.evaluate(m.seasonal_naive(plain(spark, d, "user_id"), GRID))
