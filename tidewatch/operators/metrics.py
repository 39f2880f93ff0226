"""Forecast accuracy, fold summaries, model ranking."""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.operators.chunks import chunk_window, chunked, own_rows
from tidewatch.schemas import EPS, HOURLY, Panel

METRICS = ("rmse", "mae", "mape", "r2", "smape")


def metric_columns(actual: str = "actual", predicted: str = "predicted", prefix: str = "") -> list[Column]:
    """rmse, mae, mape (rows with |actual| > 1e-8), r2 and smape (non-zero denominators)."""
    y, p = F.col(actual), F.col(predicted)
    both = y.isNotNull() & p.isNotNull()
    err = y - p
    size = (F.abs(y) + F.abs(p)) / 2
    total = F.var_pop(F.when(both, y)) * F.count(F.when(both, y))
    made = {
        "rmse": F.sqrt(F.avg(err * err)),
        "mae": F.avg(F.abs(err)),
        "mape": F.avg(F.when(F.abs(y) > EPS, F.abs(err / y))) * 100,
        "r2": 1 - F.sum(err * err) / (total + EPS),
        "smape": F.avg(F.when(size != 0, F.abs(err) / size)) * 100,
    }
    return [made[m].alias(f"{prefix}_{m}" if prefix else m) for m in METRICS]


def evaluate(predictions: DataFrame, by=("series",), actual: str = "actual", predicted: str = "predicted", prefix: str = "") -> DataFrame:
    """All metrics and the number of predictions, per group, in one aggregate."""
    scored = F.count(F.when(F.col(actual).isNotNull() & F.col(predicted).isNotNull(), 1)).alias("n_predictions")
    return predictions.groupBy(*by).agg(*metric_columns(actual, predicted, prefix), scored)


def _scaled_error(predictions, train, panel, difference, halo, actual, predicted):
    w = chunk_window(panel)
    steps = own_rows(chunked(train, panel, halo).withColumn("_d", difference(w)))
    base = steps.groupBy(*panel.keys).agg(F.avg(F.abs(F.col("_d"))).alias("naive_mae"))
    error = predictions.groupBy(*panel.keys).agg(F.avg(F.abs(F.col(actual) - F.col(predicted))).alias("mae"))
    ratio = F.when(F.col("naive_mae") == 0, F.lit(float("inf"))).otherwise(F.col("mae") / F.col("naive_mae"))
    return error.join(base, list(panel.keys)).select(*panel.keys, "mae", "naive_mae", ratio.alias("mase"))


def mase(predictions: DataFrame, train: DataFrame, panel: Panel = HOURLY, seasonality: int = 1, actual="actual", predicted="predicted") -> DataFrame:
    """Error scaled by the mean absolute ``seasonality``-th order difference of the training series.

    The order of differencing (not a lag) is the observed meaning of
    ``seasonality``; ``seasonal_mase`` uses the lag. A zero scale gives infinity.
    """
    def difference(w):
        terms = [F.lag(panel.value, j).over(w) * float((-1) ** j * comb(seasonality, j)) for j in range(seasonality + 1)]
        return sum(terms[1:], terms[0])
    return _scaled_error(predictions, train, panel, difference, seasonality, actual, predicted)


def seasonal_mase(predictions: DataFrame, train: DataFrame, panel: Panel = HOURLY, seasonality: int = 24, actual="actual", predicted="predicted") -> DataFrame:
    """Error scaled by the mean absolute change over ``seasonality`` rows."""
    difference = lambda w: F.col(panel.value) - F.lag(panel.value, seasonality).over(w)
    return _scaled_error(predictions, train, panel, difference, seasonality, actual, predicted)


def cv_summary(fold_metrics: DataFrame, by=("series", "model")) -> DataFrame:
    """Mean and population deviation over folds of rmse, mae, mape and r2."""
    made = []
    for m in ("rmse", "mae", "mape", "r2"):
        made += [F.avg(m).alias(f"cv_{m}_mean"), F.stddev_pop(m).alias(f"cv_{m}_std")]
    return fold_metrics.groupBy(*by).agg(*made)


def rank_models(results: DataFrame, panel: Panel = HOURLY, on: str = "test_rmse") -> DataFrame:
    """Models of a series by ascending error, ties by name, with their rank."""
    w = Window.partitionBy(*panel.keys).orderBy(on, "model")
    return results.withColumn("rank", F.row_number().over(w)).orderBy(*panel.keys, "rank")


def best_model(results: DataFrame, panel: Panel = HOURLY, on: str = "test_rmse", order: str | None = None) -> DataFrame:
    """The model with the lowest error per series; a tie goes to the lowest ``order`` (default: name)."""
    pick = F.min(F.struct(F.col(on), F.col(order or "model").alias("_order"), F.col("model"))).alias("_best")
    return results.groupBy(*panel.keys).agg(pick).select(*panel.keys, F.col("_best.model").alias("best_model"), F.col(f"_best.{on}").alias(on))


def seasonal_naive(df: DataFrame, panel: Panel = HOURLY, lag: int = 24) -> DataFrame:
    """Prediction = the value ``lag`` rows back; rows that have one."""
    w = chunk_window(panel)
    rows = chunked(df, panel, lag).withColumn("predicted", F.lag(panel.value, lag).over(w))
    return own_rows(rows).where("predicted is not null").withColumnRenamed(panel.value, "actual")


def residuals(predictions: DataFrame) -> DataFrame:
    """Actual, predicted and their difference, as the residual views show them."""
    return predictions.withColumn("residual", F.col("actual") - F.col("predicted"))


def residual_histogram(predictions: DataFrame, keys=("series",), bins: int = 60) -> DataFrame:
    """Equal-width histogram of the residuals."""
    from tidewatch.operators.explore import histogram

    return histogram(residuals(predictions), Panel(keys=tuple(keys), value="residual"), bins)


