"""Rolling z-score, residual and fallback detectors, and their majority vote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.functions.scalar import fallback_score, severity
from tidewatch.operators.chunks import chunk_window, chunked, rolling
from tidewatch.operators.joins import attach
from tidewatch.schemas import EPS, HOURLY, RESIDUAL_MULTIPLIER, ROLLING_Z_WINDOW, ZSCORE_THRESHOLD, Panel
from tidewatch.session import materialise

RESULT = ("timestamp", "actual", "predicted", "anomaly_score", "is_anomaly", "severity", "method")


def result_columns(keys, ts: str, actual, predicted, score, flagged, method: str) -> list[Column]:
    """The seven result columns, after the keys."""
    score, flagged = F.col(score), F.col(flagged)
    predicted = F.col(predicted) if predicted else F.lit(None).cast("double")
    return [
        *[F.col(k) for k in keys], F.col(ts).alias("timestamp"), F.col(actual).alias("actual"),
        predicted.alias("predicted"), score.alias("anomaly_score"), flagged.alias("is_anomaly"),
        severity(score, flagged).alias("severity"), F.lit(method).alias("method"),
    ]


# ------------------------------------------------------------ z-score

def fit_rolling_z(df: DataFrame, panel: Panel = HOURLY) -> DataFrame:
    """Mean and std(n-1) + 1e-8 per series, from training data."""
    return df.groupBy(*panel.keys).agg(F.avg(panel.value).alias("fit_mean"), (F.stddev_samp(panel.value) + EPS).alias("fit_std"))


def rolling_z(
    df: DataFrame, fitted: DataFrame, panel: Panel = HOURLY, threshold: float = ZSCORE_THRESHOLD,
    window: int = ROLLING_Z_WINDOW,
) -> DataFrame:
    """Adds ``z``, ``z_score`` in [0, 1] and ``z_flag``.

    The window includes the row itself. Its deviation is undefined only where
    the row is alone in it, and there the row is its own mean: the fitted
    deviation that stands in leaves z at 0 whatever it is, so no join is made
    for it. Scores are scaled by the largest z of the series in this batch (at
    least the threshold). Rows with their z are stored, so that the windows run
    once for the maximum and for the result.
    """
    keys = list(panel.keys)
    if fitted is None:
        raise RuntimeError("Rolling z-score not fitted. Call fit_rolling_z() first.")
    rows = rolling(chunked(df, panel, window - 1), chunk_window(panel), panel.value, [window], ["mean", "std"])
    rows = rows.where("_own").drop("_own")
    z = F.abs((F.col(panel.value) - F.col(f"_mean_{window}")) / (F.coalesce(F.col(f"_std_{window}"), F.lit(1.0)) + EPS))
    rows = rows.withColumn("z", z).drop(f"_mean_{window}", f"_std_{window}")
    rows = materialise(rows.drop("_chunk"), "z")
    rows = attach(rows, rows.groupBy(*keys).agg(F.max("z").alias("z_top")), keys, panel.ts)
    top = F.greatest(F.col("z_top"), F.lit(threshold + EPS))
    return (
        rows.withColumn("z_score", F.least(F.col("z") / top, F.lit(1.0)))
        .withColumn("z_flag", F.col("z") > threshold)
        .drop("z_top")
    )


def zscore_anomalies(df: DataFrame, fitted: DataFrame, panel: Panel = HOURLY, threshold: float = ZSCORE_THRESHOLD, window: int = ROLLING_Z_WINDOW) -> DataFrame:
    rows = rolling_z(df, fitted, panel, threshold, window)
    return rows.select(*result_columns(panel.keys, panel.ts, panel.value, None, "z_score", "z_flag", "zscore"))


# ------------------------------------------------------------ residual

def fit_residuals(predictions: DataFrame, keys=("series",)) -> DataFrame:
    """Mean and population std + 1e-8 of actual - predicted."""
    r = F.col("actual") - F.col("predicted")
    return predictions.groupBy(*keys).agg(F.avg(r).alias("residual_mean"), (F.stddev_pop(r) + EPS).alias("residual_std"))


def residual_scores(predictions: DataFrame, fitted: DataFrame, keys=("series",), k: float = RESIDUAL_MULTIPLIER, ts: str = "timestamp") -> DataFrame:
    """Adds ``residual_score`` and ``residual_flag``: |residual| > k sigma (the mean is not used)."""
    rows = attach(predictions, fitted.select(*keys, "residual_std"), keys, ts)
    size = F.abs(F.col("actual") - F.col("predicted"))
    limit = F.lit(float(k)) * F.col("residual_std")
    return (
        rows.withColumn("residual_score", F.least(size / (limit + EPS), F.lit(1.0)))
        .withColumn("residual_flag", size > limit)
        .drop("residual_std")
    )


def residual_anomalies(predictions: DataFrame, fitted: DataFrame | None, keys=("series",), k: float = RESIDUAL_MULTIPLIER, ts: str = "timestamp") -> DataFrame:
    if fitted is None:
        raise RuntimeError("Residual detector not fitted. Call fit_residuals() first.")
    rows = residual_scores(predictions, fitted, keys, k, ts)
    return rows.select(*result_columns(keys, ts, "actual", "predicted", "residual_score", "residual_flag", "residual"))


# ------------------------------------------------------------ fallback, vote

def fallback_anomalies(predictions: DataFrame, keys=("series",), ts: str = "timestamp", threshold: float = 0.3) -> DataFrame:
    """Relative distance from the prediction; a prediction of 0 is a prediction."""
    rows = predictions.withColumn("_score", fallback_score("actual", "predicted"))
    rows = rows.withColumn("_flag", F.col("_score") > threshold)
    return rows.select(*result_columns(keys, ts, "actual", "predicted", "_score", "_flag", "zscore_fallback"))


def vote(rows: DataFrame, scores, flags, keys=("series",), ts: str = "timestamp") -> DataFrame:
    """At least two of three flags; score is the mean of the three."""
    votes = sum((F.col(f).cast("int") for f in flags[1:]), F.col(flags[0]).cast("int"))
    mean = sum((F.col(s) for s in scores[1:]), F.col(scores[0])) / len(scores)
    rows = rows.withColumn("_score", mean).withColumn("_flag", votes >= 2)
    return rows.select(*result_columns(keys, ts, "actual", "predicted", "_score", "_flag", "ensemble"))


def severity_counts(results: DataFrame, by=()) -> DataFrame:
    """Rows, flagged rows and their share, by method and severity."""
    total = Window.partitionBy(*by, "method")
    counts = results.groupBy(*by, "method", "severity").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("is_anomaly").cast("long")).alias("n_flagged")
    )
    return counts.withColumn("share", F.col("n_rows") / F.sum("n_rows").over(total))
