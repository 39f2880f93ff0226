"""Request payloads: decoding, validity, alignment, responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.functions.scalar import align_features, n_filled, parse_iso
from tidewatch.schemas import ANOMALY_REQUEST, PREDICT_REQUEST


def _parsed(df: DataFrame, column: str, schema: str) -> DataFrame:
    body = F.from_json(F.col(column), schema, {"mode": "PERMISSIVE"})
    return df.withColumn("_r", body).withColumn("timestamp", parse_iso("_r.timestamp"))


def _reasons(df: DataFrame, checks: dict) -> DataFrame:
    """``reject_reason`` is the first check that fails, null for a valid row."""
    reason = F.lit(None).cast("string")
    for text, bad in reversed(list(checks.items())):
        reason = F.when(bad, F.lit(text)).otherwise(reason)
    return df.withColumn("reject_reason", reason)


def decode_predict(df: DataFrame, column: str = "body") -> DataFrame:
    """Timestamp, feature map and model name of each request; unusable ones carry a reason."""
    rows = _parsed(df, column, PREDICT_REQUEST)
    features = F.col("_r.features")
    bad_value = F.exists(F.map_values(features), lambda v: v.isNull() | F.isnan(v))
    rows = _reasons(rows, {
        "not json": F.col("_r").isNull(), "timestamp": F.col("timestamp").isNull(),
        "features": features.isNull() | F.coalesce(bad_value, F.lit(False)),
    })
    return rows.withColumn("features", features).withColumn("model_name", F.col("_r.model_name")).drop("_r")


def decode_anomaly(df: DataFrame, column: str = "body") -> DataFrame:
    """Timestamp, actual (at least 0), optional prediction and features, and method of each request."""
    rows = _parsed(df, column, ANOMALY_REQUEST)
    actual = F.col("_r.actual_demand")
    rows = _reasons(rows, {
        "not json": F.col("_r").isNull(), "timestamp": F.col("timestamp").isNull(),
        "actual_demand": actual.isNull() | (actual < 0),
    })
    return (
        rows.withColumn("actual", actual).withColumn("predicted", F.col("_r.predicted_demand"))
        .withColumn("features", F.col("_r.features"))
        .withColumn("method", F.coalesce(F.col("_r.method"), F.lit("ensemble"))).drop("_r")
    )


def split_valid(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows and rejected rows."""
    return rows.where("reject_reason is null").drop("reject_reason"), rows.where("reject_reason is not null")


def aligned(rows: DataFrame, names, payload: str = "features") -> DataFrame:
    """The model's features as columns (absent keys 0) and how many were filled."""
    return rows.select(
        *[c for c in rows.columns if c not in names], *[c.alias(n) for n, c in align_features(payload, names).items()],
        n_filled(payload, names).alias("n_filled"),
    )


def predict_response(scored: DataFrame, model: str, version: str = "1.0.0") -> DataFrame:
    """Response columns: id, time, rounded prediction, model, units."""
    has_id = "request_id" in scored.columns
    return scored.select(
        *[c for c in ("series",) if c in scored.columns],
        (F.col("request_id") if has_id else F.substring(F.expr("uuid()"), 1, 16)).alias("request_id"),
        "timestamp", F.round("predicted", 4).alias("predicted_demand"), F.lit(model).alias("model_name"),
        F.lit(version).alias("model_version"), F.lit("kWh").alias("units"),
    )


def anomaly_response(results: DataFrame, by=("series",)) -> DataFrame:
    """Response columns: rounded score and a message."""
    message = F.when(F.col("is_anomaly"), F.concat(F.lit("Anomaly detected (severity="), F.col("severity"), F.lit(")")))
    return results.select(
        *by, "timestamp", F.col("actual").alias("actual_demand"), F.col("predicted").alias("predicted_demand"),
        F.round("anomaly_score", 4).alias("anomaly_score"), "is_anomaly", "severity", "method",
        message.otherwise(F.lit("Normal observation")).alias("message"),
    )
