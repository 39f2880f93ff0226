"""Latency summary, history look-ups, dashboard tables, table utilities."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewatch.schemas import HOURLY, LATENCY_SLA_MS, LATENCY_WINDOW, Panel


def latency_columns(latency: str = "latency_ms", sla_ms: float = LATENCY_SLA_MS) -> list[Column]:
    x = F.col(latency)
    points = F.percentile(x, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    return [
        F.count(x).alias("count"), F.avg(x).alias("mean_ms"), points[0].alias("p50_ms"), points[1].alias("p95_ms"),
        points[2].alias("p99_ms"), F.max(x).alias("max_ms"),
        (F.avg((x > sla_ms).cast("double")) * 100).alias("sla_breach_pct"),
    ]


def latency_summary(log: DataFrame, order=("created_at",), latency: str = "latency_ms", window: int = LATENCY_WINDOW, sla_ms: float = LATENCY_SLA_MS) -> DataFrame:
    """Count, mean, percentiles, maximum and breach share of the newest ``window`` records; empty when there are none."""
    newest = log.orderBy(*[F.desc(c) for c in order]).limit(window)
    return newest.agg(*latency_columns(latency, sla_ms)).where(F.col("count") > 0)


# ------------------------------------------------------------ history

def recent_predictions(table: DataFrame, limit: int = 100, order=("created_at", "request_id")) -> DataFrame:
    return table.orderBy(*[F.desc(c) for c in order]).limit(limit)


def recent_anomalies(table: DataFrame, severity: str | None = None, limit: int = 100, order=("timestamp", "series")) -> DataFrame:
    return anomalies(table, severity).orderBy(*[F.desc(c) for c in order]).limit(limit)


def anomalies(table: DataFrame, severity: str | None = None) -> DataFrame:
    """Flagged rows, of one severity when given."""
    found = table.where("is_anomaly")
    return found if severity is None else found.where(F.col("severity") == severity)


def latest_metrics(table: DataFrame, by=()) -> DataFrame:
    """The newest metrics row, nulls as 0."""
    newest = table.groupBy(*by).agg(F.max_by(F.struct(*[c for c in table.columns if c not in by]), "created_at").alias("_m"))
    shown = {"rmse": "test_rmse", "mae": "test_mae", "mape": "test_mape", "r2": "test_r2"}
    zero = lambda c, kind: F.coalesce(F.col(f"_m.{c}"), F.lit(0).cast(kind))
    return newest.where("_m is not null").select(
        *by, "_m.model_name", "_m.model_version", *[zero(c, "double").alias(n) for c, n in shown.items()],
        zero("n_train_samples", "long").alias("n_train_samples"), zero("n_test_samples", "long").alias("n_test_samples"),
        F.col("_m.created_at").alias("last_trained_at"),
    )


def prediction_by_id(table: DataFrame, request_id: str) -> DataFrame:
    return table.where(F.col("request_id") == request_id).limit(1)


# ------------------------------------------------------------ dashboard

def date_range(df: DataFrame, panel: Panel = HOURLY, start: dt.date | str | None = None, end: dt.date | str | None = None, days: int = 30) -> DataFrame:
    """Rows on the dates from start to end, both included; default the last ``days`` days.

    The dates become a half-open timestamp range, which the Parquet scan can
    use; without an end the newest date is read first, from the time column.
    """
    ts = F.col(panel.ts)
    if end is None:
        end = df.agg(F.to_date(F.max(ts))).first()[0]
        if end is None:
            return df.where(F.lit(False))
    until = F.date_add(F.lit(end).cast("date"), 1).cast("timestamp")
    if start is None:
        start_ts = F.date_sub(F.lit(end).cast("date"), days).cast("timestamp")
    else:
        start_ts = F.lit(start).cast("timestamp")
    return df.where((ts >= start_ts) & (ts < until))


def kpis(df: DataFrame, panel: Panel = HOURLY, by=()) -> DataFrame:
    v = panel.value
    return df.groupBy(*by).agg(F.avg(v).alias("avg_demand"), F.max(v).alias("max_demand"), F.min(v).alias("min_demand"))


def anomaly_overlay(df: DataFrame, results: DataFrame, panel: Panel = HOURLY) -> DataFrame:
    """All points, with the flagged value where the point is an anomaly."""
    flagged = anomalies(results).select(*panel.keys, F.col("timestamp").alias(panel.ts), F.col("actual").alias("anomaly_value"))
    return df.join(flagged, [*panel.keys, panel.ts], "left")


# ------------------------------------------------------------ utilities

def fingerprint(df: DataFrame, length: int = 16) -> DataFrame:
    """A short hash of all rows, the same in any row order."""
    total = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))
    text = F.concat_ws("|", F.lit(",".join(df.columns)), F.coalesce(total, F.lit(0)).cast("string"), F.count(F.lit(1)).cast("string"))
    return df.agg(F.substring(F.sha2(text, 256), 1, length).alias("fingerprint"))


def narrow_types(df: DataFrame) -> DataFrame:
    """double to float; each long to the smallest integer type its range fits."""
    longs = [f.name for f in df.schema if isinstance(f.dataType, T.LongType)]
    casts = {f.name: "float" for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    if longs:
        spans = df.agg(*[F.min(c).alias(f"lo_{c}") for c in longs], *[F.max(c).alias(f"hi_{c}") for c in longs]).first()
        for c in longs:
            lo, hi = spans[f"lo_{c}"], spans[f"hi_{c}"]
            if lo is None:
                continue
            for kind, bits in (("tinyint", 7), ("smallint", 15), ("int", 31)):
                if -(2**bits) <= lo and hi < 2**bits:
                    casts[c] = kind
                    break
    return df.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns])
