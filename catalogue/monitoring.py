"""Drift, latency, history, dashboard tables, payloads, utilities."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import NUDGE, query
from catalogue.accuracy import metric_sql, naive_scores, shown
from catalogue.base import DRIFT_DAY, DRIFT_FEATURES, daily, drift_sides, events, hourly, naive, plain, r, sql, table, view
from catalogue.detection import SEVERITY
from tidewatch.functions.scalar import psi_level, severity
from tidewatch.operators import anomaly as a
from tidewatch.operators import drift, monitor
from tidewatch.operators.clean import clean
from tidewatch.schemas import HOURLY
from tidewatch.session import new_path
from tidewatch.sources import payload, readers, sinks

view("dv", "dv AS (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {c} AS value, (l_shipdate >= TIMESTAMP '{DRIFT_DAY}')::INT AS side FROM lineitem" for c in DRIFT_FEATURES) + ")")
view("ds", """ds AS (SELECT feature, min(value) AS lo, max(value) AS hi, count(*) FILTER (side = 0) AS nt, count(*) FILTER (side = 1) AS np,
  avg(value) FILTER (side = 0) AS train_mean, avg(value) FILTER (side = 1) AS prod_mean,
  stddev_pop(value) FILTER (side = 0) AS train_std, stddev_pop(value) FILTER (side = 1) AS prod_std FROM dv GROUP BY 1)""", "dv")
view("dbin", """dbin AS (SELECT feature, side, CASE WHEN value < lo + b * w THEN b - 1 WHEN value >= lo + (b + 1) * w AND b < 9 THEN b + 1 ELSE b END AS bin
  FROM (SELECT feature, side, value, lo, (hi - lo) / 10 AS w, least(floor((value - lo) / ((hi - lo) / 10)), 9) AS b FROM dv JOIN ds USING (feature)))""", "ds")
view("psi", """psi AS (SELECT feature, sum((p - t) * ln(p / t)) AS psi FROM (
  SELECT feature, coalesce(ct, 0) / (nt + 1e-8::DOUBLE) + 1e-8::DOUBLE AS t, coalesce(cp, 0) / (np + 1e-8::DOUBLE) + 1e-8::DOUBLE AS p
  FROM (SELECT feature, nt, np, unnest(range(10)) AS bin FROM ds)
  LEFT JOIN (SELECT feature, bin::BIGINT AS bin, count(*) FILTER (side = 0) AS ct, count(*) FILTER (side = 1) AS cp FROM dbin GROUP BY 1, 2) USING (feature, bin)) GROUP BY 1)""", "dbin")
view("ks", """ks AS (SELECT feature, d, CASE WHEN x < 0.2 THEN 1 ELSE greatest(0, least(1, (SELECT sum(CASE WHEN j % 2 = 1 THEN 2 ELSE -2 END * exp(-2.0::DOUBLE * j * j * x * x)) FROM range(1, 101) t(j)))) END AS pv
  FROM (SELECT feature, max(abs(ct / nt - cp / np)) AS d, max(abs(ct / nt - cp / np)) * sqrt(any_value(nt::DOUBLE) * any_value(np) / (any_value(nt) + any_value(np))) AS x FROM (
    SELECT feature, value, sum(t) OVER w AS ct, sum(p) OVER w AS cp FROM (
      SELECT feature, value, count(*) FILTER (side = 0) AS t, count(*) FILTER (side = 1) AS p FROM dv GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY feature ORDER BY value)) JOIN ds USING (feature) GROUP BY 1))""", "ds")


@query("psi", sql(f"SELECT feature, {r('psi')} AS psi, CASE WHEN psi < 0.1 THEN 'none' WHEN psi < 0.2 THEN 'low' WHEN psi < 0.25 THEN 'medium' ELSE 'high' END AS level FROM psi", "psi"))
def psi(spark, d):
    return drift.psi(drift.value_rows(*drift_sides(spark, d), DRIFT_FEATURES)).withColumn("level", psi_level("psi"))


@query("ks_two_sample", sql(f"SELECT feature, {r('d')} AS ks_statistic, {r('pv')} AS ks_pvalue FROM ks", "ks"))
def ks(spark, d):
    return drift.ks(drift.value_rows(*drift_sides(spark, d), DRIFT_FEATURES))


@query("drift_report", sql(f"""SELECT feature, {shown(['train_mean', 'prod_mean', 'train_std', 'prod_std'])}, {r('d')} AS ks_statistic, {r('pv')} AS ks_pvalue,
  {r('psi')} AS psi, pv < 0.05 OR psi > 0.1 AS is_drifted, CASE WHEN psi < 0.1 THEN 'none' WHEN psi < 0.2 THEN 'low' WHEN psi < 0.25 THEN 'medium' ELSE 'high' END AS drift_level
  FROM ds JOIN ks USING (feature) JOIN psi USING (feature)""", "ds", "ks", "psi"))
def drift_report(spark, d):
    """All numeric columns of both sides."""
    return drift.drift_report(*drift_sides(spark, d))


# ------------------------------------------------------------ latency, history

@query("latency_summary", f"""SELECT count(*) AS count, {r('avg(value)')} AS mean_ms, {r('quantile_cont(value, 0.5)')} AS p50_ms, {r('quantile_cont(value, 0.95)')} AS p95_ms,
  {r('quantile_cont(value, 0.99)')} AS p99_ms, {r('max(value)')} AS max_ms, {r('avg((value > 100)::INT) * 100')} AS sla_breach_pct
  FROM (SELECT value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000)""")
def latency_summary(spark, d):
    log = events(spark, d).select("event_id", F.col("ts").alias("created_at"), F.col("value").alias("latency_ms"))
    return monitor.latency_summary(log, ("created_at", "event_id"), sla_ms=100.0)


def prediction_log(spark, d):
    """A prediction table: one request per naive prediction."""
    return naive(spark, d).select(
        "series", F.concat_ws("_", "series", F.date_format("timestamp", "yyyyMMddHH")).alias("request_id"), "timestamp",
        F.col("predicted").alias("predicted_demand"), F.lit("naive_24").alias("model_name"), F.lit("1.0.0").alias("model_version"),
        F.col("timestamp").alias("created_at"),
    )


_LOG = f"""SELECT series, series || '_' || strftime(timestamp, '%Y%m%d%H') AS request_id, timestamp, {r('predicted')} AS predicted_demand,
  'naive_24' AS model_name, '1.0.0' AS model_version, timestamp AS created_at FROM p"""


@query("recent_predictions", sql(f"SELECT * FROM ({_LOG}) ORDER BY created_at DESC, request_id DESC LIMIT 50", "p"))
def recent_predictions(spark, d):
    return monitor.recent_predictions(prediction_log(spark, d), 50)


@query("prediction_by_id", sql(f"SELECT * FROM ({_LOG}) WHERE request_id = 'click_2024011512'", "p"))
def prediction_by_id(spark, d):
    return monitor.prediction_by_id(prediction_log(spark, d), "click_2024011512")


def residual_results(spark, d):
    p = naive(spark, d)
    return a.residual_anomalies(p, a.fit_residuals(p))


_FLAGGED = f"SELECT series, timestamp, {r('actual')} AS actual, {r('predicted')} AS predicted, {r('rs')} AS anomaly_score, rf AS is_anomaly, 'high' AS severity, 'residual' AS method FROM rp WHERE rf"


@query("recent_anomalies", sql(f"{_FLAGGED} ORDER BY timestamp DESC, series DESC LIMIT 10", "rp"))
def recent_anomalies(spark, d):
    return monitor.recent_anomalies(residual_results(spark, d), limit=10)


@query("recent_anomalies_high", sql(f"{_FLAGGED} ORDER BY timestamp DESC, series DESC LIMIT 50", "rp"))
def recent_high(spark, d):
    return monitor.recent_anomalies(residual_results(spark, d), "high", 50)


@query("anomaly_filter", sql(_FLAGGED, "rp"))
def anomaly_filter(spark, d):
    return monitor.anomalies(residual_results(spark, d))


def metrics_table(spark, d):
    """A metrics history: one training run per series and model, the model's lag as its age."""
    s = naive_scores(spark, d)
    return s.select(
        "series", F.col("model").alias("model_name"), F.lit("1.0.0").alias("model_version"), F.col("test_rmse").alias("rmse"),
        F.col("test_mae").alias("mae"), F.lit(None).cast("double").alias("mape"), F.col("test_r2").alias("r2"),
        F.lit(None).cast("long").alias("n_train_samples"), F.col("n_predictions").alias("n_test_samples"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("k")).alias("created_at"),
    )


@query("latest_metrics", sql(f"""SELECT series, model AS model_name, '1.0.0' AS model_version, {shown(['test_rmse', 'test_mae'])}, 0::DOUBLE AS test_mape, {r('test_r2')} AS test_r2,
  0 AS n_train_samples, n_predictions AS n_test_samples, epoch_ms((1700000000 + k)::BIGINT * 1000)::TIMESTAMP AS last_trained_at FROM scores
  QUALIFY row_number() OVER (PARTITION BY series ORDER BY k DESC) = 1""", "scores"))
def latest_metrics(spark, d):
    return monitor.latest_metrics(metrics_table(spark, d), ("series",))


@query("metrics_flatten", sql(f"""SELECT series, model AS "Model", {r('test_rmse')} AS "RMSE", {r('test_mae')} AS "MAE", 0::DOUBLE AS "MAPE" FROM scores""", "scores"))
def metrics_flatten(spark, d):
    """Metrics as the JSON file holds them (MAPE left out of it), flattened again."""
    texts = sinks.metrics_json(naive_scores(spark, d), ["test_rmse", "test_mae", "test_r2"], by=("series",))
    return readers.flatten_metrics(texts, "value", ("series",))


@query("metrics_file", sql(f"""SELECT model AS "Model", {shown(['test_rmse', 'test_mae', 'test_mape']).replace('AS test_rmse', 'AS "RMSE"').replace('AS test_mae', 'AS "MAE"').replace('AS test_mape', 'AS "MAPE"')}
  FROM (SELECT 'naive_' || k AS model, {metric_sql('test_')} FROM naives WHERE predicted IS NOT NULL AND pos >= floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) GROUP BY 1)""", "naives"))
def metrics_file(spark, d):
    """The evaluation file, written and read back."""
    from catalogue.accuracy import naive_models
    from tidewatch.operators.metrics import evaluate

    path = new_path(spark, "evaluation")
    sinks.save_results(evaluate(naive_models(spark, d), ("model",), prefix="test"), path, ["test_rmse", "test_mae", "test_mape"])
    return readers.load_metrics(spark, path)


# ------------------------------------------------------------ dashboard

@query("date_range_kpis", sql(f"""SELECT series, {r('avg(demand)')} AS avg_demand, {r('max(demand)')} AS max_demand, {r('min(demand)')} AS min_demand
  FROM h WHERE timestamp::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-14' GROUP BY 1""", "h"))
def date_range_kpis(spark, d):
    return monitor.kpis(monitor.date_range(hourly(spark, d), start="2024-01-05", end="2024-01-14"), by=("series",))


@query("date_range_default", sql(f"""SELECT series, {r('avg(demand)')} AS avg_demand, {r('max(demand)')} AS max_demand, {r('min(demand)')} AS min_demand
  FROM l WHERE timestamp::DATE >= (SELECT max(timestamp)::DATE - 30 FROM l) GROUP BY 1""", "l"))
def date_range_default(spark, d):
    """The last 30 days of the daily panel."""
    return monitor.kpis(monitor.date_range(daily(spark, d)), by=("series",))


@query("anomaly_overlay", sql(f"SELECT series, timestamp, {r('demand')} AS demand, {r('CASE WHEN rf THEN actual END')} AS anomaly_value FROM g LEFT JOIN rp USING (series, timestamp)", "g", "rp"))
def anomaly_overlay(spark, d):
    return monitor.anomaly_overlay(plain(spark, d), residual_results(spark, d))


# ------------------------------------------------------------ payloads

@query("map_feature_align", f"""SELECT event_id, {r("coalesce((props->>'k')::DOUBLE, 0)")} AS k, 0::DOUBLE AS absent, 1 AS n_filled FROM events""")
def map_feature_align(spark, d):
    rows = events(spark, d).select("event_id", F.from_json("props", "map<string, double>").alias("features"))
    return payload.aligned(rows, ["k", "absent"]).drop("features")


def requests(spark, d):
    """Request bodies from events: a third kind has no usable time, another a negative value."""
    when = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.col("event_type")
    stamp = F.when(kind == "error", F.lit("not a time")).when(kind == "view", F.concat(when, F.lit("Z"))).otherwise(when)
    actual = F.when(kind == "signup", -1 - F.col("value")).otherwise(F.col("value"))
    body = F.struct(stamp.alias("timestamp"), actual.alias("actual_demand"), (F.col("value") * 0.8).alias("predicted_demand"),
                    F.from_json("props", "map<string, double>").alias("features"))
    return events(spark, d).select("event_id", kind.alias("series"), F.to_json(body).alias("body"))


@query("json_payload_split", f"""SELECT event_id, event_type AS series, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS timestamp,
  {r("CASE WHEN event_type = 'signup' THEN -1 - value ELSE value END")} AS actual, {r('value * 0.8')} AS predicted,
  CASE WHEN event_type = 'error' THEN 'timestamp' WHEN event_type = 'signup' THEN 'actual_demand' END AS reject_reason FROM events""")
def json_payload_split(spark, d):
    """Valid and rejected requests, put together again with the reason."""
    rows = payload.decode_anomaly(requests(spark, d))
    good, bad = payload.split_valid(rows)
    both = good.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(bad)
    return both.select("event_id", "series", "timestamp", "actual", "predicted", "reject_reason")


@query("predict_payload", f"""SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS timestamp,
  {r("(props->>'k')::DOUBLE")} AS k, CASE WHEN event_type = 'error' THEN 'timestamp' END AS reject_reason FROM events""")
def predict_payload(spark, d):
    rows = payload.decode_predict(requests(spark, d))
    return rows.select("event_id", "timestamp", F.col("features")["k"].alias("k"), "reject_reason")


@query("score_response", sql(f"""SELECT series, series || '_' || strftime(timestamp, '%Y%m%d%H') AS request_id, timestamp, {r(f'round(predicted + {NUDGE * 1e-4!r}::DOUBLE, 4)')} AS predicted_demand,
  'naive_24' AS model_name, '1.0.0' AS model_version, 'kWh' AS units FROM p""", "p"))
def score_response(spark, d):
    # filled values can lie exactly between two roundings; both engines move them off that edge
    log = prediction_log(spark, d).withColumn("predicted", F.col("predicted_demand") + F.lit(NUDGE * 1e-4))
    return payload.predict_response(log, "naive_24")


@query("anomaly_response", sql(f"""SELECT series, timestamp, {r('actual')} AS actual_demand, {r('predicted')} AS predicted_demand, {r('round(rs, 4)')} AS anomaly_score,
  rf AS is_anomaly, {SEVERITY.format(f='rf', s='rs')} AS severity, 'residual' AS method,
  CASE WHEN rf THEN 'Anomaly detected (severity=high)' ELSE 'Normal observation' END AS message FROM rp""", "rp"))
def anomaly_response(spark, d):
    return payload.anomaly_response(residual_results(spark, d))


@query("severity_levels", sql(f"SELECT series, timestamp, {r('fs')} AS score, {SEVERITY.format(f='true', s='fs')} AS severity FROM fp", "fp"))
def severity_levels(spark, d):
    from tidewatch.functions.scalar import fallback_score

    p = naive(spark, d)
    return p.select("series", "timestamp", fallback_score("actual", "predicted").alias("score")).withColumn("severity", severity("score"))


# ------------------------------------------------------------ utilities, tables

def _narrowest(c: str) -> str:
    fits = " ".join(f"WHEN min({c}) >= {-(2**bits)} AND max({c}) < {2**bits} THEN '{kind}'" for kind, bits in (("tinyint", 7), ("smallint", 15), ("int", 31)))
    return f"(SELECT CASE {fits} ELSE 'bigint' END FROM lineitem) AS type_{c}"


@query("narrow_types", f"SELECT l_orderkey, l_suppkey, {r('l_quantity')} AS l_quantity, {_narrowest('l_orderkey')}, {_narrowest('l_suppkey')}, 'float' AS type_l_quantity FROM lineitem")
def narrow_types(spark, d):
    """The narrowed columns, and the types they have got."""
    narrow = monitor.narrow_types(table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity"))
    return narrow.select("*", *[F.lit(f.dataType.simpleString()).alias(f"type_{f.name}") for f in narrow.schema])


@query("fingerprint")
def fingerprint(spark, d):
    return monitor.fingerprint(hourly(spark, d))


@query("table_append", sql(f"SELECT series, timestamp, {r('demand')} AS demand, true AS is_processed FROM c", "c"))
def table_append(spark, d):
    """The cleaned series in the series table: appended twice, read once per (series, timestamp)."""
    root = new_path(spark, "tables")
    rows = clean(hourly(spark, d)).withColumn("is_processed", F.lit(True))
    sinks.append(rows, "time_series_data", root)
    sinks.append(rows, "time_series_data", root)
    stored = sinks.read_table(spark, "time_series_data", root)
    return sinks.unique_series(stored).select("series", "timestamp", "demand", "is_processed")


@query("prediction_table", sql("SELECT series, model_name, model_version, count(*) AS n FROM (" + _LOG + ") GROUP BY 1, 2, 3", "p"))
def prediction_table(spark, d):
    root = new_path(spark, "tables")
    sinks.append(prediction_log(spark, d), "predictions", root)
    return sinks.read_table(spark, "predictions", root).groupBy("series", "model_name", "model_version").agg(F.count(F.lit(1)).alias("n"))


@query("positions", sql("SELECT series, timestamp, row_number() OVER (PARTITION BY series ORDER BY timestamp) - 1 AS pos, count(*) OVER (PARTITION BY series) AS n FROM u", "u"))
def positions(spark, d):
    from tidewatch.operators.chunks import positions as rank

    return rank(hourly(spark, d, "user_id"), HOURLY).drop("demand")


