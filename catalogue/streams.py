"""The event table as a file stream, processed to the end and compared with its batch twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import query
from catalogue import monitoring  # noqa: F401 - its views
from catalogue.base import DRIFT_DAY, DRIFT_FEATURES, drift_sides, naive, r, sql, table, view
from catalogue.detection import SEVERITY
from catalogue.models import ONE, lagged
from tidewatch.operators import anomaly as a
from tidewatch.operators.models import LinearForecaster
from tidewatch.session import materialise, new_path
from tidewatch.sources import payload
from tidewatch.streaming import jobs


def event_stream(spark, d):
    schema = table(spark, d, "events").schema
    stream = jobs.file_stream(spark, d, schema, "events.parquet")
    return stream.select(
        "event_id", F.col("event_type").alias("series"), F.col("ts").cast("timestamp").alias("timestamp"), F.col("value").alias("demand"), "props"
    )


@query("stream_rollup", f"""SELECT event_type AS series, date_trunc('hour', ts) AS timestamp, {r('avg(value)')} AS demand FROM events GROUP BY 1, 2""")
def stream_rollup(spark, d):
    return jobs.run_to_table(jobs.rollup(event_stream(spark, d)), new_path(spark, "rollup"), keys=["series", "timestamp"])


@query("stream_dedup", "SELECT DISTINCT event_type AS series, date_trunc('hour', ts) AS timestamp FROM events")
def stream_dedup(spark, d):
    """Repeated (series, hour) rows; the first of each is kept."""
    stream = event_stream(spark, d).withColumn("timestamp", F.date_trunc("hour", "timestamp")).select("series", "timestamp")
    return jobs.run_to_table(jobs.deduplicate(stream), new_path(spark, "dedup"))


@query("stream_latency", f"""SELECT date_trunc('hour', ts) AS window_start, count(*) AS count, {r('avg(value)')} AS mean_ms, {r('quantile_cont(value, 0.5)')} AS p50_ms,
  {r('quantile_cont(value, 0.95)')} AS p95_ms, {r('quantile_cont(value, 0.99)')} AS p99_ms, {r('max(value)')} AS max_ms, {r('avg((value > 100)::INT) * 100')} AS sla_breach_pct
  FROM events GROUP BY 1""")
def stream_latency(spark, d):
    counts = jobs.latency_counts(event_stream(spark, d), "timestamp", "demand")
    return jobs.latency_from_counts(jobs.run_to_table(counts, new_path(spark, "latency"), keys=["window_start", "value"]), sla_ms=100.0)


def _bodies(spark, d):
    when = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    body = F.struct(when.alias("timestamp"), F.col("demand").alias("actual_demand"), (F.col("demand") * 0.8).alias("predicted_demand"),
                    F.create_map(F.lit(ONE[0]), F.col("demand")).alias("features"))
    return event_stream(spark, d).select("event_id", "series", F.to_json(body).alias("body"))


@query("stream_anomaly", sql(f"""SELECT event_id, series, date_trunc('second', ts) AS timestamp, {r('value')} AS actual, {r('value * 0.8')} AS predicted, {r('s')} AS anomaly_score, f AS is_anomaly,
  {SEVERITY.format(f='f', s='s')} AS severity, 'residual' AS method FROM (
  SELECT event_id, event_type AS series, ts, value, least(abs(value - value * 0.8) / (3 * sd + 1e-8), 1) AS s, abs(value - value * 0.8) > 3 * sd AS f
  FROM events JOIN (SELECT series, stddev_pop(actual - predicted) + 1e-8 AS sd FROM p GROUP BY 1) k ON k.series = event_type)""", "p"))
def stream_anomaly(spark, d):
    """Request bodies decoded and checked against stored residual calibration."""
    calibration = materialise(a.fit_residuals(naive(spark, d)), "calibration")  # not once per micro-batch
    good, _ = payload.split_valid(payload.decode_anomaly(_bodies(spark, d)))
    return jobs.run_to_table(jobs.detect(good, calibration, keep=("event_id",)), new_path(spark, "anomaly"))


@query("stream_score", sql(f"""SELECT event_id, series, {r('greatest(b0 + b1 * value, 0)', 5)} AS predicted FROM (SELECT event_id, event_type AS series, value FROM events)
  JOIN (SELECT series, regr_slope(y, x) AS b1, regr_intercept(y, x) AS b0 FROM (
    SELECT series, demand AS y, lag(demand, 24) OVER (PARTITION BY series ORDER BY timestamp) AS x FROM g) WHERE x IS NOT NULL GROUP BY 1) USING (series)""", "g"), digits=5)
def stream_score(spark, d):
    """Request bodies aligned to a stored model and predicted."""
    path = new_path(spark, "model")
    LinearForecaster(spread="event_id").fit(lagged(spark, d), ONE).save(path)
    model = LinearForecaster.load(spark, path)
    model.spread = "event_id"
    good, _ = payload.split_valid(payload.decode_predict(_bodies(spark, d)))
    scored = jobs.score(good, model).select("event_id", "series", "predicted")
    return jobs.run_to_table(scored, new_path(spark, "score"))


@query("stream_zscore", f"""SELECT series, timestamp, {r('demand', 5)} AS actual, {r('z', 5)} AS z, {r('least(z / (3 + 1e-8), 1)', 5)} AS anomaly_score, z > 3 AS is_anomaly FROM (
  SELECT series, timestamp, demand, abs(demand - avg(demand) OVER w) / (coalesce(stddev_samp(demand) OVER w, 1) + 1e-8) AS z FROM (
    SELECT event_type AS series, ts AS timestamp, value AS demand FROM events) WINDOW w AS (PARTITION BY series ORDER BY timestamp, demand ROWS BETWEEN 167 PRECEDING AND CURRENT ROW))""", digits=5)
def stream_zscore(spark, d):
    stream = event_stream(spark, d).select("series", "timestamp", "demand")
    return jobs.online_zscore(stream, new_path(spark, "zscore")).drop("seq")


@query("stream_to_predictions", sql(f"""SELECT series, 'ridge' AS model_name, count(*) AS n, count(DISTINCT event_id) AS n_requests, {r('avg(greatest(b0 + b1 * value, 0))', 5)} AS mean_predicted
  FROM (SELECT event_id, event_type AS series, value FROM events) JOIN (SELECT series, regr_slope(y, x) AS b1, regr_intercept(y, x) AS b0 FROM (
    SELECT series, demand AS y, lag(demand, 24) OVER (PARTITION BY series ORDER BY timestamp) AS x FROM g) WHERE x IS NOT NULL GROUP BY 1) USING (series) GROUP BY 1""", "g"), digits=5)
def stream_to_predictions(spark, d):
    """Requests scored as they come, into the predictions table, beside a first commit by a batch job."""
    root = new_path(spark, "tables")
    model = LinearForecaster(spread="event_id").fit(lagged(spark, d), ONE)
    good, _ = payload.split_valid(payload.decode_predict(_bodies(spark, d)))
    scored = jobs.score(good, model).select(
        "series", F.col("event_id").cast("string").alias("request_id"), "timestamp", F.col("predicted").alias("predicted_demand"), F.lit("ridge").alias("model_name"))
    stored = jobs.run_to_stored(scored, "predictions", root, "score")
    return stored.groupBy("series", "model_name").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("request_id").alias("n_requests"), F.avg("predicted_demand").alias("mean_predicted"))


view("dtrain", f"""dtrain AS (SELECT feature, min(value) AS lo, max(value) AS hi, count(*) AS n FROM dv WHERE side = 0 GROUP BY 1)""", "dv")
_BIN = "CASE WHEN v < lo + b * w THEN b - 1 WHEN v >= lo + (b + 1) * w AND b < 9 THEN b + 1 ELSE b END"
view("dweek", f"""dweek AS (SELECT feature, side, week, {_BIN} AS bin FROM (
  SELECT feature, side, week, v, lo, (hi - lo) / 10 AS w, least(floor((v - lo) / ((hi - lo) / 10)), 9) AS b FROM (
    SELECT feature, side, time_bucket(INTERVAL 7 DAYS, day, TIMESTAMP '1970-01-01') AS week, greatest(least(value, hi), lo) AS v, lo, hi FROM dvt JOIN dtrain USING (feature))))""",
     "dtrain", "dvt")
view("dvt", "dvt AS (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {c} AS value, l_shipdate::TIMESTAMP AS day, (l_shipdate >= TIMESTAMP '{DRIFT_DAY}')::INT AS side FROM lineitem" for c in DRIFT_FEATURES) + ")")


@query("stream_drift", sql(f"""SELECT window_start, feature, {r('psi')} AS psi, psi > 0.1 AS is_drifted FROM (
  SELECT window_start, feature, sum((a - e) * ln(a / e)) AS psi FROM (
    SELECT week AS window_start, feature, coalesce(c, 0) / (total + 1e-8::DOUBLE) + 1e-8::DOUBLE AS a, coalesce(t, 0) / (n + 1e-8::DOUBLE) + 1e-8::DOUBLE AS e
    FROM (SELECT week, feature, count(*) AS total FROM dweek WHERE side = 1 GROUP BY 1, 2) JOIN (SELECT feature, n, unnest(range(10)) AS bin FROM dtrain) USING (feature)
    LEFT JOIN (SELECT week, feature, bin::BIGINT AS bin, count(*) AS c FROM dweek WHERE side = 1 GROUP BY 1, 2, 3) USING (week, feature, bin)
    LEFT JOIN (SELECT feature, bin::BIGINT AS bin, count(*) AS t FROM dweek WHERE side = 0 GROUP BY 1, 2) USING (feature, bin)) GROUP BY 1, 2)""", "dweek"))
def stream_drift(spark, d):
    """Line items as a stream, weekly bin counts against the training ranges, PSI of every week."""
    train, _ = drift_sides(spark, d)
    baseline = materialise(jobs.drift_baseline(train, DRIFT_FEATURES), "baseline")
    schema = table(spark, d, "lineitem").schema
    stream = jobs.file_stream(spark, d, schema, "lineitem.parquet").select(F.col("l_shipdate").cast("timestamp").alias("timestamp"), *DRIFT_FEATURES)
    stream = stream.where(F.col("timestamp") >= F.lit(DRIFT_DAY).cast("timestamp"))
    counts = jobs.drift_counts(stream, baseline, DRIFT_FEATURES)
    counts = jobs.run_to_table(counts, new_path(spark, "drift"), keys=["window_start", "feature", "bin"])
    return jobs.drift_from_counts(counts, baseline)

