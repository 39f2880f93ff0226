"""Anomaly detectors on the hourly grid with the seasonal-naive forecast."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import query
from catalogue.base import GRID, gappy, naive, plain, r, split, sql, view
from tidewatch.operators import anomaly as a
from tidewatch.operators.features import build_features, feature_names
from tidewatch.operators.iforest import IsolationForest
from tidewatch.schemas import HOURLY
from tidewatch.session import materialise, new_path
from tidewatch.sources import readers, sinks

SEVERITY = "CASE WHEN {f} THEN CASE WHEN {s} >= 0.8 THEN 'high' WHEN {s} >= 0.6 THEN 'medium' WHEN {s} >= 0.3 THEN 'low' ELSE 'normal' END ELSE 'normal' END"


def result(table: str, s: str, f: str, method: str, predicted: str = "predicted", actual: str = "actual") -> str:
    return f"""SELECT series, timestamp, {r(actual)} AS actual, {r(predicted)} AS predicted, {r(s)} AS anomaly_score, {f} AS is_anomaly,
  {SEVERITY.format(f=f, s=s)} AS severity, '{method}' AS method FROM {table}"""


def z_view(name: str, src: str, train: str) -> None:
    view(name, f"""{name} AS (SELECT *, least(z / greatest(max(z) OVER (PARTITION BY series), 3 + 1e-8), 1) AS zs, z > 3 AS zf FROM (
  SELECT series, timestamp, demand, abs((demand - m) / (coalesce(sd, fit) + 1e-8)) AS z FROM (
    SELECT series, timestamp, demand, avg(demand) OVER w AS m, stddev_samp(demand) OVER w AS sd FROM {src}
    WINDOW w AS (PARTITION BY series ORDER BY timestamp ROWS BETWEEN 167 PRECEDING AND CURRENT ROW))
  JOIN (SELECT series, stddev_samp(demand) + 1e-8 AS fit FROM {train} GROUP BY 1) USING (series)))""", src if src in ("g", "ug", "ud") else "s")


z_view("zg", "g", "g")
z_view("zu", "ug", "ug")
z_view("zd", "ud", "ud")


@query("zscore_anomalies", sql(result("zg", "zs", "zf", "zscore", "NULL::DOUBLE", "demand"), "zg"))
def zscore_anomalies(spark, d):
    g = plain(spark, d)
    return a.zscore_anomalies(g, a.fit_rolling_z(g), GRID)


@query("zscore_anomalies_by_user", sql(result("zu", "zs", "zf", "zscore", "NULL::DOUBLE", "demand"), "zu"))
def zscore_by_user(spark, d):
    g = plain(spark, d, "user_id")
    return a.zscore_anomalies(g, a.fit_rolling_z(g), GRID)


@query("zscore_gappy", sql(result("zd", "zs", "zf", "zscore", "NULL::DOUBLE", "demand"), "zd"))
def zscore_gappy(spark, d):
    """The rolling window counts rows where a series has gaps."""
    rows = gappy(spark, d)
    return a.zscore_anomalies(rows, a.fit_rolling_z(rows))


view("rp", """rp AS (SELECT *, least(abs(actual - predicted) / (3 * sd + 1e-8), 1) AS rs, abs(actual - predicted) > 3 * sd AS rf
  FROM p JOIN (SELECT series, stddev_pop(actual - predicted) + 1e-8 AS sd FROM p GROUP BY 1) USING (series))""", "p")


@query("residual_anomalies", sql(result("rp", "rs", "rf", "residual"), "rp"))
def residual_anomalies(spark, d):
    p = naive(spark, d)
    return a.residual_anomalies(p, a.fit_residuals(p))


@query("residual_calibration", sql(f"""SELECT series, {r('avg(actual - predicted)')} AS residual_mean, {r('stddev_pop(actual - predicted) + 1e-8')} AS residual_std
  FROM p GROUP BY 1""", "p"))
def residual_calibration(spark, d):
    return a.fit_residuals(naive(spark, d))


view("fp", "fp AS (SELECT *, least(abs(actual - coalesce(predicted, actual)) / (actual + 1e-8), 1) AS fs FROM p)", "p")


@query("fallback_score", sql(result("fp", "fs", "fs > 0.3", "zscore_fallback"), "fp"))
def fallback_score(spark, d):
    return a.fallback_anomalies(naive(spark, d))


view("ens", """ens AS (SELECT rp.series, rp.timestamp, actual, predicted, (fs + zs + rs) / 3 AS es, (fs > 0.3)::INT + zf::INT + rf::INT >= 2 AS ef
  FROM rp JOIN zg USING (series, timestamp) JOIN (SELECT series, timestamp, fs FROM fp) USING (series, timestamp))""", "rp", "zg", "fp")


def three_scores(spark, d):
    """Rolling z, residual and fallback scores as columns of one plan (the third in the forest's place)."""
    g = plain(spark, d)
    p = naive(spark, d)
    rows = a.rolling_z(g, a.fit_rolling_z(g)).drop("z")
    rows = rows.join(p.select("series", "timestamp", "actual", "predicted"), ["series", "timestamp"])
    rows = a.residual_scores(rows, a.fit_residuals(p))
    return rows.withColumn("f_score", a.fallback_score("actual", "predicted")).withColumn("f_flag", F.col("f_score") > 0.3)


def voted(spark, d):
    return a.vote(three_scores(spark, d), ("f_score", "z_score", "residual_score"), ("f_flag", "z_flag", "residual_flag"))


@query("ensemble_votes", sql(result("ens", "es", "ef", "ensemble"), "ens"))
def ensemble_votes(spark, d):
    return voted(spark, d)


@query("severity_counts", sql(f"""SELECT method, severity, n_rows, n_flagged, {r('n_rows / sum(n_rows) OVER (PARTITION BY method)')} AS share FROM (
  SELECT 'residual' AS method, {SEVERITY.format(f='rf', s='rs')} AS severity, count(*) AS n_rows, sum(rf::INT)::BIGINT AS n_flagged FROM rp GROUP BY 2)""", "rp"))
def severity_counts(spark, d):
    p = naive(spark, d)
    return a.severity_counts(a.residual_anomalies(p, a.fit_residuals(p)))


@query("anomaly_file_roundtrip", sql(result("rp", "rs", "rf", "residual"), "rp"))
def anomaly_file(spark, d):
    """Anomaly results through a CSV file."""
    p, path = naive(spark, d), new_path(spark, "anomalies") + ".csv"
    sinks.write_results(a.residual_anomalies(p, a.fit_residuals(p)), path)
    return readers.load_anomalies(spark, path)


# ------------------------------------------------------------ isolation forest

def forest_rows(spark, d):
    """Feature matrix by split, written once."""
    matrix = build_features(split(spark, d), GRID, carry_history=True)
    return materialise(matrix, "forest"), feature_names(matrix, HOURLY)


@query("isolation_forest")
def isolation_forest(spark, d):
    matrix, names = forest_rows(spark, d)
    return IsolationForest(names).fit(matrix.where("split = 'train'")).predict(matrix)


@query("isolation_forest_scored")
def forest_scored(spark, d):
    """The forest fitted on one daily-scaled matrix: flagged rows per series after a save and load."""
    matrix, names = forest_rows(spark, d)
    path = new_path(spark, "iforest")
    IsolationForest(names).fit(matrix).save(spark, path)
    found = IsolationForest.load(spark, path).predict(matrix)
    return found.groupBy("series").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_anomaly").cast("long")).alias("n_flagged"))


@query("ensemble_full")
def ensemble_full(spark, d):
    """Forest, rolling z and residual detectors with a majority vote, fitted on the training rows, voting on all."""
    matrix, names = forest_rows(spark, d)
    train = matrix.where("split = 'train'")
    forest = IsolationForest(names).fit(train)
    p = matrix.withColumn("actual", F.col("demand")).withColumn("predicted", F.col("demand_lag_24h"))
    rows = a.rolling_z(forest.normalised(p), a.fit_rolling_z(train))
    rows = a.residual_scores(rows, a.fit_residuals(p.where("split = 'train'")))
    return a.vote(rows, ("forest_score", "z_score", "residual_score"), ("forest_flag", "z_flag", "residual_flag"))
