"""Fitted models on the feature matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import query
from catalogue.accuracy import NAMES, metric_sql, shown
from catalogue.base import DAILY_GRID, GRID, VIEWS, daily_grid, daily_parts, grid, plain, r, split, sql, view
from tidewatch.operators import models as mo
from tidewatch.operators.features import build_features, feature_names, lag_features
from tidewatch.operators.forecast import SequenceForecaster, naive_forecast
from tidewatch.operators.grid import over_parts
from tidewatch.operators.metrics import evaluate
from tidewatch.schemas import HOURLY
from tidewatch.session import materialise, new_path

ONE = ["demand_lag_24h"]
TWO = ["demand_lag_1h", "demand_lag_24h"]


def matrix(spark, d):
    """The feature matrix, look-back rows carried over into later splits, written once; and its feature names."""
    m = build_features(split(spark, d), GRID, carry_history=True)
    names = feature_names(m, HOURLY)
    return materialise(m.withColumn("target", F.col("demand")), "matrix"), names


def lagged(spark, d):
    rows = lag_features(grid(spark, d), lags=(1, 24)).where("demand_lag_24h is not null")
    return rows.withColumn("target", F.col("demand"))


view("lags2", """lags2 AS (SELECT * FROM (SELECT series, timestamp, demand AS y, lag(demand, 1) OVER w AS x1, lag(demand, 24) OVER w AS x2, pos, n FROM g
  WINDOW w AS (PARTITION BY series ORDER BY timestamp)) WHERE x2 IS NOT NULL)""", "g")
view("co", """co AS (SELECT series, count(*) AS m, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, covar_pop(x1, x1) AS s11, covar_pop(x2, x2) AS s22, covar_pop(x1, x2) AS s12,
  covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y FROM lags2 GROUP BY 1)""", "lags2")


def solved(alpha: str) -> str:
    """Two-feature normal equations with ``alpha`` on the diagonal (per row of data)."""
    det = f"((s11 + {alpha}) * (s22 + {alpha}) - s12 * s12)"
    return f"""(SELECT *, my - b1 * m1 - b2 * m2 AS b0 FROM (SELECT *, (s1y * (s22 + {alpha}) - s2y * s12) / {det} AS b1,
  (s2y * (s11 + {alpha}) - s1y * s12) / {det} AS b2 FROM co))"""


@query("ols_one_feature", sql(f"SELECT series, {r('regr_intercept(y, x2)', 5)} AS intercept, {r('regr_slope(y, x2)', 5)} AS slope FROM lags2 GROUP BY 1", "lags2"), digits=5)
def ols_one(spark, d):
    model = mo.LinearForecaster().fit(lagged(spark, d), ONE)
    return model.coefficients.select("series", "intercept", F.col("coef")[0].alias("slope"))


def _register_pair(kind: str, alpha: str) -> None:
    text = sql(f"SELECT series, m AS n, {r('b0', 5)} AS intercept, {r('b1', 5)} AS b1, {r('b2', 5)} AS b2 FROM {solved(alpha)}", "co")

    @query(f"{kind}_two_features", text, digits=5)
    def pair(spark, d):
        model = mo.LinearForecaster(kind).fit(lagged(spark, d), TWO)
        return model.coefficients.select("series", "n", "intercept", F.col("coef")[0].alias("b1"), F.col("coef")[1].alias("b2"))


_register_pair("linear_regression", "0")
_register_pair("ridge", "(1 / m)")


view("llags", """llags AS (SELECT * FROM (SELECT series, timestamp, demand AS y, lag(demand, 1) OVER w AS x1, lag(demand, 7) OVER w AS x2 FROM lg
  WINDOW w AS (PARTITION BY series ORDER BY timestamp)) WHERE x2 IS NOT NULL)""", "lg")
view("lco", VIEWS["co"][0].replace("co AS", "lco AS", 1).replace("FROM lags2", "FROM llags"), "llags")
WEEK = ["demand_lag_1h", "demand_lag_7h"]


def by_supplier(spark, d):
    """The daily panel of every supplier with two lags: as many models as suppliers."""
    return lagged_days(daily_grid(spark, d).drop("pos", "n"), DAILY_GRID)


def lagged_days(rows, panel):
    return lag_features(rows, panel, lags=(1, 7)).where("demand_lag_7h is not null").withColumn("target", F.col("demand"))


@query("ridge_by_supplier", sql(f"SELECT series, m AS n, {r('b0', 5)} AS intercept, {r('b1', 5)} AS b1, {r('b2', 5)} AS b2 FROM {solved('(1 / m)').replace('FROM co', 'FROM lco')}", "lco"), digits=5)
def ridge_by_supplier(spark, d):
    model = mo.LinearForecaster("ridge").fit(by_supplier(spark, d), WEEK)
    return model.coefficients.select("series", "n", "intercept", F.col("coef")[0].alias("b1"), F.col("coef")[1].alias("b2"))


@query("lasso_one_feature", sql(f"""SELECT series, {r('my - b * m2', 5)} AS intercept, {r('b', 5)} AS slope FROM (
  SELECT *, sign(s2y) * greatest(abs(s2y) - 0.1, 0) / s22 AS b FROM co)""", "co"), digits=5)
def lasso_one(spark, d):
    """Closed form: soft threshold of the covariance."""
    model = mo.LinearForecaster("lasso").fit(lagged(spark, d), ONE)
    return model.coefficients.select("series", "intercept", F.col("coef")[0].alias("slope"))


@query("linear_forecast_metrics", sql(f"""SELECT series, n_predictions, {shown(NAMES)} FROM (SELECT series, count(*) AS n_predictions, {metric_sql()} FROM (
  SELECT series, y AS actual, greatest(b0 + b1 * x1 + b2 * x2, 0) AS predicted FROM lags2 JOIN {solved('0')} USING (series)) GROUP BY 1)""", "co"))
def linear_forecast_metrics(spark, d):
    rows = lagged(spark, d)
    return evaluate(mo.LinearForecaster().fit(rows, TWO).predict(rows), ("series",), "target")


@query("pooled_ols", sql(f"SELECT count(*) AS n, {r('regr_intercept(y, x2)', 5)} AS intercept, {r('regr_slope(y, x2)', 5)} AS slope FROM lags2", "lags2"), digits=5)
def pooled_ols(spark, d):
    """One model over all series."""
    model = mo.LinearForecaster(keys=()).fit(lagged(spark, d), ONE)
    return model.coefficients.select("n", "intercept", F.col("coef")[0].alias("slope"))


# ------------------------------------------------------------ whole matrix: fitted on train and val, scored on test

def _register_linear(kind: str, name: str) -> None:
    @query(name)
    def linear(spark, d):
        m, names = matrix(spark, d)
        model = mo.LinearForecaster(kind, keys=()).fit(m.where("split != 'test'"), names)
        return evaluate(model.predict(m.where("split = 'test'")), ("series",), "target")


_register_linear("linear_regression", "ols")
_register_linear("ridge", "ridge")
_register_linear("lasso", "lasso")


def _register_tree(name: str, make) -> None:
    @query(name)
    def tree(spark, d):
        m, names = matrix(spark, d)
        model = make().fit(m.where("split != 'test'"), names)
        return evaluate(model.predict(m.where("split = 'test'")), ("series",), "target")


# smaller presets than the defaults of the library, for run time
_register_tree("forest", lambda: mo.random_forest(trees=20, depth=8))
_register_tree("gbt_a", lambda: mo.boosted_a(rounds=10, depth=5))
_register_tree("gbt_b", lambda: mo.boosted_b(rounds=10, depth=4))


@query("feature_top_k")
def feature_top_k(spark, d):
    m, names = matrix(spark, d)
    return mo.select_features(m.where("split = 'train'"), names, top_k=10, trees=20, depth=6)


@query("lasso_sparsity")
def lasso_sparsity(spark, d):
    m, names = matrix(spark, d)
    return mo.LinearForecaster("lasso").fit(m.where("split = 'train'"), names).sparsity()


@query("cv_models")
def cv_models(spark, d):
    """Three linear models over five expanding folds, all folds in one pass each."""
    m, names = matrix(spark, d)
    kinds = [mo.LinearForecaster(k) for k in ("linear_regression", "ridge", "lasso")]
    return mo.cv_results(mo.cross_validate(kinds, m.where("split = 'train'"), names))


view("cvfit", """cvfit AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY timestamp) - 1 AS i, count(*) OVER (PARTITION BY series) AS nn FROM lags2)
  CROSS JOIN (SELECT unnest(range(5)) AS fold))""", "lags2")


@query("cv_ols_one_feature", sql(f"""SELECT series, fold::BIGINT AS fold, n_predictions, {shown(NAMES)} FROM (
  SELECT series, fold, count(*) AS n_predictions, {metric_sql('', 'y', 'greatest(a + b * x2, 0)')}
  FROM (SELECT *, nn - (5 - fold) * floor(nn / 6)::BIGINT AS st FROM cvfit)
  JOIN (SELECT series, fold, regr_slope(y, x2) AS b, regr_intercept(y, x2) AS a FROM (SELECT *, nn - (5 - fold) * floor(nn / 6)::BIGINT AS st FROM cvfit)
    WHERE i < st - 24 GROUP BY 1, 2) USING (series, fold)
  WHERE i >= st AND i < st + floor(nn / 6)::BIGINT GROUP BY 1, 2)""", "cvfit"))
def cv_ols(spark, d):
    rows = lagged(spark, d).drop("pos", "n")
    return mo.cross_validate([mo.LinearForecaster()], rows, ONE).drop("model")


view("lcvfit", VIEWS["cvfit"][0].replace("cvfit AS", "lcvfit AS", 1).replace("FROM lags2", "FROM llags"), "llags")


@query("cv_ols_by_supplier", sql(f"""SELECT series, fold::BIGINT AS fold, n_predictions, {shown(NAMES)} FROM (
  SELECT series, fold, count(*) AS n_predictions, {metric_sql('', 'y', 'greatest(a + b * x2, 0)')}
  FROM (SELECT *, nn - (5 - fold) * floor(nn / 6)::BIGINT AS st FROM lcvfit)
  JOIN (SELECT series, fold, regr_slope(y, x2) AS b, regr_intercept(y, x2) AS a FROM (SELECT *, nn - (5 - fold) * floor(nn / 6)::BIGINT AS st FROM lcvfit)
    WHERE i < st - 24 GROUP BY 1, 2) USING (series, fold)
  WHERE i >= st AND i < st + floor(nn / 6)::BIGINT GROUP BY 1, 2)""", "lcvfit"))
def cv_ols_by_supplier(spark, d):
    """As many models as suppliers and folds, all in one pass."""
    return over_parts(daily_parts(spark, d), lambda rows, panel: mo.cross_validate([mo.LinearForecaster()], lagged_days(rows, panel), WEEK[1:], panel)).drop("model")


@query("model_roundtrip", sql(f"SELECT series, timestamp, {r('greatest(b0 + b1 * x1 + b2 * x2, 0)', 5)} AS predicted FROM lags2 JOIN {solved('(1 / m)')} USING (series)", "co"), digits=5)
def model_roundtrip(spark, d):
    """A ridge model saved, loaded and used."""
    rows, path = lagged(spark, d), new_path(spark, "model")
    mo.LinearForecaster("ridge").fit(rows, TWO).save(path)
    return mo.LinearForecaster.load(spark, path).predict(rows).select("series", "timestamp", "predicted")


# ------------------------------------------------------------ sequences

@query("sequence_forecast")
def sequence_forecast(spark, d):
    g = plain(spark, d)
    return SequenceForecaster().fit(g).predict(g)


@query("multi_step_forecast")
def multi_step(spark, d):
    g = grid(spark, d)
    return SequenceForecaster().fit(g).forecast(g, 48)


view("zs2", """zs2 AS (SELECT * FROM (SELECT series, timestamp, m, s, z AS y, lag(z, 2) OVER w AS x1, lag(z, 1) OVER w AS x2 FROM (
  SELECT g.series, timestamp, ((demand - m) / s)::FLOAT::DOUBLE AS z, m, s FROM g JOIN (SELECT series, avg(demand) AS m, stddev_pop(demand) + 1e-8 AS s FROM g GROUP BY 1) k USING (series))
  WINDOW w AS (PARTITION BY series ORDER BY timestamp)) WHERE x1 IS NOT NULL)""", "g")
view("zco", VIEWS["co"][0].replace("co AS", "zco AS", 1).replace("FROM lags2", "FROM zs2"), "zs2")
_TWO_BACK = solved("0").replace("FROM co", "FROM zco")


@query("sequence_forecast_two", sql(f"SELECT series, timestamp, {r('y * s + zs2.m', 4)} AS actual, {r('greatest((b0 + b1 * x1 + b2 * x2) * s + zs2.m, 0)', 4)} AS predicted FROM zs2 JOIN {_TWO_BACK} USING (series)", "zco"), digits=4)
def sequence_two(spark, d):
    """The sequence model with the last two values, which SQL can solve."""
    g = plain(spark, d)
    return SequenceForecaster(2).fit(g).predict(g)


view("ahead", f"""ahead AS (SELECT series, 0 AS step, z1, z2, b0, b1, b2, m, s, hi FROM (
  SELECT series, arg_max(z, timestamp) AS z2, arg_max(zp, timestamp) AS z1, max(timestamp) AS hi, any_value(m) AS m, any_value(s) AS s FROM (
    SELECT series, timestamp, m, s, z, lag(z) OVER (PARTITION BY series ORDER BY timestamp) AS zp FROM (
      SELECT g.series, timestamp, (demand - m) / s AS z, m, s FROM g JOIN (SELECT series, avg(demand) AS m, stddev_pop(demand) + 1e-8 AS s FROM g GROUP BY 1) k USING (series))) GROUP BY 1)
  JOIN {_TWO_BACK.replace('SELECT *,', 'SELECT series,', 1).replace('my - b1 * m1 - b2 * m2 AS b0', 'b1, b2, my - b1 * m1 - b2 * m2 AS b0')} USING (series)
  UNION ALL SELECT series, step + 1, z2, b0 + b1 * z1 + b2 * z2, b0, b1, b2, m, s, hi FROM ahead WHERE step < 48)""", "zco")


@query("multi_step_forecast_two", sql(f"SELECT series, step::BIGINT AS step, hi + step * INTERVAL 1 HOUR AS timestamp, {r('greatest(z2 * s + m, 0)', 4)} AS predicted FROM ahead WHERE step > 0", "ahead").replace("WITH", "WITH RECURSIVE", 1), digits=4)
def multi_step_two(spark, d):
    g = grid(spark, d)
    return SequenceForecaster(2).fit(g).forecast(g, 48)


@query("multi_step_naive", sql(f"""SELECT series, step::BIGINT AS step, hi + step * INTERVAL 1 HOUR AS timestamp, {r('greatest(demand, 0)')} AS predicted
FROM (SELECT series, max(timestamp) AS hi, max(n) AS n FROM g GROUP BY 1) CROSS JOIN (SELECT unnest(range(1, 49)) AS step)
JOIN (SELECT series, pos, demand FROM g) USING (series) WHERE pos = n - 24 + (step - 1) % 24""", "g"))
def multi_step_naive(spark, d):
    return naive_forecast(grid(spark, d), 48)


@query("multi_step_naive_by_user", sql(f"""SELECT series, step::BIGINT AS step, hi + step * INTERVAL 1 HOUR AS timestamp, {r('greatest(demand, 0)')} AS predicted
FROM (SELECT series, max(timestamp) AS hi, max(n) AS n FROM ug GROUP BY 1) CROSS JOIN (SELECT unnest(range(1, 49)) AS step)
JOIN (SELECT series, pos, demand FROM ug) USING (series) WHERE n >= 24 AND pos = n - 24 + (step - 1) % 24""", "ug"))
def multi_step_naive_by_user(spark, d):
    return naive_forecast(grid(spark, d, "user_id"), 48)
