from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.frames import series, values, wave
from tidewatch.operators import explore, metrics as m, models as mo
from tidewatch.operators.forecast import SequenceForecaster
from tidewatch.schemas import HOURLY

NAMES = ["a", "b", "c", "twin"]


def data(spark, n=300, name="s"):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 3)) * [1, 10, 100] + [0, 5, 1000]
    y = 3 * x[:, 0] - 0.5 * x[:, 1] + 0.1 * x[:, 2] + 200 + rng.normal(size=n)
    rows = [(name, i, *map(float, r), float(2 * r[0]), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "series string, i long, a double, b double, c double, twin double, target double")
    return df.withColumn("timestamp", F.timestamp_seconds(F.col("i") * 3600)), x, y


def test_least_squares_with_a_collinear_column(spark):
    df, x, y = data(spark)
    got = mo.LinearForecaster().fit(df, NAMES).predict(df.repartition(5))
    z = np.c_[np.ones(len(x)), x]
    best = z @ np.linalg.lstsq(z, y, rcond=None)[0]
    assert values(got, "predicted") == pytest.approx(list(best), abs=1e-6)


def test_ridge_closed_form(spark):
    df, x, y = data(spark)
    model = mo.LinearForecaster("ridge", alpha=5.0).fit(df, NAMES[:3])
    c = x - x.mean(axis=0)
    beta = np.linalg.solve(c.T @ c + 5 * np.eye(3), c.T @ (y - y.mean()))
    assert model.coefficients.first().coef == pytest.approx(list(beta), rel=1e-7)


def test_lasso_conditions(spark):
    """At the optimum every residual correlation is at most alpha, and equals it where the coefficient is not zero."""
    df, x, y = data(spark)
    model = mo.LinearForecaster("lasso", alpha=1.0).fit(df, NAMES[:3])
    beta = np.array(model.coefficients.first().coef)
    c, t = x - x.mean(axis=0), y - y.mean()
    pull = c.T @ (t - c @ beta) / len(y)
    for g, w in zip(pull, beta):
        assert abs(g) <= 1.0 + 1e-5
        if w:
            assert g == pytest.approx(np.sign(w), abs=1e-5)
    heavy = mo.LinearForecaster("lasso", alpha=1e6).fit(df, NAMES[:3]).sparsity().first()
    assert (heavy.n_zero, heavy.n_features, heavy.sparsity) == (3, 3, 1.0)


def test_one_model_per_series_and_pooled(spark):
    a, b = data(spark)[0], data(spark, 120, "t")[0].withColumn("target", F.col("a") * 7 + 1000)
    both = a.unionByName(b)
    per = {r.series: r.coef[0] for r in mo.LinearForecaster().fit(both, NAMES[:3]).coefficients.collect()}
    assert per["s"] == pytest.approx(3, abs=0.3) and per["t"] == pytest.approx(7)
    assert mo.LinearForecaster(keys=()).fit(both, NAMES[:3]).coefficients.count() == 1


def test_unfitted_and_negative(spark, tmp_path):
    df, *_ = data(spark, 50)
    for model in (mo.LinearForecaster(), mo.random_forest(2, 2)):
        with pytest.raises(RuntimeError):
            model.predict(df)
        with pytest.raises(RuntimeError):
            model.save(str(tmp_path / "m"))
    low = df.withColumn("target", F.lit(-5.0) + F.col("a"))
    assert min(values(mo.LinearForecaster().fit(low, ["a"]).predict(low), "predicted")) == 0.0
    with pytest.raises(ValueError):
        mo.LinearForecaster("elastic")


def test_forest_importances_and_reload(spark, tmp_path):
    df, *_ = data(spark, 200)
    model = mo.random_forest(trees=5, depth=4).fit(df, NAMES[:3])
    assert model.importances(spark).agg(F.sum("importance")).first()[0] == pytest.approx(1)
    model.save(str(tmp_path / "rf"))
    again = mo.TreeForecaster.load(str(tmp_path / "rf"))
    assert again.features == NAMES[:3]
    assert values(again.predict(df), "predicted") == values(model.predict(df), "predicted")


def test_metric_values(spark):
    df = spark.createDataFrame([("a", 100.0, 90.0), ("a", 200.0, 220.0), ("b", 5.0, 5.0), ("b", 0.0, 0.0)], "series string, actual double, predicted double")
    got = {r.series: r for r in m.evaluate(df).collect()}
    assert got["a"].mape == pytest.approx(10) and got["a"].mae == 15
    assert (got["b"].rmse, got["b"].mae, got["b"].mape, got["b"].smape) == (0, 0, 0, 0)
    assert got["b"].r2 == pytest.approx(1)


def test_mase_of_constant_is_infinite(spark):
    p = spark.createDataFrame([("a", 1.0, 2.0)], "series string, actual double, predicted double")
    assert m.mase(p, series(spark, [5.0] * 10)).first().mase == float("inf")


def test_best_model_tie_goes_to_the_first(spark):
    df = spark.createDataFrame([("a", "z", 1, 2.0), ("a", "b", 2, 2.0), ("a", "c", 3, 9.0)], "series string, model string, ord int, test_rmse double")
    assert m.best_model(df, order="ord").first().best_model == "z"
    assert m.best_model(df).first().best_model == "b"


def test_sequence_model_learns_a_cycle(spark):
    import math

    df = series(spark, [100 + 10 * math.sin(2 * math.pi * i / 24) for i in range(200)])
    model = SequenceForecaster().fit(df)
    out = model.predict(df)
    assert out.count() == 176
    assert m.evaluate(out).first().rmse < 0.01
    ahead = values(model.forecast(df, 48), "predicted", ("step",))
    assert ahead == pytest.approx([100 + 10 * math.sin(2 * math.pi * i / 24) for i in range(200, 248)], abs=0.5)
    with pytest.raises(RuntimeError):
        SequenceForecaster().predict(df)


def test_acf_reads_the_whole_series(spark):
    """More rows than several chunks hold, the first half louder; and the last rows alone on demand."""
    rng = np.random.default_rng(5)
    x = np.cumsum(rng.normal(size=7000)) * np.where(np.arange(7000) < 3500, 3.0, 1.0)

    def plain(v, k):
        d = v - v.mean()
        return float((d[k:] * d[:len(d) - k]).sum() / (d * d).sum())

    df = series(spark, list(map(float, x)))
    got = {r.lag: r.acf for r in explore.acf(df, lags=12).collect()}
    assert got == pytest.approx({k: plain(x, k) for k in range(13)}, abs=1e-9)
    got = {r.lag: r.acf for r in explore.acf(df, lags=12, sample=3000).collect()}
    assert got == pytest.approx({k: plain(x[-3000:], k) for k in range(13)}, abs=1e-9)


def test_pacf_of_an_autoregression(spark):
    rng, x = random.Random(0), [0.0]
    for _ in range(3000):
        x.append(0.7 * x[-1] + rng.gauss(0, 1))
    got = {r.lag: r.pacf for r in explore.pacf(series(spark, x), lags=5).collect()}
    assert got[0] == 1 and got[1] == pytest.approx(0.7, abs=0.05) and abs(got[2]) < 0.06


def test_pacf_against_yule_walker(spark):
    x = np.array(wave(400))
    d = x - x.mean()
    r = np.array([d[k:] @ d[: len(d) - k] / (d @ d) for k in range(8)])
    got = {row.lag: row.pacf for row in explore.pacf(series(spark, list(map(float, x))), lags=7).collect()}
    for k in range(1, 8):
        t = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        assert got[k] == pytest.approx(np.linalg.solve(t, r[1 : k + 1])[-1], abs=1e-9)


def test_qq_fit_by_hand(spark):
    import statistics

    x = [1.0, 2.0, 2.0, 2.0, 5.0, 9.0, 10.0]
    n = len(x)
    place = [1 - 0.5 ** (1 / n), *[(i - 0.3175) / (n + 0.365) for i in range(2, n)], 0.5 ** (1 / n)]
    q = [statistics.NormalDist().inv_cdf(p) for p in place]
    slope, intercept = np.polyfit(q, x, 1)
    got = explore.qq_fit(series(spark, x)).first()
    assert (got.slope, got.intercept) == (pytest.approx(slope), pytest.approx(intercept))
    assert explore.qq_points(series(spark, x), block=2).count() == n


def test_decompose_needs_two_periods(spark):
    assert explore.seasonal_decompose(series(spark, wave(300))).count() == 0
    out = explore.seasonal_decompose(series(spark, wave(400)), HOURLY.on(chunk_rows=100))
    assert out.count() == 400 and out.where("trend is null or residual is null").count() == 0


def test_products_of_a_hot_key_and_of_tiny_ones(spark):
    """Few rows of a key travel as rows, many as one array; the sums are the same."""
    rng = np.random.default_rng(5)
    names = ["hot"] * 900 + [f"k{i % 80}" for i in range(150)] + [None] * 3
    rows = [(k, *map(float, r)) for k, r in zip(names, rng.normal(size=(len(names), 3)))]
    df = spark.createDataFrame(rows, "k string, a double, b double, y double").repartition(3)
    got = {r.k: np.array(r.products) for r in mo.sum_products(df, ["k"], ["a", "b"], "y").collect()}
    assert len(got) == 82
    for k, products in got.items():
        z = np.array([[1.0, *r[1:]] for r in rows if r[0] == k])
        assert products == pytest.approx((z.T @ z)[np.triu_indices(4)])


def test_binned_density_is_close_to_the_direct_sum(spark):
    v = np.array(wave(300))
    got = explore.kde(series(spark, v.tolist())).orderBy("point").collect()
    h = v.std(ddof=1) * len(v) ** -0.2
    x = np.linspace(v.min(), v.max(), 200)
    direct = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi))
    assert [r.x for r in got] == pytest.approx(x.tolist())
    assert np.abs(np.array([r.density for r in got]) - direct).max() < 1e-3 * direct.max()


def test_density_is_the_direct_sum_where_the_range_is_wide(spark):
    """One far value makes the bandwidth narrow beside the range; copies count each, a constant series has no density."""
    a = np.array([*wave(6000), *[800.0] * 500, 3e6])
    b = np.array(wave(50, seed=1))
    rows = [(k, i, float(x)) for k, v in (("a", a), ("b", b), ("flat", [5.0] * 3)) for i, x in enumerate(v)] + [("a", -1, None)]
    df = spark.createDataFrame(rows, "series string, timestamp long, demand double").repartition(5)
    got = explore.kde(df).collect()
    assert len(got) == 400
    for name, v in (("a", a), ("b", b)):
        mine = sorted((r for r in got if r.series == name), key=lambda r: r.point)
        h, x = v.std(ddof=1) * len(v) ** -0.2, np.linspace(v.min(), v.max(), 200)
        direct = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi))
        assert [r.x for r in mine] == pytest.approx(x.tolist())
        assert [r.density for r in mine] == pytest.approx(direct.tolist(), rel=1e-9, abs=1e-12 * direct.max())


def test_folds_of_whole_series_where_they_stand(spark):
    """The same scores as with a fold as one more key; rows leave their tasks as metrics only."""
    from tidewatch.operators.features import lag_features
    from tidewatch.operators.grid import over_parts, parts, regularise
    from tidewatch.schemas import HOURLY

    panel, full = HOURLY.on(chunk_rows=16), HOURLY.on(full=True)
    df = series(spark, wave(100), gaps=range(40, 47)).unionByName(series(spark, wave(8, 3), "short")).unionByName(series(spark, wave(400, 5), "long"))
    model = [mo.LinearForecaster()]

    def run(rows, panel):
        rows = lag_features(rows, panel, (1, 2)).where("demand_lag_2h is not null").withColumn("target", F.col("demand"))
        return mo.cross_validate(model, rows, ["demand_lag_1h", "demand_lag_2h"], panel, gap=3)

    made = parts(df, panel)
    assert [p.whole for _, p in made] == [True, False]
    ours = over_parts(made, run).orderBy("series", "fold").toPandas()
    plain = run(regularise(df, panel, "linear"), full).orderBy("series", "fold").toPandas()[ours.columns.tolist()]
    assert ours["series"].tolist() == plain["series"].tolist() and ours["fold"].tolist() == plain["fold"].tolist()
    for c in ("rmse", "mae", "mape", "r2", "smape", "n_predictions"):
        assert ours[c].to_numpy(float) == pytest.approx(plain[c].to_numpy(float), nan_ok=True, rel=1e-6), c
    plan = run(*made[0])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("run(") == 2 and "partial_" in plan.split("MapInArrow")[0]  # lags, then fits and scores; nothing shuffled between
    assert "Exchange" not in "".join(plan.split("MapInArrow")[1:2])


def test_boxes_where_series_stand_whole(spark):
    """Months of short series are boxed where their rows are; those of a long one as before."""
    from tidewatch.operators.grid import over_parts, parts, regularise

    panel, full = HOURLY.on(step=86400, chunk_rows=16), HOURLY.on(step=86400, full=True)
    df = series(spark, wave(2400, 4, size=300.0), gaps=range(30, 300)).unionByName(series(spark, [None, 3.0], "b"))
    df = df.groupBy("series", F.date_trunc("day", "timestamp").alias("timestamp")).agg(F.max("demand").alias("demand"))
    long = series(spark, [1.0, 900.0], "long").withColumn("timestamp", F.expr("timestamp + make_interval(0, 0, 0, (demand / 2)::int)"))
    made = parts(df.unionByName(long), panel)
    assert [p.whole for _, p in made] == [True, False]
    ours = over_parts(made, explore.monthly_box).orderBy("series", "month").toPandas()
    plain = explore.monthly_box(regularise(df.unionByName(long), panel, "linear"), full).orderBy("series", "month").toPandas()
    assert ours.columns.tolist() == plain.columns.tolist() and ours[["series", "month_name"]].equals(plain[["series", "month_name"]])
    for c in plain.columns[3:]:
        assert ours[c].to_numpy(float) == pytest.approx(plain[c].to_numpy(float)), c
    plan = explore.monthly_box(*made[0])._jdf.queryExecution().executedPlan().toString().split("Generate")[0]
    assert plan.count("Exchange") == 1 and "partial_" in plan.split("Exchange")[1]  # one row a box and task
