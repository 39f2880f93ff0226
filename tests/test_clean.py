from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from tests.frames import series, values, wave
from tidewatch.functions.scalar import clip_range, normal_quantile
from tidewatch.operators import clean as c
from tidewatch.operators.quantiles import exact_quantiles, running_counts
from tidewatch.schemas import HOURLY

TINY = HOURLY.on(chunk_rows=16)


def test_outliers_are_capped_and_counted(spark):
    raw = wave(500)
    raw[50], raw[200] = 9999.0, -500.0
    out = c.clean(series(spark, raw), TINY, keep_flag=True)
    stats = c.clean_stats(out).first()
    assert stats.n_rows == 500 and stats.n_outliers >= 2
    assert stats.demand_max < 9999 and stats.demand_min >= 0


def test_no_nulls_remain(spark):
    raw = [None if i in {*range(10, 16), 100} else v for i, v in enumerate(wave(300))]
    assert c.clean(series(spark, raw), TINY).where("demand is null").count() == 0


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-5.0,), (None,), (20000.0,), (7.0,)], "demand double")
    assert [r[0] for r in df.select(clip_range("demand")).collect()] == [0.0, None, 10000.0, 7.0]


def test_zscore_replaces_by_median(spark):
    raw = [10.0, 11.0, 9.0, 10.0, 12.0, 8.0, 10.0, 11.0, 9.0, 10.0, 10.0, 10.0, 500.0]
    out = values(c.treat_outliers(series(spark, raw), TINY, "zscore"))
    assert out[-1] == 10.0 and out[:-1] == raw[:-1]


def test_constant_series_has_no_outliers(spark):
    out = c.treat_outliers(series(spark, [5.0] * 30), TINY, "both")
    assert values(out) == [5.0] * 30 and out.where("is_outlier").count() == 0
    scaled = c.scale(series(spark, [5.0] * 3), c.fit_scaler(series(spark, [5.0] * 3)))
    assert values(scaled, "scaled") == [0.0] * 3


@pytest.mark.parametrize("method", ["standard", "minmax", "robust"])
def test_scaler_round_trip(spark, method):
    df = series(spark, wave(100))
    fitted = c.fit_scaler(df, method=method)
    back = c.inverse_scale(c.scale(df, fitted), fitted)
    assert values(back, "restored") == pytest.approx(values(df))


def test_wrong_names_raise(spark):
    df = series(spark, [1.0, 2.0])
    with pytest.raises(ValueError):
        c.treat_outliers(df, method="mad")
    with pytest.raises(ValueError):
        c.fit_scaler(df, method="log")
    with pytest.raises(RuntimeError):
        c.scale(df, None)


@pytest.mark.parametrize("accuracy, small", [(10, 700), (10_000, 16_384)])
def test_quantiles_are_exact_beyond_the_sketch(spark, accuracy, small):
    """A coarse sketch only costs rounds; the result stays exact, heavy values included."""
    import random

    rng = random.Random(1)
    rows = [("a", rng.expovariate(0.01)) for _ in range(4000)] + [("a", 5.0)] * 2000 + [("b", float(i)) for i in range(11)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", {"p0": 0.0, "q1": 0.25, "q2": 0.5, "q9": 0.9, "p100": 1.0}, accuracy, small).collect()}
    x = sorted(v for k, v in rows if k == "a")
    for name, p in (("p0", 0.0), ("q1", 0.25), ("q2", 0.5), ("q9", 0.9), ("p100", 1.0)):
        spot = p * (len(x) - 1)
        lo = int(spot)
        hi = min(lo + 1, len(x) - 1)
        assert got["a"][name] == pytest.approx(x[lo] + (x[hi] - x[lo]) * (spot - lo))
    assert (got["b"].q1, got["b"].q2, got["b"].p100) == (2.5, 5.0, 10.0)


def test_quantiles_without_keys_and_with_wrong_cuts(spark, monkeypatch):
    """Cuts that miss every rank only choose the wrong piece for a while: each round still narrows the brackets."""
    from tidewatch.operators import quantiles

    df = spark.createDataFrame([(float(i * i % 997),) for i in range(997)], "v double")
    x = sorted(float(i * i % 997) for i in range(997))
    assert exact_quantiles(df, [], "v", {"m": 0.5, "p": 0.1}, small=10).first()[:] == (x[498], pytest.approx(x[99] + 0.6 * (x[100] - x[99])))
    plain = F.percentile_approx
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda c, at, accuracy: plain(c, [0.6] * len(at), 100))
    assert exact_quantiles(df, [], "v", {"m": 0.5}, small=300).first().m == x[498]


def test_no_task_sorts_more_than_a_small_bracket(spark):
    """One key with most of the rows: what is sorted per key and rank stays under the bound."""
    from tidewatch.operators import quantiles

    df = spark.range(60_000).selectExpr("if(id % 10 = 0, 'b', 'a') AS k", "cast(pmod(hash(id), 1000003) as double) AS v")
    seen = []
    picked = quantiles._picked
    quantiles._picked = lambda rows, state, *rest: seen.append(rows.groupBy("k").count().agg(F.max("count")).first()[0]) or picked(rows, state, *rest)
    try:
        got = {r.k: r for r in exact_quantiles(df, ["k"], "v", {"q1": 0.25, "q3": 0.75}, small=500).collect()}
    finally:
        quantiles._picked = picked
    want = {r.k: r for r in df.groupBy("k").agg(F.percentile("v", 0.25).alias("q1"), F.percentile("v", 0.75).alias("q3")).collect()}
    assert seen[0] <= 2 * 500 and all((got[k].q1, got[k].q3) == pytest.approx((want[k].q1, want[k].q3)) for k in "ab")


def test_quantile_of_nulls_is_absent(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "k string, v double")
    assert [r.k for r in exact_quantiles(df, ["k"], "v", {"m": 0.5}).collect()] == ["b"]


def test_running_counts(spark):
    rows = [("a", float(i % 50), 1 + i % 3) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, v double, n long")
    got = running_counts(df, ["k"], "v", ["n"], buckets=8).orderBy("v").collect()
    total = 0
    for r in got:
        assert r.before_n == total
        total += r.n
        assert r.cum_n == total


def test_normal_quantile(spark):
    points = [1e-12, 1e-6, 0.01, 0.075, 0.2, 0.5, 0.77, 0.95, 0.999, 1 - 1e-9]
    df = spark.createDataFrame([(p,) for p in points], "p double").select("p", normal_quantile("p").alias("z"))
    for r in df.collect():
        assert r.z == pytest.approx(statistics.NormalDist().inv_cdf(r.p), abs=1e-9)


def test_clean_with_stored_bounds(spark):
    train, new = series(spark, wave(200)), series(spark, [5000.0, *wave(50, seed=3)])
    bounds = c.fit_iqr_bounds(train)
    top = bounds.first().upper
    assert values(c.clean(new, TINY, bounds=bounds))[0] == pytest.approx(top)
    assert c.clean(new, TINY, staged=True).count() == 51


def test_mean_of_group_is_unchanged_by_salting(spark):
    from tidewatch.operators.joins import attach

    df = series(spark, wave(100))
    state = df.groupBy("series").agg(F.avg("demand").alias("m"))
    assert attach(df, state, ["series"], "timestamp").select("m").distinct().count() == 1
    assert attach(df, state.drop("series"), [], "timestamp").count() == 100


def test_fences_where_series_stand_whole(spark):
    """Short series get theirs where their rows are, a long one as before; the same values, and no filled row is shuffled."""
    panel = HOURLY.on(chunk_rows=16)
    raw = wave(100)
    raw[20], raw[50], raw[60] = 5000.0, -300.0, None
    df = series(spark, raw, gaps=range(70, 80)).unionByName(series(spark, [None, 3.0], "b")).unionByName(series(spark, [None] * 3, "c"))
    short = df.withColumn("note", F.lit("x"))
    both = short.unionByName(series(spark, wave(300, 9)[:-1] + [9999.0], "long").withColumn("note", F.lit("y")))
    for frame in (short, both):
        got = c.clean(frame, panel, keep_flag=True, with_position=True).orderBy("series", "timestamp").toPandas()
        plain = c.regularise(frame, panel, "linear", with_position=True)
        plain = c.cap_iqr(plain, c.fit_iqr_bounds(plain, panel), panel).withColumn("demand", clip_range("demand"))
        plain = plain.orderBy("series", "timestamp").toPandas()
        assert got.columns.tolist() == plain.columns.tolist()
        assert got["demand"].to_numpy(float) == pytest.approx(plain["demand"].to_numpy(float), nan_ok=True)
        for name in ("series", "timestamp", "pos", "n", "is_outlier"):
            assert got[name].tolist() == plain[name].tolist()
        assert got["note"].fillna("").tolist() == plain["note"].fillna("").tolist()
    plan = c.clean(short, panel)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Generate")[0] and "MapInArrow" in plan.split("Generate")[0]
