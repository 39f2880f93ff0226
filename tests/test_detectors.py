from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.frames import series, wave
from tidewatch.functions.scalar import fallback_score, psi_level, severity
from tidewatch.operators import anomaly as a
from tidewatch.operators import drift, monitor
from tidewatch.operators.iforest import IsolationForest, tree_samples
from tidewatch.schemas import HOURLY

SMALL = HOURLY.on(chunk_rows=200)


def spiky(spark):
    rng = random.Random(42)
    v = [800 + rng.gauss(0, 30) for _ in range(300)]
    v[50], v[150], v[250] = 2500.0, -200.0, 1800.0
    return series(spark, v)


def test_zscore_flags_the_spike(spark):
    df = spiky(spark)
    rows = a.zscore_anomalies(df, a.fit_rolling_z(df), SMALL).orderBy("timestamp").collect()
    assert rows[50].is_anomaly and rows[50].severity != "normal"
    assert all(0 <= r.anomaly_score <= 1 for r in rows)
    assert rows[0].anomaly_score == 0 and not rows[0].is_anomaly
    with pytest.raises(RuntimeError):
        a.zscore_anomalies(df, None)


def test_residual_flags_the_miss(spark):
    df = series(spark, wave(200)).withColumnRenamed("demand", "actual")
    p = df.withColumn("predicted", F.col("actual") + F.when(F.col("timestamp") == F.lit("2022-01-05 04:00:00").cast("timestamp"), 1000.0).otherwise(F.rand(1)))
    found = a.residual_anomalies(p, a.fit_residuals(p)).where("is_anomaly").collect()
    assert [str(r.timestamp) for r in found] == ["2022-01-05 04:00:00"] and found[0].severity == "high"
    with pytest.raises(RuntimeError):
        a.residual_anomalies(p, None)


def test_severity_borders(spark):
    df = spark.createDataFrame([(s,) for s in (0.0, 0.1, 0.3, 0.6, 0.65, 0.8, 0.9, 1.0)], "s double")
    assert [r[0] for r in df.select(severity("s")).collect()] == ["normal", "normal", "low", "medium", "medium", "high", "high", "high"]
    levels = spark.createDataFrame([(s,) for s in (0.05, 0.1, 0.2, 0.25)], "s double")
    assert [r[0] for r in levels.select(psi_level("s")).collect()] == ["none", "low", "medium", "high"]


def test_fallback_score(spark):
    df = spark.createDataFrame([(900.0, 850.0), (5000.0, 850.0), (0.0, 0.0), (100.0, None), (100.0, 0.0)], "a double, p double")
    got = [r[0] for r in df.select(fallback_score("a", "p")).collect()]
    assert got == pytest.approx([50 / 900, 0.83, 0.0, 0.0, 1.0])


def test_vote(spark):
    rows = [("a", 1.0, 1.0, 0.9, True, 0.9, True, 0.0, False), ("a", 1.0, 1.0, 0.9, True, 0.1, False, 0.2, False)]
    df = spark.createDataFrame(rows, "series string, actual double, predicted double, s1 double, f1 boolean, s2 double, f2 boolean, s3 double, f3 boolean")
    got = a.vote(df.withColumn("timestamp", F.lit("2022-01-01").cast("timestamp")), ("s1", "s2", "s3"), ("f1", "f2", "f3")).collect()
    assert [(r.is_anomaly, r.severity) for r in got] == [(True, "medium"), (False, "normal")]


def forest_frame(spark, n=600):
    rng = random.Random(0)
    rows = [("a", i, rng.gauss(0, 1), rng.gauss(5, 2)) for i in range(n)]
    rows[123] = ("a", 123, 30.0, -40.0)
    return spark.createDataFrame(rows, "series string, i long, x double, y double").withColumn("timestamp", F.timestamp_seconds(F.col("i") * 3600))


def test_forest_ranks_the_spike_first_and_ignores_partitioning(spark):
    df = forest_frame(spark)
    one = IsolationForest(["x", "y"], trees=40).fit(df)
    two = IsolationForest(["x", "y"], trees=40).fit(df.repartition(7))
    assert one.nodes.equals(two.nodes) and one.offset == pytest.approx(two.offset)
    rows = one.normalised(df).orderBy(F.desc("forest_score")).collect()
    assert rows[0].i == 123 and rows[0].forest_flag
    assert all(-1e-9 <= r.forest_score <= 1 for r in rows)
    assert sum(r.forest_flag for r in rows) == pytest.approx(30, abs=2)
    with pytest.raises(RuntimeError):
        IsolationForest(["x"]).score(df)


def test_forest_samples_are_whole_and_distinct(spark):
    picks = tree_samples(forest_frame(spark), ["x"], trees=5, sample=64).groupBy("tree").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("x").alias("d")).collect()
    assert [(r.n, r.d) for r in picks] == [(64, 64)] * 5
    tiny = tree_samples(forest_frame(spark, 200).limit(50), ["x"], trees=3, sample=64).groupBy("tree").count().collect()
    assert [r["count"] for r in tiny] == [50] * 3


def test_tree_samples_come_from_all_rows(spark):
    """On more rows than trees and samples could hold, trees share almost none."""
    n = 60_000
    rows = spark.range(n).selectExpr("'a' as series", "timestamp_seconds(id * 3600) as timestamp", "cast(id as double) as x")
    picks = tree_samples(rows, ["x"], trees=100, sample=256).selectExpr("tree", "x[0] as x").toPandas()
    assert len(picks) == 100 * 256 and (picks.groupby("tree").size() == 256).all() and not picks.duplicated().any()
    # 25,600 draws with replacement between trees hit n * (1 - exp(-25,600 / n)) rows
    assert picks["x"].nunique() == pytest.approx(n * (1 - np.exp(-25_600 / n)), rel=0.02)


def test_forest_save_and_load(spark, tmp_path):
    df = forest_frame(spark)
    model = IsolationForest(["x", "y"], trees=10).fit(df)
    model.save(spark, str(tmp_path / "f"))
    again = IsolationForest.load(spark, str(tmp_path / "f"))
    assert again.nodes.equals(model.nodes) and again.offset == model.offset


def brute_ks(x, y):
    return max(abs(sum(a <= v for a in x) / len(x) - sum(b <= v for b in y) / len(y)) for v in set(x) | set(y))


def test_drift_against_brute_force(spark):
    rng = random.Random(5)
    x, y = [rng.gauss(0, 1) for _ in range(300)], [rng.gauss(0.8, 1) for _ in range(200)]
    train = spark.createDataFrame([(v, 1.0, "t") for v in x], "v double, c double, name string")
    prod = spark.createDataFrame([(v, 1.0, "t") for v in y], "v double, c double, name string")
    got = {r.feature: r for r in drift.drift_report(train, prod).collect()}
    assert set(got) == {"v", "c"}
    assert got["v"].ks_statistic == pytest.approx(brute_ks(x, y)) and got["v"].is_drifted
    assert got["c"].psi == pytest.approx(0, abs=1e-6) and not got["c"].is_drifted and got["c"].drift_level == "none"
    assert got["v"].train_mean == pytest.approx(sum(x) / 300)


def test_few_values_are_skipped(spark):
    few = spark.createDataFrame([(float(i),) for i in range(9)], "v double")
    many = spark.createDataFrame([(float(i),) for i in range(50)], "v double")
    assert drift.drift_report(few, many).count() == 0


def test_default_date_range_reaches_the_scan(spark, tmp_path):
    df = series(spark, [float(i) for i in range(24 * 40)])
    path = str(tmp_path / "panel")
    df.write.parquet(path)
    stored = spark.read.parquet(path)
    out = monitor.date_range(stored, days=3)
    assert out.count() == 4 * 24 and out.agg(F.min("demand")).first()[0] == 36 * 24.0
    scan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in scan.split("PushedFilters:")[1].split("]")[0] and "Join" not in scan
    assert monitor.date_range(stored, start="2022-02-08").count() == 2 * 24
    assert monitor.date_range(df.where("false")).count() == 0
    assert monitor.date_range(spark.createDataFrame([("a", None, 1.0)], df.schema)).count() == 0
