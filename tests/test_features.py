from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.frames import at, series, values, wave
from tidewatch.functions.scalar import calendar, is_holiday
from tidewatch.operators import features as f
from tidewatch.operators.grid import deal, regularise
from tidewatch.operators.split import temporal_split
from tidewatch.schemas import HOURLY

SMALL = HOURLY.on(chunk_rows=200)


def test_matrix_columns_and_rows(spark):
    out = f.build_features(series(spark, wave(400)), SMALL)
    assert out.count() == 400 - 168
    assert len(f.feature_names(out)) == 51


def test_each_split_loses_its_look_back(spark):
    parts = temporal_split(series(spark, wave(1200)), SMALL)
    counts = dict(f.build_features(parts, SMALL).groupBy("split").count().collect())
    assert counts == {"train": 840 - 168, "val": 180 - 168, "test": 180 - 168}
    carried = dict(f.build_features(parts, SMALL, carry_history=True).groupBy("split").count().collect())
    assert carried == {"train": 840 - 168, "val": 180, "test": 180}


def test_shorter_than_the_look_back_gives_no_rows(spark):
    assert f.build_features(series(spark, wave(100)), SMALL).count() == 0


def test_first_rolling_std_is_zero_and_mean_is_null(spark):
    row = f.rolling_features(series(spark, [5.0, 7.0, 9.0]), windows=(3,)).orderBy("timestamp").collect()
    assert [r.demand_roll_std_3h for r in row][:2] == [0.0, 0.0]
    assert [r.demand_roll_mean_3h for r in row] == [None, 5.0, 6.0]


def test_null_label_on_a_row_drops_it(spark):
    df = series(spark, wave(300)).withColumn("is_anomaly", F.when(F.hour("timestamp") != 5, F.lit(False)))
    out = f.build_features(df, SMALL)
    assert out.where("is_anomaly is null").count() == 0 and out.count() < 300 - 168
    assert "is_anomaly" not in f.feature_names(out)


def test_calendar_edges(spark):
    days = ["2024-02-29 23:00", "2024-12-31 00:00", "2022-01-01 12:00", "2021-01-03 07:00", "2023-07-04 21:00"]
    df = spark.createDataFrame([(dt.datetime.fromisoformat(d),) for d in days], "t timestamp")
    rows = df.select("t", *[c.alias(n) for n, c in calendar("t").items()], is_holiday("t").alias("h")).collect()
    assert [r.day_of_year for r in rows] == [60, 366, 1, 3, 185]
    assert [r.week_of_year for r in rows] == [9, 1, 52, 53, 27]
    assert [r.is_month_end for r in rows] == [1, 1, 0, 0, 0]
    assert [r.is_weekend for r in rows] == [0, 0, 1, 1, 0]
    assert [r.is_night for r in rows] == [1, 1, 0, 0, 0]
    assert [r.is_peak_hour for r in rows] == [0, 0, 0, 1, 1]
    assert [r.h for r in rows] == [0, 0, 1, 0, 1]


def test_text_columns_are_not_features(spark):
    df = series(spark, wave(5)).withColumn("note", F.lit("x")).withColumn("temperature", F.lit(1.0))
    assert f.feature_names(df) == ["temperature"]
    assert f.feature_names(df, drop_cols=["temperature"]) == []


def test_sequences(spark):
    pairs = f.sequence_pairs(series(spark, [float(i) for i in range(10)]), HOURLY.on(chunk_rows=4), 4).orderBy("timestamp").collect()
    assert len(pairs) == 6
    assert pairs[0].sequence == [0, 1, 2, 3] and pairs[0].next_value == 4 and pairs[0].timestamp == at(4)


@pytest.mark.parametrize("chunk", [168, 5000])
def test_chunking_does_not_change_the_matrix(spark, chunk):
    df = series(spark, wave(600)).unionByName(series(spark, wave(450, seed=1), "b"))
    cols = ["demand_lag_168h", "demand_roll_mean_168h", "demand_roll_std_24h", "demand_roll_min_48h"]
    a = f.build_features(df, HOURLY.on(chunk_rows=chunk))
    b = f.build_features(df, HOURLY)
    for c in cols:
        assert values(a, c) == pytest.approx(values(b, c))


@pytest.mark.parametrize("chunk", [16, 64, 512])
def test_row_windows_on_gaps_equal_plain_windows(spark, chunk):
    from pyspark.sql import Window

    from tidewatch.operators import anomaly, metrics

    panel, w = HOURLY.on(chunk_rows=chunk), Window.partitionBy("series").orderBy("timestamp")
    df = series(spark, wave(1500), gaps=[i for i in range(1500) if i * i % 11 > 3]).cache()
    n = df.count()
    lags = (1, 24, 48)
    plain = df.select("*", *[F.lag("demand", k).over(w).alias(f"demand_lag_{k}h") for k in lags])
    ours = f.lag_features(df, panel, lags)
    assert ours.count() == n and ours.exceptAll(plain).isEmpty()
    means = f.rolling_features(df, panel, (30,), ("mean",)).join(df.select("timestamp", F.avg("demand").over(w.rowsBetween(-30, -1)).alias("want")), "timestamp")
    assert means.where("abs(demand_roll_mean_30h - want) > 1e-9 or (want is null) != (demand_roll_mean_30h is null)").isEmpty()
    assert f.sequence_pairs(df, panel, 24).count() == n - 24
    assert metrics.seasonal_naive(df, panel, 24).count() == n - 24
    x, m, s = F.col("demand"), F.avg("demand").over(w.rowsBetween(-39, 0)), F.stddev_samp("demand").over(w.rowsBetween(-39, 0))
    want = df.select("timestamp", F.coalesce(F.abs((x - m) / (s + 1e-8)), F.lit(0.0)).alias("want"))
    z = anomaly.rolling_z(df, anomaly.fit_rolling_z(df), panel, window=40).join(want, "timestamp")
    assert z.count() == n and z.where("abs(z - want) > 1e-6").isEmpty()


def test_dealt_feature_matrix_equals_the_windowed_one(spark):
    """The same matrix; above the exploded gaps nothing is shuffled or sorted."""
    df = series(spark, wave(400), gaps=range(50, 90)).unionByName(series(spark, [None, 5.0, 6.0], "b"))
    rows, dealt, _ = deal(df, HOURLY.on(chunk_rows=16), back=30)
    how = dict(lags=(1, 24, 30), windows=(3, 24))
    ours = f.build_features(rows.drop("_whole"), dealt, **how)
    plain = f.build_features(regularise(df, fill="linear"), HOURLY.on(full=True), **how)
    assert ours.dtypes == plain.dtypes
    plan = ours._jdf.queryExecution().executedPlan().toString().split("Generate")[0]
    assert "MapInArrow" in plan and "Exchange" not in plan and "Sort" not in plan
    ours, plain = (x.orderBy("series", "timestamp").toPandas() for x in (ours, plain))
    assert ours["timestamp"].tolist() == plain["timestamp"].tolist() and len(ours) == 370
    for c in plain.columns[2:]:
        assert ours[c].to_numpy(float) == pytest.approx(plain[c].to_numpy(float), rel=1e-12), c
