from __future__ import annotations

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from tests.frames import at, series, wave
from tidewatch.operators import anomaly as a
from tidewatch.schemas import HOURLY
from tidewatch.streaming import jobs

SCHEMA = "series string, timestamp timestamp, demand double"


def feed(spark, folder, *batches):
    """One file per batch, read one file per trigger, oldest first."""
    import os
    import time

    for i, rows in enumerate(batches):
        part = f"{folder}/b{i}"
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(part)
        os.makedirs(f"{folder}/in", exist_ok=True)
        name = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        os.link(f"{part}/{name}", f"{folder}/in/{i}.parquet")
        os.utime(f"{folder}/in/{i}.parquet", (time.time() + i, time.time() + i))
    return jobs.file_stream(spark, f"{folder}/in", spark.createDataFrame([], SCHEMA).schema, per_trigger=1)


def test_late_rows_are_dropped(spark, tmp_path):
    first = [("a", at(i / 4), 1.0) for i in range(40)]
    later = [("a", at(10), 1.0)]  # Spark drops late rows by the mark of the batch before the last
    late = [("a", at(1), 99.0), ("a", at(9.9), 5.0), ("a", at(30), 1.0)]
    out = jobs.run_to_table(jobs.rollup(feed(spark, str(tmp_path), first, later, late)), str(tmp_path / "out"))
    got = {r.timestamp: r.demand for r in out.collect()}
    assert got[at(1)] == 1.0 and got[at(9)] == pytest.approx((4 + 5) / 5)
    assert max(got) < at(28)


def test_repeats_are_dropped(spark, tmp_path):
    rows = [("a", at(i), 1.0) for i in range(5)]
    out = jobs.run_to_table(jobs.deduplicate(feed(spark, str(tmp_path), rows, rows)), str(tmp_path / "out"))
    assert out.count() == 5


def test_open_windows_are_in_the_table(spark, tmp_path):
    rows = [("a", at(i / 4), float(i)) for i in range(40)]
    late = [("a", at(9.9), 5.0), ("b", at(9), 2.0)]
    out = jobs.run_to_table(jobs.rollup(feed(spark, str(tmp_path), rows, late)), str(tmp_path / "out"), keys=["series", "timestamp"])
    got = {(r.series, r.timestamp): r.demand for r in out.collect()}
    assert len(got) == 11 and got["b", at(9)] == 2.0
    assert got["a", at(0)] == 1.5 and got["a", at(9)] == pytest.approx((36 + 37 + 38 + 39 + 5) / 5)


def test_a_stream_without_rows_has_a_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = jobs.file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema)
    assert jobs.run_to_table(jobs.rollup(stream), str(tmp_path / "out"), keys=["series", "timestamp"]).count() == 0


def test_online_zscore_equals_batch(spark, tmp_path):
    v = wave(260)
    v[200] = 3000.0
    rows = [("a", at(i), x) for i, x in enumerate(v)]
    stream = feed(spark, str(tmp_path), rows[:100], rows[100:180], rows[180:])
    out = jobs.online_zscore(stream, str(tmp_path / "out"), HOURLY.on(chunk_rows=64)).orderBy("timestamp").collect()
    df = series(spark, v)
    batch = a.rolling_z(df, a.fit_rolling_z(df), HOURLY).orderBy("timestamp").collect()
    assert [r.z for r in out] == pytest.approx([r.z for r in batch], abs=1e-6)
    assert [r.is_anomaly for r in out] == [r.z_flag for r in batch] and out[200].is_anomaly
    assert [r.seq for r in out] == list(range(260))


def _plain_z(rows, window=168):
    """(time, value, z) of one series by a plain loop, in order of time and value."""
    rows, made = sorted(rows), []
    for i, (when, x) in enumerate(rows):
        frame = [b for _, b in rows[max(0, i - window + 1):i + 1]]
        std = statistics.stdev(frame) if len(frame) > 1 else 1.0
        made.append((when, x, abs(x - statistics.fmean(frame)) / (std + 1e-8)))
    return made


@pytest.mark.parametrize("mode", ["update", "append"])
def test_online_zscore_keeps_late_and_tied_rows(spark, tmp_path, mode):
    v = wave(240)
    first = [("a", at(i), x) for i, x in enumerate(v[:120]) if i not in (118, 119)]
    second = [("a", at(118), v[118]), ("a", at(117), 7.0), ("a", at(117), 7.0), ("a", at(117.5), 55.0), ("b", at(117), 3.0), ("a", at(118), None)]
    third = [("a", at(i), x) for i, x in enumerate(v[120:], 120)] + [("a", at(119), v[119]), ("a", at(119), 12.0)]
    out = jobs.online_zscore(feed(spark, str(tmp_path), first, second, third), str(tmp_path / "out"), mode=mode).collect()
    for name in ("a", "b"):
        want = _plain_z([(w, x) for s, w, x in first + second + third if s == name and x is not None])
        if mode == "append":
            want = [w for w in want if w[0] < at(237)]  # the newest two hours are still open
        got = sorted((r.timestamp, r.actual, r.seq, r.z) for r in out if r.series == name)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert [g[3] for g in got] == pytest.approx([w[2] for w in want], abs=1e-6)


def test_latency_windows_over_several_batches(spark, tmp_path):
    values = [[float(i * 37 % 101) for i in range(300)], [5.0] * 40 + [1000.0]]
    batches = [[("a", at(0.5), v) for v in vs] for vs in values]
    counts = jobs.latency_counts(feed(spark, str(tmp_path), *batches), "timestamp", "demand")
    counts = jobs.run_to_table(counts, str(tmp_path / "out"), keys=["window_start", "value"])
    row = jobs.latency_from_counts(counts, 100.0).first()
    x = sorted(sum(values, []))
    assert row["count"] == 341 and row.mean_ms == pytest.approx(statistics.fmean(x)) and row.max_ms == 1000.0
    for got, p in ((row.p50_ms, 0.5), (row.p95_ms, 0.95), (row.p99_ms, 0.99)):
        spot = p * (len(x) - 1)
        assert got == pytest.approx(x[int(spot)] + (x[min(int(spot) + 1, len(x) - 1)] - x[int(spot)]) * (spot % 1))
    assert row.sla_breach_pct == pytest.approx(sum(v > 100 for v in x) * 100 / len(x))


def test_stream_and_appends_share_a_table(spark, tmp_path):
    from tidewatch.sources import sinks

    root = str(tmp_path / "tables")
    stream = feed(spark, str(tmp_path), [("a", at(i), 1.0) for i in range(5)], [("a", at(i), 2.0) for i in range(3, 8)])
    rows = jobs.run_to_stored(stream, "time_series_data", root, "intake")
    got = {r.timestamp: r.demand for r in rows.collect()}
    assert len(got) == 8 and got[at(2)] == 1.0 and got[at(3)] == 2.0  # the last commit of a (series, timestamp)
    sinks.batch_writer("time_series_data", root, "intake")(series(spark, [7.0] * 5), 0)  # batch 0 once more
    sinks.append(series(spark, [9.0]), "time_series_data", root)
    got = {r.timestamp: r.demand for r in sinks.read_table(spark, "time_series_data", root).collect()}
    assert len(got) == 8 and got[at(0)] == 9.0 and got[at(1)] == 7.0
    assert sinks.commits(spark, "time_series_data", root).count() == 3


def test_rows_without_a_log_entry_are_not_read(spark, tmp_path):
    from tidewatch.sources import sinks

    root = str(tmp_path / "tables")
    sinks.append(series(spark, [1.0, 2.0]), "time_series_data", root)
    half = sinks.conform(series(spark, [5.0]), "time_series_data").withColumn("date", F.to_date("timestamp"))
    half.write.partitionBy("date").parquet(f"{root}/time_series_data/write=half")
    assert [r.demand for r in sinks.read_table(spark, "time_series_data", root).orderBy("timestamp").collect()] == [1.0, 2.0]


def test_detect_without_calibration(spark):
    df = spark.createDataFrame([("a", dt.datetime(2023, 1, 1), 900.0, 0.0), ("b", dt.datetime(2023, 1, 1), 100.0, None)],
                               "series string, timestamp timestamp, actual double, predicted double")
    got = {r.series: (r.is_anomaly, r.method) for r in jobs.detect(df).collect()}
    assert got == {"a": (True, "zscore_fallback"), "b": (False, "zscore_fallback")}
    fitted = spark.createDataFrame([("a", 1000.0)], "series string, residual_std double")
    got = {r.series: (r.is_anomaly, r.method) for r in jobs.detect(df, fitted).collect()}
    assert got == {"a": (False, "residual"), "b": (False, "zscore_fallback")}


def test_drift_of_the_training_data_is_none(spark):
    df = series(spark, wave(500))
    base = jobs.drift_baseline(df, ["demand"])
    same = base.selectExpr("timestamp'2024-01-01' as window_start", "feature", "bin", "cast(round(expected * 500) as bigint) as n")
    row = jobs.drift_from_counts(same, base).first()
    assert row.psi == pytest.approx(0, abs=1e-6) and not row.is_drifted
    assert base.agg(F.count(F.lit(1))).first()[0] == 10
