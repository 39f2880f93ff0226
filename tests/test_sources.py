from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.frames import at, series, values, wave
from tidewatch.functions.scalar import now_text, parse_iso
from tidewatch.operators import monitor
from tidewatch.sources import payload, readers, sinks


def test_unknown_suffix_and_missing_column(spark, tmp_path):
    with pytest.raises(ValueError):
        readers.load(spark, str(tmp_path / "x.json"))
    with pytest.raises(ValueError):
        readers.enforce_schema(spark.createDataFrame([(1,)], "demand int"))


def test_csv_with_bad_numbers(spark, tmp_path):
    path = tmp_path / "one.csv"
    path.write_text("timestamp,demand,temperature\n2022-01-01 00:00:00,1.5,3\n2022-01-01 01:00:00,oops,4\n")
    rows = readers.load(spark, str(path)).orderBy("timestamp").collect()
    assert [(r.timestamp, r.demand, r.series) for r in rows] == [(at(0), 1.5, "one"), (at(1), None, "one")]


def test_further_numbers_are_typed_and_become_features(spark, tmp_path):
    from tidewatch.operators.features import feature_names

    path = tmp_path / "three.csv"
    path.write_text("timestamp,demand,temperature,open,note\n2022-01-01 00:00:00,1.5,3.5,true,x\n2022-01-01 01:00:00,2,,false,7\n")
    df = readers.load(spark, str(path))
    assert dict(df.dtypes)["temperature"] == "double" and dict(df.dtypes)["open"] == "boolean" and dict(df.dtypes)["note"] == "string"
    assert feature_names(df) == ["temperature", "open"] and [r.temperature for r in df.orderBy("timestamp").collect()] == [3.5, None]


def test_bad_time_raises(spark, tmp_path):
    path = tmp_path / "two.csv"
    path.write_text("timestamp,demand\nyesterday,1.5\n")
    with pytest.raises(Exception):
        readers.load(spark, str(path)).collect()


def test_wide_file(spark, tmp_path):
    path = tmp_path / "wide.txt"
    lines = ['"";"MT_001";"MT_002"']
    for i, (a, b) in enumerate([("1,0", "2,5"), ("2,0", "2,5"), ("3,0", "2,5"), ("6,0", "2,5")]):
        lines.append(f'"2022-01-01 00:{15 * i:02d}:00";{a};{b}')
    lines.append('"2022-01-01 02:00:00";5,25;0,0')
    path.write_text("\n".join(lines) + "\n")
    rows = readers.load(spark, str(path)).orderBy("series", "timestamp").collect()
    assert [(r.series, r.demand) for r in rows] == [("MT_001", 12), ("MT_001", None), ("MT_001", 21), ("MT_002", 10), ("MT_002", None), ("MT_002", 0)]


def test_absent_files_are_none(spark, tmp_path):
    assert readers.load_anomalies(spark, str(tmp_path / "no.csv")) is None
    assert readers.load_metrics(spark, str(tmp_path / "no.json")) is None
    with pytest.raises(FileNotFoundError):
        sinks.load_fitted(spark, str(tmp_path / "no"))
    assert sinks.read_table(spark, "predictions", str(tmp_path)).count() == 0


def test_metrics_file_with_absent_key(spark, tmp_path):
    path = tmp_path / "metrics.json"
    path.write_text('{"ridge": {"metrics": {"test_rmse": 2.0}, "n_predictions": 5},\n "lasso": {"n_predictions": 1}}')
    got = {r.Model: (r.RMSE, r.MAE, r.MAPE) for r in readers.load_metrics(spark, str(path)).collect()}
    assert got == {"ridge": (2.0, 0.0, 0.0), "lasso": (0.0, 0.0, 0.0)}


def test_tables(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = series(spark, [1.0, 2.0]).withColumnRenamed("demand", "predicted_demand").withColumn("request_id", F.lit("r")).withColumn("model_name", F.lit("m"))
    sinks.append(rows, "predictions", root)
    sinks.append(rows, "predictions", root)
    got = sinks.read_table(spark, "predictions", root)
    assert got.count() == 4 and got.where("created_at is null or model_version <> '1.0.0'").count() == 0
    with pytest.raises(ValueError):
        sinks.append(rows.drop("request_id"), "predictions", root)
    write = sinks.batch_writer("anomalies", root)
    flagged = rows.selectExpr("series", "timestamp", "1d as actual_demand", "0.5d as anomaly_score", "true as is_anomaly", "'zscore' as method")
    write(flagged, 7)
    write(flagged, 7)  # a repeated batch
    assert spark.read.parquet(f"{root}/anomalies").count() == 2


def test_iso_times(spark):
    texts = ["2023-06-15T14:00:00", "2023-06-15T14:00:00Z", "2023-06-15T16:00:00+02:00", "2023-06-15", "not a time", "2023-13-40T00:00:00", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_iso("t").cast("string")).collect()]
    assert got == ["2023-06-15 14:00:00"] * 3 + ["2023-06-15 00:00:00", None, None, None]
    assert spark.range(1).select(now_text()).first()[0].endswith("Z")


def test_payloads(spark):
    bodies = [
        '{"timestamp": "2023-06-15T14:00:00", "features": {"hour": 14, "x": 1.5}}', '{"timestamp": "nope", "features": {}}',
        '{"timestamp": "2023-06-15T14:00:00"}', "garbage",
    ]
    rows = payload.decode_predict(spark.createDataFrame([(b,) for b in bodies], "body string"))
    good, bad = payload.split_valid(rows)
    assert good.count() == 1 and bad.count() == 3
    r = payload.aligned(good, ["hour", "lag"]).first()
    assert (r.hour, r.lag, r.n_filled) == (14.0, 0.0, 1)
    asks = ['{"timestamp": "2023-06-15T14:00:00", "actual_demand": 900, "predicted_demand": 850}', '{"timestamp": "2023-06-15T14:00:00", "actual_demand": -100}']
    got = payload.decode_anomaly(spark.createDataFrame([(b,) for b in asks], "body string")).select("reject_reason", "method").collect()
    assert [tuple(r) for r in got] == [(None, "ensemble"), ("actual_demand", "ensemble")]


def test_latency_and_history(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 2001)], "created_at long, latency_ms double")
    got = monitor.latency_summary(df, sla_ms=1500.0).first()
    assert (got["count"], got.p50_ms, got.max_ms, got.sla_breach_pct) == (1000, 1500.5, 2000, 50)
    assert monitor.latency_summary(df.where("created_at < 0")).count() == 0
    assert [r.created_at for r in monitor.recent_predictions(df, 5, ("created_at",)).collect()] == [2000, 1999, 1998, 1997, 1996]


def test_fingerprint_and_narrowing(spark):
    df = series(spark, wave(50))
    assert monitor.fingerprint(df).first() == monitor.fingerprint(df.repartition(5).orderBy(F.desc("demand"))).first()
    assert monitor.fingerprint(df).first() != monitor.fingerprint(df.limit(49)).first()
    wide = spark.createDataFrame([(1, 40000, 2**40, 1.5), (-128, 0, 0, 2.5)], "a long, b long, c long, d double")
    assert [t for _, t in monitor.narrow_types(wide).dtypes] == ["tinyint", "int", "bigint", "float"]


def test_sorted_series_files(spark, tmp_path):
    path = str(tmp_path / "s")
    sinks.write_series(series(spark, wave(100)), path, files=3)
    assert values(spark.read.parquet(path)) == wave(100)
