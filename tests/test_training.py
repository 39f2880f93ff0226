from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from tests.frames import series, wave
from tidewatch.operators.iforest import IsolationForest
from tidewatch.operators.models import LinearForecaster, TreeForecaster
from tidewatch.plans.training import run


class Broken(TreeForecaster):
    def fit(self, df, features, target="target"):
        raise ValueError("cannot be trained")


def test_whole_run(spark, tmp_path):
    v = wave(1400)
    v[1350] = 5000.0
    raw = series(spark, v, gaps=[10, 11, 12]).unionByName(series(spark, wave(1400, seed=7), "b"))
    models = [LinearForecaster("ridge"), LinearForecaster("lasso"), Broken("broken", None)]
    out = str(tmp_path / "run")
    summary = run(raw, out, models=models, forest=IsolationForest([], trees=10))
    assert summary["status"] == "success" and summary["n_models_trained"] == 2 and summary["best_model"] in ("ridge", "lasso")
    status = {r.model: (r.status, r.error) for r in spark.read.parquet(f"{out}/status").collect()}
    assert status["ridge"] == ("ok", None) and status["broken"] == ("failed", "cannot be trained")
    found = spark.read.option("header", True).csv(f"{out}/test_anomalies")
    assert found.count() == 2 * (210 - 168)
    assert spark.read.parquet(f"{out}/missing").count() == 3
    assert spark.read.parquet(f"{out}/cv").count() == 4
    assert spark.read.parquet(f"{out}/anomalies").count() == 84
    assert spark.read.parquet(f"{out}/time_series_data").where("is_processed").count() == 2800
    row = spark.read.parquet(f"{out}/model_metrics").first()
    assert row.model_name == summary["best_model"] and row.n_train_samples == 2 * ((980 - 168) + (210 - 168))
    ranks = spark.read.parquet(f"{out}/ranking").orderBy("rank").select("model").collect()
    assert ranks[0].model == summary["best_model"]
    text = next(f for f in os.listdir(f"{out}/summary_json") if f.endswith(".json"))
    assert json.load(open(f"{out}/summary_json/{text}"))["best_model"] == summary["best_model"]
    assert spark.read.parquet(f"{out}/clean_stats").where(F.col("n_rows") == 1400).count() == 2
