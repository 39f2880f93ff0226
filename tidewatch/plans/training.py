"""The whole training run: ingest, explore, clean, split, features, models, selection, detection, tables."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, functions as F

from tidewatch.operators import anomaly, explore
from tidewatch.operators.clean import clean, clean_stats, fit_scaler
from tidewatch.operators.features import build_features, feature_names
from tidewatch.operators.grid import missing_timestamps
from tidewatch.operators.iforest import IsolationForest
from tidewatch.operators.metrics import best_model, evaluate, rank_models
from tidewatch.operators.models import LinearForecaster, cross_validate, cv_results, random_forest
from tidewatch.operators.split import temporal_split
from tidewatch.schemas import HOURLY, Panel
from tidewatch.session import materialise
from tidewatch.sources import sinks


def default_models(panel: Panel = HOURLY) -> list:
    return [
        LinearForecaster("linear_regression", keys=panel.keys, spread=panel.ts),
        LinearForecaster("ridge", keys=panel.keys, spread=panel.ts),
        LinearForecaster("lasso", keys=panel.keys, spread=panel.ts),
        random_forest(),
    ]


def run(
    raw: DataFrame, out: str, panel: Panel = HOURLY, models: list | None = None, run_explore: bool = True,
    run_cv: bool = True, select_on: str = "test", forest: IsolationForest | None = None, version: str = "1.0.0",
    carry_history: bool = False,
) -> dict:
    """Train on ``raw`` and write every table under ``out``. Returns a small summary.

    Only results with a handful of rows come to the driver. Cleaned data and
    the feature matrix are written once and read by each later pass. A model
    that fails is recorded with its error and the run goes on. The best model
    (per run, over all series) is picked on the test split, as observed, or on
    ``select_on="val"``. Each split loses its look-back rows, as observed,
    unless ``carry_history``, which short panels need to have test rows.
    """
    started = time.time()
    spark = raw.sparkSession
    models = default_models(panel) if models is None else models
    keys = list(panel.keys)

    missing_timestamps(raw, panel).write.mode("overwrite").parquet(f"{out}/missing")
    if run_explore:
        explore.summary_stats(raw, panel).write.mode("overwrite").parquet(f"{out}/summary")

    cleaned = materialise(clean(raw, panel, keep_flag=True, with_position=True, staged=True), "clean")
    clean_stats(cleaned, panel).write.mode("overwrite").parquet(f"{out}/clean_stats")
    parts = temporal_split(cleaned.drop("is_outlier"), panel)
    sinks.save_fitted(fit_scaler(parts.where("split = 'train'"), panel), f"{out}/scaler")

    matrix = build_features(parts, panel.on(full=True), carry_history=carry_history)  # cleaning made the grid
    names = feature_names(matrix, panel)
    matrix = materialise(matrix.withColumn("target", F.col(panel.value)), "matrix")
    train, trainval = matrix.where("split = 'train'"), matrix.where("split in ('train', 'val')")
    test = matrix.where("split = 'test'")

    status, scored, metrics, folds = [], {}, [], []
    for model in models:
        try:
            if select_on == "val":
                judged = model.fit(train, names).predict(matrix.where("split = 'val'"))
                val_rmse = evaluate(judged, [], "target").first()["rmse"]
            else:
                val_rmse = None
            model.fit(trainval, names)
            predictions = model.predict(test).select(*keys, panel.ts, F.col("target").alias("actual"), "predicted")
            predictions = materialise(predictions, f"predictions-{model.name}")
            row = evaluate(predictions, [], prefix="test").withColumn("model", F.lit(model.name))
            metrics.append(row.withColumn("_select", F.lit(val_rmse) if val_rmse is not None else F.col("test_rmse")))
            scored[model.name] = (model, predictions)
            model.save(f"{out}/models/{model.name}")
            if run_cv:
                folds.append(cross_validate([model], train, names, panel))
            status.append((model.name, "ok", None))
        except Exception as error:  # noqa: BLE001 - one failing model must not end the run
            status.append((model.name, "failed", str(error)[:500]))

    if not metrics:
        raise RuntimeError(f"no model could be trained: {status}")
    table = metrics[0]
    for m in metrics[1:]:
        table = table.unionByName(m)
    table = materialise(table, "metrics")
    everything = Panel(keys=(), ts=panel.ts, value=panel.value, step=panel.step)
    best = best_model(table, everything, "_select").first()["best_model"]
    rank_models(table, everything, "_select").drop("_select").write.mode("overwrite").parquet(f"{out}/ranking")
    names_out = [f"test_{m}" for m in ("rmse", "mae", "mape", "r2", "smape")]
    sinks.save_results(table, f"{out}/evaluation", names_out)
    spark.createDataFrame(status, "model string, status string, error string").write.mode("overwrite").parquet(f"{out}/status")
    if folds:
        all_folds = folds[0]
        for f in folds[1:]:
            all_folds = all_folds.unionByName(f)
        cv_results(all_folds, panel).write.mode("overwrite").parquet(f"{out}/cv")

    # detectors are calibrated on the training split and run on the test split
    model, test_predictions = scored[best]
    fitted_on = model.predict(train).select(*keys, panel.ts, F.col("target").alias("actual"), "predicted")
    calibration = sinks.save_fitted(anomaly.fit_residuals(fitted_on, keys), f"{out}/detectors/residual")
    z_fit = sinks.save_fitted(anomaly.fit_rolling_z(train, panel), f"{out}/detectors/zscore")
    forest = forest or IsolationForest(names)
    forest.features = names
    forest.fit(train, panel)
    forest.save(spark, f"{out}/detectors/forest")
    rows = forest.normalised(test, panel)
    rows = anomaly.rolling_z(rows.join(test_predictions.drop("actual"), [*keys, panel.ts]), z_fit, panel)
    rows = rows.withColumnRenamed(panel.value, "actual")
    rows = anomaly.residual_scores(rows, calibration, keys, ts=panel.ts)
    results = anomaly.vote(rows, ("forest_score", "z_score", "residual_score"), ("forest_flag", "z_flag", "residual_flag"), keys, panel.ts)
    results = materialise(results, "anomalies")
    sinks.write_results(results, f"{out}/test_anomalies")
    sinks.append(results.withColumnRenamed("actual", "actual_demand").withColumnRenamed("predicted", "predicted_demand"), "anomalies", out)
    sinks.append(cleaned.withColumn("is_processed", F.lit(True)), "time_series_data", out)

    top = table.where(F.col("model") == best).first()
    elapsed = round(time.time() - started, 2)
    record = table.where(F.col("model") == best).select(
        F.col("model").alias("model_name"), F.lit(version).alias("model_version"),
        *[F.col(f"test_{m}").alias(m) for m in ("rmse", "mae", "mape", "r2")],
        F.lit(trainval.count()).alias("n_train_samples"), F.col("n_predictions").alias("n_test_samples"),
        F.lit(elapsed).alias("training_duration_s"), F.lit("best model of the run").alias("notes"),
    )
    sinks.append(record, "model_metrics", out)
    summary = {
        "status": "success", "best_model": best, "elapsed_seconds": elapsed,
        "n_models_trained": len(scored), "test_rmse": float(top["test_rmse"]), "artifacts_dir": out,
    }
    sinks.save_summary(spark, f"{out}/summary_json", **summary)
    return summary
