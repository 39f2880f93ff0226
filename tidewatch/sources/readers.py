"""Reading series, result and metrics files into frames."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewatch.operators.grid import regularise, resample
from tidewatch.schemas import HOURLY, METRICS_FILE, Panel

REQUIRED = ("timestamp", "demand")


def check_columns(df: DataFrame, required, name: str = "DataFrame") -> None:
    """ValueError when a required column is absent."""
    absent = sorted(set(required) - set(df.columns))
    if absent:
        raise ValueError(f"columns absent from {name}: {absent}")


def enforce_schema(df: DataFrame, panel: Panel = HOURLY, name: str = "the series") -> DataFrame:
    """Required columns present, time parsed (bad time raises), value numeric (bad value is null).

    Time without a zone is UTC. Rows are not sorted: order is given to each
    window that needs it, and to files on write.
    """
    check_columns(df, (panel.ts, panel.value), name)
    ts = F.col(panel.ts)
    ts = ts.cast("timestamp") if not isinstance(df.schema[panel.ts].dataType, T.StringType) else F.to_timestamp(ts)
    value = F.col(panel.value)
    if isinstance(df.schema[panel.value].dataType, T.StringType):
        value = F.trim(value)
    value = F.nanvl(value.try_cast("double"), F.lit(None))
    made = {panel.ts: ts, panel.value: value}
    return df.select(*[made[c].alias(c) if c in made else F.col(c) for c in df.columns])


def read_csv(spark: SparkSession, path: str, panel: Panel = HOURLY) -> DataFrame:
    """CSV with a header. Further columns of numbers or truth values come typed, so that they can be features.

    Key, time and value are read as text and typed later; a further column with anything else in it stays text. Types are those
    Spark finds in all rows of the file, which costs one more pass over it.
    """
    found = spark.read.option("header", True).option("inferSchema", True).csv(path).schema
    plain = (T.NumericType, T.BooleanType)
    later = {*panel.keys, panel.ts, panel.value}
    typed = [f if f.name not in later and isinstance(f.dataType, plain) else T.StructField(f.name, T.StringType()) for f in found]
    return spark.read.option("header", True).schema(T.StructType(typed)).csv(path)


def unpivot_wide(df: DataFrame, time_column: str, panel: Panel = HOURLY, per_hour: float = 4.0, decimal_comma: bool = True) -> DataFrame:
    """Wide consumer columns to (series, hour, mean x 4), every consumer kept; empty hours are null rows."""
    consumers = [c for c in df.columns if c != time_column]
    pairs = F.array(*[F.struct(F.lit(c).alias("series"), F.col(f"`{c}`").cast("string").alias("v")) for c in consumers])
    long = df.select(F.col(time_column).cast("timestamp").alias(panel.ts), F.explode(pairs).alias("_p"))
    text = F.translate("_p.v", ",", ".") if decimal_comma else F.col("_p.v")
    long = long.select(F.col("_p.series").alias("series"), panel.ts, text.cast("double").alias(panel.value))
    hourly = resample(long, panel.on(keys=("series",)), "hour", {panel.value: F.avg(panel.value) * per_hour})
    return regularise(hourly, panel.on(keys=("series",)))


def read_wide(spark: SparkSession, path: str, panel: Panel = HOURLY) -> DataFrame:
    """Semicolon-separated load profile: blank first header, one decimal-comma column per consumer."""
    raw = spark.read.option("header", True).option("sep", ";").csv(path)
    return unpivot_wide(raw, raw.columns[0], panel)


def load(spark: SparkSession, path: str, panel: Panel = HOURLY) -> DataFrame:
    """A series file by suffix: .csv, .txt / .tsv (wide), .parquet. A single series gets the key of its file."""
    suffix = os.path.splitext(path)[1].lower()
    if suffix == ".csv":
        df = read_csv(spark, path, panel)
    elif suffix in (".txt", ".tsv"):
        df = read_wide(spark, path, panel)
    elif suffix == ".parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"no reader for files ending in {suffix!r}")
    check_columns(df, (panel.ts, panel.value), "the series")
    if "series" in panel.keys and "series" not in df.columns:
        name = os.path.splitext(os.path.basename(path))[0]
        df = df.withColumn("series", F.lit(name))
    return enforce_schema(df, panel)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def load_anomalies(spark: SparkSession, path: str) -> DataFrame | None:
    """The anomaly result file (Parquet or CSV), or None when there is none."""
    if not _exists(spark, path):
        return None
    if path.endswith(".csv"):
        raw = spark.read.option("header", True).csv(path)
        kinds = {"timestamp": "timestamp", "actual": "double", "predicted": "double", "anomaly_score": "double", "is_anomaly": "boolean"}
        return raw.select(*[F.col(c).cast(kinds.get(c, "string")).alias(c) for c in raw.columns])
    return spark.read.parquet(path)


def load_metrics(spark: SparkSession, path: str) -> DataFrame | None:
    """The metrics file as (Model, RMSE, MAE, MAPE), or None when there is none."""
    if not _exists(spark, path):
        return None
    return flatten_metrics(spark.read.text(path, wholetext=True), "value")


def flatten_metrics(df: DataFrame, column: str, by=()) -> DataFrame:
    """One row per model from a JSON map; an absent metric is 0."""
    parsed = F.from_json(column, METRICS_FILE)
    rows = df.select(*by, F.explode(parsed).alias("Model", "_m"))
    metric = lambda name: F.coalesce(F.try_element_at(F.col("_m.metrics"), F.lit(name)), F.lit(0.0))
    return rows.select(*by, "Model", metric("test_rmse").alias("RMSE"), metric("test_mae").alias("MAE"), metric("test_mape").alias("MAPE"))
