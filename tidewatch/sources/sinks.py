"""Writing result tables, metrics files, run summaries and fitted state."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewatch.schemas import ANOMALY_TABLE, METRICS_TABLE, PREDICTION_TABLE, SERIES_TABLE

TABLES = {
    "time_series_data": SERIES_TABLE, "predictions": PREDICTION_TABLE,
    "anomalies": ANOMALY_TABLE, "model_metrics": METRICS_TABLE,
}
# Column defaults of the tables.
DEFAULTS = {"model_version": "1.0.0", "is_processed": False, "severity": "normal"}
_DATED = {"time_series_data", "predictions", "anomalies"}


def conform(df: DataFrame, table: str) -> DataFrame:
    """A table's columns in order: cast, defaults filled, ``created_at`` set, extra columns dropped."""
    made = []
    for f in TABLES[table]:
        if f.name == "created_at":
            c = F.coalesce(F.col("created_at"), F.current_timestamp()) if "created_at" in df.columns else F.current_timestamp()
        elif f.name in df.columns:
            c = F.col(f.name)
            if f.name in DEFAULTS:
                c = F.coalesce(c, F.lit(DEFAULTS[f.name]))
        elif f.name in DEFAULTS:
            c = F.lit(DEFAULTS[f.name])
        elif not f.nullable:
            raise ValueError(f"{table} needs column {f.name}")
        else:
            c = F.lit(None)
        made.append(c.cast(f.dataType).alias(f.name))
    return df.select(*made)


def commit(df: DataFrame, table: str, root: str, name: str) -> None:
    """Write rows as the commit ``name`` of a table; a commit of that name is replaced.

    A commit is a folder of its own (``write=<name>``, by day inside for dated tables); readers see it once its entry is in the table's log, which
    is written last and in one step, so that no reader meets half a commit, and several writers, batch or stream, share one table. Rows are dealt by
    day, and Spark splits a busy day by its size.
    """
    spark, rows = df.sparkSession, conform(df, table)
    if table in _DATED:
        rows = rows.withColumn("date", F.to_date("timestamp")).hint("rebalance", "date")
        rows.write.mode("overwrite").partitionBy("date").parquet(f"{root}/{table}/write={name}")
    else:
        rows.write.mode("overwrite").parquet(f"{root}/{table}/write={name}")
    entry = spark.range(1).select(F.lit(name).alias("name"), F.current_timestamp().alias("committed_at"))
    entry.coalesce(1).write.mode("overwrite").parquet(f"{root}/{table}/_log/commits/commit={name}")


def append(df: DataFrame, table: str, root: str) -> None:
    """Append rows to a table, as a commit of its own."""
    commit(df, table, root, f"append-{uuid.uuid4().hex}")


def batch_writer(table: str, root: str, stream: str = "stream"):
    """A ``foreachBatch`` function: batch n of a stream is one commit, so a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        commit(batch, table, root, f"{stream}-{batch_id}")

    return write


def unique_series(df: DataFrame) -> DataFrame:
    """One row per (series, timestamp), as the series table demands."""
    return df.dropDuplicates(["series", "timestamp"])


def commits(spark: SparkSession, table: str, root: str) -> DataFrame:
    """A table's log: ``write`` and ``committed_at`` of each commit."""
    from tidewatch.sources.readers import _exists

    log = f"{root}/{table}/_log/commits"
    if not _exists(spark, log):
        return spark.createDataFrame([], "write string, committed_at timestamp")
    return spark.read.schema("name string, committed_at timestamp").parquet(log).select(F.col("name").alias("write"), "committed_at")


def read_table(spark: SparkSession, table: str, root: str) -> DataFrame:
    """All committed rows of a table; one never written to is empty.

    The series table keeps one row per (series, timestamp): that of the last commit.
    """
    from tidewatch.sources.readers import _exists

    schema = TABLES[table]
    log = commits(spark, table, root)
    if not _exists(spark, f"{root}/{table}"):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(T.StructType([*schema, T.StructField("write", T.StringType())])).parquet(f"{root}/{table}").join(log, "write")
    if table != "time_series_data":
        return rows.select(*schema.names)
    others = [c for c in schema.names if c not in ("series", "timestamp")]
    last = F.max_by(F.struct(*others), F.struct("committed_at", "write")).alias("_row")
    return rows.groupBy("series", "timestamp").agg(last).select("series", "timestamp", "_row.*").select(*schema.names)


def write_results(results: DataFrame, path: str, fmt: str = "csv") -> None:
    """Anomaly results: keys and the seven result columns."""
    if fmt == "csv":
        results.write.mode("overwrite").option("header", True).csv(path)
    else:
        results.write.mode("overwrite").parquet(path)


def metrics_json(metrics: DataFrame, names, count: str = "n_predictions", by=()) -> DataFrame:
    """One JSON text per group: {model: {metrics: {...}, n_predictions}}; one row per model goes in."""
    pairs = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n) for n in names]))
    entry = F.struct(F.col("model"), F.struct(pairs.alias("metrics"), F.col(count).alias("n_predictions")).alias("e"))
    entries = F.collect_list(entry)  # one per model
    return metrics.groupBy(*by).agg(F.to_json(F.map_from_entries(entries)).alias("value"))


def save_results(metrics: DataFrame, path: str, names) -> None:
    """The evaluation file: one JSON object over models (a handful of rows)."""
    metrics_json(metrics, names).select("value").coalesce(1).write.mode("overwrite").text(path)


def save_summary(spark: SparkSession, path: str, **fields) -> None:
    """The run summary: one JSON row."""
    cols = [(v if hasattr(v, "_jc") else F.lit(v)).alias(k) for k, v in fields.items()]
    spark.range(1).select(*cols).coalesce(1).write.mode("overwrite").json(path)


def save_fitted(state: DataFrame, path: str) -> DataFrame:
    """Store a fitted table and return it re-read: its size is then known, and Spark broadcasts it when small."""
    state.write.mode("overwrite").parquet(path)
    return state.sparkSession.read.parquet(path)


def load_fitted(spark: SparkSession, path: str) -> DataFrame:
    from tidewatch.sources.readers import _exists

    if not _exists(spark, path):
        raise FileNotFoundError(f"nothing stored at {path}")
    return spark.read.parquet(path)


def write_series(df: DataFrame, path: str, keys=("series",), ts: str = "timestamp", files: int | None = None) -> None:
    """Series in time order inside each file: ranges of (series, time), never one global sort task."""
    args = [*keys, ts]
    ranged = df.repartitionByRange(files, *args) if files else df.repartitionByRange(*args)
    ranged.sortWithinPartitions(*args).write.mode("overwrite").parquet(path)
