"""Continuous versions of intake, scoring and monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewatch.functions.scalar import fallback_score, severity
from tidewatch.operators.chunks import chunk_window, chunked, own_rows, rolling
from tidewatch.operators.drift import _bin
from tidewatch.operators.joins import attach
from tidewatch.operators.quantiles import ranked, running_counts
from tidewatch.schemas import DRIFT_THRESHOLD, EPS, HOURLY, LATENCY_SLA_MS, RESIDUAL_MULTIPLIER, ROLLING_Z_WINDOW, ZSCORE_THRESHOLD, Panel
from tidewatch.session import materialise
from tidewatch.sources.payload import aligned
from tidewatch.sources.sinks import batch_writer, read_table


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, name: str = "*.parquet", per_trigger: int | None = None) -> DataFrame:
    """A Parquet file stream over one folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(folder)


def rollup(stream: DataFrame, panel: Panel = HOURLY, length: str = "1 hour", late: str = "2 hours", how=F.avg) -> DataFrame:
    """Aggregate per series and tumbling window; rows later than ``late`` are dropped."""
    return (
        stream.withWatermark(panel.ts, late)
        .groupBy(*panel.keys, F.window(panel.ts, length).alias("_w"))
        .agg(how(panel.value).alias(panel.value))
        .select(*panel.keys, F.col("_w.start").alias(panel.ts), panel.value)
    )


def deduplicate(stream: DataFrame, panel: Panel = HOURLY, late: str = "2 hours", extra=()) -> DataFrame:
    """The first row of each (series, timestamp) inside the watermark."""
    return stream.withWatermark(panel.ts, late).dropDuplicatesWithinWatermark([*panel.keys, panel.ts, *extra])


def score(requests: DataFrame, model, payload: str = "features") -> DataFrame:
    """Align each request's feature map to the model and predict; the same call serves batch and stream."""
    return model.predict(aligned(requests, model.features, payload))


def detect(requests: DataFrame, calibration: DataFrame | None = None, keys=("series",), k: float = RESIDUAL_MULTIPLIER, keep=()) -> DataFrame:
    """Anomaly check of actual against predicted.

    With stored calibration (a static frame of ``residual_std``) the residual
    rule decides, and ``method`` says so; a series without one, a request
    without a prediction, or a request for another method gets the fallback score.
    """
    rows = requests
    if calibration is not None:
        rows = rows.join(calibration.select(*keys, "residual_std"), list(keys), "left")
    else:
        rows = rows.withColumn("residual_std", F.lit(None).cast("double"))
    limit = F.lit(float(k)) * F.col("residual_std")
    size = F.abs(F.col("actual") - F.col("predicted"))
    usable = F.col("residual_std").isNotNull() & F.col("predicted").isNotNull()
    if "method" in rows.columns:
        usable = usable & F.col("method").isin("residual", "ensemble")
    plain = fallback_score("actual", "predicted")
    value = F.when(usable, F.least(size / (limit + EPS), F.lit(1.0))).otherwise(plain)
    flag = F.when(usable, size > limit).otherwise(plain > 0.3)
    rows = rows.withColumn("anomaly_score", value).withColumn("is_anomaly", flag)
    return rows.select(
        *keep, *keys, "timestamp", "actual", "predicted", "anomaly_score", "is_anomaly",
        severity("anomaly_score", "is_anomaly").alias("severity"),
        F.when(usable, "residual").otherwise("zscore_fallback").alias("method"),
    )


def online_zscore(
    stream: DataFrame, path: str, panel: Panel = HOURLY, late: str = "2 hours", threshold: float = ZSCORE_THRESHOLD,
    window: int = ROLLING_Z_WINDOW, fit_std: float = 1.0, mode: str = "update",
) -> DataFrame:
    """Rolling z-score over the last ``window`` values of each series, from a stream into the table under ``path``.

    Rows stand in order of time, then value (ties are all kept); ``seq`` is a row's place in its series. Each micro-batch is joined with the
    stored tail of the series (the rows still inside the watermark and the ``window - 1`` before them) and scored with the chunked row windows of
    the batch operator: ranks come from ranges of (series, time), frames from chunks of ranks, so that no task holds a series, in a batch of
    any size. A row inside the watermark may still change the scores after it. In ``update`` mode a batch writes each score from its first new
    row on, and the last one of a (series, ``seq``) counts; in ``append`` mode a row is written once, when the watermark has passed it. Nulls, and
    rows behind the watermark (the newest time of earlier batches less ``late``), are left out. A repeated batch starts from the
    tail before it and replaces what it wrote. The score is scaled by the threshold, as one row has no batch maximum.
    """
    if mode not in ("update", "append"):
        raise ValueError(f"Unknown output mode: {mode}")
    spark, keys, ts = stream.sparkSession, list(panel.keys), panel.ts
    kinds = T.StructType([*[stream.schema[k] for k in keys], stream.schema[ts]])
    tail = T.StructType([*kinds, T.StructField("_v", T.DoubleType()), T.StructField("seq", T.LongType())])
    out = T.StructType([*kinds, *[T.StructField(c, k) for c, k in (
        ("seq", T.LongType()), ("actual", T.DoubleType()), ("z", T.DoubleType()), ("anomaly_score", T.DoubleType()), ("is_anomaly", T.BooleanType()),
    )]])
    by_rank = panel.on(ts="_place", value="_v", full=True)
    late_us = spark.range(1).select(F.unix_micros(F.lit("1970-01-01").cast("timestamp") + F.expr(f"interval {late}"))).first()[0]

    def write(batch: DataFrame, number: int) -> None:
        held, mark = spark.createDataFrame([], tail), None
        if number:
            held = spark.read.schema(tail).parquet(f"{path}/tail/{number - 1}")
            mark = spark.read.parquet(f"{path}/mark/{number - 1}").first()[0]
        us = F.unix_micros(ts)
        new = batch.select(*keys, ts, F.col(panel.value).cast("double").alias("_v"), F.lit(None).cast("long").alias("seq")).where("_v is not null")
        new = new if mark is None else new.where(us >= mark)
        rows = materialise(ranked(held.unionByName(new), keys, [ts, "_v"], "_place"), "ranked")
        newest = rows.agg(F.max(us)).first()[0]
        open_from = mark if newest is None else max(newest - late_us, mark if mark is not None else newest - late_us)
        closed = us < F.lit(open_from)
        places = rows.groupBy(*keys).agg(
            F.coalesce(F.min("seq"), F.lit(0)).alias("_base"), F.min(F.when(F.col("seq").isNull(), F.col("_place"))).alias("_first"),
            F.count(F.when(closed, 1)).alias("_closed"), F.count(F.when(us < F.lit(mark), 1)).alias("_was_closed"),
        )
        places = materialise(places, "places")
        scored = own_rows(rolling(chunked(rows.drop("seq"), by_rank, window - 1), chunk_window(by_rank), "_v", [window], ["mean", "std"]))
        scored = attach(scored, places, keys, "_place")
        z = F.abs(F.col("_v") - F.col(f"_mean_{window}")) / (F.coalesce(F.col(f"_std_{window}"), F.lit(float(fit_std))) + F.lit(EPS))
        wanted = F.col("_place") >= F.col("_first") if mode == "update" else (F.col("_place") >= F.col("_was_closed")) & (F.col("_place") < F.col("_closed"))
        made = scored.where(wanted).withColumn("z", z).select(
            *keys, ts, (F.col("_base") + F.col("_place")).alias("seq"), F.col("_v").alias("actual"), "z",
            F.least(F.col("z") / F.lit(threshold + EPS), F.lit(1.0)).alias("anomaly_score"), (F.col("z") > threshold).alias("is_anomaly"),
        )
        made.write.mode("overwrite").parquet(f"{path}/table/_batch={number}")
        kept = attach(rows.drop("seq"), places, keys, "_place").where(F.col("_place") >= F.col("_closed") - (window - 1))
        kept.select(*keys, ts, "_v", (F.col("_base") + F.col("_place")).alias("seq")).write.mode("overwrite").parquet(f"{path}/tail/{number}")
        spark.createDataFrame([(open_from,)], "mark long").coalesce(1).write.mode("overwrite").parquet(f"{path}/mark/{number}")

    spark.createDataFrame([], out).write.mode("overwrite").parquet(f"{path}/table/_batch=-1")
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/progress")
    writer.trigger(availableNow=True).start().awaitTermination()
    return latest(spark, f"{path}/table", out, [*keys, "seq"])


def latency_counts(stream: DataFrame, ts: str = "created_at", column: str = "latency_ms", length: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows per tumbling window and distinct latency: state that is spread over tasks by value and merges by adding."""
    rows = stream.where(F.col(column).isNotNull()).withWatermark(ts, late)
    out = rows.groupBy(F.window(ts, length).alias("_w"), F.col(column).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("_w.start").alias("window_start"), "value", "n")


def latency_from_counts(counts: DataFrame, sla_ms: float = LATENCY_SLA_MS) -> DataFrame:
    """Latency summary per window from finished counts (batch side of the latency monitor); percentiles are exact.

    Ranks are running totals over ranges of (window, value), so that one window's values are many tasks' work.
    """
    v, n = F.col("value"), F.col("n")
    totals = materialise(counts.groupBy("window_start").agg(
        F.sum("n").alias("count"), (F.sum(v * n) / F.sum(n)).alias("mean_ms"), F.max(v).alias("max_ms"),
        (F.sum(F.when(v > sla_ms, n).otherwise(0)) * 100 / F.sum(n)).alias("sla_breach_pct"),
    ), "totals")
    rows = attach(running_counts(counts, ["window_start"], "value", ["n"]), totals.select("window_start", "count"), ["window_start"], "value")
    points = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
    picks = []
    for name, p in points.items():
        spot = F.lit(p) * (F.col("count") - 1)
        picks += [F.min(F.when(F.col("cum_n") > F.floor(spot), v)).alias(f"_lo_{name}"), F.min(F.when(F.col("cum_n") > F.ceil(spot), v)).alias(f"_hi_{name}")]
    found = rows.groupBy("window_start").agg(*picks).join(totals, "window_start")
    made = []
    for name, p in points.items():
        spot = F.lit(p) * (F.col("count") - 1)
        made.append((F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * (spot - F.floor(spot))).alias(name))
    return found.select("window_start", "count", "mean_ms", *made, "max_ms", "sla_breach_pct")


def drift_baseline(train: DataFrame, features, bins: int = 10, eps: float = EPS) -> DataFrame:
    """Per feature and bin: range and expected share, from training data (features x bins rows).

    Values outside the training range count in the end bins.
    """
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features]
    long = train.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*").where("value is not null")
    span = long.groupBy("feature").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.count("value").alias("_n"))
    # one row per feature, so its size is bounded by the schema; bins are counted before the shuffle
    rows = long.join(F.broadcast(span), "feature")
    counts = rows.groupBy("feature", _bin(F.col("value"), bins).alias("bin")).agg(F.count(F.lit(1)).alias("_t"))
    dense = span.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).join(counts, ["feature", "bin"], "left")
    share = F.coalesce("_t", F.lit(0)) / (F.col("_n") + F.lit(eps)) + F.lit(eps)
    return dense.select("feature", "bin", "_lo", "_hi", share.alias("expected"))


def drift_counts(stream: DataFrame, baseline: DataFrame, features, ts: str = "timestamp", length: str = "7 days", late: str = "1 hour", bins: int = 10) -> DataFrame:
    """Bin counts per window and feature, against the baseline's ranges (stream with static join)."""
    span = baseline.select("feature", "_lo", "_hi").distinct()
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features]
    long = stream.withWatermark(ts, late).select(ts, F.explode(F.array(*pairs)).alias("_p")).select(ts, "_p.*").where("value is not null")
    rows = long.join(span, "feature")
    inside = F.greatest(F.least(F.col("value"), F.col("_hi")), F.col("_lo"))
    return (
        rows.groupBy(F.window(ts, length).alias("_w"), "feature", _bin(inside, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n")).select(F.col("_w.start").alias("window_start"), "feature", "bin", "n")
    )


def drift_from_counts(counts: DataFrame, baseline: DataFrame, eps: float = EPS, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """PSI per window and feature from finished bin counts (batch side of the drift monitor)."""
    totals = counts.groupBy("window_start", "feature").agg(F.sum("n").alias("_total"))
    dense = totals.join(baseline.select("feature", "bin", "expected"), "feature")
    rows = dense.join(counts, ["window_start", "feature", "bin"], "left")
    actual = F.coalesce("n", F.lit(0)) / (F.col("_total") + F.lit(eps)) + F.lit(eps)
    out = rows.groupBy("window_start", "feature").agg(F.sum((actual - F.col("expected")) * F.log(actual / F.col("expected"))).alias("psi"))
    return out.withColumn("is_drifted", F.col("psi") > threshold)


def run_to_table(stream: DataFrame, path: str, mode: str = "append", keys=None) -> DataFrame:
    """Process everything available, write it as Parquet under ``path``, and read that back.

    Progress is kept beside the table, so a restart goes on where it stopped.
    With ``keys`` the stream runs in update mode: each micro-batch writes its
    changed rows to a folder of its own (a repeated batch overwrites it) and the
    last row of each key is read, windows still open at the end included.
    """
    spark, schema = stream.sparkSession, stream.schema
    table = f"{path}/table"
    if keys is None:
        writer = stream.writeStream.outputMode(mode).format("parquet").option("path", table)
    else:
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{table}/_batch=-1")  # a stream without rows has a table too
        writer = stream.writeStream.outputMode("update").foreachBatch(
            lambda rows, batch: rows.write.mode("overwrite").parquet(f"{table}/_batch={batch}")
        )
    writer.option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(table) if keys is None else latest(spark, table, schema, keys)


def latest(spark: SparkSession, table: str, schema: T.StructType, keys) -> DataFrame:
    """The last written row of each key, from a table with one folder per micro-batch."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("_batch", T.LongType())])).parquet(table)
    others = [c for c in schema.names if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "_batch").alias("_last"))
    return last.select(*[F.col(f"_last.{c}").alias(c) if c in others else F.col(c) for c in schema.names])


def run_to_stored(stream: DataFrame, table: str, root: str, name: str) -> DataFrame:
    """Process everything available into one of the result tables, and read that back.

    Each micro-batch is one commit of the table, named by the stream and its number: a repeated batch replaces itself, and other
    writers may append meanwhile.
    """
    writer = stream.writeStream.foreachBatch(batch_writer(table, root, name)).option("checkpointLocation", f"{root}/progress/{name}")
    writer.trigger(availableNow=True).start().awaitTermination()
    return read_table(stream.sparkSession, table, root)
