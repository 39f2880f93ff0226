"""Scans, schema, resampling, grid and gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import query
from catalogue.base import events, hourly, r, sql, view, daily
from tidewatch.operators.grid import gap_islands, missing_timestamps, regularise, resample
from tidewatch.schemas import DAILY, HOURLY
from tidewatch.session import new_path
from tidewatch.sources import readers, sinks

RAW = HOURLY.on(ts="ts", value="value", keys=("event_type",))


@query("resample_hourly", f"SELECT event_type, date_trunc('hour', ts) AS ts, {r('avg(value)')} AS value FROM events GROUP BY 1, 2")
def resample_hourly(spark, d):
    return resample(events(spark, d), RAW, "hour")


@query("resample_hourly_grid", sql(
    f"SELECT series, timestamp, {r('demand')} AS demand FROM m_grid LEFT JOIN m USING (series, timestamp)",
    extra="""m AS (SELECT user_id::VARCHAR AS series, date_trunc('hour', ts) AS timestamp, avg(value) AS demand FROM events GROUP BY 1, 2),
m_grid AS (SELECT series, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS timestamp
  FROM (SELECT series, min(timestamp) AS lo, max(timestamp) AS hi FROM m GROUP BY 1))"""))
def resample_hourly_grid(spark, d):
    """Hourly mean per user; empty hours stay as null rows."""
    raw = events(spark, d).select(F.col("user_id").cast("string").alias("series"), F.col("ts").alias("timestamp"), F.col("value").alias("demand"))
    return regularise(resample(raw, HOURLY, "hour"))


@query("resample_daily", f"""SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS ts, {r('min(value)')} AS day_min, {r('max(value)')} AS day_max,
  {r('avg(value)')} AS day_mean FROM events GROUP BY 1, 2""")
def resample_daily(spark, d):
    from tidewatch.operators.explore import daily_range

    return daily_range(events(spark, d), RAW)


@query("resample_6h", f"SELECT event_type, time_bucket(INTERVAL 6 HOURS, ts) AS ts, {r('avg(value)')} AS value FROM events GROUP BY 1, 2")
def resample_6h(spark, d):
    return resample(events(spark, d), RAW, "6 hours")


@query("enforce_schema", f"""SELECT event_type AS series, ts AS timestamp,
  {r("CASE WHEN event_type = 'error' THEN NULL ELSE value END")} AS demand FROM events""")
def enforce_schema(spark, d):
    """Time and value arrive as text; values that are not numbers become null."""
    text = events(spark, d).select(
        F.col("event_type").alias("series"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")).alias("demand"),
    )
    return readers.enforce_schema(text)


view("quarter", """quarter AS (SELECT event_type AS series, time_bucket(INTERVAL 15 MINUTES, ts) AS timestamp, round(sum(value), 2) AS v
  FROM events GROUP BY 1, 2)""")
_WIDE = sql(
    f"""SELECT series, timestamp, {r('m * 4')} AS demand
FROM (SELECT DISTINCT series FROM quarter) CROSS JOIN
     (SELECT unnest(generate_series(min(date_trunc('hour', timestamp)), max(date_trunc('hour', timestamp)), INTERVAL 1 HOUR)) AS timestamp FROM quarter)
LEFT JOIN (SELECT series, date_trunc('hour', timestamp) AS timestamp, avg(v) AS m FROM quarter GROUP BY 1, 2) USING (series, timestamp)""",
    "quarter")
KINDS = ["click", "error", "purchase", "signup", "view"]


def _wide(spark, d):
    """15-minute sums, one decimal-comma text column per event type."""
    e = events(spark, d).withColumn("at", F.window("ts", "15 minutes")["start"])
    wide = e.groupBy("at").pivot("event_type", KINDS).agg(F.round(F.sum("value"), 2))
    return wide.select(F.col("at").alias("_c0"), *[F.translate(F.col(c).cast("string"), ".", ",").alias(c) for c in KINDS])


@query("unpivot_wide", _WIDE)
def unpivot_wide(spark, d):
    return readers.unpivot_wide(_wide(spark, d), "_c0")


@query("scan_wide", _WIDE)
def scan_wide(spark, d):
    """The same through a semicolon-separated file with a blank first header."""
    path = new_path(spark, "wide") + ".txt"
    text = _wide(spark, d).withColumn("_c0", F.date_format("_c0", "yyyy-MM-dd HH:mm:ss")).withColumnRenamed("_c0", " ")
    text.write.option("header", True).option("sep", ";").csv(path)
    return readers.load(spark, path)


_HOURLY = sql(f"SELECT series, timestamp, {r('demand')} AS demand FROM h", "h")


@query("scan_csv", _HOURLY)
def scan_csv(spark, d):
    path = new_path(spark, "series") + ".csv"
    hourly(spark, d).write.option("header", True).csv(path)
    return readers.load(spark, path)


@query("scan_parquet", _HOURLY)
def scan_parquet(spark, d):
    path = new_path(spark, "series") + ".parquet"
    sinks.write_series(hourly(spark, d), path)
    return readers.load(spark, path)


@query("regular_grid", sql(f"SELECT series, timestamp, {r('demand')} AS demand FROM g_grid LEFT JOIN h USING (series, timestamp)", "g"))
def regular_grid(spark, d):
    return regularise(hourly(spark, d))


@query("regular_grid_daily", sql(f"SELECT series, timestamp, {r('demand')} AS demand FROM lg_grid LEFT JOIN l USING (series, timestamp)", "lg"))
def regular_grid_daily(spark, d):
    return regularise(daily(spark, d), DAILY)


@query("missing_timestamps", sql("SELECT series, timestamp FROM g_grid ANTI JOIN h USING (series, timestamp)", "g"))
def missing(spark, d):
    return missing_timestamps(hourly(spark, d))


@query("missing_timestamps_sparse", sql("SELECT series, timestamp FROM ug_grid ANTI JOIN u USING (series, timestamp)", "ug"))
def missing_sparse(spark, d):
    return missing_timestamps(hourly(spark, d, "user_id"))


_ISLANDS = """SELECT series, min(timestamp) AS gap_start, max(timestamp) AS gap_end, count(*) AS n_missing
FROM (SELECT series, timestamp, timestamp - row_number() OVER (PARTITION BY series ORDER BY timestamp) * INTERVAL {step} AS island
      FROM {g}_grid ANTI JOIN {h} USING (series, timestamp)) GROUP BY series, island"""


@query("gap_islands", sql(_ISLANDS.format(step="1 HOUR", g="g", h="h"), "g"))
def islands(spark, d):
    return gap_islands(hourly(spark, d))


@query("gap_islands_daily", sql(_ISLANDS.format(step="1 DAY", g="lg", h="l"), "lg"))
def islands_daily(spark, d):
    return gap_islands(daily(spark, d), DAILY)
