"""Base views of the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogue import rounded_sql
from tidewatch.operators.grid import deal, parts, regularise
from tidewatch.operators.metrics import seasonal_naive
from tidewatch.operators.split import temporal_split
from tidewatch.schemas import DAILY, HOURLY, Panel

GRID, DAILY_GRID = HOURLY.on(full=True), DAILY.on(full=True)  # what regularise fills has no gaps
DRIFT_DAY = "1998-06-01"
DRIFT_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark, d) -> DataFrame:
    e = table(spark, d, "events")
    return e.withColumn("ts", F.col("ts").cast("timestamp"))


def hourly(spark, d, key: str = "event_type") -> DataFrame:
    """Gappy hourly panel: sum of value per key and hour."""
    return (
        events(spark, d)
        .groupBy(F.col(key).cast("string").alias("series"), F.date_trunc("hour", "ts").alias("timestamp"))
        .agg(F.round(F.sum("value"), 2).alias("demand"))
    )


def grid(spark, d, key: str = "event_type") -> DataFrame:
    """The hourly panel on its regular grid, gaps filled linearly, with position."""
    return regularise(hourly(spark, d, key), HOURLY, "linear", with_position=True)


def plain(spark, d, key: str = "event_type") -> DataFrame:
    return grid(spark, d, key).drop("pos", "n")


def split(spark, d) -> DataFrame:
    return temporal_split(grid(spark, d))


def naive(spark, d) -> DataFrame:
    """Actual and seasonal-naive prediction on the grid."""
    return seasonal_naive(plain(spark, d), GRID)


def gappy(spark, d) -> DataFrame:
    """Hours of each user that have events, and no other row."""
    return regularise(hourly(spark, d, "user_id"), HOURLY, "drop")


def daily(spark, d) -> DataFrame:
    """Gappy daily panel: quantity shipped per supplier and day."""
    li = table(spark, d, "lineitem")
    return (
        li.groupBy(F.col("l_suppkey").cast("string").alias("series"), F.col("l_shipdate").cast("timestamp").alias("timestamp"))
        .agg(F.sum("l_quantity").alias("demand"))
    )


def daily_grid(spark, d) -> DataFrame:
    return regularise(daily(spark, d), DAILY, "linear", with_position=True)


def dealt_daily(spark, d, back: int) -> tuple[DataFrame, Panel]:
    """The daily grid with its rows dealt, ``back`` earlier ones with each chunk, and the panel that says so."""
    rows, panel, _ = deal(daily(spark, d), DAILY, "linear", back)
    return rows.drop("_whole"), panel


def daily_parts(spark, d) -> list[tuple[DataFrame, Panel]]:
    """The daily grid in parts: dealt rows of series that are whole in one chunk, and the rows of others."""
    return parts(daily(spark, d), DAILY, "linear")


def drift_sides(spark, d) -> tuple[DataFrame, DataFrame]:
    li = table(spark, d, "lineitem")
    day = F.lit(DRIFT_DAY).cast("timestamp_ntz")
    cols = [*DRIFT_FEATURES, "l_shipdate"]
    return li.where(F.col("l_shipdate") < day).select(*cols), li.where(F.col("l_shipdate") >= day).select(*cols)


# ------------------------------------------------------------------ SQL

r = rounded_sql


_FILL = """{name}_grid AS (
  SELECT series, unnest(generate_series(lo, hi, INTERVAL {step})) AS timestamp
  FROM (SELECT series, min(timestamp) AS lo, max(timestamp) AS hi FROM {src} GROUP BY series)),
{name}_near AS (
  SELECT series, timestamp, demand,
    last_value(CASE WHEN demand IS NOT NULL THEN timestamp END IGNORE NULLS) OVER back AS pt,
    last_value(demand IGNORE NULLS) OVER back AS pv,
    first_value(CASE WHEN demand IS NOT NULL THEN timestamp END IGNORE NULLS) OVER ahead AS nt,
    first_value(demand IGNORE NULLS) OVER ahead AS nv
  FROM {name}_grid LEFT JOIN {src} USING (series, timestamp)
  WINDOW back AS (PARTITION BY series ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         ahead AS (PARTITION BY series ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
{name} AS (
  SELECT series, timestamp,
    CASE WHEN demand IS NOT NULL THEN demand WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv
         ELSE pv + (nv - pv) / (epoch_us(nt) - epoch_us(pt)) * (epoch_us(timestamp) - epoch_us(pt)) END AS demand,
    row_number() OVER (PARTITION BY series ORDER BY timestamp) - 1 AS pos,
    count(*) OVER (PARTITION BY series) AS n
  FROM {name}_near)"""

VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "h": ("""h AS (SELECT event_type AS series, date_trunc('hour', ts) AS timestamp, round(sum(value), 2) AS demand
  FROM events GROUP BY 1, 2)""", ()),
    "u": ("""u AS (SELECT user_id::VARCHAR AS series, date_trunc('hour', ts) AS timestamp, round(sum(value), 2) AS demand
  FROM events GROUP BY 1, 2)""", ()),
    "ud": ("ud AS (SELECT * FROM u WHERE demand IS NOT NULL)", ("u",)),
    "l": ("""l AS (SELECT l_suppkey::VARCHAR AS series, l_shipdate AS timestamp, sum(l_quantity) AS demand
  FROM lineitem GROUP BY 1, 2)""", ()),
    "g": (_FILL.format(name="g", src="h", step="1 HOUR"), ("h",)),
    "ug": (_FILL.format(name="ug", src="u", step="1 HOUR"), ("u",)),
    "lg": (_FILL.format(name="lg", src="l", step="1 DAY"), ("l",)),
    "s": ("""s AS (SELECT series, timestamp, demand, pos, n,
    CASE WHEN pos < floor(n * 0.7::DOUBLE) THEN 'train' WHEN pos < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split
  FROM g)""", ("g",)),
    "p": ("""p AS (SELECT * FROM (SELECT series, timestamp, demand AS actual, lag(demand, 24) OVER (PARTITION BY series ORDER BY timestamp) AS predicted
  FROM g) WHERE predicted IS NOT NULL)""", ("g",)),
}


def sql(main: str, *views: str, extra: str = "") -> str:
    """``main`` after the CTEs of the named views and what they need."""
    order: list[str] = []

    def need(name: str) -> None:
        text, below = VIEWS[name]
        for b in below:
            need(b)
        if name not in order:
            order.append(name)

    for v in views:
        need(v)
    ctes = [VIEWS[v][0] for v in order] + ([extra] if extra else [])
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + main.strip()


def view(name: str, text: str, *below: str) -> str:
    """Define a further view."""
    VIEWS[name] = (text.strip(), below)
    return name
