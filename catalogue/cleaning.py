"""Filling, outliers, range, scaling, splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import query
from catalogue.base import daily, grid, hourly, plain, r, split, sql, view
from tidewatch.functions.scalar import clip_range
from tidewatch.operators import clean as c
from tidewatch.operators.grid import regularise
from tidewatch.operators.split import assert_no_leak, cv_folds, split_overlap, temporal_split, train_val_union
from tidewatch.schemas import DAILY

SHOW = "SELECT series, timestamp, {v} AS demand FROM {t}"


@query("fill_linear", sql(SHOW.format(v=r("demand"), t="g"), "g"))
def fill_linear(spark, d):
    return plain(spark, d)


@query("fill_linear_sparse", sql(SHOW.format(v=r("demand"), t="ug"), "ug"))
def fill_linear_sparse(spark, d):
    return plain(spark, d, "user_id")


@query("fill_linear_daily", sql(SHOW.format(v=r("demand"), t="lg"), "lg"))
def fill_linear_daily(spark, d):
    return regularise(daily(spark, d), DAILY, "linear")


@query("fill_ffill", sql(SHOW.format(v=r("coalesce(pv, nv)"), t="ug_near"), "ug"))
def fill_ffill(spark, d):
    return regularise(hourly(spark, d, "user_id"), fill="ffill")


@query("fill_bfill", sql(SHOW.format(v=r("coalesce(nv, pv)"), t="ug_near"), "ug"))
def fill_bfill(spark, d):
    return regularise(hourly(spark, d, "user_id"), fill="bfill")


@query("fill_drop", sql(SHOW.format(v=r("demand"), t="g_near WHERE demand IS NOT NULL"), "g"))
def fill_drop(spark, d):
    return regularise(hourly(spark, d), fill="drop")


# ------------------------------------------------------------ outliers

view("q", """q AS (SELECT series, q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper
  FROM (SELECT series, quantile_cont(demand, 0.25) AS q1, quantile_cont(demand, 0.75) AS q3 FROM g GROUP BY 1))""", "g")
view("capped", """capped AS (SELECT series, timestamp, pos, n, demand < lower OR demand > upper AS is_outlier,
  CASE WHEN demand < lower THEN lower WHEN demand > upper THEN upper ELSE demand END AS demand FROM g JOIN q USING (series))""", "q")
Z = """{name} AS (SELECT series, timestamp, {flag} AS is_outlier,
  CASE WHEN abs(demand - m) / nullif(s, 0) > 3 THEN med ELSE demand END AS demand
  FROM {src} JOIN (SELECT series, avg(demand) AS m, stddev_pop(demand) AS s, median(demand) AS med FROM {src} GROUP BY 1) USING (series))"""
view("zed", Z.format(name="zed", src="g", flag="coalesce(abs(demand - m) / nullif(s, 0) > 3, false)"), "g")
view("treated", Z.format(name="treated", src="capped", flag="is_outlier OR coalesce(abs(demand - m) / nullif(s, 0) > 3, false)"), "capped")
view("cleaned", """cleaned AS (SELECT series, timestamp, pos, n, is_outlier, least(greatest(demand, 0), 10000) AS demand FROM capped)""", "capped")
FLAGGED = "SELECT series, timestamp, {v} AS demand, is_outlier FROM {t}"


@query("iqr_bounds", sql(f"SELECT series, {r('q1')} AS q1, {r('q3')} AS q3, {r('lower')} AS lower, {r('upper')} AS upper FROM q", "q"))
def iqr_bounds(spark, d):
    return c.fit_iqr_bounds(plain(spark, d))


@query("iqr_cap", sql(FLAGGED.format(v=r("demand"), t="capped"), "capped"))
def iqr_cap(spark, d):
    return c.treat_outliers(plain(spark, d), method="iqr")


@query("zscore_median", sql(FLAGGED.format(v=r("demand"), t="zed"), "zed"))
def zscore_median(spark, d):
    return c.treat_outliers(plain(spark, d), method="zscore")


@query("outliers_both", sql(FLAGGED.format(v=r("demand"), t="treated"), "treated"))
def outliers_both(spark, d):
    return c.treat_outliers(plain(spark, d), method="both")


@query("range_clip", sql(SHOW.format(v=r("least(greatest(demand - 100, 0), 150)"), t="g"), "g"))
def range_clip(spark, d):
    """Clip of shifted values, so that both ends are met."""
    return plain(spark, d).withColumn("demand", clip_range(F.col("demand") - 100, 0, 150))


@query("clean_series", sql(SHOW.format(v=r("demand"), t="cleaned"), "cleaned"))
def clean_series(spark, d):
    return c.clean(hourly(spark, d))


@query("clean_daily", sql(
    SHOW.format(v=r("least(greatest(CASE WHEN demand < q1 - 1.5 * (q3 - q1) THEN q1 - 1.5 * (q3 - q1) WHEN demand > q3 + 1.5 * (q3 - q1) THEN q3 + 1.5 * (q3 - q1) ELSE demand END, 0), 10000)"),
                t="lg JOIN (SELECT series, quantile_cont(demand, 0.25) AS q1, quantile_cont(demand, 0.75) AS q3 FROM lg GROUP BY 1) USING (series)"), "lg"))
def clean_daily(spark, d):
    return c.clean(daily(spark, d), DAILY)


@query("clean_with_fitted_bounds", sql(
    SHOW.format(v=r("least(greatest(CASE WHEN demand < lower THEN lower WHEN demand > upper THEN upper ELSE demand END, 0), 10000)"),
                t="""s JOIN (SELECT series, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM
  (SELECT series, quantile_cont(demand, 0.25) AS q1, quantile_cont(demand, 0.75) AS q3 FROM s WHERE split = 'train' GROUP BY 1)) USING (series)
  WHERE split = 'test'"""), "s"))
def clean_with_fitted_bounds(spark, d):
    """Test rows cleaned with fences fitted on the training rows."""
    parts = split(spark, d)
    bounds = c.fit_iqr_bounds(parts.where("split = 'train'"))
    return c.clean(parts.where("split = 'test'").drop("split"), bounds=bounds)


@query("clean_stats", sql(f"""SELECT series, count(*) AS n_rows, sum(is_outlier::INT)::BIGINT AS n_outliers, {r('avg(demand)')} AS demand_mean,
  {r('stddev_samp(demand)')} AS demand_std, {r('min(demand)')} AS demand_min, {r('max(demand)')} AS demand_max FROM cleaned GROUP BY 1""", "cleaned"))
def clean_stats(spark, d):
    return c.clean_stats(c.clean(hourly(spark, d), keep_flag=True))


# ------------------------------------------------------------ scaling

SCALERS = {
    "standard": ("avg(demand)", "stddev_pop(demand)"),
    "minmax": ("min(demand)", "max(demand) - min(demand)"),
    "robust": ("median(demand)", "quantile_cont(demand, 0.75) - quantile_cont(demand, 0.25)"),
}


def _register_scaler(method: str, centre: str, spread: str) -> None:
    text = f"""SELECT series, timestamp, {r('demand')} AS demand, {r('(demand - c) / CASE WHEN w = 0 THEN 1 ELSE w END')} AS scaled
FROM s JOIN (SELECT series, {centre} AS c, {spread} AS w FROM s WHERE split = 'train' GROUP BY 1) USING (series)"""

    @query(f"scale_{method}", sql(text, "s"))
    def scaled(spark, d):
        parts = split(spark, d)
        fitted = c.fit_scaler(parts.where("split = 'train'"), method=method)
        return c.scale(parts.drop("split"), fitted)


for _name, (_c, _w) in SCALERS.items():
    _register_scaler(_name, _c, _w)


@query("scale_roundtrip", sql(f"SELECT series, timestamp, {r('demand')} AS demand, {r('demand')} AS restored FROM g", "g"))
def scale_roundtrip(spark, d):
    g = plain(spark, d)
    fitted = c.fit_scaler(g, method="robust")
    return c.inverse_scale(c.scale(g, fitted), fitted).drop("scaled")


# ------------------------------------------------------------ splitting

@query("temporal_split", sql(f"SELECT series, timestamp, {r('demand')} AS demand, split FROM s", "s"))
def temporal(spark, d):
    return split(spark, d)


@query("temporal_split_irregular", sql(
    f"""SELECT series, timestamp, {r('demand')} AS demand, CASE WHEN pos < floor(n * 0.6::DOUBLE) THEN 'train' WHEN pos < floor(n * (0.6::DOUBLE + 0.2::DOUBLE)) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY timestamp) - 1 AS pos, count(*) OVER (PARTITION BY series) AS n FROM u)""", "u"))
def temporal_irregular(spark, d):
    """By rank, on rows with gaps."""
    return temporal_split(hourly(spark, d, "user_id"), train_ratio=0.6, val_ratio=0.2)


@query("split_overlap", sql("""SELECT series, timestamp, min(split) AS first_split, max(split) AS last_split FROM s
  GROUP BY 1, 2 HAVING min(split) <> max(split)""", "s"))
def overlap(spark, d):
    return split_overlap(split(spark, d))


@query("split_sizes", sql("SELECT series, split, count(*) AS n_rows, min(timestamp) AS first_at, max(timestamp) AS last_at FROM s GROUP BY 1, 2", "s"))
def split_sizes(spark, d):
    """Rows and span of each split, after the leak check."""
    parts = split(spark, d)
    assert_no_leak(*[parts.where(F.col("split") == name) for name in ("train", "val", "test")])
    return parts.groupBy("series", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("timestamp").alias("first_at"), F.max("timestamp").alias("last_at")
    )


@query("train_val_union", sql(f"SELECT series, timestamp, {r('demand')} AS demand, split FROM s WHERE split <> 'test'", "s"))
def union(spark, d):
    return train_val_union(split(spark, d))


view("folds", """folds AS (SELECT series, timestamp, demand, fold, CASE WHEN pos < st - 24 THEN 'train' ELSE 'val' END AS role
  FROM (SELECT *, n - (5 - fold) * floor(n / 6)::BIGINT AS st, floor(n / 6)::BIGINT AS sz FROM g CROSS JOIN (SELECT unnest(range(5)) AS fold))
  WHERE pos < st - 24 OR (pos >= st AND pos < st + sz))""", "g")


@query("cv_folds", sql(f"SELECT series, timestamp, {r('demand')} AS demand, fold::BIGINT AS fold, role FROM folds", "folds"))
def folds(spark, d):
    return cv_folds(grid(spark, d))
