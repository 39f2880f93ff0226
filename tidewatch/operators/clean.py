"""Cleaning: grid, filling, outliers, range; statistics and scalers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.functions.scalar import clip_range
from tidewatch.operators.grid import over_parts, parts, regularise
from tidewatch.operators.joins import attach
from tidewatch.operators.quantiles import exact_quantiles, with_quantiles
from tidewatch.schemas import HOURLY, IQR_MULTIPLIER, MAX_DEMAND, MIN_DEMAND, ZSCORE_THRESHOLD, Panel
from tidewatch.session import materialise

OUTLIER_METHODS = ("iqr", "zscore", "both")
QUARTILES = {"q1": 0.25, "q3": 0.75}


# ------------------------------------------------------------ outliers

def fit_iqr_bounds(df: DataFrame, panel: Panel = HOURLY, k: float = IQR_MULTIPLIER) -> DataFrame:
    """Quartile fences per series."""
    q = exact_quantiles(df, panel.keys, panel.value, QUARTILES)
    return q.select(*panel.keys, "q1", "q3", *_fences(k))


def _fences(k: float):
    spread = F.col("q3") - F.col("q1")
    return (F.col("q1") - k * spread).alias("lower"), (F.col("q3") + k * spread).alias("upper")


def cap_iqr(df: DataFrame, bounds: DataFrame, panel: Panel = HOURLY) -> DataFrame:
    """Values strictly outside the fences become the fence; adds ``is_outlier``."""
    return _capped(attach(df, bounds.select(*panel.keys, "lower", "upper"), panel.keys, panel.ts), panel)


def _capped(rows: DataFrame, panel: Panel) -> DataFrame:
    v = F.col(panel.value)
    low, high = F.col("lower"), F.col("upper")
    flagged = F.coalesce((v < low) | (v > high), F.lit(False))
    capped = F.when(v < low, low).when(v > high, high).otherwise(v)
    seen = F.col("is_outlier") | flagged if "is_outlier" in rows.columns else flagged
    return rows.withColumn("is_outlier", seen).withColumn(panel.value, capped).drop("lower", "upper")


def fit_zscore(df: DataFrame, panel: Panel = HOURLY) -> DataFrame:
    """Mean and population deviation (a null counts as 0) and the median, per series."""
    v = F.coalesce(F.col(panel.value), F.lit(0.0))
    moments = df.groupBy(*panel.keys).agg(F.avg(v).alias("z_mean"), F.stddev_pop(v).alias("z_std"))
    median = exact_quantiles(df, panel.keys, panel.value, {"z_median": 0.5})
    return moments.join(median, list(panel.keys), "left")


def replace_zscore(df: DataFrame, fitted: DataFrame, panel: Panel = HOURLY, threshold: float = ZSCORE_THRESHOLD) -> DataFrame:
    """Values more than ``threshold`` deviations off become the median; adds ``is_outlier``."""
    v = F.coalesce(F.col(panel.value), F.lit(0.0))
    rows = attach(df, fitted, panel.keys, panel.ts)
    z = F.try_divide(F.abs(v - F.col("z_mean")), F.col("z_std"))
    flagged = F.coalesce(z > threshold, F.lit(False))
    rows = rows.withColumn("_flag", flagged)
    seen = F.col("is_outlier") | F.col("_flag") if "is_outlier" in df.columns else F.col("_flag")
    return (
        rows.withColumn("is_outlier", seen)
        .withColumn(panel.value, F.when(F.col("_flag"), F.col("z_median")).otherwise(F.col(panel.value)))
        .drop("_flag", "z_mean", "z_std", "z_median")
    )


def treat_outliers(
    df: DataFrame, panel: Panel = HOURLY, method: str = "iqr", bounds: DataFrame | None = None,
    k: float = IQR_MULTIPLIER, threshold: float = ZSCORE_THRESHOLD,
) -> DataFrame:
    """Cap by quartile fences, replace by z-score, or both in that order; adds ``is_outlier``.

    Where each series stands whole, its fences are found there and not joined.
    """
    if method not in OUTLIER_METHODS:
        raise ValueError(f"Unknown outlier method: {method}")
    if method == "iqr" and bounds is None and panel.whole:
        fenced = with_quantiles(df, panel, (), panel.value, QUARTILES)
        return _capped(fenced.select(*df.columns, *_fences(k)), panel)
    if method in ("iqr", "both"):
        df = cap_iqr(df, fit_iqr_bounds(df, panel, k) if bounds is None else bounds, panel)
    if method in ("zscore", "both"):
        df = replace_zscore(df, fit_zscore(df, panel), panel, threshold)
    return df


# ------------------------------------------------------------ cleaning

def clean(
    df: DataFrame, panel: Panel = HOURLY, fill: str = "linear", method: str = "iqr",
    low: float = MIN_DEMAND, high: float = MAX_DEMAND, bounds: DataFrame | str = "self",
    on_duplicate: str = "raise", order_by: str | None = None, keep_flag: bool = False,
    with_position: bool = False, staged: bool = False,
) -> DataFrame:
    """Grid, filling, outlier treatment and range clip.

    ``bounds="self"`` takes the fences from this data even when transforming
    new data (the observed behaviour); pass a fitted frame to use stored ones.
    ``staged`` writes the filled grid once, as fences need passes of their own;
    where they need none, in series that fit into a chunk, it makes no difference.
    """
    if method == "iqr" and isinstance(bounds, str) and fill in ("linear", "ffill", "bfill"):
        def treated(rows, panel):
            rows = materialise(rows, "filled") if staged and not panel.whole else rows
            return treat_outliers(rows, panel, method).drop("_chunk", "_own")

        filled = parts(df, panel, fill, on_duplicate=on_duplicate, order_by=order_by, with_position=with_position)
        out = over_parts(filled, treated).withColumn(panel.value, clip_range(panel.value, low, high))
        return out if keep_flag else out.drop("is_outlier")
    filled = regularise(df, panel, fill, on_duplicate, order_by, with_position=with_position and fill != "drop")
    if staged:
        filled = materialise(filled, "filled")
    fences = None if isinstance(bounds, str) else bounds
    out = treat_outliers(filled, panel, method, fences)
    out = out.withColumn(panel.value, clip_range(panel.value, low, high))
    return out if keep_flag else out.drop("is_outlier")


def clean_stats(df: DataFrame, panel: Panel = HOURLY) -> DataFrame:
    """Rows, treated outliers and moments per series, from ``clean(keep_flag=True)``."""
    v = panel.value
    return df.groupBy(*panel.keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("is_outlier").cast("long")).alias("n_outliers"),
        F.avg(v).alias("demand_mean"), F.stddev_samp(v).alias("demand_std"),
        F.min(v).alias("demand_min"), F.max(v).alias("demand_max"),
    )


# ------------------------------------------------------------ scaling

def fit_scaler(df: DataFrame, panel: Panel = HOURLY, method: str = "standard") -> DataFrame:
    """Centre and spread per series: standard, minmax or robust. A zero spread is 1."""
    keys, v = list(panel.keys), panel.value
    if method == "standard":
        fitted = df.groupBy(*keys).agg(F.avg(v).alias("centre"), F.stddev_pop(v).alias("spread"))
    elif method == "minmax":
        fitted = df.groupBy(*keys).agg(F.min(v).alias("centre"), (F.max(v) - F.min(v)).alias("spread"))
    elif method == "robust":
        q = exact_quantiles(df, keys, v, {"q1": 0.25, "centre": 0.5, "q3": 0.75})
        fitted = q.select(*keys, "centre", (F.col("q3") - F.col("q1")).alias("spread"))
    else:
        raise ValueError(f"Unknown scaling method: {method}")
    return fitted.withColumn("spread", F.when(F.col("spread") == 0, F.lit(1.0)).otherwise(F.col("spread")))


def _fitted(state: DataFrame | None) -> DataFrame:
    if state is None:
        raise RuntimeError("no scaling state yet: fit the scaler before using it")
    return state


def scale(df: DataFrame, scaler: DataFrame | None, panel: Panel = HOURLY, column: str | None = None, to: str = "scaled") -> DataFrame:
    """(value - centre) / spread."""
    rows = attach(df, _fitted(scaler), panel.keys, panel.ts)
    return rows.withColumn(to, (F.col(column or panel.value) - F.col("centre")) / F.col("spread")).drop("centre", "spread")


def inverse_scale(df: DataFrame, scaler: DataFrame | None, panel: Panel = HOURLY, column: str = "scaled", to: str = "restored") -> DataFrame:
    """value * spread + centre."""
    rows = attach(df, _fitted(scaler), panel.keys, panel.ts)
    return rows.withColumn(to, F.col(column) * F.col("spread") + F.col("centre")).drop("centre", "spread")
