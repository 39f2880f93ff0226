"""Exploration tables: the numbers behind each exploratory figure."""

from __future__ import annotations


import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidewatch.functions.scalar import day_name, month_name, normal_quantile
from tidewatch.operators.arrays import add_arrays, runs
from tidewatch.operators.chunks import chunk_window, chunked, own_rows, rolling, stands, streamed, undealt
from tidewatch.operators.grid import bucket_us, resample
from tidewatch.operators.joins import attach
from tidewatch.operators.quantiles import exact_quantiles, running_counts, with_quantiles
from tidewatch.operators.split import tail, with_position
from tidewatch.schemas import HOURLY, Panel
from tidewatch.session import materialise

# Weekday names, Monday first.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
Z95 = 1.959963984540054  # 97.5 % point of the standard normal


def summary_stats(df: DataFrame, panel: Panel = HOURLY) -> DataFrame:
    """Count, span, moments, median, bias-corrected skewness and excess kurtosis, share missing.

    The share missing is over all rows (the original drops nulls first and
    always reports 0).
    """
    keys = list(panel.keys)
    df = df.withColumn(panel.value, F.nanvl(F.col(panel.value), F.lit(None)))
    v, n = F.col(panel.value), F.count(panel.value)
    skew = F.skewness(v) * F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2)
    kurt = F.try_divide((n - 1).cast("double"), F.when(n > 3, (n - 2) * (n - 3)).cast("double")) * ((n + 1) * F.kurtosis(v) + 6)
    stats = df.groupBy(*keys).agg(
        n.alias("n_observations"), F.min(panel.ts).alias("start_date"), F.max(panel.ts).alias("end_date"),
        F.round(F.avg(v), 2).alias("mean"), F.round(F.stddev_samp(v), 2).alias("std"),
        F.round(F.min(v), 2).alias("min"), F.round(F.max(v), 2).alias("max"),
        F.round(skew, 4).alias("skewness"), F.round(kurt, 4).alias("kurtosis"),
        F.round(F.avg(v.isNull().cast("double")) * 100, 3).alias("pct_missing"),
    )
    median = exact_quantiles(df, keys, panel.value, {"median": 0.5})
    return stats.join(median.withColumn("median", F.round("median", 2)), keys, "left")


def daily_range(df: DataFrame, panel: Panel = HOURLY) -> DataFrame:
    v = F.col(panel.value)
    return resample(df, panel, "day", {"day_min": F.min(v), "day_max": F.max(v), "day_mean": F.avg(v)})


def hour_weekday_pivot(df: DataFrame, panel: Panel = HOURLY, alphabetic: bool = False) -> DataFrame:
    """Mean by hour (rows) and weekday (columns, Monday first or alphabetic)."""
    names = sorted(WEEKDAYS) if alphabetic else list(WEEKDAYS)
    rows = df.select(*panel.keys, F.hour(panel.ts).alias("hour"), day_name(panel.ts).alias("_day"), panel.value)
    return rows.groupBy(*panel.keys, "hour").pivot("_day", names).agg(F.avg(panel.value))


def weekday_profile(df: DataFrame, panel: Panel = HOURLY) -> DataFrame:
    """Mean by weekday (0 = Monday) and hour."""
    return df.groupBy(*panel.keys, F.weekday(panel.ts).alias("day_of_week"), F.hour(panel.ts).alias("hour")).agg(
        F.avg(panel.value).alias("mean_demand")
    )


def box_stats(df: DataFrame, panel: Panel = HOURLY, by=()) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 IQR) and the count of outliers."""
    keys, v = [*panel.keys, *by], F.col(panel.value)
    df = df.where(v.isNotNull())
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    if panel.whole:
        rows = with_quantiles(df.select(*keys, "_chunk", panel.value), panel, by, panel.value, probs)
    else:
        rows = attach(df.select(*keys, panel.ts, panel.value), exact_quantiles(df, keys, panel.value, probs), keys, panel.ts)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - reach, F.col("q3") + reach
    out = rows.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(v >= low, v)).alias("_lo"), F.max(F.when(v <= high, v)).alias("_hi"),
        F.sum(((v < low) | (v > high)).cast("long")).alias("n_outliers"), F.count(v).alias("n"),
    )
    return out.select(
        *keys, "q1", "median", "q3", F.least("_lo", "q1").alias("whisker_low"),
        F.greatest("_hi", "q3").alias("whisker_high"), "n_outliers", "n",
    )


def monthly_box(df: DataFrame, panel: Panel = HOURLY) -> DataFrame:
    """Box statistics per calendar month; absent months are absent."""
    boxes = box_stats(df.withColumn("month", F.month(panel.ts)), panel, ("month",))
    name = month_name(F.make_date(F.lit(2000), F.col("month"), F.lit(1)))
    return boxes.select(*panel.keys, "month", name.alias("month_name"), *boxes.columns[len(panel.keys) + 1:])


def _span(df: DataFrame, panel: Panel) -> DataFrame:
    v = panel.value
    return df.groupBy(*panel.keys).agg(F.min(v).alias("_min"), F.max(v).alias("_max"), F.count(v).alias("_n"), F.stddev_samp(v).alias("_std"))


def histogram(df: DataFrame, panel: Panel = HOURLY, bins: int = 80) -> DataFrame:
    """Counts in equal-width bins from minimum to maximum, the last bin closed; empty bins are 0."""
    keys, v = list(panel.keys), F.col(panel.value)
    flat = F.col("_min") == F.col("_max")
    span = _span(df, panel).where("_n > 0").select(
        *keys, F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("_lo"),
        F.when(flat, F.col("_max") + 0.5).otherwise(F.col("_max")).alias("_hi"),
    )
    width = (F.col("_hi") - F.col("_lo")) / bins
    rows = attach(df.where(v.isNotNull()), span, keys, panel.value)
    index = F.least(F.floor((v - F.col("_lo")) / width), F.lit(bins - 1)).cast("int")
    counts = rows.groupBy(*keys, index.alias("bin")).agg(F.count(F.lit(1)).alias("_count"))
    dense = span.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return dense.join(counts, [*keys, "bin"], "left").select(
        *keys, "bin", (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_end"), F.coalesce("_count", F.lit(0)).alias("count"),
    )


def kde(df: DataFrame, panel: Panel = HOURLY, points: int = 200) -> DataFrame:
    """Gaussian kernel density (Scott bandwidth) on a grid from minimum to maximum: the direct sum over all values.

    Equal values of a series are counted before the shuffle and weigh as often as they occur. Each task adds its values' kernels to one
    array of points per series as they stream by; only those arrays are shuffled then.
    """
    keys, v = list(panel.keys), panel.value
    span = _span(df, panel).where("_n > 1 and _std > 0")
    span = materialise(span.withColumn("_h", F.col("_std") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))), "spans")
    counted = df.where(F.col(v).isNotNull()).groupBy(*keys, v).agg(F.count(F.lit(1)).alias("_copies"))
    rows = attach(counted, span, keys, v).where("_h is not null")
    rows = rows.select(*keys, *[F.col(c).cast("double").alias(c) for c in (v, "_copies", "_min", "_max", "_h")])
    rows = rows.sortWithinPartitions(*keys) if keys else rows
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField("_sum", T.ArrayType(T.DoubleType()))])
    sums = add_arrays(rows.mapInArrow(_kernel_sums(keys, v, points), schema), keys, "_sum")
    made = attach(sums, span, keys, keys).select(*keys, "_min", "_max", "_h", "_n", F.posexplode("_sum").alias("point", "_mass"))
    x = F.col("_min") + (F.col("_max") - F.col("_min")) / (points - 1) * F.col("point")
    return made.select(*keys, "point", x.alias("x"), (F.col("_mass") / (F.col("_n") * F.col("_h") * (2 * np.pi) ** 0.5)).alias("density"))


def _kernel_sums(keys: list[str], value: str, points: int, block: int = 1024):
    """For sorted keys: each key's sums of copies x kernel at its points, one array a key and task."""

    def run(batches):
        now, total, like = None, None, None

        def emit():
            made = [*(pa.array([k], like.field(i).type) for i, k in enumerate(now)), pa.array([total.tolist()])]
            return pa.RecordBatch.from_arrays(made, names=[*keys, "_sum"])

        for b in batches:
            like = b.schema
            v, copies, lo, hi, h = (b.column(c).to_numpy(zero_copy_only=False) for c in (value, "_copies", "_min", "_max", "_h"))
            for key, start, end in runs(b, keys):
                if total is None or key != now:
                    if total is not None:
                        yield emit()
                    now, total = key, np.zeros(points)
                grid = lo[start] + (hi[start] - lo[start]) / (points - 1) * np.arange(points)
                for i in range(start, end, block):
                    j = min(i + block, end)
                    z = (grid[None, :] - v[i:j, None]) / h[start]
                    total += copies[i:j] @ np.exp(-0.5 * z * z)
        if total is not None:
            yield emit()

    return run


def qq_points(df: DataFrame, panel: Panel = HOURLY, block: int = 4096) -> DataFrame:
    """Normal quantile (Filliben position) of every ordered value.

    Ranks run over distinct values, then spread to the copies of a value in
    blocks, so one value with very many copies is many tasks' work.
    """
    keys, v = list(panel.keys), panel.value
    distinct = df.where(F.col(v).isNotNull()).groupBy(*keys, v).agg(F.count(F.lit(1)).alias("copies"))
    size = df.groupBy(*keys).agg(F.count(v).alias("_n"))
    ranks = attach(running_counts(distinct, keys, v, ["copies"]), size, keys, v)
    first, last = F.col("before_copies") + 1, F.col("cum_copies")
    blocks = ranks.withColumn("_from", F.explode(F.sequence(first, last, F.lit(block)))).repartition(*[F.col(k) for k in keys], v, "_from")
    rank = F.explode(F.sequence("_from", F.least(F.col("_from") + (block - 1), last)))
    points = blocks.select(*keys, F.col(v).alias("ordered"), "_n", rank.alias("rank"))
    n, i = F.col("_n"), F.col("rank")
    edge = F.pow(F.lit(0.5), 1 / n)
    place = F.when(i == n, edge).when(i == 1, 1 - edge).otherwise((i - 0.3175) / (n + 0.365))
    return points.select(*keys, "rank", normal_quantile(place).alias("theoretical"), "ordered")


def qq_fit(df: DataFrame, panel: Panel = HOURLY) -> DataFrame:
    """Least-squares line through the Q-Q points, and its R squared."""
    x, y = F.col("theoretical"), F.col("ordered")
    return qq_points(df, panel).groupBy(*panel.keys).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2")
    )


# ------------------------------------------------------------ rolling views

def _full(width: int, stat: str) -> Column:
    return F.when(F.col(f"_count_{width}") == width, F.col(f"_{stat}_{width}"))


def rolling_overview(df: DataFrame, panel: Panel = HOURLY, width: int = 168) -> DataFrame:
    """Mean of the last ``width`` rows with this one, null until there are as many."""
    rows = rolling(chunked(df, panel, width - 1), chunk_window(panel), panel.value, [width], ["mean", "count"])
    rows = rows.withColumn(f"rolling_mean_{width}", _full(width, "mean"))
    return own_rows(rows).drop(f"_mean_{width}", f"_count_{width}")


def rolling_buckets(df: DataFrame, panel: Panel = HOURLY, unit: str = "6 hours", widths=(168, 720)) -> DataFrame:
    """Rolling mean (and std for the first width) over 6-hour means, counted in buckets.

    The widths are numbers of 6-hour buckets, as computed originally (there
    labelled 7 and 30 days). Empty buckets are skipped, so the windows run by
    rank, not by time. Rows dealt with enough look-back have no empty buckets and
    stay where they are.
    """
    made = [_full(w, "mean").alias(f"rolling_mean_{w}") for w in widths] + [_full(widths[0], "std").alias(f"rolling_std_{widths[0]}")]
    length = bucket_us(panel, unit)
    if length and stands(panel, max(widths) * -(-length // panel.step_us)):
        rows = streamed(resample(df, panel, unit), panel, widths, ["mean", "std", "count"])
        return rows.where(F.col(panel.value).isNotNull()).select(*panel.keys, panel.ts, panel.value, *made)
    df, panel = undealt(df, panel)
    buckets = resample(df, panel, unit).where(F.col(panel.value).isNotNull())
    ranked = with_position(buckets, panel).drop("n")
    by_rank = panel.on(ts="pos", full=True)
    rows = rolling(chunked(ranked, by_rank, max(widths) - 1), chunk_window(by_rank), panel.value, widths, ["mean", "std", "count"])
    return rows.where("_own").select(*panel.keys, panel.ts, panel.value, *made)


# ------------------------------------------------------------ autocorrelation

def _acf_table(df: DataFrame, panel: Panel, lags: int, sample: int | None) -> DataFrame:
    keys = list(panel.keys)
    valued = df.where(F.col(panel.value).isNotNull())
    rows = tail(valued, panel, sample) if sample else with_position(valued, panel)
    means = rows.groupBy(*keys).agg(F.avg(panel.value).alias("_mean"))
    rows = attach(rows, means, keys, panel.ts).select(*keys, "pos", (F.col(panel.value) - F.col("_mean")).alias("_d"))
    by_rank = panel.on(ts="pos", full=True)
    w = chunk_window(by_rank)
    rows = chunked(rows, by_rank, lags).select("*", *[F.lag("_d", k).over(w).alias(f"_l{k}") for k in range(1, lags + 1)])
    rows = own_rows(rows)
    products = [F.sum(F.col("_d") * F.col("_d" if k == 0 else f"_l{k}")).alias(f"_p{k}") for k in range(lags + 1)]
    sums = rows.groupBy(*keys).agg(F.count("_d").alias("n"), *products)
    ratios = [F.try_divide(F.coalesce(F.col(f"_p{k}"), F.lit(0.0)), F.col("_p0")) for k in range(lags + 1)]
    return sums.where(F.col("n") > lags).select(*keys, "n", F.array(*ratios).alias("acf"))


def acf(df: DataFrame, panel: Panel = HOURLY, lags: int = 72, sample: int | None = None) -> DataFrame:
    """Biased autocorrelation of all values of a series, or of its last ``sample``, with 95 % Bartlett bounds."""
    keys = list(panel.keys)
    long = _acf_table(df, panel, lags, sample).select(*keys, "n", F.posexplode("acf").alias("lag", "acf"))
    before = Window.partitionBy(*keys).orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    square = F.when(F.col("lag") > 0, F.col("acf") * F.col("acf"))
    spread = (1 + 2 * F.coalesce(F.sum(square).over(before), F.lit(0.0))) / F.col("n")
    half = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(F.sqrt(spread) * Z95)
    return long.select(*keys, "lag", "acf", (F.col("acf") - half).alias("lower"), (F.col("acf") + half).alias("upper"))


def _durbin(r: np.ndarray) -> list[float]:
    out, phi, error = [1.0], np.zeros(0), 1.0
    for k in range(1, len(r)):
        if error <= 0:
            out.append(float("nan"))
            continue
        last = (r[k] - phi @ r[k - 1:0:-1]) / error
        phi = np.append(phi - last * phi[::-1], last)
        error *= 1 - last * last
        out.append(float(last))
    return out


def pacf(df: DataFrame, panel: Panel = HOURLY, lags: int = 72, sample: int | None = None) -> DataFrame:
    """Partial autocorrelation (Yule-Walker on the biased autocorrelation), with 95 % bounds."""

    @F.pandas_udf("array<double>")
    def partial(r: pd.Series) -> pd.Series:
        return r.map(lambda a: _durbin(np.asarray(a, dtype=float)))

    table = _acf_table(df, panel, lags, sample).where("acf[0] is not null")
    long = table.select(*panel.keys, "n", F.posexplode(partial("acf")).alias("lag", "pacf"))
    half = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(F.lit(Z95) / F.sqrt("n"))
    return long.select(*panel.keys, "lag", "pacf", (F.col("pacf") - half).alias("lower"), (F.col("pacf") + half).alias("upper"))


# ------------------------------------------------------------ decomposition

def seasonal_decompose(df: DataFrame, panel: Panel = HOURLY, period: int = 168) -> DataFrame:
    """Additive trend, seasonal and residual parts on a gap-free grid.

    Trend is the centred 2 x period mean, continued at both ends by the line
    through the nearest ``period`` trend values. Series shorter than two
    periods give no rows.
    """
    keys, half = list(panel.keys), period // 2
    rows = with_position(df, panel).where(F.col("n") >= 2 * period)
    by_rank = panel.on(ts="pos", full=True)
    w = chunk_window(by_rank)
    # the trailing sum of `period` rows, read half a period ahead, is the centred sum
    wide = rolling(chunked(rows, by_rank, half, half), w, panel.value, [period], ["sum"])
    if period % 2 == 0:
        centre = (F.lead(f"_sum_{period}", half - 1).over(w) + F.lead(f"_sum_{period}", half).over(w)) / (2 * period)
    else:
        centre = F.lead(f"_sum_{period}", half).over(w) / period
    inside = F.col("pos").between(half, F.col("n") - 1 - half)
    wide = wide.withColumn("_t", F.when(inside, centre))
    rows = own_rows(wide).drop(f"_sum_{period}")

    last = F.col("n") - 1 - half
    near_front = F.col("pos").between(half, F.least(F.lit(half + period), last) - 1)
    near_back = F.col("pos").between(F.greatest(F.lit(half), last - period), last - 1)
    fit = lambda where: (F.when(where, F.col("_t")), F.when(where, F.col("pos").cast("double")))
    (fy, fx), (by, bx) = fit(near_front), fit(near_back)
    ends = rows.where(near_front | near_back).groupBy(*keys).agg(
        F.regr_slope(fy, fx).alias("_fs"), F.regr_intercept(fy, fx).alias("_fi"),
        F.regr_slope(by, bx).alias("_bs"), F.regr_intercept(by, bx).alias("_bi"),
    )
    rows = attach(rows, ends, keys, panel.ts)
    trend = (
        F.when(F.col("pos") < half, F.col("_fs") * F.col("pos") + F.col("_fi"))
        .when(F.col("pos") > last, F.col("_bs") * F.col("pos") + F.col("_bi"))
        .otherwise(F.col("_t"))
    )
    rows = rows.withColumn("trend", trend).withColumn("_phase", F.pmod("pos", F.lit(period)))
    phases = rows.groupBy(*keys, "_phase").agg(F.avg(F.col(panel.value) - F.col("trend")).alias("_s"))
    phases = phases.withColumn("seasonal", F.col("_s") - F.avg("_s").over(Window.partitionBy(*keys))).drop("_s")
    rows = attach(rows, phases, [*keys, "_phase"], panel.ts)
    return rows.select(
        *keys, panel.ts, F.col(panel.value).alias("observed"), "trend", "seasonal",
        (F.col(panel.value) - F.col("trend") - F.col("seasonal")).alias("residual"),
    )
