"""Temporal split, expanding folds, set checks. All are filters on position."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.operators.chunks import positions
from tidewatch.schemas import CV_GAP, CV_SPLITS, HOURLY, TRAIN_RATIO, VAL_RATIO, Panel


def with_position(df: DataFrame, panel: Panel = HOURLY) -> DataFrame:
    """``pos`` and ``n`` per series, unless the frame has them already."""
    return df if {"pos", "n"} <= set(df.columns) else positions(df, panel)


def temporal_split(
    df: DataFrame, panel: Panel = HOURLY, train_ratio: float | None = None, val_ratio: float | None = None,
) -> DataFrame:
    """Adds ``split``: train, val, test in time order per series; later rows never come before earlier ones.

    Cut points are floor(n * ratio) in double arithmetic. Only ``None`` means
    the default ratio, so a ratio of 0 is honoured.
    """
    train = TRAIN_RATIO if train_ratio is None else train_ratio
    val = VAL_RATIO if val_ratio is None else val_ratio
    rows = with_position(df, panel)
    first = F.floor(F.col("n") * F.lit(float(train)))
    second = F.floor(F.col("n") * F.lit(float(train + val)))
    split = F.when(F.col("pos") < first, "train").when(F.col("pos") < second, "val").otherwise("test")
    return rows.withColumn("split", split).drop("pos", "n")


def train_val_union(df: DataFrame) -> DataFrame:
    """The rows of train and val together."""
    return df.where(F.col("split").isin("train", "val"))


def split_overlap(df: DataFrame, panel: Panel = HOURLY) -> DataFrame:
    """Timestamps that occur in more than one split (none, when nothing leaks)."""
    return (
        df.groupBy(*panel.keys, panel.ts)
        .agg(F.min("split").alias("first_split"), F.max("split").alias("last_split"))
        .where("first_split <> last_split")
    )


def assert_no_leak(train: DataFrame, val: DataFrame, test: DataFrame, panel: Panel = HOURLY) -> None:
    """Raise ValueError when two of the frames share a (series, timestamp)."""
    at = [*panel.keys, panel.ts]
    for left, right, name in ((train, val, "train/val"), (val, test, "val/test"), (train, test, "train/test")):
        if left.select(*at).intersect(right.select(*at)).limit(1).count():
            raise ValueError(f"{name} share timestamps")


def cv_folds(
    df: DataFrame, panel: Panel = HOURLY, n_splits: int | None = None, gap: int | None = None,
) -> DataFrame:
    """Expanding-window folds: one row per (row, fold) it takes part in, with ``fold`` and ``role``.

    The validation part of fold i is the i-th of the last ``n_splits`` blocks of
    n // (n_splits + 1) rows; training is everything more than ``gap`` rows
    before it.
    """
    k = CV_SPLITS if n_splits is None else n_splits
    gap = CV_GAP if gap is None else gap
    rows = with_position(df, panel)
    size = F.floor(F.col("n") / (k + 1))
    start = lambda fold: F.col("n") - (k - fold) * size
    roles = [
        F.when(F.col("pos") < start(i) - gap, F.struct(F.lit(i).alias("fold"), F.lit("train").alias("role")))
        .when((F.col("pos") >= start(i)) & (F.col("pos") < start(i) + size),
              F.struct(F.lit(i).alias("fold"), F.lit("val").alias("role")))
        for i in range(k)
    ]
    return (
        rows.withColumn("_role", F.explode(F.array_compact(F.array(*roles))))
        .select("*", "_role.fold", "_role.role").drop("_role", "pos", "n")
    )


def tail(df: DataFrame, panel: Panel = HOURLY, size: int = 5000) -> DataFrame:
    """The last ``size`` rows with a value, per series."""
    rows = with_position(df.where(F.col(panel.value).isNotNull()), panel)
    return rows.where(F.col("pos") >= F.col("n") - size)


def head(df: DataFrame, panel: Panel = HOURLY, size: int = 500) -> DataFrame:
    """The first ``size`` rows in time order, per series."""
    rows = with_position(df, panel)
    return rows.where(F.col("pos") < size).drop("pos", "n")
