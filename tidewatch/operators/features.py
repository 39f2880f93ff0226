"""The feature matrix: lags, rolling statistics, calendar, cycles, holidays."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tidewatch.functions.scalar import calendar, cyclical, is_holiday
from tidewatch.operators.chunks import chunk_window, chunked, own_rows, rolling, stands, streamed, undealt
from tidewatch.schemas import HOURLY, LAGS, ROLLING_STATS, ROLLING_WINDOWS, SEQUENCE_LENGTH, Panel


def _lag_columns(panel: Panel, window, lags):
    return [F.lag(panel.value, k).over(window).alias(f"{panel.value}_lag_{k}h") for k in lags]


def _rolling_columns(panel: Panel, windows, stats):
    made = []
    for width in sorted(windows):
        for stat in stats:
            c = F.col(f"_{stat}_{width}")
            made.append((F.coalesce(c, F.lit(0.0)) if stat == "std" else c).alias(f"{panel.value}_roll_{stat}_{width}h"))
    return made


def lag_features(df: DataFrame, panel: Panel = HOURLY, lags=LAGS) -> DataFrame:
    """Value k rows back, for each k."""
    if stands(panel, max(lags)):
        rows = streamed(df, panel, (), (), lags=lags)
        return rows.withColumnsRenamed({f"_lag_{k}": f"{panel.value}_lag_{k}h" for k in lags})
    df, panel = undealt(df, panel)
    w = chunk_window(panel)
    return own_rows(chunked(df, panel, max(lags)).select("*", *_lag_columns(panel, w, lags)))


def rolling_features(df: DataFrame, panel: Panel = HOURLY, windows=ROLLING_WINDOWS, stats=ROLLING_STATS) -> DataFrame:
    """Mean, std (n-1; 0 where undefined), min and max of the w rows before each row."""
    w = chunk_window(panel)
    rows = rolling(chunked(df, panel, max(windows)), w, panel.value, windows, stats, shift=1)
    return own_rows(rows.select(*df.columns, "_chunk", "_own", *_rolling_columns(panel, windows, stats)))


def calendar_features(df: DataFrame, panel: Panel = HOURLY) -> DataFrame:
    return df.select("*", *[c.alias(n) for n, c in calendar(panel.ts).items()])


def cyclical_features(df: DataFrame, panel: Panel = HOURLY) -> DataFrame:
    return df.select("*", *[c.alias(n) for n, c in cyclical(panel.ts).items()])


def holiday_feature(df: DataFrame, panel: Panel = HOURLY) -> DataFrame:
    return df.withColumn("is_holiday", is_holiday(panel.ts))


def build_features(
    df: DataFrame, panel: Panel = HOURLY, lags=LAGS, windows=ROLLING_WINDOWS, stats=ROLLING_STATS,
    cycles: bool = True, holidays: bool = True, drop_nulls: bool = True, carry_history: bool = False,
) -> DataFrame:
    """The whole feature matrix in one shuffle, one sort; none of either for dealt rows.

    With a ``split`` column, windows stay inside each split (each split loses
    its look-back rows, the observed behaviour) unless ``carry_history``. Rows
    with a null in any column, pass-through ones included, are dropped.
    """
    inside = panel if carry_history or "split" not in df.columns else panel.by("split")
    if inside is panel and stands(panel, max([*lags, *windows])):
        rows = streamed(df, panel, windows, stats, shift=1, lags=lags)
        rows = rows.withColumnsRenamed({f"_lag_{k}": f"{panel.value}_lag_{k}h" for k in lags})
        df = df.drop("_chunk", "_own")
    else:
        df, inside = undealt(df, inside)
        w = chunk_window(inside)
        rows = chunked(df, inside, max([*lags, *windows]))
        rows = rolling(rows.select("*", *_lag_columns(panel, w, lags)), w, panel.value, windows, stats, shift=1).where("_own")
    lag_names = [f"{panel.value}_lag_{k}h" for k in lags]
    extra = dict(calendar(panel.ts))
    if cycles:
        extra.update(cyclical(panel.ts))
    if holidays:
        extra["is_holiday"] = is_holiday(panel.ts)
    out = rows.select(
        *df.columns, *lag_names, *_rolling_columns(panel, windows, stats), *[c.alias(n) for n, c in extra.items()]
    )
    # only these can be null: the wider windows hold what the narrowest holds
    narrowest = [f"{panel.value}_roll_{s}_{min(windows)}h" for s in stats if s != "std"][:1]
    return out.na.drop("any", subset=[*df.columns, *lag_names, *narrowest]) if drop_nulls else out


def feature_names(df: DataFrame, panel: Panel = HOURLY, drop_cols=()) -> list[str]:
    """Columns that are features: not the key, time, target, label, split, nor text."""
    skip = {*panel.keys, panel.ts, panel.value, "is_anomaly", "split", *drop_cols}
    plain = (T.NumericType, T.BooleanType)
    return [f.name for f in df.schema if f.name not in skip and isinstance(f.dataType, plain)]


def feature_target(df: DataFrame, panel: Panel = HOURLY, drop_cols=()) -> DataFrame:
    """Keys, time, the features and the target."""
    names = feature_names(df, panel, drop_cols)
    return df.select(*panel.keys, panel.ts, *names, F.col(panel.value).alias("target"))


def sequence_pairs(df: DataFrame, panel: Panel = HOURLY, length: int = SEQUENCE_LENGTH, column: str | None = None) -> DataFrame:
    """The ``length`` values before each row as an array, and the value itself; rows with a full array."""
    column = column or panel.value
    w = chunk_window(panel)
    past = F.collect_list(F.col(column).cast("float")).over(w.rowsBetween(-length, -1))
    rows = chunked(df, panel, length).withColumn("sequence", past)
    rows = rows.withColumn("next_value", F.col(column).cast("float"))
    return own_rows(rows.where(F.size("sequence") == length)).select(*panel.keys, panel.ts, "sequence", "next_value")
