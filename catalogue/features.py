"""Lag, rolling, calendar, cyclic and holiday features; the feature matrix; sequences."""

from __future__ import annotations

from catalogue import query
from catalogue.base import GRID, daily_grid, dealt_daily, gappy, grid, plain, r, split, sql, view
from tidewatch.operators import features as f
from tidewatch.operators.split import temporal_split
from tidewatch.schemas import DAILY, LAGS, ROLLING_WINDOWS


def lag_sql(w: str = "w") -> str:
    return ",\n".join(f"lag(demand, {k}) OVER {w} AS demand_lag_{k}h" for k in LAGS)


def roll_sql(w: str = "PARTITION BY series ORDER BY timestamp") -> str:
    out = []
    for n in ROLLING_WINDOWS:
        frame = f"({w} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        out += [
            f"avg(demand) OVER {frame} AS demand_roll_mean_{n}h",
            f"coalesce(stddev_samp(demand) OVER {frame}, 0) AS demand_roll_std_{n}h",
            f"min(demand) OVER {frame} AS demand_roll_min_{n}h",
            f"max(demand) OVER {frame} AS demand_roll_max_{n}h",
        ]
    return ",\n".join(out)


CALENDAR = """hour(timestamp) AS hour, isodow(timestamp) - 1 AS day_of_week, day(timestamp) AS day_of_month, month(timestamp) AS month,
quarter(timestamp) AS quarter, week(timestamp) AS week_of_year, dayofyear(timestamp) AS day_of_year,
(isodow(timestamp) >= 6)::BIGINT AS is_weekend, (day(timestamp) = 1)::BIGINT AS is_month_start,
(timestamp::DATE = last_day(timestamp))::BIGINT AS is_month_end,
(hour(timestamp) BETWEEN 7 AND 9 OR hour(timestamp) BETWEEN 17 AND 21)::BIGINT AS is_peak_hour,
(hour(timestamp) >= 22 OR hour(timestamp) <= 5)::BIGINT AS is_night"""
_PARTS = {"hour": ("hour(timestamp)", 24), "day_of_week": "", "month": ("month(timestamp)", 12), "day_of_year": ("dayofyear(timestamp)", 365)}
_PARTS["day_of_week"] = ("(isodow(timestamp) - 1)", 7)
CYCLES = ",\n".join(
    f"{fn}(2 * pi() * {e} / {p})::FLOAT::DOUBLE AS {n}_{fn}" for n, (e, p) in _PARTS.items() for fn in ("sin", "cos")
)
HOLIDAY = "((month(timestamp), day(timestamp)) IN ((1, 1), (12, 25), (12, 26), (7, 4)))::BIGINT AS is_holiday"
LAG_NAMES = [f"demand_lag_{k}h" for k in LAGS]
ROLL_NAMES = [f"demand_roll_{s}_{n}h" for n in ROLLING_WINDOWS for s in ("mean", "std", "min", "max")]
CAL_NAMES = ["hour", "day_of_week", "day_of_month", "month", "quarter", "week_of_year", "day_of_year", "is_weekend",
             "is_month_start", "is_month_end", "is_peak_hour", "is_night"]
CYC_NAMES = [f"{n}_{fn}" for n in _PARTS for fn in ("sin", "cos")]


def shown(names) -> str:
    return ", ".join(f"{r(n)} AS {n}" for n in names)


ALL = f"{shown(LAG_NAMES + ROLL_NAMES + CYC_NAMES)}, {', '.join(CAL_NAMES)}, is_holiday"


@query("lag_features", sql(f"SELECT series, timestamp, {shown(['demand', *LAG_NAMES])} FROM (SELECT *, {lag_sql('(PARTITION BY series ORDER BY timestamp)')} FROM g)", "g"))
def lag_features(spark, d):
    return f.lag_features(plain(spark, d))


@query("rolling_features", sql(f"SELECT series, timestamp, {shown(['demand', *ROLL_NAMES])} FROM (SELECT *, {roll_sql()} FROM g)", "g"))
def rolling_features(spark, d):
    return f.rolling_features(plain(spark, d), GRID)


@query("lag_features_gappy", sql(f"SELECT series, timestamp, {shown(['demand', *LAG_NAMES])} FROM (SELECT *, {lag_sql('(PARTITION BY series ORDER BY timestamp)')} FROM ud)", "ud"))
def lag_features_gappy(spark, d):
    """Lags count rows where a series has gaps."""
    return f.lag_features(gappy(spark, d))


@query("rolling_features_gappy", sql(f"SELECT series, timestamp, {shown(['demand', *ROLL_NAMES])} FROM (SELECT *, {roll_sql()} FROM ud)", "ud"))
def rolling_features_gappy(spark, d):
    """Frames count rows where a series has gaps."""
    return f.rolling_features(gappy(spark, d))


@query("calendar_features", sql(f"SELECT series, timestamp, {r('demand')} AS demand, {CALENDAR} FROM lg", "lg"))
def calendar_features(spark, d):
    return f.calendar_features(daily_grid(spark, d).drop("pos", "n"), DAILY)


@query("calendar_features_hourly", sql(f"SELECT series, timestamp, {r('demand')} AS demand, {CALENDAR} FROM g", "g"))
def calendar_features_hourly(spark, d):
    return f.calendar_features(plain(spark, d))


@query("cyclical_features", sql(f"SELECT series, timestamp, {r('demand')} AS demand, {shown(CYC_NAMES)} FROM (SELECT *, {CYCLES} FROM g)", "g"))
def cyclical_features(spark, d):
    return f.cyclical_features(plain(spark, d))


@query("holiday_flag", sql(f"SELECT series, timestamp, {r('demand')} AS demand, {HOLIDAY} FROM lg", "lg"))
def holiday_flag(spark, d):
    return f.holiday_feature(daily_grid(spark, d).drop("pos", "n"), DAILY)


view("m", f"""m AS (SELECT *, {CALENDAR}, {CYCLES}, {HOLIDAY} FROM (SELECT series, timestamp, demand, split,
{lag_sql('(PARTITION BY series, split ORDER BY timestamp)')},
{roll_sql('PARTITION BY series, split ORDER BY timestamp')} FROM s) WHERE demand_lag_168h IS NOT NULL)""", "s")
view("w", f"""w AS (SELECT *, {CALENDAR}, {CYCLES}, {HOLIDAY} FROM (SELECT series, timestamp, demand,
{lag_sql('(PARTITION BY series ORDER BY timestamp)')},
{roll_sql()} FROM g) WHERE demand_lag_168h IS NOT NULL)""", "g")
view("lw", f"""lw AS (SELECT *, {CALENDAR}, {CYCLES}, {HOLIDAY} FROM (SELECT series, timestamp, demand,
{lag_sql('(PARTITION BY series ORDER BY timestamp)')},
{roll_sql()} FROM lg) WHERE demand_lag_168h IS NOT NULL)""", "lg")


@query("feature_matrix", sql(f"SELECT series, timestamp, {r('demand')} AS demand, {ALL} FROM w", "w"))
def feature_matrix(spark, d):
    return f.build_features(plain(spark, d), GRID)


@query("feature_matrix_daily", sql(f"SELECT series, timestamp, {r('demand')} AS demand, {ALL} FROM lw", "lw"))
def feature_matrix_daily(spark, d):
    return f.build_features(*dealt_daily(spark, d, max(*LAGS, *ROLLING_WINDOWS)))


@query("feature_matrix_by_split", sql(f"SELECT series, timestamp, split, {r('demand')} AS demand, {ALL} FROM m", "m"))
def feature_matrix_by_split(spark, d):
    """Windows stay inside each split, which loses its look-back rows."""
    return f.build_features(split(spark, d), GRID)


@query("feature_matrix_carried", sql(f"""SELECT w.series, w.timestamp, split, {r('w.demand')} AS demand,
  {', '.join(f'{r("w." + n)} AS {n}' for n in LAG_NAMES + ROLL_NAMES)} FROM w JOIN s USING (series, timestamp)""", "w", "s"))
def feature_matrix_carried(spark, d):
    """Windows run over the splits' borders."""
    keep = ["series", "timestamp", "split", "demand", *LAG_NAMES, *ROLL_NAMES]
    return f.build_features(split(spark, d), GRID, carry_history=True).select(*keep)


@query("feature_target", sql(f"SELECT series, timestamp, {r('demand')} AS target, {ALL} FROM m WHERE split = 'train'", "m"))
def feature_target(spark, d):
    return f.feature_target(f.build_features(split(spark, d), GRID).where("split = 'train'"))


@query("sequence_pairs", sql(f"""SELECT series, timestamp, step, {r('v', 2)} AS v, {r('next_value', 2)} AS next_value FROM (
  SELECT series, timestamp, unnest(list(demand::FLOAT::DOUBLE) OVER (PARTITION BY series ORDER BY timestamp ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)) AS v,
    unnest(range(least(pos, 24))) AS step, demand::FLOAT::DOUBLE AS next_value, pos FROM g) WHERE pos >= 24""", "g"), digits=2)
def sequence_pairs(spark, d):
    """The 24 values before each row, one row per element here."""
    pairs = f.sequence_pairs(plain(spark, d))
    return pairs.selectExpr("series", "timestamp", "posexplode(sequence) as (step, v)", "next_value")


@query("temporal_split_by_position", sql("SELECT series, timestamp, split FROM s", "s"))
def split_by_position(spark, d):
    return temporal_split(grid(spark, d)).select("series", "timestamp", "split")
