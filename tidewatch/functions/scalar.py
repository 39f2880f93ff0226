"""Column expressions shared by batch and streaming jobs."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from tidewatch.schemas import EPS, FIXED_HOLIDAYS, MAX_DEMAND, MIN_DEMAND, SEVERITY


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------ calendar

def calendar(ts) -> dict[str, Column]:
    """Twelve calendar features, with their narrow types."""
    ts = _col(ts)
    hour, weekday = F.hour(ts), F.weekday(ts)
    flag = lambda condition: condition.cast("tinyint")
    return {
        "hour": hour.cast("tinyint"),
        "day_of_week": weekday.cast("tinyint"),
        "day_of_month": F.day(ts).cast("tinyint"),
        "month": F.month(ts).cast("tinyint"),
        "quarter": F.quarter(ts).cast("tinyint"),
        "week_of_year": F.weekofyear(ts).cast("tinyint"),
        "day_of_year": F.dayofyear(ts).cast("smallint"),
        "is_weekend": flag(weekday >= 5),
        "is_month_start": flag(F.day(ts) == 1),
        "is_month_end": flag(F.to_date(ts) == F.last_day(ts)),
        "is_peak_hour": flag(hour.between(7, 9) | hour.between(17, 21)),
        "is_night": flag((hour >= 22) | (hour <= 5)),
    }


# Period of each cyclic calendar feature.
CYCLES = {"hour": 24, "day_of_week": 7, "month": 12, "day_of_year": 365}


def cyclical(ts) -> dict[str, Column]:
    """Sine and cosine of four calendar features, as float32."""
    parts = calendar(ts)
    made = {}
    for name, period in CYCLES.items():
        angle = F.lit(2 * math.pi) * parts[name].cast("double") / period
        made[f"{name}_sin"] = F.sin(angle).cast("float")
        made[f"{name}_cos"] = F.cos(angle).cast("float")
    return made


def is_holiday(ts, holidays=FIXED_HOLIDAYS) -> Column:
    """1 on a fixed month and day."""
    ts = _col(ts)
    return (F.month(ts) * 100 + F.day(ts)).isin([m * 100 + d for m, d in holidays]).cast("tinyint")


def floor_to_hour(ts) -> Column:
    return F.date_trunc("hour", _col(ts))


def day_name(ts) -> Column:
    return F.date_format(_col(ts), "EEEE")


def month_name(ts) -> Column:
    return F.date_format(_col(ts), "MMM")


def now_text() -> Column:
    """Current UTC time to the second, ISO 8601 with Z."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_iso(text) -> Column:
    """ISO 8601 text, with T or blank and an optional offset or Z; null when it is not one."""
    text = _col(text)
    shape = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?(Z|[+-]\d{2}:\d{2})?)?$"
    full = F.when(text.rlike(r"[T ]\d{2}$"), F.concat(text, F.lit(":00"))).otherwise(text)
    return F.when(text.rlike(shape), F.try_to_timestamp(full))


# ------------------------------------------------------------ values

def clip_range(x, low=MIN_DEMAND, high=MAX_DEMAND) -> Column:
    """Clip to [low, high]; null stays null."""
    x, low, high = _col(x), _lit(low), _lit(high)
    return F.when(x < low, low).when(x > high, high).otherwise(x)


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def non_negative(x) -> Column:
    x = _col(x)
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def severity(score, flagged=None) -> Column:
    """Severity label of a score; ``normal`` for rows that are not flagged."""
    score = _col(score)
    label = (
        F.when(score >= SEVERITY["high"], "high")
        .when(score >= SEVERITY["medium"], "medium")
        .when(score >= SEVERITY["low"], "low")
        .otherwise("normal")
    )
    return label if flagged is None else F.when(_col(flagged), label).otherwise("normal")


def psi_level(psi) -> Column:
    psi = _col(psi)
    return F.when(psi < 0.1, "none").when(psi < 0.2, "low").when(psi < 0.25, "medium").otherwise("high")


def fallback_score(actual, predicted) -> Column:
    """Relative distance from the prediction, at most 1; an absent prediction counts as the actual."""
    actual = _col(actual)
    gap = F.abs(actual - F.coalesce(_col(predicted), actual))
    return F.least(gap / (actual + F.lit(EPS)), F.lit(1.0))


def align_features(payload, names) -> dict[str, Column]:
    """The model's features from a map, in order; an absent key is 0."""
    payload = _col(payload)
    return {n: F.coalesce(F.try_element_at(payload, F.lit(n)), F.lit(0.0)) for n in names}


def n_filled(payload, names) -> Column:
    """How many of the model's features the payload did not hold."""
    payload = _col(payload)
    absent = [F.try_element_at(payload, F.lit(n)).isNull().cast("int") for n in names]
    return sum(absent[1:], absent[0])


# ------------------------------------------------------------ normal quantile

# Published coefficients of algorithm AS 241 (PPND16), numerator
# then denominator, highest power first, for the centre and the two tails.
_CENTRE = (
    (2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457,
     13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.387132872796366608),
    (5226.495278852545925, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867,
     5394.1960214247511077, 687.1870074920579083, 42.313330701600911252, 1.0),
)
_NEAR = (
    (7.7454501427834140764e-4, 0.0227238449892691845833, 0.24178072517745061177, 1.27045825245236838258,
     3.64784832476320460504, 5.7694972214606914055, 4.6303378461565452959, 1.42343711074968357734),
    (1.05075007164441684324e-9, 5.475938084995344946e-4, 0.0151986665636164571966, 0.14810397642748007459,
     0.68976733498510000455, 1.6763848301838038494, 2.05319162663775882187, 1.0),
)
_FAR = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 0.0012426609473880784386, 0.026532189526576123093,
     0.29656057182850489123, 1.7848265399172913358, 5.4637849111641143699, 6.6579046435011037772),
    (2.04426310338993978564e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5, 7.868691311456132591e-4,
     0.0148753612908506148525, 0.13692988092273580531, 0.59983220655588793769, 1.0),
)


def _ratio(tables, r: Column) -> Column:
    top, bottom = (F.lit(t[0]) for t in tables)
    for a, b in zip(tables[0][1:], tables[1][1:]):
        top, bottom = top * r + a, bottom * r + b
    return top / bottom


def normal_quantile(p) -> Column:
    """Inverse of the standard normal distribution function (AS 241)."""
    p = _col(p)
    q = p - 0.5
    tail = F.sqrt(-F.log(F.when(q < 0, p).otherwise(F.lit(1.0) - p)))
    outer = F.when(tail <= 5, _ratio(_NEAR, tail - 1.6)).otherwise(_ratio(_FAR, tail - 5.0))
    return F.when(F.abs(q) <= 0.425, q * _ratio(_CENTRE, F.lit(0.180625) - q * q)).otherwise(
        F.when(q < 0, -outer).otherwise(outer)
    )
