"""Small frames for the edge rules."""

from __future__ import annotations

import datetime as dt
import math
import random

START = dt.datetime(2022, 1, 1)


def at(i: float, start: dt.datetime = START) -> dt.datetime:
    return start + dt.timedelta(hours=i)


def series(spark, values, name="a", start=START, gaps=()):
    rows = [(name, at(i, start), v) for i, v in enumerate(values) if i not in set(gaps)]
    return spark.createDataFrame(rows, "series string, timestamp timestamp, demand double")


def wave(n, seed=42, noise=30.0, size=100.0):
    rng = random.Random(seed)
    return [max(0.0, 800 + size * math.sin(2 * math.pi * (i % 24) / 24) + rng.gauss(0, noise)) for i in range(n)]


def values(df, column="demand", order=("series", "timestamp")):
    return [r[column] for r in df.orderBy(*order).collect()]
