"""Forecasts from the recent sequence: one step ahead, and several by feeding back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.functions.scalar import non_negative
from tidewatch.operators.features import sequence_pairs
from tidewatch.operators.joins import attach
from tidewatch.operators.models import LinearForecaster
from tidewatch.operators.split import tail
from tidewatch.schemas import EPS, HOURLY, SEQUENCE_LENGTH, Panel
from tidewatch.session import materialise


class SequenceForecaster:
    """Linear model of the next value from the last ``length`` standardised values.

    Predictions carry the timestamp of the value they predict.
    """

    def __init__(self, length: int = SEQUENCE_LENGTH, panel: Panel = HOURLY):
        self.length, self.panel = length, panel
        self.model: LinearForecaster | None = None
        self.moments: DataFrame | None = None

    def _check(self):
        if self.model is None:
            raise RuntimeError("the sequence model has no fitted state yet")

    def _scaled(self, df: DataFrame) -> DataFrame:
        p = self.panel
        rows = attach(df, self.moments, p.keys, p.ts)
        return rows.withColumn("_z", (F.col(p.value) - F.col("_m")) / F.col("_s")).drop("_m", "_s")

    def _pairs(self, df: DataFrame) -> DataFrame:
        pairs = sequence_pairs(self._scaled(df), self.panel, self.length, "_z")
        return pairs.select(*self.panel.keys, self.panel.ts, "next_value", *[F.col("sequence")[i].alias(f"s_{i}") for i in range(self.length)])

    def fit(self, df: DataFrame) -> "SequenceForecaster":
        p = self.panel
        moments = df.groupBy(*p.keys).agg(F.avg(p.value).alias("_m"), (F.stddev_pop(p.value) + EPS).alias("_s"))
        self.moments = materialise(moments, "moments")
        model = LinearForecaster("linear_regression", keys=p.keys, spread=p.ts)
        model.fit(self._pairs(df), [f"s_{i}" for i in range(self.length)], "next_value")
        self.model = model
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        """Actual and predicted for every row with a full sequence before it."""
        self._check()
        p, m = self.panel, self.model
        rows = attach(self._pairs(df), m.coefficients.select(*p.keys, "intercept", "coef"), p.keys, p.ts)
        z = F.col("intercept")
        for i in range(self.length):
            z = z + F.col("coef")[i] * F.col(f"s_{i}").cast("double")
        rows = attach(rows.withColumn("_p", z), self.moments, p.keys, p.ts)
        back = lambda c: F.col(c).cast("double") * F.col("_s") + F.col("_m")
        return rows.select(*p.keys, p.ts, back("next_value").alias("actual"), non_negative(back("_p")).alias("predicted"))

    def forecast(self, df: DataFrame, steps: int) -> DataFrame:
        """``steps`` values past each series' end, each prediction fed back as the newest value.

        Works on the last ``length`` values of a series only.
        """
        self._check()
        p, length = self.panel, self.length
        last = tail(self._scaled(df), p, length)
        order = F.array_sort(F.collect_list(F.struct(F.col("pos"), F.col("_z"))))
        seeds = last.groupBy(*p.keys).agg(F.transform(order, lambda s: s["_z"]).alias("_seed"), F.max(p.ts).alias("_end"))
        seeds = seeds.where(F.size("_seed") == length)
        state = self.model.coefficients.select(*p.keys, "intercept", "coef").join(self.moments, list(p.keys))
        rows = seeds.join(state, list(p.keys))

        def step(held, _):
            window = F.slice(held, -length, length)
            terms = F.zip_with(window, F.col("coef"), lambda x, c: x * c)
            value = F.aggregate(terms, F.col("intercept"), lambda acc, t: acc + t)
            return F.concat(held, F.array(value))

        full = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.col("_seed"), step)
        rows = rows.select(*p.keys, "_end", "_m", "_s", F.posexplode(F.slice(full, length + 1, steps)).alias("_i", "_z"))
        ahead = F.timestamp_micros(F.unix_micros("_end") + (F.col("_i") + 1).cast("long") * p.step_us)
        return rows.select(
            *p.keys, (F.col("_i") + 1).alias("step"), ahead.alias(p.ts),
            non_negative(F.col("_z") * F.col("_s") + F.col("_m")).alias("predicted"),
        )


def naive_forecast(df: DataFrame, steps: int, panel: Panel = HOURLY, season: int = 24) -> DataFrame:
    """``steps`` values past the end, each the value one season before it (fed back past one season)."""
    last = tail(df, panel, season)
    order = F.array_sort(F.collect_list(F.struct(F.col("pos"), F.col(panel.value).alias("v"))))
    seeds = last.groupBy(*panel.keys).agg(F.transform(order, lambda s: s["v"]).alias("_seed"), F.max(panel.ts).alias("_end"))
    rows = seeds.where(F.size("_seed") == season).withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))
    ahead = F.timestamp_micros(F.unix_micros("_end") + (F.col("_i") + 1).cast("long") * panel.step_us)
    value = F.element_at("_seed", (F.pmod("_i", F.lit(season)) + 1).cast("int"))
    return rows.select(*panel.keys, (F.col("_i") + 1).alias("step"), ahead.alias(panel.ts), non_negative(value).alias("predicted"))
