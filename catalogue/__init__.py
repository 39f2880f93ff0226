"""Registered queries, each with the DuckDB SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewatch.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType)


# Means of two-decimal values often lie exactly between two roundings, where the
# last bit of a sum would decide. Both engines add this part of the last shown
# digit before rounding, so such ties are off the edge.
NUDGE = 0.031415926


def rounded(c, digits: int):
    """Round for comparison; adding 0 turns a negative zero into zero.

    ``round`` goes through decimal text. Where a double holds the shown digits, its nearest whole number of them is the same and takes a fraction of the time.
    """
    x, unit = c + F.lit(NUDGE * 10.0**-digits), 10.0**digits
    return F.when(F.abs(x) < 2.0**50 / unit, F.rint(x * unit) / unit).otherwise(F.round(x, digits)) + F.lit(0.0)


def rounded_sql(expr: str, digits: int = 6) -> str:
    return f"round({expr} + {NUDGE * 10.0**-digits!r}::DOUBLE, {digits}) + 0::DOUBLE"


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Plain comparable columns: doubles rounded, whole numbers as long, times without zone."""
    made = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = rounded(c.cast("double"), digits)
        elif isinstance(f.dataType, _WHOLE):
            c = c.cast("long")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        made.append(c.alias(f.name))
    return df.select(*made)


def query(name: str, sql: str | None = None, digits: int = 6):
    """Register a query, and the SQL that gives the same rows."""

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finish(build(prepare(spark), sf_dir), digits)

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def load_all() -> None:
    from catalogue import accuracy, cleaning, detection, exploration, features, intake, models, monitoring, streams  # noqa: F401
