"""Distribution drift: PSI, two-sample KS, report."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewatch.functions.scalar import psi_level
from tidewatch.operators.quantiles import running_counts
from tidewatch.schemas import DRIFT_THRESHOLD, EPS, KS_ALPHA
from tidewatch.session import materialise

MIN_ROWS = 10


def numeric_features(train: DataFrame, prod: DataFrame, features=None) -> list[str]:
    """Wanted (default: all numeric) columns that both sides have."""
    wanted = features or [f.name for f in train.schema if isinstance(f.dataType, T.NumericType)]
    return [c for c in wanted if c in train.columns and c in prod.columns]


def value_rows(train: DataFrame, prod: DataFrame, features=None) -> DataFrame:
    """``feature, value, n_train, n_prod``: one row per value, the counts telling its side. Nulls and NaN are left out."""
    names = numeric_features(train, prod, features)

    def long(df: DataFrame, side: int) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("feature"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("value")) for c in names]
        return df.select(F.explode(F.array(*pairs)).alias("_p")).select(
            "_p.*", F.lit(1 - side).cast("long").alias("n_train"), F.lit(side).cast("long").alias("n_prod")
        )

    return long(train, 0).unionByName(long(prod, 1)).where("value is not null")


def value_counts(rows: DataFrame) -> DataFrame:
    """Distinct values per feature with their count on either side; counts combine before the shuffle."""
    return rows.groupBy("feature", "value").agg(F.sum("n_train").alias("n_train"), F.sum("n_prod").alias("n_prod"))


def sizes(rows: DataFrame) -> DataFrame:
    """Per feature: rows and moments (population std) on either side, joint range. One pass; features with under ten rows on a side are left out."""
    v = F.col("value")
    made = [F.min(v).alias("_lo"), F.max(v).alias("_hi")]
    for side in ("train", "prod"):
        mine = F.when(F.col(f"n_{side}") > 0, v)
        made += [F.count(mine).alias(f"rows_{side}"), F.avg(mine).alias(f"{side}_mean"), F.stddev_pop(mine).alias(f"{side}_std")]
    return rows.groupBy("feature").agg(*made).where((F.col("rows_train") >= MIN_ROWS) & (F.col("rows_prod") >= MIN_ROWS))


def _with_sizes(rows: DataFrame, found: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(found), "feature")  # one row per feature: its size is bounded by the schema


def _bin(v: Column, bins: int) -> Column:
    """Equal-width bin over [_lo, _hi]; a value on an edge opens the next bin, the maximum closes the last."""
    lo, hi = F.col("_lo"), F.col("_hi")
    width = (hi - lo) / bins
    first = F.least(F.floor(F.try_divide(v - lo, width)), F.lit(bins - 1))
    left, right = lo + first * width, lo + (first + 1) * width
    moved = F.when(v < left, first - 1).when((v >= right) & (first < bins - 1), first + 1).otherwise(first)
    return F.coalesce(moved, F.lit(0)).cast("int")


def bin_counts(rows: DataFrame, found: DataFrame, bins: int = 10) -> DataFrame:
    """Rows of either side per feature and joint equal-width bin, empty bins too: features x bins rows leave each task."""
    counts = _with_sizes(rows, found).groupBy("feature", _bin(F.col("value"), bins).alias("bin")).agg(
        F.sum("n_train").alias("_t"), F.sum("n_prod").alias("_p")
    )
    dense = found.select("feature", "rows_train", "rows_prod", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return dense.join(counts, ["feature", "bin"], "left")


def psi(rows: DataFrame, bins: int = 10, eps: float = EPS, found: DataFrame | None = None) -> DataFrame:
    """Population stability index per feature over joint equal-width bins; ``found`` is ``sizes(rows)`` where it is known."""
    binned = bin_counts(rows, sizes(rows) if found is None else found, bins)
    expected = F.coalesce("_t", F.lit(0)) / (F.col("rows_train") + F.lit(eps)) + F.lit(eps)
    actual = F.coalesce("_p", F.lit(0)) / (F.col("rows_prod") + F.lit(eps)) + F.lit(eps)
    return binned.groupBy("feature").agg(F.sum((actual - expected) * F.log(actual / expected)).alias("psi"))


def kolmogorov(scaled: Column) -> Column:
    """Two-sided limit probability of a scaled KS distance (100 terms of its series)."""
    term = lambda j: F.when(j % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(-2.0 * j * j * scaled * scaled)
    total = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda acc, j: acc + term(j.cast("double")))
    return F.when(scaled < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


def ks(rows: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """Two-sample KS distance per feature (exact) and its asymptotic p-value.

    The only measure that needs values in order: distinct ones with their counts are dealt into ranges.
    """
    found = sizes(rows) if found is None else found
    runs = _with_sizes(running_counts(value_counts(rows), ["feature"], "value", ["n_train", "n_prod"]), found.select("feature", "rows_train", "rows_prod"))
    gap = F.abs(F.col("cum_n_train") / F.col("rows_train") - F.col("cum_n_prod") / F.col("rows_prod"))
    best = runs.groupBy("feature", "rows_train", "rows_prod").agg(F.max(gap).alias("ks_statistic"))
    size = F.col("rows_train") * F.col("rows_prod") / (F.col("rows_train") + F.col("rows_prod"))
    return best.select("feature", "ks_statistic", kolmogorov(F.sqrt(size) * F.col("ks_statistic")).alias("ks_pvalue"))


def drift_report(train: DataFrame, prod: DataFrame, features=None, threshold: float | None = None) -> DataFrame:
    """One row per feature: moments, KS, PSI, ``is_drifted`` (p < 0.05 or PSI above the threshold), level by PSI."""
    limit = DRIFT_THRESHOLD if threshold is None else threshold
    rows = value_rows(train, prod, features)
    found = materialise(sizes(rows), "sizes")
    moments = found.select("feature", *[f"{side}_{m}" for m in ("mean", "std") for side in ("train", "prod")])
    report = moments.join(ks(rows, found), "feature").join(psi(rows, found=found), "feature")
    return report.withColumn("is_drifted", (F.col("ks_pvalue") < KS_ALPHA) | (F.col("psi") > limit)).withColumn(
        "drift_level", psi_level("psi")
    )
