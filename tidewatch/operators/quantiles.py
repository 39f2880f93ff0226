"""Exact quantiles and running totals over ordered values without holding a group's values in one task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidewatch.operators.arrays import by_group, doubles, nullable
from tidewatch.operators.joins import attach
from tidewatch.schemas import Panel
from tidewatch.session import materialise

ACCURACY = 10_000
SMALL = 16_384  # rows of a bracket that one task may sort
GRID = 256


def exact_quantiles(df: DataFrame, keys, value: str, probs: dict[str, float], accuracy: int = ACCURACY, small: int = SMALL) -> DataFrame:
    """Linear-interpolated quantiles per key, exact, named as in ``probs``.

    Every quantile lies between two ranks, and each wanted rank has a bracket: least and greatest value it may be, how many
    values lie below, how many inside. A bracket of more than ``small`` rows is cut at two points of a mergeable sketch, the rows in the three pieces are
    counted, and the piece that holds the rank is the next bracket, whether the sketch was right or not. Once all are small,
    or hold one value, the rows left are sorted per key and rank: at most ``small`` of them, no matter how many rows a key has. A round keeps
    about 6/accuracy of the rows of a bracket, and the rounds after the first read only rows inside brackets, which are stored.
    Nulls and NaN are left out; a key without values is absent.
    """
    keys = list(keys)
    rows = df.select(*keys, F.nanvl(F.col(value).cast("double"), F.lit(None)).alias("_v")).where("_v is not null")
    margin = 3.0 / accuracy
    cuts = [c for p in probs.values() for c in (max(p - margin, 0.0), min(p + margin, 1.0))]
    first = rows.groupBy(*keys).agg(
        F.count("_v").alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"), F.percentile_approx("_v", cuts, accuracy).alias("_cuts")
    ).where("_n > 0")
    wanted = {}  # target: (its prob, its rank, the cuts' places)
    for i, p in enumerate(probs.values()):
        spot = F.lit(float(p)) * (F.col("_n") - 1)
        wanted[f"{i}a"], wanted[f"{i}b"] = (F.floor(spot), 2 * i), (F.ceil(spot), 2 * i)
    state = first.select(
        *keys, "_n",
        *[c for t, (rank, at) in wanted.items() for c in (
            rank.alias(f"_rank{t}"), F.col("_min").alias(f"_lo{t}"), F.col("_max").alias(f"_hi{t}"), F.lit(0).cast("long").alias(f"_below{t}"),
            F.col("_n").alias(f"_size{t}"), F.col("_cuts")[at].alias(f"_left{t}"), F.col("_cuts")[at + 1].alias(f"_right{t}"),
        )],
    )
    state = materialise(state, "brackets")
    open_ = lambda t: (F.col(f"_size{t}") > small) & (F.col(f"_lo{t}") < F.col(f"_hi{t}"))
    inside = lambda t: F.col("_v").between(F.col(f"_lo{t}"), F.col(f"_hi{t}"))
    any_of = lambda test: _any([test(t) for t in wanted])
    while not state.where(any_of(open_)).isEmpty():
        state = materialise(_narrowed(rows, state, keys, wanted, open_, inside), "brackets")
        kept = attach(rows, state.select(*keys, *[f"_{c}{t}" for t in wanted for c in ("lo", "hi")]), keys, "_v").where(any_of(inside))
        rows = materialise(kept.select(*keys, "_v"), "inside")
        if not state.where(any_of(open_)).isEmpty():
            state = _recut(rows, state, keys, wanted, open_, inside, max(accuracy, 10 * GRID))
    return _picked(rows, state, keys, wanted, probs, inside)


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def _narrowed(rows: DataFrame, state: DataFrame, keys, wanted, open_, inside) -> DataFrame:
    """Each open bracket's piece that holds its rank: left of, between or right of its cuts."""
    v = F.col("_v")
    joined = attach(rows, state.where(_any([open_(t) for t in wanted])), keys, "_v").where("_n is not null")
    made = []
    for t in wanted:
        left, right = v < F.col(f"_left{t}"), v > F.col(f"_right{t}")
        here = inside(t)
        count = lambda c: F.sum((here & c).cast("long"))  # noqa: E731, B023
        made += [
            count(left).alias(f"_l{t}"), count(right).alias(f"_r{t}"), count(~left & ~right).alias(f"_m{t}"),
            F.max(F.when(here & left, v)).alias(f"_lhi{t}"), F.min(F.when(here & right, v)).alias(f"_rlo{t}"),
            F.min(F.when(here & ~left & ~right, v)).alias(f"_mlo{t}"), F.max(F.when(here & ~left & ~right, v)).alias(f"_mhi{t}"),
        ]
    counted = joined.groupBy(*keys).agg(*made)
    both = _joined(state, counted, keys)
    out = [*[F.col(k) for k in keys], F.col("_n")]
    for t in wanted:
        c = lambda name: F.col(f"_{name}{t}")  # noqa: E731, B023
        at = c("rank") - c("below")
        stay = ~open_(t)
        in_left, in_middle = at < c("l"), at < c("l") + c("m")
        pick = lambda old, a, b, d: F.when(stay, old).when(in_left, a).when(in_middle, b).otherwise(d)  # noqa: E731, B023
        out += [
            c("rank"), pick(c("lo"), c("lo"), c("mlo"), c("rlo")).alias(f"_lo{t}"), pick(c("hi"), c("lhi"), c("mhi"), c("hi")).alias(f"_hi{t}"),
            pick(c("below"), c("below"), c("below") + c("l"), c("below") + c("l") + c("m")).alias(f"_below{t}"),
            pick(c("size"), c("l"), c("m"), c("r")).alias(f"_size{t}"), c("left"), c("right"),
        ]
    return both.select(*out)


def _joined(state: DataFrame, other: DataFrame, keys) -> DataFrame:
    """Two tables with one row per key; null keys meet."""
    if not keys:
        return state.withColumn("_one", F.lit(1)).join(other.withColumn("_one", F.lit(1)), "_one", "left").drop("_one")
    renamed = other.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in other.columns if c not in keys])
    same = _all([F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return state.join(renamed, same, "left").drop(*[f"_k{i}" for i in range(len(keys))])


def _all(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def _recut(rows: DataFrame, state: DataFrame, keys, wanted, open_, inside, accuracy: int) -> DataFrame:
    """New cuts of the open brackets: the points of a sketch of each around its rank."""
    grid = [i / GRID for i in range(GRID + 1)]
    still = attach(rows, state.where(_any([open_(t) for t in wanted])), keys, "_v").where("_n is not null")
    cuts = still.groupBy(*keys).agg(*[
        F.percentile_approx(F.when(open_(t) & inside(t), F.col("_v")), grid, accuracy).alias(f"_grid{t}") for t in wanted
    ])
    both = _joined(state.drop(*[f"_{c}{t}" for t in wanted for c in ("left", "right")]), cuts, keys)
    made = []
    for t in wanted:
        place = (F.col(f"_rank{t}") - F.col(f"_below{t}")) * GRID / F.col(f"_size{t}")
        made += [
            F.get(f"_grid{t}", F.greatest(F.floor(place) - 1, F.lit(0)).cast("int")).alias(f"_left{t}"),
            F.get(f"_grid{t}", F.least(F.floor(place) + 2, F.lit(GRID)).cast("int")).alias(f"_right{t}"),
        ]
    kept = [c for c in both.columns if not c.startswith("_grid")]
    return materialise(both.select(*kept, *made), "brackets")


def _picked(rows: DataFrame, state: DataFrame, keys, wanted, probs, inside) -> DataFrame:
    """The values at the wanted ranks of brackets that are small, or hold one value."""
    joined = attach(rows, state, keys, "_v").where("_n is not null")
    targets = F.array_compact(F.array(*[F.when(inside(t), F.struct(
        F.lit(t).alias("t"), (F.col(f"_rank{t}") - F.col(f"_below{t}")).alias("at")
    )) for t in wanted]))
    # equal values combine before the shuffle
    counts = joined.select(*keys, "_v", F.explode(targets).alias("_t")).groupBy(*keys, "_t.t", "_t.at", "_v").agg(F.count(F.lit(1)).alias("_count"))
    running = Window.partitionBy(*keys, "t").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    hits = counts.withColumn("_cum", F.sum("_count").over(running)).where("_cum > at")
    found = hits.groupBy(*keys).agg(*[F.min(F.when(F.col("t") == t, F.col("_v"))).alias(f"_at{t}") for t in wanted])
    made = []
    for i, (name, p) in enumerate(probs.items()):
        spot = F.lit(float(p)) * (F.col("_n") - 1)
        lo, hi = F.col(f"_at{i}a"), F.col(f"_at{i}b")
        made.append((lo + (hi - lo) * (spot - F.floor(spot))).alias(name))
    return _joined(state.select(*keys, "_n"), found, keys).where("_at0a is not null").select(*keys, *made)


def with_quantiles(df: DataFrame, panel: Panel, by, value: str, probs: dict[str, float]) -> DataFrame:
    """Each row with the ``exact_quantiles`` of its series and ``by``, for rows whose series stand whole: nothing is shuffled, a task holds one series.

    Nulls and NaN are left out; rows of a group without values get null.
    """
    keys, by = list(panel.keys), list(by)
    schema = T.StructType([*df.schema, *[T.StructField(name, T.DoubleType()) for name in probs]])

    def work(batch, starts):
        of = lambda c: batch.column(batch.schema.get_field_index(c))
        rows = batch.num_rows
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, rows)))
        for c in by:
            codes = of(c).dictionary_encode(null_encoding="encode")
            group = group * len(codes.dictionary) + codes.indices.to_numpy()
        group = np.unique(group, return_inverse=True)[1]
        v = doubles(of(value))
        known = np.flatnonzero(~np.isnan(v))
        order = known[np.lexsort((v[known], group[known]))]
        ordered, n = v[order], np.bincount(group[order], minlength=group.max() + 1)
        first, some = np.cumsum(n) - n, n > 0
        made = []
        for p in probs.values():
            spot = p * (n - 1)
            low = np.floor(spot)
            at = np.where(some, first + low, 0).astype(int)
            up = np.where(some, first + np.ceil(spot), 0).astype(int)
            q = ordered[at] + (ordered[up] - ordered[at]) * (spot - low) if len(ordered) else np.zeros(len(n))
            made.append(nullable(q[group], some[group]))
        return pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *probs])

    return by_group(df, [*keys, "_chunk"], schema, work)


def running_counts(df: DataFrame, keys, value: str, counts: list[str], buckets: int | None = None) -> DataFrame:
    """Running totals of ``counts`` over distinct values in order, per key.

    ``df`` has one row per (keys, value). Rows are dealt into ranges of (keys, value) and stored with their range's number; the
    ranges' totals, one row per key and range, are added up along each key, and totals inside a range start from there. So a key is
    as many tasks' work as its distinct values fill ranges: ``buckets`` of them in all, or as many as Spark's partition size asks for. Adds ``before_{c}`` and
    ``cum_{c}``.
    """
    keys = list(keys)
    order = [*keys, value]
    dealt = df.repartitionByRange(buckets, *order) if buckets else df.repartitionByRange(*order)
    rows = materialise(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    totals = rows.groupBy(*keys, "_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in counts])
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *keys, "_range", *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_start_{c}") for c in counts]
    )
    inner = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    # said explicitly: a window would also be content with rows partitioned by the keys alone
    out = _joined(rows.repartition(*keys, "_range"), starts, [*keys, "_range"])
    out = out.select("*", *[(F.col(f"_start_{c}") + F.sum(c).over(inner)).alias(f"cum_{c}") for c in counts])
    out = out.select("*", *[(F.col(f"cum_{c}") - F.col(c)).alias(f"before_{c}") for c in counts])
    return out.drop("_range", *[f"_start_{c}" for c in counts])


def ranked(df: DataFrame, keys, order: list[str], pos: str = "pos", n: str | None = None) -> DataFrame:
    """Add each row's 0-based place in its key's order, and with ``n`` the key's row count.

    As for running totals, rows are dealt into ranges of (keys, order), so that a key is as many tasks' work as its rows fill ranges,
    however they are spread over time. Rows equal in all of ``order`` stand in any order, beside each other.
    """
    keys = list(keys)
    rows = materialise(df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = rows.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_size"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *keys, "_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"), *([F.sum("_size").over(whole).alias(n)] if n else [])
    )
    inner = Window.partitionBy(*keys, "_range").orderBy(*order)
    out = _joined(rows.repartition(*keys, "_range"), starts, [*keys, "_range"])
    return out.withColumn(pos, F.col("_start") + F.row_number().over(inner) - 1).drop("_range", "_start")
