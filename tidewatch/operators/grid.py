"""Regular time grid: missing timestamps, gaps, filling."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewatch.operators.arrays import by_group, doubles, nullable
from tidewatch.operators.chunks import across_chunks, chunk_of, join_by_chunk, undealt
from tidewatch.operators.joins import attach
from tidewatch.schemas import HOURLY, Panel
from tidewatch.session import materialise

FILLS = ("linear", "ffill", "bfill", "drop", None)
_BLOCK = 4096
PIECES = 8


def _unique(df: DataFrame, panel: Panel, on_duplicate: str, order_by: str | None) -> DataFrame:
    keys = [*panel.keys, panel.ts]
    rest = [c for c in df.columns if c not in keys]
    if on_duplicate == "raise":
        return df
    if on_duplicate == "mean":
        return df.groupBy(*keys).agg(
            *[(F.avg(c) if c == panel.value else F.first(c, ignorenulls=True)).alias(c) for c in rest]
        )
    if on_duplicate == "last":
        if order_by is None:
            raise ValueError("on_duplicate='last' needs order_by, the column that says which row is last")
        picked = F.max_by(F.struct(*rest), F.col(order_by)).alias("_row")
        return df.groupBy(*keys).agg(picked).select(*keys, "_row.*")
    raise ValueError(f"Unknown on_duplicate: {on_duplicate}")


def _timed(df: DataFrame, panel: Panel) -> DataFrame:
    """Rows with a time, counted in microseconds, and their chunk; NaN is null."""
    return (
        df.where(F.col(panel.ts).isNotNull())
        .withColumn(panel.value, F.nanvl(F.col(panel.value).cast("double"), F.lit(None)))
        .withColumn("_us", F.unix_micros(F.col(panel.ts)))
        .withColumn("_chunk", chunk_of(F.col("_us"), panel.step_us, panel.chunk_rows))
    )


def _known(panel: Panel) -> Column:
    return F.when(F.col(panel.value).isNotNull(), F.struct(F.col("_us").alias("us"), F.col(panel.value).alias("v")))


def _summaries(rows: DataFrame, panel: Panel) -> DataFrame:
    """One row per series and chunk with on-grid rows: their ends and known ends, and the series' bounds."""
    keys, step = list(panel.keys), panel.step_us
    v, at = F.col(panel.value), F.when(F.col(panel.value).isNotNull(), F.col("_us"))
    per_chunk = rows.groupBy(*keys, "_chunk", F.pmod("_us", F.lit(step)).alias("_phase")).agg(
        F.min("_us").alias("_first"), F.max("_us").alias("_last"),
        F.min(at).alias("_first_at"), F.min_by(v, at).alias("_first_v"), F.max(at).alias("_last_at"), F.max_by(v, at).alias("_last_v"),
    )
    known = lambda end: F.when(
        F.col(f"_{end}_at").isNotNull(), F.struct(F.col(f"_{end}_at").alias("us"), F.col(f"_{end}_v").alias("v"))
    ).alias(f"_{end}_known")
    per_chunk = materialise(per_chunk.select(*keys, "_chunk", "_phase", "_first", "_last", known("first"), known("last")), "chunks")
    bounds = per_chunk.groupBy(*keys).agg(F.min("_first").alias("_start"), F.max("_last").alias("_stop"))
    return attach(per_chunk, bounds, keys, "_chunk").where(F.col("_phase") == F.pmod("_start", F.lit(step)))


def _present(df: DataFrame, panel: Panel, raise_on_duplicate: bool = True) -> DataFrame:
    """Present on-grid rows, each knowing the next present row and known values.

    The grid of a series starts at its first timestamp. Chunks are summarised
    into one small row each; what the other chunks hold gives every chunk the
    series start and end, the first row after it and the nearest known values
    outside it. The rows themselves shuffle once, by (keys, chunk).
    """
    keys, step = list(panel.keys), panel.step_us
    rows = _timed(df, panel)
    known, per_chunk = _known(panel), _summaries(rows, panel)
    per_chunk = across_chunks(per_chunk, keys, panel.chunk_rows, {
        "_chunk_next": ("first_after", "_first"), "_before": ("last_before", "_last_known"), "_after": ("first_after", "_first_known"),
    }).select(
        *keys, "_chunk", "_start",
        (F.col("_start") + F.floor((F.col("_stop") - F.col("_start")) / step) * step).alias("_end"),
        "_chunk_next", "_before", "_after",
    )
    on_grid = F.pmod(F.col("_us"), F.lit(step)) == F.pmod(F.col("_start"), F.lit(step))
    joined = join_by_chunk(rows, per_chunk, keys).where(on_grid).withColumn("_known", known)
    inner = f"over (partition by {', '.join(f'`{k}`' for k in keys)}, _chunk order by _us)"
    out = joined.select(
        "*",
        F.expr(f"lead(_us) {inner}").alias("_lead"),
        F.expr(f"lag(_known) ignore nulls {inner}").alias("_lag_known"),
        F.expr(f"lead(_known) ignore nulls {inner}").alias("_lead_known"),
    )
    next_us = F.coalesce("_lead", "_chunk_next", F.col("_end") + step)
    if raise_on_duplicate:
        message = F.concat(F.lit("duplicate timestamp: "), F.col(panel.ts).cast("string"))
        next_us = F.when(F.col("_lead") == F.col("_us"), F.raise_error(message).cast("long")).otherwise(next_us)
    return (
        out.withColumn("_next", next_us)
        .withColumn("_prev", F.coalesce("_known", "_lag_known", "_before"))
        .withColumn("_foll", F.coalesce("_lead_known", "_after"))
        .drop("_lead", "_chunk_next", "_lag_known", "_lead_known", "_before", "_after")
    )


def _spread(first: Column, last: Column, step: int):
    """Two-level sequence, so that a gap of any length makes no giant array."""
    return F.sequence(first, last, F.lit(step * _BLOCK)), lambda block: F.sequence(
        block, F.least(block + (_BLOCK - 1) * step, last), F.lit(step)
    )


def _filled(fill: str | None, value: Column, own: Column) -> Column:
    p, n, at = F.col("_prev"), F.col("_foll"), F.col("_at")
    if fill is None:
        return F.when(own, value)
    if fill == "ffill":
        return F.coalesce(p["v"], n["v"])
    if fill == "bfill":
        return F.when(own & value.isNotNull(), value).otherwise(F.coalesce(n["v"], p["v"]))
    slope = (n["v"] - p["v"]) / (n["us"] - p["us"])
    return (
        F.when(own & value.isNotNull(), value)
        .when(p.isNull(), n["v"])
        .when(n.isNull(), p["v"])
        .otherwise(p["v"] + slope * (at - p["us"]))
    )


def regularise(
    df: DataFrame,
    panel: Panel = HOURLY,
    fill: str | None = None,
    on_duplicate: str = "raise",
    order_by: str | None = None,
    with_position: bool = False,
) -> DataFrame:
    """Every step from a series' first to last timestamp, one row each.

    Off-grid rows vanish. Pass-through columns are null on added rows. ``fill``
    treats null values: ``linear`` by position (ends take the nearest value),
    ``ffill`` / ``bfill`` (then the other way for the ends), ``drop`` removes
    them, ``None`` keeps them. ``with_position`` adds ``pos`` and ``n``.
    A duplicate timestamp raises unless ``on_duplicate`` is ``mean`` or ``last``.
    """
    if fill not in FILLS:
        raise ValueError(f"fill must be a known way to fill gaps, got {fill!r}")
    df = _unique(df, panel, on_duplicate, order_by)
    keys, step = list(panel.keys), panel.step_us
    extras = [c for c in df.columns if c not in (*keys, panel.ts, panel.value)]
    rows = _present(df, panel, raise_on_duplicate=on_duplicate == "raise")
    place = []
    if with_position:
        place = [
            ((F.col("_at") - F.col("_start")) / step).cast("long").alias("pos"),
            ((F.col("_end") - F.col("_start")) / step + 1).cast("long").alias("n"),
        ]
    if fill == "drop":
        kept = rows.where(F.col(panel.value).isNotNull()).withColumn("_at", F.col("_us"))
        kept = kept.select(*df.columns, "_next", *place)
        return kept.where("_next is not null").drop("_next", "pos", "n")
    blocks, within = _spread(F.col("_us"), F.col("_next") - step, step)
    rows = rows.withColumn("_block", F.explode(blocks)).withColumn("_at", F.explode(within(F.col("_block"))))
    own = F.col("_at") == F.col("_us")
    made = {
        panel.ts: F.timestamp_micros("_at"),
        panel.value: _filled(fill, F.col(panel.value), own),
        **{c: F.when(own, F.col(c)) for c in extras},
    }
    return rows.select(*[made[c].alias(c) if c in made else F.col(c) for c in df.columns], *place)


def deal(
    df: DataFrame, panel: Panel = HOURLY, fill: str = "linear", back: int = 0, on_duplicate: str = "raise", order_by: str | None = None,
    with_position: bool = False,
) -> tuple[DataFrame, Panel, bool]:
    """The filled grid of ``regularise`` with its rows dealt for operators that take them as they stand, so that only given rows are shuffled.

    A chunk is ``PIECES`` times ``chunk_rows`` steps, counted from the panel's first, so that most series are whole in one. Rows given in the
    last pieces of a chunk, at least ``back`` steps, go to the next one too; gaps are exploded and filled after the shuffle, in both.
    Gives the rows with ``_chunk``, ``_own`` and ``_whole`` (the series has one chunk), each chunk's beside each other in time order; the
    panel that says so; and whether any series is longer than a chunk.
    """
    if fill not in ("linear", "ffill", "bfill"):
        raise ValueError(f"dealt rows have no gaps, so fill cannot be {fill!r}")
    df = _unique(df, panel, on_duplicate, order_by)
    keys, step = list(panel.keys), panel.step_us
    extras = [c for c in df.columns if c not in (*keys, panel.ts, panel.value)]
    rows = _timed(df, panel)
    pieces = _summaries(rows, panel)
    reach = -(-back // panel.chunk_rows)
    many, origin = max(PIECES, reach), pieces.agg(F.min("_chunk")).first()[0] or 0
    heads = materialise(_heads(pieces, panel, many, reach, origin), "heads")

    home = F.floor((F.col("_chunk") - origin) / many)
    late = F.pmod(F.col("_chunk") - origin, F.lit(many)) >= many - reach
    homes = F.explode(F.when(late, F.array(home, home + 1)).otherwise(F.array(home))) if reach else home
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    given = rows.select(*named, "_us", F.col(panel.value).alias("_v"), *[F.col(c).alias(f"_x{i}") for i, c in enumerate(extras)], homes.alias("_home"))
    same = (F.col("_home") == F.col("_chunk")) & (F.pmod(F.col("_us") - F.col("_from"), F.lit(step)) == 0)
    for i, k in enumerate(keys):
        same = same & (F.col(f"_k{i}") == F.col(k))
    joined = given.join(heads.hint("shuffle_hash"), same, "right").drop("_home", *[f"_k{i}" for i in range(len(keys))])
    joined = joined.withColumn("_known", F.when(F.col("_v").isNotNull(), F.struct(F.col("_us").alias("us"), F.col("_v").alias("v"))))
    inner = f"over (partition by {', '.join(f'`{k}`' for k in keys)}, _chunk order by _us)"
    out = joined.select(
        "*", F.expr(f"lag(_us) {inner}").alias("_lag"), F.expr(f"lead(_us) {inner}").alias("_lead"),
        F.expr(f"lag(_known) ignore nulls {inner}").alias("_lag_known"), F.expr(f"lead(_known) ignore nulls {inner}").alias("_lead_known"),
    )
    until = F.coalesce("_lead", F.col("_until") + step) - step
    if on_duplicate == "raise":
        message = F.concat(F.lit("duplicate timestamp: "), F.timestamp_micros("_us").cast("string"))
        until = F.when(F.col("_lead") == F.col("_us"), F.raise_error(message).cast("long")).otherwise(until)
    # a stretch of steps has its first and last, and a line: value, the time it holds at, slope
    known, lead, after, before = F.col("_known"), F.col("_lead_known"), F.col("_after"), F.col("_before")
    main = _line(fill, F.coalesce(known, "_lag_known", before), F.coalesce(lead, after), F.coalesce("_us", "_from"), until)
    early = _line(fill, before, F.coalesce(known, lead, after), F.col("_from"), F.col("_us") - step)
    stretches = F.when(F.col("_lag").isNull() & (F.col("_from") < F.col("_us")), F.array(early, main)).otherwise(F.array(main))
    out = out.withColumn("_s", F.explode(stretches)).withColumn("_at", F.explode(F.sequence("_s.first", "_s.last", F.lit(step))))
    at, line = F.col("_at"), F.col("_s")
    given = F.coalesce(at == F.col("_us"), F.lit(False))
    made = {
        panel.ts: F.timestamp_micros(at),
        panel.value: F.when(given & F.col("_v").isNotNull(), F.col("_v")).otherwise(line["base"] + line["slope"] * (at - line["origin"])),
        **{c: F.when(given, F.col(f"_x{i}")) for i, c in enumerate(extras)},
    }
    place = [((at - F.col("_start")) / step).cast("long").alias("pos"), ((F.col("_end") - F.col("_start")) / step + 1).cast("long").alias("n")]
    out = out.select(
        *[made[c].alias(c) if c in made else F.col(c) for c in df.columns], *(place if with_position else []),
        "_chunk", (at >= F.col("_own_from")).alias("_own"), "_whole",
    )
    return out, panel.on(full=True, dealt=back), not heads.where("not _whole").isEmpty()


def _heads(pieces: DataFrame, panel: Panel, many: int, reach: int, origin: int) -> DataFrame:
    """One row per series and chunk of ``many`` pieces: its steps, those of the ``reach`` pieces before it included, and the nearest known values outside them."""
    keys, step = list(panel.keys), panel.step_us
    pieces = across_chunks(pieces, keys, panel.chunk_rows, {
        "_next": ("first_after", "_chunk"), "_before": ("last_before", "_last_known"), "_after": ("first_after", "_first_known"),
    }).withColumn("_end", F.col("_start") + F.floor((F.col("_stop") - F.col("_start")) / step) * step)
    piece, last = F.col("_chunk"), chunk_of(F.col("_end"), step, panel.chunk_rows)
    group = lambda p: F.floor((p - origin) / many)
    upto = F.least(group(F.coalesce("_next", last + 1) - 1 + reach), group(last))
    rows = pieces.withColumn("_group", F.explode(F.sequence(group(piece), upto)))
    first = F.col("_group") * many + origin
    # a chunk that begins behind this piece has its last known value before it
    before = F.when(first - reach <= piece, F.col("_before")).otherwise(F.coalesce("_last_known", "_before"))
    rows = rows.groupBy(*keys, "_group").agg(
        F.min_by(before, piece).alias("_before"), F.max_by(F.col("_after"), piece).alias("_after"), F.min("_start").alias("_start"), F.min("_end").alias("_end")
    )
    begins = lambda p: p * (panel.chunk_rows * step) + F.pmod("_start", F.lit(step))
    return rows.select(
        *keys, F.col("_group").alias("_chunk"), "_start", "_end", "_before", "_after", F.greatest("_start", begins(first - reach)).alias("_from"),
        F.least(F.col("_end"), begins(first + many) - step).alias("_until"), begins(first).alias("_own_from"),
        (group(chunk_of(F.col("_start"), step, panel.chunk_rows)) == group(last)).alias("_whole"),
    )


def _line(fill: str, p: Column, n: Column, first: Column, last: Column) -> Column:
    """A stretch of steps to fill between two known points."""
    if fill == "linear":
        between = p.isNotNull() & n.isNotNull()
        base = F.coalesce(p["v"], n["v"])
        slope = F.when(between, (n["v"] - p["v"]) / (n["us"] - p["us"])).otherwise(0.0)
        origin = F.coalesce(p["us"], F.lit(0).cast("long"))
    else:
        base = F.coalesce(p["v"], n["v"]) if fill == "ffill" else F.coalesce(n["v"], p["v"])
        slope, origin = F.lit(0.0), F.lit(0).cast("long")
    return F.struct(first.alias("first"), last.alias("last"), base.alias("base"), slope.alias("slope"), origin.alias("origin"))


def parts(df: DataFrame, panel: Panel = HOURLY, fill: str = "linear", **how) -> list[tuple[DataFrame, Panel]]:
    """The filled grid in parts for operators that need a series whole: the dealt rows of series that are, and where there are others, theirs as a plain panel."""
    rows, dealt, longer = deal(df, panel, fill, **how)
    if not longer:
        return [(rows.drop("_whole"), dealt.on(whole=True))]
    return [(rows.where("_whole and _own").drop("_whole"), dealt.on(whole=True)), (rows.where("not _whole and _own").drop("_chunk", "_own", "_whole"), panel.on(full=True))]


def over_parts(made: list[tuple[DataFrame, Panel]], operator) -> DataFrame:
    """``operator(rows, panel)`` of each part, together."""
    out = None
    for rows, panel in made:
        one = operator(rows, panel)
        out = one if out is None else out.unionByName(one)
    return out


def _gaps(df: DataFrame, panel: Panel) -> DataFrame:
    return _present(df, panel, raise_on_duplicate=False).where(F.col("_next") > F.col("_us") + panel.step_us)


def missing_timestamps(df: DataFrame, panel: Panel = HOURLY) -> DataFrame:
    """Grid timestamps without a row, one row each."""
    step = panel.step_us
    blocks, within = _spread(F.col("_us") + step, F.col("_next") - step, step)
    return (
        _gaps(df, panel)
        .withColumn("_block", F.explode(blocks))
        .withColumn("_at", F.explode(within(F.col("_block"))))
        .select(*panel.keys, F.timestamp_micros("_at").alias(panel.ts))
    )


def gap_islands(df: DataFrame, panel: Panel = HOURLY) -> DataFrame:
    """Runs of missing timestamps: first, last and how many."""
    step = panel.step_us
    return _gaps(df, panel).select(
        *panel.keys,
        F.timestamp_micros(F.col("_us") + step).alias("gap_start"),
        F.timestamp_micros(F.col("_next") - step).alias("gap_end"),
        ((F.col("_next") - F.col("_us")) / step - 1).cast("long").alias("n_missing"),
    )


def resample(df: DataFrame, panel: Panel, unit: str, aggregates: dict[str, Column] | None = None) -> DataFrame:
    """Aggregate to calendar buckets (``hour``, ``day``, ...) or a length such as ``6 hours``."""
    value = F.col(panel.value)
    if panel.dealt is not None and aggregates is None and bucket_us(panel, unit):
        return _resampled(df, panel, bucket_us(panel, unit))
    df, panel = undealt(df, panel)
    aggregates = aggregates or {panel.value: F.avg(value)}
    if " " in unit:
        bucket = F.window(panel.ts, unit)["start"]
    else:
        bucket = F.date_trunc(unit, F.col(panel.ts))
    return df.groupBy(*panel.keys, bucket.alias(panel.ts)).agg(*[c.alias(n) for n, c in aggregates.items()])


def bucket_us(panel: Panel, unit: str) -> int:
    """The microseconds of a length that cuts no chunk of dealt rows, else 0."""
    length = int(pd.Timedelta(unit) // pd.Timedelta(1, "us")) if " " in unit else 0
    return length if length and panel.chunk_rows * panel.step_us % length == 0 else 0


def _resampled(df: DataFrame, panel: Panel, length: int) -> DataFrame:
    """Means of the buckets of dealt rows, which stay dealt: neighbouring rows are added as they stream by."""
    names = [*panel.keys, panel.ts, panel.value, "_chunk", "_own"]
    schema = T.StructType([T.StructField(panel.value, T.DoubleType()) if c == panel.value else df.schema[c] for c in names])

    def work(batch, starts):
        columns = {c: batch.column(batch.schema.get_field_index(c)) for c in names}
        v, us = doubles(columns[panel.value]), columns[panel.ts].cast(pa.int64()).to_numpy()
        bucket = us // length
        new = np.zeros(batch.num_rows, bool)
        new[starts] = True
        new[1:] |= bucket[1:] != bucket[:-1]
        at = np.flatnonzero(new)
        known = ~np.isnan(v)
        n = np.add.reduceat(known.astype(np.int64), at)
        mean = np.add.reduceat(np.where(known, v, 0.0), at) / np.maximum(n, 1)
        columns = {c: a.take(pa.array(at)) for c, a in columns.items()}
        columns[panel.ts] = pa.array(bucket[at] * length).cast(columns[panel.ts].type)
        columns[panel.value] = nullable(mean, n > 0)
        return pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    return by_group(df.select(*names), [*panel.keys, "_chunk"], schema, work)
