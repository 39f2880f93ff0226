"""Windows over long series in bounded pieces.

A ROWS window partitioned by series alone puts a whole series in one task.
Here a series is cut along its axis into chunks; each row is also copied to
the neighbouring chunk when that chunk's windows reach back (or ahead) to it.
Windows then partition by (keys, chunk), and only a chunk's own rows are kept.
Windows count rows, so rows are ranked first and cut by rank; where the panel
is said to be full, n rows back is n steps back and time serves as the rank.
Key columns and times are not null, as in the series table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidewatch.operators.arrays import by_group, doubles, nullable, offsets
from tidewatch.schemas import Panel
from tidewatch.session import materialise


def axis_of(df: DataFrame, panel: Panel) -> tuple[Column, int]:
    """The ordering column as a long, and the length of one step on it.

    A timestamp is counted in microseconds; an integer position in ones.
    """
    if isinstance(df.schema[panel.ts].dataType, T.TimestampType):
        return F.unix_micros(F.col(panel.ts)), panel.step_us
    return F.col(panel.ts).cast("long"), 1


def chunk_of(axis: Column, step: int, chunk_rows: int) -> Column:
    return F.floor(axis / F.lit(step * chunk_rows)).cast("long")


def by_chunk(rows: DataFrame, panel: Panel) -> DataFrame:
    """Shuffle rows by (keys, chunk).

    Said explicitly, because a window over (keys, chunk) is also content with
    rows already partitioned by the keys alone, and a long series would then
    stay in one task.
    """
    return rows.repartition(*panel.keys, "_chunk")


def join_by_chunk(rows: DataFrame, per_chunk: DataFrame, keys, on: str = "_chunk", how: str = "inner") -> DataFrame:
    """Join one small row per (keys, chunk) to the rows of that chunk.

    Both sides shuffle by (keys, chunk), which the windows after it need
    anyway; the hint keeps the rows from being sorted for the join, and from
    being the broadcast side when they are few.
    """
    return rows.join(per_chunk.hint("shuffle_hash"), [*keys, on], how)


def chunked(df: DataFrame, panel: Panel, back: int, ahead: int = 0) -> DataFrame:
    """Add ``_chunk`` and ``_own``, copying the rows neighbouring chunks need."""
    if panel.full:
        axis, step = axis_of(df, panel)
    else:
        df = _ranked(df, panel, "_pos", "_n").drop("_n")
        axis, step = F.col("_pos"), 1
    rows = max(panel.chunk_rows, back, ahead, 1)
    own = chunk_of(axis, step, rows)
    inside = F.pmod(axis, F.lit(step * rows))
    targets = [own]
    if back:
        targets.append(F.when(inside >= (rows - back) * step, own + 1))
    if ahead:
        targets.append(F.when(inside < ahead * step, own - 1))
    if len(targets) == 1:
        return by_chunk(df.withColumn("_chunk", own).withColumn("_own", F.lit(True)).drop("_pos"), panel)
    out = df.withColumn("_home", own).withColumn("_chunk", F.explode(F.array_compact(F.array(*targets))))
    return by_chunk(out.withColumn("_own", F.col("_chunk") == F.col("_home")).drop("_home", "_pos"), panel)


def chunk_window(panel: Panel):
    return Window.partitionBy(*panel.keys, "_chunk").orderBy(panel.ts)


def own_rows(df: DataFrame) -> DataFrame:
    return df.where("_own").drop("_own", "_chunk")


def positions(df: DataFrame, panel: Panel) -> DataFrame:
    """Add ``pos`` (0-based rank along the axis) and ``n`` (rows of the series).

    Ranks come from row counts per chunk: the running total over a series'
    chunks plus the rank inside the chunk.
    """
    return _ranked(df, panel, "pos", "n")


def _ranked(df: DataFrame, panel: Panel, pos: str, n: str) -> DataFrame:
    axis, step = axis_of(df, panel)
    rows = df.withColumn("_chunk", chunk_of(axis, step, panel.chunk_rows))
    keys = list(panel.keys)
    counts = materialise(rows.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_count")), "chunks")
    counts = across_chunks(counts, keys, panel.chunk_rows, {"_before": ("before", "_count"), n: ("sum", "_count")})
    rank = F.row_number().over(chunk_window(panel)) - 1
    return (
        join_by_chunk(rows, counts.drop("_count"), keys)
        .withColumn(pos, F.col("_before") + rank)
        .drop("_before", "_chunk")
    )


# ---------------------------------------------------------------- summaries of chunks

_WHOLE = {"before": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def _nearest(function: str, column: str, keys, order: str) -> Column:
    by = ", ".join(f"`{k}`" for k in keys)
    return F.expr(f"{function}(`{column}`) ignore nulls over (partition by {by} order by `{order}`)")


def across_chunks(per_chunk: DataFrame, keys, group: int, wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """Add to one row per (keys, ``_chunk``) what the other chunks of its series hold.

    ``wanted`` names each new column by how it is found and the column it is
    found in: ``sum``, ``min`` and ``max`` of the whole series, ``before`` (sum
    over earlier chunks, 0 for the first), ``last_before`` and ``first_after``
    (nearest value that is not null in an earlier or later chunk).

    A very long series has many chunks, so these run in two levels: ``group``
    neighbouring chunks are summed up in one row, a window over those rows
    gives what lies outside each group, and a window per group adds the rest.
    A task holds the chunks of one group, or one row per group of a series.
    ``per_chunk`` is read twice: callers store it, so that the rows are not.
    """
    keys = list(keys)
    inside = [*keys, "_group"]
    rows = per_chunk.withColumn("_group", chunk_of(F.col("_chunk"), 1, group))
    known = lambda c: F.when(F.col(c).isNotNull(), F.col("_chunk"))
    parts = []
    for name, (how, c) in wanted.items():
        if how in _WHOLE:
            parts.append(_WHOLE[how](c).alias(f"_of_{name}"))
        else:
            parts.append((F.max_by if how == "last_before" else F.min_by)(F.col(c), known(c)).alias(f"_of_{name}"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    outside = {
        "before": lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0)),
        "last_before": lambda c: _nearest("lag", c, keys, "_group"),
        "first_after": lambda c: _nearest("lead", c, keys, "_group"),
        **{how: lambda c, f=f: f(c).over(whole) for how, f in _WHOLE.items() if how != "before"},
    }
    groups = rows.groupBy(*inside).agg(*parts).select(*inside, *[outside[how](f"_of_{name}").alias(f"_of_{name}") for name, (how, _) in wanted.items()])
    earlier = Window.partitionBy(*inside).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    within = {
        "before": lambda c, out: out + F.coalesce(F.sum(c).over(earlier), F.lit(0)),
        "last_before": lambda c, out: F.coalesce(_nearest("lag", c, inside, "_chunk"), out),
        "first_after": lambda c, out: F.coalesce(_nearest("lead", c, inside, "_chunk"), out),
    }
    joined = rows.join(groups, inside)
    made = [within.get(how, lambda _, out: out)(c, F.col(f"_of_{name}")).alias(name) for name, (how, c) in wanted.items()]
    return joined.select(*per_chunk.columns, *made)


# ---------------------------------------------------------------- rolling

_PARTS = {"mean": {"n", "s"}, "std": {"n", "s", "q"}, "min": {"lo"}, "max": {"hi"}, "count": {"n"}, "sum": {"n", "s"}}


def _single(x: Column, parts) -> dict[str, Column]:
    """Count, sum, squared deviation, least and greatest of a one-row frame."""
    made = {
        "n": F.when(x.isNotNull(), F.lit(1)).otherwise(F.lit(0)), "s": F.coalesce(x, F.lit(0.0)),
        "q": F.lit(0.0), "lo": x, "hi": x,
    }
    return {p: made[p] for p in parts}


def _merge(pieces: list[dict[str, Column]], parts) -> dict[str, Column]:
    """The same of several frames together; deviations are taken from the joint mean."""
    total = lambda p: sum((c[p] for c in pieces[1:]), pieces[0][p])
    out = {}
    if "n" in parts:
        out["n"] = total("n")
    if "s" in parts:
        out["s"] = total("s")
    if "q" in parts:
        mean = out["s"] / F.greatest(out["n"], F.lit(1))
        shift = [F.when(c["n"] > 0, (c["s"] - c["n"] * mean) * (c["s"] - c["n"] * mean) / c["n"]).otherwise(0.0) for c in pieces]
        out["q"] = sum(shift, total("q"))
    if "lo" in parts:
        out["lo"] = F.least(*[c["lo"] for c in pieces])
    if "hi" in parts:
        out["hi"] = F.greatest(*[c["hi"] for c in pieces])
    return out


def _steps(widths) -> list[int]:
    """Widths to build in order, so that each is at most four of an earlier one."""
    plan = []
    for width in sorted(set(widths)):
        top = plan[-1] if plan else 1
        while width > 4 * top:
            top *= 2
            plan.append(top)
        if width > 1 and width not in plan:
            plan.append(width)
    return plan


def rolling(df: DataFrame, window, value: str, widths, stats, shift: int = 0) -> DataFrame:
    """Add ``_{stat}_{width}`` for trailing row windows ending ``shift`` rows back.

    A frame of width w is merged from two to four already built narrower
    frames read with ``lag``, so a row costs a handful of merges instead of
    one update per row in the frame. Frames are added up and never subtracted,
    so no precision is lost to cancellation.
    Nulls are skipped; an empty frame gives null, ``std`` of one value is null.
    """
    parts = sorted(set().union(*(_PARTS[s] for s in stats)))
    kept = list(df.columns)
    x = F.col(value)
    if shift:
        df, x = df.select("*", F.lag(x, shift).over(window).alias("_base")), F.col("_base")
    of = lambda width, at=0: {p: F.col(f"_{width}_{p}" + (f"_{at}" if at else "")) for p in parts}
    df = df.select("*", *[c.alias(f"_1_{p}") for p, c in _single(x, parts).items()])
    built, read, nothing = [1], set(), {"n": F.lit(0), "s": F.lit(0.0), "q": F.lit(0.0)}
    for width in _steps(widths):
        pieces, offset = [], 0
        while offset < width:
            part = max(b for b in built if b <= width - offset)
            pieces.append((part, offset))
            offset += part
        lagged = []
        for part, at in pieces:
            for p in parts if at and (part, at) not in read else ():
                c = F.lag(f"_{part}_{p}", at).over(window)
                lagged.append((F.coalesce(c, nothing[p]) if p in nothing else c).alias(f"_{part}_{p}_{at}"))
        read.update(pieces)
        df = df.select("*", *lagged)
        merged = _merge([of(part, at) for part, at in pieces], parts)
        df = df.select("*", *[c.alias(f"_{width}_{p}") for p, c in merged.items()])
        built.append(width)

    made = []
    for width in sorted(set(widths)):
        c = of(width)
        for stat in stats:
            made.append({
                "mean": lambda: F.when(c["n"] > 0, c["s"] / c["n"]),
                "sum": lambda: F.when(c["n"] > 0, c["s"]),
                "std": lambda: F.when(c["n"] > 1, F.sqrt(c["q"] / (c["n"] - 1))),
                "min": lambda: c["lo"],
                "max": lambda: c["hi"],
                "count": lambda: c["n"],
            }[stat]().alias(f"_{stat}_{width}"))
    return df.select(*kept, *made)


# ---------------------------------------------------------------- rows from ``deal``

def stands(panel: Panel, back: int) -> bool:
    """Whether rows are dealt with at least ``back`` earlier ones."""
    return panel.dealt is not None and (panel.whole or panel.dealt >= back)


def undealt(df: DataFrame, panel: Panel) -> tuple[DataFrame, Panel]:
    """Own rows only, as a plain panel."""
    if panel.dealt is None:
        return df, panel
    return df.where("_own").drop("_chunk", "_own"), panel.on(dealt=None, whole=False)


def streamed(df: DataFrame, panel: Panel, widths, stats, shift: int = 0, lags=()) -> DataFrame:
    """Own rows of dealt ones with ``_lag_{k}`` and ``_{stat}_{width}``: the same frames and sums as in ``rolling``, added as rows stream by."""
    parts = sorted(set().union(set(), *(_PARTS[s] for s in stats)))
    whole = {"n": T.LongType(), "count": T.LongType()}
    made = [T.StructField(f"_lag_{k}", T.DoubleType()) for k in lags]
    made += [T.StructField(f"_{s}_{w}", whole.get(s, T.DoubleType())) for w in sorted(set(widths)) for s in stats]
    kept = [c for c in df.columns if c != "_own"]
    value, steps = panel.value, _steps(widths)

    def work(batch, starts):
        rows = batch.num_rows
        at, own = offsets(starts, rows), batch.column(batch.schema.get_field_index("_own")).to_numpy(zero_copy_only=False).astype(bool)
        x = doubles(batch.column(batch.schema.get_field_index(value)))

        def lag(a, k, nothing):
            out = np.full(rows, nothing, a.dtype)
            if 0 < k < rows:
                out[k:] = a[:-k]
                out[at < k] = nothing
            return out if k else a

        columns = [lag(x, k, np.nan)[own] for k in lags]
        columns = [nullable(c, ~np.isnan(c)) for c in columns]
        of = _summed(lag(x, shift, np.nan) if shift else x, steps, parts, lag) if widths else {}
        for width in sorted(set(widths)):
            c = {p: a[own] for p, a in of[width].items()}
            for stat in stats:
                with np.errstate(invalid="ignore", divide="ignore"):
                    columns.append({
                        "mean": lambda: nullable(c["s"] / c["n"], c["n"] > 0),
                        "sum": lambda: nullable(c["s"], c["n"] > 0),
                        "std": lambda: nullable(np.sqrt(c["q"] / (c["n"] - 1)), c["n"] > 1),
                        "min": lambda: nullable(c["lo"], np.isfinite(c["lo"])),
                        "max": lambda: nullable(c["hi"], np.isfinite(c["hi"])),
                        "count": lambda: pa.array(c["n"].astype(np.int64)),
                    }[stat]())
        mask = pa.array(own)
        same = [batch.column(batch.schema.get_field_index(c)).filter(mask) for c in kept]
        return pa.RecordBatch.from_arrays([*same, *columns], names=[*kept, *[f.name for f in made]])

    schema = T.StructType([*[df.schema[c] for c in kept], *made])
    return by_group(df, [*panel.keys, "_chunk"], schema, work).drop("_chunk")


def _summed(x: np.ndarray, steps: list[int], parts, lag) -> dict[int, dict[str, np.ndarray]]:
    """``_single`` and ``_merge`` on arrays: the parts of the trailing frames of each width."""
    known = ~np.isnan(x)
    first = {
        "n": known.astype(float), "s": np.where(known, x, 0.0), "q": np.zeros(len(x)),
        "lo": np.where(known, x, np.inf), "hi": np.where(known, x, -np.inf),
    }
    nothing = {"n": 0.0, "s": 0.0, "q": 0.0, "lo": np.inf, "hi": -np.inf}
    built = {1: {p: first[p] for p in parts}}
    for width in steps:
        pieces, offset = [], 0
        while offset < width:
            part = max(b for b in built if b <= width - offset)
            pieces.append({p: lag(built[part][p], offset, nothing[p]) for p in parts})
            offset += part
        out = {}
        for p in ("n", "s"):
            if p in parts:
                out[p] = sum((c[p] for c in pieces[1:]), pieces[0][p])
        if "q" in parts:
            mean = out["s"] / np.maximum(out["n"], 1)
            out["q"] = sum((c["q"] for c in pieces[1:]), pieces[0]["q"])
            for c in pieces:
                out["q"] = out["q"] + (c["s"] - c["n"] * mean) ** 2 / np.maximum(c["n"], 1)
        for p, pick in (("lo", np.minimum), ("hi", np.maximum)):
            if p in parts:
                out[p] = pieces[0][p]
                for c in pieces[1:]:
                    out[p] = pick(out[p], c[p])
        built[width] = out
    return built
