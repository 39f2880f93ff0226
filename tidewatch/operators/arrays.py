"""Sums of arrays per key, entry by entry, without exploding them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BUNDLE = 64  # first-level sums join the arrays of so many partitions


def matrix(column: pa.Array) -> np.ndarray:
    """A list column whose lists have one length, as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def runs(batch: pa.RecordBatch, names: list[str]) -> list[tuple[tuple, int, int]]:
    """Key, first row and end of each stretch of rows with one key; nulls are equal."""
    n = batch.num_rows
    if not n:
        return []
    change = np.zeros(n, bool)
    change[0] = True
    for c in names:
        codes = batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy()
        change[1:] |= codes[1:] != codes[:-1]
    starts = np.flatnonzero(change)
    keys = [batch.column(c).take(pa.array(starts)).to_pylist() for c in names]
    keys = list(zip(*keys, strict=True)) if names else [()]
    return list(zip(keys, starts.tolist(), [*starts[1:].tolist(), n], strict=True))


def by_group(rows: DataFrame, names, schema, work) -> DataFrame:
    """``work(batch, starts)`` over rows whose groups stand together; a batch holds whole groups, which begin at ``starts``.

    Nothing is shuffled or sorted: rows must already stand so, as they do after ``deal``. A task holds an Arrow batch and one group.
    """
    names = list(names)

    def run(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            b = b if held is None else pa.concat_batches([held, b])
            starts = np.array([at for _, at, _ in runs(b, names)])
            if starts[-1]:
                yield work(b.slice(0, starts[-1]), starts[:-1])
            held = b.slice(starts[-1])
        if held is not None:
            yield work(held, np.zeros(1, int))

    return rows.mapInArrow(run, schema)


def offsets(starts: np.ndarray, rows: int) -> np.ndarray:
    """Each row's place in its group."""
    return np.arange(rows) - np.repeat(starts, np.diff(np.append(starts, rows)))


def doubles(column: pa.Array) -> np.ndarray:
    """A column as doubles, null as NaN."""
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False)


def nullable(values: np.ndarray, known: np.ndarray) -> pa.Array:
    return pa.array(values, mask=~known)


def add_arrays(parts: DataFrame, keys, value: str) -> DataFrame:
    """One array per key: the sums of the arrays in ``value``, entry by entry.

    Rows of one key arrive sorted and are added as they stream by, so a task holds one sum and one Arrow batch. Two levels: a key's
    arrays are first added for every ``BUNDLE`` neighbouring partitions, then over those, so that no task reads one array per
    partition of the input. Arrays of one key have one length and no null entries; null keys are a key.
    """
    keys = list(keys)
    held = parts.withColumn("_bundle", F.floor(F.spark_partition_id() / BUNDLE))
    for names in ([*keys, "_bundle"], keys):
        dealt = held.repartition(*names) if names else held.repartition(1)
        if names:
            dealt = dealt.sortWithinPartitions(*names)
        schema = dealt.select(*names, value).schema
        held = dealt.select(*names, value).mapInArrow(_adder(names, value), schema)
    return held


def _adder(names: list[str], value: str):
    def run(batches):
        now, total, like = None, None, None

        def emit():
            keys = [pa.array([k], like.field(i).type) for i, k in enumerate(now)]
            return pa.RecordBatch.from_arrays([*keys, pa.array([total.tolist()], like.field(len(names)).type)], schema=like)

        for b in batches:
            like = b.schema
            for key, at, end in runs(b, names):
                part = matrix(b.column(value).slice(at, end - at)).sum(0)
                if total is not None and key == now:
                    total = total + part
                else:
                    if total is not None:
                        yield emit()
                    now, total = key, part
        if total is not None:
            yield emit()

    return run
