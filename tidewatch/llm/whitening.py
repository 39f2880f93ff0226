"""Whitening of embeddings through the covariance of their distinct vectors.

Entries become integers (``floor(64 * c) + 1000000``), equal integer vectors are one row with a count, and everything else is done once per distinct
vector: integer sums per dimension, the covariance as one matrix product of centred rows times their weights per Arrow
batch, and the projection on the leading eigenvectors. The weights are the counts, so that the fit list is all vectors, or one
(``weight="one"``), which fits on distinct vectors. Results are joined back to the rows by the vector. A vector held by
more than a thousandth of all rows is joined by broadcast: there are fewer than a thousand of those at any size; the others
are shuffled, and none of them is hot.

Left out are vectors that are null or empty, hold null or non-finite entries, or have another length than most (the shorter one in a tie). Entries whose
integer would pass 2^40 are held there. Components whose eigenvalue is under 1e-10 of the greatest have no direction and are not
returned: for one vector, or equal ones, none. Repeated rows and ids, and null ids, are returned each. Other columns are ignored.
``deviation`` is exact, and null where it passes a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import ready, table
from tidewatch.operators.arrays import add_arrays, matrix
from tidewatch.session import materialise

SCALE, SHIFT, LIMIT, COMPONENTS, FLOOR, HOT = 64, 1_000_000, 1 << 40, 32, 1e-10, 1000


def integers(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``x``, the integer vector, of the rows that take part."""
    c = F.col(vector).cast("array<double>")
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = df.select(F.col(vec_id).alias("vec_id"), c.alias("c")).where(F.col("c").isNotNull() & (F.size("c") > 0) & finite)
    sizes = rows.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.where(F.size("c") == (sizes.d if sizes else 0))
    held = lambda v: F.least(F.greatest(v, F.lit(-float(LIMIT))), F.lit(float(LIMIT)))
    return rows.select("vec_id", F.transform("c", lambda v: F.floor(held(v * SCALE)).cast("long") + SHIFT).alias("x"))


def longs(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def sums(distinct: DataFrame, weight: str = "count") -> list:
    """Per dimension its number, exact weighted sum, least and greatest entry."""

    def run(batches):
        for b in batches:
            x, w = longs(b.column("x")), b.column("w").to_numpy()
            if len(x):
                # halves keep products with a count in a long
                high, low = x >> 20, x & ((1 << 20) - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, pa.int64()) for v in (np.arange(x.shape[1]), w @ high, w @ low, x.min(0), x.max(0))], ["i", "high", "low", "least", "most"]
                )

    rows = distinct.select("x", F.col(weight).alias("w")).mapInArrow(run, "i long, high long, low long, least long, most long")
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    found = rows.groupBy("i").agg(exact("high"), exact("low"), F.min("least").alias("least"), F.max("most").alias("most")).orderBy("i").collect()
    return [(int(r.high) * (1 << 20) + int(r.low), r.least, r.most) for r in found]


def centred_products(df: DataFrame, column: str, weight: str, centre: np.ndarray) -> np.ndarray:
    """Sum of weight * (v - centre)(v - centre)' over all rows; one partial matrix per task."""

    def run(batches):
        total = 0.0
        for b in batches:
            v = matrix(b.column(column)) - centre
            if len(v):
                total = total + (v * b.column("w").to_numpy()[:, None]).T @ v
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["g"])

    parts = df.select(column, F.col(weight).cast("double").alias("w")).mapInArrow(run, "g array<double>")
    return np.array(add_arrays(parts, [], "g").first().g).reshape(len(centre), -1)


def deviations(x: np.ndarray, n: int, total: list[int], reach: int) -> list:
    """Sum over dimensions of (n * x - S)^2 per row, exact; ``reach`` is a bound of |x - x'| in one dimension."""
    base = [round(s / n) for s in total]
    rest = [n * c - s for c, s in zip(base, total, strict=True)]
    near = x - np.array(base, np.int64)
    if x.shape[1] * (n * (reach + 1)) ** 2 < 1 << 62:
        return ((near * n + np.array(rest, np.int64)) ** 2).sum(1).tolist()
    exact = ((near.astype(object) * n + np.array(rest, object)) ** 2).sum(1).tolist()
    return [v if v < 1 << 63 else None for v in exact]


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, weight: str = "count") -> DataFrame:
    """``vec_id, whitened`` (an array), ``deviation`` and, the same on all rows, ``n, explained`` (an array), ``identity_error``."""
    ready(df.sparkSession)
    rows = integers(df, vec_id, vector)
    # pre-aggregated before the shuffle, so that copies of one vector are one row a task
    distinct = materialise(rows.groupBy("x").agg(F.count(F.lit(1)).alias("count")).withColumn("one", F.lit(1).cast("long")), "distinct-vectors")
    n = distinct.agg(F.sum(weight)).first()[0] or 0
    numbers = "n long, explained array<double>, identity_error double"
    if not n:
        return df.sparkSession.createDataFrame([], f"vec_id {df.schema[vec_id].dataType.simpleString()}, whitened array<double>, deviation long, {numbers}")
    per = sums(distinct, weight)
    total, reach = [s for s, _, _ in per], max(most - least for _, least, most in per)
    centre = np.array([s / n for s in total])
    covariance = centred_products(distinct, "x", weight, centre) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > FLOOR * max(values.max(), 0.0)]
    turn = vectors[:, order] / np.sqrt(values[order])
    explained = (values[order] / max(np.trace(covariance), 1e-300)).tolist()

    def project(batches):
        for b in batches:
            x = longs(b.column("x"))
            z = (x - centre) @ turn
            yield pa.RecordBatch.from_arrays(
                [b.column("x"), b.column("count"), b.column(weight), pa.array(z.tolist(), pa.list_(pa.float64())), pa.array(deviations(x, n, total, reach) if len(x) else [], pa.int64())],
                ["x", "count", "w", "whitened", "deviation"],
            )

    white = distinct.mapInArrow(project, "x array<long>, count long, w long, whitened array<double>, deviation long")
    white = materialise(white, "white-vectors")
    error = 0.0
    if len(order):
        means = white.where("w > 0").mapInArrow(_weighted_sum, "g array<double>")
        means = np.array(add_arrays(means, [], "g").first().g) / n
        error = float(np.abs(centred_products(white, "whitened", "w", means) / n - np.eye(len(order))).max())
    bar = max(distinct.agg(F.sum("count")).first()[0] // HOT, HOT)
    hot = F.broadcast(white.where(F.col("count") > bar).drop("w", "count"))
    cool = white.where(F.col("count") <= bar).drop("w", "count")
    back = rows.join(hot, "x").unionByName(rows.join(cool.hint("merge"), "x"))
    said = F.array(*[F.lit(e) for e in explained]).cast("array<double>")
    return back.select(
        "vec_id", "whitened", "deviation", F.lit(n).cast("long").alias("n"), said.alias("explained"), F.lit(error).alias("identity_error")
    )


def _weighted_sum(batches):
    for b in batches:
        if b.num_rows:
            z = b.column("w").to_numpy() @ matrix(b.column("whitened"))
            yield pa.RecordBatch.from_arrays([pa.array([z.tolist()], pa.list_(pa.float64()))], ["g"])


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    white = whiten(table(spark, sf_dir, "embeddings"))
    return white.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("i", "whitened")).select(
        "vec_id", (F.col("i") + 1).cast("int").alias("component"), "n", "deviation", "whitened", F.get("explained", F.col("i")).alias("explained"), "identity_error"
    )
