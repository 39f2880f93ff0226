"""Near-duplicate vectors through a pivot-permutation index.

Of ``SAMPLE`` vectors drawn by a hash (a bounded sample), at most ``PIVOTS`` become reference points, none as similar as
``APART`` to another: else a large group would have many pivots of its own and noise would order them. A vector is described by its ``NEAREST`` nearest pivots; its
entries in the inverted lists are all pairs of these, so two vectors meet where they share at least two pivots. Lists of one are
dropped. A pair that shares more is looked at in one list only, that of its two smallest shared pivots. Long lists are cut
into blocks of about ``BLOCK``, each pair of blocks is one matrix product, and a block returns sums and one link per vector to the
smallest of its component there: pairs are counted, never listed. Cosines are in double precision, so no link below the threshold is
reported; recall is that of the index (measured in the tests and README). Up to ``2 * NEAREST - 2`` pivots any two vectors share two, so
that all pairs are compared; where the whole sample is as similar as ``APART`` to one pivot, all vectors are in one list.

Equal vectors are one node with a count. Vectors that are null, empty, zero, hold null or non-finite components, or have
another length than most, link with nothing. A null id keeps its row. Rows of one id are counted each. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import components, ready, table
from tidewatch.session import materialise

SAMPLE, PIVOTS, APART, NEAREST, BLOCK, COSINE = 4096, 512, 0.5, 6, 256, 0.9


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows scaled to length 1."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)  # so that squares stay finite
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` most similar pivots of each row, nearest first; equal similarity goes to the smaller number."""
    near = vectors @ pivots.T
    k = min(k, len(pivots))
    return np.argsort(-near, axis=1, kind="stable")[:, :k] if near.shape[1] <= 4 * k else np.take_along_axis(
        part := np.sort(np.argpartition(-near, k - 1, axis=1)[:, :k], axis=1), np.argsort(-np.take_along_axis(near, part, axis=1), axis=1, kind="stable"), axis=1
    )


def apart(sample: np.ndarray, most: int, cosine: float = APART) -> np.ndarray:
    """The first vectors of the sample of which no two are as similar as ``cosine``."""
    chosen = np.empty((most, sample.shape[1]))
    n = 0
    for v in sample:
        if n < most and (n == 0 or (chosen[:n] @ v).max() < cosine):
            chosen[n] = v
            n += 1
    return chosen[:n]


def entries(nodes: DataFrame, pivots: np.ndarray, k: int, dim: int) -> DataFrame:
    """``node``, ``p``, ``q`` (two of its nearest pivots, p < q) and ``near`` (all of them)."""
    shipped = nodes.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        for b in batches:
            near = np.sort(nearest_pivots(matrix(b.column("vector"), dim), shipped.value, k), axis=1)
            i, j = np.triu_indices(near.shape[1], 1)
            flat = near.astype(np.int32)
            lists = pa.ListArray.from_arrays(np.arange(0, flat.size + 1, flat.shape[1], dtype=np.int32), flat.ravel())
            take = pa.array(np.repeat(np.arange(b.num_rows), len(i)))
            yield pa.RecordBatch.from_arrays([b.column("node").take(take), pa.array(flat[:, i].ravel()), pa.array(flat[:, j].ravel()), lists.take(take)], ["node", "p", "q", "near"])

    return nodes.select("node", "vector").mapInArrow(run, "node long, p int, q int, near array<int>")


def compare(blocks: DataFrame, dim: int, cosine: float) -> DataFrame:
    """For each pair of blocks: ``node``, ``links`` (rows linked, by their counts) and ``least`` (a node of its component)."""
    def one(g: pa.RecordBatch):
        x = matrix(g.column("vector"), dim)
        node, count = g.column("node").to_numpy(), g.column("m").to_numpy()
        side = g.column("block").to_numpy()
        near = g.column("near").flatten().to_numpy().reshape(g.num_rows, -1)
        q, bi, bj = (g.column(c)[0].as_py() for c in ("q", "bi", "bj"))
        a, b = np.flatnonzero(side == bi), np.flatnonzero(side == bj)
        linked = x[a] @ x[b].T >= cosine
        linked &= node[a][:, None] != node[b][None, :]
        # of all shared pivots q must be the second smallest, else another list has the pair
        low = np.where(near < q, near, -1)
        shared = np.zeros(linked.shape, np.int32)
        for s in range(near.shape[1]):
            mine = low[a, s][:, None]
            for t in range(near.shape[1]):
                shared += (mine == low[b, t][None, :]) & (mine >= 0)
        here = linked & (shared == 1)
        total = np.zeros(len(node), np.int64)
        total[a] += here @ count[b]
        if bi != bj:
            total[b] += here.T @ count[a]
        label = node.copy()
        while True:
            before = label.copy()
            big = np.iinfo(np.int64).max
            label[a] = np.minimum(label[a], np.where(linked, label[b][None, :], big).min(axis=1, initial=big))
            label[b] = np.minimum(label[b], np.where(linked, label[a][:, None], big).min(axis=0, initial=big))
            if (label == before).all():
                break
        hit = (total > 0) | (label != node)
        return pa.RecordBatch.from_arrays([pa.array(node[hit]), pa.array(total[hit]), pa.array(label[hit])], ["node", "links", "least"])

    def run(batches):
        held: pa.RecordBatch | None = None
        for b in batches:
            held = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            change = np.zeros(held.num_rows, bool)
            for c in ("p", "q", "bi", "bj"):
                v = held.column(c).to_numpy()
                change[1:] |= v[1:] != v[:-1]
            cuts = [0, *np.flatnonzero(change).tolist()]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                yield one(held.slice(lo, hi - lo))
            held = held.slice(cuts[-1])
        if held is not None and held.num_rows:
            yield one(held)

    return blocks.select("p", "q", "bi", "bj", "block", "node", "m", "near", "vector").mapInArrow(run, "node long, links long, least long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, n_pivots: int = PIVOTS, nearest: int = NEAREST, block: int = BLOCK) -> DataFrame:
    """Per row ``vec_id``, ``n_links``, ``component_id``, ``kept``; ``vectors`` has vec_id and embedding."""
    ready(vectors.sparkSession)
    v = F.transform("embedding", lambda x: x.cast("double"))
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select("vec_id", v.alias("vector"), (F.coalesce(odd, F.lit(True)) | ~F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))).alias("odd"))
    sizes = rows.where("not odd").groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dim = sizes.n if sizes else 0
    good = rows.where(f"not odd and size(vector) = {dim}")
    # -0.0 and 0.0 are one component value
    good = good.select("vec_id", F.transform("vector", lambda x: x + F.lit(0.0)).alias("vector"))
    nodes = good.groupBy("vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("m"))
    nodes = materialise(nodes.select(F.xxhash64("vector").alias("node"), "first", "m", "vector"), "nodes")
    # a node is named by the hash of its vector; of two vectors with one hash each gets another name
    twice = nodes.groupBy("node").count().where("count > 1").select("node")
    if not twice.isEmpty():
        nodes = materialise(nodes.join(twice.withColumn("again", F.lit(True)), "node", "left").withColumn("node", F.when(F.col("again"), F.xxhash64(F.lit(1), "vector")).otherwise(F.col("node"))).drop("again"), "nodes")
    sample = nodes.orderBy(F.xxhash64(F.lit(41), "node"), "node").limit(SAMPLE).select("vector").collect()
    if not sample:
        return vectors.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    pivots = np.array([r.vector for r in sample])
    pivots /= np.abs(pivots).max(axis=1, keepdims=True)
    pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)
    pivots = apart(pivots, n_pivots)
    if len(pivots) == 1:  # taken twice, so that all vectors are in the one list of the pair
        pivots = np.repeat(pivots, 2, axis=0)

    listed = materialise(entries(nodes, pivots, nearest, dim), "entries")
    lists = listed.groupBy("p", "q").agg(F.count("*").alias("size")).where("size > 1")
    listed = listed.join(lists, ["p", "q"]).join(nodes.select("node", "m", "vector"), "node")
    cut = F.ceil(F.col("size") / block).cast("int")
    listed = listed.withColumn("cut", cut).withColumn("block", F.pmod(F.xxhash64(F.lit(5), "node"), F.col("cut")).cast("int"))
    listed = listed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
    listed = listed.withColumns({"bi": F.least("block", "other"), "bj": F.greatest("block", "other")})
    listed = listed.repartition("p", "q", "bi", "bj").sortWithinPartitions("p", "q", "bi", "bj")
    found = materialise(compare(listed, dim, cosine), "block-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.where("node != least").select(F.col("node").alias("a"), F.col("least").alias("b")))

    placed = nodes.select("node", "first", "m").join(links, "node", "left").join(groups, "node", "left")
    placed = materialise(placed.select("node", "first", "m", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("root")), "placed")
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    told = placed.join(least, "root").select("node", (F.col("links") + F.col("m") - 1).alias("n_links"), "component_id")
    # the node of a row is found by its vector, as the nodes were named
    keyed = good.join(materialise(nodes.select("node", F.col("vector").alias("_v")).join(told, "node").drop("node"), "told"), F.col("vector") == F.col("_v"))
    linked = keyed.select("vec_id", "n_links", "component_id")
    alone = rows.where(f"odd or size(vector) != {dim}").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op1_pivot_permutation(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
