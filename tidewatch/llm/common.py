"""Settings, stored stages and connected components shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.session import materialise, prepare

# Rows of one Arrow batch: with texts of up to some hundred kilobytes a batch stays well under a task's memory.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def ready(spark: SparkSession) -> SparkSession:
    prepare(spark)
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, parts: int) -> Column:
    """The document's fold: crc32 of its id as text, modulo ``parts``. A null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts, F.lit(0))


def bounded(df: DataFrame, rows: int, on: str, seed: int) -> DataFrame:
    """All rows if there are at most ``rows``, else about that many, chosen by a hash of ``on``."""
    n = df.count()
    if n <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit(seed), F.col(on)), F.lit(1 << 30)) < int((1 << 30) * rows / n))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component`` (its smallest reachable node) for every node of an edge; needs no self-links.

    Alternating large-star and small-star steps: each reconnects a node's neighbours to the smallest of them, so the
    number of rounds grows with the logarithm of a path's length. Every step is a grouped minimum and a join on the node,
    both safe for a hot node; each round is stored, so that a lost executor costs one round.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    edges = materialise(edges, "edges")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.where("u != v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
        edges = materialise(small.where("u != v").distinct(), "small")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.countDistinct("u")).first()
        if state[0] == state[2] and before == state[:2]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state[:2]
