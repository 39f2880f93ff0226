"""Exact duplicates by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its content says so: after a line end, or after a sentence end before a capital in the first half of
the alphabet, at least ``least`` and at most ``most`` characters after the last cut. Chunks are de-duplicated over all
documents by a 64-bit hash and length, and each such identifier is verified: where its chunks have not all one SHA-256, the
digest becomes part of it. A document's recipe is its ordered list of identifiers, and equal texts are those with equal
recipes. Texts are read once and never shuffled: only digests (about 50 bytes for each kilobyte of text) move. The text's
own SHA-256 verifies every group.

Null text counts as empty; empty texts form one group with an empty recipe. A null ``doc_id`` is a document of its own id
and sorts lowest. Repeated rows are counted as rows of their group. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import ready, table
from tidewatch.session import materialise

LEAST, MOST = 512, 8192


def chunk_pattern(least: int = LEAST, most: int = MOST) -> str:
    return rf"(?s).{{{least},{most}}}?(?:\n|[.!?] (?=[A-M]))|.{{1,{most}}}"


def recipes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, most: int = MOST) -> DataFrame:
    """``doc_id``, ``text_sha256``, ``rows`` (equal rows of this id and text) and ``recipe`` (ordered chunk identifiers)."""
    ready(docs.sparkSession)
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    cut = F.transform(
        F.regexp_extract_all(body, F.lit(chunk_pattern(least, most)), F.lit(0)),
        lambda c: F.struct(F.unhex(F.sha2(c.cast("binary"), 256)).alias("digest"), F.length(c).alias("size"), F.xxhash64(c).alias("check")),
    )
    chunks = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.sha2(body.cast("binary"), 256).alias("text_sha256"), cut.alias("c"))
    chunks = materialise(chunks.select("doc_id", "text_sha256", F.posexplode_outer("c").alias("pos", "c")).select("doc_id", "text_sha256", "pos", "c.*"), "chunks")
    known = chunks.where("pos is not null").groupBy("check", "size").agg((F.min("digest") == F.max("digest")).alias("sure"))
    identifier = F.struct("pos", "check", "size", F.when(~F.col("sure"), F.col("digest")).alias("digest"))
    return chunks.join(known, ["check", "size"], "left").groupBy("doc_id", "text_sha256").agg(
        F.sort_array(F.collect_set(F.when(F.col("pos").isNotNull(), identifier))).alias("recipe"),
        F.sum(F.when(F.coalesce("pos", F.lit(0)) == 0, 1).otherwise(0)).alias("rows"),
    )


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, most: int = MOST) -> DataFrame:
    """One row per document row: ``doc_id``, ``keep_id`` (largest id of its equals), ``group_size``, ``kept``, ``text_sha256``."""
    listed = materialise(recipes(docs, doc_id, text, least, most), "recipes")
    groups = listed.groupBy("recipe", "text_sha256").agg(F.max("doc_id").alias("keep_id"), F.sum("rows").alias("group_size"))
    out = listed.join(groups, ["recipe", "text_sha256"])
    return out.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("_copy"),
    ).drop("_copy")


def drop_exact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without all but one of equal texts; the row with the largest id stays, with all its columns.

    Rows of a kept id and another text stay with their own group's verdict, since the digest is part of the key; of equal
    rows of one id one stays.
    """
    groups = exact_groups(docs, doc_id, text).where("kept").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("_n"))
    key = F.sha2(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary"), 256)
    keep = groups.select(F.col("doc_id").alias("_keep"), F.col("text_sha256").alias("_sha"), "_n")
    keep = materialise(keep, "kept")
    # the kept ids grow with the documents: joined by sorting at every size
    found = docs.withColumn("_text_sha", key).join(keep.hint("merge"), F.col(f"`{doc_id}`").eqNullSafe(F.col("_keep")) & (F.col("_text_sha") == F.col("_sha")))
    once = found.where("_n = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
    more = found.where("_n > 1").dropDuplicates(["_keep", "_sha"]).select(*[F.col(f"`{c}`") for c in docs.columns])
    return once.unionByName(more) if keep.where("_n > 1").limit(1).count() else once


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""
