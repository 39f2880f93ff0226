"""From raw documents to packed training sequences: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import exact, jaccard, mixing, packing, quality
from tidewatch.llm.common import ready, table
from tidewatch.session import materialise

# of the tokens expected toxic after the stages before; all other documents stay
WEIGHTS = {"toxic": 0.8}
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id", "quality AS label")
    return quality.keep_good(docs.select(*DOCUMENT), labels)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_exact(docs.select(*DOCUMENT))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs.select(*DOCUMENT))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.resample(docs.select(*DOCUMENT), mixing.label_domains(table(spark, sf_dir, "labels")), WEIGHTS, relative=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", distinct_documents),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources to target weights", mixed),
    ("packing", packed),
]
ORACLE_SQL = None  # SQL cannot express the classifier


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(ready(spark), docs, sf_dir), name.replace(" ", "-"))
    return docs
