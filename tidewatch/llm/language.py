"""Language by multinomial naive Bayes over hashed character n-grams.

Executors count byte 2- and 3-grams of the lower-cased training texts by language and bucket; Spark sums the counts over all
training documents, and the driver gets one number for each language and bucket. The matrix of log probabilities is broadcast
(languages x ``2 ** BITS`` floats, at most ``MOST`` languages) and texts are scored in batches: the sparse row of a text
is the sum of its n-grams' columns. The score is the posterior of the chosen language, with the text counted as at most
``EVIDENCE`` n-grams, since neighbouring n-grams are not independent. Digits and ASCII signs are left out.

Text that is null or has no letter gives ``und`` with score 0. Null languages are not learned; without training rows all are
``und``. Ties go to the first language by name. Repeated rows count as often as they occur; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import fold, table
from tidewatch.llm.text import blocks, grams, lowered, raw

BITS, SIZES, MOST, EVIDENCE = 14, (2, 3), 1000, 50.0
_KEEP = np.full(256, 32, np.uint8)
for _range in (range(65, 91), range(97, 123), range(128, 256)):
    _KEEP[list(_range)] = list(_range)


def counts(docs: DataFrame, lang: str = "lang") -> DataFrame:
    """``lang``, ``bucket``, ``n`` over all rows with text and language."""
    def run(batches):
        total: dict[str, np.ndarray] = {}
        for b in blocks(batches):
            names = b.column("lang").to_pylist()
            data, at = raw(b.column("text"))
            data = _KEEP[lowered(data)]
            kinds = sorted(set(names))
            code = np.array([kinds.index(x) for x in names])
            for where, bucket in grams(data, at, SIZES, BITS):
                owner = code[np.searchsorted(at, where, "right") - 1]
                for k, name in enumerate(kinds):
                    total[name] = total.get(name, 0) + np.bincount(bucket[owner == k], minlength=1 << BITS)
        for name, n in total.items():
            hit = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(hit), pa.string()), pa.array(hit.astype(np.int32)), pa.array(n[hit].astype(np.int64))], ["lang", "bucket", "n"])

    rows = docs.where(F.col(lang).isNotNull() & F.col("text").isNotNull()).select(F.col(lang).cast("string").alias("lang"), "text")
    return rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Language names in order, and the log probability of each bucket given each, smoothed by one half."""
    table_ = counts(docs, lang).where("n > 0")
    names = [r.lang for r in table_.select("lang").distinct().orderBy("lang").limit(MOST + 1).collect()]
    if len(names) > MOST:
        raise ValueError(f"more than {MOST} languages")
    matrix = np.full((len(names), 1 << BITS), 0.5)
    place = {x: k for k, x in enumerate(names)}
    for r in table_.toLocalIterator():
        matrix[place[r.lang], r.bucket] += r.n
    return names, np.log(matrix / matrix.sum(axis=1, keepdims=True)).astype(np.float32)


def log_likelihood(data: np.ndarray, at: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of log probabilities of each text under each language, and its number of n-grams."""
    data = _KEEP[lowered(data)]
    out = np.zeros((len(at) - 1, len(matrix)))
    number = np.zeros(len(at) - 1)
    for where, bucket in grams(data, at, SIZES, BITS):
        edge = np.searchsorted(where, at)
        number += np.diff(edge)
        for k, row in enumerate(matrix):
            run = np.concatenate(([0.0], np.cumsum(row[bucket], dtype=np.float64)))
            out[:, k] += run[edge[1:]] - run[edge[:-1]]
    return out, number


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` for every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        names, matrix = shipped.value
        for b in blocks(batches):
            text = b.column("text")
            letter = pc.match_substring_regex(text, r"\p{L}").fill_null(False).to_numpy(zero_copy_only=False)
            if not names:
                lang, score = ["und"] * b.num_rows, np.zeros(b.num_rows)
            else:
                total, number = log_likelihood(*raw(text), matrix)
                total *= (np.minimum(number, EVIDENCE) / np.maximum(number, 1))[:, None]
                p = np.exp(total - total.max(axis=1, keepdims=True))
                best = p.argmax(axis=1)
                score = np.where(letter, 1 / p.sum(axis=1), 0.0)
                lang = [names[k] if ok else "und" for k, ok in zip(best.tolist(), letter.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(fold("doc_id", 5) != 0).select("text", "lang"))
    return predict(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
