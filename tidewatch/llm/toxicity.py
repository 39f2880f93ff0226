"""Toxicity from subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

Character 3-, 4- and 5-grams of words (with their edges) are hashed to buckets; each bucket has a small vector. The vectors of
a segment of four words are averaged (over ``LEAST`` n-grams at least, so that a few do not decide alone) and a linear softmax gives the segment's probability, so an unseen misspelling is
scored by the n-grams it shares with known words. A document is as toxic as its worst segment: labels are of documents, so
training first averages over all segments and then follows the worst segment of each document. Every text is scored
whole. Embeddings and softmax are trained together on at most ``train_rows`` labelled documents, a third of them toxic where there are
as many; a quarter of them only place the cut. The model is ``2 ** BITS`` buckets of ``DIM`` numbers, whatever the input;
scoring ships one number a bucket, the product of its vector and the softmax weights.

Null and empty texts have no segment and score as the bias alone does (low). Texts of blanks are empty texts. Labels that are
null are not used; without rows of both classes every score is 0. Repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import bounded, fold, table
from tidewatch.llm.text import blocks, grams, lowered, raw, word_bounds

TRAIN_ROWS = 2400
BITS, DIM, SIZES, SEGMENT, LEAST = 18, 8, (3, 4, 5), 4, 30
FLOOR = -12.0


def segments(data: np.ndarray, at: np.ndarray, words: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of ``words`` words begin (the blank before included), and where each text's runs begin among them."""
    starts, _, first = word_bounds(data, at)
    count = np.diff(first)
    runs = -(-count // words)
    begin = np.concatenate(([0], np.cumsum(runs)))
    k = np.arange(begin[-1]) - np.repeat(begin[:-1], runs)
    heads = starts[np.repeat(first[:-1], runs) + k * words]
    low = np.repeat(at[:-1], runs)
    return np.maximum(heads - 1, low), begin


def segment_logits(data: np.ndarray, at: np.ndarray, value: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Mean bucket value of each segment's n-grams (over ``LEAST`` at least), and where each text's segments begin."""
    data = lowered(data)
    heads, begin = segments(data, at)
    total = np.zeros(len(heads) + 1)
    number = np.zeros(len(heads) + 1)
    for where, bucket in grams(data, at, SIZES, bits):
        run = np.concatenate(([0.0], np.cumsum(value[bucket], dtype=np.float64)))
        edge = np.searchsorted(where, np.append(heads, len(data)))
        total[:-1] += run[edge[1:]] - run[edge[:-1]]
        number[:-1] += np.diff(edge)
    return total[:-1] / np.maximum(number[:-1], LEAST), begin


def worst(logit: np.ndarray, begin: np.ndarray, none: float = FLOOR) -> np.ndarray:
    """The largest of each text's segment logits; ``none`` for a text without segments."""
    if not len(logit):
        return np.full(len(begin) - 1, none)
    top = np.maximum.reduceat(np.append(logit, none), begin[:-1])
    return np.where(np.diff(begin) > 0, top, none)


@dataclass
class Softmax:
    """One value a bucket (its vector times the softmax weights), scale and cut on the logit."""

    value: np.ndarray
    slope: float = 1.0
    cut: float = 0.0

    def score(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (logit - self.cut), -30, 30)))


def fit(texts: list[str], label: np.ndarray, warm: int = 30, steps: int = 60, seed: int = 7) -> Softmax:
    """Joint full-batch Adam steps on bucket vectors and softmax weights."""
    if not len(label) or label.min() == label.max():
        return Softmax(np.zeros(1 << BITS, np.float32), 1.0, 30.0)
    rng = np.random.default_rng(seed)
    part = rng.permutation(len(texts)) % 4 == 0
    for c in (0, 1):
        if not (~part & (label == c)).any():
            part[:] = False
    ids: list[list[np.ndarray]] = [[] for _ in SIZES]
    edges: list[list[np.ndarray]] = [[] for _ in SIZES]
    runs, seen = [], [0] * len(SIZES)
    for piece in blocks([pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])]):
        data, at = raw(piece.column(0))
        data = lowered(data)
        heads, begin = segments(data, at)
        runs.append(np.diff(begin))
        for k, (where, bucket) in enumerate(grams(data, at, SIZES, BITS)):
            edges[k].append(np.searchsorted(where, heads) + seen[k])
            ids[k].append(bucket.astype(np.int32))
            seen[k] += len(where)
    ids = [np.concatenate(x) for x in ids]
    edges = [np.append(np.concatenate(x), n) for x, n in zip(edges, seen, strict=True)]
    runs = np.concatenate(runs)
    begin = np.concatenate(([0], np.cumsum(runs)))
    doc = np.repeat(np.arange(len(texts)), runs)
    number = np.maximum(sum(np.diff(e) for e in edges), LEAST)

    def logits(value: np.ndarray) -> np.ndarray:
        total = np.zeros(len(doc))
        for i, e in zip(ids, edges, strict=True):
            run = np.concatenate(([0.0], np.cumsum(value[i], dtype=np.float64)))
            total += run[e[1:]] - run[e[:-1]]
        return total / number

    vector = rng.normal(0, 0.05, (1 << BITS, DIM)).astype(np.float32)
    weight = rng.normal(0, 0.3, DIM).astype(np.float32)
    bias = np.zeros(1, np.float32)
    moment = [[np.zeros_like(p), np.zeros_like(p)] for p in (vector, weight, bias)]
    cost = np.where(part, 0, np.where(label == 1, 0.4 / max(1, (label[~part] == 1).sum()), 0.6 / max(1, (label[~part] == 0).sum())))
    share = 1 / np.maximum(np.diff(begin), 1)
    for t in range(1, warm + steps + 1):
        value = vector @ weight
        logit = logits(value)
        if t <= warm:  # every segment carries its document's label
            chosen = np.arange(len(doc))
            heavy = cost[doc] * share[doc]
        else:  # the worst segment of each document
            top = worst(logit, begin)
            hit = np.flatnonzero(logit == top[doc])
            chosen = hit[np.unique(doc[hit], return_index=True)[1]]
            heavy = cost[doc[chosen]]
        z = logit[chosen] + bias[0]
        g = heavy * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[doc[chosen]])
        slope = np.zeros(1 << BITS, np.float32)
        for i, e in zip(ids, edges, strict=True):
            size = e[chosen + 1] - e[chosen]
            if len(chosen) < len(doc):
                i = i[np.arange(size.sum()) + np.repeat(e[chosen] - np.concatenate(([0], np.cumsum(size)[:-1])), size)]
            slope += np.bincount(i, np.repeat(g / number[chosen], size), 1 << BITS)
        grads = (slope[:, None] * weight, vector.T @ slope, np.array([g.sum()], np.float32))
        for p, d, (m, v) in zip((vector, weight, bias), grads, moment, strict=True):
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            p -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)
    value = vector @ weight
    top = worst(logits(value), begin)
    used = part if len(set(label[part])) == 2 else np.ones(len(label), bool)
    top, y = top[used], label[used]
    order = np.argsort(top)
    # flagging a clean document costs as much as missing four toxic ones, each class by its share
    wrong = np.cumsum(y[order] == 1) / (y == 1).sum() - 4 * np.cumsum(y[order] == 0) / (y == 0).sum()
    k = int(np.argmin(wrong))
    # n-grams never seen have value near 0 and must not decide
    cut = max(1.0, (top[order[k]] + top[order[min(k + 1, len(order) - 1)]]) / 2)
    return Softmax(value.astype(np.float32), 1.0, float(cut))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Softmax:
    """Fit on at most ``rows`` labelled documents; ``docs`` has doc_id and text, ``labels`` doc_id and label (1 toxic)."""
    labels = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    toxic = bounded(labels.where("label = 1"), rows // 3, "doc_id", 3)
    other = bounded(labels.where("label = 0"), rows - rows // 3, "doc_id", 3)
    got = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(toxic.union(other)), "doc_id").collect()
    got.sort(key=lambda r: (r.doc_id, r.text))
    return fit([r.text for r in got], np.array([r.label for r in got], int))


def score(docs: DataFrame, model: Softmax) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` for every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shipped.value
        for b in blocks(batches):
            logit, begin = segment_logits(*raw(b.column("text")), model.value)
            s = model.score(worst(logit, begin))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def op3_toxicity(spark, sf_dir: str, rows: int = TRAIN_ROWS) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(fold("doc_id", 5) != 0).select("doc_id", F.col("toxic").alias("label")), rows)
    return score(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
