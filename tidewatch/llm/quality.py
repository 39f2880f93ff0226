"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad. A line's potential is linear in its own features and those of the lines before and after it; a
transition matrix joins neighbours. Labels are of documents only, so training alternates: all lines of a bad document start
as bad and those of a good one as good; after each fit the lines of bad documents are labelled anew by their marginals, and the
worst line of a bad document always stays bad. A document's raw quality is the length-weighted mean of its lines' forward-backward marginals. Two numbers
map it to the score, so that the cut that separates the training documents best becomes the threshold.

The model is fitted on at most ``train_rows`` labelled documents, of which executors compute line features and the driver gets
these alone (sixteen numbers a line). It has under 120 weights. Scoring is one map over whole texts.

Null and empty texts have one empty line and get a score like any other. Labels that are null are not used. Repeated rows
are scored alike; other columns are ignored, whatever their names. With no labelled row of one of the classes the score is 1, or 0 if all are bad.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import bounded, fold, ready, table
from tidewatch.llm.text import blank, blocks, raw, span_hashes, word_bounds

TRAIN_ROWS = 4000
THRESHOLD = 0.7
_KIND = np.zeros(256, np.uint8)  # 1 upper, 2 lower or beyond ASCII, 3 digit, 4 usual punctuation, 5 other sign
_KIND[33:127] = 5
_KIND[65:91], _KIND[97:123], _KIND[128:], _KIND[48:58] = 1, 2, 2, 3
_KIND[[ord(c) for c in ".,;:'\"?()-"]] = 4
OWN = 16


def line_features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line of every text, each line's length in bytes (at least 1), and where each text's lines begin."""
    breaks = np.flatnonzero(data == 10)
    n = len(at) - 1
    owner = np.searchsorted(at, breaks, "right") - 1
    lines = np.bincount(owner, minlength=n) + 1
    first = np.concatenate(([0], np.cumsum(lines)))
    lo = np.empty(first[-1], np.int64)
    rank = np.arange(len(breaks)) + owner + 1  # a break starts the next line of its text
    lo[first[:-1]] = at[:-1]
    lo[rank] = breaks + 1
    hi = np.empty_like(lo)
    hi[:-1] = lo[1:]
    hi[-1:] = at[-1]
    last = np.zeros(len(lo), bool)
    last[first[1:] - 1] = True
    hi = np.where(last, np.repeat(at[1:], lines), hi - 1)
    size = hi - lo

    kind = _KIND[data]
    space = blank(data)

    def count(mask: np.ndarray) -> np.ndarray:
        run = np.concatenate(([0], np.cumsum(mask, dtype=np.int32)))
        return (run[hi] - run[lo]).astype(np.float64)

    upper, lower, digit, sign = (count(kind == k) for k in (1, 2, 3, 5))
    starts, ends, _ = word_bounds(data, at)
    word = span_hashes(data, starts, ends)
    place = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
    words = np.maximum(place[1] - place[0], 1).astype(np.float64)
    stutter = np.concatenate(([0, 0], np.cumsum(word[1:] == word[:-1])))[: len(word) + 1]
    stutter = np.maximum(0, stutter[place[1]] - stutter[np.minimum(place[0] + 1, place[1])]) / words
    full = np.maximum(size, 1).astype(np.float64)
    text = np.flatnonzero(size > 0)
    hashed = np.zeros(len(lo), np.uint64)
    hashed[text] = span_hashes(data, lo[text], hi[text])
    doc = np.repeat(np.arange(n), lines)
    order = np.lexsort((hashed, doc))
    same = (hashed[order][1:] == hashed[order][:-1]) & (doc[order][1:] == doc[order][:-1]) & (size[order][1:] > 0)
    again = np.zeros(len(lo), bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    letters = upper + lower
    mean = (size - count(space)) / words
    own = np.stack([
        upper / np.maximum(letters, 1), np.minimum(1, 3 * upper / np.maximum(letters, 1)), sign / full, np.minimum(1, sign / words),
        digit / full, np.minimum(1, digit / words), again, size < 20, size == 0, np.log1p(size) / 8, np.minimum(mean, 30) / 10,
        np.minimum(1, np.abs(mean - 6) / 6), letters / full, stutter, np.minimum(1, 5 * stutter), np.ones(len(lo)),
    ], axis=1).astype(np.float32)
    return own, full, first


def with_neighbours(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's features, those of the line before and of the line after; zeros where a text ends."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return np.concatenate([own, before, after], axis=1)


@dataclass
class Crf:
    """Weights of the state "good" against "bad", transition scores, and the map to a score."""

    weight: np.ndarray
    step: np.ndarray
    slope: float = 8.0
    cut: float = 0.5


def marginals(crf: Crf, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of each line, and the sums over line pairs of P(state, next state), by forward-backward over all texts at once."""
    lines = np.diff(first)
    order = np.argsort(-lines, kind="stable")
    start, size = first[:-1][order], lines[order]
    emit = np.zeros((len(x), 2))
    emit[:, 1] = x @ crf.weight
    step = np.exp(crf.step)
    emit = np.exp(emit - emit.max(axis=1, keepdims=True))
    forward, back = np.empty_like(emit), np.ones_like(emit)
    longest = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(longest), "left")  # texts with more than k lines
    state = emit[start]
    state = state / state.sum(axis=1, keepdims=True)
    forward[start] = state
    for k in range(1, longest):
        state = (state[: alive[k]] @ step) * emit[start[: alive[k]] + k]
        state /= state.sum(axis=1, keepdims=True)
        forward[start[: alive[k]] + k] = state
    for k in range(longest - 2, -1, -1):
        i = start[: alive[k + 1]] + k
        b = (back[i + 1] * emit[i + 1]) @ step.T
        back[i] = b / b.sum(axis=1, keepdims=True)
    both = forward * back
    good = both[:, 1] / both.sum(axis=1)
    inner = np.ones(len(x), bool)
    inner[first[1:] - 1] = False
    i = np.flatnonzero(inner)
    pair = forward[i][:, :, None] * step[None] * (back[i + 1] * emit[i + 1])[:, None, :]
    pair /= pair.sum(axis=(1, 2), keepdims=True)
    return good, pair.sum(axis=0)


def document_quality(good: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(good * size, first[:-1]) / np.add.reduceat(size, first[:-1])


def fit(x: np.ndarray, size: np.ndarray, first: np.ndarray, label: np.ndarray, rounds: int = 3, steps: int = 120, threshold: float = THRESHOLD) -> Crf:
    """Alternate gradient steps on the conditional likelihood with new line labels; then place the cut."""
    crf = Crf(np.zeros(x.shape[1]), np.zeros((2, 2)))
    if not len(label) or label.min() == label.max():
        crf.weight[OWN - 1] = 50.0 if not len(label) or label.max() else -50.0
        return crf
    lines = np.diff(first)
    doc_bad = np.repeat(label == 0, lines)
    target = (~doc_bad).astype(np.float64)
    inner = np.ones(len(x), bool)
    inner[first[1:] - 1] = False
    inner = np.flatnonzero(inner)
    for again in range(rounds):
        m = [np.zeros_like(crf.weight), np.zeros_like(crf.step)]
        v = [np.zeros_like(crf.weight), np.zeros_like(crf.step)]
        want = np.zeros((2, 2))
        hard = target.round().astype(int)
        np.add.at(want, (hard[inner], hard[inner + 1]), 1)
        for t in range(1, steps + 1):
            good, pair = marginals(crf, x, first)
            grads = [x.T @ (target - good) / len(x) - 1e-4 * crf.weight, (want - pair) / len(x) - 1e-4 * crf.step]
            for i, (g, p) in enumerate(zip(grads, (crf.weight, crf.step), strict=True)):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.99 * v[i] + 0.01 * g * g
                p += 0.15 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.99**t)) + 1e-8)
        good, _ = marginals(crf, x, first)
        if again + 1 < rounds:
            worst = np.minimum.reduceat(good, first[:-1])
            target = np.where(doc_bad & ((good < 0.5) | (good == np.repeat(worst, lines))), 0.0, 1.0)
    quality = document_quality(good, size, first)
    order = np.argsort(quality)
    # losing a good document costs as much as keeping four bad ones, each class by its share
    wrong = 4 * np.cumsum(label[order] == 1) / (label == 1).sum() - np.cumsum(label[order] == 0) / (label == 0).sum()
    k = int(np.argmin(wrong))
    above = quality[order[k + 1]] if k + 1 < len(order) else 1.0
    crf.cut = float((quality[order[k]] + above) / 2)
    return crf


def score_of(crf: Crf, quality: np.ndarray, threshold: float) -> np.ndarray:
    """The line through (0, 0), (cut, threshold) and (1, 1), bent at the cut."""
    cut = min(max(crf.cut, 1e-6), 1 - 1e-6)
    return np.clip(np.where(quality < cut, quality / cut * threshold, threshold + (quality - cut) / (1 - cut) * (1 - threshold)), 0, 1)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> Crf:
    """Fit on at most ``rows`` labelled documents; ``docs`` has doc_id and text, ``labels`` doc_id and label (1 good)."""
    labels = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = F.broadcast(bounded(labels, rows, "doc_id", 5))  # at most about ``rows`` short rows

    def features(batches):
        for b in blocks(batches):
            own, size, first = line_features(*raw(b.column("text")))
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id").cast(pa.int64()), b.column("label").cast(pa.int32()),
                pa.array([own[i:j].tobytes() for i, j in zip(first[:-1], first[1:], strict=True)], pa.binary()),
                pa.array([size[i:j].tobytes() for i, j in zip(first[:-1], first[1:], strict=True)], pa.binary()),
            ], ["doc_id", "label", "own", "size"])

    found = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "label", "text")
    got = found.mapInArrow(features, "doc_id long, label int, own binary, size binary").collect()
    got.sort(key=lambda r: (r.doc_id, r.own))
    own = np.concatenate([np.zeros((0, OWN), np.float32)] + [np.frombuffer(r.own, np.float32).reshape(-1, OWN) for r in got])
    size = np.concatenate([np.zeros(0)] + [np.frombuffer(r["size"]) for r in got])
    first = np.concatenate(([0], np.cumsum([len(r["size"]) // 8 for r in got]))).astype(np.int64)
    label = np.array([r.label for r in got])
    return fit(with_neighbours(own, first).astype(np.float64), size, first, label, threshold=threshold)


def score(docs: DataFrame, crf: Crf, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` for every row."""
    def run(batches):
        for b in blocks(batches):
            own, size, first = line_features(*raw(b.column("text")))
            good, _ = marginals(crf, with_neighbours(own, first).astype(np.float64), first)
            s = score_of(crf, document_quality(good, size, first), threshold)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def op5_quality(spark, sf_dir: str, rows: int = TRAIN_ROWS) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    crf = train(docs, labels.where(fold("doc_id", 4) != 2).select("doc_id", F.col("quality").alias("label")), rows)
    return score(docs, crf).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier accepts, with all their columns; ``labels`` has doc_id and label."""
    ready(docs.sparkSession)
    crf = train(docs, labels, rows, threshold)
    names = docs.columns

    def run(batches):
        for b in blocks(batches):
            own, size, first = line_features(*raw(b.column("text")))
            good, _ = marginals(crf, with_neighbours(own, first).astype(np.float64), first)
            yield b.filter(pa.array(score_of(crf, document_quality(good, size, first), threshold) >= threshold))

    return docs.select(*names).mapInArrow(run, docs.schema)
