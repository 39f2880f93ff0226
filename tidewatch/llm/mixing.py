"""Soft-membership mixing of documents to target domain weights, in DataFrame functions only.

A multinomial naive Bayes classifier over hashed words is learnt from a table of labelled documents and gives every document
a posterior over the domains. Nonnegative rates are fitted so that the expected domain token totals, the sum of
rate x tokens x posterior, come as near to the targets as nonnegative rates allow: accelerated projected gradient least squares
from rate 1, the residual weighted by the inverse of ``sum(tokens x posterior x posterior')``, in which the step length is 1. One
step needs one sum over all documents of as many numbers as there are domains; a document's rate is a function of its
own posterior and the steps so far, so no table is rewritten and no document is collected.

The classifier learns from at most ``train_rows`` labelled rows; domains are at most ``DOMAINS``. Null and empty texts
have no tokens and the prior as posterior, and get a rate like any other. Null labels are not used; without labels there is one domain, and
all rates are equal. Repeated rows are rated alike; other columns are ignored.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import bounded, ready, table
from tidewatch.session import materialise

BUCKETS, TRAIN_ROWS, DOMAINS, EVIDENCE = 4096, 4000, 64, 40


def buckets(text: str = "text") -> Column:
    """The hash bucket of each word of the text."""
    body = F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    words = F.filter(F.split(body, r"[\x09-\x0D\x20]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


def learn(docs: DataFrame, labelled: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Domain names in order, their log priors and the log probability of each bucket given each."""
    labelled = labelled.where("domain is not null and doc_id is not null").groupBy("doc_id").agg(F.min(F.col("domain").cast("string")).alias("domain"))
    chosen = F.broadcast(bounded(labelled, rows, "doc_id", 11))  # at most about ``rows`` short rows
    seen = docs.select("doc_id", "text").join(chosen, "doc_id").select("domain", F.explode_outer(buckets()).alias("bucket"))
    got = seen.groupBy("domain", "bucket").agg(F.count("*").alias("n")).collect()
    names = sorted({r.domain for r in got})
    if len(names) > DOMAINS:
        raise ValueError(f"more than {DOMAINS} domains")
    if not names:
        return ["all"], np.zeros(1), np.zeros((1, BUCKETS))
    n = np.full((len(names), BUCKETS), 0.5)
    for r in got:
        if r.bucket is not None:
            n[names.index(r.domain), r.bucket] += r.n
    share = dict(chosen.groupBy("domain").count().collect())
    prior = np.array([share.get(x, 0) + 1.0 for x in names])
    return names, np.log(prior / prior.sum()), np.log(n / n.sum(axis=1, keepdims=True))


def added(places: str, value: Column) -> Column:
    """The sum of ``value`` at the places listed."""
    return F.aggregate(places, F.lit(0.0), lambda a, w: a + F.get(value, w))


def memberships(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray]) -> DataFrame:
    """``doc_id``, ``tokens`` and the posteriors ``p0``, ``p1`` ... of every row; long texts count as ``EVIDENCE`` words, so they stay soft."""
    names, prior, chance = model
    rows = docs.select("doc_id", buckets().alias("w")).withColumn("tokens", F.size("w").cast("double"))
    # relative to the mean over domains, which drops out of the posterior
    relative = chance - chance.mean(axis=0, keepdims=True)
    scale = F.least(F.lit(1.0), F.lit(float(EVIDENCE)) / F.greatest("tokens", F.lit(1.0)))
    sums = []
    for k in range(len(names)):
        value = F.from_json(F.lit(json.dumps([round(x, 6) for x in relative[k].tolist()])), "array<double>")
        sums.append((added("w", value) * scale + float(prior[k])).alias(f"s{k}"))
    rows = rows.select("doc_id", "tokens", *sums)
    top = F.greatest(*[f"s{k}" for k in range(len(names))]) if len(names) > 1 else F.col("s0")
    rows = rows.select("doc_id", "tokens", *[F.exp(F.col(f"s{k}") - top).alias(f"e{k}") for k in range(len(names))])
    whole = sum((F.col(f"e{k}") for k in range(1, len(names))), F.col("e0"))
    return rows.select("doc_id", "tokens", *[(F.col(f"e{k}") / whole).alias(f"p{k}") for k in range(len(names))])


def rate_after(steps: list[list[float]], width: int, bounded: bool = False) -> Column:
    """A document's rate ``r`` after projected steps, from its posterior, and the point ``y`` of the next gradient.

    Rates are at least 0; with ``bounded`` they are held between the document's ``low`` and ``high``.
    """
    start = F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("y"))
    if not steps:
        return start
    path = F.from_json(F.lit(json.dumps(steps)), "array<array<double>>")

    def step(s, g):
        moved = sum((F.col(f"p{k}") * F.get(g, F.lit(k)) for k in range(1, width)), F.col("p0") * F.get(g, F.lit(0)))
        r = s["y"] - moved
        r = F.least(F.col("high"), F.greatest(F.col("low"), r)) if bounded else F.greatest(F.lit(0.0), r)
        return F.struct(r.alias("r"), (r + F.get(g, F.lit(width)) * (r - s["r"])).alias("y"))

    return F.aggregate(path, start, step)


def fit(members: DataFrame, target: np.ndarray, rounds: int = 40, tolerance: float = 1e-5, bounded: bool = False) -> list[list[float]]:
    """The steps of accelerated projected gradient descent towards expected totals ``target``, each with its momentum.

    It ends when the totals miss the target by less than ``tolerance`` of all tokens, or after ``rounds`` when rates of at least 0 allow no better.
    With ``bounded`` rates stay between the columns ``low`` and ``high`` (a projection too), and it also ends when no total moves by more than that.
    """
    width = len(target)
    square = [F.sum(F.col("tokens") * F.col(f"p{i}") * F.col(f"p{j}")) for i in range(width) for j in range(width)]
    m = np.array([x or 0.0 for x in members.agg(*[c.alias(f"m{k}") for k, c in enumerate(square)]).first()]).reshape(width, width)
    m += np.eye(width) * max(1e-9, 1e-9 * np.trace(m))
    steps: list[list[float]] = []
    t, last = 1.0, None
    for _ in range(rounds):
        rated = members.withColumn("s", rate_after(steps, width, bounded))
        sums = [F.sum(F.col(f"s.{x}") * F.col("tokens") * F.col(f"p{k}")).alias(f"{x}{k}") for x in "ry" for k in range(width)]
        total = np.array([x or 0.0 for x in rated.agg(*sums).first()]).reshape(2, width)
        near = tolerance * max(1.0, np.abs(target).sum())
        if np.abs(total[0] - target).max() <= near or (bounded and last is not None and np.abs(total - last).max() <= near):
            break
        last = total
        step = np.linalg.solve(m, total[1] - target)
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        steps.append([*step.tolist(), (t - 1) / after])
        t = after
    return steps


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], budget: float = 1.0, rows: int = TRAIN_ROWS) -> tuple[DataFrame, list[str]]:
    """``doc_id``, ``tokens``, ``p0`` ..., ``rate`` per row, and the domain of each posterior.

    ``weights`` gives each domain's share of the result (a domain not named: 0), ``budget`` the result's tokens as a multiple of
    the input's. ``labelled`` has doc_id and domain.
    """
    ready(docs.sparkSession)
    model = learn(docs, labelled, rows)
    names = model[0]
    members = materialise(memberships(docs, model), "memberships")
    whole = members.agg(F.sum("tokens")).first()[0] or 0.0
    share = np.array([max(0.0, weights.get(x, 0.0)) for x in names])
    share = share / share.sum() if share.sum() > 0 else np.full(len(names), 1 / len(names))
    steps = fit(members, share * whole * budget)
    return members.withColumn("rate", rate_after(steps, len(names))["r"]), names


WEIGHTS = {"clean": 0.85, "low": 0.1, "toxic": 0.05}


def label_domains(labels: DataFrame) -> DataFrame:
    """Domains of the labelled table: toxic, else low quality, else clean."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean")
    return labels.select("doc_id", domain.alias("domain"))


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out, names = mix(docs, label_domains(labels), WEIGHTS)
    return out.select("doc_id", F.col("tokens").cast("long").alias("tokens"), *[F.col(f"p{k}").alias(f"p_{n}") for k, n in enumerate(names)], "rate")


MOST = 2.0


def by_id(members: DataFrame, names: list[str], labelled: DataFrame, lower: set[str]) -> DataFrame:
    """One row per id: ``tokens`` and mean posteriors of its rows, weighted by tokens, and the bounds ``low`` and ``high`` of its rate.

    An id that is to stay has a rate from 1 to ``MOST``, one that may leave from 0 to 1. Those that may leave are labelled with a domain in
    ``lower``, or not labelled and in every row more probably of such a domain than of any other; a tie stays.
    """
    width = range(len(names))
    best = lambda kept: F.greatest(F.lit(-1.0), F.lit(-1.0), *[F.col(f"p{k}") for k in width if (names[k] in lower) == kept])
    weight = F.greatest(F.col("tokens"), F.lit(1e-9))  # texts without a word have the prior
    sums = [F.sum(weight * F.col(f"p{k}")).alias(f"p{k}") for k in width]
    ids = members.withColumn("less", best(True) > best(False)).groupBy("doc_id").agg(
        F.sum(weight).alias("_weight"), F.sum("tokens").alias("tokens"), F.min("less").alias("less"), *sums
    )
    told = labelled.where("domain is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("domain").isin(*lower)).alias("_low"))
    leaves = F.coalesce("_low", "less")
    return ids.join(told.hint("merge"), "doc_id", "left").select(
        "doc_id", "tokens", *[(F.col(f"p{k}") / F.col("_weight")).alias(f"p{k}") for k in width],
        F.when(leaves, 0.0).otherwise(1.0).alias("low"), F.when(leaves, 1.0).otherwise(MOST).alias("high"),
    )


def mix_within(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], budget: float = 1.0, rows: int = TRAIN_ROWS) -> tuple[DataFrame, list[str]]:
    """``doc_id``, ``tokens``, ``p0`` ..., ``low``, ``high``, ``rate`` per id, and the domain of each posterior.

    A weight is the wanted multiple of the tokens that ``docs`` themselves are expected to have of the domain (a domain not named: 1);
    ``budget`` multiplies them all.
    Only documents of domains whose weight is under 1 can leave (``by_id``), and the bounds hold in every step of the fit, so that the
    rates meet the totals themselves, or come as near as the bounds allow.
    """
    ready(docs.sparkSession)
    model = learn(docs, labelled, rows)
    names = model[0]
    ids = materialise(by_id(memberships(docs, model), names, labelled, {x for x, w in weights.items() if w < 1}), "rates")
    expected = ids.agg(*[F.sum(F.col("tokens") * F.col(f"p{k}")).alias(f"e{k}") for k in range(len(names))]).first()
    target = budget * np.array([max(0.0, weights.get(x, 1.0)) * (e or 0.0) for x, e in zip(names, expected)])
    steps = fit(ids, target, bounded=True)
    return ids.withColumn("rate", rate_after(steps, len(names), bounded=True)["r"]), names


def resample(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], budget: float = 1.0, rows: int = TRAIN_ROWS, relative: bool = False) -> DataFrame:
    """The documents, each as often as its rate says: the whole part always, once more by a hash of the id below the rest.

    With ``relative`` weights are multiples of what the documents have and rates are bounded (``mix_within``).
    """
    out, _ = mix_within(docs, labelled, weights, budget, rows) if relative else mix(docs, labelled, weights, budget, rows)
    chance = F.pmod(F.xxhash64(F.lit(23), F.col("doc_id")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = out.groupBy("doc_id").agg(F.max("rate").alias("rate")).select(F.col("doc_id").alias("_id"), F.floor(F.col("rate") + chance).cast("int").alias("_copies"))
    copies = materialise(copies.where("_copies > 0"), "copies")
    # the kept ids grow with the documents: joined by sorting at every size
    found = docs.join(copies.hint("merge"), docs["doc_id"].eqNullSafe(F.col("_id")))
    return found.withColumn("_turn", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*[F.col(f"`{c}`") for c in docs.columns])
