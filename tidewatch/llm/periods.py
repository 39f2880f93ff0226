"""Periodic runs of words: where a text repeats the same few words over and over.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at least ``max(SHORTEST, TIMES * q)`` long, that
no neighbouring word extends. At every dyadic scale B the words are cut into overlapping blocks of B words, half a block
apart, and each block is compared with the window behind it: an exact number theoretic transform gives, for every distance up to B,
the sum of squared differences of word numbers modulo a prime. Sums of zero are the only places where the block can occur again; they are compared word by
word, so a sum that is a multiple of the prime does no harm. The smallest such distance d in (B/2, B] is a seed, and is
extended to both sides as far as words d apart are equal. A run of period q in (B/2, B] has 4q words, so some block of this scale and its
next occurrence lie inside it, and a block that holds a whole period does not recur sooner: every run is found, with its smallest period.

Blocks are left out only where the result is known: if one of its words does not recur within B words, or if block and window lie
inside a run of a period of at most B/2. So usual text costs a few transforms, and no text more than n log(n)^2.

Words are ``[^\\x20\\x09-\\x0D]+``. A null text has none: no runs, empty collapsed text; likewise an empty or blank one. Equal and repeated rows are
searched each; ids of any type, other columns are ignored. Memory follows a block of texts, or one longer text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import ready, table
from tidewatch.llm.text import blocks

SHORTEST, TIMES = 6, 4
PRIME, ROOT = 998_244_353, 3  # 119 * 2**23 + 1: transforms of up to 2**23 places
FAR = np.int64(1) << 40
NARROW = 8  # distances up to this are extended for the whole block of texts at once


def roots(size: int, back: bool) -> np.ndarray:
    """The first ``size / 2`` powers of a root of unity of order ``size``, or of its inverse."""
    step = pow(ROOT, (PRIME - 1) // size, PRIME)
    step = pow(step, PRIME - 2, PRIME) if back else step
    out = np.ones(max(size // 2, 1), np.int64)
    done = 1
    while done < len(out):
        out[done : 2 * done] = out[:done] * pow(step, done, PRIME) % PRIME
        done *= 2
    return out


def transform(a: np.ndarray) -> np.ndarray:
    """Number theoretic transform of each row, in bit-reversed order; the width is a power of two."""
    m, size = a.shape
    h = size // 2
    while h:
        a = a.reshape(m, -1, 2, h)
        u, v = a[:, :, 0], a[:, :, 1]
        a = np.stack(((u + v) % PRIME, (u - v + PRIME) * roots(2 * h, False) % PRIME), axis=2)
        h //= 2
    return a.reshape(m, size)


def inverse(a: np.ndarray) -> np.ndarray:
    """Back from bit-reversed order."""
    m, size = a.shape
    h = 1
    while h < size:
        a = a.reshape(m, -1, 2, h)
        u, v = a[:, :, 0], a[:, :, 1] * roots(2 * h, True) % PRIME
        a = np.stack(((u + v) % PRIME, (u - v + PRIME) % PRIME), axis=2)
        h *= 2
    return a.reshape(m, size) * pow(size, PRIME - 2, PRIME) % PRIME


def squared_differences(block: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Per row the sums of (block[j] - window[s + j])^2 over j, modulo the prime, for s from 0 to the block's width less one.

    Rows of ``window`` are twice as wide as those of ``block``, so that the cyclic product wraps around at no such s.
    """
    m, width = block.shape
    turned = np.zeros_like(window)
    turned[:, -np.arange(width)] = block
    crossed = inverse(transform(turned % PRIME) * transform(window % PRIME) % PRIME)[:, :width]
    squares = np.zeros((m, 2 * width + 1), np.int64)
    np.cumsum((window % PRIME) ** 2 % PRIME, axis=1, out=squares[:, 1:])
    own = ((block % PRIME) ** 2 % PRIME).sum(1, keepdims=True)
    return (own + squares[:, width : 2 * width] - squares[:, :width] - 2 * crossed) % PRIME


def nearest_repeat(words: np.ndarray, at: np.ndarray, stop: np.ndarray, width: int, rows: int = 1 << 18) -> np.ndarray:
    """For each block of ``width`` words at ``at`` the smallest distance, up to ``width``, at which it occurs again; 0 if none.

    ``stop`` is where the block's text ends; words behind it match nothing.
    """
    out = np.zeros(len(at), np.int64)
    some = max(1, rows // (2 * width))
    for lo in range(0, len(at), some):
        x, end = at[lo : lo + some, None], stop[lo : lo + some, None]
        block = words[x + np.arange(width)]
        place = x + 1 + np.arange(2 * width)
        window = np.where(place < end, words[np.minimum(place, len(words) - 1)], -1)
        zero = squared_differences(block + 1, window + 1) == 0
        left = np.flatnonzero(zero.any(1))
        while len(left):
            s = zero[left].argmax(1)
            true = (block[left] == window[left[:, None], s[:, None] + np.arange(width)]).all(1)
            out[lo + left[true]] = s[true] + 1
            zero[left, s] = False
            left = left[~true]
            left = left[zero[left].any(1)]
    return out


def extended(words: np.ndarray, lo: int, hi: int, x: int, d: int) -> tuple[int, int]:
    """The stretch around ``x`` inside lo..hi whose words ``d`` apart are equal, with x and x + d equal."""
    start, step = x, 64
    while start > lo:
        first = max(lo, start - step)
        off = np.flatnonzero(words[first:start] != words[first + d : start + d])
        if len(off):
            start = first + int(off[-1]) + 1
            break
        start, step = first, 2 * step
    stop, step = x, 64
    while stop + d < hi:
        last = min(hi - d, stop + step)
        off = np.flatnonzero(words[stop:last] != words[stop + d : last + d])
        if len(off):
            stop += int(off[0])
            break
        stop, step = last, 2 * step
    return start, stop + d


def all_runs(words: np.ndarray, first: np.ndarray, shortest: int = SHORTEST, times: int = TIMES) -> np.ndarray:
    """``start, end, period`` of every run in texts behind each other; equal numbers stand for equal words of one text.

    ``first`` is where each text begins, with the whole length at its end. ``times`` is at least 4. Sorted by start, then period.
    """
    n = len(words)
    size = np.diff(first)
    begin, stop = np.repeat(first[:-1], size), np.repeat(first[1:], size)
    order = np.argsort(words, kind="stable")
    reach = np.full(n, FAR)  # how far the next equal word is, then the greatest such distance in a block
    same = words[order[1:]] == words[order[:-1]]
    reach[order[:-1][same]] = (order[1:] - order[:-1])[same]
    known = np.zeros(n, np.int64)  # up to where blocks that begin here lie inside a run, with its period behind them
    found: dict[tuple[int, int], int] = {}  # a stretch comes with its smallest period first

    def add(start: int, end: int, d: int) -> None:
        if end - start >= max(shortest, times * d):
            found.setdefault((start, end), d)
            known[start:end] = np.maximum(known[start:end], end - d)

    width, longest = 1, int(size.max(initial=0))
    while 2 * width <= longest:
        at = np.arange(0, n - width + 1, max(width // 2, 1))
        at = at[(reach[at] <= width) & (at + width + width // 2 < stop[at]) & (at + width > known[at])]
        d = nearest_repeat(words, at, stop[at], width)
        seeds, d = at[2 * d > width], d[2 * d > width]
        for one in np.unique(d[d <= NARROW]).tolist():
            equal = np.zeros(n + 2, bool)
            equal[1 : n - one + 1] = (words[one:] == words[:-one]) & (begin[one:] == begin[:-one])
            starts, ends = np.flatnonzero(equal[1:] & ~equal[:-1]), np.flatnonzero(equal[:-1] & ~equal[1:])
            for a, e in zip(starts[good := ends - starts + one >= max(shortest, times * one)].tolist(), ends[good].tolist(), strict=True):
                add(a, e + one, one)
        done: dict[int, int] = {}
        for x, one in zip(seeds[d > NARROW].tolist(), d[d > NARROW].tolist(), strict=True):
            if done.get(one, -1) <= x:
                a, e = extended(words, int(begin[x]), int(stop[x]), x, one)
                done[one] = e - one
                add(a, e, one)
        if n > width:
            reach[: n - width] = np.maximum(reach[: n - width], reach[width:])
            reach[n - width :] = FAR
        width *= 2
    made = np.array(sorted((a, d, e) for (a, e), d in found.items()), np.int64).reshape(-1, 3)
    return made[:, [0, 2, 1]]


def numbered(texts: list[str | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Each text's words, their numbers (others in each text), and where each text begins among them."""
    split, numbers, first = [], [], [0]
    base = 0
    for t in texts:
        seen: dict[bytes, int] = {}
        words = t.encode().split() if t else []  # bytes.split() parts at exactly these six characters
        numbers += [seen.setdefault(w, base + len(seen)) for w in words]
        base += len(seen)
        split.append(words)
        first.append(len(numbers))
    return split, np.array(numbers, np.int64), np.array(first, np.int64)


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``runs`` (start, length, period in words, by start, then period) and ``collapsed``.

    ``collapsed`` is the text without what its runs repeat, kept words joined by one space: of each run only the first period stays.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    parts = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for b in blocks(batches):
            split, words, first = numbered(b.column("text").to_pylist())
            runs = all_runs(words, first)
            drop = np.zeros(len(words) + 1, np.int64)
            np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
            np.add.at(drop, runs[:, 1], -1)
            drop = np.cumsum(drop) > 0
            owner = np.searchsorted(first, runs[:, 0], "right") - 1
            ends = np.searchsorted(owner, np.arange(len(split) + 1))
            cols = [runs[:, 0] - first[owner], runs[:, 1] - runs[:, 0], runs[:, 2]]
            held = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols], fields=list(parts))
            kept = []
            for i, (ws, lo, hi) in enumerate(zip(split, first[:-1].tolist(), first[1:].tolist(), strict=True)):
                if ends[i + 1] > ends[i]:
                    ws = [w for w, gone in zip(ws, drop[lo:hi].tolist(), strict=True) if not gone]
                kept.append(b" ".join(ws).decode())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), held), pa.array(kept, pa.string())],
                ["doc_id", "runs", "collapsed"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def with_planted_periods(doc_id: Column, text: Column) -> Column:
    """The query's input: in a tenth of the documents, told by a checksum of the id, the words from one place on repeat.

    With h the CRC-32 of the id as text and g = h / 10, each word from number a = g mod n on becomes one of the p words from a on,
    p = 1 + (n - a) / (3 + g mod 8). A null id, or a text without words, is left as it is.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def planted(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        source = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, source(i).cast("int"))), " "))

    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    let = F.get(F.transform(F.array(words), planted), 0)  # binds the words once
    return F.when(h % 10 == 0, F.coalesce(let, text)).otherwise(text)


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_runs(docs.select("doc_id", with_planted_periods(F.col("doc_id"), F.col("text")).alias("text")))
    exceeds = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    best = F.aggregate("runs", F.get("runs", 0), lambda best, r: F.when(exceeds(r, best), r).otherwise(best))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
