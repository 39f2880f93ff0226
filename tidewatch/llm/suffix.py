"""Repeated byte windows by a depth-limited most-significant-digit radix sort of suffixes.

Every string of ``depth`` bytes that starts in two places makes its bytes repeated. Equal strings have the same smallest
``DIGIT``-byte hash inside, so suffixes are taken at these anchors only (about one in 75 bytes); an anchor stands for the run of
windows that have it, its cell. The suffixes are then told apart digit by digit, deepest last, and what is alone drops out of
further passes:

1. by the ``DIGIT`` bytes at the anchor;
2. by all bytes of the cell: cells with an equal are repeated as a whole and need no further pass;
3. through the whole depth: the windows of the cells that are left, where a repeated passage begins or ends.

Groups that are equal at full depth are the repeated windows. Passes 1 and 2 move hashes only. For pass 3 a cell brings its
bytes (under 400). A digit with many cells is dealt over several tasks, and what one of them cannot decide alone is counted
across them, so no group has to fit in a task. Equality is by 128 bits of hashes. Texts are shuffled by their id twice, for the bytes of
the cells and for the result.

Bytes are UTF-8, null text is empty, matches do not cross documents, and texts shorter than ``depth`` have none. Rows are told
apart by ``doc_id`` and a hash of the text that is checked to tell the texts of one id apart, so repeated rows repeat each other. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import ready, table
from tidewatch.llm.text import blocks, mix, raw
from tidewatch.session import materialise

DEPTH, DIGIT, GROUP = 200, 50, 256
_BASES = tuple(np.uint64(b) for b in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03))
_INVERSE = tuple(np.uint64(pow(int(b), -1, 2**64)) for b in _BASES)
_BYTES = tuple(np.random.default_rng(s).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for s in (31, 32))
_SPACE = 24  # bits of a place inside a block; longer texts are cut with an overlap


def rolling(data: np.ndarray, which: int):
    """A function giving the hash of ``data[lo:hi]`` for arrays of places."""
    power = np.full(len(data) + 1, _BASES[which], np.uint64)
    back = np.full(len(data) + 1, _INVERSE[which], np.uint64)
    power[0] = back[0] = 1
    power, back = np.multiply.accumulate(power), np.multiply.accumulate(back)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[which][data] * power[:-1], dtype=np.uint64)))
    return lambda lo, hi: mix((total[hi] - total[lo]) * back[lo])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def cells(data: np.ndarray, at: np.ndarray, depth: int = DEPTH, digit: int = DIGIT) -> tuple[np.ndarray, ...]:
    """Text number, first and last window start, digit hash and hash of all bytes of each cell."""
    none = np.zeros(0, np.int64)
    if len(data) < depth:
        return none, none, none, none, none
    one, two = rolling(data, 0), rolling(data, 1)
    place = np.arange(len(data) - digit + 1)
    key = one(place, place + digit)
    low = sliding_min((key >> np.uint64(_SPACE) << np.uint64(_SPACE)) | place.astype(np.uint64), depth - digit + 1)
    anchor = (low & np.uint64((1 << _SPACE) - 1)).astype(np.int64)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))[: len(anchor)]
    start = np.arange(len(anchor))
    fits = start + depth <= at[1:][doc]
    new = fits.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    end = fits.copy()
    end[:-1] &= (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | ~fits[1:]
    last = np.flatnonzero(end)
    return doc[first], first, last, key[anchor[first]].view(np.int64), (two(first, last + depth) + (last - first).astype(np.uint64)).view(np.int64)


def cut_long(batches, limit: int, depth: int):
    """Blocks of at most ``limit`` bytes as (rows, places of the pieces in their texts, bytes, bounds); long texts overlap by a window."""
    for b in blocks(batches, "text", 1 << 19):
        data, at = raw(b.column("text"))
        if len(data) <= limit:
            yield b, np.arange(b.num_rows), np.zeros(b.num_rows, np.int64), data, at
            continue
        step = limit - depth + 1  # one row
        for lo in range(0, len(data), step):
            part = data[lo : lo + limit]
            yield b, np.zeros(1, np.int64), np.array([lo]), part, np.array([0, len(part)])


def find_cells(docs: DataFrame, depth: int, digit: int) -> DataFrame:
    def run(batches):
        for b, row, shift, data, at in cut_long(batches, 1 << 22, depth):
            doc, first, last, key, whole = cells(data, at, depth, digit)
            take = pa.array(row[doc])
            base = (shift - at[:-1])[doc]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id").take(take), b.column("crc").take(take), pa.array(first + base), pa.array(last + base), pa.array(key), pa.array(whole),
            ], ["doc_id", "crc", "first", "last", "digit", "whole"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, crc long, first long, last long, digit long, whole long")


def cell_bytes(found: DataFrame, depth: int) -> DataFrame:
    """The bytes of the listed cells (``spots``) of each text, one row per cell."""
    def run(batches):
        for b in blocks(batches):
            data, at = raw(b.column("text"))
            row, first, key, salt, got = [], [], [], [], []
            for i, spots in enumerate(b.column("spots").to_pylist()):
                for s in spots:
                    row.append(i)
                    first.append(s["first"])
                    key.append(s["digit"])
                    salt.append(s["salt"])
                    got.append(data[at[i] + s["first"] : at[i] + s["last"] + depth].tobytes())
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id").take(take), b.column("crc").take(take), pa.array(first, pa.int64()), pa.array(key, pa.int64()), pa.array(salt, pa.int32()), pa.array(got, pa.binary()),
            ], ["doc_id", "crc", "first", "digit", "salt", "piece"])

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.select("doc_id", "crc", "text", "spots").mapInArrow(run, f"doc_id {kind}, crc long, first long, digit long, salt int, piece binary")


def deepest(pieces: DataFrame, depth: int) -> DataFrame:
    """Pass 3 inside a task: ``state`` 1 for windows found repeated, 0 for windows that other tasks may repeat, 2 for one of
    the repeated windows, as other tasks must see it. ``salt`` is -1 where the whole group is in the task."""
    def flush(batch: pa.RecordBatch):
        data, at = raw(batch.column("piece"))
        windows = np.diff(at) - depth + 1
        row = np.repeat(np.arange(batch.num_rows), windows)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
        start = at[:-1][row] + inside
        h = rolling(data, 1)(start, start + depth)
        key = batch.column("digit").to_numpy()[row]
        order = np.lexsort((h, key))
        same = (h[order][1:] == h[order][:-1]) & (key[order][1:] == key[order][:-1])
        again = np.zeros(len(row), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        head = np.zeros(len(row), bool)
        head[order] = np.concatenate(([True], ~same)) if len(row) else head[order]
        shared = batch.column("salt").to_numpy()[row] >= 0
        first = batch.column("first").to_numpy()[row] + inside
        # neighbouring repeated windows of a cell are one run
        run_start = again.copy()
        run_start[1:] &= ~(again[:-1] & (row[1:] == row[:-1]))
        run_end = again.copy()
        run_end[:-1] &= ~(again[1:] & (row[1:] == row[:-1]))
        s, e = np.flatnonzero(run_start), np.flatnonzero(run_end)
        yield made(batch, row[s], first[s], first[e] + depth, key[s], h[s], 1)
        w = np.flatnonzero(shared & ~again)
        yield made(batch, row[w], first[w], first[w] + depth, key[w], h[w], 0)
        w = np.flatnonzero(shared & again & head)
        yield made(batch, row[w], first[w], first[w] + depth, key[w], h[w], 2)

    def made(batch, row, lo, hi, key, h, state):
        take = pa.array(row)
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id").take(take), batch.column("crc").take(take), pa.array(lo), pa.array(hi), pa.array(key), pa.array(h.view(np.int64)), pa.array(np.full(len(row), state, np.int32)),
        ], ["doc_id", "crc", "lo", "hi", "digit", "window", "state"])

    def run(batches):
        held: pa.RecordBatch | None = None
        for b in batches:
            held = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            key, salt = held.column("digit").to_numpy(), held.column("salt").to_numpy()
            ends = np.flatnonzero((key[1:] != key[:-1]) | (salt[1:] != salt[:-1]))
            if held.num_rows >= 4 * GROUP and len(ends):
                yield from flush(held.slice(0, int(ends[-1]) + 1))
                held = held.slice(int(ends[-1]) + 1)
        if held is not None and held.num_rows:
            yield from flush(held)

    kind = pieces.schema["doc_id"].dataType.simpleString()
    return pieces.mapInArrow(run, f"doc_id {kind}, crc long, lo long, hi long, digit long, window long, state int")


def repeated_spans(docs: DataFrame, depth: int, digit: int, repeats: bool) -> DataFrame:
    """``doc_id``, ``crc``, ``lo``, ``hi``: byte spans that repeated windows cover; they may overlap."""
    all_cells = materialise(find_cells(docs, depth, digit), "cells")
    shared = all_cells.groupBy("digit").agg(F.count("*").alias("m")).where("m > 1")
    kept = materialise(all_cells.join(shared, "digit"), "digit-cells")
    twins = kept.groupBy("digit", "whole").agg(F.count("*").alias("w")).where("w > 1")
    kept = materialise(kept.join(twins, ["digit", "whole"], "left"), "told-cells")
    whole = kept.where("w is not null").select("doc_id", "crc", F.col("first").alias("lo"), (F.col("last") + depth).alias("hi"))

    # cells with twins are done but still repeat windows of others: one of each twin group goes on
    head = kept.where("w is not null").groupBy("digit", "whole").agg(F.min(F.struct("doc_id", "crc", "first", "last", "m")).alias("c")).select("c.*", "digit")
    open_ = kept.where("w is null").select("doc_id", "crc", "first", "last", "m", "digit").unionByName(head)
    salt = F.when(F.col("m") > GROUP, F.pmod(F.xxhash64("doc_id", "first"), F.ceil(F.col("m") / (GROUP // 2))).cast("int")).otherwise(F.lit(-1))
    spots = open_.groupBy("doc_id", "crc").agg(F.collect_list(F.struct("first", "last", "digit", salt.alias("salt"))).alias("spots"))
    spots = spots.select(F.col("doc_id").alias("_id"), F.col("crc").alias("_crc"), "spots")
    found = docs.dropDuplicates(["doc_id", "crc"]) if repeats else docs
    found = found.join(spots.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("crc") == F.col("_crc")))
    dealt = cell_bytes(found, depth)
    dealt = dealt.repartition("digit", "salt").sortWithinPartitions("digit", "salt")
    told = materialise(deepest(dealt, depth), "windows")
    across = told.where("state != 1").groupBy("digit", "window").agg(F.count("*").alias("n"), F.max("state").alias("s")).where("n > 1").select("digit", "window")
    late = told.where("state = 0").join(across, ["digit", "window"]).select("doc_id", "crc", "lo", "hi")
    return whole.unionByName(told.where("state = 1").select("doc_id", "crc", "lo", "hi")).unionByName(late)


def keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``doc_id, crc, text``, and whether two rows have one id and one text.

    ``crc`` is a 64-bit hash that tells the texts of one id apart: where two of them, by their MD5, share it, another seed is taken.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    for seed in itertools.count(1):
        made = docs.select("doc_id", hashed(body, seed).alias("crc"), body.alias("text"))
        told = made.select("doc_id", "crc", F.md5(F.col("text").cast("binary")).alias("whole"))
        again = told.groupBy("doc_id", "crc").agg(F.count(F.lit(1)).alias("n"), F.min("whole").alias("a"), F.max("whole").alias("b")).where("n > 1")
        state = again.agg(F.count(F.lit(1)), F.count(F.when(F.col("a") != F.col("b"), 1))).first()
        if not state[1]:
            return made, state[0] > 0


def hashed(body: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), body)


def without_repeats(docs: DataFrame, depth: int = DEPTH, digit: int = DIGIT) -> DataFrame:
    """Per row ``doc_id``, ``kept`` (the bytes left), ``n_bytes``, ``n_removed``, ``n_spans``."""
    ready(docs.sparkSession)
    docs, repeats = keyed(docs)
    spans = materialise(repeated_spans(docs, depth, digit, repeats), "spans")
    # equal rows have equal spans
    spans = (spans.distinct() if repeats else spans).groupBy("doc_id", "crc").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    spans = spans.select(F.col("doc_id").alias("_id"), F.col("crc").alias("_crc"), "spans")
    both = docs.join(spans.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("crc") == F.col("_crc")), "left")

    def run(batches):
        for b in blocks(batches):
            data, at = raw(b.column("text"))
            kept, size, gone, count = [], [], [], []
            for i, listed in enumerate(b.column("spans").to_pylist()):
                text = data[at[i] : at[i + 1]]
                change = np.zeros(len(text) + 1, np.int32)
                for s in listed or ():
                    change[s["lo"]] += 1
                    change[s["hi"]] -= 1
                cover = np.cumsum(change[:-1]) > 0
                kept.append(text[~cover].tobytes())
                size.append(len(text))
                gone.append(int(cover.sum()))
                count.append(int((cover[1:] & ~cover[:-1]).sum() + (len(cover) > 0 and cover[0])))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (size, gone, count))], ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return both.select("doc_id", "text", "spans").mapInArrow(run, f"doc_id {kind}, kept binary, n_bytes long, n_removed long, n_spans long")


def brute_force(texts: list[bytes], depth: int = DEPTH) -> list[tuple[int, int, int, str]]:
    """The same figures by counting every window, for tests."""
    seen: dict[bytes, int] = {}
    for t in texts:
        for p in range(len(t) - depth + 1):
            seen[t[p : p + depth]] = seen.get(t[p : p + depth], 0) + 1
    out = []
    for t in texts:
        cover = [False] * len(t)
        for p in range(len(t) - depth + 1):
            if seen[t[p : p + depth]] > 1:
                cover[p : p + depth] = [True] * depth
        left = bytes(c for c, gone in zip(t, cover, strict=True) if not gone)
        spans = sum(c and not (i and cover[i - 1]) for i, c in enumerate(cover))
        out.append((len(t), sum(cover), spans, hashlib.sha256(left).hexdigest()))
    return out


def op2_suffix_array(spark, sf_dir: str) -> DataFrame:
    out = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
