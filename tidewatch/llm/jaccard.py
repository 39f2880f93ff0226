"""Near duplicates by word-shingle Jaccard similarity, with prefix filters under several global token orders.

Two sets of similarity t share one of their first ``n - ceil(t n) + 1`` tokens under any order that is the same for all
documents. The first order puts rare tokens first (by a fixed-size count sketch over all documents, so that passages which
many documents share stand last) and makes the candidates: documents in one token's list. The second (same counts, other
ties) and third (a hash) must agree before a pair's sets are compared. Any sketch gives a valid order, so results are exact.

Equal sets are one node. A list of m nodes is not expanded into pairs: all are compared with its leader, the node whose
prefix is shared most, which then leaves the list. Lists whose nodes are in one component by then are done; after three
such rounds pairs are made between nodes of a list that lie in different components. Pairs inside a component cannot change it. Tokens and nodes are spread by grouped minima and joins, which Spark splits when a key is hot.

Sizes: the sketch is ``2 ** BITS`` counters and the filter of candidate documents ``2 ** FILTER`` bits, whatever the input; only they
are collected and shipped. Both only order and prune: wrong guesses cost time, not links.

A-Z is lower-cased; words are runs of bytes other than space and tab to carriage return. Null and empty texts, and texts
without words, have no shingles and link with nothing. Fewer words than the width are one shingle. Repeated rows are equal sets;
a null id keeps its row and never names a component. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import components, ready, table
from tidewatch.llm.text import blocks, mix, raw, shingles
from tidewatch.session import materialise

WIDTH, PERCENT = 5, 75
BITS, PART, FILTER, STARS = 20, 14, 26, 3
_TIES = (np.uint64(0x51ED270B9F3C6D2F), np.uint64(0xC3A5C85C97CB3127), np.uint64(0x9AE16A3B2F90404F))


def needed(n, percent: int):
    """The least overlap that two sets can have of which the larger has n tokens."""
    return -(-percent * n // 100)


def order_key(tokens: np.ndarray, levels: np.ndarray, which: int) -> np.ndarray:
    """Place of each token in one of the three global orders."""
    tie = mix(tokens ^ _TIES[which])
    if which == 2:
        return tie
    return (levels[(tokens >> np.uint64(64 - BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (tie >> np.uint64(8))


def prefix(tokens: np.ndarray, levels: np.ndarray, which: int, percent: int) -> np.ndarray:
    """The tokens that count, in the order's sequence."""
    n = len(tokens)
    k = n - needed(n, percent) + 1
    key = order_key(tokens, levels, which)
    if k < n:
        part = np.argpartition(key, k - 1)[:k]
        tokens, key = tokens[part], key[part]
    return tokens[np.argsort(key)]


def parity(tokens: np.ndarray) -> bytes:
    """For each slot, whether an odd number of tokens falls there; two to four slots a token, folded by xor to any smaller power of two."""
    slots = 1 << max(6, int(2 * len(tokens) - 1).bit_length()) if len(tokens) else 64
    odd = np.bincount(((tokens >> np.uint64(7)) & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differ_at_least(x: bytes, y: bytes) -> int:
    """A lower bound on the tokens that one of two sets has and the other has not."""
    x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def describe(docs: DataFrame, width: int = WIDTH, salt: int = 0, keys: tuple[str, ...] = ("doc_id",)) -> tuple[DataFrame, np.ndarray]:
    """``keys``, ``n``, ``sid`` (a hash of the set), ``check`` (a second one), ``marks`` per row, and each counter's level."""
    def run(batches):
        counts = np.zeros(1 << BITS, np.int32)
        for b in blocks(batches):
            sets = shingles(*raw(b.column("text")), width)
            n = np.array([len(s) for s in sets])
            flat = np.concatenate(sets)
            at = np.concatenate(([0], np.cumsum(n)))
            counts += np.bincount((flat >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS).astype(np.int32)
            marks = [parity(x) for x in sets]
            ids = []
            for seed in (salt + 1, salt + 1_000_003):
                run_ = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(flat ^ mix(np.array([seed], np.uint64))), dtype=np.uint64)))
                ids.append(mix(run_[at[1:]] - run_[at[:-1]] + n.astype(np.uint64)).view(np.int64))
            none = pa.nulls(len(n))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keys), pa.array(n.astype(np.int64)), pa.array(ids[0]), pa.array(ids[1]), pa.array(marks, pa.binary()), none.cast(pa.int32()), none.cast(pa.binary())], names)
        if counts.any():
            parts = counts.reshape(-1, 1 << PART)
            none = pa.nulls(len(parts))
            yield pa.RecordBatch.from_arrays([*(none.cast(k) for k in kinds), none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.binary()), pa.array(np.arange(len(parts), dtype=np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())], names)

    from pyspark.sql.pandas.types import to_arrow_type

    names = [*keys, "n", "sid", "check", "marks", "part", "counts"]
    types = [docs.schema[c].dataType for c in keys]
    kinds = [to_arrow_type(t) for t in types]
    told = ", ".join(f"{c} {t.simpleString()}" for c, t in zip(keys, types, strict=True))
    both = docs.select(*keys, F.col("text").cast("string").alias("text")).mapInArrow(run, f"{told}, n long, sid long, check long, marks binary, part int, counts binary")
    both = materialise(both, "shingle-sets")

    def summed(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                one = np.frombuffer(c.as_buffer(), np.int32)
                total[k] = total[k] + one if k in total else one.astype(np.int64)
        for k, c in total.items():
            level = (2 * np.log2(c + 1.0)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["part", "level"])

    parts = 1 << (BITS - PART)
    got = both.where("part is not null").select("part", "counts").repartition(parts, "part").mapInArrow(summed, "part int, level binary").collect()
    levels = np.zeros((parts, 1 << PART), np.uint8)
    for r in got:
        levels[r.part] = np.frombuffer(r.level, np.uint8)
    return both.where("part is null").select(*keys, "n", "sid", "check", "marks"), levels.reshape(-1)


def token_lists(docs: DataFrame, levels, width: int, percent: int, salt: int) -> DataFrame:
    """``token``, ``sid``, ``n``, ``pos`` (place in the order): the first order's prefixes, without tokens that occur once.

    The prefixes are made twice, not stored.
    """
    def run(batches):
        table_, seen = levels.value, set()
        for b in blocks(batches):
            tokens, owners, sizes, places = [], [], [], []
            for s, sid in with_ids(b, width, salt):
                if len(s) and sid not in seen:
                    seen.add(sid)
                    p = prefix(s, table_, 0, percent)
                    tokens.append(p)
                    owners.append(np.full(len(p), sid, np.int64))
                    sizes.append(np.full(len(p), len(s), np.int32))
                    places.append(np.arange(len(p), dtype=np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), *(pa.array(np.concatenate(x)) for x in (owners, sizes, places))], ["token", "sid", "n", "pos"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "token long, sid long, n int, pos int")
    shared = materialise(rows.groupBy("token").agg(F.count("*").alias("m")).where("m > 1").select("token"), "shared-tokens")
    return materialise(rows.join(shared, "token"), "token-lists")


def with_ids(batch: pa.RecordBatch, width: int, salt: int):
    """Each text's shingles and the id of the set, as in ``describe``."""
    sets = shingles(*raw(batch.column("text")), width)
    n = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    at = np.concatenate(([0], np.cumsum(n)))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(flat ^ mix(np.array([salt + 1], np.uint64))), dtype=np.uint64)))
    ids = mix(total[at[1:]] - total[at[:-1]] + n.astype(np.uint64)).view(np.int64)
    return zip(sets, ids.tolist(), strict=True)


def bitmap(ids: DataFrame, bits: int = FILTER) -> np.ndarray:
    """One bit for each hash of ``sid``: a filter of fixed size without false negatives."""
    place = F.shiftrightunsigned(F.col("sid"), 64 - bits) + 1  # Spark's bitmaps count from 1
    rows = ids.groupBy(F.bitmap_bucket_number(place).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows:
        piece = np.frombuffer(r.bits, np.uint8)
        out[(r.k - 1) * len(piece) : r.k * len(piece)] = piece
    return out


def tokens_of(docs: DataFrame, pairs: DataFrame, width: int, salt: int) -> DataFrame:
    """``sid``, ``at``, ``tokens`` (8 bytes each) of the sets in ``pairs``, by another pass over the texts.

    ``at`` tells equal sets of several documents apart.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    kept = docs.sparkSession.sparkContext.broadcast(bitmap(ids))

    def run(batches):
        bits = kept.value
        for b in blocks(batches):
            hit, sids, sets = [], [], []
            for i, (s, sid) in enumerate(with_ids(b, width, salt)):
                at = (sid % 2**64) >> (64 - FILTER)
                if len(s) and bits[at >> 3] >> (at & 7) & 1:
                    hit.append(i)
                    sids.append(sid)
                    sets.append(s.tobytes())
            if hit:
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(hit)), pa.array(sids, pa.int64()), pa.array(sets, pa.binary())], ["doc_id", "sid", "tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    sets = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, sid long, tokens binary")
    return materialise(sets.select("sid", F.xxhash64("doc_id").alias("at"), "tokens"), "tokens")


def compared(pairs: DataFrame, with_: DataFrame, test) -> DataFrame:
    """The rows of ``pairs`` whose two values, by ``sid`` and ``at``, pass ``test``."""
    def run(batches):
        for batch in batches:
            good = [test(x, y) for x, y in zip(batch.column("x"), batch.column("y"), strict=True)]
            yield batch.select(names).filter(pa.array(good, pa.bool_()))

    names = ["a", "a_at", "b", "b_at"]
    for side, to in (("a", "x"), ("b", "y")):
        pairs = pairs.join(with_.select(F.col("sid").alias(side), F.col("at").alias(f"{side}_at"), F.col(with_.columns[-1]).alias(to)), [side, f"{side}_at"])
    return pairs.select(*names, "x", "y").mapInArrow(run, "a long, a_at long, b long, b_at long")


def linked(docs: DataFrame, base: DataFrame, pairs: DataFrame, levels, width: int, percent: int, salt: int) -> DataFrame:
    """The similar pairs ``a``, ``b`` among candidates.

    A pair is left out when its parity marks show that the sets differ in too many tokens, then when it shares no prefix
    token under the second or third order; the sets of those that stay are compared.
    """
    one = base.groupBy("sid").agg(F.min(F.xxhash64("doc_id")).alias("at"), F.max("n").alias("n"))
    for side in ("a", "b"):
        pairs = pairs.join(one.select(F.col("sid").alias(side), F.col("at").alias(f"{side}_at"), F.col("n").alias(f"n_{side}")), side)
    near = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    # both sets together have n_a + n_b = 2 * shared + different, and similar ones share percent / (100 + percent) of it at least
    pairs = pairs.where(near).withColumn("most", F.floor((F.col("n_a") + F.col("n_b")) * (100 - percent) / (100 + percent)))

    def close(batches):
        for batch in batches:
            most = batch.column("most").to_pylist()
            good = [differ_at_least(x.as_py(), y.as_py()) <= m for x, y, m in zip(batch.column("x"), batch.column("y"), most, strict=True)]
            yield batch.select(["a", "a_at", "b", "b_at"]).filter(pa.array(good, pa.bool_()))

    marks = base.select("sid", F.xxhash64("doc_id").alias("at"), "marks").dropDuplicates(["sid", "at"])
    for side, to in (("a", "x"), ("b", "y")):
        pairs = pairs.join(marks.select(F.col("sid").alias(side), F.col("at").alias(f"{side}_at"), F.col("marks").alias(to)), [side, f"{side}_at"])
    pairs = pairs.select("a", "a_at", "b", "b_at", "most", "x", "y").mapInArrow(close, "a long, a_at long, b long, b_at long")
    pairs = materialise(pairs, "close-pairs")
    if pairs.isEmpty():
        return pairs.select("a", "b")

    def similar(x, y):
        x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
        for which in (1, 2):
            if not len(np.intersect1d(prefix(x, levels.value, which, percent), prefix(y, levels.value, which, percent), assume_unique=True)):
                return False
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    return materialise(compared(pairs, tokens_of(docs, pairs, width, salt), similar).select("a", "b").distinct(), "links")


def rooted(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys``, ``n``, ``root`` (the set that names the component) per row; similar are sets with 100 * both >= ``percent`` * either."""
    spark = ready(docs.sparkSession)
    salt = 0
    while True:
        base, levels = describe(docs, width, salt, keys)
        if not base.groupBy("sid").agg((F.min("check") != F.max("check")).alias("bad")).where("bad").limit(1).count():
            break
        salt += 7  # two sets with one id: hash anew
    shipped = spark.sparkContext.broadcast(levels)
    lists = token_lists(docs, shipped, width, percent, salt)

    # a set most of whose prefix other sets share too is likely the one that others were made from
    score = lists.groupBy("sid").agg((F.count("*") / F.first("n")).alias("score"))
    # counted at its first shared token, a pair of sets with the overlap it needs has that many tokens left in both
    room = f"least(nu - pu, nv - pv) * {100 + percent} >= {percent} * (nu + nv)"
    rest = materialise(lists.distinct().join(score, "sid"), "scored-lists")
    links, groups, tried = None, None, None
    for last in (False,) * STARS + (True,):
        mixed = rest.groupBy("token").agg(
            F.min(F.coalesce("component", "sid") if groups is not None else F.col("sid")).alias("lo"),
            F.max(F.coalesce("component", "sid") if groups is not None else F.col("sid")).alias("hi"),
            F.max(F.struct("score", "sid", "n", "pos")).alias("lead"),
        ).where("lo < hi").select("token", "lead")
        rest = materialise(rest.join(mixed, "token"), "mixed-lists")
        if rest.isEmpty():
            break
        if last:
            left = rest.select("token", F.col("sid").alias("u"), F.col("component").alias("cu"), F.col("n").alias("nu"), F.col("pos").alias("pu"))
            other = rest.select("token", F.col("sid").alias("v"), F.col("component").alias("cv"), F.col("n").alias("nv"), F.col("pos").alias("pv"))
            pairs = left.join(other, "token").where("u < v and coalesce(cu, u) != coalesce(cv, v)").where(room)
        else:
            pairs = rest.where("sid != lead.sid").select(F.col("sid").alias("u"), F.col("n").alias("nu"), F.col("pos").alias("pu"), F.col("lead.sid").alias("v"), F.col("lead.n").alias("nv"), F.col("lead.pos").alias("pv")).where(room)
        pairs = pairs.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "candidate-pairs")
        tried = pairs if tried is None else tried.union(pairs)
        found = linked(docs, base, pairs, shipped, width, percent, salt)
        if not found.isEmpty():
            links = found if links is None else links.union(found)
            groups = components(links)
        # a leader has met its whole list
        rest = rest.where("sid != lead.sid").select("token", "sid", "n", "pos", "score")
        placed = groups.select(F.col("node").alias("sid"), "component") if groups is not None else None
        rest = rest.join(placed, "sid", "left") if placed is not None else rest.withColumn("component", F.lit(None).cast("long"))

    if groups is None:
        groups = base.select(F.col("sid").alias("node"), F.col("sid").alias("component")).limit(0)
    rows = base.join(groups.withColumnRenamed("node", "sid"), "sid", "left")
    return materialise(rows.select(*keys, "n", F.coalesce("component", "sid").alias("root")), "rooted")


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` per row; similar are sets with 100 * both >= ``percent`` * either."""
    rows = rooted(docs, width, percent)
    least = rows.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = rows.where("n > 0").join(least, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One document of each component, that with the smallest id (a null id only where all are null); of equal rows of one id one stays.

    Texts without words are in no component and stay, each once for an id and text.
    """
    key = F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256))
    rows = rooted(docs.select("doc_id", "text", key.alias("_sha")), width, percent, ("doc_id", "_sha"))
    rows = rows.groupBy("root", "doc_id", "_sha").agg(F.max("n").alias("n"), F.count("*").alias("_n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("_keep"), "_sha", "_n")).alias("one")
    keep = rows.where("n > 0").groupBy("root").agg(first).select("one._keep", "one._sha", "one._n")
    keep = materialise(keep.unionByName(rows.where("n = 0").select(F.col("doc_id").alias("_keep"), "_sha", "_n")), "kept")
    # the kept ids grow with the documents: joined by sorting at every size
    found = docs.withColumn("_text_sha", key).join(keep.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_keep")) & (F.col("_text_sha") == F.col("_sha")))
    cols = [F.col(f"`{c}`") for c in docs.columns]
    if keep.where("_n > 1").limit(1).count() == 0:
        return found.select(*cols)
    return found.where("_n = 1").select(*cols).unionByName(found.where("_n > 1").dropDuplicates(["_keep", "_sha"]).select(*cols))


def op10_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
g AS (
  SELECT doc_id, CASE WHEN len(words) >= 5 THEN list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS grams FROM w),
s AS (SELECT doc_id, unnest(grams) AS gram FROM g),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  JOIN g ga ON ga.doc_id = a.doc_id JOIN g gb ON gb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, len(ga.grams), len(gb.grams)
  HAVING 100 * count(*) >= 75 * (len(ga.grams) + len(gb.grams) - count(*))),
reach AS (SELECT doc_id, doc_id AS other FROM g UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.other)
SELECT doc_id, any_value(len(grams)) AS n_shingles, min(other) AS component_id FROM g JOIN reach USING (doc_id) GROUP BY doc_id"""
