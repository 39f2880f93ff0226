"""Periodic runs, subwords and whitening: against brute force, the library and numpy, and the awkward cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidewatch.llm import periods, subwords, whitening

SF = "/root/testdata/sf0.001"
MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))
KIND = "doc_id long, text string, size int, runs string, ids int, x int"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    texts = [(1, "tick tock " * 900), (2, None), (3, ""), (4, " \n\t "), (5, "a a a a a a b"), (5, "a a a a a a b"), (None, "x y x y x y x y"), (6, " ".join(f"w{i}" for i in range(20_000)))]
    return spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in texts], KIND)


# ------------------------------------------------------------ runs

def brute_runs(words: list, shortest: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """Start, length, period of every run, by trying all periods."""
    n, out = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, times * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def drawn(rng: random.Random) -> list[str]:
    n, kind = rng.randint(0, 130), rng.randint(0, 4)
    if kind == 0:
        return [rng.choice("ab") for _ in range(n)]
    if kind == 1:
        return ["a"] * n
    noise = lambda: [rng.choice("xyab") for _ in range(rng.randint(0, 9))]
    if kind == 2:
        return noise() + ([rng.choice("abc") for _ in range(rng.randint(1, 25))] * 130)[:n] + noise()
    if kind == 3:
        return [rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)]
    return ([str(i) for i in range(rng.randint(1, 40))] * 30)[: rng.randint(0, 400)]


def test_transform_is_exact():
    rng = np.random.default_rng(2)
    for width in (1, 2, 8, 64):
        block, window = rng.integers(0, 10**6, (5, width)), rng.integers(0, 10**6, (5, 2 * width))
        want = [[int(((b - w[s : s + width]) ** 2).sum()) % periods.PRIME for s in range(width)] for b, w in zip(block, window)]
        assert periods.squared_differences(block, window).tolist() == want


def test_runs_against_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        docs = [drawn(rng) for _ in range(rng.randint(0, 8))]
        _, words, first = periods.numbered([" ".join(d) for d in docs])
        want = [(s + lo, s + lo + n, q) for d, lo in zip(docs, first.tolist()) for s, n, q in brute_runs(d)]
        assert sorted(map(tuple, periods.all_runs(words, first).tolist())) == sorted(want)


def test_zero_sums_are_compared_word_by_word(monkeypatch):
    """With a small prime many sums vanish by chance; the runs stay the same."""
    monkeypatch.setattr(periods, "PRIME", 257)
    rng = random.Random(8)
    for _ in range(40):
        d = drawn(rng)[:60]
        _, words, first = periods.numbered([" ".join(d)])
        assert [(s, e - s, q) for s, e, q in periods.all_runs(words, first).tolist()] == brute_runs(d)


def test_periodic_query_against_brute_force(spark):
    got = {r.doc_id: r for r in periods.op11_periodic_runs(spark, SF).collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        h, n = zlib.crc32(str(d.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        r = got.pop(d.doc_id)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r.collapsed_sha256 == sha(" ".join(w for i, w in enumerate(words) if i not in dropped))
    assert not got


def test_periodic_odd(spark, odd):
    rows = periods.find_runs(odd).collect()
    got = {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed) for r in rows}
    assert len(rows) == 8 and got[1] == ([(0, 1800, 2)], "tick tock") and got[2] == got[3] == got[4] == ([], "")
    assert got[5] == ([(0, 6, 1)], "a b") and got[None] == ([(0, 8, 2)], "x y") and got[6][0] == []
    assert periods.find_runs(odd.where("false")).count() == 0
    planted = odd.select("doc_id", periods.with_planted_periods(F.col("doc_id"), F.col("text")).alias("text"))
    assert periods.find_runs(planted).count() == 8


# ------------------------------------------------------------ subwords

def test_subwords_against_the_library():
    m, sp = subwords.Model(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(1)
    parts = ["▁", " ", "  ", "a", "b", "e", "th", "in", "1", "\n", "\t", "é", "́", "😀", "中", "国", "ก", "<0x41>", "<s>", "ا", "‍", "Z", "--", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 16))) for _ in range(8000)]
    texts += ["a" * 4000, " " * 777, "ab" * 3000, "中国" * 2000, "=-" * 1000, "", "the" * 3000]
    for t in texts:
        ids = m.ids_of(t)
        assert ids == sp.encode(t) and m.decode(ids) == sp.decode(ids)


def test_subwords_when_tables_are_emptied(monkeypatch):
    monkeypatch.setattr(subwords, "HELD", 3)
    m, sp = subwords.Model(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    t = "an unusual sentence about forecasting, thereof and otherwise unmistakably"
    assert m.ids_of(t) == sp.encode(t) and max(map(len, (m.words, m.parts, m.pairs))) <= 3


def test_backtracking_undoes_a_longest_match():
    """Some text whose longest first match is not its first token."""
    m = subwords.Model(MODEL)
    words = [w for w in ("▁therein", "▁rethink", "▁ofthere", "▁whatever", "▁misthe", "▁lesthan") if m.tokens(w)]
    longest = lambda w: max((p for p in m.ids if w.startswith(p)), key=len)
    assert any(m.name[m.tokens(w)[0]] != longest(w) for w in words)


def test_subwords_query_and_odd(spark, odd):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r for r in subwords.op12_subwords(spark, SF).collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids, r = sp.encode(d.text or ""), got.pop(d.doc_id)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)))
    assert not got
    back = subwords.decode(subwords.encode(odd, MODEL), MODEL).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == sorted((r.doc_id or 0, r.text or "") for r in odd.collect())
    assert subwords.decode(subwords.encode(odd.where("false"), MODEL), MODEL).count() == 0


# ------------------------------------------------------------ whitening

def direct(vectors: np.ndarray, k: int = 32):
    x = np.floor(64 * vectors).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    c = x - s / n
    values, turn = np.linalg.eigh(c.T @ c / n)
    values, turn = values[::-1], turn[:, ::-1]
    return ((n * x - s) ** 2).sum(1), c @ turn[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def test_whitening_query_against_numpy(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    deviation, z, explained = direct(np.array([r.embedding for r in rows], float))
    got = whitening.op13_whitening(spark, SF).orderBy("vec_id", "component").collect()
    assert len(got) == z.size and {r.n for r in got} == {len(rows)} and {r.component for r in got} == set(range(1, z.shape[1] + 1))
    held = np.array([r.whitened for r in got]).reshape(z.shape)
    assert np.abs(held - z * np.sign((held * z).sum(0))).max() < 1e-9
    assert [r.deviation for r in got[:: z.shape[1]]] == deviation.tolist()
    assert np.allclose([r.explained for r in got[: z.shape[1]]], explained, rtol=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_whitening_odd(spark, monkeypatch):
    monkeypatch.setattr(whitening, "HOT", 20)
    rng = np.random.default_rng(3)
    good = rng.normal(size=(90, 4))
    good = np.concatenate([good, np.repeat(good[:1], 60, 0)])  # a hot vector, joined by broadcast
    rows = [(i % 140, v.tolist(), 1, "n") for i, v in enumerate(good)]
    bad = [(900, None), (901, []), (902, [1.0, None, 0.0, 0.0]), (903, [float("nan"), 0.0, 0.0, 0.0]), (904, [float("-inf"), 0.0, 0.0, 0.0]), (905, [1.0, 2.0])]
    kind = "vec_id long, embedding array<double>, x int, n string"
    df = spark.createDataFrame(rows + [(i, v, 1, "n") for i, v in bad] + [(None, good[0].tolist(), 1, "n")], kind)
    got = whitening.whiten(df).collect()
    every = np.concatenate([good, good[:1]])
    deviation, z, _ = direct(every, 4)
    assert len(got) == len(every) and sorted(r.deviation for r in got) == sorted(deviation.tolist())
    held = np.array([r.whitened for r in got])
    assert np.allclose(held.T @ held / len(every), np.eye(4), atol=1e-9) and len(held[0]) == 4
    once = whitening.whiten(df, weight="one").first()
    assert once.n == 90 and once.identity_error < 1e-9
    assert whitening.whiten(df.where("false")).count() == whitening.whiten(df.where("vec_id >= 900")).where("size(whitened) > 1").count() == 0
    same = whitening.whiten(df.where("vec_id = 0").limit(1).unionAll(df.where("vec_id = 0").limit(1))).collect()
    assert [list(r.whitened) for r in same] == [[], []]
    huge = whitening.whiten(spark.createDataFrame([(i, [3e300 * (i % 3), float(i), -1e308]) for i in range(30)], "vec_id int, embedding array<double>")).collect()
    assert len(huge) == 30 and all(np.isfinite(r.whitened).all() for r in huge)


def test_deviations_past_a_long():
    x = np.array([[0], [1 << 40]])
    assert whitening.deviations(x, 2, [1 << 40], 1 << 40) == [None, None]
    assert whitening.deviations(x[:1], 1, [3], 5) == [9]
