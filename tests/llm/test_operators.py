"""The ten operators on small tables: against brute force, round trips or held-out labels, and the awkward cases."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.oracle import compare, connect
from tidewatch.llm import embeddings, exact, jaccard, language, mixing, packing, quality, suffix, surrogates, toxicity

SF = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, size int, recipe string, n int, sid int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, columns with names the operators use themselves."""
    long = " ".join(f"word{i % 977} and{i % 613}" for i in range(30_000))
    texts = [(1, "same text here for all of us"), (2, "same text here for all of us"), (3, None), (4, ""), (5, long), (6, long), (6, long), (None, "lonely"), (7, " \n\t ")]
    return spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in texts], KIND)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KIND)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_exact_agrees_with_sql(spark):
    assert compare(exact.op4_exact_dedup(spark, SF), connect(SF), exact.ORACLE) is None


def test_exact_odd(odd, empty):
    got = by_id(exact.exact_groups(odd))
    assert (got[1].keep_id, got[1].group_size, got[1].kept) == (2, 2, False) and got[2].kept
    assert got[3].keep_id == 4 and got[3].text_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[5].keep_id == 6 and got[5].group_size == 3 and got[None].kept
    assert exact.drop_exact(odd).count() == 5 and exact.exact_groups(empty).count() == 0


def test_suffix_against_brute_force(spark, odd, empty):
    rng = random.Random(3)
    line = "".join(rng.choice("abcdefgh ") for _ in range(700))
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 900))) for _ in range(30)]
    texts += [t[: len(t) // 2] + line[rng.randint(0, 200) : rng.randint(300, 700)] + t[len(t) // 2 :] for t in texts]
    texts += ["a" * 500, "ab" * 300, "é" * 260, line, line]
    got = suffix.without_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    want = suffix.brute_force([t.encode() for t in texts])
    assert [(r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got] == want
    rows = by_id(suffix.without_repeats(odd))
    assert rows[3].n_bytes == 0 and rows[5].n_removed == rows[5].n_bytes and suffix.without_repeats(empty).count() == 0


def test_jaccard_against_brute_force(spark, odd, empty):
    rng = random.Random(5)
    base = [[f"w{rng.randint(0, 400)}" for _ in range(rng.randint(1, 80))] for _ in range(12)]
    texts = []
    for words in base:
        for _ in range(8):
            w = list(words)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = f"x{rng.randint(0, 999)}"
            texts.append(" ".join(w).upper() if rng.random() < 0.3 else " ".join(w))

    def grams(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = [grams(t) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    got = jaccard.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id) for r in got] == [(len(s), k) for s, k in zip(sets, label, strict=True)]
    rows = by_id(jaccard.near_duplicates(odd.select("doc_id", "text")))
    assert rows[3].n_shingles == 0 and rows[3].component_id == 3 and rows[2].component_id == 1 and rows[6].component_id == 5
    assert jaccard.one_of_each(odd).count() == 6 and jaccard.near_duplicates(empty.select("doc_id", "text")).count() == 0


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(20, 16))
    x = np.concatenate([centre + rng.normal(size=centre.shape) * 0.12 for _ in range(12)])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, x[0].tolist()), (904, [1.0]), (905, [None] * 16)]
    got = {r.vec_id: r for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    y = np.concatenate([x, x[:1]])
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    want = ((y @ y.T) >= 0.9).sum(1) - 1
    found = np.array([got[i].n_links for i in [*range(len(x)), 903]])
    assert (found <= want).all() and found.sum() >= 0.9 * want.sum()
    assert all(got[i].n_links == 0 and got[i].kept for i in (900, 901, 902, 904, 905)) and got[903].component_id == got[0].component_id
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_packing_round_trip(spark, odd, empty):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(40).collect()] + ["<|endoftext|> 中 \n\n  x's", "", None]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack_documents(docs).collect()
    for i, text in enumerate(texts):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        mine = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert sum(r.length for r in mine) == len(ids) == mine[0].doc_tokens
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in mine)
    for s in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert packing.pack_documents(odd).where("doc_id = 6").count() % 2 == 0 and packing.pack_documents(empty).count() == 0


def test_mixing_meets_targets(spark, odd, empty):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out, names = mixing.mix(docs, mixing.label_domains(labels), mixing.WEIGHTS)
    rows = out.collect()
    whole = sum(r.tokens for r in rows)
    for k, name in enumerate(names):
        assert abs(sum(r.rate * r.tokens * r[f"p{k}"] for r in rows) / whole - mixing.WEIGHTS[name]) < 1e-3
    assert min(r.rate for r in rows) >= 0
    none = spark.createDataFrame([], "doc_id long, domain string")
    assert all(abs(r.rate - 1) < 1e-9 for r in mixing.mix(odd, none, {})[0].collect()) and mixing.mix(empty, none, {})[0].count() == 0


def accuracy(spark, got, column):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = got.where("held_out").join(labels, "doc_id").collect()
    return np.mean([r[column] == r.predicted for r in rows])


def test_classifiers_held_out(spark, odd, empty):
    sf = "/root/testdata/sf0.01"
    assert accuracy(spark, quality.op5_quality(spark, sf), "quality") > 0.93
    assert accuracy(spark, toxicity.op3_toxicity(spark, sf), "toxic") > 0.85
    said = language.op6_language_id(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in said]) > 0.98
    none = spark.createDataFrame([], "doc_id long, label int")
    for docs, n in ((odd, 9), (empty, 0)):
        assert quality.score(docs, quality.train(docs, none)).where("score between 0 and 1").count() == n
        assert toxicity.score(docs, toxicity.train(docs, none)).where("score between 0 and 1").count() == n
        assert language.predict(docs, language.train(docs.selectExpr("text", "'en' AS lang"))).count() == n
    spoken = by_id(language.predict(odd, language.train(odd.selectExpr("text", "'en' AS lang"))))
    assert spoken[3].lang_pred == spoken[4].lang_pred == spoken[7].lang_pred == "und" and spoken[1].lang_pred == "en"


def test_surrogates(spark, odd, empty):
    texts = [(1, "Mrs. Smith, +1 (807) 555-5623, a.b@mail.org"), (2, "+1-807-555-5623 A.B@mail.org 39.73.140.133 password=c1f6c02f845bf302"), (3, "4425414259157784"), (4, None), (5, "")]
    got = {r.doc_id: r for r in surrogates.replace(spark.createDataFrame(texts, "doc_id long, text string"), "k").collect()}
    assert [got[i].n_entities for i in range(1, 6)] == [3, 4, 1, 0, 0] and got[4].text is None and got[5].text == ""
    for leak in ("Smith", "555-5623", "a.b@", "39.73", "c1f6c0", "44254142"):
        assert all(leak not in (r.text or "") for r in got.values())
    digits = lambda t: "".join(c for c in t.split("@")[0] if c.isdigit())[:11]
    assert digits(got[1].text) == digits(got[2].text)
    card = [int(c) for c in reversed(got[3].text)]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(card)) % 10 == 0
    assert surrogates.replace(odd, "k").count() == 9 and surrogates.replace(empty, "k").count() == 0


def test_surrogates_leave_no_part_of_a_secret(spark):
    rng = random.Random(9)
    draw = lambda n: "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789") for _ in range(n))
    long, parts, upper, padded = draw(300), [draw(20) for _ in range(3)], "9233A8EC" * 4, draw(30)
    texts = [(1, f'TOKEN = "{upper}" Password: {draw(9)}x API_KEY={parts[0]}'), (2, f"secret={long} end"), (3, f"token={'.'.join(parts)}. Next"), (4, f"pwd: {padded}~{padded}== end")]
    got = by_id(surrogates.replace(spark.createDataFrame(texts, "doc_id long, text string"), "k"))
    assert [got[i].n_entities for i in (1, 2, 3, 4)] == [3, 1, 1, 1]
    for i, text in texts:
        assert len(got[i].text) == len(text)
    for i, secret in ((1, upper), (1, parts[0]), (2, long), *((3, p) for p in parts), (4, padded)):
        assert all(secret[at : at + 8] not in got[i].text for at in range(len(secret) - 7))
    assert got[3].text.endswith(". Next") and got[4].text.endswith("== end")
    assert set(got[1].text.split('"')[1]) <= set("0123456789ABCDEF")


def test_suffix_texts_of_one_id_with_one_hash(spark, monkeypatch):
    """A hash that cannot tell two texts of one id apart is seen, and another seed taken; hot ids and repeated rows included."""
    plain = suffix.hashed
    monkeypatch.setattr(suffix, "hashed", lambda body, seed: suffix.F.lit(7).cast("long") if seed == 1 else plain(body, seed))
    rng = random.Random(12)
    draw = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared, texts = draw(260), [draw(rng.randint(3, 700)) for _ in range(40)]
    texts += [texts[3] + shared, shared, "x", texts[5], texts[5]]
    rows = [(None if i % 3 else 9, t) for i, t in enumerate(texts)]
    got = suffix.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = suffix.brute_force([t.encode() for t in texts])
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got) == sorted(want)


def test_surrogates_of_all_short_names(spark):
    """Every two-letter name there is: no surrogate is a real name or given twice."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [a.upper() + b for a in letters for b in letters]
    docs = spark.createDataFrame([(i, f"Mr {n} said so, and Mr {n} left") for i, n in enumerate(names)], "doc_id long, text string")
    texts = [r.text for r in surrogates.replace(docs, "k").collect()]
    found = [t.split()[1] for t in texts]
    assert all(t == f"Mr {n} said so, and Mr {n} left" for t, n in zip(texts, found)) and len(set(found)) == len(names) and not set(found) & set(names)


def test_embeddings_of_one_tight_group(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=16) + rng.normal(size=(600, 16)) * 0.15
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = ((y @ y.T) >= 0.9).sum(1) - 1
    assert (y @ y.T).min() > 0.5 and want.min() > 0
    got = {r.vec_id: r for r in embeddings.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    assert [got[i].n_links for i in range(600)] == want.tolist() and all(r.component_id == 0 for r in got.values())
    assert [got[i].kept for i in range(2)] == [True, False]


def test_one_of_each_keeps_rows_without_id_and_other_texts_of_an_id(spark):
    say = lambda k: " ".join(f"{k}{i}" for i in range(40))
    rows = [(None, say("a")), (None, say("b")), (None, say("b") + " more"), (None, say("c")), (1, say("c") + " more"), (2, say("d")), (2, say("e")), (2, say("e")), (None, ""), (None, " ")]
    got = sorted((r.doc_id or 0, r.text) for r in jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    b = [t for i, t in got if t.startswith("b0")]
    assert len(b) == 1 and b[0] in (say("b"), say("b") + " more")
    assert got == sorted([(0, ""), (0, " "), (0, say("a")), (0, b[0]), (1, say("c") + " more"), (2, say("d")), (2, say("e"))])


def test_pipeline_mixing_keeps_documents_that_are_not_toxic(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    good = docs.join(labels.where("quality = 1"), "doc_id", "left_semi").select(*corpus_pipeline.DOCUMENT)
    before, after = (Counter(r.doc_id for r in d.select("doc_id").collect()) for d in (good, corpus_pipeline.mixed(spark, good, SF)))
    assert all(after[i] >= n for i, n in before.items() if i not in toxic) and toxic & set(before)
    share = lambda c: sum(n for i, n in c.items() if i in toxic) / sum(c.values())
    assert share(after) <= share(before)


def test_mixing_takes_toxic_documents_out_where_posteriors_are_soft(spark):
    """Clean documents with words of toxic ones must not raise all rates until nothing leaves."""
    rng = random.Random(8)
    say = lambda toxic: " ".join(rng.choice("xyz" if rng.random() < toxic else "abc") + str(rng.randint(0, 30)) for _ in range(40))
    kinds = [("clean", 0.1)] * 400 + [("toxic", 0.9)] * 200 + [("clean", 0.75)] * 40 + [(None, 0.1)] * 50 + [(None, 0.9)] * 50
    docs = spark.createDataFrame([(i, say(t)) for i, (_, t) in enumerate(kinds)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(kinds)], "doc_id long, domain string")
    got = Counter(r.doc_id for r in mixing.resample(docs, labels, {"toxic": 0.6}, relative=True).collect())
    toxic = {i for i, (d, t) in enumerate(kinds) if d == "toxic" or (d is None and t > 0.5)}
    assert all(1 <= got[i] <= 2 for i in range(len(kinds)) if i not in toxic) and all(got[i] <= 1 for i in toxic)
    assert 0.4 < sum(got[i] for i in toxic) / len(toxic) < 0.8
    out, names = mixing.mix_within(docs, labels, {"toxic": 0.6})
    rows = out.collect()
    for k, name in enumerate(names):
        had, has = (sum(x * r.tokens * r[f"p{k}"] for x, r in ((w(r), r) for r in rows)) for w in (lambda r: 1.0, lambda r: r.rate))
        assert abs(has - {"toxic": 0.6}.get(name, 1.0) * had) < 1e-4 * sum(r.tokens for r in rows)


def test_mixing_of_awkward_rows_repeats_none_often_and_drops_none_on_a_tie(spark, odd, empty):
    labels = spark.createDataFrame([(1, "clean"), (5, "toxic"), (6, "clean"), (7, "toxic")], "doc_id long, domain string")
    before = Counter((r.doc_id, r.text) for r in odd.collect())
    after = Counter((r.doc_id, r.text) for r in mixing.resample(odd, labels, {"toxic": 0.1}, relative=True).collect())
    assert all(n <= 2 * before[x] for x, n in after.items())
    # equal priors: a text without a word is as likely clean as toxic
    assert all(after[x] >= n for x, n in before.items() if x[0] in (1, 3, 4, 6))
    assert mixing.resample(empty, labels, {"toxic": 0.1}, relative=True).count() == 0
