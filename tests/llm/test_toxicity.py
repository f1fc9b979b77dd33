import random
import zlib

import numpy as np

import __spark_entry__ as E
from cases import awkward_rows, documents
from tickwise.llm import toxicity as op

SF = "/root/testdata/sf0.01"


def labels(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, toxic int, label string")


def test_held_out_documents(spark):
    toxic = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").collect())
    rows = E.queries()["op8_toxicity"](spark, SF).collect()
    held = [(toxic[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in toxic]
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    clean, bad = [s for t, s in held if t == 0], [s for t, s in held if t == 1]
    assert sum(s >= 0.5 for s in clean) <= 0.03 * len(clean)
    assert np.mean([b > c for b in bad for c in clean]) > 0.8


def test_learns_a_pair_that_is_harmful_only_together(spark):
    """insult-like word alone and group word alone are harmless in equal parts."""
    rng = random.Random(0)
    filler = [f"w{'abcdefghijklmnopqrstuvwxyz'[i]}{'abcdefghijklmnopqrstuvwxyz'[j]}" for i in range(26) for j in range(26)]
    rows, marks = [], []
    for i in range(1200):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = rng.choices(filler, k=20) + ["zap"] * a + ["quux"] * b
        rng.shuffle(words)
        rows.append((i, " ".join(words), "en", "s"))
        marks.append((i, int(a and b)))
    got = {r.doc_id: r.predicted for r in
           op.toxicity_scores(documents(spark, rows), labels(spark, marks)).collect()}
    held = [(i, t) for i, t in marks if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i] == t for i, t in held) >= 0.95 * len(held)


def test_learns_a_pair_of_words_alike_in_both_labels(spark):
    """Label 1 if both words are there or neither: each alone says nothing."""
    rng = random.Random(3)
    filler = [f"w{x}{y}" for x in "abcdefghij" for y in "abcdefghij"]
    rows, marks = [], []
    for i in range(1600):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = rng.choices(filler, k=12) + ["zap"] * a + ["quux"] * b
        rng.shuffle(words)
        rows.append((i, " ".join(words), "en", "s"))
        marks.append((i, int(a == b)))
    got = {r.doc_id: r.predicted for r in op.toxicity_scores(documents(spark, rows), labels(spark, marks)).collect()}
    held = [(i, t) for i, t in marks if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i] == t for i, t in held) >= 0.95 * len(held)


def test_score_equals_the_plain_sum_over_pairs(spark):
    """Brute force: distinct terms of a text, bias, weights and every pair."""
    rows = [(i, f"{'bad' if i % 3 else 'good'} word{i % 7} Word{i % 5}, x{i % 2}", "en", "s") for i in range(300)]
    docs, marks = documents(spark, rows), labels(spark, [(i, int(i % 3 > 0)) for i in range(300)])
    model = op.fit(docs, marks)
    got = {r.doc_id: r.score for r in op.toxicity_scores(docs, marks).collect()}
    for i, text, *_ in rows:
        hashes = {h for token in text.lower().split() for h in op._terms_of(token)}
        ids = sorted({model["terms"][h] for h in hashes if h in model["terms"]})
        z = model["bias"] + sum(model["w"][a] for a in ids) + sum(
            model["v"][a] @ model["v"][b] for n, a in enumerate(ids) for b in ids[n + 1:])
        assert abs(got[i] - 1 / (1 + np.exp(-z))) < 1e-6


def test_terms_beyond_the_buckets_share_them(spark, monkeypatch):
    monkeypatch.setattr(op, "BUCKETS", 3)
    sample = spark.createDataFrame([(0, "aa bb cc dd ee")] * 5 + [(1, "aa")] * 2, "label int, text string")
    of = op._buckets(sample)
    assert len(of) == 5 and set(of.values()) == {0, 1, 2} and of[op._terms_of("aa")[0]] == 0


def test_a_bound_sample_keeps_the_balance_of_all_labels(spark, monkeypatch):
    rows = [(i, "same words", "en", "s") for i in range(1000)]
    marks = [(i, int(i % 10 == 0)) for i in range(1000)]
    docs = documents(spark, rows)
    share = np.mean([t for i, t in marks if zlib.crc32(str(i).encode()) % 5])
    for most in (12_000, 200, 40):               # no label, the clean one, both are cut
        monkeypatch.setattr(op, "TRAIN_ROWS", most)
        got = op.toxicity_scores(docs, labels(spark, marks)).collect()
        assert {r.predicted for r in got} == {0}
        assert abs(got[0].score - share) < 0.05, most


def test_factorization_adds_the_products_of_all_pairs():
    rng = np.random.default_rng(1)
    w, v = rng.random(6), rng.random((6, op.RANK))
    ids = np.array([0, 2, 5])
    pairs = sum(v[i] @ v[j] for n, i in enumerate(ids) for j in ids[n + 1:])
    assert abs(op.raw_score(ids, 0.5, w, v) - (0.5 + w[ids].sum() + pairs)) < 1e-9


def test_awkward_rows_and_labels(spark):
    rows = awkward_rows()
    marks = [(i, i % 2) for i in range(20, 50)] + [(None, 1), (20, None), (21, 0), (999, 1)]
    got = op.toxicity_scores(documents(spark, rows), labels(spark, marks)).collect()
    assert sorted(map(str, (r.doc_id for r in got))) == sorted(str(r[0]) for r in rows)
    assert all(0 <= r.score <= 1 for r in got)
    blank = {r.score for r in got if r.doc_id in (1, 2, 3)}
    assert len(blank) == 1


def test_without_labels_of_both_kinds(spark):
    rows = awkward_rows()[:5]
    got = op.toxicity_scores(documents(spark, rows), labels(spark, [])).collect()
    assert {r.score for r in got} == {0.5}
    got = op.toxicity_scores(documents(spark, rows), labels(spark, [(i, 0) for i in range(9)])).collect()
    assert len({r.score for r in got}) == 1 and got[0].score < 0.5
    assert op.toxicity_scores(documents(spark, []), labels(spark, [])).count() == 0
