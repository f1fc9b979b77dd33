import zlib

import numpy as np

import __spark_entry__ as E
from cases import awkward_rows, documents
from tickwise.llm import language_id as op

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    lang = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect())
    rows = [r for r in E.queries()["op4_language_id"](spark, SF).collect() if r.held_out]
    assert len(rows) > 100 and sum(lang[r.doc_id] == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_awkward_rows(spark):
    rows = awkward_rows()
    got = op.language_id(documents(spark, rows)).select("doc", "held_out", "lang_pred", "score").collect()
    assert len(got) == len(rows)
    for r in got:
        letters = any(c.isalpha() for c in r.doc.text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert r.lang_pred in ("und", "en", "fr", "de") and 0 <= r.score <= 1
        assert r.held_out == (zlib.crc32(("" if r.doc.doc_id is None else str(r.doc.doc_id)).encode()) % 4 == 2)
    same = {}
    for r in got:
        assert same.setdefault(r.doc.text, (r.lang_pred, r.score)) == (r.lang_pred, r.score)


def test_nothing_learned_and_empty_table(spark):
    got = op.language_id(documents(spark, [(1, "some words", None, "a")])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    assert op.language_id(documents(spark, [])).count() == 0
    assert op.in_known_language(documents(spark, [])).count() == 0


def test_mixture_proportions_and_set_choice():
    en, fr = b"the this that with from they have been ", "être après très déjà où forêt élève ".encode()
    logp = np.full((op.BUCKETS, 3), 0.01)
    for k, text in enumerate((en, fr)):
        logp[:, k] += np.bincount(op.trigrams(text)[0], minlength=op.BUCKETS)
    logp = np.log(logp / logp.sum(axis=0)).astype(np.float32)
    lang, share = op.infer([en * 5, fr * 5, en * 6 + fr * 2], logp)
    assert lang.tolist() == [0, 1, 0]
    assert share[0] == share[1] == 1.0 and 0.7 < share[2] < 0.85


def _plain(text, logp):
    """One document, word by word: EM from equal shares for every set of the
    most probable languages, the best by penalised likelihood."""
    bucket, word = op.trigrams(text)
    words = [[sum(float(logp[b, k]) for b, w in zip(bucket, word) if w == x) for k in range(logp.shape[1])]
             for x in range(word.max() + 1)]
    like = [[np.exp(max(v - max(row), -40)) for v in row] for row in words]

    def em(pi):
        for _ in range(op.STEPS):
            new = [0.0] * len(pi)
            for row in like:
                total = sum(a * p for a, p in zip(row, pi))
                for k, (a, p) in enumerate(zip(row, pi)):
                    new[k] += a * p / total / len(like)
            pi = new
        return pi

    n = logp.shape[1]
    full = em([1 / n] * n)
    order = sorted(range(n), key=lambda k: -full[k])
    best = None
    for size in range(1, n + 1):
        pi = [1 / size if k in order[:size] else 0.0 for k in range(n)]
        pi = em(pi) if size > 1 else pi
        value = sum(np.log(sum(a * p for a, p in zip(row, pi))) for row in like) - 0.5 * (size - 1) * np.log(len(like))
        if best is None or value > best[0]:
            best = value, max(range(n), key=lambda k: pi[k]), max(pi), size
    return best[1:]


def test_infer_equals_a_plain_version_for_sets_of_any_size():
    rng = np.random.default_rng(5)
    vocabulary = [[("".join(rng.choice(list(letters), 5))).encode() for _ in range(30)]
                  for letters in ("abcd", "efgh", "ijkl", "mnop", "qrst", "uvwx")]
    logp = np.full((op.BUCKETS, 6), 0.01)
    for k, words in enumerate(vocabulary):
        logp[:, k] += np.bincount(op.trigrams(b" ".join(words))[0], minlength=op.BUCKETS)
    logp = np.log(logp / logp.sum(axis=0)).astype(np.float32)
    texts = [b" ".join(w for k in langs for w in vocabulary[k][:20])
             for langs in ((0,), (1, 2), (0, 2, 5), (5, 4, 3, 2, 1), (0, 1, 2, 3, 4, 5), (3, 3, 3, 1))]
    lang, share = op.infer(texts, logp)
    sizes = []
    for i, t in enumerate(texts):
        want_lang, want_share, size = _plain(t, logp)
        sizes.append(size)
        assert abs(share[i] - want_share) < 1e-5, i
        if i in (0, 5):                       # the others have languages of equal shares
            assert lang[i] == want_lang
    assert sizes[3:5] == [5, 6]


def test_long_text_in_parts_gives_the_same_result(monkeypatch):
    logp = np.log(np.random.default_rng(0).dirichlet(np.ones(op.BUCKETS), 3).T).astype(np.float32)
    text = b"one two three four five six seven " * 50
    whole = op.infer([text], logp)
    monkeypatch.setattr(op, "BATCH_BYTES", 64)
    parts = op.infer([text], logp)
    assert whole[0] == parts[0] and np.allclose(whole[1], parts[1])


def test_stage_keeps_clean_documents_unchanged(spark):
    docs = documents(spark, awkward_rows())
    kept = op.in_known_language(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {20, 35, 49} and not {1, 2, 3, 9} & {r.doc_id for r in kept.collect()}


def test_stage_drops_text_of_no_learned_language(spark):
    """Planted junk goes, clean text (learned from or not) stays."""
    import base64
    import random
    rng = random.Random(1)

    def made(alphabet, n):
        return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 10))) for _ in range(n))

    latin, cyrillic = "abcdefghijklmnopqrstuvwxyz", "".join(chr(c) for c in range(0x430, 0x450))
    junk = [t for _ in range(20) for t in (made(latin, 200), made(latin, 8), made(cyrillic, 200), made("0123456789abcdef", 200),
                                           base64.b64encode(rng.randbytes(1500)).decode())]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    n = docs.count()
    planted = spark.createDataFrame([(10**9 + i, t, None) for i, t in enumerate(junk)], docs.schema)
    kept = {r.doc_id for r in op.in_known_language(docs.unionByName(planted)).select("doc_id").collect()}
    assert not [i for i in kept if i >= 10**9]
    assert len(kept) == n


def test_background_takes_words_of_no_language():
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcd"), 5)).encode() for _ in range(30)]
    counts = np.full((op.BUCKETS, 1), op.SMOOTHING)
    counts[:, 0] += 5000 * np.bincount(op.trigrams(b" ".join(words))[0], minlength=op.BUCKETS)
    langs, logp = op.with_background(["xx"], np.log(counts / counts.sum(axis=0)))
    other = ["".join(rng.choice(list("wxyz"), 5)).encode() for _ in range(30)]
    lang, share = op.infer([b" ".join(words), b" ".join(other), b" ".join(words[:20] + other[:10])], logp)
    assert langs == ["xx", "und"] and lang.tolist() == [0, 1, 0]
    assert share[0] > 0.99 and share[1] > 0.99 and abs(share[2] - 2 / 3) < 0.01
    assert op.with_background([], None) == ([], None)
