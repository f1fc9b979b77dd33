import itertools
import math
import zlib
from collections import Counter

import numpy as np

import __spark_entry__ as E
from cases import awkward_rows, documents
from tickwise.llm import lm_scoring as op

SF = "/root/testdata/sf0.001"


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def brute_base(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        if zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 != 2:
            counts.update(tokens(text))
    n, v = sum(counts.values()), len(counts)
    return sorted(((i, zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2, len(tokens(t)),
                    sum(counts[w] > 0 for w in tokens(t)), n,
                    round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 6))
                   for i, t, *_ in rows), key=repr)


def rounded(df):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                   for r in df.collect()), key=repr)


def test_base_and_counts_match_brute_force(spark, monkeypatch):
    rows = awkward_rows()
    for lookup, head in ((131_072, 32_768), (12, 5)):                 # with rare words joined too
        monkeypatch.setattr(op, "LOOKUP_WORDS", lookup)
        monkeypatch.setattr(op, "HEAD_WORDS", head)
        got = op.lm_scores(documents(spark, rows))
        assert rounded(got) == brute_base(rows)
        assert all(math.isfinite(r.score) and r.score < 0 for r in got.collect())


def test_empty_table_and_no_training_rows(spark):
    assert op.lm_scores(documents(spark, [])).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    got = op.lm_scores(documents(spark, [(held, "some words", "en", "a"), (held, None, "en", "a")])).collect()
    assert [r.train_tokens for r in got] == [0, 0] and all(math.isfinite(r.score) for r in got)


def brute_likelihood(ids, trans, emit):
    """Sum over all state paths."""
    states, total = trans.shape[0], 0.0
    for path in itertools.product(range(states), repeat=len(ids)):
        p, before = 1.0, states - 1
        for s, x in zip(path, ids):
            p *= trans[before, s] * emit[x, s]
            before = s
        total += p
    return total


def small_model(seed=4, states=3, words=5):
    rng = np.random.default_rng(seed)
    trans = rng.random((states, states))
    emit = np.zeros((words + 2, states))
    emit[:words, :-1] = rng.random((words, states - 1))
    emit /= emit.sum(axis=0, where=emit > 0, keepdims=True) + (emit.sum(axis=0) == 0)
    emit[words, -1] = 1
    emit[-1] = 1
    return trans / trans.sum(axis=1, keepdims=True), emit


def test_forward_recursion_is_exact_in_any_lane():
    trans, emit = small_model()
    docs = [[0, 1, 5], [5], [2, 2, 3, 4, 5], [4, 5], [1, 0, 0, 5]]
    grid, places = op._matrix([np.array(d) for d in docs], 6)
    scale = op.forward(grid, trans.astype(np.float32), emit.astype(np.float32))[1].ravel()
    for d, p in zip(docs, places):
        want = math.log(brute_likelihood(d, trans, emit))
        assert abs(np.log(scale[p].astype(float)).sum() - want) < 1e-4


def test_expected_counts_match_path_sums():
    trans, emit = small_model()
    docs = [[0, 1, 5], [2, 3, 2, 5], [5]]
    grid, _ = op._matrix([np.array(d) for d in docs], 6)
    moves, counts = op.expected_counts(grid, trans.astype(np.float32), emit.astype(np.float32), 6)
    want_moves, want_counts = np.zeros((3, 3)), np.zeros((6, 3))
    for ids in docs:
        total = brute_likelihood(ids, trans, emit)
        for path in itertools.product(range(3), repeat=len(ids)):
            p, before = 1.0, 2
            for s, x in zip(path, ids):
                p *= trans[before, s] * emit[x, s]
                before = s
            before = 2
            for s, x in zip(path, ids):
                want_moves[before, s] += p / total
                want_counts[x, s] += p / total
                before = s
    assert np.allclose(moves, want_moves, atol=1e-4) and np.allclose(counts, want_counts, atol=1e-4)


def test_training_beats_the_base_on_held_out_documents(spark):
    rows = E.queries()["op2_lm_scoring"](spark, SF).where("held_out").collect()
    per_token = lambda c: sum(r[c] for r in rows) / sum(r.n_tokens for r in rows)
    assert per_token("score") > per_token("base_score") + 0.1


def test_every_frequent_word_has_its_own_emissions(spark, monkeypatch):
    """Whatever travels whole: words of MIN_OWN training tokens and more are
    counted by state, one by one, and scores follow the dense recursion."""
    from pyspark.sql import functions as F
    rng = np.random.default_rng(0)
    words = [f"w{i}x" for i in range(60)]                             # of few classes: their ends are alike
    weights = 1 / np.arange(1, 61)
    rows = [(i, " ".join(rng.choice(words, rng.integers(1, 40), p=weights / weights.sum())), "en", "s")
            for i in range(80)]
    for name, n in (("HEAD_WORDS", 7), ("LOOKUP_WORDS", 12), ("PART_TOKENS", 100), ("BLOCK_TOKENS", 200)):
        monkeypatch.setattr(op, name, n)
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 != 2]
    counts = Counter(w for r in train for w in tokens(r[1]) if w)
    docs = documents(spark, rows)
    vocab = op.word_counts(docs.where(op.fold(F.col("doc_id"), op.FOLDS) != op.HELD_OUT))
    v = op.Vocabulary(vocab)
    encoded = op.encode(docs, v)
    found = op.look_up(encoded, vocab, v)
    resolved = op.resolve(encoded, found, v)
    assert v.parts > 1 and resolved.select("block").distinct().count() > 1
    own = found.where("block = -1").select("part", "c", F.lit(None).cast("binary").alias("sums"))
    model = op.train_hmm(resolved, own, v)
    head = [w for w, i in v.index.items() if i < v.head]
    emit, mass = {}, model.emit.sum(axis=0)
    for r in model.own.collect():
        names = sorted(w for w, c in counts.items()
                       if c >= op.MIN_OWN and w not in head and zlib.crc32(w) % v.parts == r.part)
        assert [counts[w] for w in names] == r.c
        sums = op._matrix_of(bytes(r.sums))
        assert np.allclose(sums.sum(axis=1), r.c, rtol=1e-3)          # each token is in some state
        e = op._own_emissions(r.c, bytes(r.sums), model.share, model.mass)
        mass = mass + e.sum(axis=0)
        emit |= dict(zip(names, e))
    assert len(emit) > 20 and set(emit) | set(head) == {w for w, c in counts.items() if c >= op.MIN_OWN}
    assert np.allclose(mass, 1)
    emit |= {w: model.emit[i] for w, i in v.index.items() if i < v.head}
    got = {r.doc_id: r.score for r in op.scores(resolved, model, v).collect()}
    for i, text, *_ in rows:
        now, total = np.eye(op.STATES)[-1], 0.0
        for w in tokens(text):
            k = v.klass(w)
            inside = 1.0 if w in emit or not w else (counts[w] + 1) / 10 ** v.log_class[k]
            e = np.append(emit[w] if w in emit else model.emit[v.head + k], 0) if w else np.eye(op.STATES)[-1]
            now = now @ model.trans * e
            total += math.log10(now.sum() * inside)
            now /= now.sum()
        assert abs(got[i] - total) < 1e-3, i


def test_classes_match_between_spark_and_python(spark):
    from pyspark.sql import functions as F
    words = [b"a", b"ab", b"abc", b"abcd", "é".encode(), "日本".encode()]
    got = spark.createDataFrame([(w,) for w in words], "word binary").select(
        "word", F.pmod(F.crc32(F.substring("word", -3, 3)), F.lit(op.CLASSES)).alias("k")).collect()
    assert all(op.Vocabulary.klass(bytes(r.word)) == r.k for r in got)


def test_words_and_packed_ids_match_plain_versions():
    import pyarrow as pa
    texts = [r[1] for r in awkward_rows()] + [" a  B\x1c\x0bÀc ", "\x00 \x85", "a " * 9]
    for some in (texts, [None], [], ["x"]):
        numbers, words, sizes = op._tokens(pa.array(some, pa.string()))
        assert [words[i] for i in numbers] == [w for t in some for w in tokens(t)[:-1]]
        assert sizes.tolist() == [len(tokens(t)) - 1 for t in some] and b"" not in words
    edges = np.array([x for b in (7, 14, 21) for x in (2 ** b - 1, 2 ** b)] + [0, 2 ** 28 - 1], np.int32)
    for ids in (edges, edges[:0]):
        blob, ends = op._packed(ids)
        assert op._unpacked(blob.tobytes()).tolist() == ids.tolist() and len(ends) == len(ids)
    for x in (edges, np.linspace(0, 1, 30).astype(np.float32), np.arange(5) << 40):
        assert (op._loose(op._squeezed(x), x.dtype) == x).all()


def test_recursions_are_the_same_in_spans_of_any_length(monkeypatch):
    trans, emit = (x.astype(np.float32) for x in small_model())
    rng = np.random.default_rng(5)
    docs = [np.append(rng.integers(0, 5, n), 5) for n in (0, 1, 2, 7, 30, 31)]
    grid, _ = op._matrix(docs, 6)
    want = op.expected_counts(grid, trans, emit, 6)
    for span in (1, 3, 7, 20):
        monkeypatch.setattr(op, "SPAN", span)
        for a, b in zip(op.expected_counts(grid, trans, emit, 6), want):
            assert np.allclose(a, b, atol=1e-4)
    assert abs(want[1].sum() - sum(map(len, docs))) < 1e-3


def test_blocks_fill_up_across_scan_tasks_and_ids_are_stored_small(spark):
    """What a pass sends grows with the blocks a word is in: small scan tasks share a block."""
    from pyspark.sql import functions as F
    rows = [(i, " ".join(f"w{(i + j) % 40}" for j in range(50)), "en", "s") for i in range(200)]
    docs = documents(spark, rows).repartition(40)
    vocab = op.word_counts(docs.where(op.fold(F.col("doc_id"), op.FOLDS) != op.HELD_OUT))
    got = op.encode(docs, op.Vocabulary(vocab)).where("part = -1")
    assert got.select("block").distinct().count() <= 2 * spark.sparkContext.defaultParallelism < 40
    size, n = got.agg(F.sum(F.length("ids")), F.sum("n_tokens")).first()
    assert n == 51 * 200 and size < 2 * n
