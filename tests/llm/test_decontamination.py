import re

import pytest
from pyspark.sql import functions as F

from cases import awkward_rows, documents
from tickwise.llm import decontamination as op

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, size=13):
    grams = {}
    for item, text, *_ in items:
        w = words(text)
        for s in range(max(len(w) - size, 0) + 1 if w else 0):
            grams.setdefault(tuple(w[s:s + size]), set()).add(item)
    out = []
    for doc_id, text, *_ in rows:
        w, hit, held = words(text), set(), set()
        for g, ids in grams.items():
            for s in range(len(w) - len(g) + 1):
                if w[s] == g[0] and tuple(w[s:s + len(g)]) == g:
                    hit |= set(range(s, s + len(g)))
                    held |= ids
        out.append((doc_id, len(w), len(hit), sorted(str(i) for i in held if i is not None),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def benchmark():
    passage = "Alpha beta GAMMA delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron Éta"
    return [(1, passage), (2, passage), (2, passage), (10, passage[6:] + " extra tail words here"), (3, "short, item!"),
            (4, "the"), (5, None), (6, "  ... "), (None, "orphan item text"), (7, "a a a a a a a a a a a a a a a")]


def rows():
    p = benchmark()[0][1]
    return awkward_rows() + [
        (300, "x " * 100 + p + " y" * 100, "en", "a"), (301, "x " * 2000 + p, "en", "a"), (302, p.lower(), "en", "a"),
        (303, p.replace(" ", "--"), "en", "a"), (304, p.replace("delta", "DELTA é"), "en", "a"),
        (305, "a " * 40, "en", "a"), (306, "an orphan item text", "en", "b"), (307, "short item short item", "en", "b")]


@pytest.mark.parametrize("max_windows", [10_000, 5])
def test_matches_brute_force(spark, max_windows):
    items = spark.createDataFrame([(*r, "b") for r in benchmark()], "item_id long, text string, window string")
    got = op.contamination(documents(spark, rows()), items, max_windows=max_windows).select(
        "doc.doc_id", "n_words", "n_hit", "items", "contaminated")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows(), benchmark())


def test_texts_of_one_hash_are_told_apart(spark, monkeypatch):
    """Windows and document words of equal length share a hash here."""
    monkeypatch.setattr(op.F, "xxhash64", lambda c: F.length(c).cast("long"))
    items = spark.createDataFrame(benchmark(), "item_id long, text string")
    some = [r for r in rows() if len(r[1] or "") < 2000]
    got = op.contamination(documents(spark, some), items, max_windows=0).select(
        "doc.doc_id", "n_words", "n_hit", "items", "contaminated")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(some, benchmark())


def test_a_large_benchmark_stays_in_spark(spark):
    """More windows than travel with the query; one passage is in a third of the rows."""
    import random
    rng = random.Random(4)
    word = lambda: "w" + str(rng.randint(0, 400))
    bench = [(i, " ".join(word() for _ in range(rng.choice([3, 13, 20, 40])))) for i in range(300)]
    made = [(i, " ".join([*(word() for _ in range(30)), bench[0 if i % 3 == 0 else i % 300][1], word()]), "en", "a")
            for i in range(150)]
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = op.contamination(documents(spark, made), items, max_windows=100).select(
        "doc.doc_id", "n_words", "n_hit", "items", "contaminated")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(made, bench)


def test_contaminated_documents_go_and_others_stay_unchanged(spark):
    items = spark.createDataFrame(benchmark(), "item_id long, text string").where(F.length("text") > 20)
    docs = documents(spark, rows())
    got = op.without_contaminated(docs, items)
    bad = {r[0] for r in brute(rows(), [b for b in benchmark() if b[1] and len(b[1]) > 20]) if r[4]}
    assert got.columns == docs.columns
    want = [r for r in docs.collect() if r.doc_id not in bad]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want)) and 300 in bad and 301 not in bad


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert op.contamination(documents(spark, []), items).count() == 0
    got = op.contamination(documents(spark, rows()[:8]), items).collect()
    assert len(got) == 8 and not any(r.n_hit or r.contaminated for r in got)
