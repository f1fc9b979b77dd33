import random

import xxhash

from cases import awkward_rows, documents
from pyspark.sql import functions as F
from tickwise.llm import simhash_dedup as op


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64(b" ".join(words[i:i + 3]), seed=42).intdigest() for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps):
    """{fp: its single-link group}."""
    left, out = set(fps), {}
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            f = todo.pop()
            group.add(f)
            near = {g for g in left if (f ^ g).bit_count() <= 3}
            left -= near
            todo += near
        out |= {f: frozenset(group) for f in group}
    return out


def smallest(group, fps):
    return min((i for f in group for i in fps[f] if i is not None), default=None)


def expected(rows):
    fps = {}
    for doc_id, text, *_ in rows:
        fps.setdefault(brute_fp(text), []).append(doc_id)
    component = {f: smallest(group, fps) for f, group in brute_groups(fps).items()}
    return sorted(((i, f"{brute_fp(t):016x}", component[brute_fp(t)]) for i, t, *_ in rows), key=repr)


def near_copies(seed=5):
    rng = random.Random(seed)
    base = [rng.choice("abcdefghij") * rng.randint(1, 6) for _ in range(400)]
    rows = []
    for i in range(60):
        words = list(base)
        words[rng.randrange(400)] = f"w{i}"
        rows.append((1000 - i, " ".join(words), "en", "a"))
    return rows


def test_components_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op, "CHUNK", 1000)
    rows = awkward_rows() + near_copies()
    got = op.simhash_components(documents(spark, rows)).select(
        "doc_id", op.hex16(F.col("fp")).alias("fingerprint"), "component_id")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows)


def test_links_of_planted_fingerprints(spark):
    rng = random.Random(1)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for f in base:
        for k in (1, 2, 3, 4):
            g = f
            for b in rng.sample(range(64), k):
                g ^= 1 << b
            fps.add(g)
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    got = {frozenset(r) for r in op.links(df).collect()}
    want = {frozenset((signed(f), signed(g))) for f in fps for g in fps if f != g and (f ^ g).bit_count() <= 3}
    assert got == want


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    labels = dict(op.component_labels(edges).collect())
    assert set(labels[i] for i in range(61)) == {0} and labels[100] == labels[101] == 100


def test_one_document_of_each_group_stays(spark):
    rows = awkward_rows() + near_copies()
    docs = documents(spark, rows)
    kept = op.one_of_each_group(docs)
    assert kept.columns == docs.columns
    fps = {}
    for doc_id, text, *_ in rows:
        fps.setdefault(brute_fp(text), []).append(doc_id)
    want = [smallest(group, fps) for group in set(brute_groups(fps).values())]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert op.simhash_components(documents(spark, [])).count() == 0
    assert op.one_of_each_group(documents(spark, [])).count() == 0
