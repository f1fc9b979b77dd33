import random
import re
from collections import Counter

import numpy as np
import pytest

from cases import awkward_rows, documents
from tickwise.llm import collocations as op

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, min_count, max_words=5, top=2000):
    out = []
    for lang in {r[2] or "und" for r in rows}:
        f, n = Counter(), 0
        for _, text, own, *_ in rows:
            if (own or "und") != lang:
                continue
            lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
            for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
                words = re.findall("[^\x20\x09]+", piece)
                n += len(words)
                f.update(tuple(words[i:i + m]) for m in range(1, max_words + 1) for i in range(len(words) - m + 1))
        f = {p: c for p, c in f.items() if c >= min_count}
        scored = []
        for p, a in f.items():
            longer = (q for q in f if len(q) > len(p) and 100 * f[q] >= 100 * a
                      and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if len(p) > 1 and not any(longer):
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def phrases(n=400, seed=5):
    rng = random.Random(seed)
    words = "the of a RE ré b\x1cc ünd x y z".split(" ")
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n"])
                       for _ in range(rng.randint(0, 40)))
        rows.append((i, text + (" new york city hall " * rng.randint(0, 2)), rng.choice(["en", "en", "fr", None]), "s"))
    return rows


@pytest.mark.parametrize("min_count,top", [(8, 2000), (30, 5)])
def test_against_brute_force(spark, min_count, top):
    rows = phrases()
    got = op.collocations(documents(spark, rows), min_count=min_count, top=top)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == brute(rows, min_count, top=top)


def test_small_chunks_slices_and_tiles_change_nothing(spark, monkeypatch):
    for name, value in (("ROW_TOKENS", 20), ("COUNT_PAIRS", 30), ("SLICE", 7), ("TILE", 4), ("DENSE", 3)):
        monkeypatch.setattr(op, name, value)
    rows = phrases(150)
    # the workers import the module afresh: the parts they run are tested here
    chunk = op._Chunk()
    for r in rows:
        chunk.add((r[1] or "").encode())
    words, counts, parts = chunk.result()
    assert len(parts) > 20 and all(op.unpacked(p)[-1] == -1 for p in parts)
    codes = np.concatenate([op.unpacked(p) for p in parts])
    stream, lower = [], lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    for r in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(r[1])):
            stream += re.findall("[^\x20\x09]+", piece) + [None]
    got = [None if c < 0 else words[c] for c in codes.tolist()]
    assert got == stream
    assert dict(zip(words, counts.tolist())) == Counter(w for w in stream if w)
    rng = np.random.default_rng(1)
    a, b = rng.zipf(1.3, 5000) % 4000, rng.zipf(1.3, 5000) % 4000
    x, y, n = op.tile_counts(a, b)
    assert Counter(zip(a.tolist(), b.tolist())) == dict(zip(zip(x.tolist(), y.tolist()), n.tolist()))
    for rows in (phrases(60), [(1, None, None, None)]):      # parts of chunks, bound when the job is made
        got = op.collocations(documents(spark, rows), min_count=4)
        assert sorted(map(tuple, got.collect())) == brute(rows, 4)
    none = np.array([], np.int64)
    assert [len(c) for c in op.tile_counts(none, none)] == [0, 0, 0]


def test_rows_of_a_chunk_use_some_of_its_words():
    local, ids = np.array([7, 1, 0]), np.array([70, 10, 0])
    for codes, want in (([0, 1, -1, 2], [0, 10, -1, -1]), ([7, -1], [70, -1]), ([9, 1], [-1, 10]), ([], [])):
        assert op._of_words(op.packed(np.array(codes, np.int64)), local, None, ids).tolist() == want


def test_symbols_are_packed_whole():
    for top in (-1, 0, 254, 255, 65_534, 65_535, (1 << 32) - 2, (1 << 32) - 1, 1 << 40):
        row = np.array([top, -1, max(top - 1, -1)], np.int64)
        assert op.unpacked(op.packed(row)).tolist() == row.tolist()
    assert [op.packed(np.array([t]))[0] for t in (254, 255, 65_534, 65_535, 1 << 32)] == [1, 2, 2, 4, 8]
    assert op.unpacked(op.packed(np.array([], np.int64))).tolist() == []


def test_awkward_rows(spark):
    rows = awkward_rows()
    got = op.collocations(documents(spark, rows), min_count=3)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3)


def test_scores_beyond_64_bits(spark):
    # 1000 * a * n of 4e9 occurrences each does not fit 64 bits
    a, n, l, r = 4_000_000_000, 9_000_000_000_000, 5_000_000_001, 4_000_000_003
    got = spark.sql(f"select (1000BD * cast({a} as decimal(17, 0)) * cast({n} as decimal(17, 0))) div "
                    f"(cast({l} as decimal(19, 0)) * cast({r} as decimal(19, 0))) as score").first()[0]
    assert got == 1000 * a * n // (l * r)


def test_empty_tables(spark):
    for rows in ([], [(1, None, None, None), (2, "only a few words", "en", "a")]):
        got = op.collocations(documents(spark, rows))
        assert got.columns == COLUMNS and got.count() == 0


def test_many_slices_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(op, "SLICE_KEYS", 200)
    rows = phrases(200, seed=9)
    got = op.collocations(documents(spark, rows), min_count=6)
    assert sorted(map(tuple, got.collect())) == brute(rows, 6)


def test_pairs_travel_in_slices_of_few_bytes(spark):
    rng = np.random.default_rng(3)
    chunks = [rng.integers(-1, 3000, 20_000) for _ in range(3)]
    level = spark.createDataFrame([(c, bytearray(op.packed(s))) for c, s in enumerate(chunks)],
                                  "chunk long, symbols binary").coalesce(1)
    want = [Counter((x, y) for x, y in zip(s.tolist(), s[1:].tolist()) if x >= 0 and y >= 0) for s in chunks]
    asked = op.asked_pairs(level, 4).collect()
    assert len(asked) == 3 * 4        # a row for each chunk and slice, not one for each pair
    assert sum(len(r["a"]) + len(r["b"]) + len(r["counts"]) for r in asked) < 6 * sum(map(len, want))
    for c, pairs in enumerate(want):
        got = {}
        for r in asked:
            if r["chunk"] == c:
                got.update(zip(zip(op.sums(r["a"]).tolist(), op.unpacked(r["b"]).tolist()), op.unpacked(r["counts"]).tolist()))
        assert got == pairs
    rows = op.numbered_pairs(op.asked_pairs(level, 4), 4, 2).collect()
    found = {(r["left"], r["right"]): (r["id"], r["f"]) for r in rows if r["chunk"] is None}
    total = sum(want, Counter())
    assert {p: f for p, (_, f) in found.items()} == {p: f for p, f in total.items() if f >= 2}
    assert len({i for i, _ in found.values()}) == len(found) > 10
    for c, pairs in enumerate(want):
        got = {}
        for r in rows:
            if r["chunk"] == c:
                got.update(zip(zip(op.sums(r["a"]).tolist(), op.unpacked(r["b"]).tolist()), op.unpacked(r["ids"]).tolist()))
        assert got == {p: found[p][0] for p in pairs if p in found}


def test_a_chunk_without_pairs_is_asked_nothing(spark):
    level = spark.createDataFrame([(1, bytearray(op.packed(np.array([4, -1, 5])))), (2, bytearray(op.packed(np.array([-1]))))],
                                  "chunk long, symbols binary")
    assert op.asked_pairs(level, 4).collect() == []
    assert op.numbered_pairs(op.asked_pairs(level, 4), 4, 1).collect() == []


def test_symbols_without_a_neighbour_are_left_out():
    for old, new in (([], []), ([3], []), ([-1, -1], []), ([3, -1, 4, 5, -1, -1, 6, 7], [4, 5, -1, 6, 7]),
                     ([1, 2, 3, -1, 4, -1, 5, 6, -1], [1, 2, 3, -1, 5, 6, -1])):
        assert op._linked(np.array(old, np.int64)).tolist() == new
    for numbers in ([], [0], [5, 5, 9, 70_000]):
        assert op.sums(op.steps(np.array(numbers, np.int64))).tolist() == numbers
