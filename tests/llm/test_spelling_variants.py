import random
import re
import zlib
from collections import Counter

import numpy as np

from cases import awkward_rows, documents
from tickwise.llm import spelling_variants as op

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def edit_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(rows, min_length=7, min_count=2, ratio=10):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    near = {w: [v for v in counts if edit_one(w, v)] for w in counts}
    form = {}
    for w, around in near.items():
        if around:
            best = min(around, key=lambda v: (-counts[v], v))
            if counts[best] >= ratio * counts[w]:
                form[w] = best
    out = []
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, counts[w], len(near[w]), counts[form[w]] if w in form else None))
    return sorted(out)


def variants(n=250, seed=4):
    rng = random.Random(seed)
    base = ["organise", "organize", "programme", "PROGRAMME", "éclairage", "ÉCLAIRAGE", "straße÷x", "aaaaaaaa", "mississippi"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 40)):
            w = rng.choice(base)
            for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
                k, c = rng.randrange(len(w)), rng.choice("aezéß")
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + c + w[k + 1:], w[:k] + c + w[k:]])
            words.append(w)
        rows.append((i, "_".join(words) + rng.choice(["", "\n", " 日本 "]), "en", "s"))
    return rows


def test_against_brute_force(spark):
    rows = variants()
    got = op.spelling_variants(documents(spark, rows), ratio=3)
    assert got.columns == COLUMNS
    want = brute(rows, ratio=3)
    assert sorted(map(tuple, got.collect())) == want
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] != r[2] for r in want if r[1])


def test_several_passes_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(op, "FILTER_BYTES", 64)
    monkeypatch.setattr(op, "PAGE", 4)
    rows = variants(80)
    got = op.spelling_variants(documents(spark, rows))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_filter_groups():
    page = op.PAGE
    groups = op.filter_groups({7: 3 * page, 8: 10, 9: 5 * page + 1}, limit=16 * page)
    assert all(sum(b - a for _, a, b in g) <= 2 * page for g in groups)
    covered = {s: sorted((a, b) for g in groups for t, a, b in g if t == s) for s in (7, 8, 9)}
    assert {s: (r[0][0], r[-1][1]) for s, r in covered.items()} == {7: (0, 3 * page), 8: (0, 10), 9: (0, 5 * page + 1)}
    assert all(x[1] == y[0] for r in covered.values() for x, y in zip(r, r[1:]))
    assert op.filter_groups({}, 64) == []


def test_every_edit_passes_a_full_filter_and_few_an_ordinary_one():
    rng = random.Random(2)
    spell = lambda n: bytes(rng.choice(b"abcdefgh\xe9") for _ in range(n))
    whole = lambda w: int(op._mix((np.frombuffer(w, np.uint8).astype(np.uint64)
                                   * op._multipliers(len(w))).sum(dtype=np.uint64)[None])[0])
    full = (1, 0, np.full(1, ~np.uint64(0)))
    alphabet = [*b"abcdefgh\xe9"]
    for size in (7, 9, 40):
        words = [spell(size) for _ in range(5)] + [b"a" * size]
        letters = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), size)
        got = Counter()
        for row, h, to in op.edits(letters, size, alphabet, {size: full, size - 1: full}):
            got.update((r, x, to) for r, x in zip(row.tolist(), h.tolist()))
        want = Counter()
        for r, w in enumerate(words):
            for v in {w[:k] + bytes([c]) + w[k + 1:] for k in range(size) for c in alphabet if c > w[k]}:
                want[r, whole(v), size] += 1
            for v in {w[:k] + w[k + 1:] for k in range(size)}:
                want[r, whole(v), size - 1] += 1
        assert got == want
    h = op._mix(np.arange(1, 40_001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    n = 20_000 * op.BITS_PER_WORD // 64
    bits = np.zeros(n, np.uint64)
    np.bitwise_or.at(bits, op.block_of(h[:20_000], n).astype(np.int64), op.bits_of(h[:20_000]))
    assert op._passes(h[:20_000], (n, 0, bits)).all()
    assert op._passes(h[20_000:], (n, 0, bits)).mean() < 0.03


def test_awkward_and_long_words(spark):
    rows = awkward_rows() + [(200 + k, "y" * 3_000 + "z" * (k % 3) + " éclairs Éclairs éclairx", "en", "s") for k in range(9)]
    rows += [(None, "éclairx éclairx", "en", "s")]
    got = op.spelling_variants(documents(spark, rows))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_long_chains_are_followed(spark):
    forms = spark.createDataFrame([(k, k + 1) for k in range(11)], "id long, root long")
    assert sorted(map(tuple, op.roots(forms, 11).collect())) == [(k, 11) for k in range(11)]


def test_empty_tables(spark):
    for rows in ([], [(1, None, None, None), (2, "short words only", "en", "a")]):
        got = op.spelling_variants(documents(spark, rows))
        assert got.columns == COLUMNS and got.count() == 0


def test_query(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = E.queries()["op13_spelling_variants"](spark, sf)
    assert sorted(map(tuple, got.collect())) == brute(rows)
