import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np

from tickwise.llm import topk_search as op


def brute(rows, every, k):
    good = [(i, [math.floor(64 * x) for x in np.asarray(v, np.float32).astype(float)]) for i, v, *_ in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in good:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def vectors(seed=2, n=150, dims=7):
    rng = random.Random(seed)
    rows = [(i, [rng.uniform(-1, 1) * rng.choice([1, 1, 9]) for _ in range(dims)]) for i in range(n)]
    rows[5] = (5, rows[4][1])                                        # ties
    rows += [(200, None), (201, []), (202, [None] * dims), (203, [float("nan")] * dims), (None, rows[0][1]),
             (204, [float("inf")] + [0.0] * (dims - 1)), (220, [1.0, 2.0]), (221, [0.5, -3.0])]
    return [(*r, "x", 1) for r in rows]


def run(spark, rows, k=20, every=20):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, block string, part int")
    v = op.quantised(df)
    got = op.exact_top_k(v, v.where(f"vec_id % {every} = 0"), k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in got.collect())


def test_matches_brute_force(spark):
    assert run(spark, vectors()) == brute(vectors(), 20, 20)


def test_several_blocks_and_parts(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_ROWS", 40)
    monkeypatch.setattr(op, "QUERY_ROWS", 9)
    assert run(spark, vectors(), 5, 2) == brute(vectors(), 2, 5)


def test_empty_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(20, None, "x", 1)]) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-70, 70), min_size=3, max_size=3), min_size=1, max_size=90),
       st.lists(st.integers(-70, 70), min_size=3, max_size=3), st.integers(1, 12))
def test_bitmap_arithmetic(values, query, k):
    values = np.array(values)
    lowest, bits, slices = op.bit_slices(values)
    base, sums = op.added(query, lowest, bits, slices)
    want = values @ np.array(query)
    bit = lambda s: np.unpackbits(s.view(np.uint8), bitorder="little")[:len(values)].astype(np.int64)
    assert (sum((bit(s) << j for j, s in enumerate(sums)), np.zeros(len(values), np.int64)) + base == want).all()
    valid = np.zeros(slices.shape[-1], np.uint8)
    ones = np.packbits(np.ones(len(values), np.uint8), bitorder="little")
    valid[:len(ones)] = ones
    rows = op.best_rows(sums, valid.view("<u8"), k)
    assert sorted(rows.tolist()) == sorted(np.lexsort((np.arange(len(values)), -want))[:k].tolist())
