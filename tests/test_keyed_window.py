"""W2 with bounded memory: a key's rows as an iterator, set aside by ranges."""
import random

import pandas as pd
import pytest

from tickwise.streaming.keyed_window import CountWindow, range_of


class Values:
    """A list or map state in memory."""

    def __init__(self):
        self.rows, self.map = [], {}

    def get(self):
        return iter(self.rows)

    def put(self, rows):
        self.rows = list(rows)

    def getValue(self, key):
        return self.map[key]

    def updateValue(self, key, value):
        self.map[key] = value

    def removeKey(self, key):
        del self.map[key]


class Handle:
    def getListState(self, *_):
        return Values()

    getMapState = getListState


class Watched(CountWindow):
    largest = 0

    def window(self, frame, seen):
        self.largest = max(self.largest, len(frame))
        return super().window(frame, seen)


def run(batches, n, held_rows, width, order=("tick_id",), frame_rows=7):
    p = Watched(n, order, held_rows, width)
    p.init(Handle())
    out = []
    for rows in batches:
        frames = (pd.DataFrame(rows[i:i + frame_rows], columns=["symbol", "timestampvalue", "tick_id", "price", "volume"])
                  for i in range(0, len(rows), frame_rows))
        out += list(p.handleInputRows(("a",), frames, None))
        assert not p.aside.map
    return p, pd.concat(out, ignore_index=True) if out else None


def brute(rows, n):
    out = {}
    for i, r in enumerate(rows):
        frame = rows[max(0, i - n + 1):i + 1]
        out[r[2]] = (sum(f[3] for f in frame) / len(frame), sum(f[4] for f in frame) / len(frame))
    return out


@pytest.mark.parametrize("cuts", [1, 3, 10])
@pytest.mark.parametrize("n", [1, 3, 40])
def test_memory_is_bounded_and_rows_are_those_of_one_frame(cuts, n):
    rng = random.Random(cuts * n)
    rows = [("a", f"2024-01-01 00:{i // 60 % 60:02d}:{i % 60:02d}", i, float(rng.randint(0, 999)), rng.randint(0, 99))
            for i in range(3_000)]
    size = -(-len(rows) // cuts)
    batches = [rows[i:i + size] for i in range(0, len(rows), size)]
    for b in batches:
        b[:] = rng.sample(b, len(b))               # a shuffle keeps no order
    p, got = run(batches, n, held_rows=50, width=20)
    assert p.largest <= 50 + 7
    want = brute(rows, n)
    assert {t: (a, v) for t, a, v in zip(got.tick_id, got.priceavg, got.volumeavg)} == want
    assert got.tick_id.tolist() == sorted(want)
    assert len(p.last.rows) == min(n - 1, len(rows))


def test_rows_without_position_come_first_and_texts_go_by_minute():
    ids = pd.Series([5, None, -3, 10_000_000_000])
    assert [k for _, k in sorted(zip(range_of(ids, 10), [5, None, -3, 10_000_000_000]), key=lambda p: p[0])] == [
        None, -3, 5, 10_000_000_000]
    texts = pd.Series(["2024-01-01 00:01:59", None, "2024-01-01 00:01:00", "2023"])
    assert range_of(texts).tolist() == ["t2024-01-01 00:01", "", "t2024-01-01 00:01", "t2023"]
    rows = [("a", f"2024-01-01 00:{m:02d}:{s:02d}", 60 * m + s, float(m * s), m) for m in range(9) for s in range(60)]
    shuffled = random.Random(1).sample(rows, len(rows))
    _, got = run([shuffled], 5, held_rows=30, width=20, order=("timestampvalue", "tick_id"))
    assert {t: (a, v) for t, a, v in zip(got.tick_id, got.priceavg, got.volumeavg)} == brute(rows, 5)


def test_no_rows():
    p, got = run([[]], 3, 10, 10)
    assert got is None and p.last.rows == []
