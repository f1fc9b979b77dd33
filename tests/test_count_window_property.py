"""Property: the count-window core of the streaming operator, fed in random
micro-batches with the state carried between them, equals a plain deque."""
from collections import deque

import numpy as np
from hypothesis import given, settings, strategies as st

from tickwise.streaming.count_window import window_means


def deque_means(values, n):
    d, out = deque(maxlen=n), []
    for v in values:
        d.append(v)
        s = 0.0
        for x in d:
            s += x
        out.append(s / len(d))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=80),
       st.integers(1, 6), st.lists(st.integers(1, 10), min_size=1, max_size=20))
def test_batches_with_state_equal_deque(values, n, cuts):
    out, state, i = [], np.zeros(0), 0
    for c in cuts + [len(values)]:
        batch = np.asarray(values[i:i + c], dtype="float64")
        i += len(batch)
        if len(batch) == 0:
            continue
        out.extend(window_means(state, batch, n).tolist())
        state = np.concatenate([state, batch])[-(n - 1):] if n > 1 else np.zeros(0)
        if i >= len(values):
            break
    assert out == deque_means(values, n)
