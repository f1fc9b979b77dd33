"""W2 in the state store, with bounded memory for a key of any size.

A key's rows of a micro-batch come as an iterator of frames, in no order.  Up
to ``held_rows`` of them are put in arrival order in memory.  A key with more
sets them aside by ranges of the order column in a map state (on the worker's
disk and empty again when the call returns), and then takes the
ranges one after the other: what is in memory at a time is one range, not the
key's whole micro-batch.  The last ``n-1`` ticks of a key are a list state.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

HELD_ROWS = 100_000       # rows of a key ordered in memory; no effect on results
RANGE = 100_000           # arrival positions of a range (positions are unique)
MINUTE_TEXT = 16          # a range of ordering texts: the same first characters
POSITION = r" \d{20}$"     # end of an arrival position (functions.columns.arrival_position)
OFFSET_DIGITS = 5         # a range of arrival positions: the same text but for so many last digits


def range_of(values: pd.Series, width: int = RANGE) -> pd.Series:
    """The range an order value is in: whole numbers by width, arrival positions
    by topic, partition and leading digits of the offset, other texts by their
    minute; rows without a value come first, as a range of their own."""
    if pd.api.types.is_numeric_dtype(values):
        filled = values.fillna(0).astype("int64")
        return ((filled // width) * 2 + 1).where(values.notna(), -(1 << 62)).map(lambda k: f"{k + (1 << 62):020d}")
    known = values.dropna()
    end = -OFFSET_DIGITS if len(known) and re.search(POSITION, known.iloc[0]) else MINUTE_TEXT
    return values.map(lambda t: "" if t is None else "t" + t[:end])


def window_means(prev: np.ndarray, new: np.ndarray, n: int) -> np.ndarray:
    """Mean over the last ``min(n, seen)`` values for every new value, summed
    oldest first (the same left-to-right sum as a SQL row frame)."""
    x = np.concatenate([prev, new]).astype("float64")
    start = len(prev)
    idx = np.arange(start, len(x))
    s = np.zeros(len(idx))
    cnt = np.zeros(len(idx))
    for lag in range(n - 1, -1, -1):          # oldest element of the frame first
        j = idx - lag
        ok = j >= 0
        s[ok] = s[ok] + x[j[ok]]
        cnt[ok] += 1
    return s / cnt


class CountWindow(StatefulProcessor):
    """Mean price and volume over the last ``min(n, seen)`` ticks for every
    tick of a key."""

    def __init__(self, n: int, order: Sequence[str], held_rows: int = HELD_ROWS, width: int = RANGE):
        self.n, self.order, self.held_rows, self.width = n, list(order), held_rows, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getListState("last", "price double, volume double")
        self.aside = handle.getMapState("aside", "place string, part int", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size, parts = 0, {}
        for frame in rows:
            held.append(frame)
            size += len(frame)
            if size > self.held_rows and self.order:
                self.set_aside(pd.concat(held, ignore_index=True), parts)
                held, size = [], 0
        seen = [tuple(r) for r in self.last.get()]
        if parts:
            if held:
                self.set_aside(pd.concat(held, ignore_index=True), parts)
            for place in sorted(parts):
                frames = []
                for part in range(parts[place]):
                    frames.append(pickle.loads(bytes(self.aside.getValue((place, part))[0])))
                    self.aside.removeKey((place, part))
                out, seen = self.window(pd.concat(frames, ignore_index=True), seen)
                yield out
        elif held:
            out, seen = self.window(pd.concat(held, ignore_index=True), seen)
            yield out
        if seen:
            self.last.put(seen)

    def set_aside(self, frame: pd.DataFrame, parts: dict[str, int]) -> None:
        for place, rows in frame.groupby(range_of(frame[self.order[0]], self.width), sort=False):
            part = parts.get(place, 0)
            self.aside.updateValue((place, part), (pickle.dumps(rows),))
            parts[place] = part + 1

    def window(self, frame: pd.DataFrame, seen: list[tuple]) -> tuple[pd.DataFrame, list[tuple]]:
        """The frame in order with its means, and the ticks the next one needs."""
        if self.order:
            frame = frame.sort_values(self.order, kind="stable", na_position="first")
        frame = frame.reset_index(drop=True)
        before = np.array(seen, dtype="float64").reshape(-1, 2)
        for k, (column, mean) in enumerate((("price", "priceavg"), ("volume", "volumeavg"))):
            frame[column] = frame[column].astype("float64")
            frame[mean] = window_means(before[:, k], frame[column].to_numpy(), self.n)
        keep = self.n - 1
        both = np.concatenate([before, frame[["price", "volume"]].to_numpy(dtype="float64")])
        return frame, [tuple(r) for r in both[len(both) - min(keep, len(both)):].tolist()]

    def close(self) -> None:
        pass
