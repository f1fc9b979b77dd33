"""Best-fit packing of tokenised documents into sequences of fixed capacity.

The shape of the packing depends only on how many pieces there are of each
length, so the plan is made on that histogram (at most ``capacity`` rows,
whatever the corpus) and applied to the pieces by their rank within their
length:

* pieces above one third of the capacity: at most two fit a sequence, and
  greedy matching gives each (longest first) the longest partner that fits;
* shorter pieces, longest first, go to the fullest sequence that still takes
  them, several at a time where they are equal, and open new sequences only
  when no gap is left.

Defined results: null text counts as empty (one piece holding the end id);
repeated rows are packed like any other row; an empty table gives no row; only
``doc_id`` and ``text`` are read, so other columns may have any name.  Very long
texts are encoded whole and cut into pieces; pieces of one length (ties) are
ranked by doc_id, piece and checksum.
"""

from __future__ import annotations

import bisect
import os
import re
import struct
import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import on_workers, stored

CAPACITY = 4096
END_ID = 1
PART_CHARS = 1_000_000    # text encoded together
CACHE_WORDS = 300_000     # words whose ids a worker remembers (memory bound, no effect on results)
GROUP_ROWS = 500          # aimed rows of one length ranked together
MAX_SALTS = 4096          # parts a length is cut into at most

# Letters whose capitals and small ones Unicode pairs within Latin-1, in normal form as they stand; the marks of
# ASCII but ' (it begins contractions) and those of added tokens, < | and >.
LATIN_SMALL = "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
PLAIN = re.compile(f"([A-Za-z{LATIN_SMALL}ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ]+)([!-&(-/:;=?@[-`{{}}~]*)").fullmatch

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of texts as little-endian uint32 bytes.  The tokenizer never joins
    characters across a space or line feed, so each space-separated part is
    encoded once and remembered.  An unknown part of Latin letters and marks
    after them is a word and a run of marks to the pre-tokenizer, so the model
    takes each as it is; other unknown parts of many texts are encoded together
    and told apart by the places of their tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        split = self.tok.pre_tokenizer.pre_tokenize_str
        self.symbols = {ord(c): split(c)[0][0] for c in LATIN_SMALL}       # as the model has them
        self.seen: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        words = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.seen) > CACHE_WORDS:
            self.older, self.seen = self.seen, {"": b""}
        seen, rare = self.seen, []
        for w in set().union(*words).difference(seen):
            if w in self.older:
                seen[w] = self.older[w]
            elif plain := PLAIN(w):
                word, marks = plain.groups()
                ids = marks and seen.get(word) or self._ids(word.lower())
                seen[w] = ids + self._marks(marks) if marks else ids
            else:
                rare.append(w)
        for i in range(0, len(rare), 1000):
            self._learn(rare[i:i + 1000])
        return [b"".join([seen[w] for w in ws]) for ws in words]

    def _ids(self, word: str) -> bytes:
        ids = [t.id for t in self.tok.model.tokenize(word if word.isascii() else word.translate(self.symbols))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _marks(self, marks: str) -> bytes:
        if marks not in self.seen:
            self.seen[marks] = self._ids(marks)
        return self.seen[marks]

    def _learn(self, words: list[str]) -> None:
        import numpy as np
        e = self.tok.encode(" ".join(words), add_special_tokens=False)
        begins = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words])))
        word_of = np.searchsorted(begins, [o[0] for o in e.offsets], side="right") - 1
        ends = (4 * np.searchsorted(word_of, np.arange(len(words) + 1))).tolist()
        ids = np.asarray(e.ids, "<u4").tobytes()
        self.seen.update((w, ids[a:b]) for w, a, b in zip(words, ends, ends[1:]))


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def encoded(batch, encode: WordEncoder):
    """(doc_id, ids) of an Arrow batch of (doc_id, text), ``PART_CHARS`` at a time."""
    held, texts, size = [], [], 0
    for doc_id, text in zip(batch.column(0), batch.column(1)):
        held.append(doc_id.as_py())
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size > PART_CHARS:
            yield from zip(held, encode(texts))
            held, texts, size = [], [], 0
    yield from zip(held, encode(texts))


def token_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
                 end_id: int = END_ID) -> DataFrame:
    """Every document's ids (end id last), cut into pieces of ``capacity``."""
    path = tokenizer or default_tokenizer()
    end = end_id.to_bytes(4, "little")

    def cut(batches):
        import pyarrow as pa
        encode = _encoder(path)
        for b in batches:
            out = [], [], [], [], []
            for doc_id, ids in encoded(b, encode):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    for column, v in zip(out, (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(v)
            types = pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    return on_workers(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


class _Gaps:
    """Open sequences by what still fits: (first sequence, how many) per gap."""

    def __init__(self):
        self.sizes: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, gap: int, first: int, n: int) -> None:
        if gap <= 0 or n <= 0:
            return
        if gap not in self.runs:
            self.runs[gap] = []
            bisect.insort(self.sizes, gap)
        self.runs[gap].append((first, n))

    def tightest(self, length: int) -> tuple[int, int, int] | None:
        i = bisect.bisect_left(self.sizes, length)
        if i == len(self.sizes):
            return None
        gap = self.sizes[i]
        first, n = self.runs[gap].pop()
        if not self.runs[gap]:
            del self.runs[gap], self.sizes[i]
        return gap, first, n


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """Rows (length, first_rank, pieces, first_sequence, per_sequence, offset):
    the pieces of that length with these ranks go ``per_sequence`` to a
    sequence, side by side from ``offset``."""
    plan: list[tuple] = []
    left = {n: c for n, c in counts.items() if c > 0}
    rank = dict.fromkeys(left, 0)
    gaps, sequences = _Gaps(), 0

    def put(length: int, pieces: int, first: int, per: int, offset: int) -> None:
        plan.append((length, rank[length], pieces, first, per, offset))
        rank[length] += pieces
        left[length] -= pieces

    large = sorted(n for n in left if 3 * n > capacity)
    for n in reversed(large):
        while left[n]:
            i = bisect.bisect_right(large, min(n, capacity - n)) - 1
            while i >= 0 and left[large[i]] < (2 if large[i] == n else 1):
                i -= 1
            if i < 0:
                alone = left[n]
                put(n, alone, sequences, 1, 0)
                gaps.add(capacity - n, sequences, alone)
                sequences += alone
                continue
            mate = large[i]
            pairs = left[n] // 2 if mate == n else min(left[n], left[mate])
            if mate == n:
                put(n, 2 * pairs, sequences, 2, 0)
            else:
                put(n, pairs, sequences, 1, 0)
                put(mate, pairs, sequences, 1, n)
            gaps.add(capacity - n - mate, sequences, pairs)
            sequences += pairs
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            found = gaps.tightest(n)
            if found:
                gap, first, free = found
            else:
                gap, first = capacity, sequences
                free = -(-left[n] // (capacity // n))
                sequences += free
            per = gap // n
            full = min(free, left[n] // per)
            if full:
                put(n, full * per, first, per, capacity - gap)
                gaps.add(gap - per * n, first, full)
                gaps.add(gap, first + full, free - full)
            else:
                some = left[n]
                put(n, some, first, some, capacity - gap)
                gaps.add(gap - some * n, first, 1)
                gaps.add(gap, first + 1, free - 1)
    return plan


def ranked(pieces: DataFrame, largest: int) -> DataFrame:
    """``rank``: 0, 1, ... within each length.  A length is cut into parts, so
    that no task sorts all pieces of a frequent length; the parts' sizes give
    the offsets between them."""
    salts = max(1, min(MAX_SALTS, -(-largest // GROUP_ROWS)))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = (salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
             .select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    return (salted.join(bases, ["length", "_salt"])
            .withColumn("rank", F.col("_base") + F.row_number().over(within) - 1)
            .drop("_salt", "_base"))


def placed(ranks: DataFrame, plan: list[tuple]) -> DataFrame:
    """Look every piece's place up in the plan (its size is bounded by the
    capacity, so it goes to all tasks)."""
    rows = sorted(plan)
    shared = ranks.sparkSession.sparkContext.broadcast(rows)

    def assign(frames):
        import numpy as np
        plan = np.array(shared.value, dtype=np.int64).reshape(-1, 6)
        ends = np.cumsum(plan[:, 2])
        order = ends - plan[:, 2]                      # place of a plan row's first piece among all pieces
        first_of = dict(zip(plan[::-1, 0].tolist(), order[::-1].tolist()))
        for f in frames:
            at = f["length"].map(first_of).to_numpy(np.int64) + f["rank"].to_numpy(np.int64)
            p = plan[np.searchsorted(ends, at, side="right")]
            k = f["rank"].to_numpy(np.int64) - p[:, 1]
            f = f.drop(columns="rank")
            f["sequence_id"] = p[:, 3] + k // p[:, 4]
            f["offset"] = p[:, 5] + k % p[:, 4] * p[:, 0]
            yield f

    columns = [c.split()[0] for c in PIECES.split(", ")]
    return ranks.select(*columns, "rank").mapInPandas(assign, PLACED)


def best_fit_packing(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
                     end_id: int = END_ID) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    pieces = stored(token_pieces(docs, tokenizer, capacity, end_id), "op1-pieces")
    counts = {r["length"]: r["n"] for r in
              pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}   # at most `capacity` rows
    plan = packing_plan(counts, capacity)
    return placed(ranked(pieces, max(counts.values(), default=0)), plan)
