"""Spelling variants by Bloom-guided neighbourhoods.

Words are the letter runs of all texts (with the planted slips of the contract
applied), counted by Spark.  Each word's neighbours in one direction are
generated as hashes only: every deletion, and every replacement by a later
letter (the other directions are the same pairs seen from the other word).  A
blocked Bloom filter for each word length says which of them can be words; the
filters go to all workers, as many at a time as fit ``FILTER_BYTES``, a length
with a larger one in several passes over block ranges.  Only what passes
is shuffled: it meets the vocabulary by hash and length, and an exact
edit distance of the two words removes false positives.

A word's hash is a sum of letter times place multiplier, so an edit changes one
term (or moves a suffix by one place) and costs no new pass over the word.

A word's form is its near word of largest count where that is ``RATIO`` times
its own; counts grow along forms, so the chain to the root has at most
log10(largest count) links and is followed by pointer doubling.

Defined results: null text has no words, a null doc_id counts as empty text in
the slip's checksum; very long texts and words are taken whole; repeated rows
count again; of near words with the same count the first in code-point order
is the form; an empty table gives no row; only ``doc_id`` and ``text`` are
read, so other columns may have any name.
"""

from __future__ import annotations

import math
import re
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ASCII_UPPER, on_workers, stored

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
SLIP = 31                 # a run is changed where its checksum is divisible by this
FILTER_BYTES = 32 << 20   # filters sent to the workers at a time
BITS_PER_WORD = 16
PAGE = 4096               # 64-bit blocks built together
COUNTED = 400_000         # words a task counts before it sends them on
CELLS = 1 << 20           # edits hashed together by a worker

_LOWER = bytes.maketrans(ASCII_UPPER.encode(), ASCII_LOWER.encode())
LETTERS = "a-zÀ-ÿ"
FIRST_HIGH = 0xC0

WORDS = "id long, word string, n long, size int, h long, low long, high long"


def slipped(doc_id, run: str, prefix: int) -> str:
    """The run, or where 31 divides its checksum without one code point;
    ``prefix`` is the checksum of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), prefix)
    if h % SLIP:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with ``min_count`` occurrences and more."""
    def run(batches):
        import pyarrow as pa
        runs = re.compile(f"[{LETTERS}]{{{min_length},}}")      # a slip makes no run longer
        counts: dict[str, int] = {}

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                               pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word in runs.findall((text.as_py() or b"").translate(_LOWER).decode("utf-8", "replace")):
                    word = slipped(doc_id, word, prefix)
                    if len(word) >= min_length:
                        counts[word] = counts.get(word, 0) + 1
                if len(counts) > COUNTED:
                    yield out()
                    counts = {}
        yield out()

    rows = on_workers(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    return (rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def _mix(h):
    """The last steps of a 64-bit hash: every bit depends on all."""
    h = (h ^ (h >> 33)) * 0xFF51AFD7ED558CCD
    h = (h ^ (h >> 33)) * 0xC4CEB9FE1A85EC53
    return h ^ (h >> 33)


def _multipliers(size: int):
    """An odd multiplier for every place, by rule."""
    import numpy as np
    places = np.arange(1, size + 1, dtype=np.uint64)
    return _mix(places * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _by_size(words: list[bytes], limit: int = CELLS):
    """Places of words of one length, a bounded number of letters at a time,
    with their letters as a matrix."""
    import numpy as np
    places: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        places.setdefault(len(w), []).append(k)
    for size, at in places.items():
        step = max(1, limit // size)
        for i in range(0, len(at), step):
            part = at[i:i + step]
            yield size, part, np.frombuffer(b"".join([words[k] for k in part]), np.uint8).reshape(len(part), size)


def hashed(counts: DataFrame) -> DataFrame:
    """Words with an id, their length, hash and letters (bits of a-z and of
    U+00C0-U+00FF)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            words = [w.encode("latin-1") for w in b.column(1).to_pylist()]
            size, h = np.zeros(len(words), np.int32), np.zeros(len(words), np.uint64)
            low, high = np.zeros(len(words), np.int64), np.zeros(len(words), np.uint64)
            for length, at, letters in _by_size(words):
                size[at] = length
                h[at] = _mix((letters.astype(np.uint64) * _multipliers(length)).sum(axis=1, dtype=np.uint64))
                ascii_bits = np.where(letters < 128, np.int64(1) << (letters.astype(np.int64) - 97) % 64, 0)
                low[at] = np.bitwise_or.reduce(ascii_bits, axis=1)
                late = np.uint64(1) << (letters - np.uint8(FIRST_HIGH)).astype(np.uint64) % np.uint64(64)
                high[at] = np.bitwise_or.reduce(np.where(letters >= FIRST_HIGH, late, np.uint64(0)), axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(size), pa.array(h.view(np.int64)), pa.array(low),
                 pa.array(high.view(np.int64))], names=["id", "word", "n", "size", "h", "low", "high"])

    return counts.select(F.monotonically_increasing_id().alias("id"), "word", "n").mapInArrow(run, WORDS)


def filter_groups(blocks: dict[int, int], limit: int) -> list[list[tuple[int, int, int]]]:
    """Filters (length, first block, end block), grouped for the passes: no
    group has more than ``limit`` bytes."""
    at_most = max(PAGE, limit // 8 // PAGE * PAGE)
    groups, room = [], 0
    for size, n in sorted(blocks.items()):
        for first in range(0, n, at_most):
            end = min(n, first + at_most)
            if end - first > room or not groups:
                groups.append([])
                room = at_most
            groups[-1].append((size, first, end))
            room -= end - first
    return groups


def block_of(h, n: int):
    """The block of unsigned hashes among ``n``: from the upper half."""
    import numpy as np
    return ((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def bits_of(h):
    """Four bits of a block, from the lower half."""
    import numpy as np
    one, field = np.uint64(1), np.uint64(63)
    bits = one << (h & field)
    for shift in (6, 12, 18):
        bits = bits | one << (h >> np.uint64(shift) & field)
    return bits


def build_filters(words: DataFrame, blocks: dict[int, int], group: list[tuple[int, int, int]]) -> dict[int, tuple]:
    """{length: (blocks in all, first block, 64-bit blocks)} for one group,
    built page by page on the workers."""
    import numpy as np
    spark = words.sparkSession
    ranges = spark.createDataFrame([(s, blocks[s], a, b) for s, a, b in group],
                                   "size int, blocks long, first long, end long")
    block = F.shiftrightunsigned(F.shiftrightunsigned("h", 32) * F.col("blocks"), 32)
    keys = (words.select("size", "h").join(F.broadcast(ranges), "size").withColumn("block", block)
            .where((F.col("block") >= F.col("first")) & (F.col("block") < F.col("end")))
            .select("size", F.floor(F.col("block") / PAGE).alias("page"), (F.col("block") % PAGE).alias("at"), "h"))

    def page(key, rows):
        import numpy as np
        import pyarrow as pa
        bits = np.zeros(PAGE, np.uint64)
        h = rows.column("h").to_numpy().view(np.uint64)
        np.bitwise_or.at(bits, rows.column("at").to_numpy(), bits_of(h))
        return pa.table({"size": [key[0].as_py()], "page": [key[1].as_py()], "bits": [bits.tobytes()]},
                        schema=pa.schema([("size", pa.int32()), ("page", pa.int64()), ("bits", pa.binary())]))

    pages = keys.groupBy("size", "page").applyInArrow(page, "size int, page long, bits binary")
    # all blocks of the group's lengths, also those without a word
    filters = {s: (blocks[s], a, np.zeros(-(-(b - a) // PAGE) * PAGE, np.uint64)) for s, a, b in group}
    for row in pages.toLocalIterator():
        _, first, bits = filters[row["size"]]
        at = row["page"] * PAGE - first
        bits[at:at + PAGE] = np.frombuffer(row["bits"], np.uint64)
    return filters


def _passes(h, found: tuple):
    """Which hashes the filter lets through."""
    import numpy as np
    n, first, bits = found
    at = block_of(h, n).astype(np.int64) - first
    inside = (at >= 0) & (at < len(bits))
    want = bits_of(h)
    return inside & (bits[np.where(inside, at, 0)] & want == want)


def edits(letters, size: int, alphabet, filters: dict[int, tuple]):
    """Rows and hashes (with their length) of the edits of words of one length
    that a filter lets through: replacements by later letters, deletions."""
    import numpy as np
    n = len(letters)
    value, by = letters.astype(np.uint64), _multipliers(size)
    terms = value * by
    whole = terms.sum(axis=1, dtype=np.uint64)
    if size in filters and len(alphabet):
        new = np.array(alphabet, np.uint64)
        step = max(1, CELLS // (n * len(new)))
        for i in range(0, size, step):
            old = value[:, i:i + step, None]
            h = whole[:, None, None] + (new - old) * by[i:i + step, None]
            row = np.broadcast_to(np.arange(n)[:, None, None], h.shape)
            later = new > old
            h, row = _mix(h[later]), row[later]
            hit = _passes(h, filters[size])
            yield row[hit], h[hit], size
    if size - 1 in filters:
        before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
        moved = value[:, 1:] * by[:-1]
        after = np.zeros_like(terms)
        after[:, :-1] = np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
        first = np.ones(letters.shape, bool)          # of a run of one letter, one deletion
        first[:, 1:] = letters[:, 1:] != letters[:, :-1]
        row = np.broadcast_to(np.arange(n)[:, None], letters.shape)[first]
        h = _mix((before + after)[first])
        hit = _passes(h, filters[size - 1])
        yield row[hit], h[hit], size - 1


def candidates(words: DataFrame, filters: dict[int, tuple], alphabets: dict[int, list[int]]) -> DataFrame:
    """(id, size, h): a word and the length and hash of a neighbour that may
    be a word."""
    shared = words.sparkSession.sparkContext.broadcast((filters, alphabets))
    sizes = sorted(set(filters) | {s + 1 for s in filters})

    def run(batches):
        import numpy as np
        import pyarrow as pa
        filters, alphabets = shared.value
        for b in batches:
            ids = b.column(0).to_numpy()
            spelt = [w.encode("latin-1") for w in b.column(1).to_pylist()]
            for size, at, letters in _by_size(spelt, CELLS // 16):
                for row, h, to in edits(letters, size, alphabets.get(size, []), filters):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[np.asarray(at)[row]]), pa.array(np.full(len(row), to, np.int32)),
                         pa.array(h.view(np.int64))], names=["id", "size", "h"])

    return (words.where(F.col("size").isin(sizes)).select("id", "word")
            .mapInArrow(run, "id long, size int, h long"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b): ids of words one edit apart, each pair once.  ``words`` is a
    stored table of :func:`hashed`."""
    shape = words.groupBy("size").agg(F.count("*").alias("n"), F.bit_or("low").alias("low"),
                                      F.bit_or("high").alias("high")).collect()      # one row per word length
    blocks = {r["size"]: max(1, -(-r["n"] * BITS_PER_WORD // 64)) for r in shape}
    alphabets = {r["size"]: [97 + k for k in range(26) if r["low"] >> k & 1]
                 + [FIRST_HIGH + k for k in range(64) if r["high"] >> k & 1] for r in shape}
    spelt = words.select(F.col("id").alias("b"), F.col("word").alias("near"), "size", "h")
    pairs = None
    for group in filter_groups(blocks, FILTER_BYTES):
        found = candidates(words, build_filters(words, blocks, group), alphabets)
        met = (found.join(spelt, ["size", "h"]).join(words.select("id", "word"), "id")
               .where(F.levenshtein("word", "near", 1) == 1).select(F.col("id").alias("a"), "b"))
        met = stored(met, "op13-pairs")
        pairs = met if pairs is None else pairs.union(met)
    return words.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0) if pairs is None else pairs


def roots(forms: DataFrame, links: int) -> DataFrame:
    """(id, root): the end of each word's chain of forms of at most ``links``
    links; ``forms`` is (id, root) with the first link."""
    at = stored(forms, "op13-roots")
    for _ in range(max(0, math.ceil(math.log2(max(links, 1))))):
        then = at.select(F.col("id").alias("root"), F.col("root").alias("next"))
        at = stored(at.join(then, "root", "left").select("id", F.coalesce("next", "root").alias("root")), "op13-roots")
    return at


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                      ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word."""
    words = stored(hashed(word_counts(docs, min_length, min_count)), "op13-words")
    pairs = near_pairs(words)
    counts = words.select(F.col("id").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    both = pairs.union(pairs.select("b", "a")).toDF("id", "b").join(counts, "b")
    best = both.groupBy("id").agg(F.count("*").alias("n_near"), F.min(F.struct(
        (-F.col("near_n")).alias("less"), "near", "b")).alias("best"))
    known = stored(words.select("id", "word", "n").join(best, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), (-F.col("best.less")).alias("form_n"),
        F.col("best.near").alias("form"), F.col("best.b").alias("root"))
        .withColumn("formed", F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False))), "op13-forms")
    largest = known.agg(F.max("n")).first()[0] or 1
    links = int(math.log(max(largest, 1), ratio)) + 1
    ends = roots(known.where("formed").select("id", "root"), links)
    spelt = known.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    ends = ends.join(spelt, "root").select("id", "root_word")
    return known.drop("root").join(ends, "id", "left").select(
        "word", F.when(F.col("formed"), F.col("form")).alias("form"),
        F.coalesce("root_word", "word").alias("root"), "n", "n_near",
        F.when(F.col("formed"), F.col("form_n")).alias("form_n"))
