"""Language-model scoring with a hidden Markov model over words.

Words are counted over all training documents.  Every word seen at least
``MIN_OWN`` times there has emissions of its own, however many such words there
are; the truly rare ones and the unseen belong to one of ``CLASSES`` classes by
their last three bytes, a state emits the class, and the class gives the word
with add-one smoothing of its count (one unknown word a class).  The end of a
document is emitted by a state of its own, from which the next document
starts, so documents laid end to end have exactly the likelihood they have
apart, and many lanes of documents run through the recursions together.

Training is Baum-Welch: the scaled forward-backward recursion over the
documents gives expected counts, Spark sums them, and the new parameters go
out with the next pass; a word's shares in the states are drawn to the overall
ones, so that a word is not tied to one state by a few tokens.  The emissions
of the ``HEAD_WORDS`` most frequent words and of the classes travel whole with
every pass.  Those of all other words are a table in parts by hash of the word
(it grows with the input and never meets on the driver): each block of
documents (about ``BLOCK_TOKENS`` tokens) is sent those of the words it has,
and gives back their expected counts.  Documents are stored once, their ids in
few bytes; a pass puts them together with what was found of the words that do
not travel whole.  ``WARM_PASSES`` passes over one document
in ``WARM_PART``, by hash of its id, give start values only, with words that
do not travel whole telling nothing; then ``PASSES`` passes run over all
training documents.  The score is the exact log10 likelihood by the scaled
forward recursion over the whole text.

Words that are not among the most frequent (at most ``LOOKUP_WORDS``) are
looked up part by part, once for each block.

Defined results: null text counts as empty (one token, the end); a null doc_id
is in the fold of an empty id; repeated rows are scored, and trained on, like
any other; an empty table gives no row; without training documents the model
is uniform; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, free_shuffles, on_workers, stored

FOLDS = 7
HELD_OUT = 2
MIN_OWN = 5               # training words seen so often have emissions of their own
HEAD_WORDS = 32_768       # of these, as many travel whole with every pass, the others to the blocks that have them
LOOKUP_WORDS = 131_072
BLOCK_TOKENS = 8_000_000  # tokens of the documents that share the emissions sent to them
PART_TOKENS = 500_000     # training tokens of the words that a task looks up, or re-estimates
CHUNK, SALT = 4_096, 8    # the counts of the words that travel whole are summed in so many rows and shares of the blocks
CLASSES = 1_024
STATES = 16               # the last one emits the end, and only that
PASSES = 3
WARM_PASSES = 6
WARM_PART = 16
SHRINK = 4.0              # a word's shares in the states are drawn to the overall shares by so many tokens
BATCH_TOKENS = 400_000    # tokens that run through the recursions together
LANES = 512
SPAN = 8_192              # places of a grid whose emissions are fetched at once
COUNTED_WORDS = 400_000   # words a task counts before it hands them on

DOCUMENT = "doc_id long, held_out boolean, n_tokens long, known long, base double, inside double, ids binary"
ASKED = "at int, seen binary, own binary, c array<long>"


def _tokens(texts):
    """Words of the A-Z lower-cased texts (Arrow's ASCII functions know A-Z and
    the six blanks only): (numbers into the distinct words, these, words of
    each text)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string()).fill_null("")))
    words = lists.flatten().dictionary_encode()
    numbers, distinct = words.indices.to_numpy(), words.dictionary.cast(pa.binary()).to_pylist()
    sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
    if b"" in distinct:                                   # beside blanks at a text's ends
        blank = distinct.index(b"")
        there = numbers != blank
        before = np.concatenate(([0], np.cumsum(there)))
        sizes = np.diff(before[np.concatenate(([0], np.cumsum(sizes)))])
        numbers = numbers[there]
        numbers = numbers - (numbers > blank)
        del distinct[blank]
    return numbers, distinct, sizes


def _packed(values):
    """Whole numbers below 2^28 in 1 to 4 bytes each, seven bits a byte, the
    last one below 128: (bytes, places after each number)."""
    import numpy as np
    size = 1 + (values >= 1 << 7).astype(np.int64) + (values >= 1 << 14) + (values >= 1 << 21)
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(4):
        has = np.flatnonzero(size > k)
        out[ends[has] - size[has] + k] = (values[has] >> 7 * k & 127) | (size[has] > k + 1).astype(values.dtype) << 7
    return out, ends


def _unpacked(blob):
    import numpy as np
    data = np.frombuffer(blob, np.uint8)
    ends = np.flatnonzero(data < 128)
    starts = np.concatenate(([0], ends + 1))[:len(ends)]
    values = (data[starts] & 127).astype(np.int32)
    for k in (1, 2, 3):
        has = np.flatnonzero(ends - starts >= k)
        values[has] |= (data[starts[has] + k] & 127).astype(np.int32) << 7 * k
    return values


def _squeezed(values) -> bytes:
    """Numbers of one type as planes of their bytes, which compress better."""
    import numpy as np
    import pyarrow as pa
    raw = np.ascontiguousarray(values)
    planes = raw.view(np.uint8).reshape(-1, raw.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _loose(blob: bytes, dtype):
    import numpy as np
    import pyarrow as pa
    size = int.from_bytes(blob[:8], "little")
    planes = np.frombuffer(pa.decompress(blob[8:], size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def _count_words(batches):
    from collections import Counter

    import numpy as np
    import pyarrow as pa
    counts: Counter = Counter()

    def rows():
        out = pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.binary()),
                                          pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts.clear()
        return out

    for b in batches:
        numbers, words, sizes = _tokens(b.column(0))
        for w, n in zip(words, np.bincount(numbers, minlength=len(words)).tolist()):
            counts[w] += n
        counts[b""] += len(sizes)                         # the end: no word is empty
        if len(counts) > COUNTED_WORDS:
            yield rows()
    yield rows()


def word_counts(train: DataFrame) -> DataFrame:
    """(word, c) over all training texts; the end counts as the empty word."""
    return (on_workers(train).select(F.col("text").cast("string")).mapInArrow(_count_words, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("c")))


def _frequent(words: DataFrame, most: int) -> DataFrame:
    """The words above a count that at most ``most`` words reach.  The count is
    found in steps of about one per cent, from a small histogram, so that no
    partition's candidates meet on the driver."""
    step = F.floor(F.log2(F.col("c").cast("double")) * 64)
    sizes = words.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()    # at most 64 * 63 rows
    least, total = 1 << 20, 0
    for r in sorted(sizes, key=lambda r: -r["step"]):
        total += r["n"]
        if total > most:
            break
        least = r["step"]
    return words.where(step >= least)


class Vocabulary:
    """What the encoder needs: bounded by LOOKUP_WORDS and CLASSES."""

    def __init__(self, vocab: DataFrame):
        import numpy as np
        total = vocab.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
        self.n, self.v = total["n"] or 0, total["v"]
        words = vocab.where(F.length("word") > 0)
        top = _frequent(words, LOOKUP_WORDS).select("word", "c").toArrow().sort_by(
            [("c", "descending"), ("word", "ascending")])
        counts = top["c"].to_numpy().astype(np.int64)
        self.head = min(HEAD_WORDS, int((counts >= MIN_OWN).sum()))
        here = (np.arange(len(counts)) < self.head) | (counts < MIN_OWN)      # the others are looked up in parts
        counts = counts[here]
        self.index = {w: i for i, w in enumerate(top.filter(here)["word"].to_pylist())}
        rare = words.where(F.col("c") < MIN_OWN)
        tail = rare.groupBy(F.pmod(F.crc32(F.substring("word", -3, 3)), F.lit(CLASSES)).alias("k")).agg(
            F.sum("c").alias("n"), F.count("*").alias("v")).collect()
        class_n, class_v = np.zeros(CLASSES), np.zeros(CLASSES)
        for r in tail:
            class_n[r["k"]], class_v[r["k"]] = r["n"], r["v"]
        klass = np.array([self.klass(w) for w in self.index], np.int64)
        self.end_id = self.head + CLASSES
        rank = np.arange(len(counts))
        self.ids = np.where(rank < self.head, rank, self.head + klass).astype(np.int32)
        self.log_count = np.log10(counts + 1.0)
        ends = vocab.where(F.length("word") == 0).first()
        self.ends = ends["c"] if ends else 0
        self.parts = max(1, -(-int(self.n - self.ends - counts.sum()) // PART_TOKENS))
        self.log_class = np.log10(class_n + class_v + 1)
        self.emitted = np.concatenate((counts[:self.head], class_n, [self.ends])).astype(np.float64)

    @staticmethod
    def klass(word: bytes) -> int:
        import zlib
        return zlib.crc32(word[-3:]) % CLASSES


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """A row per document (part -1): its emission ids, packed, and what is known
    of its base score and of the words inside their classes.  Words that are not
    in the vocabulary's index are numbered within a block of documents, by ids
    above the end's, part after part; a row per block and part has them, in the
    order of their numbers, and the first number."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext
        v = shared.value
        find, per_token = v.index.get, math.log10(v.n + v.v + 1)
        block, held, others, waiting = TaskContext.get().partitionId() << 24, 0, {}, []
        schema = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("doc_id", pa.int64()),
                            ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()),
                            ("base", pa.float64()), ("inside", pa.float64()), ("ids", pa.binary()),
                            ("words", pa.binary()), ("at", pa.int32())])

        def finished():
            words = list(others)
            part = np.fromiter((zlib.crc32(w) % v.parts for w in words), np.int64, len(words))
            order = np.argsort(part, kind="stable")
            number = np.empty(len(order), np.int32)
            number[order] = np.arange(len(order))
            while waiting:
                columns, ids, sizes = waiting.pop(0)
                rare = np.flatnonzero(ids > v.end_id)
                ids[rare] = v.end_id + 1 + number[ids[rare] - v.end_id - 1]
                blob, ends = _packed(ids)
                offsets = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(sizes)))]
                n = len(sizes)
                packed = pa.Array.from_buffers(pa.binary(), n, [
                    None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(blob)])
                yield pa.RecordBatch.from_arrays([
                    pa.array([block] * n, pa.int64()), pa.array([-1] * n, pa.int32()), *columns, packed,
                    pa.nulls(n, pa.binary()), pa.nulls(n, pa.int32())], schema=schema)
            first = np.searchsorted(part[order], np.arange(v.parts + 1)).tolist()
            yield pa.RecordBatch.from_pylist([
                {"block": block, "part": p, "words": b"\n".join(words[q] for q in order[a:b].tolist()), "at": a}
                for p, (a, b) in enumerate(zip(first, first[1:])) if a < b], schema)

        for whole in batches:
            size = np.cumsum(pc.binary_length(whole.column(2).cast(pa.binary())).fill_null(0).to_numpy())
            cuts = np.flatnonzero(np.diff(size // BLOCK_TOKENS, append=-1)) + 1      # fewer tokens than bytes
            for first, last in zip([0, *cuts.tolist()], cuts.tolist()):
                b = whole.slice(first, last - first)
                if held >= BLOCK_TOKENS:
                    yield from finished()
                    block, held, others = block + 1, 0, {}
                numbers, words, sizes = _tokens(b.column(2))
                of_word = np.fromiter((find(w, -1) for w in words), np.int64, len(words))
                id_of, log_c, inside = (np.zeros(len(words), t) for t in (np.int32, float, float))
                there = np.flatnonzero(of_word >= 0)
                id_of[there] = v.ids[of_word[there]]
                log_c[there] = v.log_count[of_word[there]]
                rare = there[of_word[there] >= v.head]
                inside[rare] = log_c[rare] - v.log_class[id_of[rare] - v.head]
                for i in np.flatnonzero(of_word < 0).tolist():
                    id_of[i] = v.end_id + 1 + others.setdefault(words[i], len(others))
                of = np.repeat(np.arange(len(sizes)), sizes)
                add = lambda x: np.bincount(of, weights=x[numbers], minlength=len(sizes))
                n_tokens = sizes + 1
                known = add((of_word >= 0).astype(float)).astype(np.int64) + (v.ends > 0)
                base = add(log_c) + math.log10(v.ends + 1) - per_token * n_tokens
                ids = np.full(int(n_tokens.sum()), v.end_id, np.int32)
                ids[np.arange(len(numbers)) + of] = id_of[numbers]
                waiting.append(((b.column(0), b.column(1), pa.array(n_tokens), pa.array(known), pa.array(base),
                                 pa.array(add(inside))), ids, n_tokens))
                held += len(ids)
        yield from finished()

    rows = docs.select(F.col("doc_id").cast("long"),
                       (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), F.col("text").cast("string"))
    # few tasks, so that blocks fill up and few of them share a word, but enough for all cores
    tasks = max(vocabulary.n * FOLDS // (FOLDS - 1) // BLOCK_TOKENS, 2 * spark.sparkContext.defaultParallelism)
    return stored(rows.coalesce(tasks).mapInArrow(run, f"block long, part int, {DOCUMENT}, words binary, at int"),
                  "op2-encoded")


def _both(left: DataFrame, right: DataFrame, key: str, run, schema: str) -> DataFrame:
    """``run`` over the rows that both tables have of a key, as Arrow tables."""
    return left.groupBy(key).cogroup(right.groupBy(key)).applyInArrow(run, schema)


def look_up(encoded: DataFrame, vocab: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(block, part, at, seen, own, c): counts of the blocks' words, part by
    part; own is the word's number among the part's words with emissions of
    their own, or -1 - its class.  Rows with block -1 have the counts of the former."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(asked, words):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        v = shared.value
        words = words.sort_by("word").combine_chunks()
        c, klass = words["c"].to_numpy(), words["klass"].to_numpy()
        mine = np.flatnonzero(c >= MIN_OWN)
        mine = mine[[w not in v.index for w in words["word"].take(pa.array(mine)).to_pylist()]]
        own = (-1 - klass).astype(np.int32)
        own[mine] = np.arange(len(mine))
        c, own = np.append(c, 0), np.append(own, 0).astype(np.int32)         # last: an unknown word
        out = []
        if len(mine):
            out.append({"block": -1, "part": words["part"][0].as_py(), "c": c[mine]})
        for r in asked.to_pylist():
            ask = pa.array(r["words"].split(b"\n"), pa.binary())
            found = pc.index_in(ask, value_set=words["word"]).fill_null(len(c) - 1).to_numpy()
            owns = own[found]
            new = np.flatnonzero(found == len(c) - 1)
            owns[new] = [-1 - v.klass(w) for w in ask.take(pa.array(new)).to_pylist()]
            out.append({"block": r["block"], "part": r["part"], "at": r["at"], "seen": _squeezed(c[found]),
                        "own": _squeezed(owns)})
        return pa.Table.from_pylist(out, pa.schema([
            ("block", pa.int64()), ("part", pa.int32()), ("at", pa.int32()), ("seen", pa.binary()),
            ("own", pa.binary()), ("c", pa.list_(pa.int64()))]))

    part = F.pmod(F.crc32("word"), F.lit(vocabulary.parts)).cast("int").alias("part")
    klass = F.pmod(F.crc32(F.substring("word", -3, 3)), F.lit(CLASSES)).alias("klass")
    found = _both(encoded.where("part >= 0").select("block", "part", "at", "words"),
                  vocab.where(F.length("word") > 0).select(part, "word", "c", klass), "part", run,
                  f"block long, part int, {ASKED}")
    return stored(found, "op2-found")


def resolve(encoded: DataFrame, found: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The documents of each block, and a row per block and part with what was
    found of the words numbered there: both stay where they are stored, and a
    pass puts them together (see :func:`_places`)."""
    return encoded.where("part = -1").drop("words", "at").unionByName(
        found.where("block >= 0").drop("c"), allowMissingColumns=True)


def _places(found, head: int, end_id: int):
    """What was found of a block's words: (its rows by part, the emission id of
    each number above the end's - a class, or one of the block's own words, by
    part and number - and, row by row, the own words' numbers in the parts)."""
    import numpy as np
    found = found.sort_by("at")
    owns = [_loose(x, np.int32) for x in found["own"].to_pylist()]
    own = np.concatenate([np.zeros(0, np.int32), *owns])
    mine = own >= 0
    return found, np.where(mine, end_id + np.cumsum(mine), head - 1 - own).astype(np.int32), [x[x >= 0] for x in owns]


def _resolved(values, to, end_id: int):
    """Ids of documents with those above the end's as :func:`_places` has them."""
    import numpy as np
    rare = np.flatnonzero(values > end_id)
    values[rare] = to[values[rare] - end_id - 1]
    return values


def _lanes(lengths):
    """(place of each document, steps, lanes): documents laid end to end in
    lanes of about equal length; a place is step * lanes + lane."""
    total, longest = sum(lengths), max(lengths)
    lanes = max(1, min(LANES, len(lengths), total // longest))
    loads = [(0, lane) for lane in range(lanes)]
    place = [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        load, lane = heapq.heappop(loads)
        place[i] = load * lanes + lane
        heapq.heappush(loads, (load + lengths[i], lane))
    return place, max(load for load, _ in loads), lanes


def _groups(docs):
    """A table's documents, by length, in groups of about BATCH_TOKENS: (numbers
    in the table, their ids end to end, the places between them)."""
    import numpy as np
    sizes = docs["n_tokens"].to_numpy()
    order = np.argsort(sizes, kind="stable")
    ends, first = np.cumsum(sizes[order]), 0
    while first < len(order):
        held = ends[first - 1] if first else 0
        last = min(len(order), int(np.searchsorted(ends, held + BATCH_TOKENS)) + 1)
        yield (order[first:last], _unpacked(b"".join(docs["ids"].take(order[first:last]).to_pylist())),
               ends[first:last - 1] - held)
        first = last


def _matrix(ids, pad: int):
    """Ids as [step, lane], the lanes filled up with ``pad``; and each
    document's places there."""
    import numpy as np
    place, steps, lanes = _lanes([len(x) for x in ids])
    grid = np.full(steps * lanes, pad, np.int64)
    places = [np.arange(len(x)) * lanes + p for x, p in zip(ids, place)]
    for x, p in zip(ids, places):
        grid[p] = x
    return grid.reshape(steps, lanes), places


def forward(grid, trans, emit):
    """Scaled forward recursion: state probabilities [step, lane, state] and
    the scale (token likelihood) of every place."""
    import numpy as np
    (steps, lanes), states = grid.shape, len(trans)
    alpha = np.empty((steps, lanes, states), np.float32)
    scale = np.empty((steps, lanes), np.float32)
    now = np.zeros((lanes, states), np.float32)
    now[:, -1] = 1                                        # a document starts after an end
    ones, moved, span = np.ones(trans.shape, np.float32), np.empty_like(now), max(1, SPAN // lanes)
    sums = np.empty((span, lanes, states), np.float32)
    for first in range(0, steps, span):
        rows = alpha[first:first + span]
        emit.take(grid[first:first + span], axis=0, out=rows, mode="clip")
        for row, c in zip(rows, sums):
            row *= np.matmul(now, trans, out=moved)
            row /= np.matmul(row, ones, out=c)            # the sum, in every column
            now = row
        scale[first:first + span] = sums[:len(rows), :, 0]
    return alpha, scale


def expected_counts(grid, trans, emit, pad: int):
    """Expected transitions [from, to] and emissions [id, state] of a grid."""
    import numpy as np
    alpha, scale = forward(grid, trans, emit)
    steps, lanes, states = alpha.shape
    moves, span = np.zeros((states, states)), max(1, SPAN // lanes)
    start = np.zeros((lanes, states), np.float32)
    start[:, -1] = 1
    last = np.ones((lanes, states), np.float32)
    back = np.ascontiguousarray(trans.T)
    afters, betas = (np.empty((span, lanes, states), np.float32) for _ in range(2))
    for first in range((steps - 1) // span * span, -1, -span):
        part = grid[first:first + span]
        n = len(part)
        after, beta = emit.take(part, axis=0, out=afters[:n], mode="clip"), betas[:n]
        after /= scale[first:first + n, :, None]
        beta[-1] = last
        for k in range(n - 1, -1, -1):
            after[k] *= beta[k]
            np.matmul(after[k], back, out=beta[k - 1] if k else last)
        if (part == pad).any():
            after *= (part != pad)[:, :, None]
        if not first:
            moves += start.T @ after[0]
        skip = int(not first)
        moves += alpha[first + skip - 1:first + n - 1].reshape(-1, states).T @ after[skip:].reshape(-1, states)
        alpha[first:first + n] *= beta                    # padding is counted as id ``pad``, which goes
    moves *= trans
    flat, gamma = grid.ravel(), alpha.reshape(-1, states)
    counts = np.stack([np.bincount(flat, weights=gamma[:, s], minlength=pad + 1) for s in range(states)], axis=1)
    return moves, counts[:pad]


def start_model(vocabulary: Vocabulary):
    """Transitions that mostly stay, emissions near the overall ones, each
    state moved at random (fixed seed)."""
    import numpy as np
    rng = np.random.default_rng(11)
    p = (vocabulary.emitted[:-1] + 0.5) / (vocabulary.emitted[:-1] + 0.5).sum()
    noise = np.exp(rng.normal(0, 0.6, (len(p), STATES - 1)))
    trans = np.full((STATES, STATES), 0.4 / STATES) + 0.6 * np.eye(STATES)
    trans[-1] = 1.0
    trans[-1, -1] = 0.02
    return trans / trans.sum(axis=1, keepdims=True), p[:, None] * noise / (p[:, None] * noise).sum(axis=0)


def _tables(trans, emit, own=None):
    """The model as the recursions use it: the end state's column, the rows of
    a block's own words, and a last row for the padding, which every state
    emits.  Without ``own``, one row stands for all own words and tells nothing."""
    import numpy as np
    own = np.ones((1, STATES - 1), np.float32) if own is None else own
    full = np.zeros((len(emit) + 2 + len(own), STATES), np.float32)
    full[:len(emit), :-1] = emit
    full[len(emit), -1] = 1
    full[len(emit) + 1:-1, :-1] = own
    full[-1] = 1
    return trans.astype(np.float32), full


def _shares(counts, share):
    """Of each word, its tokens' shares in the states, drawn to the overall ones."""
    return (counts + SHRINK * share) / (counts.sum(axis=1) + SHRINK)[:, None]


def _grid(ids, emit):
    """The documents as a grid over the ids they have: (grid, places, these
    ids, their emissions with the padding's)."""
    import numpy as np
    used = np.flatnonzero(np.bincount(np.concatenate(ids), minlength=len(emit)))
    number = np.zeros(len(emit), np.int64)
    number[used] = np.arange(len(used))
    grid, places = _matrix([number[x] for x in ids], len(used))
    return grid, places, used, np.concatenate((emit[used], emit[-1:]))


def _count(docs, to, end_id: int, trans, emit):
    """Expected transitions and emissions of a table's documents."""
    import numpy as np
    moves, counts = np.zeros((STATES, STATES)), np.zeros((len(emit) - 1, STATES))
    for _, values, cuts in _groups(docs):
        grid, _, used, local = _grid(np.split(_resolved(values, to, end_id), cuts), emit)
        m, c = expected_counts(grid, trans, local, len(used))
        moves += m
        counts[used] += c
    return moves, counts


def _estimate(moves, counts, vocabulary: Vocabulary, own_total=0.0, own_mass=None):
    """(transitions, emissions, overall shares, mass of the states' emissions)
    from the sums; ``own_mass`` gives that of the own words from the shares."""
    moves = moves + 0.1
    counts = counts[:, :-1] + 1e-6
    total = counts.sum(axis=0) + own_total
    share = total / total.sum()
    emit = (vocabulary.emitted[:-1] + 0.5)[:, None] * _shares(counts, share)
    mass = emit.sum(axis=0) + (own_mass(share) if own_mass else 0)
    return moves / moves.sum(axis=1, keepdims=True), emit / mass, share, mass


def warm_pass(rows: DataFrame, trans, emit, vocabulary: Vocabulary):
    """One pass over the warm-up part, in which own words tell nothing."""
    import numpy as np
    shared = rows.sparkSession.sparkContext.broadcast(_tables(trans, emit))
    size, none = vocabulary.end_id, np.array([vocabulary.end_id + 1])

    def run(batches):
        import pyarrow as pa
        moves, counts = np.zeros((STATES, STATES)), np.zeros((size, STATES))
        for b in batches:
            m, c = _count(pa.Table.from_batches([b]), none, size, *shared.value)
            moves += m
            counts += c[:size]
        used = np.flatnonzero(counts.any(axis=1))
        rows = np.concatenate((moves, counts[used]))
        ids = np.concatenate((-1 - np.arange(STATES), used))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32())] + [
            pa.array(rows[:, s], pa.float32()) for s in range(STATES)],
            names=["id"] + [f"s{s}" for s in range(STATES)])

    columns = [f"s{s}" for s in range(STATES)]
    summed = (rows.select("n_tokens", "ids").mapInArrow(run, "id int, " + ", ".join(f"{c} float" for c in columns))
              .groupBy("id").agg(*[F.sum(c).alias(c) for c in columns]).toPandas())   # bounded by the model
    shared.unpersist()
    sums, ids = summed[columns].to_numpy(np.float64), summed["id"].to_numpy()
    moves, counts = np.zeros((STATES, STATES)), np.zeros((size, STATES))
    moves[-1 - ids[ids < 0]] = sums[ids < 0]
    counts[ids[ids >= 0]] = sums[ids >= 0]
    return _estimate(moves, counts, vocabulary)[:2]


class Model:
    """Transitions and the emissions of head words and classes; ``own`` has the
    other words' (part, c, sums) in Spark: counts of the words and, after a
    pass, their expected counts by state."""

    def __init__(self, trans, emit, own: DataFrame):
        self.trans, self.emit, self.own = trans, emit, own
        self.share = self.mass = None


def _matrix_of(blob: bytes, columns: int = STATES - 1):
    import numpy as np
    return np.frombuffer(blob, np.float32).reshape(-1, columns)


def _own_emissions(c, sums, share, mass):
    import numpy as np
    counts = _matrix_of(sums).astype(np.float64) + 1e-6
    return (np.array(c, np.float64) + 0.5)[:, None] * _shares(counts, share) / mass


def sent(rows: DataFrame, model: Model, *more: str) -> DataFrame:
    """(block, part, at, own, emit): the emissions of own words, for each block
    that has them, with the columns ``more`` of what was found."""
    found = rows.where("part >= 0").select("block", "part", "at", "own", *more)
    if model.share is None:                                  # nothing is known yet: they tell nothing
        return found.withColumn("emit", F.lit(None).cast("binary"))
    share, mass = model.share, model.mass

    def run(places, own):
        import numpy as np
        import pyarrow as pa
        out = [None] * places.num_rows
        for r in own.to_pylist():
            emit = _own_emissions(r["c"], r["sums"], share, mass).astype(np.float32)
            for i, x in enumerate(places["own"].to_pylist()):
                x = _loose(x, np.int32)
                x = x[x >= 0]
                out[i] = _squeezed(emit[x]) if len(x) else None
        return places.append_column("emit", pa.array(out, pa.binary()))

    kinds = "".join(f", {k} binary" for k in more)
    return _both(found, model.own, "part", run, f"block long, part int, at int, own binary{kinds}, emit binary")


def _with_own(found, mine, trans, emit):
    """The model's tables with the block's own words."""
    import numpy as np
    own = [np.ones((len(at), STATES - 1), np.float32) if x is None else _matrix_of(_loose(x, np.float32))
           for at, x in zip(mine, found["emit"].to_pylist())]
    return _tables(trans, emit, np.concatenate(own) if own else np.zeros((0, STATES - 1), np.float32))


def full_pass(rows: DataFrame, model: Model, vocabulary: Vocabulary) -> Model:
    """One pass over all training rows, with every word's own counts."""
    import numpy as np
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((model.trans, model.emit))
    size, head = vocabulary.end_id, vocabulary.head
    share_of_blocks = SALT

    def learn(docs, found):
        import pyarrow as pa
        out = {"part": [], "at": [], "sums": []}
        if docs.num_rows:
            found, to, mine = _places(found, head, size)
            trans, emit = _with_own(found, mine, *shared.value)
            moves, counts = _count(docs, to, size, trans, emit)
            own = counts[size + 1:, :-1].astype(np.float32)
            salt, whole = docs["block"][0].as_py() % share_of_blocks, np.concatenate(
                (moves, np.append(own.sum(axis=0, dtype=np.float64), 0)[None], counts[:size])).astype(np.float32)
            for i in range(0, len(whole), CHUNK):
                out["part"].append(-1 - (i // CHUNK * share_of_blocks + salt))
                out["at"].append(None)
                out["sums"].append(whole[i:i + CHUNK].tobytes())
            held = 0
            for part, at in zip(found["part"].to_pylist(), mine):
                sums = own[held:held + len(at)]
                held += len(at)
                seen = np.flatnonzero(sums.any(axis=1))      # not those of held-out documents only
                if len(seen):
                    out["part"].append(part)
                    out["at"].append(_squeezed(at[seen]))
                    out["sums"].append(_squeezed(sums[seen]))
        return pa.table(out, pa.schema([("part", pa.int32()), ("at", pa.binary()), ("sums", pa.binary())]))

    def add(counted, own):
        import pyarrow as pa
        schema = pa.schema([("part", pa.int32()), ("c", pa.list_(pa.int64())), ("sums", pa.binary())])
        if own.num_rows:
            total = np.zeros((len(own["c"][0]), STATES - 1))
            for r in counted.to_pylist():
                total[_loose(r["at"], np.int32)] += _matrix_of(_loose(r["sums"], np.float32))
        else:
            total = sum(_matrix_of(x.as_py(), STATES).astype(np.float64) for x in counted["sums"])
        part = (own if own.num_rows else counted)["part"].slice(0, 1)
        return pa.table([part, own["c"].slice(0, 1) if own.num_rows else pa.nulls(1, schema.field("c").type),
                         pa.array([total.astype(np.float32).tobytes()])], schema=schema)

    train = rows.where("part = -1 and not held_out").select("block", "n_tokens", "ids")
    counted = _both(train, sent(rows, model), "block", learn, "part int, at binary, sums binary")
    summed = stored(_both(counted, model.own.select("part", "c"), "part", add, "part int, c array<long>, sums binary"),
                    "op2-model")
    shared.unpersist()
    whole = np.zeros((STATES + 1 + size, STATES))
    for r in summed.where("part < 0").collect():             # bounded by HEAD_WORDS, CLASSES and SALT
        i = (-1 - r["part"]) // SALT * CHUNK
        x = _matrix_of(bytes(r["sums"]), STATES)
        whole[i:i + len(x)] += x
    own = summed.where("part >= 0")
    columns = [f"s{s}" for s in range(STATES - 1)]

    def own_mass(share):
        def run(batches):
            import pyarrow as pa
            for b in batches:
                for r in b.to_pylist():
                    mass = _own_emissions(r["c"], r["sums"], share, 1.0).sum(axis=0)
                    yield pa.RecordBatch.from_pydict({c: [float(x)] for c, x in zip(columns, mass)})

        total = own.mapInArrow(run, ", ".join(f"{c} double" for c in columns)).agg(*[F.sum(c) for c in columns]).first()
        return np.array([x or 0.0 for x in total])

    out = Model(model.trans, model.emit, own)
    out.trans, out.emit, out.share, out.mass = _estimate(
        whole[:STATES], whole[STATES + 1:], vocabulary, whole[STATES, :-1], own_mass)
    return out


def scores(rows: DataFrame, model: Model, vocabulary: Vocabulary) -> DataFrame:
    """The result rows: log10 likelihood of each document's emission ids, and
    of the words inside their classes."""
    shared = rows.sparkSession.sparkContext.broadcast((model.trans, model.emit, vocabulary.log_class))
    train_tokens, size, head = vocabulary.n, vocabulary.end_id, vocabulary.head

    def run(docs, found):
        import numpy as np
        import pyarrow as pa
        known, base, score = (np.array(docs[k].to_numpy()) for k in ("known", "base", "inside"))
        if docs.num_rows:
            found, to, mine = _places(found, head, size)
            *model, log_class = shared.value
            trans, emit = _with_own(found, mine, *model)
            c = np.concatenate([np.zeros(0, np.int64)] + [_loose(x, np.int64) for x in found["seen"].to_pylist()])
            log_c, rest = np.log10(c + 1), np.flatnonzero(to < size)
            inside = np.zeros(len(c))
            inside[rest] = log_c[rest] - log_class[to[rest] - head]
            for group, values, cuts in _groups(docs):
                rare = np.flatnonzero(values > size)
                q, of = values[rare] - size - 1, np.searchsorted(cuts, rare, side="right")
                add = lambda x: np.bincount(of, weights=x[q], minlength=len(group))
                known[group] += add(c > 0).astype(np.int64)
                base[group] += add(log_c)
                grid, places, _, local = _grid(np.split(_resolved(values, to, size), cuts), emit)
                logs = np.log10(forward(grid, trans, local)[1].astype(np.float64)).ravel()
                score[group] += add(inside) + [logs[p].sum() for p in places]
        return pa.table({"doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": docs["n_tokens"],
                         "n_known": pa.array(known, pa.int64()),
                         "train_tokens": pa.array([train_tokens] * docs.num_rows, pa.int64()),
                         "base_score": pa.array(base, pa.float64()), "score": pa.array(score, pa.float64())})

    docs = rows.where("part = -1").select("block", *(x.split()[0] for x in DOCUMENT.split(", ")))
    return _both(docs, sent(rows, model, "seen"), "block", run, "doc_id long, held_out boolean, n_tokens long, "
                 "n_known long, train_tokens long, base_score double, score double")


def _warm_part(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(n_tokens, ids) of the warm-up documents, own words under one id."""
    size, head = vocabulary.end_id, vocabulary.head

    def run(docs, found):
        import numpy as np
        import pyarrow as pa
        _, to, _ = _places(found, head, size)
        to = np.minimum(to, size + 1)
        ids = [_packed(_resolved(_unpacked(x), to, size))[0].tobytes() for x in docs["ids"].to_pylist()]
        return pa.table({"n_tokens": docs["n_tokens"], "ids": pa.array(ids, pa.binary())})

    docs = rows.where("part = -1 and not held_out").where(F.pmod(F.xxhash64("doc_id"), F.lit(WARM_PART)) == 0)
    return stored(_both(docs.select("block", "n_tokens", "ids"), rows.where("part >= 0").select("block", "at", "own"),
                        "block", run, "n_tokens long, ids binary"), "op2-warm")


def train_hmm(rows: DataFrame, own: DataFrame, vocabulary: Vocabulary) -> Model:
    """Warm-up passes on a part, then full passes over all training rows."""
    trans, emit = start_model(vocabulary)
    if vocabulary.n:
        part = _warm_part(rows, vocabulary)
        if not part.isEmpty():
            for _ in range(WARM_PASSES):
                trans, emit = warm_pass(part, trans, emit, vocabulary)
    model = Model(trans, emit, own)
    for _ in range(PASSES if vocabulary.n else 0):
        model = full_pass(rows, model, vocabulary)
        free_shuffles(rows)                                  # here, as the pass itself still holds its tables
    return model


def lm_scores(docs: DataFrame) -> DataFrame:
    """One row per document: the add-one unigram base and the model's score."""
    vocab = stored(word_counts(docs.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)), "op2-words")
    vocabulary = Vocabulary(vocab)
    encoded = encode(docs, vocabulary)
    found = look_up(encoded, vocab, vocabulary)
    rows = resolve(encoded, found, vocabulary)
    free_shuffles(rows)
    own = found.where("block = -1").select("part", "c", F.lit(None).cast("binary").alias("sums"))
    return scores(rows, train_hmm(rows, own, vocabulary), vocabulary)
