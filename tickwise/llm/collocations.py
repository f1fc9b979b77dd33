"""Phrase collocations by direct-address tiling.

Texts become chunks of word numbers, one language each.  Words of ``MIN_COUNT``
and more occurrences in their language are numbered (the frequent first), and
neighbouring pairs of them are counted: a chunk's pairs fall into tiles of
``TILE`` x ``TILE`` numbers, a tile with many pairs is counted in a dense array
addressed by the pair itself (``numpy.bincount``), the pairs of all other tiles
by sorting their coordinates.  Spark brings the chunks' counts together in
slices by hash, about ``SLICE_KEYS`` counts each: a slice's task adds them up,
numbers the frequent words or pairs and answers each chunk with the numbers of
those that it has.  Both ways hold sorted numbers in few bytes, so they take
less room than the text, however many words and pairs are frequent.

The frequent pairs' numbers take the words' place: a chunk then holds, at each
place, the number of the phrase that begins there, and two phrases of k words
that overlap in all but a word make one of k + 1.  A phrase has no more
occurrences than either of these two, so no frequent phrase is missed, whatever
the threshold left out; places without a frequent neighbour are left out too.

Counts, the shares of the cuts and the drop rule are joins of the phrase
tables; scores are exact integer quotients of decimals.

Defined results: null text has no words; null lang is ``und``; very long texts
are cut into slices at blanks, with no phrase lost at a cut; repeated rows
count again; ties of the score go to the smaller cut, ties of the report to the
larger count and then to the phrase in byte order; an empty table, or one with
no frequent phrase, gives no row; only ``lang`` and ``text`` are read, so other
columns may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ASCII_UPPER, free_shuffles, on_workers, stored

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
CHUNK_TOKENS = 1 << 18    # words of a chunk, about; no effect on results
ROW_TOKENS = 1 << 15      # words of a row of a chunk, about (a piece is never cut); likewise
COUNT_PAIRS = 1 << 18     # pairs counted together, about; likewise
SLICE_KEYS = 1 << 21      # counts of chunks added up by a task, about; likewise
SLICE = 1 << 22           # bytes of text split at a time
TILE = 1 << 10
DENSE = TILE * TILE // 8  # pairs from which a tile is counted in a dense array

BREAKS = b".,;:!?\x0A\x0B\x0C\x0D"
_TABLE = bytes.maketrans(ASCII_UPPER.encode() + BREAKS + b"\t", ASCII_LOWER.encode() + b"\n" * len(BREAKS) + b" ")

CHUNKS = "chunk long, lang string, first long, words array<string>, counts binary, n long, codes binary"


def packed(symbols) -> bytes:
    """Symbols from -1 on, in as few bytes each as the largest needs: the low
    bytes of all, then the next ones (the high ones are alike and compress)."""
    import numpy as np
    size = 1
    while int(symbols.max(initial=-1)) + 1 >= 1 << 8 * size:
        size *= 2
    return bytes([size]) + (symbols + 1).astype(f"<u{size}").view(np.uint8).reshape(-1, size).T.tobytes()


def unpacked(row: bytes):
    import numpy as np
    size = row[0]
    planes = np.frombuffer(row, np.uint8, offset=1).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{size}").ravel().astype(np.int64) - 1


def steps(numbers) -> bytes:
    """Ascending numbers by what each adds to the one before."""
    import numpy as np
    return packed(np.diff(numbers, prepend=0))


def sums(row: bytes):
    return unpacked(row).cumsum()


class _Numbers(dict):
    """A chunk's words, numbered as they come."""

    def __init__(self):
        super().__init__({b"": -2, b"\n": -1})

    def __missing__(self, word):
        n = self[word] = len(self) - 2
        return n


class _Chunk:
    def __init__(self):
        self.numbers, self.codes, self.size = _Numbers(), [], 0

    def add(self, text: bytes) -> None:
        import numpy as np
        text = text.translate(_TABLE)
        at = 0
        while at < len(text):
            end = at + SLICE
            if end < len(text):        # up to the next blank or break
                blank, line = text.find(b" ", end), text.find(b"\n", end)
                ends = [e for e in (blank, line) if e >= 0]
                end = min(ends) if ends else len(text)
            words = text[at:end].replace(b"\n", b" \n ").split(b" ")
            codes = np.array(list(map(self.numbers.__getitem__, words)), np.int32)
            codes = codes[codes > -2]
            self.codes.append(codes)
            self.size += len(codes)
            at = end
        self.codes.append(np.array([-1], np.int32))

    def result(self) -> tuple:
        """The words, how often each occurs, and the text as places in them,
        cut at ends of pieces into rows."""
        import numpy as np
        codes = np.concatenate(self.codes)
        counts = np.bincount(codes[codes >= 0], minlength=len(self.numbers) - 2)
        rows, ends, at = [], np.flatnonzero(codes < 0), 0
        while at < len(codes):
            k = min(np.searchsorted(ends, at + ROW_TOKENS), len(ends) - 1)     # the last code is an end
            rows.append(packed(codes[at:ends[k] + 1]))
            at = int(ends[k]) + 1
        return [w.decode("utf-8", "replace") for w in list(self.numbers)[2:]], counts, rows


def word_chunks(docs: DataFrame) -> DataFrame:
    """Texts in chunks of one language and about ``CHUNK_TOKENS`` words.  Rows
    (chunk, lang, first, words, counts, n) for a chunk's distinct words, numbered
    from ``first``, their counts and these counts' sum, and rows (chunk, lang,
    codes): the numbers in the order of the text, -1 between pieces
    (:func:`packed`)."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        schema = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("first", pa.int64()),
                            ("words", pa.list_(pa.string())), ("counts", pa.binary()), ("n", pa.int64()),
                            ("codes", pa.binary())])
        next_id = TaskContext.get().partitionId() << 32
        chunks: dict[str, _Chunk] = {}

        def out(lang):
            nonlocal next_id
            words, counts, rows = chunks.pop(lang).result()
            for codes in rows:
                yield pa.RecordBatch.from_pylist([{"chunk": next_id, "lang": lang, "codes": codes}], schema)
            for i in range(0, len(words), ROW_TOKENS):
                n = counts[i:i + ROW_TOKENS]
                yield pa.RecordBatch.from_pylist([{"chunk": next_id, "lang": lang, "first": i, "counts": packed(n),
                                                   "words": words[i:i + ROW_TOKENS], "n": int(n.sum())}], schema)
            next_id += 1

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                chunk = chunks.setdefault(lang, _Chunk())
                chunk.add(text.as_py() or b"")
                if chunk.size >= CHUNK_TOKENS:
                    yield from out(lang)
                elif sum(c.size for c in chunks.values()) >= 4 * CHUNK_TOKENS:
                    for each in list(chunks):
                        yield from out(each)
        for lang in list(chunks):
            yield from out(lang)

    rows = on_workers(docs).select(F.coalesce(F.col("lang").cast("string"), F.lit("und")),
                                   F.col("text").cast("string").cast("binary"))
    return rows.mapInArrow(run, CHUNKS)


def asked_words(chunks: DataFrame, slices: int) -> DataFrame:
    """(slice, chunk, lang, local, words, counts): the chunks' words by hash."""
    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, lang, first, words, counts = (c[i] for c in batch.columns)
                words, counts = words.values, unpacked(counts.as_py())
                of = np.array([zlib.crc32(w) for w in words.cast(pa.binary()).to_pylist()], np.int64) % slices
                order = np.argsort(of, kind="stable")
                found, at = np.unique(of[order], return_index=True)
                parts = np.split(order, at[1:])
                yield pa.RecordBatch.from_arrays([
                    pa.array(found, pa.int32()), pa.array([chunk.as_py()] * len(found), pa.int64()),
                    pa.array([lang.as_py()] * len(found), pa.string()),
                    pa.array([steps(first.as_py() + p) for p in parts], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.append(at, len(order)), pa.int32()), words.take(pa.array(order))),
                    pa.array([packed(counts[p]) for p in parts], pa.binary())],
                    names=["slice", "chunk", "lang", "local", "words", "counts"])

    return (chunks.where(F.col("words").isNotNull()).select("chunk", "lang", "first", "words", "counts")
            .mapInArrow(run, "slice int, chunk long, lang string, local binary, words array<string>, counts binary"))


def _numbered(keys, n, min_count: int, of: int, slices: int):
    """The frequent ones of a slice's keys, the most frequent first: their place
    among ``keys`` and their counts; and every key's number, or -1."""
    import numpy as np
    distinct, at, back = np.unique(keys, return_index=True, return_inverse=True)
    f = np.zeros(len(distinct), np.int64)
    np.add.at(f, back, n)
    often = np.flatnonzero(f >= min_count)
    often = often[np.argsort(-f[often], kind="stable")]
    ids = np.full(len(distinct), -1, np.int64)
    ids[often] = np.arange(len(often)) * slices + of         # small numbers, none in two slices
    return at[often], f[often], ids[back]


def numbered_words(asked: DataFrame, slices: int, min_count: int) -> DataFrame:
    """Rows (lang, phrase, f, id) for the frequent words and answers (chunk, a,
    ids): the local numbers (:func:`steps`) of the chunk's frequent words, and
    their ids."""
    def run(key, rows):
        import numpy as np
        import pyarrow as pa
        of = key[0].as_py()
        words = pa.concat_arrays([x.flatten() for x in rows["words"].chunks])
        counts = [unpacked(x) for x in rows["counts"].to_pylist()]
        sizes = [len(x) for x in counts]
        langs = pa.concat_arrays(rows["lang"].chunks).dictionary_encode()
        coded = words.dictionary_encode()
        lang = np.repeat(langs.indices.to_numpy(), sizes).astype(np.int64)
        first, f, ids = _numbered(lang * len(coded.dictionary) + coded.indices.to_numpy(), np.concatenate(counts),
                                  min_count, of, slices)
        new = np.split(ids, np.cumsum(sizes)[:-1])
        local = [sums(x)[i >= 0] for x, i in zip(rows["local"].to_pylist(), new)]
        out = {"chunk": rows["chunk"].to_pylist(), "a": [steps(x) for x in local], "ids": [packed(i[i >= 0]) for i in new]}
        answers = pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), (pa.int64(), pa.binary(), pa.binary()))})
        answers = answers.filter(pa.array([len(x) > 0 for x in local], pa.bool_()))
        found = pa.table({"lang": langs.dictionary.take(pa.array(lang[first])), "phrase": words.take(pa.array(first)),
                          "f": pa.array(f), "id": pa.array(ids[first])})
        both = pa.concat_tables([answers, found], promote_options="default")
        return both.select(["chunk", "a", "ids", "lang", "phrase", "f", "id"])

    return asked.groupBy("slice").applyInArrow(
        run, "chunk long, a binary, ids binary, lang string, phrase string, f long, id long")


def tile_counts(a, b):
    """Distinct pairs of two arrays of numbers, and how often each occurs."""
    import numpy as np
    ids, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    side = -(-len(ids) // TILE)
    tile = x // TILE * side + y // TILE
    dense = np.bincount(tile, minlength=side * side) >= DENSE
    found = []
    for t in np.flatnonzero(dense).tolist():
        inside = tile == t
        cells = np.bincount(x[inside] % TILE * TILE + y[inside] % TILE, minlength=TILE * TILE)
        cell = np.flatnonzero(cells)
        found.append((t // side * TILE + cell // TILE, t % side * TILE + cell % TILE, cells[cell]))
    rest = ~dense[tile]
    code, n = np.unique(x[rest] * len(ids) + y[rest], return_counts=True)
    found.append((code // max(len(ids), 1), code % max(len(ids), 1), n))
    x, y, n = (np.concatenate(c) for c in zip(*found))
    return ids[x], ids[y], n


def _pairs_at(symbols: bytes):
    """Neighbouring symbols: both numbers, and the places of the first."""
    import numpy as np
    s = unpacked(symbols)
    at = np.flatnonzero((s[:-1] >= 0) & (s[1:] >= 0))
    return s[at], s[at + 1], at, len(s)


def asked_pairs(chunks: DataFrame, slices: int) -> DataFrame:
    """(slice, chunk, a, b, counts): how often symbol b follows a in a chunk, by
    hash of the two; ``a`` ascends (:func:`steps`)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def out(chunk, held):
            a, b, n = tile_counts(*(np.concatenate(c) for c in zip(*held)))
            of = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
            of = (of >> np.uint64(32)).astype(np.int64) % slices
            order = np.lexsort((b, a, of))
            found, at = np.unique(of[order], return_index=True)
            parts = np.split(order, at[1:])
            return pa.RecordBatch.from_arrays([
                pa.array(found, pa.int32()), pa.array([chunk] * len(found), pa.int64()),
                pa.array([steps(a[p]) for p in parts][:len(found)], pa.binary()),
                pa.array([packed(b[p]) for p in parts][:len(found)], pa.binary()),
                pa.array([packed(n[p]) for p in parts][:len(found)], pa.binary())],
                names=["slice", "chunk", "a", "b", "counts"])

        held, size, last = [], 0, None
        for batch in batches:
            for chunk, symbols in zip(batch.column(0).to_pylist(), batch.column(1)):
                if held and (size >= COUNT_PAIRS or chunk != last):
                    yield out(last, held)
                    held, size = [], 0
                a, b = _pairs_at(symbols.as_py())[:2]
                held.append((a, b))
                size, last = size + len(a), chunk
        if held:
            yield out(last, held)

    return chunks.select("chunk", "symbols").mapInArrow(run, "slice int, chunk long, a binary, b binary, counts binary")


def numbered_pairs(asked: DataFrame, slices: int, min_count: int) -> DataFrame:
    """Rows (left, right, f, id) for the frequent pairs and answers (chunk, a, b,
    ids): the chunk's frequent pairs (a: :func:`steps`) and their ids."""
    def run(key, rows):
        import numpy as np
        import pyarrow as pa
        of = key[0].as_py()
        a, b, counts = ([f(x) for x in rows[c].to_pylist()] for c, f in (("a", sums), ("b", unpacked), ("counts", unpacked)))
        left, right = np.concatenate(a), np.concatenate(b)
        keys = left * (int(right.max(initial=0)) + 1) + right    # below 2**63 for ids below 2**31, of 2e11 words
        first, f, ids = _numbered(keys, np.concatenate(counts), min_count, of, slices)
        new = np.split(ids, np.cumsum([len(x) for x in a])[:-1])
        hits = [i >= 0 for i in new]
        answers = pa.table({
            "chunk": rows["chunk"], "a": pa.array([steps(x[h]) for x, h in zip(a, hits)], pa.binary()),
            "b": pa.array([packed(x[h]) for x, h in zip(b, hits)], pa.binary()),
            "ids": pa.array([packed(x[h]) for x, h in zip(new, hits)], pa.binary())})
        answers = answers.filter(pa.array([bool(h.any()) for h in hits], pa.bool_()))
        found = pa.table({"left": pa.array(left[first]), "right": pa.array(right[first]), "f": pa.array(f),
                          "id": pa.array(ids[first])})
        both = pa.concat_tables([answers, found], promote_options="default")
        return both.select(["chunk", "a", "b", "ids", "left", "right", "f", "id"])

    return asked.groupBy("slice").applyInArrow(
        run, "chunk long, a binary, b binary, ids binary, left long, right long, f long, id long")


def _linked(symbols):
    """Symbols with a neighbour, a -1 after each run of them: the others make no pair."""
    import numpy as np
    live = symbols >= 0
    pair = live[:-1] & live[1:]
    keep = np.zeros(len(symbols), bool)
    keep[:-1] |= pair
    keep[1:] |= pair
    end = np.zeros(len(symbols), bool)
    end[1:] = keep[:-1] & ~keep[1:]
    return symbols[keep | end]


def _renumbered(chunks: DataFrame, answers: DataFrame, apply) -> DataFrame:
    """Chunks with new symbols: ``apply`` gets the old ones and what the chunk's
    rows of ``answers`` hold as arrays."""
    def run(key, old, new):
        import numpy as np
        import pyarrow as pa
        none = [np.zeros(0, np.int64)]
        columns = [np.concatenate(none + [f(x) for x in new.column(c).to_pylist() if x is not None])
                   for c, f in (("a", sums), ("b", unpacked), ("ids", unpacked))]
        out = [_linked(apply(v.as_py(), *columns)) for v in old.column("symbols")]
        out = [packed(x) for x in out if len(x)]
        return pa.table({"chunk": pa.array([key[0].as_py()] * len(out), pa.int64()), "symbols": pa.array(out, pa.binary())})

    return (chunks.select("chunk", "symbols").groupBy("chunk")
            .cogroup(answers.select("chunk", "a", "b", "ids").toDF("of", "a", "b", "ids").groupBy("of"))
            .applyInArrow(run, "chunk long, symbols binary"))


def _of_words(codes: bytes, local, _, ids):
    import numpy as np
    codes = unpacked(codes)
    size = max(codes.max(initial=-1), local.max(initial=-1)) + 2
    number = np.full(size, -1, np.int64)         # the last one is for -1
    number[local] = ids
    return number[codes]


def _of_pairs(symbols: bytes, a, b, ids):
    import numpy as np
    x, y, at, size = _pairs_at(symbols)
    known = np.unique(np.concatenate((a, b)))     # a pair may come twice, with the same id
    out = np.full(size, -1, np.int64)
    if not len(known):
        return out
    order = np.lexsort((b, a))
    keys = (np.searchsorted(known, a) * len(known) + np.searchsorted(known, b))[order]
    i, j = (np.minimum(np.searchsorted(known, v), len(known) - 1) for v in (x, y))
    pair = i * len(known) + j
    k = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
    hit = (known[i] == x) & (known[j] == y) & (keys[k] == pair)
    out[at[hit]] = ids[order][k[hit]]
    return out


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT,
                     max_words: int = MAX_WORDS) -> tuple[list[DataFrame], DataFrame]:
    """Tables of the phrases of 1, 2, ... words with ``min_count`` occurrences
    and more: (id, lang, phrase, last, f, a, b), a and b being the ids of the
    phrase without its last and without its first word; and (lang, n)."""
    chunks = stored(word_chunks(docs), "op12-words")
    totals = stored(chunks.where(F.col("words").isNotNull()).groupBy("lang").agg(F.sum("n").alias("n")), "op12-totals")
    n = totals.agg(F.sum("n")).first()[0] or 0
    slices = -(-n // SLICE_KEYS) or 1
    none = F.lit(None).cast("long")
    numbered = stored(numbered_words(asked_words(chunks, slices), slices, min_count), "op12-numbers")
    tables = [stored(numbered.where(F.col("chunk").isNull()).select(
        "id", "lang", "phrase", F.col("phrase").alias("last"), "f", none.alias("a"), none.alias("b")), "op12-phrases")]
    free_shuffles(docs)                    # here and below: what follows starts from stored tables
    answers = numbered.where(F.col("chunk").isNotNull()).withColumn("b", F.lit(None).cast("binary"))
    texts = chunks.where(F.col("codes").isNotNull()).select("chunk", F.col("codes").alias("symbols"))
    level = stored(_renumbered(texts, answers, _of_words), "op12-symbols")
    while True:
        free_shuffles(docs)
        numbered = stored(numbered_pairs(asked_pairs(level, slices), slices, min_count), "op12-numbers")
        free_shuffles(docs)
        found = numbered.where(F.col("chunk").isNull()).select("id", "f", F.col("left").alias("a"), F.col("right").alias("b"))
        first = tables[-1].select(F.col("id").alias("a"), "lang", F.col("phrase").alias("head"))
        then = tables[-1].select(F.col("id").alias("b"), "last")
        found = stored(found.join(first, "a").join(then, "b").select(
            "id", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "f", "a", "b"), "op12-phrases")
        tables.append(found)
        if len(tables) == max_words or found.isEmpty():
            return tables, totals
        level = stored(_renumbered(level, numbered.where(F.col("chunk").isNotNull()), _of_pairs), "op12-symbols")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases."""
    tables, totals = frequent_phrases(docs, min_count, max_words)
    kept = []
    for size, (table, longer) in enumerate(zip(tables[1:], [*tables[2:], None]), 2):
        if longer is not None:      # a longer phrase still can only add to a phrase between them
            inside = longer.select(F.col("a").alias("id"), "f").union(longer.select("b", "f"))
            table = table.join(inside, ["id", "f"], "left_anti")
        kept.append(table.select("lang", "phrase", F.col("f").alias("a"), F.lit(size).alias("size")))
    shares = reduce(DataFrame.union, [t.select("lang", "phrase", "f") for t in tables])
    cut = reduce(DataFrame.union, kept).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    head, rest = F.expr("substring_index(phrase, ' ', k)"), F.expr("substring_index(phrase, ' ', k - size)")
    scored = (cut.select("*", head.alias("head"), rest.alias("rest"))
              .join(shares.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
              .join(shares.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
              .join(totals, "lang")
              .withColumn("score", F.expr("(1000BD * cast(a as decimal(17, 0)) * cast(n as decimal(17, 0))) div "
                                          "(cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")))
    lowest = F.col("score") * F.lit(8) + F.col("k")         # fewer than 8 cuts
    best = scored.groupBy("lang", "phrase", "a", "n").agg(
        F.min("score").alias("score"), F.min_by("l", lowest).alias("l"), F.min_by("r", lowest).alias("r"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
