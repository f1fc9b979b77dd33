"""Exact top-k by inner product over a bit-sliced index.

Every component x of a vector becomes the integer floor(64 x).  The index cuts
the vectors into blocks; a block holds, for every attribute and every bit of
its (offset) integers, one bitmap over the block's rows.  A query multiplies
and adds these slices with bitmap arithmetic only: each set bit of a query
weight contributes a shifted slice (its complement where the weight is
negative), and carry-save adders (three bitmaps in, sum and carry out) reduce
each binary place to one bitmap of the scores.  The k best rows are then
selected from the most significant slice downward; rows still equal after the
last slice are the boundary, taken by smaller vec_id.  Scores are exact, so
the k best of all blocks merged are the exact answer.

Every query row meets every block; groups of queries and blocks are spread
over tasks, and each group returns k rows per query.

Defined results: vectors that are null, empty, of another length than most or
hold null or non-finite components take no part, nor do rows with a null
vec_id; vectors of a length other than a query's are not its candidates; a
query's own vec_id is never its candidate; repeated rows are separate
candidates; an empty table gives no row; only ``vec_id`` and ``embedding`` are
read.  Integers and scores must fit 62 bits, otherwise the query fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import on_workers, stored

SCALE = 64
TOP = 20
QUERY_EVERY = 20
BLOCK_ROWS = 32_768       # rows whose slices are added together
QUERY_ROWS = 256          # queries that one task takes against one block

RESULT = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, dims, q): floor(scale * x) per component, usable vectors only."""
    x = F.col("x")
    usable = (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))))
    return (vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull()).where(usable)
            .select("vec_id", F.size("x").alias("dims"),
                    F.transform("x", lambda v: F.floor(v * F.lit(float(scale))).cast("long")).alias("q")))


def _matrix(column, dims: int):
    import numpy as np
    return np.asarray(column.combine_chunks().flatten()).reshape(-1, dims)


def bit_slices(values):
    """(lowest, bits, slices): slices[d, j] is the bitmap of bit j of
    values[:, d] - lowest, padded to whole 64-bit words."""
    import numpy as np
    lowest = int(values.min())
    shifted = (values - lowest).astype(np.uint64)
    bits = max(1, int(shifted.max()).bit_length())
    n, dims = values.shape
    slices = np.zeros((dims, bits, -(-n // 64) * 8), np.uint8)
    for j in range(bits):
        packed = np.packbits(((shifted >> np.uint64(j)) & np.uint64(1)).astype(np.uint8), axis=0, bitorder="little")
        slices[:, j, :packed.shape[0]] = packed.T
    return lowest, bits, slices


def added(query, lowest: int, bits: int, slices):
    """Slices (most significant last) of sum |q_d| * y_d over the rows, with
    y_d = x_d - lowest, or its complement where q_d < 0; and the constant that
    turns that sum into the inner product."""
    import numpy as np
    words = slices.view("<u8")
    top = (1 << bits) - 1
    places: list[list] = []
    base = 0
    for d, q in enumerate(query):
        if not q:
            continue
        base += q * lowest if q > 0 else q * (lowest + top)
        y = words[d] if q > 0 else ~words[d]
        w = abs(q)
        while w:
            shift = (w & -w).bit_length() - 1
            w &= w - 1
            while len(places) < shift + bits:
                places.append([])
            for j in range(bits):
                places[shift + j].append(y[j])
    sums, i = [], 0
    while i < len(places):
        stack = np.array(places[i]) if places[i] else np.zeros((1, words.shape[-1]), np.uint64)
        carries = []
        while len(stack) > 1:
            if len(stack) == 2:
                a, b = stack
                carries.append((a & b)[None])
                stack = (a ^ b)[None]
                continue
            third = len(stack) // 3
            a, b, c = stack[:third], stack[third:2 * third], stack[2 * third:3 * third]
            x = a ^ b
            carries.append((a & b) | (x & c))
            stack = np.concatenate((x ^ c, stack[3 * third:]))
        sums.append(stack[0])
        if carries:
            if i + 1 == len(places):
                places.append([])
            places[i + 1].extend(row for part in carries for row in part)
        i += 1
    return base, sums


def best_rows(sums, valid, k: int):
    """Row numbers of the k largest sums (all, if fewer), smaller rows first
    among equals."""
    import numpy as np
    chosen, equal = np.zeros_like(valid), valid.copy()
    for s in reversed(sums):
        upper = equal & s
        n = int(np.bitwise_count(chosen | upper).sum())
        if n > k:
            equal = upper
        else:
            chosen = chosen | upper
            equal = equal & ~s
            if n == k:
                equal = np.zeros_like(valid)
                break
    rows = lambda bitmap: np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))
    sure = rows(chosen)
    return np.concatenate((sure, rows(equal)[:k - len(sure)]))


def _build(key, rows):
    """One block of the index: ids in order, and the slices of their vectors."""
    import numpy as np
    import pyarrow as pa
    ids = rows["vec_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    lowest, bits, slices = bit_slices(_matrix(rows["q"], key[0].as_py())[order])
    return pa.Table.from_pydict({
        "dims": [key[0].as_py()], "block": [key[1].as_py()], "ids": [ids[order].astype("<i8").tobytes()],
        "lowest": [lowest], "bits": [bits], "slices": [slices.tobytes()]},
        schema=pa.schema([("dims", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()),
                          ("lowest", pa.int64()), ("bits", pa.int32()), ("slices", pa.binary())]))


INDEX = "dims int, block long, ids binary, lowest long, bits int, slices binary"


def bit_sliced_index(vectors: DataFrame) -> DataFrame:
    """The stored index: a row per block of about ``BLOCK_ROWS`` vectors."""
    blocks = -(-on_workers(vectors).count() // BLOCK_ROWS) or 1
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id", "q"), F.lit(blocks)))
    return stored(dealt.groupBy("dims", "block").applyInArrow(_build, INDEX), "op3-index")


def _search_block(block: dict, queries, query_ids, k: int):
    import numpy as np
    ids = np.frombuffer(block["ids"], "<i8")
    lowest, bits, dims = block["lowest"], block["bits"], block["dims"]
    slices = np.frombuffer(block["slices"], np.uint8).reshape(dims, bits, -1)
    largest = max(abs(lowest), abs(lowest + (1 << bits)))
    if max(map(abs, queries.ravel().tolist()), default=0) * largest * dims >= 1 << 62:
        raise OverflowError("scores of these vectors do not fit a long")
    every = np.zeros(slices.shape[-1], np.uint8)
    ones = np.packbits(np.ones(len(ids), np.uint8), bitorder="little")
    every[:len(ones)] = ones
    out = [], [], []
    for q, own in zip(queries.tolist(), query_ids.tolist()):
        base, sums = added(q, lowest, bits, slices)
        valid = every.copy()
        for r in range(np.searchsorted(ids, own), np.searchsorted(ids, own, side="right")):
            valid[r >> 3] &= np.uint8(255 - (1 << (r & 7)))
        rows = best_rows(sums, valid.view("<u8"), k)
        score = np.full(len(rows), base, np.int64)
        for j, s in enumerate(sums):
            score += ((s[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << j
        out[0].append(np.full(len(rows), own))
        out[1].append(ids[rows])
        out[2].append(score)
    return [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): both inputs as from :func:`quantised`."""
    index = bit_sliced_index(stored(vectors, "op3-integers"))
    asked = stored(queries, "op3-queries")
    parts = -(-asked.count() // QUERY_ROWS) or 1
    blocks = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    probes = (asked.withColumn("part", F.pmod(F.xxhash64("vec_id", "q"), F.lit(parts)).cast("int"))
              .join(index.select("dims", F.col("block").alias("in_block")), "dims")
              .withColumnRenamed("in_block", "block"))
    key = ["dims", "block", "part"]

    def search(block, probe):
        import numpy as np
        import pyarrow as pa
        found = [np.zeros(0, np.int64)] * 3
        if block.num_rows and probe.num_rows:
            own = block.to_pylist()[0]
            found = _search_block(own, _matrix(probe["q"], own["dims"]), probe["vec_id"].to_numpy(), k)
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in found],
                                    names=["query_id", "vec_id", "score"])

    near = (blocks.groupBy(*key).cogroup(probes.groupBy(*key))
            .applyInArrow(search, RESULT))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))
