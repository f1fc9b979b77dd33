"""SimHash near-dedup by multi-index hashing.

Fingerprints: 3-word shingles of the A-Z lower-cased text, XXH64 (seed 42),
bit-wise majority.  Equal fingerprints collapse before any search, so a group
of copies costs one row.  Two fingerprints within 3 bits differ by at most one
bit in one of their two 32-bit halves (pigeonhole), so the index holds both
halves of each fingerprint, and a search looks up the Hamming ball of radius
one around each half (the half itself and, as a pair needs to be met from one
side only, the neighbours with one more bit set); what the table returns is
verified on all 64 bits.  Connected documents get their smallest doc_id by
label propagation with pointer jumping over the verified links.

Defined results: null or blank text has fingerprint zero, linked like any
other; a text of fewer words than a shingle is one shingle; repeated rows give
repeated result rows; a null doc_id is returned with the component of its
text; an empty table gives no row; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import on_workers, stored

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
HALF = 32
CHUNK = 65_536            # shingles hashed at a time (bounds memory on very long texts)


def fingerprint(text: bytes, words_per: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of one text, as a signed long."""
    import numpy as np
    from xxhash import xxh64_intdigest as xxh64
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - words_per + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    ends = (ends[min(words_per, len(words)) - 1:] - 1).tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, n, CHUNK):
        hashes = [xxh64(line[a:b], SEED) for a, b in zip(starts[i:i + CHUNK], ends[i:i + CHUNK])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words_per: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) for every row."""
    def compute(batches):
        import pyarrow as pa
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            fps = [fingerprint(t.as_py() or b"", words_per) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return on_workers(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        compute, "doc_id long, fp long")


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _halves(fp: Column, ball: bool) -> Column:
    """Index keys of a fingerprint: its two halves, told apart by bit 32; with
    ``ball`` also the halves that have one more bit set."""
    def keys(side: int, half: Column) -> list[Column]:
        tag = F.lit(side << HALF).cast("long")
        exact = F.array(half.bitwiseOR(tag))
        if not ball:
            return [exact]
        bits = F.array(*[F.lit(1 << b).cast("long") for b in range(HALF)])
        free = F.filter(bits, lambda b: half.bitwiseAND(b) == 0)
        return [exact, F.transform(free, lambda b: half.bitwiseOR(b).bitwiseOR(tag))]

    low = fp.bitwiseAND(F.lit((1 << HALF) - 1))
    return F.concat(*keys(0, low), *keys(1, F.shiftrightunsigned(fp, HALF)))


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """All pairs (a, b) of distinct fingerprints within ``max_bits`` bits, each
    at least once."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves with a ball of one bit find distances up to 3")
    probes = fps.select(F.col("fp").alias("a"), F.explode(_halves(F.col("fp"), True)).alias("key"))
    index = fps.select(F.col("fp").alias("b"), F.explode(_halves(F.col("fp"), False)).alias("key"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).between(1, max_bits)
    return probes.join(index, "key").where(near).select("a", "b")


def component_labels(edges: DataFrame) -> DataFrame:
    """(node, label): label is the smallest node reachable.  Every round takes
    the smallest label next to a node and then the label of that label; each
    round's labels are written to the shared folder."""
    both = stored(edges.select(F.col("a").alias("node"), F.col("b").alias("to"))
                  .union(edges.select("b", "a")).distinct(), "op7-links")
    labels = stored(both.groupBy("node").agg(F.min("to").alias("to"))
                    .select("node", F.least("node", "to").alias("label")), "op7-labels")
    while True:
        offered = (both.join(labels.withColumnRenamed("node", "to"), "to")
                   .groupBy("node").agg(F.min("label").alias("offer")))
        lower = labels.join(offered, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "offer").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        step = stored(lower.join(jump, "label").select(
            "node", "old", F.least("label", "next").alias("label")), "op7-labels")
        labels = step.select("node", "label")
        if step.where("old <> label").isEmpty():
            return labels


def simhash_components(docs: DataFrame, words_per: int = SHINGLE_WORDS,
                       max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    prints = stored(fingerprints(docs, words_per), "op7-fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    labels = component_labels(links(distinct.select("fp"), max_bits))
    member = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label"))
    smallest = member.groupBy("label").agg(F.min("first").alias("component_id"))
    of_print = member.join(smallest, "label").select("fp", "component_id")
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")


def one_of_each_group(docs: DataFrame, words_per: int = SHINGLE_WORDS,
                      max_bits: int = MAX_BITS) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group (of
    repeated rows one, rows without an id only where the group has no other),
    unchanged."""
    @F.pandas_udf("long")
    def compute(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in column:
            yield pd.Series([fingerprint((t or "").encode(), words_per) for t in batch], dtype="int64")

    rows = stored(on_workers(docs).select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row"),
                              compute(F.col("text").cast("string")).alias("fp")), "op7-rows")
    prints = rows.select("row", F.col("doc.doc_id").cast("long").alias("id"), "fp")
    labels = component_labels(links(prints.select("fp").distinct(), max_bits))
    grouped = prints.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    kept = (grouped.groupBy(F.coalesce("label", "fp").alias("label"))
            .agg(F.min_by("row", F.coalesce("id", F.lit((1 << 63) - 1))).alias("row")).select("row"))
    return rows.join(kept, "row", "left_semi").select("doc.*")
