"""Benchmark decontamination with a broadcast set of normalised test n-grams.

Every benchmark item is cut into windows of 13 words.  A window is looked up
under its longest word (its anchor): scanning a document tests each word
against the hash set of anchors, and only where one occurs is the document's
window at that place compared, word by word, with the benchmark's.  The scan
needs no shuffle: a document's hits, their union and the items are computed in
its own row.

The windows travel with the query only up to ``MAX_WINDOWS``.  A larger benchmark
stays in Spark: the hash of the words at every place of a document meets the
hashes of the stored windows in a join, and a document's hits are put together
by its row and compared word by word with the windows found, so that two texts
of one hash are told apart.

Defined results: null text has no words (zero counts, not contaminated); null
or blank items have no window, items with a null id still mark words but are
not counted; repeated rows give repeated result rows, repeated items count
once by id; without benchmark rows nothing is hit; an empty ``documents`` table
gives no row; very long texts are scanned whole; of a window's equally long words
the first is the anchor, which changes no result; only ``doc_id``, ``text`` and
``item_id``, ``text`` are read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored

WINDOW_WORDS = 13
MAX_WINDOWS = 20_000
# Bytes that part words (ASCII other than digits and letters), after lower-casing.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
HIT = "array<struct<start:int,words:int,items:array<string>>>"


def word_list(text: Column) -> Column:
    """Words of the A-Z lower-cased text; none for null."""
    plain = F.octet_length(text) == F.length(text)        # ASCII only: lower() changes nothing but A-Z
    low = F.when(plain, F.lower(text)).otherwise(ascii_lower(text))
    return F.filter(F.split(F.coalesce(low, F.lit("")), SEPARATORS), lambda w: w != "")


def windows(items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """(anchor, at, words, window, items): each distinct window once, with the
    place of its anchor and the ids of the items that hold it."""
    n = F.size("w")
    starts = F.sequence(F.lit(0), F.greatest(n - size, F.lit(0)))
    cut = (items.select(F.col("item_id").cast("string").alias("item"), word_list(F.col("text")).alias("w"))
           .where(n > 0).select("item", "w", F.explode(starts).alias("s"))
           .select("item", F.slice("w", F.col("s") + 1, F.lit(size)).alias("w")))
    longest = F.array_max(F.transform("w", lambda x: F.length(x)))
    anchor = F.filter("w", lambda x: F.length(x) == F.col("longest"))[0]
    return (cut.withColumn("longest", longest).withColumn("anchor", anchor)
            .select("item", "anchor", F.array_join("w", " ").alias("window"), F.size("w").alias("words"),
                    (F.array_position("w", F.col("anchor")) - 1).cast("int").alias("at"))
            .groupBy("anchor", "at", "words", "window")
            .agg(F.sort_array(F.collect_set("item")).alias("items")))


def window_hits(words: Column, block: list) -> Column:
    """All occurrences of the block's windows in a word list."""
    if not block:
        return F.array().cast(HIT)
    by_anchor: dict[str, list] = {}
    for r in block:
        by_anchor.setdefault(r["anchor"], []).append(
            {"at": r["at"], "words": r["words"], "window": r["window"], "items": r["items"]})
    kind = "map<string,array<struct<at:int,words:int,window:string,items:array<string>>>>"
    table = F.from_json(F.lit(json.dumps(by_anchor, ensure_ascii=False)), kind)
    anchors = list(by_anchor)

    def scan(ws: Column) -> Column:
        def same(i: Column, w: Column) -> Column:
            here = F.array_join(F.slice(ws, F.greatest(i - w["at"], F.lit(0)) + 1, w["words"]), " ")
            return (i >= w["at"]) & (here == w["window"])

        def found(i: Column) -> Column:
            hits = F.filter(F.element_at(table, F.get(ws, i)), lambda w: same(i, w))
            return F.transform(hits, lambda w: F.struct((i - w["at"]).alias("start"), w["words"].alias("words"),
                                                        w["items"].alias("items")))
        places = F.filter(F.sequence(F.lit(0), F.size(ws) - 1), lambda i: F.get(ws, i).isin(anchors))
        return F.flatten(F.transform(places, found))

    # the word list is bound to a variable: it is made once a row
    return F.when(F.size(words) > 0, F.transform(F.array(words), scan)[0]).otherwise(F.array().cast(HIT))


def joined_hits(rows: DataFrame, grams: DataFrame) -> DataFrame:
    """(row, hits) of the rows (row, w) with a place whose words have the hash
    of a window; ``hits`` holds these places with the windows' words, yet to be
    compared.  A place sends its hash alone, and no window leaves Spark."""
    lengths = sorted(r["words"] for r in grams.select("words").distinct().collect())     # at most WINDOW_WORDS

    def places(n: int) -> Column:
        starts = F.when(F.size("w") >= n, F.sequence(F.lit(0), F.size("w") - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(
            i.alias("start"), F.lit(n).alias("words"),
            F.xxhash64(F.array_join(F.slice("w", i + 1, n), " ")).alias("hash")))

    probes = rows.select("row", F.explode(F.concat(*[places(n) for n in lengths])).alias("p")).select("row", "p.*")
    known = grams.select(F.xxhash64("window").alias("hash"), "words", "window", "items")
    return (probes.join(known, ["hash", "words"]).groupBy("row")
            .agg(F.collect_list(F.struct("start", "words", "items", "window")).alias("hits")))


def _same_words(words: Column, hits: Column) -> Column:
    """The hits whose window is what the document has there."""
    real = F.filter(hits, lambda h: F.array_join(F.slice(words, h["start"] + 1, h["words"]), " ") == h["window"])
    return F.transform(real, lambda h: F.struct(h["start"].alias("start"), h["words"].alias("words"),
                                                h["items"].alias("items")))


def _covered(hits: Column) -> Column:
    """How many words lie inside at least one hit."""
    spans = F.array_sort(F.transform(hits, lambda h: F.struct(h["start"].alias("s"),
                                                             (h["start"] + h["words"]).alias("e"))))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(spans, zero, lambda acc, x: F.struct(
        F.greatest(acc["end"], x["e"]).alias("end"),
        (acc["n"] + F.greatest(x["e"] - F.greatest(x["s"], acc["end"]), F.lit(0))).alias("n")),
        lambda acc: acc["n"])


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS,
                  max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``docs`` as struct column ``doc`` with n_words, n_hit, n_items, items
    (sorted ids) and contaminated."""
    rows = docs.select(F.struct("*").alias("doc"))
    grams = stored(windows(items, size), "op9-windows")
    n = grams.count()
    if n <= max_windows:
        hit = (rows.withColumn("w", word_list(F.col("doc.text")))
               .select("doc", F.size("w").cast("long").alias("n_words"),
                       window_hits(F.col("w"), grams.collect()).alias("hits")))      # at most max_windows
    else:
        rows = stored(rows.select("doc", F.monotonically_increasing_id().alias("row"),
                                  word_list(F.col("doc.text")).alias("w")), "op9-words")
        hit = (rows.join(joined_hits(rows, grams), "row", "left")
               .select("doc", F.size("w").cast("long").alias("n_words"),
                       F.coalesce(_same_words(F.col("w"), F.col("hits")), F.array().cast(HIT)).alias("hits")))
    found = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))))
    return (hit.select("doc", "n_words", _covered(F.col("hits")).alias("n_hit"), found.alias("items"))
            .select("doc", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
                    ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated")))


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, unchanged."""
    return contamination(docs, items).where(~F.col("contaminated")).select("doc.*")
