"""Cross-site boilerplate lines by distinct-site spread.

Every line's hash gets a HyperLogLog sketch of the sites (``source``) it was
seen on; sketches are built per task and merged by the aggregation, so a line
seen everywhere costs one small row per task.  Where the estimate is within
its error of the threshold, the line's sites are counted exactly; clear cases
need no further count.  A line spread over at least ``min_sites`` sites is
boilerplate: it stays in the document with the smallest id that has it, and
goes from all others.  The pipeline gives long lines a smaller spread.

Lines are parted by line feeds and compared without surrounding spaces; blank
lines are never boilerplate.  Defined results: null text has no line and stays
null; a null source is no site; rows without an id never hold the kept copy
unless no other row does; repeated rows are treated alike; documents without
boilerplate are returned unchanged; only ``doc_id``, ``text`` and ``source``
are read, other columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

MIN_SITES = 10
LONG_WORDS = 50           # lines of more words are passages:
LONG_SITES = 3            # the pipeline takes them out from so many sites on (op6 has one threshold, as its SQL)
LG_K = 10                 # 1024 registers: relative standard error about 1.04 / 32
ERRORS = 4                # standard errors around the threshold that count as near


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES, long_sites: int | None = None) -> DataFrame:
    """(line, keeper): hashes of lines on at least ``min_sites`` sites (long
    ones: ``long_sites``, if given), and the smallest id of a document that
    has the line."""
    counted = lines.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"),
        F.min("id").alias("keeper"), F.max("long").alias("long"))
    least = F.when(F.col("long"), min_sites if long_sites is None else long_sites).otherwise(min_sites)
    margin = 1 + ERRORS * 1.04 / (1 << (LG_K // 2)) * F.col("least")
    seen = stored(counted.withColumn("least", least).where(F.col("sites") >= F.col("least") - margin), "op6-spread")
    near = seen.where(F.col("sites") < F.col("least") + margin).select("line", "keeper", "least")
    exact = (lines.where(F.col("site").isNotNull()).select("line", "site").distinct()
             .join(near, "line").groupBy("line").agg(F.count("*").alias("n"), F.min("keeper").alias("keeper"),
                                                     F.min("least").alias("least"))
             .where(F.col("n") >= F.col("least")).select("line", "keeper"))
    return seen.where(F.col("sites") >= F.col("least") + margin).select("line", "keeper").unionByName(exact)


def line_dedup(docs: DataFrame, min_sites: int = MIN_SITES, long_sites: int | None = None) -> DataFrame:
    """``docs`` as struct column ``doc`` with n_lines, n_removed and the text
    that is left (null where the text is null)."""
    key = [F.col("doc_id").alias("id"), F.xxhash64("text").alias("print")]
    cut = docs.select(*key, F.col("source").alias("site"), F.posexplode(_lines(F.col("text"))).alias("at", "raw"))
    lines = stored(cut.where(F.trim("raw") != "").select(
        "id", "print", "site", "at", F.xxhash64(F.trim("raw")).alias("line"),
        (F.size(F.split(F.trim("raw"), " +")) > LONG_WORDS).alias("long")), "op6-lines")
    found = spread_lines(lines, min_sites, long_sites)
    gone = (lines.select("id", "print", "at", "line").join(found, "line")
            .where(~F.col("id").eqNullSafe(F.col("keeper")))
            .groupBy("id", "print").agg(F.collect_set("at").alias("gone")))
    rows = docs.select(F.struct("*").alias("doc"), *key)
    joined = rows.join(gone.withColumnsRenamed({"id": "g_id", "print": "g_print"}).hint("shuffle_hash"),
                       F.col("id").eqNullSafe(F.col("g_id")) & (F.col("print") == F.col("g_print")), "left")
    text = F.col("doc.text")

    def rest(ls: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("gone"))
        return F.array_join(F.transform(kept, lambda i: F.get(ls, i)), "\n")

    return joined.select(
        "doc", F.when(text.isNull(), 0).otherwise(F.size(_lines(text))).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), text).otherwise(F.transform(F.array(_lines(text)), rest)[0]).alias("left"))


def without_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES,
                        long_sites: int | None = LONG_SITES) -> DataFrame:
    """``docs`` with the boilerplate lines gone from their texts; a document
    that held nothing else goes.  A line of over LONG_WORDS words does not
    recur by chance, so fewer sites are enough."""
    blank = (F.col("n_removed") > 0) & (F.trim("left") == "")
    return line_dedup(docs, min_sites, long_sites).where(~blank).select(
        F.col("doc").withField("text", F.col("left")).alias("doc")).select("doc.*")
