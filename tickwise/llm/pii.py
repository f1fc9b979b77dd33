"""Personal data: fixed forms, and bootstrapped contextual extraction.

Four patterns find the seed entities.  The word before and the word after an
entity are its lexical patterns.  Strings of looser shape that no seed covers
(an address without a dotted domain, a dotted quad, a number of seven digits or
more that fails its kind's test) are candidate instances, of every kind that
their form allows: a number of 13 to 15 digits may be a card or a phone.  Patterns and instances form a
bipartite graph, scored iteratively by Spark: a pattern's score is the share
of its word's occurrences in the corpus that stand next to an instance of the
kind, weighted by the instances' confidence (seeds: 1); an instance's
confidence is the noisy-or of its patterns' scores.  Only patterns seen with
``MIN_INSTANCES`` different instances, one a seed, take part.  Candidates whose
confidence reaches ``MIN_CONFIDENCE`` are added spans, of the kind whose
patterns found them (of several, the most confident; a tie goes to the kind
listed first).  Base spans always stay; the counts are those of base
spans.

Defined results: null text counts as empty; repeated rows give repeated result
rows; an empty table gives no row; a null doc_id is kept; very long texts are
searched whole; only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sized, stored
from .spans import clear_of, marks, matches, written

KINDS = ("email", "ip", "card", "phone")
# The base patterns.  A match can only start where its run of
# characters starts or where the match before ended (\G), so these places are
# the only ones tried; possessive repetition changes no match, as what follows
# is outside the repeated class.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"
LOOSE = (r"(?:(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++)"
         r"|(?:(?<![0-9.])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++(?![0-9.]))"
         r"|(?:[+(]?[0-9](?:[().\x20/-]{0,2}+[0-9]){6,}+)")
CARD_DIGITS = (14, 19)
PHONE_DIGITS = (10, 15)
LOOSE_CARD_DIGITS = 13    # a number of so many digits or more may be a card, of up to 15 digits a phone

ROUNDS = 3
MIN_INSTANCES = 3
MIN_CONFIDENCE = 0.5


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        d = F.when(i % 2 == 1, 2 * d).otherwise(d)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _base(text: Column) -> dict[str, Column]:
    def card(s: Column) -> Column:
        d = _digits(s["value"])
        return F.length(d).between(*CARD_DIGITS) & luhn(d)

    return {
        "email": matches(text, EMAIL, "@"),
        "ip": F.filter(matches(text, IP, "."), lambda s: s["value"].rlike(IP_PARTS)),
        "card": F.filter(matches(text, CARD), card),
        "phone": F.filter(matches(text, PHONE, "+"), lambda s: F.length(_digits(s["value"])).between(*PHONE_DIGITS)),
    }


def _shapes(value: Column) -> Column:
    """The kinds a candidate could be."""
    n = F.length(_digits(value))
    return (F.when(value.contains("@"), F.array(F.lit("email")))
            .when(value.rlike(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"), F.array(F.lit("ip")))
            .when(n > PHONE_DIGITS[1], F.array(F.lit("card")))
            .when(n >= LOOSE_CARD_DIGITS, F.array(F.lit("card"), F.lit("phone")))
            .otherwise(F.array(F.lit("phone"))))


def _tagged(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), F.lit(True).alias("seed"), s.alias("s")))


def _instances(entities: DataFrame) -> DataFrame:
    """One row per entity and context word: side, word, kind, value, seed."""
    value = F.when(F.col("kind") == "email", F.lower("s.value")).otherwise(_digits(F.col("s.value")))
    words = F.array(
        F.struct(F.lit("before").alias("side"), F.regexp_extract("s.before", r"(\S+)\s+$", 1).alias("word")),
        F.struct(F.lit("after").alias("side"), F.regexp_extract("s.after", r"^\s+(\S+)", 1).alias("word")))
    return (entities.select("kind", "seed", value.alias("value"), F.explode(words).alias("w"))
            .select("kind", "seed", "value", "w.side", F.lower("w.word").alias("word")).where(F.col("word") != ""))


def confident_instances(entities: DataFrame, texts: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(kind, value, belief) of the candidates that the patterns vouch for.  ``entities``
    holds seeds and candidates with their contexts, ``texts`` the whole texts."""
    pattern = ["kind", "side", "word"]
    edges = stored(_instances(entities).groupBy(*pattern, "value")
                   .agg(F.count("*").alias("n"), F.max("seed").alias("seed")), "op5-edges")
    known = stored(edges.groupBy(*pattern).agg(F.count("*").alias("instances"), F.max("seed").alias("seed"))
                   .where((F.col("instances") >= MIN_INSTANCES) & F.col("seed")).select(*pattern), "op5-patterns")
    words = known.select("word").distinct()
    seen = (texts.select(F.explode(F.split(F.lower("text"), r"\s+")).alias("word"))
            .join(sized(words), "word").groupBy("word").agg(F.count("*").alias("total")))
    graph = stored(edges.join(known.join(seen, "word"), pattern), "op5-graph")
    scores = None
    belief = graph.select("kind", "value", F.col("seed").cast("double").alias("belief"))
    for _ in range(rounds):
        belief = belief.groupBy("kind", "value").agg(F.max("belief").alias("belief"))
        scores = (graph.join(belief, ["kind", "value"]).groupBy(*pattern)
                  .agg((F.sum(F.col("n") * F.col("belief")) / F.greatest(F.max("total"), F.sum("n"))).alias("score")))
        doubt = F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9))))
        belief = stored(graph.join(scores, pattern).groupBy("kind", "value")
                        .agg(F.when(F.max("seed"), 1.0).otherwise(1 - F.exp(doubt)).alias("belief"),
                             F.max("seed").alias("seed")), "op5-belief")
    return belief.where(~F.col("seed") & (F.col("belief") >= MIN_CONFIDENCE)).select(
        "kind", "value", "belief")


def pii_spans(docs: DataFrame) -> DataFrame:
    """doc_id, the base spans of each kind and ``added`` (kind, start, end)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64("text").alias("print"), text.alias("text"))
    base = _base(F.col("text"))
    located = rows.select("doc_id", "print", *[c.alias(k) for k, c in base.items()],
                          matches(F.col("text"), LOOSE).alias("loose"))
    located = stored(located.withColumn("loose", clear_of(F.col("loose"), F.concat(*KINDS))), "op5-located")

    tagged = F.concat(*[_tagged(F.col(k), k) for k in KINDS],
                      F.flatten(F.transform("loose", lambda s: F.transform(_shapes(s["value"]), lambda k: F.struct(
                          k.alias("kind"), F.lit(False).alias("seed"), s.alias("s"))))))
    found = confident_instances(located.select(F.explode(tagged).alias("e")).select("e.*"), rows)
    key = F.when(F.col("kind") == "email", F.lower("s.value")).otherwise(_digits(F.col("s.value")))
    first = F.array(*[F.lit(k) for k in reversed(KINDS)])
    best = F.max(F.struct(F.round("belief", 9).alias("belief"), F.array_position(first, F.col("kind")).alias("order"),
                          "kind"))
    added = (located.select("doc_id", "print", F.explode("loose").alias("s"))
             .withColumn("kind", F.explode(_shapes(F.col("s.value")))).withColumn("value", key)
             .join(found, ["kind", "value"])
             .groupBy(F.col("doc_id").alias("a_id"), F.col("print").alias("a_print"), "s.start", "s.end")
             .agg(best.alias("best"))
             .groupBy("a_id", "a_print")
             .agg(F.collect_set(F.struct("start", "end", F.col("best.kind").alias("kind"))).alias("added")))
    return (located.join(added, F.col("doc_id").eqNullSafe(F.col("a_id")) & (F.col("print") == F.col("a_print")), "left")
            .select("doc_id", *KINDS, "added"))


def digests(found: DataFrame) -> DataFrame:
    """The result columns: counts and hash of the base spans, and all spans."""
    base = F.concat(*[marks(F.col(k), k, i) for i, k in enumerate(KINDS)])
    rank = F.array(*[F.lit(k) for k in KINDS])
    more = F.transform(F.coalesce("added", F.array().cast("array<struct<start:int,end:int,kind:string>>")),
                       lambda s: F.struct(s["start"].alias("start"),
                                          (F.array_position(rank, s["kind"]) - 1).cast("int").alias("rank"),
                                          s["end"].alias("end"), s["kind"].alias("kind")))
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.concat(base, more)).alias("spans"))
