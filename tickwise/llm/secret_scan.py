"""Secret scan: fixed forms, and sliding-window entropy of candidate strings.

Base kinds are three patterns.  Beyond them, runs of base64 characters are
candidates: what base matches and allow-listed words (placeholders, sequences)
leave of a run, in pieces of 20 and more characters that are no UUID.  A window
of 20 characters slides over a piece; a step changes the counts of two
characters, the one that comes and the one that goes, and both follow from the
19 characters between them, so a step costs the same in a run of any length.
Weights are whole numbers, so nothing drifts.  A piece whose highest window
reaches its character class's limit (hexadecimal or base64) is a span of kind
``entropy``.  Base spans always stay.

Defined results: null text counts as empty; very long texts and runs are
scanned whole; spans that start together are listed base kinds first; repeated rows give repeated result
rows; an empty table gives no row; only ``doc_id`` and ``text`` are read, other
columns pass through in ``doc``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import marks, matches, written

# The base patterns.  Possessive repetition changes no match, as
# nothing follows it; a hex or access run that is too short fails at every
# place in it, so its length is part of the pattern, whereas a short assigned
# value is consumed before it is dropped.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]++"""
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{12,})"""
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}+"
# Words that look random to no reader; they are cut out of a run.
ALLOWED = ("example", "sample", "dummy", "placeholder", "changeme", "your_", "your-", "redacted", "xxxx", "lorem",
           "foobar", "0123456789", "123456789", "abcdefgh", "deadbeef")
UUID = "(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"

WINDOW = 20
HEX_LIMIT = 3.0           # bits a character, of at most 4
BASE64_LIMIT = 3.8        # bits a character, of at most log2(20) = 4.32


SCALE = 1 << 40           # weights of counts, c * log2(c), as whole numbers


def weight(count: int) -> int:
    return round(count * math.log2(count) * SCALE) if count > 1 else 0


def bits(total: Column, window: int = WINDOW) -> Column:
    """Shannon entropy of a window from the sum of its counts' weights."""
    return F.lit(math.log2(window)) - total.cast("double") / F.lit(float(SCALE * window))


def window_entropy(value: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy (bits a character) of any window of ``value``,
    an ASCII string of at least ``window`` characters."""
    gain = F.array(*[F.lit(weight(c + 1) - weight(c)) for c in range(window)])    # of one more of a character

    def counted(codes: Column, at: Column, direction: int) -> Column:
        """The gain of the character at ``at`` over the window - 1 characters
        before (-1) or after (1) it."""
        def of(x: Column) -> Column:
            same = [F.when(F.get(codes, at + direction * k) == x, 1).otherwise(0) for k in range(1, window)]
            return F.get(gain, sum(same[1:], same[0]))
        return F.transform(F.array(F.get(codes, at)), of)[0]

    def changes(codes: Column) -> Column:
        def change(i: Column) -> Column:
            return counted(codes, i, -1) - F.when(i >= window, counted(codes, i - window, 1)).otherwise(F.lit(0))
        return F.transform(F.sequence(F.lit(0), F.size(codes) - 1), change)

    def slide(acc: Column, change: Column) -> Column:
        total, seen = acc["total"] + change, acc["seen"] + 1
        return F.struct(total.alias("total"), seen.alias("seen"),
                        F.when(seen >= window, F.least(acc["least"], total)).otherwise(acc["least"]).alias("least"))

    first = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("seen"), F.lit(weight(window)).alias("least"))
    # bound to a variable, so that the characters are taken apart once
    codes = F.array(F.filter(F.transform(F.split(value, ""), lambda c: F.ascii(c)), lambda x: x > 0))
    least = F.transform(codes, lambda c: F.aggregate(changes(c), first, slide, lambda acc: acc["least"]))[0]
    return bits(least, window)


def suspicious(value: Column) -> Column:
    """Whether a piece mixes digits and letters, is no UUID and has a window
    as mixed as its class asks for."""
    limit = F.when(value.rlike("^[0-9A-Fa-f]+$"), HEX_LIMIT).otherwise(BASE64_LIMIT)
    return (value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike(UUID)
            & (window_entropy(value) >= limit))


def masked(run: Column, taken: Column) -> Column:
    """A run's characters, blank where base spans or allowed words are."""
    met = F.filter(taken, lambda t: (run["start"] < t["end"]) & (t["start"] < run["end"]))

    def blank(value: Column, t: Column) -> Column:
        at = F.greatest(t["start"] - run["start"], F.lit(0))
        size = F.least(t["end"], run["end"]) - run["start"] - at
        return F.overlay(value, F.repeat(F.lit(" "), size), at + 1, size)

    value = F.aggregate(met, run["value"], blank)
    for word in ALLOWED:
        value = F.regexp_replace(value, f"(?i){word}", " " * len(word))
    return value


def entropy_spans(runs: Column, taken: Column) -> Column:
    """The suspicious pieces of candidate runs."""
    def of(run: Column) -> Column:
        pieces = F.filter(matches(masked(run, taken), CANDIDATE), lambda s: suspicious(s["value"]))
        return F.transform(pieces, lambda s: F.struct((s["start"] + run["start"]).alias("start"),
                                                      (s["end"] + run["start"]).alias("end"), s["value"].alias("value"),
                                                      s["before"].alias("before"), s["after"].alias("after")))
    return F.flatten(F.transform(runs, of))


def secret_scan(docs: DataFrame) -> DataFrame:
    """``docs`` as struct column ``doc`` with the base spans of each kind
    (``assign``, ``access``, ``hex``) and the added ones (``entropy``)."""
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    rows = docs.select(F.struct("*").alias("doc"))
    base = rows.select(
        "doc", F.filter(matches(text, ASSIGN), lambda s: s["value"].rlike(ASSIGN_VALUE)).alias("assign"),
        matches(text, ACCESS, "AKIA").alias("access"), matches(text, HEX).alias("hex"),
        matches(text, CANDIDATE).alias("candidates"))
    return base.select("doc", "assign", "access", "hex", entropy_spans(
        F.col("candidates"), F.concat("assign", "access", "hex")).alias("entropy"))


def digests(found: DataFrame) -> DataFrame:
    """The scan's result columns: counts, a hash of the base spans, all spans."""
    base = F.concat(marks(F.col("assign"), "assign", 0), marks(F.col("access"), "access", 1),
                    marks(F.col("hex"), "hex", 2))
    spans = F.concat(base, marks(F.col("entropy"), "entropy", 3))
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(spans).alias("spans"))
