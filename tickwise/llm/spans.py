"""Places of pattern matches in whole texts, with SQL functions only.

Patterns use possessive repetition and start conditions so that matching is
linear in the text and needs no deep recursion; each comment says why the
matches are those of the plain pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,value:string,before:string,after:string>"
MARK = "array<struct<start:int,rank:int,end:int,kind:string>>"
CONTEXT = 64              # characters kept on either side of a match, for its context words


def matches(text: Column, pattern: str, holds: str = "") -> Column:
    """Leftmost non-overlapping matches, in order: start and end in code
    points, the match, and what stands around it (between it and the next
    match on either side, at most ``CONTEXT`` characters).  Texts without any
    match (at once those without ``holds``, a string every match holds) are not
    cut up."""
    def walk(parts: Column, found: Column) -> Column:
        first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

        def step(acc: Column, i: Column) -> Column:
            before, value, after = F.get(parts, i), F.get(found, i), F.get(parts, i + 1)
            start = acc["at"] + F.length(before)
            end = start + F.length(value)
            span = F.struct(start.alias("start"), end.alias("end"), value.alias("value"),
                            F.right(before, F.lit(CONTEXT)).alias("before"),
                            F.left(after, F.lit(CONTEXT)).alias("after"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

        return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), first, step, lambda acc: acc["out"])

    empty = F.array().cast(f"array<{SPAN}>")
    both = F.array(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
                            F.split(text, pattern, -1).alias("parts")))
    # bound to a variable, so that both lists are made once a row
    cut = F.transform(both, lambda x: F.when(F.size(x["found"]) > 0, walk(x["parts"], x["found"])).otherwise(empty))[0]
    return F.when(text.contains(holds) & text.rlike(pattern), cut).otherwise(empty)


def marks(spans: Column, kind: str, rank: int) -> Column:
    """Spans as (start, rank, end, kind): sorting these sorts by start, then kind as listed."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"),
                                                 s["end"].alias("end"), F.lit(kind).alias("kind")))


def written(marked: Column) -> Column:
    """kind:start:end, comma-joined, in order."""
    return F.array_join(F.transform(F.array_sort(marked), lambda m: F.concat_ws(
        ":", m["kind"], m["start"].cast("string"), m["end"].cast("string"))), ",")


def clear_of(spans: Column, taken: Column) -> Column:
    """The spans that overlap none of ``taken``."""
    return F.filter(spans, lambda s: ~F.exists(taken, lambda t: (s["start"] < t["end"]) & (t["start"] < s["end"])))
