"""Tick JSON parsing (P1 lenient, P2 strict), invalid-tick filter (F1) and
quote cleaning (P3).

The lenient parser of the streaming path never fails: text that is not JSON,
or lacks one of the four fields, becomes the tick ``("Invalid", "Invalid", 0,
0)``.  Field text keeps its JSON form (strings with their quotes, JSON null as
the text ``null``) until :func:`clean_ticks` removes the quotes; numbers are
read leniently (numeric text parses, other text and JSON null give 0).

It is built on Spark's VARIANT type: ``try_parse_json`` (NULL for bad JSON),
``try_variant_get(.., 'variant')`` distinguishes a missing field (SQL NULL)
from JSON null, and ``to_json`` of a sub-value gives its JSON text.  VARIANT
rejects an object with a repeated key, of which the source's parser kept the
last value; such text is read as a map of texts instead (where a number in a
text field therefore gets quotes, which :func:`clean_ticks` removes).
No Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import INVALID, clean_quotes

# The fields of a tick message, in message order
FIELDS = ("symbol", "timestampValue", "price", "volume")


def parse_tick_lenient(df: DataFrame, col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``value`` JSON text -> ``symbol, timestampvalue`` (JSON text of the
    field) and ``price, volume`` (double)."""
    text = F.col(col)
    v = F.try_parse_json(text)
    # only read where VARIANT gave up: entries of the object, the last of a repeated key
    entries = F.when(v.isNull(), F.map_entries(F.from_json(text, "map<string,string>")))

    def last(f: str) -> Column:
        return F.try_element_at(F.filter(entries, lambda e: e["key"] == f), F.lit(-1))

    def number(f: str) -> Column:
        return F.coalesce(F.try_variant_get(v, f"$.{f}", "double"), last(f)["value"].try_cast("double"), F.lit(0.0))

    def json_text(f: str) -> Column:
        again = F.concat(F.lit('"'), F.replace(last(f)["value"], F.lit('"'), F.lit('\\"')), F.lit('"'))
        return F.coalesce(F.to_json(F.try_variant_get(v, f"$.{f}", "variant")),
                          F.when(last(f).isNotNull(), F.coalesce(again, F.lit("null"))))

    ok = F.lit(True)
    for f in FIELDS:
        ok = ok & (F.try_variant_get(v, f"$.{f}", "variant").isNotNull() | last(f).isNotNull())
    ok = F.coalesce(ok, F.lit(False))
    return df.select(
        *keep,
        F.when(ok, json_text("symbol")).otherwise(F.lit(INVALID)).alias("symbol"),
        F.when(ok, json_text("timestampValue")).otherwise(F.lit(INVALID)).alias("timestampvalue"),
        F.when(ok, number("price")).otherwise(F.lit(0.0)).alias("price"),
        F.when(ok, number("volume")).otherwise(F.lit(0.0)).alias("volume"))


STRICT_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestampValue", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("volume", T.IntegerType()),
])


def parse_tick_strict(df: DataFrame, col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed tick ``(symbol string, timestampvalue string, price double,
    volume int)``.  A malformed record, a value of the wrong type or a missing
    field fails the job (the batch ingest stopped on such a record)."""
    p = F.from_json(F.col(col), STRICT_SCHEMA, {"mode": "FAILFAST"})
    parsed = df.select(*keep, p.alias("_t"), F.col(col).alias("_raw"))
    complete = F.col("_t").isNotNull()
    for f in STRICT_SCHEMA.fieldNames():
        complete = complete & F.col(f"_t.{f}").isNotNull()
    checked = F.when(complete, F.col("_t")).otherwise(
        F.raise_error(F.concat(F.lit("incomplete tick record: "), F.col("_raw"))))
    return parsed.select(*keep, checked.alias("_t")).select(
        *keep, F.col("_t.symbol").alias("symbol"),
        F.col("_t.timestampValue").alias("timestampvalue"),
        F.col("_t.price").alias("price"), F.col("_t.volume").alias("volume"))


def drop_invalid(df: DataFrame, col: str = "symbol") -> DataFrame:
    """drop ticks whose symbol text contains ``Invalid`` (this also drops
    a real symbol containing that text, as the source did)."""
    return df.where(~F.col(col).contains(INVALID))


def clean_ticks(df: DataFrame, cols=("symbol", "timestampvalue")) -> DataFrame:
    """Remove JSON quotes from the text fields and trim."""
    return df.select(*[clean_quotes(c).alias(c) if c in cols else F.col(c) for c in df.columns])
