"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor
kept and returns what it keeps, with the columns of ``documents``; the last
returns the packed pieces.  :func:`run` writes every stage's result as Parquet
in the shared folder and reads it back as the next stage's documents, so a
lost executor never repeats an earlier stage.

The stages' rules are those of their operators (see ``tickwise/llm``): nulls,
empty texts, repeated rows, empty tables and extra columns are handled there.
``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm.best_fit_packing import best_fit_packing
from tickwise.llm.common import stored, table
from tickwise.llm.decontamination import without_contaminated
from tickwise.llm.language_id import in_known_language
from tickwise.llm.line_dedup import without_boilerplate
from tickwise.llm.simhash_dedup import one_of_each_group
from tickwise.session import ship_package

#: No stage but two can be written in SQL (language ID, SimHash and the
#: tokenizer cannot), so the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which at least a third is in one learned language."""
    ship_package(spark)
    return in_known_language(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cross-site boilerplate lines go; documents that held nothing else go."""
    kept = without_boilerplate(docs)
    if "n_chars" not in kept.columns:
        return kept
    return kept.withColumn("n_chars", F.length("text").cast(kept.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    ship_package(spark)
    return one_of_each_group(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark passages go."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' pieces in sequences of fixed capacity."""
    ship_package(spark)
    return best_fit_packing(docs)


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
