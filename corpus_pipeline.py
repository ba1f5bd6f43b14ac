"""The corpus pipeline: documents through five stages, each over all that its predecessor kept.

Edge cases: a null or empty text, or one of white space alone, has no words and does not pass the quality rules; where a
stage is run by itself, such a document stays as it is in all the others, and takes one place of a bin. Rows with a
null or repeated ``doc_id`` are told apart by their texts; of fully repeated rows one stays after the near
duplicates. Ties go to the smaller key, then the smaller hash. Very long texts are worked on whole, and cut into pieces
by packing alone. An empty table gives empty results, and other columns, whatever they are called, are kept as they
are by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.llm.columns import stored, words_of
from lakegauge.llm.lines import drop_repeated_lines
from lakegauge.llm.packing import pack
from lakegauge.llm.partenum import one_of_each
from lakegauge.llm.pii import sanitise
from lakegauge.llm.quality import passing


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return passing(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand, up to two edits, in an earlier place of the corpus."""
    return drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles with a similarity of at least 0.8."""
    return one_of_each(docs, width=5, share=80)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and the terms disclosing it replaced."""
    return sanitise(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in bins; a document takes its words and one end mark."""
    return pack(docs, F.size(words_of("text")) + 1)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("private data", private_data),
    ("packing", packing),
]

#: Edit distances over all pairs of lines, components and packing are beyond SQL at this size; the tests
#: compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
