"""The answer key: possessions published elsewhere, kept apart from everything they grade.

It has a base path of its own, holding archives, checksums and table; no other module names it and
the catalog does not publish it. The base is marked as restricted before anything is loaded, and a catalog
that would publish a path in it refuses, wherever it lies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructType

from lakegauge.functions.names import name_source
from lakegauge.operators.compare import compare_by_key
from lakegauge.operators.joins import mark_matches
from lakegauge.plans.loads import load_typed
from lakegauge.schemas import declare
from lakegauge.sinks.published import restrict

# The source's name and its columns in file order.
SOURCE = "pbpstats"
DEFAULT_DATASET = "pbpstats_2023"
SCHEMA = declare(
    "ENDTIME STRING, EVENTS STRING, FG2A BIGINT, FG2M BIGINT, FG3A BIGINT, FG3M BIGINT, "
    "GAMEDATE STRING, GAMEID STRING, NONSHOOTINGFOULSTHATRESULTEDINFTS BIGINT, "
    "OFFENSIVEREBOUNDS BIGINT, OPPONENT STRING, PERIOD BIGINT, SHOOTINGFOULSDRAWN BIGINT, "
    "STARTSCOREDIFFERENTIAL BIGINT, STARTTIME STRING, STARTTYPE STRING, TURNOVERS BIGINT, "
    "DESCRIPTION STRING, URL STRING"
)


def raw_folder(base: str) -> str:
    return f"{base}/raw"


def table_folder(base: str) -> str:
    return f"{base}/possessions"


def load_answer_key(
    spark: SparkSession, base: str, names: Sequence[str] = (DEFAULT_DATASET,), force: bool = False
) -> DataFrame:
    """Typed load of answer-key archives lying under ``<base>/raw``; other sources are refused."""
    sources = spark.createDataFrame([(n,) for n in names], "name STRING")
    strangers = sources.where(name_source(F.col("name")) != SOURCE).collect()
    if strangers:
        raise ValueError(f"{strangers[0].name!r} is not an answer-key dataset; only {SOURCE!r} belongs here")
    restrict(spark, base)
    return load_typed(
        spark,
        raw=raw_folder(base),
        ledger=f"{base}/checksums",
        schemas={SOURCE: SCHEMA},
        target={SOURCE: table_folder(base)},
        names=names,
        force=force,
    )


def read_answer_key(spark: SparkSession, base: str) -> DataFrame:
    schema = StructType(list(SCHEMA.fields)).add("season", LongType()).add("playoffs", BooleanType())
    return spark.read.schema(schema).parquet(table_folder(base))


def compare_to_key(derived: DataFrame, key: DataFrame, *, game: str, on: Sequence[str]) -> DataFrame:
    """Status per ``on`` key of derived rows against the answer key, within the games the key covers.

    A game absent from the key is left out, not counted as a mismatch. Both tables hold the same
    columns.
    """
    marked = mark_matches(derived, key, left_on=[game], right_on=[game], marker="__covered")
    covered = marked.where("__covered").drop("__covered")
    return compare_by_key(covered, key, on)
