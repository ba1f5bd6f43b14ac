"""Writing datasets as partitions of a table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from lakegauge.layout import PARTITION_COLUMNS

# Splits the files of a very large dataset; an ordinary season stays one file per task.
_ROWS_PER_FILE = 20_000_000

# Partitions a task may write at once; with none, Spark sorts all rows of a task by partition before it writes one.
_OPEN_FILES = "4"
_SETTING = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _unsorted(spark: SparkSession) -> Iterator[None]:
    """Writes in here keep the files of a few partitions open instead of sorting a task's rows, unless the session says
    otherwise. Tasks that meet more partitions sort the rows of these."""
    given = spark.conf.get(_SETTING, None)
    if given is not None and given != "0":
        yield
        return
    spark.conf.set(_SETTING, _OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.unset(_SETTING) if given is None else spark.conf.set(_SETTING, given)


def replace_partitions(frame: DataFrame, path: str) -> None:
    """Replace exactly the (season, playoffs) partitions ``frame`` has rows for.

    Files move into place when all tasks have succeeded, so a job whose tasks fail leaves the table
    as it was; other partitions are untouched either way. The moves go partition by partition: a
    driver killed between two of them leaves some old and some new, which loading again mends. Rows
    are written by the task that produced them, with no shuffle.
    """
    with _unsorted(frame.sparkSession):
        (
            frame.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", _ROWS_PER_FILE)
            .partitionBy(*PARTITION_COLUMNS)
            .parquet(path)
        )


def replace_with_empty(frame: DataFrame, path: str, season: int | None, playoffs: bool) -> None:
    """Make one partition hold no rows, as a dataset whose CSV is a bare header does."""
    held = "__HIVE_DEFAULT_PARTITION__" if season is None else str(season)
    leaf = f"{path}/season={held}/playoffs={str(playoffs).lower()}"
    columns = [c for c in frame.columns if c not in PARTITION_COLUMNS]
    empty = frame.sparkSession.createDataFrame([], frame.select(*columns).schema)
    empty.write.mode("overwrite").parquet(leaf)


def append_rows(frame: DataFrame, path: str) -> None:
    frame.write.mode("append").parquet(path)
