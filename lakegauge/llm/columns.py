"""Column helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.scratch import scratch_dir

# Words are runs of characters other than these six.
SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` mentions it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: str | Column) -> Column:
    """The words of a text in order; no words for null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(column, F.lit("")), SPACE), "")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Fewest tasks that rows are gathered in, and rows from which there are more.
_TASKS, _TASK_ROWS = 16, 4_000


def tasks_for(rows: DataFrame) -> int:
    """Tasks for steps on about as many rows as ``rows``, which is counted and should be stored.

    Where few rows were dealt to very many partitions, ``coalesce`` to these spares most tasks and files; more rows
    stay on the partitions they have.
    """
    return max(_TASKS, rows.count() // _TASK_ROWS)


def stored(frame: DataFrame, label: str, compression: str = "zstd", tasks: int | None = None) -> DataFrame:
    """``frame`` written once to the shared scratch folder, by at most so many ``tasks``, and read back.

    Later readers and retried tasks then see the same rows, and a lost executor costs a read.
    """
    path = scratch_dir(frame.sparkSession, label)
    frame = frame.coalesce(tasks) if tasks else frame
    frame.write.option("compression", compression).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of rows that a task hands to Python at once; a longer row goes alone.
_BATCH_BYTES = 2 << 20


def in_small_batches(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``operator``, called with a table first, with small batches for the Python steps of the jobs that it runs, unless the
    session sets their bytes. Spark's own limits are 10,000 rows and 64 MB, which every task holds several times over:
    in its JVM, outside the heap, and in its worker with the arrays made from it.

    Steps run after ``operator`` returns are not concerned, so it should store what its Python steps give.
    """

    @wraps(operator)
    def run(rows: DataFrame, *args, **named) -> DataFrame:
        spark = rows.sparkSession
        if spark.conf.get(_BATCH_SETTING, None) is not None:
            return operator(rows, *args, **named)
        spark.conf.set(_BATCH_SETTING, str(_BATCH_BYTES))
        try:
            return operator(rows, *args, **named)
        finally:
            spark.conf.unset(_BATCH_SETTING)

    return run


#: Words of 64 bits in a set of hashes that is sent to every task: its size bounds the broadcast.
_FILTER_WORDS = 1 << 16


def _places(hashed: Column) -> tuple[Column, Column]:
    word = F.pmod(hashed, F.lit(_FILTER_WORDS))
    return word, F.pmod(F.shiftright(hashed, 20), F.lit(64)).cast("int")


def possibly_among(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The ``rows`` whose ``column`` may be in the one column of ``wanted``, by a bit set of fixed size.

    No wanted row is lost; others may pass, so a join has to follow. With few wanted values this spares
    shuffling most rows; with very many, all rows pass. ``wanted`` is read once and should be stored.
    """
    name = wanted.columns[0]
    word, bit = _places(F.xxhash64(F.col(name)))
    one = F.lit(1).cast("long")
    bits = wanted.select(word.alias("__word"), F.call_function("shiftleft", one, bit).alias("__bits"))
    # A row for each word at most, whatever there is to hold.
    bits = bits.groupBy("__word").agg(F.bit_or("__bits").alias("__bits"))
    word, bit = _places(F.xxhash64(F.col(column)))
    passes = F.call_function("shiftright", F.col("__bits"), bit).bitwiseAND(one) == one
    return rows.join(F.broadcast(bits), (word == F.col("__word")) & passes, "left_semi")
