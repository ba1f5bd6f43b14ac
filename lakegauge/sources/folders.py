"""Folders that hold data, found by listing folders in tasks.

The folders of the first two levels are dealt to tasks, which walk what lies below. A folder costs one listing and
returns one row, however many files it holds; the driver sees neither files nor folders. Stores that Python tasks
cannot list have their files listed by Spark instead, to the same rows.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.sources.archives import _located, streams

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ROWS = "folder STRING, inside STRING, listed BOOLEAN, versions ARRAY<STRING>"
_NAMES = ["folder", "inside", "listed", "versions"]
_VERSION = "^([0-9a-f]{32})-"

_Row = tuple[str, str, bool, list[str]]


def _is_hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def _listing(folder: str, inside: str) -> Iterator[_Row]:
    """The folder itself if it holds data, and the folders in it, yet to be listed."""
    files, root = _located(folder)
    versions: set[str] = set()
    if not inside and files.get_file_info(root).type == pafs.FileType.File:
        # A single file was asked for.
        yield folder.rpartition("/")[0], "", True, [""]
        return
    for found in files.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
        name = found.base_name
        if _is_hidden(name):
            continue
        if found.type == pafs.FileType.Directory:
            yield f"{folder}/{name}", f"{inside}/{name}".lstrip("/"), False, []
        elif name.endswith(".parquet") and found.size:
            number = re.match(_VERSION, name)
            versions.add(number[1] if number else "")
    if versions:
        yield folder, inside, True, sorted(versions)


def _listed(rows: DataFrame, whole: bool) -> DataFrame:
    """``rows`` with folders yet to be listed replaced by what they hold: one level of it, or the ``whole`` of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            waiting = [tuple(row.values()) for row in batch.to_pylist()]
            out: list[_Row] = []
            while waiting:
                folder, inside, listed, versions = waiting.pop()
                if listed:
                    out.append((folder, inside, listed, versions))
                else:
                    (waiting if whole else out).extend(_listing(folder, inside))
            columns = [pa.array(column) for column in zip(*out)]
            if out:
                columns[3] = columns[3].cast(pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=_NAMES)

    return rows.mapInArrow(run, _ROWS)


def data_folders(spark: SparkSession, folder: str) -> DataFrame:
    """``folder``, ``inside`` (the same within the folder asked for, empty for itself) and ``versions`` of every folder
    directly holding parquet files, at any depth; none where there is no such folder.

    ``versions`` are the loads that the files' names begin with, in order, an empty string for files without one.
    Leftovers of failed writes and files without a byte do not count.
    """
    folder = folder.rstrip("/")
    if not streams(folder):
        return _by_files(spark, folder)
    rows = spark.createDataFrame([(folder, "", False, [])], _ROWS)
    first = _listed(_listed(rows, False), False)
    dealt = first.repartition(spark.sparkContext.defaultParallelism, "inside")
    return _listed(dealt, True).select("folder", "inside", "versions")


def _by_files(spark: SparkSession, folder: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "folder STRING, inside STRING, versions ARRAY<STRING>")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = files.option("pathGlobFilter", "*.parquet").load(folder).select("path")
    start = path.toUri().getPath().rstrip("/")
    parts = files.select(
        F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("folder"),
        F.regexp_extract(F.regexp_extract("path", "([^/]+)$", 1), _VERSION, 1).alias("version"),
    )
    at = F.instr("folder", F.lit(start))
    below = F.substr("folder", at + len(start) + 1)
    parts = parts.withColumn("inside", below)
    return parts.groupBy("folder", "inside").agg(F.sort_array(F.collect_set("version")).alias("versions"))

