"""A folder's archives as a stream that notices replacements.

The stream's offset is a digest of the folder's listing, so a batch starts when anything about the listing has changed
and hands on all of it; :func:`changed_archives` keeps, per archive, the size and time of the file it handed on last
and lets through what differs. An archive replaced under its name is met again, one that stayed is not, and an
archive that arrives with an old time (moved, or copied with its times) is met as well.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lakegauge.sources.archives import SUFFIX, _located

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_LISTED = "name STRING, path STRING, length BIGINT, modified BIGINT"
_HANDED_ON = "length BIGINT, modified BIGINT"

#: Archives a task of the listing hands on.
_PER_TASK = 10_000

Listed = tuple[str, str, int, int]


def list_archives(folder: str) -> list[Listed]:
    """Name, path, length and time (in nanoseconds) of the archives right under a folder, by name."""
    files, root = _located(folder)
    scheme = folder[: folder.index(root)] if root in folder else ""
    found = files.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    return sorted(
        (f.base_name[: -len(SUFFIX)], scheme + f.path, f.size, f.mtime_ns or 0)
        for f in found
        if f.type == pafs.FileType.File and f.base_name.endswith(SUFFIX) and not f.base_name.startswith((".", "_"))
    )


@dataclass
class _Slice(InputPartition):
    archives: list[Listed]


class _ListingReader(DataSourceStreamReader):
    def __init__(self, folder: str) -> None:
        self._folder = folder

    def initialOffset(self) -> dict:
        return {"listing": hashlib.sha256().hexdigest()}

    def latestOffset(self) -> dict:
        digest = hashlib.sha256()
        for archive in list_archives(self._folder):
            digest.update(repr(archive).encode())
        return {"listing": digest.hexdigest()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        # A batch run again may meet a newer listing than its offset names; what it loads is then newer too, and the
        # batch after it finds that nothing more has changed.
        archives = list_archives(self._folder)
        return [_Slice(archives[at : at + _PER_TASK]) for at in range(0, len(archives), _PER_TASK)] or [_Slice([])]

    def read(self, partition: InputPartition) -> Iterator[Listed]:
        yield from partition.archives


class ArchiveListing(DataSource):
    """``name``, ``path``, ``length`` and ``modified`` of all archives under ``path``, whenever one changes."""

    @classmethod
    def name(cls) -> str:
        return "archive_listing"

    def schema(self) -> str:
        return _LISTED

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _ListingReader(self.options["path"])


def _changed(name: tuple[str], files: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    before = state.get if state.exists else None
    for listed in files:
        # A name is listed once in a batch.
        now = (int(listed["length"].iloc[0]), int(listed["modified"].iloc[0]))
        if now != before:
            state.update(now)
            yield listed.iloc[:1]


def changed_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Streaming ``name``, ``path``, ``length`` and ``modified`` of archives that are new or differ in size or time from
    when they were last handed on."""
    spark.dataSource.register(ArchiveListing)
    listed = spark.readStream.format("archive_listing").option("path", folder).load()
    return listed.groupBy("name").applyInPandasWithState(
        _changed, _LISTED, _HANDED_ON, "append", GroupStateTimeout.NoTimeout
    )
