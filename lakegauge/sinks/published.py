"""Replacing partitions of a table in one step.

A load writes its partitions aside and moves their files into the table under names that begin with the load's number.
Nothing reads them there yet: what a table holds is told by its record, one small file per load beside the tables that
names the live load of every partition. Writing that file publishes all partitions of the load at once; a load that
stops anywhere before leaves the table as it was. Files of replaced loads are removed afterwards, and a
partition that was never published holds the files without a number.

Two loads of one table at a time cannot both write the next record: the later one raises.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.functions.columns import text
from lakegauge.layout import PARTITION_COLUMNS
from lakegauge.sinks.partitions import replace_partitions

RECORDS = "_live"

#: Name of the file that marks a folder as restricted.
RESTRICTED = "_RESTRICTED"

RECORD = "load BIGINT, partition STRING, version STRING"

_PARTITION = f"({'/'.join(f'{c}=[^/]+' for c in PARTITION_COLUMNS)})/"
_VERSION = "/([0-9a-f]{32})-[^/]+$"


def _split(path: str) -> tuple[str, str]:
    folder, _, name = path.rstrip("/").rpartition("/")
    return folder, name


def record_folder(path: str) -> str:
    """Where the records of a table lie: beside the tables, out of sight of readers."""
    folder, name = _split(path)
    return f"{folder}/{RECORDS}/{name}"


class Files:
    """A folder's file system, through Spark's own client: it knows every store that Spark knows."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        """Names directly in a folder; none where there is no such folder."""
        if not self._files.exists(self._path(folder)):
            return []
        return sorted(found.getPath().getName() for found in self._files.listStatus(self._path(folder)))

    def plain(self, folder: str) -> list[str]:
        """Names of the files directly in a folder, leaving folders out."""
        if not self._files.exists(self._path(folder)):
            return []
        listed = self._files.listStatus(self._path(folder))
        return sorted(found.getPath().getName() for found in listed if found.isFile())

    def move(self, source: str, target: str) -> bool:
        self._files.mkdirs(self._path(target).getParent())
        return self._files.rename(self._path(source), self._path(target))

    def resolved(self, path: str) -> str:
        """The full address of a path, links followed where the store has any."""
        return self._files.resolvePath(self._path(path)).toString()

    def exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))

    def remove(self, path: str) -> None:
        self._files.delete(self._path(path), True)

    def write(self, path: str, content: str) -> None:
        out = self._files.create(self._path(path), False)
        out.write(content.encode())
        out.close()


def restrict(spark: SparkSession, base: str) -> None:
    """Mark everything under a folder as never to be published."""
    files = Files(spark, base)
    if not files.exists(f"{base}/{RESTRICTED}"):
        files.write(f"{base}/{RESTRICTED}", "")


def _latest(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """Number of the latest record and the live load of each partition: a row per partition, not per file."""
    folder = record_folder(path)
    numbers = [int(n.removesuffix(".json")) for n in Files(spark, folder).names(folder) if n.endswith(".json")]
    if not numbers:
        return 0, {}
    rows = spark.read.schema(RECORD).json(f"{folder}/{max(numbers):012d}.json").collect()
    return max(numbers), {r.partition: r.version for r in rows}


def is_live(spark: SparkSession, path: str) -> Column:
    """Whether a row of the table read from ``path`` is published. Files of other loads are not opened."""
    _, live = _latest(spark, path)
    partition = F.regexp_extract("_metadata.file_path", _PARTITION, 1)
    version = F.regexp_extract("_metadata.file_path", _VERSION, 1)
    named = F.lit("")
    if live:
        known = F.create_map(*(F.lit(x) for pair in sorted(live.items()) for x in pair))
        named = F.coalesce(F.try_element_at(known, partition), F.lit(""))
    return version == named


def live_sql(spark: SparkSession, path: str, files: str) -> str:
    """The published rows of ``files``, SQL naming the table, as SQL that follows later loads."""
    if not Files(spark, path).names(record_folder(path)):
        return f"(SELECT * FROM {files})"
    records = f"json.`{record_folder(path)}`"
    return (
        f"(SELECT t.* FROM (SELECT *, regexp_extract(_metadata.file_path, {text(_PARTITION)}, 1) AS __partition, "
        f"regexp_extract(_metadata.file_path, {text(_VERSION)}, 1) AS __version FROM {files}) t "
        f"LEFT JOIN (SELECT `partition`, version FROM {records} WHERE load = (SELECT max(load) FROM {records})) r "
        f"ON r.`partition` = t.__partition WHERE coalesce(r.version, '') = t.__version)"
    )


@dataclass(frozen=True)
class Written:
    """Partitions lying aside, complete and not published."""

    path: str
    aside: str
    load: str


def write_aside(frame: DataFrame, path: str) -> Written:
    """Write the partitions ``frame`` has rows for beside the table at ``path``."""
    folder, name = _split(path)
    load = uuid.uuid4().hex
    written = Written(path, f"{folder}/_aside/{name}-{load}", load)
    replace_partitions(frame, written.aside)
    return written


def discard(spark: SparkSession, written: Written) -> None:
    """Take away partitions lying aside."""
    Files(spark, written.aside).remove(written.aside)


def publish(spark: SparkSession, written: Written) -> None:
    """Put the partitions in place of those the table holds, all in one step."""
    files = Files(spark, written.path)
    number, live = _latest(spark, written.path)
    replaced = []
    for first in files.names(written.aside):
        for second in files.names(f"{written.aside}/{first}") if "=" in first else ():
            partition = f"{first}/{second}"
            for name in files.names(f"{written.aside}/{partition}"):
                target = f"{written.path}/{partition}/{written.load}-{name}"
                if name[0] not in "._" and not files.move(f"{written.aside}/{partition}/{name}", target):
                    raise OSError(f"cannot move a loaded file to {target}")
            live[partition] = written.load
            replaced.append(partition)
    record = f"{record_folder(written.path)}/{number + 1:012d}.json"
    lines = [json.dumps({"load": number + 1, "partition": p, "version": v}) for p, v in sorted(live.items())]
    unseen = f"{record_folder(written.path)}/.{written.load}"
    files.write(unseen, "\n".join(lines) + "\n")
    if record.rpartition("/")[2] in files.names(record_folder(written.path)) or not files.move(unseen, record):
        raise RuntimeError(f"{written.path}: another load has been published meanwhile")
    files.remove(written.aside)
    for partition in replaced:
        for name in files.names(f"{written.path}/{partition}"):
            if not name.startswith(f"{written.load}-"):
                files.remove(f"{written.path}/{partition}/{name}")
