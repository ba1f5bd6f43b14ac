"""Archives: ``<name>.tar.xz`` files each holding exactly one CSV.

An xz stream has no split points, so an archive is one task's work and parallelism comes from the
number of archives. Inside the task the archive is opened once, as a stream: header, rows and checksum
come from the same bytes as they pass. It is decompressed and parsed as a stream of Arrow batches: neither
the archive, the CSV nor the parsed table is ever held whole, and nothing is spilled to disk.

Python tasks open local files and the stores pyarrow knows. Archives in a store that only Spark reads come as
cells of binary rows instead, which limits them to 2 GB.
"""

from __future__ import annotations

import csv
import hashlib
import io
import json
import lzma
import re
import sys
import tarfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import IO
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, LongType, StringType, StructField, StructType

from lakegauge.functions.strict import ACCEPTED

# Ship the functions below to the executors by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SUFFIX = ".tar.xz"

# Size of a parsed batch. A row that does not fit has its archive read again in larger ones.
_BATCH_BYTES = 4 << 20
_LARGEST_BATCH = (1 << 31) - 1

# An empty line is a row: null in a CSV of one column, too few fields in a wider one.
_PARSING = {"newlines_in_values": True, "ignore_empty_lines": False}


def archive_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Archives (``name``, ``path``, ``length``, ``content``) under a folder, or at the paths given.

    A reader that leaves ``content`` out lists the files without opening them. ``name`` is a file's own
    property, so a filter on it, or on what is derived from it, chooses files before any is opened.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(paths)
    name = F.regexp_extract("_metadata.file_name", r"^(.+)\.tar\.xz$", 1).alias("name")
    return files.select(name, "path", "length", "content")


def _located(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system a path lies on, and the path there."""
    if urlsplit(path).scheme in ("", "file"):
        return pafs.LocalFileSystem(), re.sub("^file:/*", "/", path)
    return pafs.FileSystem.from_uri(path)


def streams(folder: str) -> bool:
    """Whether tasks can open files under the folder themselves."""
    try:
        _located(folder)
    except (OSError, ValueError):
        return False
    return True


def open_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Archives under a folder, to be opened by the tasks that read them where these can: without ``content``."""
    files = archive_files(spark, folder)
    return files.drop("content") if streams(folder) else files


class _Bytes(io.RawIOBase):
    """The bytes of an archive from its first to its last, hashed as they pass."""

    def __init__(self, inner: IO[bytes]) -> None:
        self._inner = inner
        self.restart()

    def restart(self) -> None:
        self._inner.seek(0)
        self._hash = hashlib.sha256()

    def readable(self) -> bool:
        return True

    def readinto(self, buffer: memoryview) -> int:
        data = self._inner.read(len(buffer))
        self._hash.update(data)
        buffer[: len(data)] = data
        return len(data)

    def sha256(self) -> str:
        """Of the whole archive, whose rest is read for it."""
        while self.read(1 << 20):
            pass
        return self._hash.hexdigest()


def _opened(held: str | bytes) -> _Bytes:
    """An archive by its path, or the bytes of one."""
    if isinstance(held, str):
        files, path = _located(held)
        return _Bytes(files.open_input_file(path))
    return _Bytes(io.BytesIO(held))


def archive_name() -> Column:
    """``name`` of the archive a ``path`` leads to."""
    return F.regexp_extract("path", r"([^/]+)\.tar\.xz$", 1).alias("name")


@contextmanager
def _single_csv(name: str, archive: _Bytes, whole: bool = True) -> Iterator[IO[bytes]]:
    """The archive's only CSV as a byte stream. On leaving, unless ``whole`` is off, check that it
    was the only one and that the compressed stream is complete."""
    found = []
    archive.restart()
    buffered = io.BufferedReader(archive, 1 << 20)
    try:
        with lzma.open(buffered) as stream:
            with tarfile.open(fileobj=stream, mode="r|") as tar:
                for member in tar:
                    if member.isfile() and member.name.endswith(".csv"):
                        found.append(member.name)
                        if len(found) == 1:
                            yield tar.extractfile(member)
                            if not whole:
                                return
            while stream.read(1 << 20):
                pass
    except (lzma.LZMAError, tarfile.TarError, EOFError) as broken:
        raise ValueError(f"{name}: not a readable {SUFFIX} archive: {broken}") from broken
    except pa.ArrowInvalid as ragged:
        raise ValueError(f"{name}: {ragged}") from ragged
    finally:
        buffered.detach()
    if len(found) != 1:
        raise ValueError(f"{name}: an archive holds one CSV, this one {len(found)}: {found}")


def _header(name: str, archive: _Bytes) -> list[str]:
    csv.field_size_limit(_LARGEST_BATCH)
    with _single_csv(name, archive, whole=False) as member:
        header = next(csv.reader(line.decode() for line in member), None)
    if not header:
        raise ValueError(f"{name}: the CSV has no header")
    return [header[0].removeprefix("\ufeff"), *header[1:]]


class _Counted(io.RawIOBase):
    """A byte stream that counts the lines read from it and looks for empty ones, outside quotes."""

    def __init__(self, inner: IO[bytes]) -> None:
        self._inner, self._quoted, self._tail = inner, 0, b"\n"
        self.lines, self.has_empty = 0, False

    def readable(self) -> bool:
        return True

    def readinto(self, buffer: memoryview) -> int:
        data = self.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)

    def read(self, size: int = -1) -> bytes:
        data = self._inner.read(size)
        if data:
            self._count(data)
            self._tail = (self._tail + data[-2:])[-2:]
        return data

    def _count(self, data: bytes) -> None:
        values = np.frombuffer(self._tail + data, np.uint8)
        given = len(self._tail)
        quotes = np.flatnonzero(values[given:] == ord('"')) + given
        # The quotes before a line end tell whether it lies within a field.
        ends = np.flatnonzero(values[given:] == ord("\n")) + given
        ends = ends[(np.searchsorted(quotes, ends) + self._quoted) % 2 == 0]
        self.lines += len(ends)
        if not self.has_empty:
            before, second = values[ends - 1], values[np.maximum(ends - 2, 0)]
            empty = (before == ord("\n")) | ((before == ord("\r")) & (second == ord("\n")) & (ends > 1))
            self.has_empty = bool(empty.any()) or self._has_empty_by_returns(values, given, quotes)
        self._quoted = (self._quoted + len(quotes)) % 2

    def _has_empty_by_returns(self, values: np.ndarray, given: int, quotes: np.ndarray) -> bool:
        returns = np.flatnonzero(values[1:] == ord("\r")) + 1
        returns = returns[(returns >= given) & (values[returns - 1] == ord("\r"))]
        return bool(((np.searchsorted(quotes, returns) + self._quoted) % 2 == 0).any())

    @property
    def records(self) -> int:
        """Records after the header, if every quote in the CSV opens or closes a field."""
        return max(0, self.lines + (self._tail[-1:] != b"\n") - 1)


def _records(name: str, archive: _Bytes) -> tuple[int, int]:
    """Records after the header and empty lines, read one by one: slow, for files that look odd."""
    csv.field_size_limit(_LARGEST_BATCH)
    with _single_csv(name, archive) as member:
        text = io.TextIOWrapper(io.BufferedReader(_Counted(member)), "utf-8", newline="")
        lines = empty = 0
        for record in csv.reader(text):
            lines += 1
            empty += not record
        return max(0, lines - 1), empty


def _parsed(name: str, stream: IO[bytes], columns: Sequence[str], batch_bytes: int) -> Iterator[pa.RecordBatch]:
    reader = pacsv.open_csv(
        stream,
        read_options=pacsv.ReadOptions(block_size=batch_bytes, use_threads=False),
        parse_options=pacsv.ParseOptions(**_PARSING),
        convert_options=pacsv.ConvertOptions(
            column_types={c: pa.string() for c in columns},
            strings_can_be_null=True,
            quoted_strings_can_be_null=False,
            null_values=[""],
        ),
    )
    if sorted(reader.schema.names) != sorted(columns):
        missing = sorted(set(columns) - set(reader.schema.names))
        unexpected = sorted(set(reader.schema.names) - set(columns))
        raise ValueError(f"{name}: columns drift: missing={missing} unexpected={unexpected}")
    for batch in reader:
        yield batch.select(list(columns))


def _text_batches(name: str, archive: _Bytes, columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """The CSV as all-string batches in ``columns`` order. An unquoted empty field is null, a quoted
    one an empty string; a row with too few or too many fields raises.

    The records are counted beside the parser, and a difference raises. Batches grow until the
    longest row fits; rows already handed on are then passed over.
    """
    given, batch_bytes = 0, _BATCH_BYTES
    while True:
        grow, seen = False, 0
        with _single_csv(name, archive) as member:
            counted = _Counted(member)
            try:
                for batch in _parsed(name, counted, columns, batch_bytes):
                    seen += batch.num_rows
                    if seen > given:
                        yield batch.slice(max(0, batch.num_rows - (seen - given)))
                        given = seen
            except pa.ArrowInvalid as invalid:
                if "straddling" not in str(invalid) or batch_bytes == _LARGEST_BATCH:
                    raise
                grow = True
        if not grow:
            break
        batch_bytes = min(8 * batch_bytes, _LARGEST_BATCH)
    wide = len(columns) > 1
    if counted.records != given or (wide and counted.has_empty):
        records, empty = _records(name, archive)
        if wide and empty:
            raise ValueError(f"{name}: an empty line among rows of {len(columns)} columns")
        if records != given:
            raise ValueError(f"{name}: {records} records in the CSV, {given} of them parsed")


def _held(archives: DataFrame) -> str:
    """The column that leads to an archive's bytes."""
    return "content" if "content" in archives.columns else "path"


def archive_headers(archives: DataFrame) -> DataFrame:
    """One row per archive: ``name``, ``sha256`` of its bytes and the CSV's ``columns``."""
    hashed = archives.select("name", F.sha2("content", 256).alias("sha256"), "content")
    return hashed.mapInArrow(_read_headers("content"), "name STRING, sha256 STRING, columns ARRAY<STRING>")


def archive_columns(archives: DataFrame) -> DataFrame:
    """``name`` and the CSV's ``columns`` of each archive, of which only the first block is read."""
    held = _held(archives)
    return archives.select("name", held).mapInArrow(_read_headers(held), "name STRING, columns ARRAY<STRING>")


def archive_digests(archives: DataFrame) -> DataFrame:
    """``name`` and ``sha256`` of each archive's bytes, which are streamed and not unpacked."""
    held = _held(archives)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [_opened(archive.as_py()).sha256() for archive in batch.column(held)]
            yield pa.RecordBatch.from_pydict({"name": batch.column("name"), "sha256": hashes})

    return archives.select("name", held).mapInArrow(digest, "name STRING, sha256 STRING")


def _read_headers(held: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [
                _header(name.as_py(), _opened(archive.as_py()))
                for name, archive in zip(batch.column("name"), batch.column(held))
            ]
            kept = [n for n in batch.schema.names if n != held]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(columns, pa.list_(pa.string()))],
                names=[*kept, "columns"],
            )

    return read


RECEIPT = "name STRING, sha256 STRING, rows BIGINT"


def _leave_receipt(folder: str, name: str, sha256: str, rows: int) -> None:
    """One small file about an archive read to its end. A task run again leaves another that says the same."""
    files, root = _located(folder)
    files.create_dir(root, recursive=True)
    number = uuid.uuid4().hex
    with files.open_output_stream(f"{root}/.{number}") as out:
        out.write(json.dumps({"name": name, "sha256": sha256, "rows": rows}).encode() + b"\n")
    files.move(f"{root}/.{number}", f"{root}/{number}.json")


def read_receipts(spark: SparkSession, folder: str) -> DataFrame:
    """``name``, ``sha256`` and ``rows`` of the archives whose tasks left receipts."""
    return spark.read.schema(RECEIPT).json(folder).distinct()


_ARROW_TYPES = {LongType(): pa.int64(), DoubleType(): pa.float64()}
# Texts Arrow reads as numbers in ways of its own (hexadecimal, not-a-number) are checked one by one.
_UNUSUAL = {LongType(): "[xX]", DoubleType(): "[nN]"}


def _typed(values: pa.Array, to: DataType, label: str) -> pa.Array:
    """A parsed column strictly cast, by the same rule as ``strict_cast``."""
    if to == StringType():
        return values
    if not pc.any(pc.match_substring_regex(values, _UNUSUAL[to])).as_py():
        try:
            return pc.cast(values, _ARROW_TYPES[to])
        except pa.ArrowInvalid:
            pass  # A plus sign, or a misfit to be named.
    misfits = values.filter(pc.invert(pc.match_substring_regex(values, ACCEPTED[to])))
    try:
        if len(misfits) == 0:
            return pc.cast(pc.replace_substring_regex(values, r"^\+", ""), _ARROW_TYPES[to])
    except pa.ArrowInvalid as overflow:
        raise ValueError(f"{label} does not fit {to.simpleString()}: {overflow}") from overflow
    raise ValueError(f"{label} does not fit {to.simpleString()}: {misfits[0].as_py()}")


def archive_rows(
    archives: DataFrame, schema: StructType, carry: Sequence[str] = ("name",), receipts: str | None = None
) -> DataFrame:
    """All rows of the archives in the schema's columns, led by the ``carry`` columns of their archive.

    Each archive must hold exactly the schema's columns, in any order, and each value must fit its
    type. The columns are cast while they lie parsed in the task, whole batches at a time. Drift and
    misfits raise there, so a write fed by this commits nothing. With ``receipts``, a folder, each archive's
    checksum and number of rows are left there once it has been read, see :func:`read_receipts`.
    """
    carry, held = list(carry), _held(archives)
    source = archives.select("name", held, *(c for c in carry if c != "name"))
    output = StructType([*(source.schema[c] for c in carry), *schema.fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            names, archives = rows.column("name"), rows.column(held)
            for i in range(rows.num_rows):
                name, archive, count = names[i].as_py(), _opened(archives[i].as_py()), 0
                for batch in _text_batches(name, archive, schema.names):
                    labels = [pa.repeat(rows.column(c)[i], batch.num_rows) for c in carry]
                    typed = [
                        _typed(values, field.dataType, f"{name}: {field.name}")
                        for values, field in zip(batch.columns, schema.fields)
                    ]
                    count += batch.num_rows
                    yield pa.RecordBatch.from_arrays([*labels, *typed], names=output.names)
                if receipts is not None:
                    _leave_receipt(receipts, name, archive.sha256(), count)

    return source.mapInArrow(read, output)


def all_strings(columns: Sequence[str]) -> StructType:
    """Schema keeping every column as it is written."""
    return StructType([StructField(c, StringType()) for c in columns])


def bare_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV outside an archive, by its own header and all strings; a ragged row raises when read."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"', mode="FAILFAST", inferSchema=False)
