"""CSV files read by many tasks although records may span lines.

A line end ends a record where the quotes before it are even in number, and whether they are depends on the whole file
before. So each byte range says how many quotes its lines hold, a prefix sum over the ranges of a file tells each whether
it starts within a quoted field, and then every range parses from its first record on. What belongs to a record
begun in an earlier range, and the beginning of one that goes on in the next, are handed on as text, put
together by place, and parsed as well: two pieces a range at most, however many lines a record has.

Quotes are doubled within quoted fields and stand nowhere else; a file whose quotes do not add up raises.
"""

from __future__ import annotations

import io
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PARSE_BYTES = 8 << 20
_LARGEST = (1 << 31) - 1


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``start`` of the byte range and ``line``, in order within a range."""
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    return spark.read.option("lineSep", "\n").text(path).select(*place, F.col("value").alias("line"))


def _parsed(text: str, columns: Sequence[str]) -> pa.RecordBatch:
    """Records as strings: an unquoted empty field is null, a quoted one an empty string."""
    table = pacsv.read_csv(
        io.BytesIO(text.encode()),
        read_options=pacsv.ReadOptions(column_names=list(columns), block_size=_LARGEST, use_threads=False),
        parse_options=pacsv.ParseOptions(newlines_in_values=True),
        convert_options=pacsv.ConvertOptions(
            column_types={c: pa.string() for c in columns},
            strings_can_be_null=True,
            quoted_strings_can_be_null=False,
            null_values=[""],
        ),
    )
    return table.combine_chunks().to_batches()[0] if table.num_rows else pa.RecordBatch.from_pylist([], table.schema)


class _Range:
    """The lines of a byte range as they come: whole records, and the pieces at its ends."""

    def __init__(self, quoted: bool, first: bool) -> None:
        self.quoted, self.skip = quoted, first
        self.head: str | None = "" if quoted else None
        self.open: list[str] = []

    def add(self, lines: pa.Array) -> str:
        """The text of records that end within ``lines``."""
        odd = (np.cumsum(pc.count_substring(lines, '"').to_numpy()) + self.quoted) % 2 == 1
        ends = np.flatnonzero(~odd)
        texts = lines.to_pylist()
        self.quoted = bool(odd[-1]) if len(odd) else self.quoted
        if not len(ends):
            self.open += texts
            return ""
        last = int(ends[-1]) + 1
        done, self.open, begin = [*self.open, *texts[:last]], texts[last:], 0
        before = len(done) - last
        first_end = int(ends[0]) + 1 + before
        if self.head is not None and self.head == "":
            self.head, begin = "\n".join(done[:first_end]), first_end
        if self.skip:
            # The file's first record is its header.
            begin, self.skip = first_end, False
        return "".join(f"{line}\n" for line in done[begin:])


def split_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All records of the CSV files at ``path`` as strings, by their header, like ``bare_csv``, read by a task per byte
    range (``spark.sql.files.maxPartitionBytes``). All files have the same header. Empty lines are no records."""
    if columns is None:
        columns = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False).columns
    lines = _lines(spark, path)
    quotes = F.sum(F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))).alias("quotes")
    ranges = lines.groupBy("file", "start").agg(quotes)
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    ranges = ranges.select(
        "file",
        "start",
        (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("quoted"),
        (F.col("start") == F.min("start").over(whole)).alias("first"),
        (F.sum("quotes").over(whole) % 2 == 1).alias("broken"),
    )
    broken = F.concat(F.lit("quotes do not add up in "), F.col("file"))
    ranges = ranges.withColumn("quoted", F.when(F.col("broken"), F.raise_error(broken).cast("boolean")).otherwise(F.col("quoted")))
    # A row per range, kept on every task: 128 MB of text each.
    starts = {(r.file, r.start): (r.quoted, r.first) for r in ranges.drop("broken").collect()}
    known = spark.sparkContext.broadcast(starts)
    fields = [StructField(f"c{i}", StringType()) for i in range(len(columns))]
    schema = StructType([*StructType.fromDDL("file string, start long, head string, tail string, piece boolean").fields, *fields])

    def rows(text: str) -> Iterator[pa.RecordBatch]:
        if text:
            batch = _parsed(text, schema.names[5:])
            nothing = [pa.nulls(batch.num_rows, t) for t in (pa.string(), pa.int64(), pa.string(), pa.string())]
            whole = pa.array([False] * batch.num_rows, pa.bool_())
            yield pa.RecordBatch.from_arrays([*nothing, whole, *batch.columns], names=schema.names)

    def ended(place: tuple[str, int], held: _Range) -> Iterator[pa.RecordBatch]:
        # Where no record ended, all of the range belongs to one begun before.
        tail = "\n".join(held.open) if held.open else None
        head = held.head
        if held.head == "":
            head, tail = tail, None
        through = held.head == ""
        row = {"file": [place[0]], "start": [place[1]], "head": [head], "tail": [tail], "piece": [True]}
        if head is not None or tail is not None:
            empty = {n: pa.nulls(1, pa.string()) for n in schema.names[5:]}
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
            values = [pa.array(v, t) for v, t in zip(row.values(), kinds, strict=True)]
            if through:
                values[3] = pa.nulls(1, pa.string())
            yield pa.RecordBatch.from_arrays([*values, *empty.values()], names=schema.names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, texts, size = None, None, [], 0
        for batch in batches:
            files, begins = batch.column("file").to_pylist(), batch.column("start").to_numpy()
            cuts = [0, *(i for i in range(1, len(files)) if begins[i] != begins[i - 1] or files[i] != files[i - 1]), len(files)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if place != (files[a], int(begins[a])):
                    if held is not None:
                        yield from rows("".join(texts))
                        yield from ended(place, held)
                        texts, size = [], 0
                    place = (files[a], int(begins[a]))
                    held = _Range(*known.value[place])
                texts.append(held.add(batch.column("line").slice(a, b - a)))
                size += len(texts[-1])
                if size > _PARSE_BYTES:
                    yield from rows("".join(texts))
                    texts, size = [], 0
        if held is not None:
            yield from rows("".join(texts))
            yield from ended(place, held)

    found = lines.mapInArrow(read, schema)
    # A tail and the heads after it, up to the next tail, are one record.
    pieces = found.where("piece").select("file", "start", "head", "tail")
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.last(F.when(F.col("tail").isNotNull(), F.col("start")), ignorenulls=True).over(earlier)
    heads = pieces.withColumn("record", opened).where("head IS NOT NULL").select("file", "record", "start", F.col("head").alias("text"))
    tails = pieces.where("tail IS NOT NULL").select("file", F.col("start").alias("record"), "start", F.col("tail").alias("text"))
    # At its own place a tail comes after the head that closed the record before, which has another ``record``.
    joined = heads.unionByName(tails).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("start", "text"))).alias("parts")
    )
    texts = joined.select(F.array_join(F.col("parts.text"), "\n").alias("text"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = "".join(f"{t}\n" for t in batch.column("text").to_pylist())
            if text:
                yield _parsed(text, schema.names[5:])

    records = found.where("NOT piece").select(*schema.names[5:]).unionAll(texts.mapInArrow(parse, StructType(fields)))
    return records.toDF(*columns)
