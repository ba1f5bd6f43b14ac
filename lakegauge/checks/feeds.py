"""Feeds, archives and lakes that Spark derives from the given tables, for the queries to load."""

from __future__ import annotations

import io
import lzma
import shutil
import sys
import tarfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.layout import PARTITION_COLUMNS, Lake
from lakegauge.schemas import schema_for
from lakegauge.scratch import scratch_dir
from lakegauge.sinks.partitions import replace_partitions
from lakegauge.sources.archives import _located

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows a task buffers before it closes its archives.
_BUFFER_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _archive(name: str, rows: pa.Table) -> bytes:
    text = io.BytesIO()
    pacsv.write_csv(rows, text)
    packed = io.BytesIO()
    with tarfile.open(fileobj=packed, mode="w:xz", preset=0) as tar:
        member = tarfile.TarInfo(f"{name}.csv")
        member.size = text.tell()
        text.seek(0)
        tar.addfile(member, text)
    return packed.getvalue()


def pack_archives(frame: DataFrame) -> DataFrame:
    """Archives (``name``, ``content``) of all rows of ``frame``, one CSV per ``name`` and buffer.

    Written out once, since packing is the dear part and several readers follow.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held)
            held.clear()
            for name in pc.unique(rows["name"]).to_pylist():
                mine = rows.filter(pc.equal(rows["name"], name)).drop_columns(["name"])
                yield pa.RecordBatch.from_pydict({"name": [name], "content": [_archive(name, mine)]})

        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) > _BUFFER_BYTES:
                yield from close()
        if held:
            yield from close()

    path = scratch_dir(frame.sparkSession, "archives")
    frame.mapInArrow(pack, "name STRING, content BINARY").write.parquet(path)
    return frame.sparkSession.read.schema("name STRING, content BINARY").parquet(path)


def drop_archives(frame: DataFrame, folder: str) -> None:
    """Write one ``<name>.tar.xz`` per ``name`` of ``frame`` into ``folder``.

    Tasks pack the rows they read, a buffer at a time, into parts: each the lines of one archive as an xz stream of its
    own. One task per archive then strings its parts together between the tar header and the tar's end, so neither an
    archive's rows nor its CSV are ever held whole.
    """
    spark = frame.sparkSession
    parts = scratch_dir(spark, "archive-parts")
    heading = io.BytesIO()
    pacsv.write_csv(pa.table({c: pa.array([], pa.string()) for c in frame.columns if c != "name"}), heading)
    heading = heading.getvalue()

    def write_parts(rows: pa.Table, first: str) -> pa.RecordBatch:
        target, root = _located(parts)
        target.create_dir(root, recursive=True)
        out = {"name": [], "part": [], "size": []}
        for name in pc.unique(rows["name"]).to_pylist():
            own = pc.is_null(rows["name"]) if name is None else pc.equal(rows["name"], name)
            part = f"{root}/{first}-{len(out['part']):06d}-{uuid.uuid4().hex}"
            with target.open_output_stream(part) as file, lzma.open(file, "wb", preset=0) as packed:
                pacsv.write_csv(rows.filter(own).drop_columns(["name"]), packed, pacsv.WriteOptions(include_header=False))
                out["size"].append(packed.tell())
            out["name"].append(name)
            out["part"].append(part)
        return pa.RecordBatch.from_pydict(out, _PARTS)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for rows in _buffers(batches):
            yield write_parts(rows, f"{task:06d}-{number:06d}")
            number += 1

    def drop(found: pa.Table) -> pa.Table:
        name = found["name"][0].as_py()
        source, _ = _located(parts)
        target, root = _located(folder)
        target.create_dir(root, recursive=True)
        member = tarfile.TarInfo(f"{name}.csv")
        member.size = len(heading) + pc.sum(found["size"]).as_py()
        # A task run again writes the same bytes; the last move wins.
        unfinished = f"{root}/.{name}-{uuid.uuid4().hex}"
        with target.open_output_stream(unfinished) as out:
            out.write(lzma.compress(member.tobuf() + heading, preset=0))
            for part in sorted(found["part"].to_pylist()):
                with source.open_input_stream(part) as packed:
                    shutil.copyfileobj(packed, out, 1 << 20)
            # Zeros up to a whole block, and two blocks of them.
            out.write(lzma.compress(bytes(-member.size % tarfile.BLOCKSIZE + 2 * tarfile.BLOCKSIZE), preset=0))
        target.move(unfinished, f"{root}/{name}.tar.xz")
        return pa.table({"name": [name]}, schema=pa.schema([_PARTS.field("name")]))

    # Written down: the parts of a task that is run again are others.
    listed = scratch_dir(spark, "archive-part-list")
    ddl = "name STRING, part STRING, size BIGINT"
    frame.mapInArrow(pack, ddl).write.parquet(listed)
    found = spark.read.schema(ddl).parquet(listed)
    found.groupBy("name").applyInArrow(drop, "name STRING").write.format("noop").mode("overwrite").save()


_PARTS = pa.schema([("name", pa.string()), ("part", pa.string()), ("size", pa.int64())])


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches of a task, gathered until they fill a buffer."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size > _BUFFER_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def named(feed: DataFrame, source: str) -> DataFrame:
    """A feed's rows led by the ``name`` of their dataset in place of its partition."""
    marker = F.when(F.col("playoffs"), "_po_").otherwise("_")
    name = F.concat(F.lit(source), marker, F.col("season").cast("string"))
    return feed.select(name.alias("name"), *(c for c in feed.columns if c not in PARTITION_COLUMNS))


def new_lake(spark: SparkSession) -> Lake:
    return Lake(scratch_dir(spark, "lake"))


def year(moment: str) -> Column:
    return F.year(moment).cast("bigint")


def _feed(frame: DataFrame, source: str, **known: Column) -> DataFrame:
    """A feed with all declared columns, those not ``known`` being null."""
    columns = [
        known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema_for(source).fields
    ]
    return frame.select(*columns, known["season"].alias("season"), known["playoffs"].alias("playoffs"))


def land(feed: DataFrame, path: str) -> None:
    """Write a feed by partition. Rebalancing keeps files few and splits a season holding most rows."""
    replace_partitions(feed.hint("rebalance", "season", "playoffs"), path)


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as events of the main feed, urgent ones as playoffs."""
    return _feed(
        table(spark, sf_dir, "orders"),
        "nbastats",
        GAME_ID=F.col("o_orderkey").cast("string"),
        EVENTNUM=F.col("o_custkey") % 7 + 1,
        season=year("o_orderdate"),
        playoffs=F.col("o_orderpriority") == "1-URGENT",
    )


def bronze_lake(spark: SparkSession, sf_dir: str, *sources: str) -> Lake:
    """A lake with the given feeds landed: orders stand for the event feed's games and urgent ones
    for playoffs; line items stand for shots, player pairs and the parallel feed's events."""
    lake = new_lake(spark)
    items = table(spark, sf_dir, "lineitem")
    regular = F.lit(False)
    feeds = {
        "nbastats": lambda: event_feed(spark, sf_dir),
        "shotdetail": lambda: _feed(
            items,
            "shotdetail",
            GAME_ID=F.col("l_orderkey").cast("string"),
            GAME_EVENT_ID=F.col("l_linenumber"),
            season=year("l_shipdate"),
            playoffs=regular,
        ),
        "matchups": lambda: _feed(
            items,
            "matchups",
            game_id=F.col("l_orderkey").cast("string"),
            person_id=F.col("l_partkey"),
            matchups_person_id=F.col("l_suppkey"),
            season=year("l_shipdate"),
            playoffs=regular,
        ),
        "datanba": lambda: _feed(
            items,
            "datanba",
            GAME_ID=F.col("l_orderkey").cast("string"),
            pid=F.when(F.col("l_returnflag") != "A", F.col("l_partkey")),
            season=year("l_shipdate"),
            playoffs=regular,
        ),
    }
    for source in sources:
        land(feeds[source](), lake.bronze(source))
    return lake
