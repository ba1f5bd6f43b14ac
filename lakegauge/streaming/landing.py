"""Continuous form of the typed load: archives are picked up as they land."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakegauge.layout import Lake
from lakegauge.plans.loads import (
    _DATASET,
    _checksums,
    _receipts_folder,
    _write_datasets_aside,
    dataset_rows,
    recorded_checksums,
)
from lakegauge.schemas import SCHEMAS
from lakegauge.scratch import scratch_dir
from lakegauge.sinks.partitions import append_rows
from lakegauge.sinks.published import publish
from lakegauge.sources.archives import SUFFIX, archive_digests, archive_name, streams
from lakegauge.sources.manifest import with_name_parts
from lakegauge.streaming.listing import changed_archives


def _load_batch(files: DataFrame, lake: Lake) -> None:
    """Typed load of archives. Loading them again replaces the same partitions with the same rows."""
    spark = files.sparkSession
    listed = with_name_parts(files)
    sources = sorted(r.source for r in listed.select("source").distinct().collect())
    if not sources:
        return
    unknown = [s for s in sources if s not in SCHEMAS]
    if unknown:
        raise KeyError(f"no declared schema for: {', '.join(unknown)}")
    receipts = _receipts_folder(spark, files)
    loaded = []
    for source in sources:
        own = listed.where(F.col("source") == source)
        datasets = own.select("name", *_DATASET)
        rows = dataset_rows(own.select(*files.columns), SCHEMAS[source], receipts)
        loaded.append(_write_datasets_aside(rows, lake.bronze(source), datasets))
    checksums = _checksums(spark, files, receipts)
    for part in loaded:
        publish(spark, part.written)
    append_rows(checksums.select("name", "sha256", F.current_timestamp().alias("recorded_at")), lake.checksums)


def _load_changed(files: DataFrame, lake: Lake, per_load: int) -> None:
    """Load those of the archives handed on whose bytes are not the ones loaded last, at most about ``per_load`` at once.

    Only archives that have been loaded before are opened to find out; new ones are opened once, by their load.
    """
    spark = files.sparkSession
    # Written down: reading the stream's batch again would run its state again.
    path = scratch_dir(spark, "changed-archives")
    files.select("name", "path").write.parquet(path)
    changed = spark.read.schema("name STRING, path STRING").parquet(path)
    ledger = recorded_checksums(spark, lake.checksums)
    met = archive_digests(changed.join(ledger, "name", "left_semi"))
    same = met.join(ledger, ["name", "sha256"], "left_semi").select("name")
    path = scratch_dir(spark, "archives-to-load")
    changed.join(same, "name", "left_anti").write.parquet(path)
    todo = spark.read.schema("name STRING, path STRING").parquet(path)
    total = todo.count()
    loads = -(-total // per_load)
    for at in range(loads):
        _load_batch(todo.where(F.pmod(F.xxhash64("name"), F.lit(loads)) == at), lake)


def load_new_archives(
    spark: SparkSession,
    lake: Lake,
    checkpoint: str | None = None,
    max_files_per_batch: int = 1000,
    until_caught_up: bool = True,
    every: str = "1 minute",
) -> StreamingQuery:
    """Start loading archives that land in the raw folder; a restart resumes from ``checkpoint``.

    With ``until_caught_up`` the query ends once all archives present have been loaded, otherwise it
    keeps looking. An archive replaced under the same name is loaded again if its bytes have changed. At most about
    ``max_files_per_batch`` archives are loaded and published at once.

    Where Python tasks cannot open the store, Spark's own file stream is used, which does not pick a
    replaced archive up again; use ``load_bronze`` for that.
    """
    if streams(lake.raw):
        stream = changed_archives(spark, lake.raw)

        def load(files: DataFrame, _: int) -> None:
            _load_changed(files, lake, max_files_per_batch)

    else:
        stream = (
            spark.readStream.format("binaryFile")
            .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
            .option("pathGlobFilter", f"*{SUFFIX}")
            .option("maxFilesPerTrigger", max_files_per_batch)
            .load(lake.raw)
        )

        def load(files: DataFrame, _: int) -> None:
            _load_batch(files.select(archive_name(), "content"), lake)

    writer = stream.writeStream.foreachBatch(load).option(
        "checkpointLocation", checkpoint or f"{lake.base}/_stream/bronze"
    )
    trigger = {"availableNow": True} if until_caught_up else {"processingTime": every}
    return writer.trigger(**trigger).start()
