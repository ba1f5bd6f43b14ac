"""Load jobs: archives in the raw folder become partitions of tables.

* :func:`capture` keeps every column a string and skips datasets that have already landed.
* :func:`load_bronze` writes strictly typed rows and always rewrites.

Each loads any number of datasets with one job per source, so archives are read in parallel. Names and declared
sources are checked up front. An archive is opened once: its header, rows and checksum come from the same bytes, its
rows are written aside, and only when every checksum has been held against what is known of it are they published.
Fetching archives over the network is left to whatever fills the raw folder.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PythonException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakegauge.layout import PARTITION_COLUMNS, Lake
from lakegauge.operators.drift import SchemaDrift, require_no_drift
from lakegauge.schemas import SCHEMAS
from lakegauge.scratch import scratch_dir, scratch_root
from lakegauge.sinks.partitions import append_rows, replace_with_empty
from lakegauge.sinks.published import Written, discard, publish, write_aside
from lakegauge.sources.archives import (
    all_strings,
    archive_columns,
    archive_headers,
    archive_rows,
    open_archives,
    read_receipts,
    streams,
)
from lakegauge.sources.manifest import with_name_parts
from lakegauge.sources.folders import data_folders
from lakegauge.sources.tables import landed_partitions

_DATASET = ["source", *PARTITION_COLUMNS]


# --- checksums ---------------------------------------------------------------


def archive_checksums(archives: DataFrame) -> DataFrame:
    """``name`` and ``sha256`` of each archive's bytes."""
    return archives.select("name", F.sha2("content", 256).alias("sha256"))


def recorded_checksums(spark: SparkSession, path: str) -> DataFrame:
    """Latest checksum on record per name; empty before the first load."""
    # The table only ever grows, so readers and writers do not get in each other's way.
    schema = "name STRING, sha256 STRING, recorded_at TIMESTAMP"
    if _exists(spark, path):
        entries = spark.read.schema(schema).parquet(path)
    else:
        entries = spark.createDataFrame([], schema)
    return entries.groupBy("name").agg(F.max_by("sha256", F.struct("recorded_at", "sha256")).alias("sha256"))


def _exists(spark: SparkSession, path: str) -> bool:
    return not data_folders(spark, path).isEmpty()


def sidecar_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """Checksums kept as ``<archive>.sha256`` files beside the archives."""
    files = spark.read.option("pathGlobFilter", "*.tar.xz.sha256").text(folder, wholetext=True)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.tar\.xz\.sha256$", 1)
    return files.select(name.alias("name"), F.trim(F.regexp_replace("value", r"\s+", "")).alias("sha256"))


def checksum_status(actual: DataFrame, recorded: DataFrame) -> DataFrame:
    """``valid`` where the recorded checksum equals the archive's, ``stale`` where it differs and
    ``unrecorded`` where there is none. Both inputs hold each name once."""
    known = recorded.select(F.col("name").alias("__name"), F.col("sha256").alias("__recorded"))
    joined = actual.join(known, F.col("name") == F.col("__name"), "left")
    status = (
        F.when(F.col("__recorded").isNull(), "unrecorded")
        .when(F.col("__recorded") == F.col("sha256"), "valid")
        .otherwise("stale")
    )
    return joined.select("name", "sha256", F.col("__recorded").alias("recorded"), status.alias("status"))


# --- selection ---------------------------------------------------------------


def pending(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Manifest entries whose dataset has no landed partition. ``landed`` may repeat partitions."""
    held = landed.select(*(F.col(c).alias(f"__{c}") for c in _DATASET)).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in _DATASET]
    return manifest.join(held, same, "left_anti")


def _chosen(archives: DataFrame, folder: str, names: Sequence[str] | None) -> DataFrame:
    """The archives asked for; all of them by default."""
    if names is None:
        return archives
    wanted = sorted(set(names))
    asked = archives.sparkSession.createDataFrame([(n,) for n in wanted], "name STRING")
    _require_present(asked, archives, folder)
    return archives.where(F.col("name").isin(wanted))


def _require_present(asked: DataFrame, archives: DataFrame, folder: str) -> None:
    absent = [r.name for r in asked.join(archives.select("name"), "name", "left_anti").orderBy("name").limit(5).collect()]
    if absent:
        raise FileNotFoundError(f"no archive under {folder} for: {', '.join(absent)}")


def _inspect(spark: SparkSession, archives: DataFrame) -> DataFrame:
    """Headers and checksums, read once and kept for the checks and the ledger."""
    path = scratch_dir(spark, "headers")
    headers = archive_headers(archives)
    headers.write.parquet(path)
    return spark.read.schema(headers.schema).parquet(path)


def _require_intact(headers: DataFrame, recorded: DataFrame, kept: str = "recorded checksum") -> None:
    stale = checksum_status(headers, recorded).where(F.col("status") == "stale")
    names = [r.name for r in stale.orderBy("name").limit(5).collect()]
    if names:
        raise ValueError(f"archives differ from their {kept}: {', '.join(names)}")


def _require_listed(names: DataFrame, manifest: DataFrame) -> None:
    unknown = [r.name for r in names.join(manifest, "name", "left_anti").orderBy("name").limit(5).collect()]
    if unknown:
        raise KeyError(f"not in the manifest: {', '.join(unknown)}")


# --- writing -----------------------------------------------------------------


# What each row keeps of its archive: worked out once per archive, not per row.
_CARRIED = ["name", *PARTITION_COLUMNS]


def dataset_rows(archives: DataFrame, schema: StructType, receipts: str | None = None) -> DataFrame:
    """Rows of archives holding exactly the schema's columns, strictly typed and led by ``name``,
    ``season`` and ``playoffs``."""
    return archive_rows(with_name_parts(archives), schema, _CARRIED, receipts)


@dataclass(frozen=True)
class _Loaded:
    """Datasets lying aside with their rows."""

    written: Written
    outcome: DataFrame


def _write_datasets_aside(rows: DataFrame, path: str, datasets: DataFrame) -> _Loaded:
    """Write ``rows`` (led by ``name`` and its partition) beside the table; the outcome is ``datasets`` with the ``rows``
    each will hold.

    The rows handed to the writer are counted on the way; unless exactly as many lie in the
    partitions afterwards, the load raises.
    """
    seen = Observation()
    stored = rows.drop("name")
    try:
        written = write_aside(stored.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    except PythonException as failed:
        drift = re.search(r"ValueError: (.*): columns drift: (missing=.*)", str(failed))
        if drift:
            raise SchemaDrift(f"{drift[1]}: {drift[2]}") from failed
        raise

    handed = seen.get["rows"]
    held = _held(stored, written.aside, datasets)
    for empty in held.where("rows IS NULL").collect():
        # Rare: a CSV without rows touches no partition, so an older load of it would live on.
        replace_with_empty(stored, written.aside, empty.season, empty.playoffs)
    # A record of this load, one row per dataset, in the scratch folder: it does not follow later changes of the table.
    kept = scratch_dir(datasets.sparkSession, "outcome")
    held.select(*datasets.columns, F.coalesce("rows", F.lit(0)).alias("rows")).write.parquet(kept)
    outcome = datasets.sparkSession.read.parquet(kept)
    partitions = outcome.select(*PARTITION_COLUMNS, "rows").distinct()
    found = partitions.agg(F.sum("rows")).first()[0] or 0
    if found != handed:
        raise RuntimeError(f"{path}: {handed} rows read but {found} found after the write")
    return _Loaded(written, outcome)


def write_datasets(rows: DataFrame, path: str, datasets: DataFrame) -> DataFrame:
    """Write ``rows`` (led by ``name`` and its partition) in place of what the table holds in their partitions, in one
    step, and return ``datasets`` with the ``rows`` each now holds."""
    loaded = _write_datasets_aside(rows, path, datasets)
    publish(datasets.sparkSession, loaded.written)
    return loaded.outcome


def _held(stored: DataFrame, path: str, datasets: DataFrame) -> DataFrame:
    """``datasets`` with the rows their partitions hold, counted from file footers."""
    table = datasets.sparkSession.read.schema(stored.schema).parquet(path)
    counts = table.groupBy(*(F.col(c).alias(f"__{c}") for c in PARTITION_COLUMNS)).agg(
        F.count(F.lit(1)).alias("rows")
    )
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in PARTITION_COLUMNS]
    return datasets.join(counts, same, "left").select(*datasets.columns, "rows")


def _finish(results: list[DataFrame], headers: DataFrame, ledger: str) -> DataFrame:
    """Record the checksums of what was loaded, once all of it is in place, and give the outcome."""
    append_rows(headers.select("name", "sha256", F.current_timestamp().alias("recorded_at")), ledger)
    outcome = reduce(DataFrame.unionByName, results).join(headers.select("name", "sha256"), "name")
    return outcome.select("name", *_DATASET, "sha256", F.coalesce("rows", F.lit(0)).alias("rows"))


def _receipts_folder(spark: SparkSession, archives: DataFrame) -> str | None:
    """Where tasks leave receipts, if they open the archives themselves and can write there."""
    opened_by_tasks = "content" not in archives.columns and streams(scratch_root(spark))
    return scratch_dir(spark, "receipts") if opened_by_tasks else None


def _checksums(spark: SparkSession, archives: DataFrame, receipts: str | None) -> DataFrame:
    """``name`` and ``sha256`` of the archives read."""
    if receipts is None:
        return archive_checksums(archives)
    found = read_receipts(spark, receipts)
    changed = found.groupBy("name").count().where("count > 1").orderBy("name").limit(5).collect()
    if changed:
        raise RuntimeError(f"archives changed while they were read: {', '.join(r.name for r in changed)}")
    return found.select("name", "sha256")


def load_typed(
    spark: SparkSession,
    *,
    raw: str,
    ledger: str,
    schemas: Mapping[str, StructType],
    target: Mapping[str, str],
    names: Sequence[str] | None = None,
    force: bool = False,
    manifest: DataFrame | None = None,
) -> DataFrame:
    """Typed load of the archives in ``raw``, each source to its ``target`` with its own schema.

    Returns one row per dataset: ``name``, ``source``, ``season``, ``playoffs``, ``sha256``, ``rows``.
    ``force`` accepts archives whose bytes have changed since they were recorded; one that differs
    from the checksum file beside it is never accepted. With a ``manifest``, only its names are.
    """
    archives = _chosen(open_archives(spark, raw), raw, names)
    listed = with_name_parts(archives.select("name"))
    for row in listed.where(~F.col("source").isin(list(schemas))).orderBy("name").limit(1).collect():
        raise KeyError(f"{row.name}: {row.source!r} has no declared schema; declared: {', '.join(sorted(schemas))}")
    sources = sorted(r.source for r in listed.select("source").distinct().collect())
    if not sources:
        raise FileNotFoundError(f"no archives under {raw}")
    if manifest is not None:
        _require_listed(listed.select("name"), manifest)

    receipts = _receipts_folder(spark, archives)
    if receipts is None and "content" in archives.columns:
        # Read beforehand: the archives come as cells, and a drift is then found before any is parsed.
        headers = _inspect(spark, archives)
        _check_checksums(spark, headers, raw, ledger, force)
        parts = with_name_parts(headers.select("name", "columns"))
        for source in sources:
            require_no_drift(parts.where(F.col("source") == source), schemas[source].names)
    loaded: list[_Loaded] = []
    with _nothing_left(spark, loaded):
        for source in sources:
            own = with_name_parts(archives).where(F.col("source") == source).select(*archives.columns)
            datasets = with_name_parts(own.select("name"))
            loaded.append(_write_datasets_aside(dataset_rows(own, schemas[source], receipts), target[source], datasets))
        checksums = _checksums(spark, archives, receipts)
        _check_checksums(spark, checksums, raw, ledger, force)
    return _publish(spark, loaded, checksums, ledger)


def _check_checksums(spark: SparkSession, headers: DataFrame, raw: str, ledger: str, force: bool) -> None:
    _require_intact(headers, sidecar_checksums(spark, raw), "checksum file")
    if not force:
        _require_intact(headers, recorded_checksums(spark, ledger))


@contextmanager
def _nothing_left(spark: SparkSession, loaded: list[_Loaded]) -> Iterator[None]:
    """Takes away what lies aside if anything goes wrong before it is published."""
    try:
        yield
    except BaseException:
        for part in loaded:
            discard(spark, part.written)
        raise


def _publish(spark: SparkSession, loaded: list[_Loaded], checksums: DataFrame, ledger: str) -> DataFrame:
    for part in loaded:
        publish(spark, part.written)
    return _finish([part.outcome for part in loaded], checksums, ledger)


def load_bronze(
    spark: SparkSession,
    lake: Lake,
    names: Sequence[str] | None = None,
    force: bool = False,
    manifest: DataFrame | None = None,
) -> DataFrame:
    """Typed load of the raw archives into the bronze zone; see :func:`load_typed`."""
    return load_typed(
        spark,
        raw=lake.raw,
        ledger=lake.checksums,
        schemas=SCHEMAS,
        target={source: lake.bronze(source) for source in SCHEMAS},
        names=names,
        force=force,
        manifest=manifest,
    )


def capture(
    spark: SparkSession,
    lake: Lake,
    manifest: DataFrame,
    names: Sequence[str] | None = None,
    force: bool = False,
) -> DataFrame:
    """Lossless all-string load of manifest datasets that have not landed yet.

    Returns one row per dataset asked for: ``name``, ``url``, ``source``, ``season``, ``playoffs``,
    ``sha256``, ``skipped`` and ``rows`` (null where skipped). ``force`` loads them all again.
    """
    wanted = manifest
    if names is not None:
        asked = spark.createDataFrame([(n,) for n in sorted(set(names))], "name STRING")
        _require_listed(asked, manifest)
        wanted = manifest.join(asked, "name", "left_semi")
    todo = wanted if force else pending(wanted, landed_partitions(spark, lake.capture))
    entries = wanted.select("name", "url", *_DATASET)
    if todo.isEmpty():
        known = recorded_checksums(spark, lake.checksums)
        return entries.join(known, "name", "left").select(
            *entries.columns, "sha256", F.lit(True).alias("skipped"), F.lit(None).cast("bigint").alias("rows")
        )

    # Chosen by a join with the manifest: their names stay off the driver.
    names = scratch_dir(spark, "pending")
    todo.select("name").distinct().write.parquet(names)
    todo = spark.read.schema("name STRING").parquet(names)
    archives = open_archives(spark, lake.raw).join(todo, "name", "left_semi")
    _require_present(todo, archives, lake.raw)
    # The columns decide which archives a job takes, so headers are read first: a block of each archive.
    path = scratch_dir(spark, "columns")
    archive_columns(archives).write.parquet(path)
    columns = spark.read.schema("name STRING, columns ARRAY<STRING>").parquet(path)
    repeating = columns.where(F.size(F.array_distinct("columns")) < F.size("columns"))
    for r in repeating.orderBy("name").limit(1).collect():
        raise ValueError(f"{r.name}: the header repeats a column: {r.columns}")
    # One job for all archives of a source with the same columns, whatever their order.
    kinds = with_name_parts(columns).withColumn("kind", F.array_sort("columns"))
    receipts = _receipts_folder(spark, archives)
    by_columns = kinds.groupBy("source", "kind").agg(F.min_by("columns", "name").alias("columns"))
    loaded: list[_Loaded] = []
    with _nothing_left(spark, loaded):
        for kind in by_columns.orderBy("source", "kind").collect():
            chosen = kinds.where((F.col("source") == kind.source) & (F.col("kind") == F.lit(kind.kind))).select("name")
            own = archives.join(chosen, "name", "left_semi")
            datasets = with_name_parts(own.select("name"))
            rows = dataset_rows(own, all_strings(kind.columns), receipts)
            loaded.append(_write_datasets_aside(rows, lake.captured(kind.source), datasets))
        checksums = _checksums(spark, archives, receipts)
        _check_checksums(spark, checksums, lake.raw, lake.checksums, force)
    outcome = _publish(spark, loaded, checksums, lake.checksums)
    loaded = outcome.select("name", F.col("rows").alias("__loaded"))
    known = recorded_checksums(spark, lake.checksums)
    outcome = entries.join(known, "name", "left").join(loaded, "name", "left")
    return outcome.select(
        *entries.columns, "sha256", F.col("__loaded").isNull().alias("skipped"), F.col("__loaded").alias("rows")
    )

