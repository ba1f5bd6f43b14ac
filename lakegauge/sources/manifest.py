"""The manifest: one ``name=url`` line per published archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakegauge.functions.names import direct_address, name_playoffs, name_season, name_source

# Every line ending a text editor or an HTTP body may use.
_LINE_END = r"\r\n|[\n\r\x0B\f\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]"
_OUTER_BLANKS = r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$"


class ManifestError(ValueError):
    """A manifest line that is malformed or repeats a name."""


def manifest_lines(spark: SparkSession, path: str) -> DataFrame:
    """Numbered lines (``line_no`` from 1, ``line``) of a manifest file."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.posexplode(F.split("value", _LINE_END)).alias("line_no", "line")).select(
        (F.col("line_no") + 1).alias("line_no"), "line"
    )


def manifest_entries(lines: DataFrame) -> DataFrame:
    """Entries (``line_no``, ``line``, ``name``, ``url``) of the lines that are not blank or comments.

    The first ``=`` separates, since an address may hold more. Name and url are null where malformed.
    """

    def strip(text: Column) -> Column:
        return F.regexp_replace(text, _OUTER_BLANKS, "")

    bare = lines.select("line_no", "line", strip(F.col("line")).alias("__bare"))
    bare = bare.where((F.col("__bare") != "") & ~F.col("__bare").startswith("#"))
    cut = F.instr("__bare", "=")
    name = strip(F.expr("left(__bare, instr(__bare, '=') - 1)"))
    url = strip(F.expr("substring(__bare, instr(__bare, '=') + 1)"))
    well_formed = (cut > 0) & (name != "") & (url != "")
    return bare.select(
        "line_no",
        "line",
        F.when(well_formed, name).alias("name"),
        F.when(well_formed, direct_address(url)).alias("url"),
    )


def manifest_faults(entries: DataFrame) -> DataFrame:
    """Lines (``line_no``, ``fault``) that are malformed or repeat an earlier name."""
    malformed = entries.where(F.col("name").isNull()).select(
        "line_no", F.concat(F.lit("lacks a name or an address: "), "line").alias("fault")
    )
    named = entries.where(F.col("name").isNotNull())
    # The line reported is the second one holding the name; tasks keep two lines per name.
    in_order = Window.partitionBy("name").orderBy("line_no")
    ranked = named.select("name", "line_no", F.row_number().over(in_order).alias("__nth"))
    repeated = ranked.where(F.col("__nth") == 2).select(
        "line_no", F.concat(F.lit("repeats the name "), "name").alias("fault")
    )
    return malformed.unionAll(repeated)


def with_name_parts(frame: DataFrame) -> DataFrame:
    """Add ``source``, ``season`` and ``playoffs`` read from the ``name`` column."""
    name = F.col("name")
    return frame.select(
        "*",
        name_source(name).alias("source"),
        name_season(name).alias("season"),
        name_playoffs(name).alias("playoffs"),
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Checked manifest table (``name``, ``url``, ``source``, ``season``, ``playoffs``).

    The first faulty line raises with its number.
    """
    entries = manifest_entries(manifest_lines(spark, path))
    fault = manifest_faults(entries).orderBy("line_no").first()
    if fault is not None:
        raise ManifestError(f"manifest line {fault.line_no} {fault.fault}")
    return with_name_parts(entries.select("name", "url"))
