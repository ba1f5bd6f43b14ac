"""Reading what has landed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructType

from lakegauge.functions.columns import column
from lakegauge.layout import Lake
from lakegauge.schemas import schema_for
from lakegauge.sources.folders import data_folders
from lakegauge.sinks.published import RECORD, RECORDS, is_live


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def folder_exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def landed_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """(``source``, ``season``, ``playoffs``) partitions holding data under ``<folder>/<source>/``: published, or never
    subject to publishing."""
    pattern = r"/([^/]+)/(season=([^/]+)/playoffs=(true|false))$"
    names = ("source", "partition", "season", "playoffs")
    found = data_folders(spark, folder).select(
        *(F.regexp_extract("folder", pattern, i + 1).alias(n) for i, n in enumerate(names)), "versions"
    )
    found = found.where("source <> ''")
    if folder_exists(spark, f"{folder}/{RECORDS}"):
        records = spark.read.schema(RECORD).json(f"{folder}/{RECORDS}/*")
        origin = F.regexp_extract("_metadata.file_path", r"/([^/]+)/[^/]+$", 1)
        live = records.select(origin.alias("source"), "load", "partition", F.col("version").alias("live"))
        latest = live.groupBy("source").agg(F.max("load").alias("load"))
        live = live.join(latest, ["source", "load"]).drop("load")
        found = found.join(live, ["source", "partition"], "left")
    else:
        found = found.withColumn("live", F.lit(None).cast("string"))
    return found.where("array_contains(versions, coalesce(live, ''))").select(
        "source", F.col("season").try_cast("bigint").alias("season"), (F.col("playoffs") == "true").alias("playoffs")
    )


def read_bronze(
    spark: SparkSession,
    lake: Lake,
    source: str,
    columns: Sequence[str],
    seasons: Sequence[int],
) -> DataFrame:
    """``season`` and the named columns of a source's regular seasons.

    Only the seasons' own folders are listed and only the named columns are read. A season that has
    not been loaded raises.
    """
    root = lake.bronze(source)
    schema = StructType(list(schema_for(source).fields))
    schema = schema.add("season", LongType()).add("playoffs", BooleanType())
    leaves = [f"{root}/season={season}/playoffs=false" for season in seasons]
    reader = spark.read.schema(schema).option("basePath", root)
    try:
        table = reader.parquet(*leaves)
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        wanted = ", ".join(f"{source}_{season}" for season in seasons)
        raise FileNotFoundError(f"not all of {wanted} are under {root}; run load_bronze on them first") from error
    return table.where(is_live(spark, root)).select("season", *map(column, columns))
