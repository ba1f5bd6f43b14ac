"""SQL views over the published zones: one database per zone, one view per table.

Views read the folder they are defined over, so a partition landed later is seen without a rebuild,
and a rebuild touches no data. Nothing in the databases is unique to them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lakegauge.layout import Lake
from lakegauge.schemas import SCHEMAS
from lakegauge.sinks.published import RESTRICTED, Files, live_sql
from lakegauge.sources.folders import data_folders

# Published zones, by name. A zone is left unpublished by not being listed.
ZONES = ("bronze", "silver", "gold")

_MARK = "lakegauge.lake"


@dataclass(frozen=True)
class Rebuild:
    """Databases made, and the planned views that were and were not created."""

    databases: tuple[str, ...]
    created: tuple[str, ...]
    skipped: tuple[str, ...]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _entries(spark: SparkSession, lake: Lake) -> DataFrame:
    """(``zone``, ``entry``) of the folders and files directly under the published zones that hold
    data; in bronze only data with a season counts."""
    listings = []
    for zone in ZONES:
        folders = data_folders(spark, lake.zone(zone))
        pattern = "^([^/]+)/season=[0-9]+(?:/|$)" if zone == "bronze" else "^([^/]+)"
        entry = F.regexp_extract("inside", pattern, 1).alias("entry")
        listings.append(folders.select(F.lit(zone).alias("zone"), entry))
        if zone != "bronze":
            # Files lying in the zone itself are views of their own.
            names = Files(spark, lake.zone(zone)).plain(lake.zone(zone))
            single = [(zone, name) for name in names if name.endswith(".parquet") and name[0] not in "._"]
            listings.append(spark.createDataFrame(single, "zone STRING, entry STRING"))
    return reduce(DataFrame.unionAll, listings).where("entry <> ''").distinct()


def planned_views(spark: SparkSession, lake: Lake) -> DataFrame:
    """``zone``, ``name``, ``path``, ``present`` of every view a rebuild considers; changes nothing.

    Bronze plans one view per declared source, landed or not. An undeclared folder gets no view, and
    neither does a dataset without a season. Silver and gold plan what lies in the zone, a folder or
    a single ``<name>.parquet``.
    """
    found = {(r.zone, r.entry) for r in _entries(spark, lake).collect()}
    plan = [("bronze", s, lake.bronze(s), ("bronze", s) in found) for s in sorted(SCHEMAS)]
    for zone, entry in sorted(found):
        if zone != "bronze":
            plan.append((zone, entry.removesuffix(".parquet"), f"{lake.zone(zone)}/{entry}", True))
    return spark.createDataFrame(plan, "zone STRING, name STRING, path STRING, present BOOLEAN")


def _view_sql(spark: SparkSession, database: str, zone: str, name: str, path: str) -> str:
    files = f"parquet.{_quoted(path)}"
    target = f"{_quoted(database)}.{_quoted(name)}"
    if zone != "bronze":
        return f"CREATE VIEW {target} AS SELECT * FROM {files}"
    # The partition column leads and is an ordinary BIGINT; regular and playoff rows share the view.
    return (
        f"CREATE VIEW {target} AS SELECT CAST(season AS BIGINT) AS season, * EXCEPT (season, playoffs) "
        f"FROM {live_sql(spark, path, files)} WHERE season IS NOT NULL"
    )


def restricted_views(spark: SparkSession, plan: Sequence[Row], restricted: Sequence[str] = ()) -> list[str]:
    """Faults of the planned views that would read anything restricted: what lies in, on the way to or below a folder of
    ``restricted``, or in a folder carrying the mark of one. Addresses are compared as the file system resolves them."""
    faults, marked = [], {}
    bases = [Files(spark, base).resolved(base) for base in restricted if Files(spark, base).exists(base)]
    for row in plan:
        if not row.present:
            continue
        files = Files(spark, row.path)
        view = files.resolved(row.path)
        faults += [f"{row.zone}.{row.name}: {row.path} meets {b}" for b in bases if _within(view, b) or _within(b, view)]
        # The folders from the root down to the view's files, each looked at once.
        inputs = {view} | {r.folder for r in data_folders(spark, row.path).select("folder").collect()}
        folders = {folder for path in inputs for folder in _upwards(urlsplit(path).path)}
        for folder in sorted(folders):
            if folder not in marked:
                marked[folder] = files.exists(f"{folder}/{RESTRICTED}")
            if marked[folder]:
                faults.append(f"{row.zone}.{row.name}: {folder} is restricted")
    return faults


def _within(path: str, folder: str) -> bool:
    return f"{path.rstrip('/')}/".startswith(f"{folder.rstrip('/')}/")


def _upwards(path: str) -> list[str]:
    parts = path.rstrip("/").split("/")
    return ["/".join(parts[:n]) for n in range(2, len(parts) + 1)]


def _own_database(spark: SparkSession, database: str, lake: Lake) -> bool:
    facts = spark.sql(f"DESCRIBE DATABASE EXTENDED {_quoted(database)}").collect()
    return any(f"({_MARK},{lake.base})" in str(row[1]) for row in facts)


def rebuild(spark: SparkSession, lake: Lake, prefix: str = "", restricted: Sequence[str] = ()) -> Rebuild:
    """Drop the zone databases and create them again from what is on disk.

    Raises, before anything is dropped, if a view would read from a restricted folder: one of ``restricted``, or one
    marked as such, wherever it lies.

    Whatever else was put into them goes; a database of the same name made by someone else, or for
    another lake, is left alone and raises. ``prefix`` sets the databases of several lakes apart.
    """
    databases = {zone: f"{prefix}{zone}" for zone in ZONES}
    for database in databases.values():
        if spark.catalog.databaseExists(database) and not _own_database(spark, database, lake):
            raise RuntimeError(f"database {database!r} was not made by a rebuild of {lake.base}; choose another prefix")
    plan = planned_views(spark, lake).orderBy("zone", "name").collect()
    faults = restricted_views(spark, plan, restricted)
    if faults:
        raise PermissionError(f"views must not read restricted data: {'; '.join(faults[:5])}")
    mark = lake.base.replace("\\", "\\\\").replace("'", "\\'")
    for database in databases.values():
        spark.sql(f"DROP DATABASE IF EXISTS {_quoted(database)} CASCADE")
        spark.sql(f"CREATE DATABASE {_quoted(database)} WITH DBPROPERTIES ('{_MARK}' = '{mark}')")
    for row in plan:
        if row.present:
            spark.sql(_view_sql(spark, databases[row.zone], row.zone, row.name, row.path))
    return Rebuild(
        databases=tuple(databases.values()),
        created=tuple(f"{databases[r.zone]}.{r.name}" for r in plan if r.present),
        skipped=tuple(f"{databases[r.zone]}.{r.name}" for r in plan if not r.present),
    )


def query(spark: SparkSession, sql: str) -> DataFrame:
    """Run SQL over the views; a view that is not there raises naming the remedy."""
    try:
        return spark.sql(sql)
    except AnalysisException as error:
        if error.getCondition() in ("TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND"):
            raise LookupError(f"{error.getMessage()} Run rebuild(spark, lake) to create the views.") from error
        raise


def view_schemas(spark: SparkSession, databases: Sequence[str]) -> dict[str, list[tuple[str, str]]]:
    """Column names and types of every view, for comparing two builds."""
    return {
        f"{database}.{table.name}": spark.table(f"{_quoted(database)}.{_quoted(table.name)}").dtypes
        for database in databases
        for table in spark.catalog.listTables(database)
        if not table.isTemporary
    }
