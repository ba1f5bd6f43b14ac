"""One query per operator, each over whole tables: name -> function of (session, table folder)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakegauge.checks.feeds import (
    bronze_lake,
    drop_archives,
    event_feed,
    land,
    named,
    new_lake,
    pack_archives,
    table,
    year,
)
from lakegauge.functions.game import canonical_game_id, clock_seconds, game_date, score_margin, score_part
from lakegauge.functions.strict import apply_schema
from lakegauge.layout import Lake
from lakegauge.operators.aggregates import filtered_min, group_sum
from lakegauge.operators.bitmaps import distinct_bitmaps, distinct_counts, merged_bitmaps
from lakegauge.operators.compare import (
    compare_by_key,
    compare_parts,
    row_differences,
    row_differences_by_part,
    status_counts,
)
from lakegauge.operators.coverage import distinct_per_group, key_coverage
from lakegauge.operators.drift import header_drift
from lakegauge.operators.joins import (
    duplicate_keys,
    join_report,
    mark_matches,
    missing_keys,
    unmatched_sample,
)
from lakegauge.operators.sequence import previous_value, running_total
from lakegauge.plans.catalog import query, rebuild
from lakegauge.plans.loads import (
    archive_checksums,
    capture,
    checksum_status,
    dataset_rows,
    load_bronze,
    pending,
    write_datasets,
)
from lakegauge.plans.reports import run_report
from lakegauge.schemas import declare
from lakegauge.scratch import scratch_dir
from lakegauge.sinks.partitions import replace_partitions
from lakegauge.sources.archives import all_strings, archive_headers
from lakegauge.sources.manifest import manifest_entries, manifest_faults, with_name_parts
from lakegauge.sources.ranges import split_csv
from lakegauge.streaming.landing import load_new_archives
from lakegauge.validate import answer_key
from lakegauge.validate.answer_key import compare_to_key

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _registered(check: Query) -> Query:
    QUERIES[check.__name__] = check
    return check


def _listed(sample: str, *fields: str) -> Column:
    """A sample of key structs as one line: keys split by commas, their parts by slashes."""
    keys = F.transform(sample, lambda key: F.concat_ws("/", *(key[f].cast("string") for f in fields)))
    return F.array_join(keys, ",").alias(sample)


# --- key match ---------------------------------------------------------------

_MATCH = ["left_rows", "matched", "unmatched", "unmatched_keys", "duplicate_right_keys", "match_rate"]


@_registered
def join_report_orders(spark, sf_dir):
    report = join_report(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "lineitem"),
        left_on=["o_orderkey"],
        right_on=["l_orderkey"],
        name="orders_in_lineitem",
    )
    return report.select(*_MATCH, _listed("unmatched_sample", "o_orderkey"))


@_registered
def join_report_composite(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    report = join_report(
        items.where("l_returnflag = 'A'"),
        items.where("l_returnflag = 'R'"),
        left_on=["l_partkey", "l_suppkey"],
        right_on=["l_partkey", "l_suppkey"],
        name="accepted_in_returned",
    )
    return report.select(*_MATCH, _listed("unmatched_sample", "l_partkey", "l_suppkey"))


@_registered
def join_report_by_season(spark, sf_dir):
    report = join_report(
        table(spark, sf_dir, "orders").select("o_orderkey", year("o_orderdate").alias("season")),
        table(spark, sf_dir, "lineitem").select("l_orderkey", year("l_shipdate").alias("season")),
        left_on=["o_orderkey"],
        right_on=["l_orderkey"],
        name="orders_in_lineitem",
        by=["season"],
    )
    return report.select("season", *_MATCH, _listed("unmatched_sample", "o_orderkey"))


@_registered
def match_marker(spark, sf_dir):
    marked = mark_matches(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"),
        table(spark, sf_dir, "lineitem"),
        left_on=["o_orderkey"],
        right_on=["l_orderkey"],
    )
    return marked.select("o_orderkey", "o_orderstatus", F.col("matched").cast("int").alias("matched"))


@_registered
def missing_orders(spark, sf_dir):
    return missing_keys(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "lineitem"),
        reference_on=["o_orderkey"],
        frame_on=["l_orderkey"],
    )


@_registered
def unmatched_orders_sample(spark, sf_dir):
    return unmatched_sample(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "lineitem"),
        left_on=["o_orderkey"],
        right_on=["l_orderkey"],
    )


@_registered
def duplicate_line_keys(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- coverage ----------------------------------------------------------------

_SPREAD = ["units", "reference_units", "missing_units", "minimum", "median", "mean", "maximum"]


def _extremes(*fields: str) -> list[Column]:
    return [F.col(f"{side}_key.{f}").alias(f"{side}_key") for side in ("minimum", "maximum") for f in fields]


def order_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_coverage(
        table(spark, sf_dir, "lineitem"),
        group_by=["l_orderkey"],
        value_columns=["l_partkey", "l_suppkey"],
        name="order_coverage",
        dataset="lineitem",
        unit="order",
        measure="distinct parts and suppliers",
        reference_keys=table(spark, sf_dir, "orders").select("o_orderkey"),
    )


@_registered
def coverage_report(spark, sf_dir):
    return order_coverage(spark, sf_dir).select(
        *_SPREAD, *_extremes("l_orderkey"), _listed("missing_sample", "l_orderkey")
    )


@_registered
def coverage_by_season(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    report = key_coverage(
        items.select("l_orderkey", "l_partkey", "l_suppkey", year("l_shipdate").alias("season")),
        group_by=["l_orderkey"],
        value_columns=["l_partkey", "l_suppkey"],
        name="order_coverage",
        dataset="lineitem",
        unit="order",
        measure="distinct parts and suppliers",
        reference_keys=table(spark, sf_dir, "orders").select(year("o_orderdate"), "o_orderkey"),
        by=["season"],
    )
    return report.select("season", *_SPREAD, *_extremes("l_orderkey"), _listed("missing_sample", "l_orderkey"))


@_registered
def coverage_without_reference(spark, sf_dir):
    report = key_coverage(
        table(spark, sf_dir, "events"),
        group_by=["user_id"],
        value_columns=["event_type"],
        name="user_coverage",
        dataset="events",
        unit="user",
        measure="distinct event types",
    )
    return report.select(*_SPREAD, *_extremes("user_id"))


@_registered
def pooled_distinct(spark, sf_dir):
    return distinct_per_group(table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_partkey", "l_suppkey"])


@_registered
def null_inclusive_distinct(spark, sf_dir):
    users = F.when(F.col("user_id") % 7 != 0, F.col("user_id"))
    events = table(spark, sf_dir, "events").select("event_type", users.alias("user_id"))
    return distinct_per_group(events, ["event_type"], ["user_id"])


@_registered
def distinct_by_bitmaps(spark, sf_dir):
    """Distinct parts and suppliers, pooled, per return flag: bitmaps per year of shipping merged over the years."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", year("l_shipdate").alias("season"), "l_partkey", _some_suppliers().alias("l_suppkey")
    )
    by_season = distinct_bitmaps(items, ["l_returnflag", "season"], ["l_partkey", "l_suppkey"])
    return distinct_counts(merged_bitmaps(by_season, ["l_returnflag"]), ["l_returnflag"])


def _some_suppliers() -> Column:
    return F.when(F.col("l_linenumber") != 1, F.col("l_suppkey"))


# --- sequence and small aggregates -------------------------------------------


@_registered
def prev_event(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    found = previous_value(
        events, "event_type", group_by=["user_id"], order_by=["ts", "event_id"], name="prev_event_type"
    )
    return found.drop("ts")


def _cents(events: DataFrame) -> DataFrame:
    return events.withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))


@_registered
def running_total_by_user(spark, sf_dir):
    events = _cents(table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value"))
    found = running_total(events, "cents", group_by=["user_id"], order_by=["ts", "event_id"], name="running")
    return found.select("event_id", "running")


# A handful of groups hold the whole table; they are cut in the smallest of tables too.
_CHECKED_BLOCK_ROWS = 150


@_registered
def prev_event_large_groups(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "ts")
    found = previous_value(
        events,
        "user_id",
        group_by=["event_type"],
        order_by=["ts", "event_id"],
        name="prev_user_id",
        block_rows=_CHECKED_BLOCK_ROWS,
    )
    return found.select("event_id", "event_type", "prev_user_id")


@_registered
def running_total_large_groups(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    found = running_total(
        _cents(events),
        "cents",
        group_by=["event_type"],
        order_by=["ts", "event_id"],
        name="running",
        block_rows=_CHECKED_BLOCK_ROWS,
    )
    return found.select("event_id", "running")


@_registered
def running_total_of_doubles(spark, sf_dir):
    """Running totals of a floating-point column over a few groups that are cut: sums that DuckDB has exactly too."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "ts", (F.floor(F.col("value") * 4096) / 4096.0).cast("double").alias("value")
    )
    found = running_total(
        events,
        "value",
        group_by=["event_type"],
        order_by=["ts", "event_id"],
        name="running",
        block_rows=_CHECKED_BLOCK_ROWS,
    )
    return found.select("event_id", "running")


@_registered
def split_csv_documents(spark, sf_dir):
    """Whole documents, with their line breaks and quotes, through CSV files that tasks read by byte ranges."""
    path = scratch_dir(spark, "documents-csv")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    documents.write.option("header", True).option("escape", '"').csv(path)
    return split_csv(spark, path).withColumn("doc_id", F.col("doc_id").cast("bigint"))


@_registered
def group_sum_cents(spark, sf_dir):
    return group_sum(_cents(table(spark, sf_dir, "events")), ["event_type"], "cents", "cents")


@_registered
def filtered_min_event(spark, sf_dir):
    return filtered_min(table(spark, sf_dir, "events"), F.col("event_type") == "click", "event_id", "m")


# --- typing and drift --------------------------------------------------------


@_registered
def strict_cast_lines(spark, sf_dir):
    texts = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string"), F.col("l_quantity").cast("string"), "l_returnflag"
    )
    return apply_schema(texts, declare("l_orderkey BIGINT, l_quantity DOUBLE, l_returnflag STRING"))


@_registered
def header_drift_tables(spark, sf_dir):
    """Archives of two tables held against the columns of one of them."""
    orders = table(spark, sf_dir, "orders").select(F.lit("orders").alias("name"), "o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("name"), "c_custkey", F.col("c_nationkey").alias("o_custkey")
    )
    headers = archive_headers(pack_archives(orders)).unionAll(archive_headers(pack_archives(customers)))
    drift = header_drift(headers, ["o_orderkey", "o_custkey"])
    return drift.select(
        "name", F.array_join("missing", ",").alias("missing"), F.array_join("unexpected", ",").alias("unexpected")
    ).distinct()


@_registered
def header_drift_rows(spark, sf_dir):
    """A header per order, lacking a column or holding one too many as the order has it."""
    columns = F.array(
        F.lit("o_orderkey"),
        F.when(F.col("o_orderstatus") != "F", "o_custkey"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "o_extra"),
    )
    headers = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("name"), F.array_compact(columns).alias("columns")
    )
    return header_drift(headers, ["o_orderkey", "o_custkey"]).select(
        "name", F.array_join("missing", ",").alias("missing"), F.array_join("unexpected", ",").alias("unexpected")
    )


# --- names and manifest ------------------------------------------------------


def _dataset_names(orders: DataFrame) -> DataFrame:
    marker = F.when(F.col("o_orderpriority") == "1-URGENT", "_po_").otherwise("_")
    name = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("odd_"), F.col("o_orderstatus"))).otherwise(
        F.concat(F.lower("o_orderstatus"), F.lit("_feed"), marker, F.year("o_orderdate").cast("string"))
    )
    return orders.select("o_orderkey", name.alias("name"))


@_registered
def name_parts(spark, sf_dir):
    parts = with_name_parts(_dataset_names(table(spark, sf_dir, "orders")))
    return parts.withColumn("playoffs", F.col("playoffs").cast("int"))


def _manifest_lines(pages: DataFrame) -> DataFrame:
    """A manifest line per page. Urls with a fragment become comments, secure ones repository
    addresses, and plain ones without a query string are left out; one name in ten comes twice."""
    repository = F.concat(F.lit("https://github.com/own/repo/raw/main/"), "page_id", F.lit(".tar.xz"))
    url = F.when(F.col("url").startswith("https:"), repository).otherwise(F.regexp_extract("url", r"^[^?]+\?(.*)$", 0))
    name = F.concat(F.lit("page_"), F.expr("page_id - IF(page_id % 10 = 9, 1, 0)"), F.lit("_2020"))
    mark = F.when(F.contains("url", F.lit("#")), "# ").otherwise(" ")
    return pages.select(F.col("page_id").alias("line_no"), F.concat(mark, name, F.lit(" = "), url).alias("line"))


@_registered
def manifest_table(spark, sf_dir):
    entries = manifest_entries(_manifest_lines(table(spark, sf_dir, "pages")))
    return entries.where(F.col("name").isNotNull()).select("line_no", "name", "url")


@_registered
def manifest_fault_lines(spark, sf_dir):
    faults = manifest_faults(manifest_entries(_manifest_lines(table(spark, sf_dir, "pages"))))
    return faults.select("line_no", F.split_part("fault", F.lit(" "), F.lit(1)).alias("kind"))


# --- loads -------------------------------------------------------------------


def _loaded(spark: SparkSession, frame: DataFrame, schema: StructType) -> tuple[Lake, DataFrame]:
    """Pack ``frame``, load the archives as source ``feed`` and give the lake and the outcome."""
    lake = new_lake(spark)
    archives = pack_archives(frame)
    datasets = with_name_parts(archives.select("name").distinct())
    rows = dataset_rows(archives, schema)
    return lake, write_datasets(rows, lake.bronze("feed"), datasets)


def _order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    playoffs = F.when(F.col("o_orderpriority") == "1-URGENT", "_po").otherwise("")
    name = F.concat(F.lit("feed"), playoffs, F.lit("_"), F.year("o_orderdate").cast("string"))
    return table(spark, sf_dir, "orders").select(
        name.alias("name"),
        "o_orderkey",
        F.date_format("o_orderdate", "yyyyMMdd").alias("o_orderdate"),
        "o_totalprice",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
    )


_ORDER_FEED = declare(
    "o_orderkey BIGINT, o_orderdate STRING, o_totalprice DOUBLE, o_custkey BIGINT, o_orderstatus STRING"
)


@_registered
def archive_roundtrip(spark, sf_dir):
    """Orders packed into archives, scanned, strictly typed, written by partition and read back."""
    lake, _ = _loaded(spark, _order_feed(spark, sf_dir), _ORDER_FEED)
    stored = spark.read.parquet(lake.bronze("feed"))
    return stored.select(
        F.col("season").cast("bigint").alias("season"), *_ORDER_FEED.names
    )


@_registered
def load_outcome(spark, sf_dir):
    """Rows each dataset holds after the load, as the load reports them."""
    _, outcome = _loaded(spark, _order_feed(spark, sf_dir), _ORDER_FEED)
    return outcome.select("name", "season", F.col("playoffs").cast("int").alias("playoffs"), "rows")


@_registered
def archive_nullable_column(spark, sf_dir):
    """One nullable column through archives, whose CSV has an empty line for every null."""
    feed = _order_feed(spark, sf_dir).select("name", "o_custkey")
    lake, _ = _loaded(spark, feed, declare("o_custkey BIGINT"))
    return spark.read.parquet(lake.bronze("feed")).select("o_custkey")


@_registered
def capture_runs(spark, sf_dir):
    """Two captures of archive files by one manifest: the first lands every dataset, the second skips it."""
    lake, feed = new_lake(spark), _order_feed(spark, sf_dir)
    drop_archives(feed, lake.raw)
    entries = feed.select("name").distinct().withColumn("url", F.concat(F.lit("https://example.com/"), "name"))
    manifest = with_name_parts(entries)

    def outcome(run: int) -> DataFrame:
        found = capture(spark, lake, manifest)
        return found.select(F.lit(run).alias("run"), "name", F.col("skipped").cast("int").alias("skipped"), "rows")

    return outcome(1).unionAll(outcome(2))


@_registered
def bronze_load(spark, sf_dir):
    """Archive files of the main feed through the typed load, which reports the rows of each dataset."""
    lake = new_lake(spark)
    drop_archives(named(event_feed(spark, sf_dir), "nbastats"), lake.raw)
    outcome = load_bronze(spark, lake)
    return outcome.select("name", "source", "season", F.col("playoffs").cast("int").alias("playoffs"), "rows")


@_registered
def stream_reload(spark, sf_dir):
    """Archive files of the main feed through the stream, which runs again when those of the playoffs have been
    replaced by others with later event numbers."""
    lake, feed = new_lake(spark), event_feed(spark, sf_dir)
    drop_archives(named(feed, "nbastats"), lake.raw)
    load_new_archives(spark, lake).awaitTermination()
    replaced = feed.where("playoffs").withColumn("EVENTNUM", F.col("EVENTNUM") + 100)
    drop_archives(named(replaced, "nbastats"), lake.raw)
    load_new_archives(spark, lake).awaitTermination()
    return _published(
        spark, lake, "reloaded_", "SELECT GAME_ID AS game, EVENTNUM AS event FROM {p}bronze.nbastats"
    )


@_registered
def answer_key_load(spark, sf_dir):
    """Line items as possessions, loaded from archive files into the restricted zone and read back."""
    known = {
        "GAMEID": F.col("l_orderkey").cast("string"),
        "PERIOD": F.col("l_linenumber").cast("bigint"),
        "URL": F.col("l_returnflag"),
    }
    name = F.concat(F.lit(f"{answer_key.SOURCE}_"), F.year("l_shipdate").cast("string"))
    columns = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in answer_key.SCHEMA.fields]
    feed = table(spark, sf_dir, "lineitem").select(name.alias("name"), *columns)
    base = scratch_dir(spark, "answer-key")
    drop_archives(feed, answer_key.raw_folder(base))
    answer_key.load_answer_key(spark, base, sorted(r.name for r in feed.select("name").distinct().collect()))
    found = answer_key.read_answer_key(spark, base)
    return found.select("season", *known)


@_registered
def failed_reload(spark, sf_dir):
    """Orders by season after a load of them that failed half-way: the rows of the load before."""
    path = scratch_dir(spark, "reloaded")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", year("o_orderdate").alias("season"), F.lit(False).alias("playoffs")
    )
    replace_partitions(orders, path)
    halt = F.when(F.col("o_orderkey") % 7 == 3, F.raise_error(F.lit("the reload stops here")).cast("bigint"))
    changed = orders.withColumn("o_custkey", F.coalesce(halt, F.lit(0).cast("bigint")))
    try:
        replace_partitions(changed, path)
    except Exception as stopped:
        if "the reload stops here" not in str(stopped):
            raise
    return spark.read.parquet(path).select("o_orderkey", F.col("o_custkey").cast("bigint").alias("o_custkey"))


@_registered
def archive_texts(spark, sf_dir):
    """Whole documents, with their line breaks and quotes, through an all-string capture."""
    documents = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("feed_"), (F.lit(2000) + F.length("lang")).cast("string")).alias("name"),
        F.col("doc_id").cast("string").alias("doc_id"),
        "text",
        "lang",
        "source",
    )
    lake, _ = _loaded(spark, documents, all_strings(["doc_id", "text", "lang", "source"]))
    return spark.read.parquet(lake.bronze("feed")).select("doc_id", "text", "lang", "source")


@_registered
def parquet_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "customer")
    table(spark, sf_dir, "customer").write.parquet(path)
    return spark.read.parquet(path)


@_registered
def pending_loads(spark, sf_dir):
    def dataset(frame: DataFrame) -> DataFrame:
        return frame.select(
            "doc_id", F.lit("doc").alias("source"), F.col("doc_id").alias("season"), F.lit(False).alias("playoffs")
        )

    todo = pending(dataset(table(spark, sf_dir, "documents")), dataset(table(spark, sf_dir, "labels")))
    return todo.select("doc_id")


@_registered
def fingerprint(spark, sf_dir):
    archives = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("name"), F.col("text").cast("binary").alias("content")
    )
    return archive_checksums(archives).withColumnRenamed("name", "doc_id")


@_registered
def checksum_statuses(spark, sf_dir):
    """Documents against checksums recorded for the labelled ones, toxic ones having changed since."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    actual = documents.select(F.col("doc_id").alias("name"), F.sha2("text", 256).alias("sha256"))
    before = F.when(F.col("toxic") == 1, F.concat("text", F.lit("."))).otherwise(F.col("text"))
    recorded = documents.join(labels, "doc_id").select(
        F.col("doc_id").alias("name"), F.sha2(before, 256).alias("sha256")
    )
    return checksum_status(actual, recorded).select(F.col("name").alias("doc_id"), "status")


# --- named reports -----------------------------------------------------------


@_registered
def shotdetail_event_join(spark, sf_dir):
    lake = bronze_lake(spark, sf_dir, "nbastats", "shotdetail")
    report = run_report(spark, lake, "shotdetail_event_join")
    return report.select(
        "left", "right", "season", *_MATCH, _listed("unmatched_sample", "GAME_ID", "GAME_EVENT_ID")
    )


@_registered
def matchups_game_coverage(spark, sf_dir):
    report = run_report(spark, bronze_lake(spark, sf_dir, "nbastats", "matchups"), "matchups_game_coverage")
    return report.select("dataset", "season", *_SPREAD, *_extremes("game_id"), _listed("missing_sample", "game_id"))


@_registered
def datanba_game_coverage(spark, sf_dir):
    report = run_report(spark, bronze_lake(spark, sf_dir, "nbastats", "datanba"), "datanba_game_coverage")
    return report.select("dataset", "season", *_SPREAD, *_extremes("GAME_ID"), _listed("missing_sample", "GAME_ID"))


# --- catalog -----------------------------------------------------------------


def _own_prefix(label: str) -> str:
    """Sets a run's databases apart from those of other runs on the same metastore."""
    return f"{label}{uuid.uuid4().hex[:12]}_"


def _published(spark: SparkSession, lake: Lake, label: str, sql: str) -> DataFrame:
    prefix = _own_prefix(label)
    rebuild(spark, lake, prefix=prefix)
    return query(spark, sql.format(p=prefix))


@_registered
def season_view(spark, sf_dir):
    lake = bronze_lake(spark, sf_dir, "nbastats")
    return _published(
        spark, lake, "seasons_", "SELECT season, count(*) AS n FROM {p}bronze.nbastats GROUP BY season"
    )


@_registered
def season_min_max(spark, sf_dir):
    lake = bronze_lake(spark, sf_dir, "nbastats")
    return _published(
        spark, lake, "extremes_", "SELECT min(season) AS lo, max(season) AS hi FROM {p}bronze.nbastats"
    )


@_registered
def flat_view(spark, sf_dir):
    lake = new_lake(spark)
    table(spark, sf_dir, "supplier").write.parquet(f"{lake.zone('silver')}/supplier")
    return _published(
        spark, lake, "flat_", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM {p}silver.supplier"
    )


@_registered
def view_join(spark, sf_dir):
    """SQL over two views, a season at a time.

    Both views grow with the lake. Their files are small for the rows they hold, most columns being null, so the size of
    the files would have Spark broadcast one of them: the hint keeps it to a shuffled join.
    """
    lake = bronze_lake(spark, sf_dir, "nbastats", "shotdetail")
    return _published(
        spark,
        lake,
        "joined_",
        """
        SELECT /*+ MERGE(s, e) */ s.season, count(*) AS shots
        FROM {p}bronze.shotdetail s JOIN {p}bronze.nbastats e
          ON e.season = s.season AND e.GAME_ID = s.GAME_ID AND e.EVENTNUM = s.GAME_EVENT_ID
        GROUP BY s.season
        """,
    )


@_registered
def catalog_views(spark, sf_dir):
    """Rows of every view a rebuild creates over a lake of two feeds and two flat tables."""
    lake = bronze_lake(spark, sf_dir, "nbastats", "datanba")
    table(spark, sf_dir, "part").write.parquet(f"{lake.zone('silver')}/part")
    table(spark, sf_dir, "nation").write.parquet(f"{lake.zone('gold')}/nation.parquet")
    return _view_counts(spark, lake)


def _view_counts(spark: SparkSession, lake: Lake) -> DataFrame:
    prefix = _own_prefix("all_")
    made = rebuild(spark, lake, prefix=prefix)
    counts = " UNION ALL ".join(
        f"SELECT '{view.removeprefix(prefix)}' AS view, count(*) AS n FROM {view}" for view in made.created
    )
    return query(spark, counts)


@_registered
def restricted_stays_invisible(spark, sf_dir):
    """Views of a lake that holds a table beside the published zones."""
    lake = new_lake(spark)
    table(spark, sf_dir, "part").write.parquet(f"{lake.zone('silver')}/part")
    table(spark, sf_dir, "customer").write.parquet(f"{lake.zone('restricted')}/customer")
    return _view_counts(spark, lake)


@_registered
def season_landed_later(spark, sf_dir):
    """A view over seasons of which every other one lands after the rebuild."""
    lake, feed = new_lake(spark), event_feed(spark, sf_dir)
    prefix = _own_prefix("later_")
    land(feed.where("season % 2 = 0"), lake.bronze("nbastats"))
    rebuild(spark, lake, prefix=prefix)
    land(feed.where("season % 2 = 1"), lake.bronze("nbastats"))
    return query(spark, f"SELECT season, count(*) AS n FROM {prefix}bronze.nbastats GROUP BY season")


# --- comparison --------------------------------------------------------------


def _per_user(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where(F.col("event_type") == event_type)
    return events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@_registered
def compare_statuses(spark, sf_dir):
    clicks, views = _per_user(spark, sf_dir, "click"), _per_user(spark, sf_dir, "view")
    return status_counts(compare_by_key(clicks, views, ["user_id"]))


@_registered
def row_difference(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    pairs = items.select("l_partkey", "l_suppkey")
    return row_differences(pairs.where(items.l_linestatus == "F"), pairs.where(items.l_linestatus == "O"))


def _two_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Line items by year of shipping, and the same with first lines of 1995 doubled in quantity and 1996 short of some."""
    items = table(spark, sf_dir, "lineitem").select(
        year("l_shipdate").alias("season"), "l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("l_quantity")
    )
    doubled = (F.col("season") == 1995) & (F.col("l_linenumber") == 1)
    changed = items.withColumn("l_quantity", F.when(doubled, F.col("l_quantity") * 2).otherwise(F.col("l_quantity")))
    return items, changed.where((F.col("season") != 1996) | (F.col("l_linenumber") != 2))


@_registered
def unequal_partitions(spark, sf_dir):
    compared = compare_parts(*_two_snapshots(spark, sf_dir), ["season"])
    return compared.select("season", "left_rows", "right_rows", F.col("equal").cast("int").alias("equal"))


@_registered
def row_difference_by_season(spark, sf_dir):
    return row_differences_by_part(*_two_snapshots(spark, sf_dir), ["season"])


def _possessions(items: DataFrame) -> DataFrame:
    return items.groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").cast("bigint").alias("quantity"))


@_registered
def compare_to_answer_key(spark, sf_dir):
    """Order lines against the finished ones, within orders the finished ones cover."""
    items = table(spark, sf_dir, "lineitem")
    key = _possessions(items.where("l_linestatus = 'F'"))
    found = compare_to_key(_possessions(items), key, game="l_orderkey", on=["l_orderkey", "l_linenumber"])
    return status_counts(found)


# --- canonical fields --------------------------------------------------------


@_registered
def canonical_fields(spark, sf_dir):
    """Ids, clocks, dates, scores and margins written as the feeds write them, then read."""
    orders = table(spark, sf_dir, "orders")
    home, visitor = F.col("o_orderkey") % 130, F.col("o_custkey") % 130
    margin = F.when(home == visitor, "TIE").otherwise((home - visitor).cast("string"))
    clock = F.concat_ws(":", (home % 13).cast("string"), F.lpad((visitor % 60).cast("string"), 2, "0"))
    compact = F.date_format("o_orderdate", "yyyyMMdd")
    day = F.when(F.col("o_orderstatus") == "F", compact).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    written = orders.select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("game"),
        clock.alias("clock"),
        day.alias("day"),
        F.concat_ws(" - ", home.cast("string"), visitor.cast("string")).alias("score"),
        margin.alias("margin"),
    )
    return written.select(
        "o_orderkey",
        canonical_game_id(F.col("game")).alias("game_id"),
        clock_seconds(F.col("clock")).alias("seconds"),
        game_date(F.col("day")).cast("string").alias("day"),
        score_part(F.col("score"), 1).alias("home"),
        score_part(F.col("score"), 2).alias("visitor"),
        score_margin(F.col("margin")).alias("margin"),
    )
