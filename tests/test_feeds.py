"""Archives that the queries' feeds are dropped as, and how the queries over them run."""

from __future__ import annotations

from pathlib import Path

import lakegauge.checks.feeds as feeds
from lakegauge.checks.queries import QUERIES
from lakegauge.schemas import declare
from lakegauge.sinks.partitions import replace_partitions
from lakegauge.sources.archives import archive_rows, open_archives

XZ = b"\xfd7zXZ\x00"
SETTING = "spark.sql.maxConcurrentOutputFileWriters"


def test_archives_are_dropped_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feeds, "_BUFFER_BYTES", 1)
    rows = [(f"d_{2000 + i % 3}", i, None if i % 5 == 0 else f'a "{i}",\n') for i in range(50)]
    rows += [("d_2010", None, None), (None, 7, "unnamed")]
    frame = spark.createDataFrame(rows, "name STRING, n BIGINT, text STRING").repartition(4)
    feeds.drop_archives(frame, str(tmp_path / "raw"))
    schema = declare("n BIGINT, text STRING")
    found = [tuple(r) for r in archive_rows(open_archives(spark, str(tmp_path / "raw")), schema).collect()]
    assert sorted(found, key=repr) == sorted([(n or "None", *rest) for n, *rest in rows], key=repr)
    assert sorted(p.name for p in (tmp_path / "raw").glob("*.tar.xz")) == [
        "None.tar.xz", "d_2000.tar.xz", "d_2001.tar.xz", "d_2002.tar.xz", "d_2010.tar.xz"
    ]
    # The tar's header, a part of each task and the end are streams of their own.
    assert Path(tmp_path / "raw" / "d_2000.tar.xz").read_bytes().count(XZ) > 4


def test_no_rows_drop_no_archives(spark, tmp_path):
    feeds.drop_archives(spark.createDataFrame([], "name STRING, n BIGINT"), str(tmp_path / "raw"))
    assert not list(tmp_path.glob("raw/*.tar.xz"))


def test_partitions_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    given = spark.conf.get(SETTING)
    rows = spark.range(40).selectExpr("id", "id % 6 AS season", "id % 2 = 0 AS playoffs").coalesce(1)
    kind, during = type(rows.write), []
    plain = kind.parquet

    def parquet(self, *args, **kwargs):
        during.append(spark.conf.get(SETTING))
        return plain(self, *args, **kwargs)

    monkeypatch.setattr(kind, "parquet", parquet)
    try:
        for before in (None, "0", "7"):
            spark.conf.unset(SETTING) if before is None else spark.conf.set(SETTING, before)
            held = spark.conf.get(SETTING)
            replace_partitions(rows, str(tmp_path / "table"))
            assert spark.conf.get(SETTING) == held
    finally:
        spark.conf.set(SETTING, given)
    assert during[2] == "7" and "0" not in during
    assert spark.read.parquet(str(tmp_path / "table")).count() == 40


def test_views_are_not_broadcast(spark, tmp_path):
    orders = "1L AS o_orderkey, 7L AS o_custkey, timestamp'1995-01-02' AS o_orderdate, '1-URGENT' AS o_orderpriority"
    items = "1L AS l_orderkey, 1 AS l_linenumber, timestamp'1995-03-04' AS l_shipdate, 2L AS l_partkey, 3L AS l_suppkey"
    spark.range(1).selectExpr(*orders.split(", ")).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(1).selectExpr(*items.split(", "), "'A' AS l_returnflag").write.parquet(str(tmp_path / "lineitem.parquet"))
    joined = QUERIES["view_join"](spark, str(tmp_path))
    assert [tuple(r) for r in joined.collect()] == [(1995, 1)]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
