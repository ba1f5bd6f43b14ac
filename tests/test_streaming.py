from __future__ import annotations

import os
from collections import Counter

import pytest

from conftest import csv_text, drop_archive
from lakegauge.layout import Lake
from lakegauge.plans.loads import archive_checksums, checksum_status, recorded_checksums
from lakegauge.schemas import schema_for
from lakegauge.sources.archives import archive_files
from lakegauge.sources.tables import read_bronze
from lakegauge.streaming.landing import load_new_archives


def drop(lake, name, rows):
    drop_archive(lake.raw, name, csv_text(schema_for(name.split("_")[0]), [{}] * rows))


def caught_up(spark, lake):
    query = load_new_archives(spark, lake)
    query.awaitTermination()
    return sum(p["numInputRows"] > 0 for p in query.recentProgress)


def ledger_entries(spark, lake):
    return Counter(r.name for r in spark.read.parquet(lake.checksums).select("name").collect())


def test_a_restart_picks_up_only_new_archives(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    drop(lake, "nbastats_2022", 2)
    drop(lake, "datanba_2022", 3)
    assert caught_up(spark, lake) == 1
    assert read_bronze(spark, lake, "nbastats", ["EVENTNUM"], [2022]).count() == 2
    assert caught_up(spark, lake) == 0
    drop(lake, "nbastats_2023", 4)
    assert caught_up(spark, lake) == 1
    assert read_bronze(spark, lake, "nbastats", ["EVENTNUM"], [2022, 2023]).count() == 6
    assert read_bronze(spark, lake, "datanba", ["evt"], [2022]).count() == 3


def test_the_stream_keeps_checksums_as_the_batch_load_does(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    drop(lake, "nbastats_2022", 2)
    drop(lake, "datanba_2022", 1)
    caught_up(spark, lake)

    def statuses():
        actual = archive_checksums(archive_files(spark, lake.raw))
        return {r.name: r.status for r in checksum_status(actual, recorded_checksums(spark, lake.checksums)).collect()}

    assert statuses() == {"nbastats_2022": "valid", "datanba_2022": "valid"}
    drop(lake, "datanba_2022", 5)
    assert statuses() == {"nbastats_2022": "valid", "datanba_2022": "stale"}


def test_drift_ends_the_query_and_the_batch_is_retried(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    drop_archive(lake.raw, "datanba_2022", "evt,EXTRA\n1,2\n")
    with pytest.raises(Exception, match="EXTRA"):
        caught_up(spark, lake)
    drop(lake, "datanba_2022", 2)
    assert caught_up(spark, lake) == 1
    assert read_bronze(spark, lake, "datanba", ["evt"], [2022]).count() == 2


def test_a_replaced_archive_is_loaded_again_and_an_untouched_one_is_not(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    drop(lake, "nbastats_2022", 2)
    drop(lake, "datanba_2022", 3)
    caught_up(spark, lake)
    first = ledger_entries(spark, lake)
    drop(lake, "datanba_2022", 5)
    os.utime(tmp_path / "lake/raw/nbastats_2022.tar.xz")
    assert caught_up(spark, lake) == 1
    assert read_bronze(spark, lake, "datanba", ["evt"], [2022]).count() == 5
    assert read_bronze(spark, lake, "nbastats", ["EVENTNUM"], [2022]).count() == 2
    assert sorted(ledger_entries(spark, lake) - first) == ["datanba_2022"]


def test_an_archive_with_an_old_time_is_picked_up(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    drop(lake, "nbastats_2022", 2)
    caught_up(spark, lake)
    drop(lake, "nbastats_2021", 4)
    os.utime(tmp_path / "lake/raw/nbastats_2021.tar.xz", (1, 1))
    assert caught_up(spark, lake) == 1
    assert read_bronze(spark, lake, "nbastats", ["EVENTNUM"], [2021]).count() == 4


def test_large_batches_are_loaded_in_parts(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    for season in range(2010, 2015):
        drop(lake, f"datanba_{season}", season - 2009)
    load_new_archives(spark, lake, max_files_per_batch=2).awaitTermination()
    assert read_bronze(spark, lake, "datanba", ["evt"], range(2010, 2015)).count() == 15
    assert sum(ledger_entries(spark, lake).values()) == 5


def test_an_empty_folder_ends_at_once(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    assert caught_up(spark, lake) == 0
