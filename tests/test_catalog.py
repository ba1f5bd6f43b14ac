from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakegauge.checks.feeds import land
from lakegauge.layout import Lake
from lakegauge.operators.compare import identical
from lakegauge.plans.catalog import ZONES, planned_views, query, rebuild, view_schemas
from lakegauge.schemas import SCHEMAS


def land_season(spark, lake, source, season, rows, playoffs=False):
    frame = spark.range(rows).select(
        F.concat(F.lit(f"{season}0000"), F.col("id").cast("string")).alias("GAME_ID"), F.col("id").alias("EVENTNUM")
    )
    land(frame.withColumns({"season": F.lit(season).cast("int"), "playoffs": F.lit(playoffs)}), lake.bronze(source))


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    land_season(spark, lake, "nbastats", 2022, 2)
    land_season(spark, lake, "nbastats", 2023, 3)
    land_season(spark, lake, "datanba", 2023, 4)
    spark.range(5).withColumnRenamed("id", "event_id").write.parquet(f"{lake.zone('silver')}/canonical_event")
    return lake


@pytest.fixture(autouse=True)
def no_databases_left(spark):
    yield
    for database in spark.catalog.listDatabases():
        if database.name != "default":
            spark.sql(f"DROP DATABASE `{database.name}` CASCADE")


def rows(frame):
    return sorted(map(tuple, frame.collect()))


def test_one_database_per_zone_and_one_view_per_table(spark, lake):
    made = rebuild(spark, lake, prefix="t_")
    assert made.databases == tuple(f"t_{zone}" for zone in ZONES)
    assert set(made.created) == {"t_bronze.nbastats", "t_bronze.datanba", "t_silver.canonical_event"}
    assert set(made.skipped) == {f"t_bronze.{s}" for s in set(SCHEMAS) - {"nbastats", "datanba"}}
    counts = [query(spark, f"SELECT count(*) FROM {view}").first()[0] for view in sorted(made.created)]
    assert counts == [4, 5, 5]


def test_season_leads_as_bigint_and_stays_prunable(spark, lake):
    rebuild(spark, lake, prefix="t_")
    view = spark.table("t_bronze.nbastats")
    assert view.dtypes == [("season", "bigint"), ("GAME_ID", "string"), ("EVENTNUM", "bigint")]
    assert rows(query(spark, "SELECT season, count(*) FROM t_bronze.nbastats GROUP BY 1")) == [(2022, 2), (2023, 3)]
    assert rows(query(spark, "SELECT min(season), max(season) FROM t_bronze.nbastats")) == [(2022, 2023)]
    plan = view.where("season = 2023")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan and "2023" in plan.split("PartitionFilters")[1]


def test_a_new_season_shows_without_a_rebuild(spark, lake):
    rebuild(spark, lake, prefix="t_")
    land_season(spark, lake, "nbastats", 2024, 7)
    land_season(spark, lake, "nbastats", 2024, 1, playoffs=True)
    assert query(spark, "SELECT count(*) FROM t_bronze.nbastats").first()[0] == 13


def test_datasets_without_a_season_stay_out_of_the_view(spark, lake):
    land_season(spark, lake, "nbastats", None, 9)
    rebuild(spark, lake, prefix="t_")
    assert query(spark, "SELECT count(*) FROM t_bronze.nbastats").first()[0] == 5


def test_rebuilding_gives_the_same_and_drops_strays(spark, lake):
    first = rebuild(spark, lake, prefix="t_")
    schemas = view_schemas(spark, first.databases)
    before = {view: spark.table(view) for view in first.created}
    spark.sql("CREATE VIEW t_bronze.hand_made AS SELECT 1 AS x")
    assert rebuild(spark, lake, prefix="t_") == first
    assert view_schemas(spark, first.databases) == schemas
    assert all(identical(before[view], spark.table(view)) for view in first.created)
    with pytest.raises(LookupError, match="rebuild"):
        query(spark, "SELECT * FROM t_bronze.hand_made")


def test_an_empty_lake_gives_empty_databases(spark, tmp_path):
    lake = Lake(str(tmp_path / "none"))
    plan = planned_views(spark, lake).collect()
    assert {r.name for r in plan} == set(SCHEMAS) and not any(r.present for r in plan)
    assert not (tmp_path / "none").exists()
    made = rebuild(spark, lake, prefix="e_")
    assert made.created == () and len(made.skipped) == len(SCHEMAS)
    assert all(spark.catalog.databaseExists(d) for d in made.databases)


def test_undeclared_and_leftover_folders_get_no_view(spark, lake, tmp_path):
    land_season(spark, lake, "pbpstats", 2023, 2)
    (tmp_path / "lake" / "bronze" / "matchups").mkdir()
    made = rebuild(spark, lake, prefix="t_")
    assert not any("pbpstats" in view or "matchups" in view for view in made.created)


def test_zone_names_elsewhere_in_the_path_do_not_mislead(spark, tmp_path):
    lake = Lake(f"file://{tmp_path}/silver/bronze/lake/")
    land_season(spark, lake, "nbastats", 2023, 2)
    spark.range(2).write.parquet(f"{lake.zone('silver')}/a")
    spark.range(3).write.parquet(f"{lake.zone('gold')}/b.parquet")
    made = rebuild(spark, lake, prefix="p_")
    assert made.created == ("p_bronze.nbastats", "p_gold.b", "p_silver.a")
    assert [spark.table(view).count() for view in made.created] == [2, 3, 2]


def test_another_lake_s_databases_are_left_alone(spark, lake, tmp_path):
    made = rebuild(spark, lake, prefix="t_")
    other = Lake(str(tmp_path / "other"))
    land_season(spark, other, "nbastats", 2023, 1)
    with pytest.raises(RuntimeError, match="not made by a rebuild of"):
        rebuild(spark, other, prefix="t_")
    assert [spark.table(view).count() for view in sorted(made.created)] == [4, 5, 5]


def test_a_foreign_database_is_left_alone(spark, lake):
    spark.sql("CREATE DATABASE f_bronze")
    with pytest.raises(RuntimeError, match="not made by a rebuild"):
        rebuild(spark, lake, prefix="f_")
    assert spark.catalog.databaseExists("f_bronze")


def test_a_missing_view_names_the_remedy(spark):
    with pytest.raises(LookupError, match="rebuild"):
        query(spark, "SELECT * FROM nowhere.nbastats")
