from __future__ import annotations

import re
from pathlib import Path

import pytest

from conftest import csv_text, drop_archive
from lakegauge.layout import Lake
from lakegauge.operators.drift import SchemaDrift
from lakegauge.plans.catalog import rebuild
from lakegauge.validate.answer_key import (
    DEFAULT_DATASET,
    SCHEMA,
    compare_to_key,
    load_answer_key,
    raw_folder,
    read_answer_key,
)

ROWS = [
    {"GAMEID": "99800417", "EVENTS": '"Opening tip\nlayup by number 8"', "STARTTIME": '"9:37"', "STARTSCOREDIFFERENTIAL": "6"},
    {"GAMEID": "99800417", "EVENTS": '"Turnover\nsteal by number 31"', "STARTTIME": '"8:02"', "STARTSCOREDIFFERENTIAL": "-5", "URL": ""},
]


@pytest.fixture
def base(tmp_path):
    base = str(tmp_path / "key")
    drop_archive(raw_folder(base), DEFAULT_DATASET, csv_text(SCHEMA, ROWS))
    return base


def test_possessions_land_typed_and_whole(spark, base):
    outcome = load_answer_key(spark, base).first()
    assert (outcome.name, outcome.rows) == (DEFAULT_DATASET, 2)
    rows = sorted(read_answer_key(spark, base).collect(), key=lambda r: -r.STARTSCOREDIFFERENTIAL)
    assert [r.STARTTIME for r in rows] == ["9:37", "8:02"]
    assert [r.STARTSCOREDIFFERENTIAL for r in rows] == [6, -5]
    assert [r.URL for r in rows] == ["x", None]
    assert [r.GAMEID for r in rows] == ["99800417"] * 2 and all("\n" in r.EVENTS for r in rows)
    assert load_answer_key(spark, base).first().rows == 2


def test_everything_stays_under_its_own_base(spark, base, tmp_path):
    load_answer_key(spark, base)
    assert {p.name for p in tmp_path.iterdir()} == {"key"}


def test_other_sources_and_drift_are_refused(spark, base):
    with pytest.raises(ValueError, match="not an answer-key dataset"):
        load_answer_key(spark, base, ["nbastats_2023"])
    text = csv_text(SCHEMA, [{}]).replace("TURNOVERS,", "SURPRISE,")
    drop_archive(raw_folder(base), DEFAULT_DATASET, text)
    with pytest.raises(SchemaDrift, match=r"missing=\['TURNOVERS'\] unexpected=\['SURPRISE'\]"):
        load_answer_key(spark, base)


def test_the_catalog_cannot_reach_it_even_inside_the_lake(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    base = f"{lake.base}/oracle"
    drop_archive(raw_folder(base), DEFAULT_DATASET, csv_text(SCHEMA, ROWS))
    load_answer_key(spark, base)
    spark.range(1).write.parquet(f"{lake.zone('silver')}/made")
    made = rebuild(spark, lake, prefix="q_")
    assert made.created == ("q_silver.made",)
    assert not any("oracle" in d for d in made.databases)


def _reaches(source: str) -> bool:
    code = re.sub(r'""".*?"""', "", source, flags=re.S)
    return bool(re.search(r"lakegauge\.validate|pbpstats", code))


def test_no_library_module_reaches_it():
    root = Path(__file__).parent.parent / "lakegauge"
    modules = [p for p in root.rglob("*.py") if p.relative_to(root).parts[0] not in ("validate", "checks")]
    assert len(modules) > 15
    assert [str(p) for p in modules if _reaches(p.read_text())] == []
    assert _reaches("from lakegauge.validate.answer_key import SCHEMA") and _reaches('s = "pbpstats"')
    assert not _reaches('"""Prose about pbpstats."""')


def test_comparison_leaves_out_games_absent_from_the_key(spark):
    schema = "game STRING, n BIGINT, kind STRING"
    mine = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 3, None), ("z", 1, "x")], schema)
    key = spark.createDataFrame([("a", 1, "x"), ("a", 2, "n"), ("a", 3, None), ("a", 4, "x")], schema)
    found = {(r.game, r.n): r.status for r in compare_to_key(mine, key, game="game", on=["game", "n"]).collect()}
    assert found == {("a", 1): "match", ("a", 2): "mismatch", ("a", 3): "match", ("a", 4): "right_only"}


def test_a_key_placed_in_a_published_zone_is_refused(spark, tmp_path):
    """By the mark the load leaves, whatever the folder is called, and by address."""
    lake = Lake(str(tmp_path / "lake"))
    for place in ("silver/key", "gold/deep/down"):
        hidden = f"{lake.base}/{place}"
        drop_archive(raw_folder(hidden), DEFAULT_DATASET, csv_text(SCHEMA, ROWS))
        load_answer_key(spark, hidden)
        with pytest.raises(PermissionError, match="is restricted"):
            rebuild(spark, lake, prefix="refused_")
        assert not spark.catalog.databaseExists("refused_silver")
        Path(f"{lake.base}/{place.split('/')[0]}").rename(tmp_path / place.split("/")[0])
    spark.range(3).write.parquet(f"{lake.zone('silver')}/plain")
    for base in (f"{lake.zone('silver')}/plain", lake.zone("silver")):
        with pytest.raises(PermissionError, match="silver.plain: .* meets"):
            rebuild(spark, lake, prefix="refused_", restricted=[base])
    (tmp_path / "elsewhere").mkdir()
    assert "refused_silver.plain" in rebuild(spark, lake, prefix="refused_", restricted=[str(tmp_path / "elsewhere")]).created
