from __future__ import annotations

from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType

from conftest import archive_bytes, csv_text, drop_archive
from lakegauge.functions.strict import strict_cast
from lakegauge.layout import Lake
from lakegauge.operators.drift import SchemaDrift, header_drift
from lakegauge.plans import loads
from lakegauge.plans.loads import (
    archive_checksums,
    capture,
    checksum_status,
    dataset_rows,
    load_bronze,
    sidecar_checksums,
)
from lakegauge.schemas import SCHEMAS, schema_for
from lakegauge.sources import archives
from lakegauge.sources.archives import _typed, all_strings, archive_files, archive_headers, archive_rows, bare_csv
from lakegauge.sources.manifest import with_name_parts
from lakegauge.sources.tables import landed_partitions, read_bronze

POINTS = "game_id,points\nx81,305\nx93,48\n"


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def manifest_of(spark, *names):
    from lakegauge.sources.manifest import with_name_parts

    return with_name_parts(
        spark.createDataFrame([(n, f"https://example.com/{n}.tar.xz") for n in names], "name STRING, url STRING")
    )


def by_name(frame):
    return {r.name: r for r in frame.collect()}


def files_under(folder):
    return sorted(str(p.relative_to(folder)) for p in Path(folder).rglob("*.parquet"))


# --- archives ----------------------------------------------------------------


def test_archive_rows_are_strings_in_the_columns_asked_for(spark, lake):
    drop_archive(lake.raw, "d_2020", POINTS)
    frame = archive_rows(archive_files(spark, lake.raw), all_strings(["points", "game_id"]))
    assert frame.dtypes == [("name", "string"), ("points", "string"), ("game_id", "string")]
    assert sorted(map(tuple, frame.collect())) == [("d_2020", "305", "x81"), ("d_2020", "48", "x93")]


def test_unquoted_empty_is_null_quoted_empty_is_text_and_newlines_survive(spark, lake):
    drop_archive(lake.raw, "d_2020", 'a,b\n,""\n"x\ny",z\n')
    rows = [(r.a, r.b) for r in archive_rows(archive_files(spark, lake.raw), all_strings(["a", "b"])).collect()]
    assert rows == [(None, ""), ("x\ny", "z")]


@pytest.mark.parametrize(
    ("content", "message"),
    [
        (archive_bytes({"a.csv": "x\n1\n", "b.csv": "x\n1\n"}), "holds one CSV, this one 2"),
        (archive_bytes({"a.txt": "x\n1\n"}), "holds one CSV, this one 0"),
        (b"not a real xz archive", "not a readable"),
        (archive_bytes({"a.csv": "x\n" + "1\n" * 90000})[:-40], "not a readable"),
        (archive_bytes({"a.csv": "x\n1,2\n"}), "Expected 1 columns, got 2"),
        (archive_bytes({"a.csv": "y\n1\n"}), "missing=\\['x'\\] unexpected=\\['y'\\]"),
        (archive_bytes({"a.csv": "x,x\n1,2\n"}), "drift"),
    ],
)
def test_a_bad_archive_fails_the_read(spark, content, message):
    frame = spark.createDataFrame([("bad", bytearray(content))], "name STRING, content BINARY")
    with pytest.raises(Exception, match=message):
        archive_rows(frame, all_strings(["x"])).collect()


def rows_of(spark, text, *columns):
    frame = spark.createDataFrame([("d_2020", bytearray(archive_bytes({"a.csv": text})))], "name STRING, content BINARY")
    return archive_rows(frame, all_strings(columns))


def test_empty_lines_are_rows_of_one_column_and_ragged_in_more(spark):
    assert [r.a for r in rows_of(spark, "a\n1\n\n3\n\n", "a").collect()] == ["1", None, "3", None]
    assert rows_of(spark, 'a,b\n"x\n\ny",2\n,\n', "a", "b").count() == 2
    with pytest.raises(Exception, match="an empty line among rows of 2 columns"):
        rows_of(spark, "a,b\n1,2\n\n3,4\n", "a", "b").collect()


def test_a_parser_that_skips_lines_is_found_out(spark, monkeypatch):
    monkeypatch.setitem(archives._PARSING, "ignore_empty_lines", True)
    with pytest.raises(Exception, match="3 records in the CSV, 2 of them parsed"):
        rows_of(spark, "a\n1\n\n3\n", "a").collect()


@pytest.mark.parametrize("text", ['a,b\nx"y,1\nz,"2\n2"\n', 'a,b\r\n"p""q",1\r\nr,2', "a,b\rs,1\rt,2\r"])
def test_records_are_counted_whatever_the_quotes_and_line_ends(spark, text):
    assert rows_of(spark, text, "a", "b").count() == 2
    assert len(rows_of(spark, text, "a", "b").collect()) == 2


def test_very_long_rows_and_headers(spark):
    long = "y" * (40 << 20)
    lengths = rows_of(spark, f"a,b\n1,2\n{long},3\n4,5\n", "a", "b").selectExpr("length(a) AS n", "b").collect()
    assert [tuple(r) for r in lengths] == [(1, "2"), (40 << 20, "3"), (1, "5")]
    name = "c" * 200_000
    frame = spark.createDataFrame([("d", bytearray(archive_bytes({"a.csv": f"{name},b\n1,2\n"})))], "name STRING, content BINARY")
    assert archive_headers(frame).first().columns == [name, "b"]


def test_headers_carry_checksum_and_columns(spark, lake):
    import hashlib

    path = drop_archive(lake.raw, "d_2020", 'game_id,"a,b"\n1,2\n')
    row = archive_headers(archive_files(spark, lake.raw)).first()
    assert row.columns == ["game_id", "a,b"]
    assert row.sha256 == hashlib.sha256(path.read_bytes()).hexdigest()


def test_listing_archives_does_not_open_them(spark, lake):
    drop_archive(lake.raw, "d_2020", POINTS)
    listing = archive_files(spark, lake.raw).select("name")
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString()
    assert [r.name for r in listing.collect()] == ["d_2020"]


def test_bare_csv_is_strings_by_header_and_refuses_ragged_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"x\ny"\n')
    frame = bare_csv(spark, str(tmp_path / "a.csv"))
    assert frame.dtypes == [("a", "string"), ("b", "string")]
    assert [tuple(r) for r in frame.collect()] == [("1", "x\ny")]
    (tmp_path / "b.csv").write_text("a,b\n1,2\n1,2,3\n")
    with pytest.raises(Exception, match="MALFORMED"):
        bare_csv(spark, str(tmp_path / "b.csv")).collect()


# --- publishing --------------------------------------------------------------


def test_an_archive_is_opened_once(spark, lake, monkeypatch, tmp_path):
    """Counted where tasks open files: their functions are shipped by value, with this one in its place."""
    for season in (2021, 2022, 2023):
        drop_archive(lake.raw, f"datanba_{season}", csv_text(schema_for("datanba"), [{}] * 3))
    opened, notes = archives._opened, tmp_path / "opened"
    notes.mkdir()

    def noted(held):
        import uuid

        (notes / uuid.uuid4().hex).write_text(held)
        return opened(held)

    monkeypatch.setattr(archives, "_opened", noted)
    outcome = by_name(load_bronze(spark, lake))
    seen = sorted(p.read_text().rpartition("/")[2] for p in notes.iterdir())
    assert seen == [f"datanba_{s}.tar.xz" for s in (2021, 2022, 2023)]
    assert {r.rows for r in outcome.values()} == {3} and all(len(r.sha256) == 64 for r in outcome.values())


def seasons(spark, lake):
    rows = read_bronze(spark, lake, "datanba", ["evt"], [2022, 2023]).groupBy("season").count().collect()
    return {r.season: r["count"] for r in rows}


def test_a_load_that_stops_between_partitions_changes_nothing(spark, lake, monkeypatch):
    from lakegauge.plans import catalog
    from lakegauge.sinks import published

    def drop(rows):
        for season in (2022, 2023):
            drop_archive(lake.raw, f"datanba_{season}", csv_text(schema_for("datanba"), [{}] * rows))

    drop(2)
    load_bronze(spark, lake)
    catalog.rebuild(spark, lake, prefix="stops_")
    view = "SELECT season, count(*) AS n FROM stops_bronze.datanba GROUP BY season"
    move, moved = published.Files.move, []

    def stops(self, source, target):
        if "/datanba/season=" in target and "/_live/" not in target:
            moved.append(target)
            if len(moved) == 2:
                raise KeyboardInterrupt
        return move(self, source, target)

    drop(5)
    with monkeypatch.context() as patched, pytest.raises(KeyboardInterrupt):
        patched.setattr(published.Files, "move", stops)
        load_bronze(spark, lake, force=True)
    assert len(moved) == 2 and len(files_under(lake.bronze("datanba"))) > 2
    assert seasons(spark, lake) == {2022: 2, 2023: 2}
    assert {r.season: r.n for r in spark.sql(view).collect()} == {2022: 2, 2023: 2}
    load_bronze(spark, lake, force=True)
    assert seasons(spark, lake) == {2022: 5, 2023: 5}
    # The view made before follows, and nothing of the stopped load is left among the partitions.
    assert {r.season: r.n for r in spark.sql(view).collect()} == {2022: 5, 2023: 5}
    assert spark.read.parquet(lake.bronze("datanba")).count() == 10


def test_a_partition_never_published_is_not_landed(spark, lake, monkeypatch):
    from lakegauge.sinks import published

    drop_archive(lake.raw, "datanba_2023", csv_text(schema_for("datanba"), [{}]))
    with monkeypatch.context() as patched, pytest.raises(KeyboardInterrupt):
        patched.setattr(published.Files, "write", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        load_bronze(spark, lake)
    assert landed_partitions(spark, lake.zone("bronze")).isEmpty()
    load_bronze(spark, lake)
    assert [tuple(r) for r in landed_partitions(spark, lake.zone("bronze")).collect()] == [("datanba", 2023, False)]


def test_two_loads_cannot_write_the_same_record(spark, lake, tmp_path):
    from lakegauge.sinks import published

    frame = spark.createDataFrame([(1, 2020, False)], "x INT, season INT, playoffs BOOLEAN")
    path = str(tmp_path / "zone" / "table")
    first, second = published.write_aside(frame, path), published.write_aside(frame, path)
    published.publish(spark, first)
    latest = published._latest
    try:
        published._latest = lambda *_: (0, {})
        with pytest.raises(RuntimeError, match="another load has been published"):
            published.publish(spark, second)
    finally:
        published._latest = latest
    assert spark.read.parquet(path).where(published.is_live(spark, path)).count() == 1


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1 << 20])
def test_lines_are_counted_alike_in_any_blocks(block):
    texts = ["a,b\n1,2\n", 'a\n"x\ny"\n"z""\n"\n', "a\n\nb", "a\r\n\r\nb\r\n", "a\r\rb", '"a\n\nb"\n1', "", "\n", '"\r\r"\n"']
    import io

    for text in texts:
        counted = archives._Counted(io.BytesIO(text.encode()))
        while counted.read(block):
            pass
        outside = "".join(text.split('"')[::2])
        parts = text.split('"')
        empty = any(
            pattern in ("\n" * (i == 0) + part) for i, part in enumerate(parts) if i % 2 == 0 for pattern in ("\n\n", "\n\r\n", "\r\r")
        )
        assert (counted.lines, counted.has_empty) == (outside.count("\n"), empty), text


# --- drift -------------------------------------------------------------------


@pytest.mark.parametrize(
    ("columns", "expected"),
    [
        (["b", "a"], None),
        (["a"], (["b"], [])),
        (["a", "b", "Z", "C"], ([], ["C", "Z"])),
        (["A", "b"], (["a"], ["A"])),
        (["a", "b", "b"], ([], ["b"])),
    ],
)
def test_header_drift(spark, columns, expected):
    headers = spark.createDataFrame([("n", columns)], "name STRING, columns ARRAY<STRING>")
    found = [(r.missing, r.unexpected) for r in header_drift(headers, ["a", "b"]).collect()]
    assert found == ([] if expected is None else [expected])


# --- typed load --------------------------------------------------------------


def test_every_declared_source_loads_with_its_types_and_order(spark, lake):
    for source, schema in SCHEMAS.items():
        drop_archive(lake.raw, f"{source}_2023", csv_text(schema, [{}, {}]))
    outcome = by_name(load_bronze(spark, lake))
    assert {n: r.rows for n, r in outcome.items()} == {f"{s}_2023": 2 for s in SCHEMAS}
    for source, schema in SCHEMAS.items():
        leaf = spark.read.parquet(f"{lake.bronze(source)}/season=2023/playoffs=false")
        assert leaf.schema.names == schema.names
        assert [f.dataType for f in leaf.schema.fields] == [f.dataType for f in schema.fields]


def test_values_keep_their_meaning(spark, lake):
    drop_archive(
        lake.raw,
        "nbastats_2023",
        csv_text(
            schema_for("nbastats"),
            [{"GAME_ID": "0022300061", "SCOREMARGIN": "TIE", "PLAYER2_ID": "", "PLAYER3_ID": "0", "HOMEDESCRIPTION": ""}],
        ),
    )
    drop_archive(
        lake.raw,
        "matchups_2023",
        csv_text(
            schema_for("matchups"),
            [{"jersey_num": "00", "matchup_minutes": "6:20", "partial_possessions": "13.4", "comment": ""}],
        ),
    )
    load_bronze(spark, lake)
    event = read_bronze(spark, lake, "nbastats", schema_for("nbastats").names, [2023]).first()
    assert (event.season, event.GAME_ID, event.SCOREMARGIN) == (2023, "0022300061", "TIE")
    assert (event.PLAYER2_ID, event.PLAYER3_ID, event.HOMEDESCRIPTION) == (None, 0, None)
    pair = read_bronze(spark, lake, "matchups", schema_for("matchups").names, [2023]).first()
    assert (pair.jersey_num, pair.matchup_minutes, pair.partial_possessions, pair.comment) == ("00", "6:20", 13.4, None)


def test_reordered_headers_bind_by_name(spark, lake):
    schema = schema_for("datanba")
    names = list(reversed(schema.names))
    values = [f"{i}" for i in range(len(names))]
    drop_archive(lake.raw, "datanba_2023", ",".join(names) + "\n" + ",".join(values) + "\n")
    load_bronze(spark, lake)
    row = read_bronze(spark, lake, "datanba", ["evt", "GAME_ID"], [2023]).first()
    assert (row.evt, row.GAME_ID) == (22, "0")


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (lambda text: text.replace("EVENTNUM,", "").replace("g1,5,", "g1,"), r"missing=\['EVENTNUM'\]"),
        (lambda text: text.replace("GAME_ID,", "GAME_ID,EXTRA,").replace("g1,", "g1,9,"), r"unexpected=\['EXTRA'\]"),
    ],
)
def test_drift_stops_the_load_before_any_write(spark, lake, change, message):
    text = csv_text(schema_for("nbastats"), [{"GAME_ID": "g1", "EVENTNUM": "5"}])
    drop_archive(lake.raw, "nbastats_2023", change(text))
    drop_archive(lake.raw, "datanba_2023", csv_text(schema_for("datanba"), [{}]))
    with pytest.raises(SchemaDrift, match=message):
        load_bronze(spark, lake)
    assert files_under(lake.base) == []


@pytest.mark.parametrize("value", ["not-a-number", "1.5", "1e3", " 7 ", "9223372036854775808", '""'])
def test_a_bad_value_fails_and_leaves_the_old_table(spark, lake, value):
    schema = schema_for("nbastats")
    drop_archive(lake.raw, "nbastats_2023", csv_text(schema, [{"EVENTNUM": "1"}]))
    load_bronze(spark, lake)
    before = files_under(lake.bronze("nbastats"))
    drop_archive(lake.raw, "nbastats_2023", csv_text(schema, [{"EVENTNUM": "2"}] * 3 + [{"EVENTNUM": value}]))
    with pytest.raises(Exception, match="EVENTNUM does not fit bigint"):
        load_bronze(spark, lake, force=True)
    assert files_under(lake.bronze("nbastats")) == before
    assert [r.EVENTNUM for r in read_bronze(spark, lake, "nbastats", ["EVENTNUM"], [2023]).collect()] == [1]


def test_loading_again_replaces_only_its_own_partition(spark, lake):
    schema = schema_for("nbastats")
    drop_archive(lake.raw, "nbastats_2022", csv_text(schema, [{}] * 2))
    drop_archive(lake.raw, "nbastats_2023", csv_text(schema, [{}] * 3))
    drop_archive(lake.raw, "nbastats_po_2023", csv_text(schema, [{}] * 4))
    load_bronze(spark, lake)
    outcome = by_name(load_bronze(spark, lake, ["nbastats_2023"]))
    assert {n: r.rows for n, r in outcome.items()} == {"nbastats_2023": 3}
    table = spark.read.parquet(lake.bronze("nbastats"))
    counts = {(r.season, str(r.playoffs)): r["count"] for r in table.groupBy("season", "playoffs").count().collect()}
    assert counts == {(2022, "false"): 2, (2023, "false"): 3, (2023, "true"): 4}


def test_a_bare_header_replaces_an_older_load(spark, lake):
    schema = schema_for("datanba")
    drop_archive(lake.raw, "datanba_2022", csv_text(schema, [{}] * 2))
    drop_archive(lake.raw, "datanba_2023", csv_text(schema, [{}] * 3))
    load_bronze(spark, lake)
    drop_archive(lake.raw, "datanba_2023", csv_text(schema, []))
    outcome = by_name(load_bronze(spark, lake, force=True))
    assert {n: r.rows for n, r in outcome.items()} == {"datanba_2022": 2, "datanba_2023": 0}
    assert read_bronze(spark, lake, "datanba", ["evt"], [2023]).count() == 0
    assert read_bronze(spark, lake, "datanba", ["evt"], [2022]).count() == 2


def test_undeclared_sources_and_unknown_names_are_refused(spark, lake):
    drop_archive(lake.raw, "pbpstats_2023", POINTS)
    with pytest.raises(KeyError, match="declared: datanba, matchups, nbastats, shotdetail"):
        load_bronze(spark, lake)
    with pytest.raises(FileNotFoundError, match="nbastats_1999"):
        load_bronze(spark, lake, ["nbastats_1999"])
    with pytest.raises(KeyError, match="no declared schema"):
        schema_for("pbpstats")


def test_a_changed_archive_is_refused_unless_forced(spark, lake):
    schema = schema_for("datanba")
    drop_archive(lake.raw, "datanba_2023", csv_text(schema, [{}]))
    load_bronze(spark, lake)
    drop_archive(lake.raw, "datanba_2023", csv_text(schema, [{}] * 2))
    with pytest.raises(ValueError, match="differ from their recorded checksum: datanba_2023"):
        load_bronze(spark, lake)
    assert by_name(load_bronze(spark, lake, force=True))["datanba_2023"].rows == 2
    assert by_name(load_bronze(spark, lake))["datanba_2023"].rows == 2


def test_checksum_status_against_sidecars(spark, lake):
    import hashlib

    good = drop_archive(lake.raw, "a_2020", POINTS)
    drop_archive(lake.raw, "b_2020", POINTS)
    drop_archive(lake.raw, "c_2020", POINTS)
    Path(f"{good}.sha256").write_text(hashlib.sha256(good.read_bytes()).hexdigest() + "\n")
    (Path(lake.raw) / "b_2020.tar.xz.sha256").write_text("0" * 64 + "\n")
    status = checksum_status(archive_checksums(archive_files(spark, lake.raw)), sidecar_checksums(spark, lake.raw))
    assert {r.name: r.status for r in status.collect()} == {"a_2020": "valid", "b_2020": "stale", "c_2020": "unrecorded"}


def test_an_archive_unlike_its_checksum_file_is_never_loaded(spark, lake):
    path = drop_archive(lake.raw, "datanba_2023", csv_text(schema_for("datanba"), [{}]))
    sidecar = Path(f"{path}.sha256")
    sidecar.write_text("0" * 64 + "\n")
    with pytest.raises(ValueError, match="differ from their checksum file: datanba_2023"):
        load_bronze(spark, lake, force=True)
    import hashlib

    sidecar.write_text(hashlib.sha256(path.read_bytes()).hexdigest() + "\n")
    assert by_name(load_bronze(spark, lake))["datanba_2023"].rows == 1


def test_a_manifest_bounds_the_typed_load(spark, lake):
    for season in (2022, 2023):
        drop_archive(lake.raw, f"datanba_{season}", csv_text(schema_for("datanba"), [{}]))
    manifest = manifest_of(spark, "datanba_2022")
    with pytest.raises(KeyError, match="not in the manifest: datanba_2023"):
        load_bronze(spark, lake, manifest=manifest)
    assert set(by_name(load_bronze(spark, lake, ["datanba_2022"], manifest=manifest))) == {"datanba_2022"}


# --- capture -----------------------------------------------------------------


def test_capture_lands_strings_once(spark, lake):
    names = ["matchups_po_2019", "odd_name", "shots_2020"]
    manifest = manifest_of(spark, *names)
    for name in names:
        drop_archive(lake.raw, name, POINTS)
    first = by_name(capture(spark, lake, manifest))
    assert {n: (r.skipped, r.rows) for n, r in first.items()} == {n: (False, 2) for n in names}
    leaf = spark.read.parquet(f"{lake.captured('matchups')}/season=2019/playoffs=true")
    assert leaf.dtypes == [("game_id", "string"), ("points", "string")]
    assert sorted(r.points for r in leaf.collect()) == ["305", "48"]
    assert {(r.source, r.season, r.playoffs) for r in landed_partitions(spark, lake.capture).collect()} == {
        ("matchups", 2019, True), ("odd_name", None, False), ("shots", 2020, False)
    }
    before = files_under(lake.capture)
    again = by_name(capture(spark, lake, manifest))
    assert {n: (r.skipped, r.rows) for n, r in again.items()} == {n: (True, None) for n in names}
    assert all(r.sha256 == first[n].sha256 for n, r in again.items())
    assert files_under(lake.capture) == before
    assert not list(Path(lake.base).rglob("*.csv"))


def test_capture_loads_what_is_missing_and_force_loads_all(spark, lake):
    manifest = manifest_of(spark, "a_2020", "a_2021")
    drop_archive(lake.raw, "a_2020", POINTS)
    with pytest.raises(FileNotFoundError, match="a_2021"):
        capture(spark, lake, manifest)
    assert by_name(capture(spark, lake, manifest, ["a_2020"]))["a_2020"].skipped is False
    drop_archive(lake.raw, "a_2021", "other\n1\n")
    both = by_name(capture(spark, lake, manifest))
    assert {n: (r.skipped, r.rows) for n, r in both.items()} == {"a_2020": (True, None), "a_2021": (False, 1)}
    forced = by_name(capture(spark, lake, manifest, force=True))
    assert {n: (r.skipped, r.rows) for n, r in forced.items()} == {"a_2020": (False, 2), "a_2021": (False, 1)}


def test_captures_with_the_same_columns_share_a_job(spark, lake, monkeypatch):
    drop_archive(lake.raw, "a_2020", "x,y\n1,2\n")
    drop_archive(lake.raw, "a_2021", "y,x\n3,4\n")
    written, write = [], loads._write_datasets_aside
    monkeypatch.setattr(loads, "_write_datasets_aside", lambda *given: written.append(given) or write(*given))
    capture(spark, lake, manifest_of(spark, "a_2020", "a_2021"))
    assert len(written) == 1
    found = spark.read.parquet(lake.captured("a")).select("season", "x", "y").collect()
    assert sorted(map(tuple, found)) == [(2020, "1", "2"), (2021, "4", "3")]


def test_archives_are_chosen_before_any_is_opened(spark, lake):
    for name in ("a_2020", "b_2020", "b_2021"):
        drop_archive(lake.raw, name, POINTS)
    found = with_name_parts(archive_files(spark, lake.raw)).where("source = 'b'").select("name", "content")
    assert sorted(r.name for r in found.collect()) == ["b_2020", "b_2021"]
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().get("numFiles").get().value() == 2


def test_capture_refuses_a_repeated_column(spark, lake):
    drop_archive(lake.raw, "a_2020", "x,x\n1,2\n")
    with pytest.raises(ValueError, match="a_2020: the header repeats a column"):
        capture(spark, lake, manifest_of(spark, "a_2020"))


def test_capture_refuses_names_outside_the_manifest(spark, lake):
    with pytest.raises(KeyError, match="not in the manifest: nope"):
        capture(spark, lake, manifest_of(spark, "a_2020"), ["nope"])


def test_a_corrupt_archive_lands_nothing(spark, lake):
    drop_archive(lake.raw, "a_2020", POINTS).write_bytes(b"partial")
    with pytest.raises(Exception, match="not a readable"):
        capture(spark, lake, manifest_of(spark, "a_2020"))
    assert files_under(lake.base) == []
    assert landed_partitions(spark, lake.capture).isEmpty()


DOUBLES = {
    "1": 1.0, "1.": 1.0, ".5": 0.5, "-2.5e-3": -0.0025, "+1E5": 100000.0, "NaN": "nan", "inf": float("inf"),
    "-Infinity": float("-inf"), None: None,
}
BIGINTS = {"7": 7, "-7": -7, "+5": 5, "007": 7, "9223372036854775807": 2**63 - 1, "-9223372036854775808": -(2**63), None: None}
BAD = {
    "double": ["1.0d", "1f", " 2.5 ", "0x1p3", "", ".", "e5", "1,5", "nan(1)", "-nan", "+-1"],
    "bigint": ["1.5", "1e3", " 7 ", "", "0x1F", "+", "+-1", "1 2", "9223372036854775808", "-9223372036854775809"],
}


def _seen(values):
    return ["nan" if v != v else v for v in values]


@pytest.mark.parametrize(("kind", "good"), [(DoubleType(), DOUBLES), (LongType(), BIGINTS)])
def test_strict_casts_agree_in_columns_and_in_batches(spark, kind, good):
    texts, name = list(good), kind.simpleString()
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING").orderBy("i")
    cast = frame.select(strict_cast(F.col("t"), kind, "t").alias("v"))
    assert cast.dtypes == [("v", name)]
    assert _seen(r.v for r in cast.collect()) == list(good.values())
    assert _seen(_typed(pa.array(texts, pa.string()), kind, "t").to_pylist()) == list(good.values())
    for bad in BAD[name]:
        with pytest.raises(Exception, match=f"t does not fit {name}"):
            spark.createDataFrame([(bad,)], "t STRING").select(strict_cast(F.col("t"), kind, "t")).collect()
        with pytest.raises(ValueError, match=f"t does not fit {name}"):
            _typed(pa.array(["1", None, bad]), kind, "t")


def test_other_targets_have_no_strict_cast(spark):
    with pytest.raises(TypeError, match="no strict cast to date"):
        strict_cast(F.col("t"), DateType(), "t")


def test_a_load_has_no_shuffle(spark, lake):
    drop_archive(lake.raw, "datanba_2023", csv_text(schema_for("datanba"), [{}]))
    plan = dataset_rows(archive_files(spark, lake.raw), schema_for("datanba"))._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()
