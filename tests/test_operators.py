from __future__ import annotations

import math
import random
from fractions import Fraction

import random

import pytest
from pyspark.sql import functions as F

from lakegauge.functions.game import canonical_game_id, clock_seconds, game_date, score_margin, score_part
from lakegauge.operators import sequence
from lakegauge.operators.aggregates import filtered_min, group_sum
from lakegauge.operators.bitmaps import distinct_bitmaps, distinct_counts, merged_bitmaps
from lakegauge.operators.compare import (
    compare_by_key,
    compare_parts,
    fingerprints,
    identical,
    merged_fingerprints,
    row_differences,
    row_differences_by_part,
)
from lakegauge.operators.coverage import distinct_per_group
from lakegauge.operators.joins import first_keys, mark_matches
from lakegauge.operators.sequence import previous_value, running_total
from lakegauge.sources.manifest import ManifestError, manifest_lines, read_manifest, with_name_parts


@pytest.fixture(scope="module")
def plays(spark):
    return spark.createDataFrame(
        [("q", 20, "stop"), ("p", 31, "swap"), ("q", 4, "serve"), ("p", 6, "start"), ("p", 9, "serve"), ("q", 5, None)],
        "game_id STRING, event_order BIGINT, event_type STRING",
    )


def test_previous_value_stays_within_its_group(plays):
    found = previous_value(plays, "event_type", group_by=["game_id"], order_by=["event_order"], name="before")
    assert [r.before for r in found.orderBy("game_id", "event_order").collect()] == [
        None, "start", "serve", None, "serve", None
    ]


def test_running_total_and_its_nulls(spark):
    frame = spark.createDataFrame(
        [("A", 1, 2), ("A", 2, 3), ("B", 1, 2), ("C", 1, None), ("C", 2, 4), ("C", 3, None), ("C", 4, 1)],
        "g STRING, o BIGINT, points BIGINT",
    )
    found = running_total(frame, "points", group_by=["g"], order_by=["o"], name="total").orderBy("g", "o").collect()
    assert [r.total for r in found] == [2, 5, 2, None, 4, None, 5]


@pytest.mark.parametrize("block_rows", [1, 7, 100])
def test_cutting_large_groups_changes_nothing(spark, monkeypatch, block_rows):
    monkeypatch.setattr(sequence, "_FAN", 3)
    draw = random.Random(block_rows)
    rows = [
        (None if i % 5 == 0 else "hot" if i % 3 == 0 else f"g{i % 50}", draw.choice([None, 1, 2, 3]), i, draw.choice([None, 1, 2, 5]))
        for i in range(1200)
    ]
    frame = spark.createDataFrame(rows, "g STRING, a BIGINT, b BIGINT, v BIGINT")
    for operator in (previous_value, running_total):
        whole = operator(frame, "v", group_by=["g"], order_by=["a", "b"], name="r")
        cut = operator(frame, "v", group_by=["g"], order_by=["a", "b"], name="r", block_rows=block_rows)
        assert cut.columns == whole.columns
        assert identical(whole, cut)


def exact_totals(values):
    """By fractions, rounded once."""
    found, total, unusual = [], Fraction(0), 0.0
    for v in values:
        if v is None:
            found.append(None)
            continue
        total, unusual = (total + Fraction(v), unusual) if math.isfinite(v) else (total, unusual + v)
        found.append(unusual if unusual or unusual != unusual else float(total))
    return found


DOUBLES = {
    "amounts": [round(random.Random(k).uniform(-1e6, 1e6), 2) for k in range(300)],
    "wide": [random.Random(k).uniform(-1, 1) * 2.0 ** random.Random(-k).randint(-90, 90) for k in range(300)],
    "cancelling": [1e16, 1.0, -1e16, 1e-9, 0.1, -0.1, 3.0, -1e-9, -4.0, 0.0, -0.0] * 20,
    "ties": [2.0**53, 1.0, 1.0, -1.0, 2.0**-40, 0.5, 0.5, -(2.0**-40), 1.0, -(2.0**54)] * 20,
    "far apart": [1e300, 1e-300, -1e300, 5e-324, 1e-300, -5e-324] * 30,
    "unusual": [1.0, None, float("inf"), 2.0, None, float("-inf"), 3.0, float("nan"), 4.0],
    "none": [None, None],
    "zero": [0.0, -0.0, None],
}


@pytest.mark.parametrize("name", DOUBLES)
@pytest.mark.parametrize("block_rows", [3, 5_000_000])
def test_running_totals_of_doubles_are_exact(spark, name, block_rows):
    values = DOUBLES[name]
    frame = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "g string, o int, v double")
    found = running_total(frame, "v", group_by=["g"], order_by=["o"], name="t", block_rows=block_rows)
    assert found.dtypes == [("g", "string"), ("o", "int"), ("v", "double"), ("t", "double")]
    totals = [r.t for r in found.orderBy("o").collect()]
    assert list(map(repr, totals)) == list(map(repr, exact_totals(values)))


def test_running_totals_of_floats_are_doubles(spark):
    frame = spark.createDataFrame([("a", 1, 0.1), ("a", 2, 0.2), ("b", 1, None)], "g string, o int, v float")
    found = running_total(frame, "v", group_by=["g"], order_by=["o"], name="t").orderBy("g", "o").collect()
    import numpy as np

    tenth, fifth = float(np.float32(0.1)), float(np.float32(0.2))
    assert [r.t for r in found] == [tenth, float(Fraction(tenth) + Fraction(fifth)), None]


def test_marking_matches(spark):
    rows = [(None if i % 4 == 0 else "hot" if i % 3 == 0 else "gone" if i % 5 == 0 else f"g{i % 7}", i) for i in range(400)]
    left = spark.createDataFrame(rows, "k STRING, i BIGINT")
    right = spark.createDataFrame([("hot",), ("hot",), ("g1",), (None,)], "r STRING")
    found = mark_matches(left, right, left_on=["k"], right_on=["r"])
    assert found.columns == ["k", "i", "matched"]
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1]) == [(k, i, k in ("hot", "g1")) for k, i in rows]


def test_a_hot_key_is_split_when_marking_matches(spark, tmp_path):
    spark.range(200_000).selectExpr("IF(id % 10 = 0, id, 1) AS k", "uuid() AS filler").repartition(8).write.parquet(str(tmp_path / "l"))
    spark.range(5000).selectExpr("id AS r").write.parquet(str(tmp_path / "r"))
    left, right = spark.read.parquet(str(tmp_path / "l")), spark.read.parquet(str(tmp_path / "r"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(name) for name in settings}
    tracker = spark.sparkContext.statusTracker()
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        jobs = len(tracker.getJobIdsForGroup(None))
        found = mark_matches(left, right, left_on=["k"], right_on=["r"])
        assert len(tracker.getJobIdsForGroup(None)) == jobs
        assert sum(r.matched for r in found.collect()) == 180_000 + 500
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_blocks_are_balanced(spark, monkeypatch):
    frame = spark.range(20000).select(F.lit("hot").alias("g"), (F.col("id") * 7919 % 20000).alias("o"))

    def sizes():
        blocks = sequence._blocks(frame, ["g"], ["o"], 500)
        return [r["count"] for r in blocks.number(frame).groupBy("__block").count().collect()]

    found = sizes()
    assert len(found) > 25 and max(found) < 4000
    monkeypatch.setattr(sequence, "_MOST_CUTS", 4)
    assert 1 < len(sizes()) < 15


@pytest.mark.parametrize("operator", [previous_value, running_total])
@pytest.mark.parametrize("block_rows", [1, 5_000_000])
def test_building_a_sequence_starts_no_job_and_ties_raise(spark, operator, block_rows):
    tracker = spark.sparkContext.statusTracker()
    frame = spark.range(60).selectExpr("id % 2 AS g", "id AS o", "id AS v")
    jobs = len(tracker.getJobIdsForGroup(None))
    found = operator(frame, "v", group_by=["g"], order_by=["o"], name="r", block_rows=block_rows)
    assert len(tracker.getJobIdsForGroup(None)) == jobs
    assert found.where("r IS NOT NULL").count() >= 58
    tied = operator(frame.union(frame.where("o = 7")), "v", group_by=["g"], order_by=["o"], name="r", block_rows=block_rows)
    with pytest.raises(Exception, match="equal in o"):
        tied.collect()


def test_sequences_of_an_empty_table_are_empty(spark):
    frame = spark.range(0).selectExpr("id AS g", "id AS o", "id AS v")
    for operator in (previous_value, running_total):
        assert operator(frame, "v", group_by=["g"], order_by=["o"], name="r").isEmpty()


def test_samples_per_group_are_cut_before_the_shuffle(spark):
    frame = spark.range(1000).selectExpr("id % 2 AS s", "id AS k")
    found = first_keys(frame, ["k"], 3, by=["s"])
    assert sorted(map(tuple, found.collect())) == [(0, 0), (0, 2), (0, 4), (1, 1), (1, 3), (1, 5)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange", 1)[1]


def test_group_sum_and_filtered_min(spark):
    teams = spark.createDataFrame([(1, 2), (1, 3), (2, 2)], "team BIGINT, points BIGINT")
    assert sorted(map(tuple, group_sum(teams, ["team"], "points", "s").collect())) == [(1, 5), (2, 2)]
    frame = spark.range(1000).select(F.col("id").alias("a"), F.when(F.col("id") < 500, "x").otherwise("y").alias("g"))
    assert filtered_min(frame, F.col("g") == "y", "a", "m").first().m == 500


def test_filter_reaches_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("id AS a", "string(id) AS g", "id AS unused").write.parquet(str(tmp_path / "t"))
    frame = filtered_min(spark.read.parquet(str(tmp_path / "t")), F.col("g") == "7", "a", "m")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(g,7)" in plan and "unused" not in plan


def test_row_differences_count_duplicates_and_nulls(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "k BIGINT, v STRING")
    b = spark.createDataFrame([(1, None), (2, "x"), (4, "z")], "k BIGINT, v STRING")
    found = {(r.k, r.v): (r.left_rows, r.right_rows) for r in row_differences(a, b).collect()}
    assert found == {(1, None): (2, 1), (3, "y"): (1, 0), (4, "z"): (0, 1)}
    assert identical(a, a) and not identical(a, b)
    assert not identical(a, a.withColumn("k", F.col("k").cast("int")))


def test_compare_by_key_with_repeated_keys(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (3, "x"), (None, "n")], "k BIGINT, v STRING")
    b = spark.createDataFrame([(1, "y"), (1, "x"), (2, "x"), (2, "x"), (4, "x"), (None, "n")], "k BIGINT, v STRING")
    found = {r.k: r.status for r in compare_by_key(a, b, ["k"]).collect()}
    assert found == {1: "match", 2: "mismatch", 3: "left_only", 4: "right_only", None: "match"}


_PARTS = "part STRING, k BIGINT, v STRING"


def test_parts_are_equal_whatever_the_order_of_rows(spark):
    rows = [("a", 1, None), ("a", 1, None), ("a", None, "1"), ("b", 2, "x"), (None, 3, "y"), ("c", 4, "z")]
    a = spark.createDataFrame(rows, _PARTS)
    b = spark.createDataFrame(rows[::-1], _PARTS).repartition(3).select("v", "part", "k")
    assert {(r.part, r.left_rows, r.right_rows, r.equal) for r in compare_parts(a, b, ["part"]).collect()} == {
        ("a", 3, 3, True), ("b", 1, 1, True), (None, 1, 1, True), ("c", 1, 1, True)
    }
    assert row_differences_by_part(a, b, ["part"]).isEmpty()


def test_unequal_parts(spark):
    a = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("b", 1, "x"), (None, 1, "x"), ("d", 1, "x")], _PARTS)
    # A null that stands in another column, a row more often, a part without a name, a part each side lacks.
    b = spark.createDataFrame([("a", None, "1"), ("a", 2, "x"), ("b", 1, "x"), ("b", 1, "x"), (None, 2, "x"), ("e", 1, "x")], _PARTS)
    found = {r.part: (r.left_rows, r.right_rows, r.equal) for r in compare_parts(a, b, ["part"]).collect()}
    assert found == {"a": (2, 2, False), "b": (1, 2, False), None: (1, 1, False), "d": (1, 0, False), "e": (0, 1, False)}
    whole, by_part = row_differences(a, b).collect(), row_differences_by_part(a, b, ["part"]).collect()
    assert len(whole) == 7 and sorted(whole, key=repr) == sorted(by_part, key=repr)


def test_fingerprints_of_parts_merge_into_those_of_the_whole(spark):
    frame = spark.range(1000).selectExpr("id % 7 AS part", "id % 3 AS task", "id % 50 AS v")
    whole = fingerprints(frame.drop("task"), ["part"])
    pieces = [fingerprints(frame.where(f"task = {t}").drop("task"), ["part"]) for t in range(3)]
    merged = merged_fingerprints(pieces[0].unionByName(pieces[1]).unionByName(pieces[2]), ["part"])
    assert sorted(whole.collect()) == sorted(merged.select(whole.columns).collect())


def test_bitmaps_count_as_distinct_does_and_merge(spark):
    values = [0, 1, -1, 32767, 32768, 32769, -32768, -40000, 2**62, None, None, 1]
    rows = [(g, s, v, w) for g in ("a", None) for s in (1, 2) for v, w in zip(values[s:], values[::-1])]
    frame = spark.createDataFrame([*rows, ("n", 1, None, None)], "g STRING, s INT, v BIGINT, w BIGINT")
    wanted = sorted(distinct_per_group(frame, ["g"], ["v", "w"]).collect(), key=repr)
    by_season = distinct_bitmaps(frame, ["g", "s"], ["v", "w"])
    assert sorted(distinct_counts(merged_bitmaps(by_season, ["g"]), ["g"]).collect(), key=repr) == wanted
    assert sorted(distinct_counts(distinct_bitmaps(frame, ["g"], ["v", "w"]), ["g"]).collect(), key=repr) == wanted
    with pytest.raises(TypeError, match="string"):
        distinct_bitmaps(frame, ["s"], ["g"])


# --- manifest and names ------------------------------------------------------


def write(tmp_path, text):
    path = tmp_path / "manifest.txt"
    path.write_bytes(text.encode())
    return str(path)


def test_manifest(spark, tmp_path):
    text = (
        "#feeds\r\n \t\r\n shots_1987\t=  ftp://files.test/s?k=v=w&l \r"
        "pairs_po_2044=https://github.com/me/mine/raw/trunk/p.tar.xz"
    )
    table = read_manifest(spark, write(tmp_path, text))
    assert {r.name: (r.url, r.source, r.season, r.playoffs) for r in table.collect()} == {
        "shots_1987": ("ftp://files.test/s?k=v=w&l", "shots", 1987, False),
        "pairs_po_2044": ("https://raw.githubusercontent.com/me/mine/trunk/p.tar.xz", "pairs", 2044, True),
    }


@pytest.mark.parametrize(
    ("text", "message"),
    [
        ("#x\nk=u:1\n\n  bare words \n", "line 4 lacks a name or an address:   bare words"),
        ("k =  \n", "line 1 lacks a name"),
        ("\n= u:1\n", "line 2 lacks a name"),
        ("k=u:1\nm=u:2\nn=u:3\nm=u:2\nm=u:4\n", "line 4 repeats the name m"),
    ],
)
def test_faulty_manifests(spark, tmp_path, text, message):
    with pytest.raises(ManifestError, match=message):
        read_manifest(spark, write(tmp_path, text))


def test_line_numbers_follow_every_kind_of_line_end(spark, tmp_path):
    path = write(tmp_path, "a\r\nb\rc\n\nd e\x85f")
    found = {r.line_no: r.line for r in manifest_lines(spark, path).collect()}
    assert found == dict(enumerate("a\r\nb\rc\n\nd e\x85f".splitlines(), 1))


def test_name_parts(spark):
    names = {
        "serves_1999": ("serves", 1999, False),
        "rallies_po_2031": ("rallies", 2031, True),
        "east_serves_po_2007": ("east_serves", 2007, True),
        "loose_end": ("loose_end", None, False),
        "_po_2019": ("_po", 2019, False),
        "a_20201": ("a_20201", None, False),
        "2020": ("2020", None, False),
    }
    frame = with_name_parts(spark.createDataFrame([(n,) for n in names], "name STRING"))
    assert {r.name: (r.source, r.season, r.playoffs) for r in frame.collect()} == names


# --- canonical fields --------------------------------------------------------


def one(spark, expression, *texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    return [r.v for r in frame.orderBy("i").select(expression(F.col("t")).alias("v")).collect()]


def test_canonical_fields(spark):
    import datetime

    assert one(spark, canonical_game_id, "22300875", "0022300875", None) == ["0022300875", "0022300875", None]
    assert one(spark, clock_seconds, "12:00", "0:35", "00:50.5", "bad", None) == [720.0, 35.0, 50.5, None, None]
    day = datetime.date(2023, 10, 24)
    assert one(spark, game_date, "20231024", "2023-10-24", "20231399", "x", None) == [day, day, None, None, None]
    assert one(spark, lambda t: score_part(t, 1), "128 - 114", "", None) == [128, None, None]
    assert one(spark, lambda t: score_part(t, 2), "128 - 114") == [114]
    assert one(spark, score_margin, "TIE", "-3", "14", None) == [0, -3, 14, None]
