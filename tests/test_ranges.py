"""CSV by byte ranges against a parser that reads the whole file."""

from __future__ import annotations

import csv
import random

import pytest

from lakegauge.sources.ranges import split_csv


@pytest.fixture
def small_ranges(spark):
    """Ranges of some hundred bytes, so that fields span many of them."""
    old = {n: spark.conf.get(n) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


def written(path, rows, **form):
    with path.open("w", newline="") as out:
        csv.writer(out, **form).writerows(rows)


def odd_rows(seed, number=400):
    source = random.Random(seed)
    pieces = ["a", "bc", "\n", '"', ",", "\n\n", '""', " ", "\r\n", "x" * 50, "é"]
    fields = lambda: "".join(source.choices(pieces, k=source.randint(1, 12)))
    rows = [[str(i), fields(), fields()] for i in range(number)]
    # One field over many ranges, one row right after it, and one at the very end.
    rows[number // 2][1] = "long\n" * 700
    rows[-1][2] = 'end"\n' * 400
    return rows


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_many_tasks_read_what_one_reads(spark, tmp_path, small_ranges, seed, end):
    rows = odd_rows(seed)
    for part in (0, 1):
        written(tmp_path / f"{part}.csv", [["i", "a,b", "c"], *rows[part::2]], lineterminator=end)
    frame = split_csv(spark, str(tmp_path))
    assert frame.columns == ["i", "a,b", "c"]
    found = sorted((tuple(r) for r in frame.collect()), key=lambda r: int(r[0]))
    assert found == [tuple(r) for r in rows]
    tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    assert tasks > 20


def test_nulls_empty_texts_and_a_long_header(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text('"i\n' + "x" * 900 + '",b\n1,\n,""\n\n"",\n')
    frame = split_csv(spark, str(tmp_path / "a.csv"))
    assert sorted(map(repr, map(tuple, frame.collect()))) == sorted(map(repr, [("1", None), (None, ""), ("", None)]))


def test_a_bare_header_has_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n")
    assert split_csv(spark, str(tmp_path / "a.csv")).count() == 0


@pytest.mark.parametrize(("text", "message"), [('a,b\n1,"2\n3,4\n', "quotes do not add up"), ("a,b\n1,2\n1,2,3\n", "Expected 2 columns")])
def test_broken_files_raise(spark, tmp_path, text, message):
    (tmp_path / "a.csv").write_text(text)
    with pytest.raises(Exception, match=message):
        split_csv(spark, str(tmp_path / "a.csv")).collect()
