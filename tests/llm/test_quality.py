"""Quality measures against plain Python."""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import pytest

from lakegauge.llm.quality import MEASURES, PRODUCTION, STOP_WORDS, Rule, passing, quality
from lakegauge.llm.queries import ORACLES, QUERIES
from oracle import differences

SF_DIR = "/root/testdata/sf0.01"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    values = (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        len(lines),
        sum(w in STOP_WORDS for w in words),
        text.count("!"),
    )
    return dict(zip(MEASURES, values, strict=True))


def keeps(measured):
    failed = measured["n_words"] < 20 or 100 * measured["n_repeat_words"] > 30 * measured["n_words"]
    for rule in PRODUCTION:
        value = measured[rule.measure] * (100 if rule.per else 1)
        unit = measured[rule.per] if rule.per else 1
        failed |= rule.at_least is not None and value < rule.at_least * unit
        failed |= rule.at_most is not None and value > rule.at_most * unit
    return not failed


def compare(frame, texts):
    rows = quality(frame).collect()
    for row in rows:
        if row.doc_id is None:
            continue
        measured = plain(texts[row.doc_id])
        assert {name: row[name] for name in MEASURES} == measured
        failed = measured["n_words"] < 20 or 100 * measured["n_repeat_words"] > 30 * measured["n_words"]
        assert row.base_failed == failed and row.kept == keeps(measured)
    return rows


def test_tables(documents, texts):
    rows = compare(documents, texts)
    assert 0.6 * len(rows) < sum(r.kept for r in rows) < len(rows)
    assert {r.doc_id for r in passing(documents).collect()} == {r.doc_id for r in rows if r.kept}


@pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables are not here")
def test_query_equals_its_sql(spark):
    name = "op7_quality_rules"
    assert differences(spark, SF_DIR, QUERIES[name], ORACLES[name]) == ""


def test_repeated_windows(spark):
    eight = "a b c d e f g h"
    texts = dict(enumerate([
        f"{eight} {eight}", f"{eight} x {eight}", "z " * 30, f"{eight} {eight} {eight[:-2]}", "a b " * 6 + "c " * 9,
        "same\nsame\n\n same\nsame", "1 2 3 4 5 6 7", "é\x0bü\x0cx  y",
    ]))
    compare(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), texts)


def test_odd_documents(odd_documents, no_documents):
    texts = {r.doc_id: r.text for r in odd_documents.collect()}
    assert len(compare(odd_documents, texts)) == odd_documents.count()
    kept = passing(odd_documents)
    assert kept.schema == odd_documents.schema
    assert quality(no_documents).count() == 0 and passing(no_documents).count() == 0


def test_rules_are_parameters(spark):
    frame = spark.createDataFrame([(1, "word " * 3 + " ".join(map(str, range(40))))], "doc_id long, text string")
    strict = [Rule("n_words", at_most=10)]
    assert not quality(frame, rules=strict).first().kept and quality(frame, rules=[]).first().kept
    plan = frame.transform(quality)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan
