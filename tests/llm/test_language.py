"""Language labels: held-out accuracy, spans of mixed texts, and the defined results of odd ones."""

from __future__ import annotations

import zlib

import numpy as np

from lakegauge.llm.langid import LanguageModel, _SCRIPTS, fit, identify, viterbi


def test_held_out_accuracy(documents):
    rows = identify(documents, fit(documents)).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == documents.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in tested) / len(tested) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_bounded_fit_is_as_good(documents):
    rows = identify(documents, fit(documents, fit_rows=60)).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.9


def test_spans_of_mixed_text(spark, documents):
    model = fit(documents)
    by_language = {r.lang: r.text for r in documents.where("length(text) > 1500").collect()}
    parts = [" ".join(by_language[name].split()[:120]) for name in ("en", "fr", "de")]
    text = " \n".join(parts)
    row = identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert [s.lang for s in row.spans] == ["en", "fr", "de"]
    assert row.spans[0].start == 0 and row.spans[-1].end == len(text)
    for span, part in zip(row.spans, parts, strict=True):
        overlap = text[span.start : span.end]
        assert abs(len(overlap) - len(part)) < 60


def test_scripts_narrow_candidates(spark):
    rows = [(i, t, l) for i, (t, l) in enumerate([("это просто текст о языке", "ru"), ("simply a text", "en"),
                                                  ("ein einfacher Text", "de")] * 20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    asked = spark.createDataFrame([(1, "незнакомые слова"), (2, "unknown words"), (3, "中文")], "doc_id long, text string")
    found = {r.doc_id: r.lang_pred for r in identify(asked, fit(frame)).collect()}
    assert found[1] == "ru" and found[2] in ("en", "de") and found[3] in ("ru", "en", "de")


def test_odd_documents(odd_documents, no_documents):
    model = fit(odd_documents)
    rows = identify(odd_documents, model).collect()
    assert len(rows) == odd_documents.count()
    found = {r.doc_id: r for r in rows}
    for key in (0, 1, 2, 9):
        assert (found[key].lang_pred, found[key].score, found[key].spans) == ("und", 0.0, [])
    assert found[3].lang_pred == "en" and found[3].score == 1.0
    assert all(s.end <= 60_000_000 and s.start < s.end for r in rows for s in r.spans)
    assert identify(no_documents, model).count() == 0
    nothing = fit(no_documents)
    assert nothing.languages == []
    assert {r.lang_pred for r in identify(odd_documents, nothing).collect()} == {"und"}


def plain_viterbi(scores, switch):
    best = np.zeros(scores.shape[1])
    back = []
    for row in scores:
        moves = best[None, :] - switch * (1 - np.eye(len(best)))
        back.append(moves.argmax(axis=1))
        best = moves.max(axis=1) + row
    state, path = int(best.argmax()), []
    for step in reversed(back):
        path.append(state)
        state = int(step[state])
    return path[::-1]


def test_viterbi_of_texts_together():
    source = np.random.default_rng(6)
    counts = [0, 5, 1, 40, 0, 17]
    first = np.cumsum([0, *counts])
    scores = source.normal(0, 3, (first[-1], 4)).astype(np.float32)
    labels = viterbi(scores, first, 4.0)
    for a, b in zip(first, first[1:], strict=False):
        assert labels[a:b].tolist() == plain_viterbi(scores[a:b].astype(float), 4.0)


def test_model_is_small():
    assert len(_SCRIPTS) < 32 and LanguageModel([], np.zeros((0, 1)), np.zeros(0)).languages == []
