"""Line classes against plain edit distances."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import lakegauge.llm.lines as line_module
from lakegauge.llm.lines import drop_repeated_lines, line_classes, line_links, lines_of, within_edits
from llm.conftest import invented


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def edited(line, edits, source):
    for _ in range(edits):
        at = source.randrange(len(line) + 1)
        kind = source.randrange(3)
        line = line[:at] + ("" if kind == 0 else source.choice("abé")) + line[at + (kind != 1) :]
    return line


def family(seed):
    source = random.Random(seed)
    lines = []
    for n in range(25):
        base = " ".join(invented(source.randint(6, 14), 100 * seed + n))
        lines += [base, *(edited(base, source.randint(1, 4), source) for _ in range(5))]
    lines += ["=" * n for n in range(24, 32)] + ["ab" * n for n in range(12, 17)]
    return lines


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_bit_parallel_distance(spark, edits):
    lines = family(9)[:70]
    pairs = [(a, b) for a in lines for b in lines if abs(len(a) - len(b)) <= edits + 1]
    frame = spark.createDataFrame(pairs, "a string, b string")
    found = frame.select("a", "b", within_edits(F.col("a"), F.col("b"), edits).alias("near")).collect()
    assert sum(r.near for r in found) > 60
    assert all(r.near == (distance(r.a, r.b) <= edits) for r in found)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_no_link_is_lost(spark, edits):
    lines = family(edits)
    frame = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id long, text string")
    rows = lines_of(frame, "doc_id", "text", 24).where("length(line) >= 24")
    names = {r.id: r.line for r in rows.collect()}
    links = line_links(rows, edits).collect()
    found = {frozenset((names[r.a], names[r.b])) for r in links}
    long = sorted({x for x in lines if len(x) >= 24})
    wanted = {
        frozenset((a, b)) for i, a in enumerate(long) for b in long[:i] if distance(a, b) <= edits
    }
    assert found == wanted and len(links) == len(found)


def test_lines_have_eleven_keys_and_their_places_are_found_once(spark, monkeypatch):
    """There were 15 keys, of which three were found twice over and one from the other line; places were found twice."""
    keys = line_module._keys(F.col("line"), F.length("line"), 2)
    found = spark.createDataFrame([("abcdefghijklmnopqrstuvwxyz0123",)], "line string").select(keys.alias("keys")).first()
    assert len({k.k for k in found.keys}) == len(found.keys) == 11
    labels, stored = [], line_module.stored
    monkeypatch.setattr(line_module, "stored", lambda frame, label: labels.append(label) or stored(frame, label))
    line_classes(spark.createDataFrame([(1, "a line of its own\nx")], "doc_id long, text string")).collect()
    assert labels.count("line-places") == 1


def test_a_part_that_moved_between_lines_of_equal_length(spark):
    """One letter goes near the front and one comes near the back, at every pair of places."""
    base = "abcdefghijklmnopqrstuvwxyz01"
    lines = {base} | {base[:a] + base[a + 1 : b] + "#" + base[b:] for a in range(28) for b in range(a + 1, 29)}
    frame = spark.createDataFrame([(i, line) for i, line in enumerate(sorted(lines))], "doc_id long, text string")
    rows = lines_of(frame, "doc_id", "text", 24)
    names = {r.id: r.line for r in rows.collect()}
    links = line_links(rows).collect()
    assert all(distance(names[r.a], names[r.b]) <= 2 for r in links[:500])
    near = {names[r.a] if names[r.b] == base else names[r.b] for r in links if base in (names[r.a], names[r.b])}
    assert near == lines - {base} and len({frozenset((r.a, r.b)) for r in links}) == len(links)


def plain_classes(texts, edits=2, least=24):
    places = [
        ((key, number), line)
        for key, text in sorted(texts.items())
        for number, line in enumerate(text.split("\n"))
        if len(line) >= least or line.strip(" \t\n\v\f\r")
    ]
    kinds = sorted({line for _, line in places})
    root = {line: line for line in kinds}

    def find(line):
        while root[line] != line:
            line = root[line]
        return line

    links = dict.fromkeys(kinds, 0)
    by_size = sorted(kinds, key=len)
    for i, a in enumerate(by_size):
        for b in by_size[i + 1 :]:
            if len(b) - len(a) > edits:
                break
            if len(a) >= least and distance(a, b) <= edits:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    first = {}
    for place, line in places:
        first.setdefault(find(line), place)
    return {place: (*first[find(line)], links[line], place == first[find(line)]) for place, line in places}


def test_classes_and_texts(spark):
    source = random.Random(4)
    pool = family(7)
    # Short lines, equal ones among them, up to and beyond the length from which edits count.
    pool += [source.choice("abc") * n for n in range(1, 31)] + ["  ", "\t", "", " x ", " " * 24]
    texts = {i: "\n".join(source.choices(pool, k=source.randint(1, 9)) + [f"own {i}"]) for i in range(60)}
    rows = [(i, t, f"extra{i}") for i, t in texts.items()]
    frame = spark.createDataFrame(rows, "doc_id long, text string, class_doc string")
    found = line_classes(frame).collect()
    wanted = plain_classes(texts)
    assert {(r.doc_id, r.line_no): (r.class_doc, r.class_line, r.n_links, r.kept) for r in found} == wanted
    kept = {r.doc_id: r for r in drop_repeated_lines(frame).collect()}
    for key, text in texts.items():
        lines = [x for n, x in enumerate(text.split("\n")) if wanted.get((key, n), (0, 0, 0, True))[3]]
        assert kept[key].text == "\n".join(lines) and kept[key].class_doc == f"extra{key}"


def test_documents_of_repeated_lines_alone_go(spark):
    line = "this line stands in both of the documents"
    frame = spark.createDataFrame([(1, line), (2, line + "!\n\n" + line), (3, "")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in drop_repeated_lines(frame).collect()} == {1: line, 3: ""}


def test_short_lines_go_where_they_are_equal(spark):
    rows = [(1, "All rights reserved.\n\nalpha"), (2, "All rights reserved.\n\nbravo"), (3, "All rights reserved?\n \nalpha x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = {1: rows[0][1], 2: "\nbravo", 3: rows[2][1]}
    assert {r.doc_id: r.text for r in drop_repeated_lines(frame).collect()} == wanted


def test_odd_documents(odd_documents, no_documents):
    rows = line_classes(odd_documents).collect()
    assert all(r.kept == ((r.doc_id, r.line_no) == (r.class_doc, r.class_line)) for r in rows)
    cleaned = drop_repeated_lines(odd_documents)
    assert cleaned.schema == odd_documents.schema
    by_key = {r.doc_id: r.text for r in cleaned.where("doc_id IS NOT NULL").collect()}
    assert by_key[0] is None and by_key[1] == "" and by_key[12] == "same line again and again here"
    # Document 5 is document 4 once more; the rows that repeat document 4's key and text are one document.
    assert by_key[4] == "a b c d" and 5 not in by_key and by_key[8] == "A b C d\n"
    assert cleaned.count() == odd_documents.count() - 1
    assert line_classes(no_documents).count() == 0 and drop_repeated_lines(no_documents).count() == 0


def test_rows_sharing_a_key_keep_their_own_lines(spark):
    shared = "a line that stands in several of the documents"
    own = [f"{word} is what this document alone has to say here" for word in ("alpha", "bravo", "charlie", "delta")]
    rows = [(0, f"{own[0]}\n{shared}")]
    for key in (None, 7):
        rows += [(key, f"{shared}\n{own[1]} {key}"), (key, f"{own[2]} {key}\n{shared}"), (key, f"{own[3]} {key}\nx")]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    # Null comes first, so one of the null rows holds the line's first place: line 0 is earliest.
    wanted = [
        (0, own[0]),
        (None, f"{shared}\n{own[1]} None"), (None, f"{own[2]} None"), (None, f"{own[3]} None\nx"),
        (7, f"{own[1]} 7"), (7, f"{own[2]} 7"), (7, f"{own[3]} 7"),
    ]
    assert sorted(map(tuple, drop_repeated_lines(frame).collect()), key=repr) == sorted(wanted, key=repr)
    # Equal places of different texts: one of the two is the first.
    twins = [(None, f"{shared}\n{own[0]}"), (None, f"{shared}\n{own[1]}")]
    twins = spark.createDataFrame(twins, "doc_id int, text string")
    assert sum(r.kept for r in line_classes(twins).collect()) == 3
    kept = "\n".join(r.text for r in drop_repeated_lines(twins).collect()).split("\n")
    assert sorted(kept) == sorted([shared, own[0], own[1]])
