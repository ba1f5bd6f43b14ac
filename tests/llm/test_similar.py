"""Similar texts against all pairs of shingle sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

import lakegauge.llm.partenum as partenum
from lakegauge.llm.components import components, joined_further
from lakegauge.llm.partenum import one_of_each, parity_sketches, similar_texts
from lakegauge.llm.shingles import Sets, shingle_sets, signatures
from lakegauge.llm.textscan import mixed, scan, word_hashes
from llm.conftest import invented
from llm.test_vectors import classes


def shingles(text, width):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))} if words else set()


def plain(rows, width, share):
    sets = [(key, shingles(text, width)) for key, text in rows]
    links = []
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and min(len(x), len(y)) * 100 >= share * max(len(x), len(y)):
                common = len(x & y)
                if 100 * common >= share * (len(x) + len(y) - common):
                    links.append((a, b))
    keys = {key for key, _ in sets if key is not None}
    found = classes(links, keys) | {None: None}
    return sorted(((key, len(x), found[key]) for key, x in sets), key=repr)


def crowd():
    """Families with exact and near copies around the threshold, a crowd of near copies, and a shared passage."""
    source = random.Random(12)
    rows = []

    def add(words):
        rows.append((len(rows), " ".join(words)))

    for size in (4, 6, 9, 15, 25, 60, 150, 400):
        for _ in range(4):
            base = invented(size, len(rows))
            add(base)
            for changes in (0, 1, max(1, size // 60), max(1, size // 40), max(1, size // 25)):
                words = list(base)
                for _ in range(changes):
                    words[source.randrange(size)] = "changed" + str(source.randrange(99))
                add(words)
    base, passage = invented(120, 991), invented(70, 992)
    for _ in range(90):
        words = list(base)
        for _ in range(source.randint(0, 4)):
            words[source.randrange(len(words))] = "other" + str(source.randrange(999))
        add(words)
        add([*invented(20, 5000 + len(rows)), *passage, *invented(15, 9000 + len(rows))])
    return rows


@pytest.mark.parametrize(("width", "share"), [(4, 85), (5, 80)])
def test_no_link_is_lost(spark, monkeypatch, width, share):
    # Small blocks and groups, so that the crowd is cut.
    monkeypatch.setattr(partenum, "BLOCK_CLASSES", 32)
    monkeypatch.setattr(partenum, "GROUP_SIGNATURES", 3000)
    rows = crowd()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = similar_texts(frame, width=width, share=share).collect()
    assert sorted(map(tuple, found), key=repr) == plain(rows, width, share)


def test_tables(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert sorted(map(tuple, similar_texts(documents).collect()), key=repr) == plain(rows, 4, 85)


def test_odd_documents(odd_documents, no_documents):
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    assert sorted(map(tuple, similar_texts(odd_documents).collect()), key=repr) == plain(rows, 4, 85)
    nothing = similar_texts(no_documents)
    assert nothing.columns == ["doc_id", "n_shingles", "component_id"] and nothing.count() == 0


def test_rows_repeating_or_lacking_a_key(spark):
    def words(seed):
        return " ".join(invented(60, seed))

    near = words(1) + " end"
    # 5 has a text near that of 1, and another of its own; 6 two equal rows; the rows without a key copies and others.
    rows = [(1, words(1), "a"), (5, near, "b"), (5, words(2), "c"), (6, words(3), "d"), (6, words(3), "d2")]
    rows += [(None, words(4), "e"), (None, words(4), "e2"), (None, words(4) + " end", "f"), (None, words(5), "g")]
    rows += [(None, words(1), "h"), (None, None, "i"), (None, None, "i2"), (9, "", "j")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    found = [tuple(r) for r in one_of_each(frame).collect()]
    assert one_of_each(frame).schema == frame.schema
    rest = sorted(tag for _, _, tag in found)
    assert [tag for tag in rest if tag not in ("e", "f")] == ["a", "c", "d", "g", "i", "i2", "j"]
    assert len(rest) == 8 and set(found) <= set(rows)
    keyed = [(key, text) for key, text, _ in rows]
    assert sorted(map(tuple, similar_texts(frame).collect()), key=repr) == plain(keyed, 4, 85)


def family_sets():
    source = random.Random(3)
    found = []
    for size in (3, 6, 7, 8, 10, 14, 20, 25, 37, 60, 100, 200, 333, 700):
        for _ in range(10):
            base = source.sample(range(10**6), size)
            for _ in range(4):
                kept = set(source.sample(base, size - source.randint(0, size // 8)))
                found.append(kept | set(source.sample(range(10**6), source.randint(0, size // 10))))
    return found


@pytest.mark.parametrize("share", [80, 85, 95])
def test_linked_sets_share_a_signature_and_pass_the_sketch(share):
    found = family_sets()
    values = [np.sort(mixed(np.array(sorted(x), np.uint64))) for x in found]
    sets = Sets(np.concatenate(values), np.cumsum([0, *map(len, values)]))
    signed = [set() for _ in found]
    for owners, given in signatures(sets, share):
        for a, b in zip(owners.tolist(), given.tolist(), strict=True):
            signed[a].add(b)
    sketches = parity_sketches(sets)
    linked = 0
    for i, x in enumerate(found):
        for j, y in enumerate(found[:i]):
            common = len(x & y)
            if x != y and 100 * common >= share * (len(x) + len(y) - common):
                linked += 1
                assert signed[i] & signed[j]
                near = partenum._adjacency(np.array([len(x), len(y)]), [sketches[i], sketches[j]], share)
                assert near.all()
    assert linked > 10


def test_scanned_words():
    texts = ["", None, " ", "a\x0b\x1cB É x", "Ab c", "x" * 300 + " y", "x" * 300 + "z Ab"]
    words = scan(pa.array(texts).slice(1))
    lowered = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in texts[1:]]
    wanted = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in lowered]
    assert words.counts.tolist() == [len(w) for w in wanted]
    flat = [w for found in wanted for w in found]
    assert [bytes(words.data[a:b]).decode() for a, b in zip(words.starts, words.ends, strict=True)] == flat
    hashes = word_hashes(words).tolist()
    assert len({*zip(flat, hashes, strict=True)}) == len(set(flat)) == len(set(hashes))
    assert shingle_sets(words, 2).sizes.tolist() == [len(shingles(t, 2)) for t in texts[1:]]


def test_texts_sharing_a_passage_are_compared_in_one_pass(spark, monkeypatch):
    """Their lists are long, but no crowds: none of them goes through the rounds."""
    passage = invented(75, 77)
    rows = [(i, " ".join([*invented(12, 1000 + i), *passage, *invented(12, 5000 + i)])) for i in range(400)]
    rows.append((400, rows[7][1] + " end"))
    rounds, central = [], partenum._central

    def counted(members, *others):
        rounds.append(members.count())
        return central(members, *others)

    monkeypatch.setattr(partenum, "_central", counted)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, similar_texts(frame).collect()), key=repr) == plain(rows, 4, 85)
    assert rounds == [0]


def test_few_links_take_few_tasks_and_later_rounds_only_theirs(spark, monkeypatch):
    """Whatever the partitions: a crowd's rounds were dealt to all of them, and each worked on all links again."""
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        source = random.Random(5)
        links = [(a, source.randrange(a)) for a in range(1, 600) if a % 7]
        first = spark.createDataFrame(links[:300], "a long, b long")
        more = spark.createDataFrame([*links[300:], links[3], (5, 5)], "a long, b long")
        joined = components(first, "a", "b")
        whole = joined_further(joined, more)
        assert len(joined.inputFiles()) <= 16 and len(whole.inputFiles()) <= 16
        wanted = {n: least for n, least in classes(links, range(600)).items() if n != least}
        assert sorted(map(tuple, whole.collect())) == sorted(wanted.items())
        assert sorted(map(tuple, joined_further(joined, more.limit(0)).collect())) == sorted(map(tuple, joined.collect()))

        worked, whole = [], partenum.components
        monkeypatch.setattr(partenum, "BLOCK_CLASSES", 32)
        monkeypatch.setattr(partenum, "components", lambda *edges: worked.append(0) or whole(*edges))
        rows = crowd()
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        assert sorted(map(tuple, similar_texts(frame).collect()), key=repr) == plain(rows, 4, 85)
        assert len(worked) == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
