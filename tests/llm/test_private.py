"""Personal data against plain patterns, and disclosing terms on a small corpus."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest

from lakegauge.llm.pii import KINDS, base_spans, private_spans, sanitise, secret_spans, span_digest

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def passes_luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_spans(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            if kind == 1 and any(int(part) > 255 for part in match[0].split(".")):
                continue
            if kind == 2 and not (12 <= len(digits) <= 19 and passes_luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            found.append((match.start(), kind, match.end()))
    return sorted(found)


def plain_secrets(text):
    found = []
    for match in re.finditer("[A-Za-z0-9]+", text):
        word, counts = match[0], Counter(match[0])
        turns = sum(a.isdigit() != b.isdigit() for a, b in zip(word, word[1:]))
        bits = -sum(n * math.log2(n / len(word)) for n in counts.values())
        if len(word) >= 16 and turns >= 3 and bits >= 48:
            found.append((match.start(), 5, match.end()))
    return found


def plain_terms(rows, support, generalise):
    """Places of disclosing terms per row, by counting in plain Python."""
    word = re.compile(r"[^\W_]+")
    named, near, witnesses, holding = defaultdict(set), defaultdict(set), defaultdict(set), Counter()
    for at, (_, text) in enumerate(rows):
        holding.update({w.lower() for w in word.findall(text)})
        spans = sorted([*plain_spans(text), *plain_secrets(text)])
        covered = {i for start, _, end in spans for i in range(start, end)}
        for start, kind, end in spans:
            name = text[start:end].lower() if kind not in (2, 3) else re.sub("[^0-9]", "", text[start:end])
            low = text.rfind("\n", 0, start) + 1
            high = text.find("\n", end) if "\n" in text[end:] else len(text)
            before = [(m.start() + low, m[0]) for m in word.finditer(text[low:start])][-8:]
            after = [(m.start() + end, m[0]) for m in word.finditer(text[end:high])][:8]
            around = " ".join(w.lower() for _, w in before + after)
            for place, w in before + after:
                if len(w) >= 3 and not w.isdigit() and not covered & set(range(place, place + len(w))):
                    pair = (kind, name), w.lower()
                    named[pair[0]].add(at)
                    near[pair].add(at)
                    witnesses[pair].add(around)
    total, least = len(rows), math.log(max(1, len(named)) * max(1, len({t for _, t in near})))
    terms = set()
    for (entity, term), places in near.items():
        n_e, seen = len(named[entity]), len(witnesses[entity, term])
        if n_e < total and seen >= support:
            given = math.log(len(places) * total / (n_e * holding[term]))
            if given / math.log(total / n_e) >= generalise and seen * given >= least:
                terms.add(term)
    found = []
    for key, text in rows:
        covered = {i for a, _, b in [*plain_spans(text), *plain_secrets(text)] for i in range(a, b)}
        places = [(m.start(), m.end()) for m in word.finditer(text) if m[0].lower() in terms]
        found.append((key, [p for p in places if not covered & set(range(*p))]))
    return found


HARD = [
    "a@b@c.de x.y@z.com,foo@bar..com q@r.s.t- +a@b.c %@-.-",
    "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.255 1.2.3 999999.1.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 0000000000000000000000 378282246310005",
    "+1 (555) 010-9999 +12 +1234567890123456 ++49 30 1234567. +1(((((",
    "é1.1.1.1é x@é.com +33 1 23 45 67 89é@a.b",
    "",
]


def test_patterns_on_hard_texts(texts):
    for text in [*HARD, *texts.values()]:
        assert base_spans(text) == plain_spans(text)
        assert secret_spans(text) == plain_secrets(text)


def test_secrets():
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    assert secret_spans(f'token = "{key}", x') == [(9, 5, 49)]
    words = ["internationalisation", "a" * 40, "20240101123000123456", "ABCDEFGHIJKLMNOPQRST2024", key[:15], "a1" * 20]
    assert secret_spans(" ".join(words)) == []


def test_secrets_are_taken_out(spark):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    frame = spark.createDataFrame([(1, f"token = {key}\nend"), (2, "token = none")], "doc_id long, text string")
    assert dict(sanitise(frame).collect()) == {1: "token = [SECRET]\nend", 2: "token = none"}
    digest = {r.doc_id: (r.n_secret, r.spans) for r in span_digest(private_spans(frame)).collect()}
    assert digest == {1: (1, "secret:8:48"), 2: (0, "")}


@pytest.mark.parametrize(("support", "generalise"), [(1, 0.5), (2, 0.3), (2, 0.8)])
def test_terms_against_plain_counting(spark, documents, support, generalise):
    frame = documents.select("doc_id", "text").unionByName(corpus(spark).select("doc_id", "text"))
    # Surroundings beyond a fixed number of characters, and words next to matches without a space between.
    long = "x" * 300
    extra = [(900, f"zebulon {long} {long} y keeper@house.example"), (901, f"id1.2.3.4ip {long}\n{long} zebulon")]
    frame = frame.unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    rows = [(r.doc_id, r.text or "") for r in frame.collect()]
    wanted = plain_terms(rows, support, generalise)
    assert any(places for _, places in wanted)
    found = private_spans(frame, support=support, generalise=generalise).collect()
    got = [(r.doc_id, [(t.start, t.end) for t in r.terms]) for r in found]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


def test_long_runs_take_no_time():
    for text in ("a" * 2_000_000, "1" * 2_000_000, "1." * 500_000, "@" * 500_000, "+1" + "(" * 500_000):
        base_spans(text)
        secret_spans(text)


def test_digest(documents, texts):
    for row in span_digest(private_spans(documents)).collect():
        spans = plain_spans(texts[row.doc_id])
        listed = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert [s for s in row.spans.split(",") if not s.startswith(("term", "secret"))] == listed.split(",")
        assert row.n_secret == len(plain_secrets(texts[row.doc_id])) == row.spans.count("secret:")


def corpus(spark):
    rows = []
    for i in range(6):
        # The house name stands beside one address only; "write" stands everywhere.
        rows.append((i, f"note {i} please write soon{i} to zebulon at keeper@house.example about item{i}", "x"))
    rows += [(100 + i, f"please write about matter {i} to some office", "x") for i in range(60)]
    rows += [(200 + i, f"call other{i} zelda{i} at b{i}@c.example", "x") for i in range(4)]
    return spark.createDataFrame(rows, "doc_id long, text string, base string")


def test_terms_beside_one_entity_are_disclosing(spark):
    frame = corpus(spark)
    texts = dict(frame.select("doc_id", "text").collect())
    found = {row.doc_id: row for row in private_spans(frame).collect()}
    for key in range(6):
        terms = {texts[key][t.start : t.end] for t in found[key].terms}
        assert "zebulon" in terms and not terms & {"write", "please", "about", f"item{key}"}
    assert all(not row.terms for key, row in found.items() if key >= 100)
    cleaned = {row.doc_id: row for row in sanitise(frame).collect()}
    assert "[EMAIL]" in cleaned[0].text and "zebulon" not in cleaned[0].text and cleaned[0].base == "x"
    assert cleaned[100].text == texts[100]


def test_terms_are_marked_wherever_they_stand(spark):
    far = "zebulon came\n" + "plain words " * 40 + "\nkeeper@house.example\n" + "more words " * 40 + "\nthen Zebulon left"
    alone = "here ZEBULON stands alone, not zebulons, and zebulon@house.example is an address"
    rows = [(300, far, "x"), (301, alone, "x"), (None, "zebulon once", "x"), (None, "and zebulon twice", "x")]
    frame = corpus(spark).unionByName(spark.createDataFrame(rows, "doc_id long, text string, base string"))
    # They all count as occurrences, so the term tells less than near its entity alone.
    found = private_spans(frame, generalise=0.6).where("doc_id IS NULL OR doc_id IN (300, 301)").collect()
    places = [(m.start(), m.end()) for m in re.finditer("(?i)zebulon", far)]
    wanted = [(300, places), (301, [(5, 12)]), (None, [(0, 7)]), (None, [(4, 11)])]
    assert len(places) == 2
    got = [(r.doc_id, [(t.start, t.end) for t in r.terms]) for r in found]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    cleaned = [r.text for r in sanitise(frame, generalise=0.6).where("doc_id IS NULL OR doc_id >= 300").collect()]
    assert len(cleaned) == 4 and not any(re.search(r"(?i)\bzebulon\b", text) for text in cleaned)
    assert any("zebulons" in text for text in cleaned)


def test_copies_are_one_witness(spark):
    text = "please write to zebulon at keeper@house.example"
    frame = spark.createDataFrame([(i, text) for i in range(9)] + [(50, "nothing")], "doc_id long, text string")
    assert all(not row.terms for row in private_spans(frame).collect())


def test_odd_documents(odd_documents, no_documents):
    rows = span_digest(private_spans(odd_documents)).collect()
    assert len(rows) == odd_documents.count()
    assert all(row.spans == "" for row in rows)
    cleaned = sanitise(odd_documents)
    assert cleaned.schema == odd_documents.schema
    assert sorted(map(repr, cleaned.collect())) == sorted(map(repr, odd_documents.collect()))
    assert span_digest(private_spans(no_documents)).count() == 0 and sanitise(no_documents).count() == 0
