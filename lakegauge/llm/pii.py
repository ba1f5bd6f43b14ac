"""Personal data in texts: pattern matches, secrets, and terms that give the matched entities away.

Patterns find emails, ip addresses, card and phone numbers. Secrets are words whose own information content is that of
a key: long runs of letters and digits in turn whose characters hold at least ``secret_bits``. They tell all there is to
tell about what they open, so they are taken out, and what stands near them is weighed as for the rest.

The corpus then tells which words near a match are disclosing: with ``n(e)`` documents naming an entity, ``n(t)``
holding a term, ``n(e, t)`` holding it near the entity and ``N`` in all, the pointwise mutual information
log(N n(e,t) / (n(e) n(t))) is compared with the entity's information content log(N / n(e)). A term reaching
``generalise`` of it is replaced by a placeholder, one reaching ``remove`` of it is taken out, wherever it stands: in
other paragraphs and in documents that do not name the entity too.

With rare words chance alone makes such neighbours, so a pair also has to be worth naming: the information it gives,
once for each different surroundings it was seen in, must exceed log(entities * terms), what it takes to single out
one pair of all that were weighed. That holds at every size of table: a pair seen twice can do, a pair seen
once (below ``support``) is never told from chance. Copies of one passage are one surroundings.

Entities are kept as digests. The candidate terms that the second scan counts, and the disclosing ones
whose places the third returns, are folded into a fixed number of bits; what passes is joined with the
table itself.

Edge cases: null counts as empty; an empty table gives an empty result; rows repeating a key are found
one by one, and rows repeating key and text get the same spans; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakegauge.llm.columns import in_small_batches, stored

#: Kinds in their order; the patterns find all but the last two.
KINDS = ("email", "ip", "card", "phone", "term", "secret")
_TERM, _SECRET = KINDS.index("term"), KINDS.index("secret")

#: Words looked at on either side of a match, on its line.
CONTEXT_WORDS = 8
SUPPORT = 2
GENERALISE, REMOVE = 0.8, 0.95

#: A secret's least length, changes between letters and digits in it, and information of its characters.
SECRET_CHARS, SECRET_TURNS, SECRET_BITS = 16, 3, 48.0

_FILTER_WORDS = 1 << 14
#: Terms a task holds before it hands on what it has counted.
_TASK_TERMS = 300_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A run of digits that fails does so from each of its digits, so only its first one is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile("[0-9@]")
_RUN = re.compile(f"(?<![A-Za-z0-9])[A-Za-z0-9]{{{SECRET_CHARS},}}+")
_TURN = re.compile("[A-Za-z][0-9]|[0-9][A-Za-z]")
_WORD = re.compile(r"[^\W_]+")
_NOT_DIGIT = re.compile("[^0-9]")

Span = tuple[int, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@`` so that long runs of letters cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _part_fits(part: str) -> bool:
    digits = part.lstrip("0")
    return len(digits) < 3 or (len(digits) == 3 and digits <= "255")


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """``(start, kind, end)`` of every pattern match, sorted; kinds as numbered in :data:`KINDS`."""
    if not _ANY.search(text):
        return []
    found = [(a, 0, b) for a, b in _emails(text)]
    for match in _IP.finditer(text):
        if all(map(_part_fits, match[0].split("."))):
            found.append((match.start(), 1, match.end()))
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 12:
            digits = _NOT_DIGIT.sub("", match[0])
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((match.start(), 2, match.end()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", match[0])) <= 15:
                found.append((match.start(), 3, match.end()))
    return sorted(found)


def _bits(word: str) -> float:
    """Information of a word's characters, by how often each is in it."""
    return sum(n * math.log2(len(word) / n) for n in Counter(word).values())


def secret_spans(text: str) -> list[Span]:
    """``(start, kind, end)`` of every word that is a key by its own information, sorted."""
    if not _ANY.search(text):
        return []
    return [
        (match.start(), _SECRET, match.end())
        for match in _RUN.finditer(text)
        # Turns are looked for one character on, since they may overlap.
        if sum(bool(_TURN.match(match[0], i)) for i in range(len(match[0]) - 1)) >= SECRET_TURNS
        and _bits(match[0]) >= SECRET_BITS
    ]


def _all_spans(text: str) -> list[Span]:
    return sorted([*base_spans(text), *secret_spans(text)])


def _entity(text: str, span: Span) -> bytes:
    """Digest of what a span names: digits alone for numbers, lower case for the rest."""
    value = text[span[0] : span[2]]
    value = _NOT_DIGIT.sub("", value) if span[1] in (2, 3) else value.lower()
    return hashlib.blake2b(f"{span[1]}:{value}".encode(), digest_size=16).digest()


def _is_term(word: str) -> bool:
    return len(word) >= 3 and not word.isdigit()


def _words_before(text: str, low: int, end: int, width: int) -> list[re.Match]:
    """The last ``width`` words of ``text[low:end]``, found from its end so that a long line costs little."""
    reach = 16 * width
    while True:
        start = max(low, end - reach)
        words = list(_WORD.finditer(text, start, end))
        # The first one may begin before the stretch looked at.
        if start == low or len(words) > width:
            return words[-width:]
        reach *= 4


def _surroundings(text: str, span: Span, spans: list[Span], width: int) -> tuple[int, list[str]]:
    """Hash of the words around a span on its line, and the terms among them outside all spans."""
    low = text.rfind("\n", 0, span[0]) + 1
    high = text.find("\n", span[2])
    high = len(text) if high < 0 else high
    around = _words_before(text, low, span[0], width)
    around += islice(_WORD.finditer(text, span[2], high), width)
    witness = hashlib.blake2b(" ".join(m[0].lower() for m in around).encode(), digest_size=8).digest()
    if around:
        low, high = around[0].start(), around[-1].end()
    overlaps = [s for s in spans if s[0] < high and s[2] > low]
    terms = [
        m[0].lower()
        for m in around
        if _is_term(m[0]) and not any(s[0] < m.end() and m.start() < s[2] for s in overlaps)
    ]
    return int.from_bytes(witness, "little", signed=True), terms


_SPANS = "array<struct<start:int,kind:int,end:int>>"
_NEAR = "array<struct<entity:binary,witness:bigint,term:string>>"


def _found(documents: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """Key, hash of the text, spans of the patterns, of secrets and the terms near both, for every row."""
    rows = documents.select(
        F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")
    )
    schema = StructType([*rows.schema.fields[:2], *StructType.fromDDL(f"base {_SPANS}, secrets {_SPANS}, near {_NEAR}").fields])
    base_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    near_type = pa.list_(pa.struct([("entity", pa.binary()), ("witness", pa.int64()), ("term", pa.string())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, secrets, nears = [], [], []
            for value in batch.column("text"):
                whole = value.as_py() or ""
                parts = base_spans(whole), secret_spans(whole)
                for column, part in zip((bases, secrets), parts, strict=True):
                    column.append([{"start": a, "kind": k, "end": b} for a, k, b in part])
                spans = sorted([*parts[0], *parts[1]])
                near = []
                for span in spans:
                    witness, terms = _surroundings(whole, span, spans, width)
                    entity = _entity(whole, span)
                    near += [{"entity": entity, "witness": witness, "term": term} for term in terms]
                nears.append(near)
            columns = [batch.column("key"), batch.column("text_hash")]
            columns += [pa.array(bases, base_type), pa.array(secrets, base_type), pa.array(nears, near_type)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(find, schema)


def _term_filter(candidates: DataFrame) -> np.ndarray:
    """The candidates' hashes as a bit set of fixed size."""
    place = F.crc32(F.col("term").cast("binary"))
    bits = candidates.select(
        (place % _FILTER_WORDS).cast("int").alias("at"),
        F.expr("shiftleft(1L, CAST(crc32(CAST(reverse(term) AS BINARY)) % 64 AS INT))").alias("bit"),
    )
    table = bits.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(_FILTER_WORDS, np.int64)
    words[table.column("at").to_numpy()] = table.column("bits").to_numpy()
    return words


def _passes(bits: list[int], term: str) -> bool:
    word = bits[zlib.crc32(term.encode()) % _FILTER_WORDS]
    return bool(word >> (zlib.crc32(term[::-1].encode()) % 64) & 1) if word else False


def _document_counts(documents: DataFrame, text: str, candidates: DataFrame) -> DataFrame:
    """``n_t``: in how many rows each candidate term occurs, added up in each task first."""
    bits = _term_filter(candidates).tolist()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}
        counts: Counter[str] = Counter()

        def held() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["term", "n"])

        for batch in batches:
            for value in batch.column("text"):
                terms = set(_WORD.findall((value.as_py() or "").lower()))
                known.update((term, _passes(bits, term)) for term in terms if term not in known)
                counts.update(term for term in terms if known[term])
            if len(known) > _TASK_TERMS:
                known.clear()
            if len(counts) > _TASK_TERMS:
                yield held()
                counts.clear()
        yield held()

    if not any(bits):
        return candidates.select("term", F.lit(0).cast("long").alias("n_t")).limit(0)
    emitted = documents.select(F.col(text).alias("text")).mapInArrow(emit, "term string, n long")
    counted = emitted.groupBy("term").agg(F.sum("n").alias("n_t"))
    return counted.join(candidates, "term", "left_semi")


def _term_places(documents: DataFrame, key: str, text: str, terms: DataFrame) -> DataFrame:
    """``key, text_hash, term, start, end``: where words that may be among ``terms`` stand, outside all other spans."""
    bits = _term_filter(terms).tolist()
    rows = documents.select(
        F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")
    )
    schema = StructType([*rows.schema.fields[:2], *StructType.fromDDL("term string, start int, end int").fields])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}
        for batch in batches:
            rows, terms, starts, ends = [], [], [], []
            for row, value in enumerate(batch.column("text")):
                whole = value.as_py() or ""
                words = set(_WORD.findall(whole))
                known.update((word, _is_term(word) and _passes(bits, word.lower())) for word in words if word not in known)
                if any(known[word] for word in words):
                    spans = _all_spans(whole)
                    firsts = [s[0] for s in spans]
                    # How far matches reach that start no later; they may overlap.
                    reach = list(accumulate((s[2] for s in spans), max))
                    for match in _WORD.finditer(whole):
                        if known[match[0]]:
                            before = bisect_left(firsts, match.end())
                            if not before or reach[before - 1] <= match.start():
                                rows.append(row)
                                terms.append(match[0].lower())
                                starts.append(match.start())
                                ends.append(match.end())
            if len(known) > _TASK_TERMS:
                known.clear()
            if rows:
                columns = [batch.column(name).take(pa.array(rows)) for name in ("key", "text_hash")]
                columns += [pa.array(terms, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return (rows if any(bits) else rows.limit(0)).mapInArrow(emit, schema)


def disclosing_terms(
    documents: DataFrame,
    found: DataFrame,
    text: str,
    *,
    support: int = SUPPORT,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
) -> DataFrame:
    """``entity, term, removed``: the terms telling at least ``generalise`` of what the entity's name tells, and more than
    chance would."""
    near = found.select("key", "text_hash", F.explode("near").alias("n")).select(
        F.struct("key", "text_hash").alias("row"), "n.entity", "n.witness", "n.term"
    )
    per_entity = near.groupBy("entity").agg(F.count_distinct("row").alias("n_e"))
    pairs = near.groupBy("entity", "term").agg(
        F.count_distinct("row").alias("n_et"), F.count_distinct("witness").alias("witnesses")
    )
    weighed = near.agg(F.count_distinct("entity"), F.count_distinct("term")).first()
    singling_out = math.log(max(1, weighed[0]) * max(1, weighed[1]))
    pairs = stored(pairs.where(F.col("witnesses") >= support), "pii-pairs")
    counts = _document_counts(documents, text, pairs.select("term").distinct())
    total = F.lit(float(max(1, documents.count())))
    told = pairs.join(per_entity, "entity").join(counts, "term").where(F.col("n_e") < total)
    told = told.withColumn("given", F.log(F.col("n_et") * total / (F.col("n_e") * F.col("n_t"))))
    told = told.withColumn("share", F.col("given") / F.log(total / F.col("n_e")))
    told = told.where((F.col("share") >= generalise) & (F.col("witnesses") * F.col("given") >= singling_out))
    return stored(told.select("entity", "term", (F.col("share") >= remove).alias("removed")), "pii-terms")


def _spans_with_terms(documents: DataFrame, key: str, text: str, **thresholds: float) -> tuple[DataFrame, DataFrame]:
    """The pattern matches per row, and the disclosing terms' spans per key and text hash."""
    found = stored(_found(documents, key, text, CONTEXT_WORDS), "pii-found")
    terms = disclosing_terms(documents, found, text, **thresholds)
    # A term may disclose several entities; removal wins.
    terms = stored(terms.groupBy("term").agg(F.max("removed").alias("removed")), "pii-disclosing")
    # Rows repeating key and text name a place more than once.
    spans = _term_places(documents, key, text, terms.select("term")).join(terms, "term")
    spans = spans.groupBy("key", "text_hash", "start", "end").agg(F.max("removed").alias("removed"))
    fields = F.struct("start", F.lit(_TERM).alias("kind"), "end", "removed")
    return found, spans.groupBy("key", "text_hash").agg(F.sort_array(F.collect_list(fields)).alias("terms"))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def _beside(rows: DataFrame, extra: DataFrame) -> DataFrame:
    extra = extra.withColumnsRenamed({"key": "__key", "text_hash": "__hash"})
    same = F.col("key").eqNullSafe(F.col("__key")) & (F.col("text_hash") == F.col("__hash"))
    return rows.join(extra, same, "left").drop("__key", "__hash")


def private_spans(documents: DataFrame, *, key: str = "doc_id", text: str = "text", **thresholds: float) -> DataFrame:
    """``key``, ``base``, ``secrets`` and ``terms`` (arrays of start, kind and end in code points, by start) per row.

    ``thresholds``: ``support``, ``generalise`` and ``remove``.
    """
    found, terms = _spans_with_terms(documents, key, text, **thresholds)
    bare = "transform(coalesce(terms, array()), t -> named_struct('start', t.start, 'kind', t.kind, 'end', t.end))"
    return _beside(found.drop("near"), terms).select(
        F.col("key").alias(key), "base", "secrets", F.expr(f"CAST({bare} AS {_SPANS})").alias("terms")
    )


def span_digest(spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts per kind, a digest of the pattern matches and the list of all spans, from :func:`private_spans`."""

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(kind).alias(f"n_{KINDS[kind]}") for kind in range(_TERM)]
    return spans.select(
        key,
        *counts,
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.sort_array(F.concat("base", "terms", "secrets"))).alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
        F.size("secrets").cast("long").alias("n_secret"),
    )


def _redacted(text: str, spans: list[Span], terms: list[tuple[int, int, bool]]) -> str:
    """``text`` with matches and terms replaced; where matches overlap, the stretch gets the first one's name."""
    marks = [(a, b, f"[{KINDS[k].upper()}]") for a, k, b in spans]
    marks += [(a, b, "" if removed else "[TERM]") for a, b, removed in terms]
    out, done = [], 0
    for start, end, mark in sorted(marks):
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]])


@in_small_batches
def sanitise(documents: DataFrame, *, key: str = "doc_id", text: str = "text", **thresholds: float) -> DataFrame:
    """``documents`` with personal data and secrets replaced in ``text``; all other columns unchanged, null text stays null."""
    _, terms = _spans_with_terms(documents, key, text, **thresholds)
    schema = documents.schema
    marked = documents.select(
        F.struct("*").alias("row"), F.col(key).alias("key"), F.xxhash64(text).alias("text_hash")
    )
    marked = _beside(marked, terms).select("row", "terms")
    # The text goes to Python once, beside the other columns.
    marked = marked.select(F.col("row").dropFields(f"`{text}`").alias("row"), F.col("row")[text].alias("text"), "terms")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value, near in zip(batch.column("text"), batch.column("terms"), strict=True):
                whole = value.as_py()
                extra = [(t["start"], t["end"], t["removed"]) for t in near.as_py() or ()]
                texts.append(whole and _redacted(whole, _all_spans(whole), extra))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    row_type = marked.schema["row"].dataType
    replaced = marked.mapInArrow(replace, StructType().add("row", row_type).add("text", "string"))
    replaced = replaced.select(*(F.col("text" if n == text else f"row.`{n}`").alias(n) for n in schema.names))
    return stored(replaced, "sanitised")
