"""Language of texts and of spans within them.

Each language has the log probabilities of hashed byte trigrams of its words and the scripts its
letters belong to. A word's scripts narrow the languages it may be in, its trigrams score those, and
Viterbi's algorithm with a penalty for changing language labels the words; the label covering most
letter bytes is the text's.

Edge cases: a null text, or one without a letter, is ``und`` with score 0 and no span; a table
without labelled rows gives ``und`` throughout; a null key counts as the empty string when rows are
dealt to training and held-out; repeated rows are labelled one by one; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lakegauge.llm.textscan import Words, scan, text_slices

UNKNOWN = "und"
BUCKETS = 1 << 16

#: At most about this many labelled rows are learned from, chosen by hash of their key.
FIT_ROWS = 200_000

#: Log probability lost by changing language between two words.
SWITCH = 12.0

#: A language writes in a script holding at least this share of its letters.
SCRIPT_SHARE = 0.01

# First code points of ranges of letters by script, from the Unicode charts.
_SCRIPT_RANGES = (
    (0x0000, None), (0x0041, "latin"), (0x005B, None), (0x0061, "latin"), (0x007B, None),
    (0x00C0, "latin"), (0x00D7, None), (0x00D8, "latin"), (0x00F7, None), (0x00F8, "latin"),
    (0x0250, None), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "other"), (0x0E00, "thai"),
    (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, None), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "other"),
    (0xFE00, None), (0x10000, "other"), (0x1F000, None), (0x20000, "han"),
)
_SCRIPTS = sorted({script for _, script in _SCRIPT_RANGES if script})
_RANGE_STARTS = np.array([start for start, _ in _SCRIPT_RANGES])
_RANGE_BITS = np.array([1 << _SCRIPTS.index(s) if s else 0 for _, s in _SCRIPT_RANGES], np.uint32)
_ASCII_BITS = _RANGE_BITS[np.searchsorted(_RANGE_STARTS, np.arange(128), "right") - 1]


@dataclass(frozen=True)
class LanguageModel:
    """Sorted languages, trigram log probabilities (language, bucket) and scripts as bit sets."""

    languages: list[str]
    log_probabilities: np.ndarray
    scripts: np.ndarray


def _script_bits(data: np.ndarray) -> np.ndarray:
    """Script bit of the character each byte begins; 0 for other bytes and characters of no script."""
    bits = np.where(data < 128, _ASCII_BITS[np.minimum(data, 127)], 0).astype(np.uint32)
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        padded = np.append(data, [0, 0, 0]).astype(np.int64)
        b0, b1, b2, b3 = (padded[lead + k] for k in range(4))
        low = ((b0 & 0x1F) << 6) | (b1 & 0x3F)
        middle = ((b0 & 0x0F) << 12) | ((b1 & 0x3F) << 6) | (b2 & 0x3F)
        high = ((b0 & 0x07) << 18) | ((b1 & 0x3F) << 12) | ((b2 & 0x3F) << 6) | (b3 & 0x3F)
        point = np.where(b0 < 0xE0, low, np.where(b0 < 0xF0, middle, high))
        bits[lead] = _RANGE_BITS[np.searchsorted(_RANGE_STARTS, point, "right") - 1]
    return bits


def _features(words: Words, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the words ``low`` to ``high``: trigram bucket and script bit of each of their bytes, and the
    places among those bytes where the words begin."""
    begin, end = int(words.starts[low]), int(words.ends[high - 1])
    data = words.data[begin:end]
    starts, ends = words.starts[low:high] - begin, words.ends[low:high] - begin
    lengths = ends - starts
    firsts = np.cumsum(lengths) - lengths
    places = np.arange(lengths.sum()) + np.repeat(starts - firsts, lengths)
    before = np.empty(len(data), np.uint8)
    before[1:] = data[:-1]
    before[starts] = 32
    after = np.empty(len(data), np.uint8)
    after[:-1] = data[1:]
    after[ends - 1] = 32
    trigram = (before[places].astype(np.uint32) << 16) | (data[places].astype(np.uint32) << 8) | after[places]
    return (trigram * np.uint32(0x9E3779B1)) >> np.uint32(16), _script_bits(data)[places], firsts


def _word_blocks(words: Words, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of words spanning about ``most`` bytes, so that long texts need no long arrays."""
    low, count = 0, len(words.starts)
    while low < count:
        high = int(np.searchsorted(words.ends, words.starts[low] + most, "right"))
        high = max(high, low + 1)
        yield low, high
        low = high


def held_out(key: str = "doc_id", folds: int = 5, fold: int = 0) -> Column:
    """Whether a row is kept from training: crc32 of its key as text leaves ``fold`` modulo ``folds``."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds == fold


def fit(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    fit_rows: int = FIT_ROWS,
) -> LanguageModel:
    """Learn from the labelled rows that are not held out, or about ``fit_rows`` of them.

    Tasks count on their own and emit what they have seen; the sums that reach the driver are bounded
    by the languages times (buckets + scripts).
    """
    rows = documents.where(F.col(text).isNotNull() & F.col(language).isNotNull() & ~held_out(key))
    total = rows.count()
    if total > fit_rows:
        share = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 30)) / float(1 << 30)
        rows = rows.where(share < fit_rows / total)
    rows = rows.select(F.col(language).cast("string").alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            languages = np.array(batch.column("lang").to_pylist(), object)
            for name in set(languages):
                held = counts.setdefault(name, np.zeros(BUCKETS + len(_SCRIPTS), np.int64))
                chosen = batch.column("text").filter(pa.array(languages == name))
                for start, end in text_slices(chosen):
                    words = scan(chosen.slice(start, end - start))
                    for low, high in _word_blocks(words):
                        buckets, bits, _ = _features(words, low, high)
                        held[:BUCKETS] += np.bincount(buckets, minlength=BUCKETS)
                        for i in range(len(_SCRIPTS)):
                            held[BUCKETS + i] += np.count_nonzero(bits == 1 << i)
        for name, held in counts.items():
            found = np.flatnonzero(held)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([name] * len(found), pa.string()),
                    "slot": pa.array(found, pa.int32()),
                    "n": pa.array(held[found], pa.int64()),
                }
            )

    counted = rows.mapInArrow(count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    table = counted.toArrow()
    names = table.column("lang").to_pylist()
    languages = sorted(set(names))
    sums = np.zeros((len(languages), BUCKETS + len(_SCRIPTS)))
    index = {name: i for i, name in enumerate(languages)}
    at = [index[name] for name in names]
    sums[at, table.column("slot").to_numpy()] = table.column("n").to_numpy()
    seen = sums[:, :BUCKETS]
    log_probabilities = np.log((seen + 0.5) / (seen.sum(axis=1, keepdims=True) + 0.5 * BUCKETS))
    letters = sums[:, BUCKETS:]
    written = letters >= SCRIPT_SHARE * np.maximum(letters.sum(axis=1, keepdims=True), 1)
    scripts = (written * (1 << np.arange(len(_SCRIPTS)))).sum(axis=1).astype(np.uint32)
    return LanguageModel(languages, log_probabilities.astype(np.float32), scripts)


def _word_scores(model: LanguageModel, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of each word in each language, and its number of letters."""
    scores = np.empty((len(words.starts), len(model.languages)), np.float32)
    letters = np.empty(len(words.starts), np.int64)
    for low, high in _word_blocks(words):
        buckets, bits, firsts = _features(words, low, high)
        letters[low:high] = np.add.reduceat((bits != 0).astype(np.int64), firsts)
        script = np.bitwise_or.reduceat(bits, firsts)
        for i, table in enumerate(model.log_probabilities):
            scores[low:high, i] = np.add.reduceat(table[buckets], firsts)
        # A language that does not write in any of the word's scripts is no candidate, if another one does.
        possible = (script[:, None] & model.scripts[None, :]) != 0
        narrowed = ~possible & possible.any(axis=1, keepdims=True)
        scores[low:high][narrowed] = -1e9
        scores[low:high][letters[low:high] == 0] = 0
    return scores, letters


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """The best language of every word: texts advance together, a word each per step."""
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    begins, falling = first[:-1][order], counts[order]
    steps = int(falling[0]) if len(falling) else 0
    active = np.searchsorted(-falling, -np.arange(steps), "left")
    languages = scores.shape[1]
    best = np.zeros((len(order), languages))
    stays = np.empty(scores.shape, bool)
    origin = np.empty(len(scores), np.int16)
    for step, n in enumerate(active.tolist()):
        at = begins[:n] + step
        held = best[:n]
        source = held.argmax(axis=1)
        moved = held[np.arange(n), source] - switch
        stay = held >= moved[:, None]
        stays[at], origin[at] = stay, source
        best[:n] = np.where(stay, held, moved[:, None]) + scores[at]
    labels = np.empty(len(scores), np.int16)
    state = best.argmax(axis=1)
    for step in range(steps - 1, -1, -1):
        n = active[step]
        at = begins[:n] + step
        now = state[:n]
        labels[at] = now
        state[:n] = np.where(stays[at, now], now, origin[at])
    return labels


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def identify(
    documents: DataFrame,
    model: LanguageModel,
    *,
    key: str = "doc_id",
    text: str = "text",
    switch: float = SWITCH,
) -> DataFrame:
    """``key``, ``held_out``, ``lang_pred``, ``score`` (the share of letter bytes so labelled) and ``spans``
    (start and end in code points, and the language) of every row."""
    spans = "array<struct<start:int,end:int,lang:string>>"
    rows = documents.select(F.col(key).alias("key"), held_out(key).alias("held_out"), F.col(text).alias("text"))
    rest = StructType.fromDDL(f"lang_pred string, score double, spans {spans}").fields
    schema = StructType([*rows.schema.fields[:2], *rest])
    model_ref = rows.sparkSession.sparkContext.broadcast(model)
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def label(texts: pa.Array) -> tuple[list[str], list[float], list[list[dict]]]:
        model = model_ref.value
        if not model.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts), [[]] * len(texts)
        names, shares, spans = [], [], []
        words = scan(texts)
        scores, letters = _word_scores(model, words)
        labels = viterbi(scores, words.first, switch)
        for i, value in enumerate(texts):
            low, high = words.first[i], words.first[i + 1]
            whole = value.as_py() or ""
            if low == high or not _has_letter(whole):
                names.append(UNKNOWN)
                shares.append(0.0)
                spans.append([])
                continue
            weight = np.bincount(labels[low:high], letters[low:high], len(model.languages))
            if weight.sum() == 0:
                weight = np.bincount(labels[low:high], minlength=len(model.languages)).astype(float)
            top = int(weight.argmax())
            names.append(model.languages[top])
            shares.append(float(weight[top] / weight.sum()))
            changes = np.flatnonzero(np.diff(labels[low:high])) + 1
            edges = [0, *changes.tolist()]
            lasts = [*changes.tolist(), high - low]
            begin = words.starts[low] - len(whole[: _leading(whole)].encode())
            characters = _Characters(words.data[begin : words.ends[high - 1]])
            spans.append(
                [
                    {
                        "start": characters.at(int(words.starts[low + a] - begin)),
                        "end": characters.at(int(words.ends[low + b - 1] - begin)),
                        "lang": model.languages[labels[low + a]],
                    }
                    for a, b in zip(edges, lasts, strict=True)
                ]
            )
        return names, shares, spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in text_slices(batch.column("text")):
                part = batch.slice(start, end - start)
                names, shares, spans = label(part.column("text"))
                columns = [part.column("key"), part.column("held_out"), pa.array(names, pa.string())]
                columns += [pa.array(shares, pa.float64()), pa.array(spans, span_type)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def _leading(text: str) -> int:
    """Characters before the first word."""
    return len(text) - len(text.lstrip(" \t\n\x0b\x0c\r"))


class _Characters:
    """Code points before a byte of UTF-8 data."""

    def __init__(self, data: np.ndarray) -> None:
        self._before = None if data.max(initial=0) < 128 else np.cumsum((data & 0xC0) != 0x80)

    def at(self, place: int) -> int:
        return place if self._before is None else int(self._before[place - 1]) if place else 0
