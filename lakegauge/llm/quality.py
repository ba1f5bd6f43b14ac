"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Every rule bounds a measure, or a measure per hundred of another. Bounds are whole numbers and are
compared without division, so an empty text needs no special case.

Edge cases: a null text has no words and measures 0 throughout; repeated rows are judged one by one;
an empty table gives an empty result; other columns of the input are neither read nor renamed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegauge.llm.columns import let, words_of

SYMBOLS = "[#*$%&|<>]"
WINDOW = 8

# Frequent function words of the languages served.
STOP_WORDS = (
    "a an and are as at be by for from he in is it not of on or that the this to was with "
    "au auf aux avec con das de del dem den der des die du ein eine el elle en es est et für ie il im "
    "ist la las le les los mit nicht no par para pas por pour qui que se su sur un una und une von y zu"
).split()

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_stop_words",
    "n_exclamations",
)


@dataclass(frozen=True)
class Rule:
    """``measure``, or ``measure`` per hundred ``per``, must lie within the bounds given."""

    measure: str
    per: str | None = None
    at_least: int | None = None
    at_most: int | None = None

    def holds(self, measures: Column) -> Column:
        value, unit = measures[self.measure], F.lit(1)
        if self.per is not None:
            value, unit = value * 100, measures[self.per]
        low = F.lit(True) if self.at_least is None else value >= unit * self.at_least
        high = F.lit(True) if self.at_most is None else value <= unit * self.at_most
        return low & high


#: A text failing one of these is rejected whatever the other rules say.
BASE = (
    Rule("n_words", at_least=20),
    Rule("n_repeat_words", per="n_words", at_most=30),
)

#: The rules for production: length, symbol, stop-word and line ratios.
PRODUCTION = (
    Rule("word_chars", per="n_words", at_least=200, at_most=1500),
    Rule("n_symbols", per="n_words", at_most=25),
    Rule("n_exclamations", per="n_words", at_most=40),
    Rule("n_stop_words", per="n_words", at_least=2),
    Rule("n_dup_lines", per="n_lines", at_most=40),
)


def _repeated_words(words: Column) -> Column:
    """Words lying in a window of eight that occurs more than once, the first occurrence included.

    Windows are told apart by a 64-bit hash of their words' hashes and sorted only where one repeats.
    """

    def covered(ordered: Column) -> Column:
        """Words under the windows whose neighbour in hash order is the same window."""

        def repeated(entry: Column, at: Column) -> Column:
            before = F.get(ordered, at - 1)["h"] == entry["h"]
            after = F.get(ordered, at + 1)["h"] == entry["h"]
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        starts = F.sort_array(F.transform(F.filter(ordered, repeated), lambda e: e["i"]))
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            starts,
            zero,
            lambda a, i: F.struct(
                (a["n"] + WINDOW - F.greatest(a["end"] - i, F.lit(0))).alias("n"), (i + WINDOW).alias("end")
            ),
            lambda a: a["n"].cast("long"),
        )

    def count(hashes: Column) -> Column:
        positions = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        windows = F.transform(
            positions, lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(WINDOW)))
        )

        def of(windows: Column) -> Column:
            pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
            same = F.size(F.array_distinct(windows)) == F.size(windows)
            return F.when(same, F.lit(0).cast("long")).otherwise(let(F.sort_array(pairs), covered))

        return F.when(F.size(hashes) < WINDOW, F.lit(0).cast("long")).otherwise(let(windows, of))

    return let(F.transform(words, lambda w: F.xxhash64(w)), count)


def measures(text: str | Column) -> Column:
    """Struct of :data:`MEASURES` of a text, all long."""
    column = F.col(text) if isinstance(text, str) else text
    whole = F.coalesce(column, F.lit(""))

    def kept_length(pattern: str) -> Column:
        return F.length(F.regexp_replace(whole, pattern, ""))

    def of(words: Column, lines: Column) -> Column:
        stop_words = F.size(F.filter(words, lambda w: w.isin(STOP_WORDS)))
        values = (
            F.size(words),
            F.length(F.array_join(words, "")),
            kept_length("[^" + SYMBOLS[1:-1] + "]+"),
            F.size(lines) - F.size(F.array_distinct(lines)),
            _repeated_words(words),
            F.size(lines),
            stop_words,
            kept_length("[^!]+"),
        )
        return F.struct(*(v.cast("long").alias(n) for v, n in zip(values, MEASURES, strict=True)))

    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(words_of(whole), lambda words: let(lines, lambda lines: of(words, lines)))


def verdict(measured: Column, rules: Sequence[Rule]) -> Column:
    """True where every rule holds."""
    result = F.lit(True)
    for rule in rules:
        result = result & rule.holds(measured)
    return result


def quality(
    documents: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = PRODUCTION
) -> DataFrame:
    """``key``, the measures of ``text``, ``base_failed`` and ``kept`` for every row."""
    measured = documents.select(F.col(key), measures(text).alias("__m"))
    base_failed = ~verdict(F.col("__m"), BASE)
    kept = ~base_failed & verdict(F.col("__m"), rules)
    return measured.select(
        key, *(F.col("__m")[n].alias(n) for n in MEASURES), base_failed.alias("base_failed"), kept.alias("kept")
    )


def passing(documents: DataFrame, text: str = "text", rules: Sequence[Rule] = PRODUCTION) -> DataFrame:
    """The rows whose text breaks no rule, their columns unchanged."""
    return documents.where(let(measures(text), lambda m: verdict(m, [*BASE, *rules])))
