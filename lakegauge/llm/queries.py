"""The operators over whole tables with production parameters: name -> function of (session, table folder)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.llm.bpe import encode_documents
from lakegauge.llm.columns import read_table, words_of
from lakegauge.llm.itq import near_vectors
from lakegauge.llm.langid import fit, identify
from lakegauge.llm.lines import line_classes
from lakegauge.llm.multiprobe import nearest_neighbours
from lakegauge.llm.ngram_lm import score_texts
from lakegauge.llm.orchard import vector_codes
from lakegauge.llm.packing import pack
from lakegauge.llm.partenum import similar_texts
from lakegauge.llm.pii import private_spans, span_digest
from lakegauge.llm.quality import STOP_WORDS, quality
from lakegauge.llm.tokens import token_counts
from lakegauge.llm.whitening import whitened_components

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _registered(check: Query) -> Query:
    QUERIES[check.__name__] = check
    return check


@_registered
def op1_token_counts(spark, sf_dir):
    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_registered
def op2_private_spans(spark, sf_dir):
    return span_digest(private_spans(read_table(spark, sf_dir, "documents")))


@_registered
def op4_near_vectors(spark, sf_dir):
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


@_registered
def op5_best_fit(spark, sf_dir):
    """A document takes its words and one end mark."""
    return pack(read_table(spark, sf_dir, "documents"), F.size(words_of("text")) + 1)


@_registered
def op7_quality_rules(spark, sf_dir):
    return quality(read_table(spark, sf_dir, "documents"))


ORACLES["op7_quality_rules"] = f"""
WITH split AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
           [w for w in regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') if w <> ''] AS words,
           [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines
    FROM documents),
words AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split),
windows AS (
    SELECT r, i, list(word) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS eight FROM words),
repeats AS (SELECT r, i, len(eight) = 8 AND count(*) OVER (PARTITION BY r, eight) > 1 AS again FROM windows),
covered AS (
    SELECT r, max(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS under FROM repeats),
counted AS (SELECT r, count(*) FILTER (under) AS n_repeat_words FROM covered GROUP BY r),
measured AS (
    SELECT doc_id, CAST(len(words) AS bigint) AS n_words,
           CAST(length(array_to_string(words, '')) AS bigint) AS word_chars,
           CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS bigint) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS bigint) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words,
           CAST(len(lines) AS bigint) AS n_lines,
           CAST(len([w for w in words if w IN ({", ".join(f"'{w}'" for w in STOP_WORDS)})]) AS bigint) AS n_stop_words,
           CAST(length(regexp_replace(text, '[^!]+', '', 'g')) AS bigint) AS n_exclamations
    FROM split LEFT JOIN counted USING (r)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
SELECT *, NOT base_failed AND 100 * word_chars BETWEEN 200 * n_words AND 1500 * n_words
          AND 100 * n_symbols <= 25 * n_words AND 100 * n_exclamations <= 40 * n_words
          AND 100 * n_stop_words >= 2 * n_words AND 100 * n_dup_lines <= 40 * n_lines AS kept
FROM judged
"""


@_registered
def op9_bpe_chunks(spark, sf_dir):
    return encode_documents(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@_registered
def op10_language(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents")
    labelled = identify(documents, fit(documents))
    return labelled.withColumn("n_spans", F.size("spans").cast("long")).drop("spans")


@_registered
def op6_bigram_scores(spark, sf_dir):
    return score_texts(read_table(spark, sf_dir, "documents"))


@_registered
def op3_line_classes(spark, sf_dir):
    return line_classes(read_table(spark, sf_dir, "documents"))


@_registered
def op8_similar_texts(spark, sf_dir):
    return similar_texts(read_table(spark, sf_dir, "documents"))


@_registered
def op11_orchard_codes(spark, sf_dir):
    return vector_codes(read_table(spark, sf_dir, "embeddings"))


def _nearest(book: str) -> str:
    """Each part's nearest entry of a codebook, the lower index of several."""
    return f"""(
    SELECT r, p, min_by(e, [d, e]) AS e, min(d) AS d
    FROM (SELECT r, p, e, sum((x - y) * (x - y)) AS d FROM components JOIN {book} USING (p, i) GROUP BY ALL) GROUP BY ALL)"""


def _moved(book: str, near: str) -> str:
    """A codebook with its entries at the means of their parts."""
    return f"""(
    SELECT p, i, e, coalesce(m, y) AS y
    FROM {book} LEFT JOIN (
        SELECT p, i, e, CAST(floor(sum(x) / count(*)) AS bigint) AS m
        FROM components JOIN {near} USING (r, p) GROUP BY p, i, e) USING (p, i, e))"""


ORACLES["op11_orchard_codes"] = f"""
WITH kept AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, embedding FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
long AS (SELECT r, generate_subscripts(embedding, 1) - 1 AS place, unnest(embedding) AS x, len(embedding) // 16 AS width FROM kept),
components AS (
    SELECT r, place // width AS p, place % width AS i, CAST(floor(256 * CAST(x AS double)) AS bigint) AS x FROM long),
book0 AS (SELECT p, i, r - 1 AS e, x AS y FROM components WHERE r <= 64),
near0 AS {_nearest("book0")}, book1 AS {_moved("book0", "near0")},
near1 AS {_nearest("book1")}, book2 AS {_moved("book1", "near1")},
coded AS (
    SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS bigint) AS error
    FROM {_nearest("book2")} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS bigint) AS label_error,
       (SELECT sha256(string_agg(CAST(y AS varchar), ',' ORDER BY p, e, i)) FROM book2) AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""


@_registered
def op12_exact_whitening(spark, sf_dir):
    return whitened_components(read_table(spark, sf_dir, "embeddings"))


@_registered
def op13_multiprobe_neighbours(spark, sf_dir):
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
