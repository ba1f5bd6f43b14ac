"""Token counts of whole texts: batches of even bytes are encoded in Arrow functions, lengths come back.

A SentencePiece BPE model whose pieces hold the space mark only in front never joins characters
across a word's start, and it puts that mark before every text it is given. So a long text may be cut
at a single space between ASCII letters or digits: the part after it, without the space, encodes as it
does within the whole. A stretch without such a space stays one part.

Edge cases: a null or empty text has 0 bytes and 0 tokens; repeated rows are counted one by one; an
empty table gives an empty result; only the key and the text are read, whatever other columns there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

#: Bytes encoded in one call, and bytes beyond which a text is cut.
BATCH_BYTES = 1 << 20
PART_BYTES = 1 << 16

_SAFE_SPACE = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


@lru_cache(maxsize=2)
def _model(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def safe_parts(text: str, part_bytes: int = PART_BYTES) -> Iterator[str]:
    """``text`` cut at safe spaces into parts of about ``part_bytes`` characters; the spaces are left out."""
    start = 0
    while len(text) - start > part_bytes:
        space = _SAFE_SPACE.search(text, start + part_bytes)
        if space is None:
            break
        yield text[start : space.start()]
        start = space.end()
    yield text[start:]


def _lengths(model, texts: list[str | None], batch_bytes: int, part_bytes: int) -> list[int]:
    """Tokens of each text. No call gets more than about ``batch_bytes``, however the texts are sized."""
    totals = [0] * len(texts)
    owners: list[int] = []
    parts: list[str] = []
    held = 0

    def flush() -> None:
        for owner, ids in zip(owners, model.encode(parts, num_threads=1), strict=True):
            totals[owner] += len(ids)

    for owner, text in enumerate(texts):
        for part in safe_parts(text, part_bytes) if text else ():
            owners.append(owner)
            parts.append(part)
            held += len(part)
            if held >= batch_bytes:
                flush()
                owners, parts, held = [], [], 0
    if parts:
        flush()
    return totals


def token_counts(
    documents: DataFrame,
    model_path: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    limit: int = 4096,
    batch_bytes: int = BATCH_BYTES,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``key``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) per row.

    ``model_path`` names a SentencePiece BPE model that every worker can open.
    """
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = rows.select("key", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    added = [StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())]
    schema = StructType([*rows.schema.fields[:2], *added])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_path)
        for batch in batches:
            counts = _lengths(model, batch.column("text").to_pylist(), batch_bytes, part_bytes)
            over = pa.array([n > limit for n in counts], pa.bool_())
            columns = [batch.column("key"), batch.column("n_bytes"), pa.array(counts, pa.int64()), over]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(count, schema).withColumnRenamed("key", key)
