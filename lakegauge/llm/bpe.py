"""Byte-level BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the last 16 bytes cuts texts where its low bits are zero, so a passage is cut alike
in whichever document it stands. Each task keeps a table of chunks already encoded and takes their ids
from it. Where two chunks meet, the text between the last safe place of the left one and the first safe
place of the right one is encoded again; a safe place is a white-space character after a printable
ASCII one, where the vocabulary's splitting pattern always starts a new word, so an encoding of either
side agrees there with that of the whole text. A chunk without safe places joins the stretch encoded
again, which so grows until both its ends agree.

The table is shared by a task's documents and bounded in bytes; sending every chunk through a shuffle
to share it between tasks too would move more than the text itself, and ids larger than the text back.

Chunks of plain Latin text go to the faster encoder of the same vocabulary; any other character, or the
name of a special token, sends the stretch to the reference library itself.

Edge cases: null counts as empty, and an empty text has no ids; repeated rows are encoded one by one;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Mean bytes of a chunk (a power of two) and bytes of ids and text a task's table may hold.
CHUNK_BYTES = 512
TABLE_BYTES = 64 << 20

_WINDOW = 16
_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)
_BLOCK = 1 << 22

# White space after a printable ASCII character.
_SAFE = re.compile(rb"(?<=[!-~])[ \t\n\r]")
# Characters on which two Unicode tables cannot differ.
_PLAIN = re.compile("[\t\n\r -~¡-ɏ]*")


def _cuts(data: bytes, mean: int) -> list[int]:
    """Places where the rolling hash cuts ``data``, always before a whole character."""
    found: list[np.ndarray] = []
    for start in range(0, len(data), _BLOCK):
        first = max(0, start - _WINDOW)
        raw = np.frombuffer(data, np.uint8, min(len(data), start + _BLOCK) - first, first)
        rolled = _GEAR[raw]
        width = 1
        while width < _WINDOW:
            rolled[width:] += rolled[:-width] << np.uint32(width)
            width *= 2
        # The top bits depend on the whole window; low ones on its last bytes alone.
        at = np.flatnonzero((rolled >> np.uint32(8)) % np.uint32(mean) == 0) + first + 1
        found.append(at[at > start])
    places = np.concatenate(found) if found else np.empty(0, np.int64)
    whole = np.frombuffer(data, np.uint8)
    for _ in range(3):
        inside = places < len(data)
        places[inside] += (whole[places[inside]] & 0xC0) == 0x80
    return np.unique(places[(places > 0) & (places < len(data))]).tolist()


class Codec:
    """Ids of a text by either encoder, and the bytes of ids."""

    def __init__(self, json_path: str, ranks_path: str, pattern: str) -> None:
        import os

        import tiktoken

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.reference = Tokenizer.from_file(json_path)
        self.reference.no_truncation()
        self.reference.no_padding()
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("chunks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        added = self.reference.get_added_tokens_decoder()
        self.special = [token.content for token in added.values()]
        tokens = [b""] * (max([*ranks.values(), *added]) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        for rank, token in added.items():
            tokens[rank] = token.content.encode()
        self.lengths = np.array([len(token) for token in tokens])
        self._starts = np.cumsum(self.lengths) - self.lengths
        self._bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, text: str) -> np.ndarray:
        if _PLAIN.fullmatch(text) and not any(name in text for name in self.special):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.reference.encode(text, add_special_tokens=False).ids, np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        before = np.cumsum(lengths) - lengths
        places = np.arange(lengths.sum()) + np.repeat(self._starts[ids] - before, lengths)
        return self._bytes[places].tobytes()


@lru_cache(maxsize=2)
def load_codec(json_path: str, ranks_path: str, pattern: str) -> Codec:
    return Codec(json_path, ranks_path, pattern)


Stretch = tuple[bytes, bytes]


class ChunkEncoder:
    """Encodes texts chunk by chunk, keeping what it has encoded within ``table_bytes``."""

    def __init__(self, codec: Codec, chunk_bytes: int = CHUNK_BYTES, table_bytes: int = TABLE_BYTES) -> None:
        self.codec, self.chunk_bytes, self.table_bytes = codec, chunk_bytes, table_bytes
        self.known: dict[bytes, Stretch] = {}
        self.held = self.hits = 0

    def _keep(self, data: bytes, entry: Stretch) -> None:
        size = len(data) + len(entry[0]) + len(entry[1]) + 200
        if self.held + size > self.table_bytes:
            self.known.clear()
            self.held = 0
        self.known[data] = entry
        self.held += size

    def _stretches(self, data: bytes) -> Iterator[tuple[bytes, bool]]:
        """``data`` as joints and chunks in turn; chunks (marked True) begin and end at safe places."""
        edges = [0, *_cuts(data, self.chunk_bytes), len(data)] if data else []
        done = 0
        for start, end in zip(edges, edges[1:], strict=False):
            first = _SAFE.search(data, start, end)
            if first is None:
                continue
            # The last safe place: look back from the end, farther each time.
            reach, last = 64, first.start()
            while last == first.start() and reach < 2 * (end - start):
                for match in _SAFE.finditer(data, max(first.start(), end - reach), end):
                    last = match.start()
                reach *= 8
            if last > first.start():
                yield data[done : first.start()], False
                yield data[first.start() : last], True
                done = last
        if done < len(data):
            yield data[done:], False

    def encode(self, text: str) -> list[Stretch]:
        """Ids (little-endian unsigned 32-bit integers) and decoded bytes of the text's stretches, in order.

        The stretches that are not in the table are encoded in one call: each but the first begins
        at a safe place, so the ids of one end where the next one begins.
        """
        result: list[Stretch] = []
        fresh: list[tuple[int, bytes, bool]] = []
        for data, is_chunk in self._stretches(text.encode()):
            entry = self.known.get(data) if is_chunk else None
            if entry is None:
                fresh.append((len(result), data, is_chunk))
            else:
                self.hits += 1
            result.append(entry or (b"", b""))
        if not fresh:
            return result
        ids = self.codec.encode(b"".join(data for _, data, _ in fresh).decode())
        reached = np.cumsum(self.codec.lengths[ids])
        ends = np.cumsum([len(data) for _, data, _ in fresh])
        splits = np.searchsorted(reached, ends, "right")
        decoded, packed = self.codec.decode(ids), ids.astype("<u4").tobytes()
        start = first_id = 0
        for (place, data, is_chunk), end, last_id in zip(fresh, ends.tolist(), splits.tolist(), strict=True):
            entry = packed[4 * first_id : 4 * last_id], decoded[start:end]
            result[place] = entry
            if is_chunk:
                self._keep(data, entry)
            start, first_id = end, last_id
        return result


def encode_documents(
    documents: DataFrame,
    json_path: str,
    ranks_path: str,
    pattern: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
    chunk_bytes: int = CHUNK_BYTES,
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """``key``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` per row; with ``with_ids`` also ``ids``
    (little-endian unsigned 32-bit integers) and the ``decoded`` text.

    ``json_path`` is the vocabulary as the reference library reads it, ``ranks_path`` the same as ranks
    and ``pattern`` its splitting pattern; every worker must be able to open both files.
    """
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    fields = [
        rows.schema["key"],
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ]
    if with_ids:
        rest = StructType.fromDDL("ids BINARY, decoded STRING").fields
        fields = [*fields, *rest]
    schema = StructType(fields)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(load_codec(json_path, ranks_path, pattern), chunk_bytes, table_bytes)
        for batch in batches:
            counts, digests, decodings, all_ids, texts = [], [], [], [], []
            for value in batch.column("text"):
                parts = encoder.encode(value.as_py() or "")
                ids = b"".join(p[0] for p in parts)
                decoded = b"".join(p[1] for p in parts).decode("utf-8", "replace")
                counts.append(len(ids) // 4)
                digests.append(hashlib.sha256(ids).hexdigest())
                decodings.append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    all_ids.append(ids)
                    texts.append(decoded)
            columns = [batch.column("key"), pa.array(counts, pa.int64()), pa.array(digests, pa.string())]
            columns.append(pa.array(decodings, pa.string()))
            if with_ids:
                columns += [pa.array(all_ids, pa.binary()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(encode, schema).withColumnRenamed("key", key)


def decode_ids(ids: bytes, codec: Codec) -> str:
    """The text of ids as stored by :func:`encode_documents`."""
    return codec.decode(np.frombuffer(ids, "<u4")).decode("utf-8", "replace")
