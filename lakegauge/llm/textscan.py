"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

The six separators are ASCII and so is lower-casing here, so both work on bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a longer text is worked on alone.
SLICE_BYTES = 4 << 20

_IS_WORD = np.ones(256, bool)
_IS_WORD[[32, *range(9, 14)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEEDS = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LONG_WORD = 64


@dataclass(frozen=True)
class Words:
    """Lower-cased bytes of some texts and where their words lie.

    Word ``i`` is ``data[starts[i]:ends[i]]``; text ``t`` has the words ``first[t]`` to ``first[t + 1]``.
    """

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def text_slices(texts: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of ``texts`` of at most ``slice_bytes``, or of one longer text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for at, size in enumerate(sizes.tolist()):
        if held and held + size > slice_bytes:
            yield start, at
            start, held = at, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def scan(texts: pa.Array) -> Words:
    """The words of ``texts``; null has none."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    size = int(edges[-1] - edges[0])
    raw = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]] if size else np.empty(0, np.uint8)
    edges = edges - edges[0]
    inside = _IS_WORD[raw]
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    inner = edges[(edges > 0) & (edges < size)]
    begins[inner] = inside[inner]
    closes[inner - 1] = inside[inner - 1]
    starts = np.flatnonzero(begins)
    return Words(_LOWER[raw], starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, edges))


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word."""
    lengths = words.ends - words.starts
    hashes = np.full(len(lengths), _ODD, np.uint64)
    order = np.argsort(-np.minimum(lengths, _LONG_WORD), kind="stable")
    falling = np.minimum(lengths, _LONG_WORD)[order]
    starts = words.starts[order]
    running = hashes[order]
    # The words still going on at byte k come first in this order.
    going = np.searchsorted(-falling, -np.arange(_LONG_WORD), "left")
    for k, n in enumerate(going.tolist()):
        if n == 0:
            break
        step = (running[:n] ^ _SEEDS[words.data[starts[:n] + k]]) * _ODD
        running[:n] = step ^ (step >> np.uint64(29))
    hashes[order] = running
    for i in np.flatnonzero(lengths > _LONG_WORD):
        digest = hashlib.blake2b(words.data[words.starts[i] : words.ends[i]].tobytes(), digest_size=8)
        hashes[i] = int.from_bytes(digest.digest(), "little")
    return mixed(hashes ^ lengths.astype(np.uint64))
