"""Sets of hashed word shingles, and signatures that sufficiently similar sets share (PartEnum).

A link is a Jaccard similarity of at least ``share`` hundredths. Sets of sizes ``x`` and ``y`` linked so
differ in at most (100 - share) (x + y) / (100 + share) elements. Sizes are cut into bands, and a set has signatures in
its own band and in the larger bands a partner's size may lie in, so a pair meets in the band of its
larger set. Let ``k`` be the most elements a pair of a band can differ in. The domain is dealt to
``k // 2 + 1`` partitions, of which one at least holds no more than one difference, and each of those to
three parts, two of which then agree in full: each pair of parts of a partition gives a signature.

A pair of empty parts tells nothing. ``SPARE`` partitions more than needed are dealt, and a set gives
signatures of empty parts only if it has them in more than ``SPARE`` partitions: two linked sets agree
in ``SPARE + 1`` partitions, and if all of these agree in nothing but emptiness, both give them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from lakegauge.llm.textscan import Words, mixed, word_hashes

PARTS = 3
SPARE = 1
_RATIO = 1.4
_C = np.random.default_rng(5).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


@dataclass(frozen=True)
class Sets:
    """Sets of some texts: set ``t`` is ``values[first[t]:first[t + 1]]``, sorted, without repeats."""

    values: np.ndarray
    first: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.first)

    def __getitem__(self, at: int) -> np.ndarray:
        return self.values[self.first[at] : self.first[at + 1]]

    def keys(self) -> np.ndarray:
        """A 64-bit hash of each set."""
        sums = np.zeros(len(self.values) + 1, np.uint64)
        np.cumsum(mixed(self.values ^ _C[40]), out=sums[1:])
        total = sums[self.first[1:]] - sums[self.first[:-1]]
        return mixed(total ^ (self.sizes.astype(np.uint64) * _C[41]))


def shingle_sets(words: Words, width: int) -> Sets:
    """The distinct shingles of ``width`` words of each text; of a shorter text, all its words as one."""
    hashes, counts = word_hashes(words), words.counts
    texts = np.repeat(np.arange(len(counts)), np.maximum(counts - width + 1, np.minimum(counts, 1)))
    firsts = np.flatnonzero(np.diff(texts, prepend=-1))
    starts = words.first[texts] + np.arange(len(texts)) - np.repeat(firsts, np.diff(firsts, append=len(texts)))
    short = np.minimum(counts, width)[texts]
    values = short.astype(np.uint64) * _C[50]
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    for k in range(width):
        values += np.where(k < short, padded[starts + k] * _C[k], 0).astype(np.uint64)
    values = mixed(values)
    order = np.lexsort((values, texts))
    values, texts = values[order], texts[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (texts[1:] != texts[:-1])
    values, texts = values[new], texts[new]
    return Sets(values, np.searchsorted(texts, np.arange(len(counts) + 1)))


def band_edges(largest: int) -> np.ndarray:
    """Least size of each band, and the end of the last, up to at least ``largest``."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1], int(edges[-1] * _RATIO)) + 1)
    return np.array(edges)


def signatures_per_element(share: int) -> float:
    """About how many signatures a large set has for each of its elements."""
    bands = 1 + math.log(100 / share) / math.log(_RATIO)
    return PARTS * (100 - share) / (100 + share) * (1 + _RATIO) / 2 * bands


def signatures(sets: Sets, share: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of arrays: numbers of sets, and signatures these have.

    Sets too small to be linked with any but an equal one have none.
    """
    sizes = sets.sizes
    edges = band_edges(2 * int(sizes.max(initial=1)) * 100 // share + 2)
    own = np.searchsorted(edges, sizes, "right") - 1
    largest = np.searchsorted(edges, sizes * 100 // share, "right") - 1
    step = 0
    while True:
        chosen = np.flatnonzero((sizes > 0) & (own + step <= largest))
        if not len(chosen):
            return
        yield from _in_band(sets, chosen, (own + step)[chosen], edges, share)
        step += 1


def _in_band(
    sets: Sets, chosen: np.ndarray, bands: np.ndarray, edges: np.ndarray, share: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    apart = 2 * (100 - share) * (edges[bands + 1] - 1) // (100 + share)
    chosen, bands, apart = chosen[apart > 0], bands[apart > 0], apart[apart > 0]
    if not len(chosen):
        return
    partitions = apart // 2 + 1 + SPARE
    sizes = sets.sizes[chosen]
    cells = partitions * PARTS
    base = np.cumsum(cells) - cells
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    values = sets.values[np.repeat(sets.first[chosen], sizes) + within]
    dealt = mixed(values ^ _C[45])
    partition = (dealt >> np.uint64(8)) % np.repeat(partitions, sizes).astype(np.uint64)
    cell = np.repeat(base, sizes) + (partition * np.uint64(PARTS) + dealt % np.uint64(PARTS)).astype(np.int64)
    total = int(cells.sum())
    spread = mixed(values ^ _C[46])
    # Halves of 32 bits add up exactly in doubles.
    low = np.bincount(cell, (spread & np.uint64(0xFFFFFFFF)).astype(float), total).astype(np.uint64)
    high = np.bincount(cell, (spread >> np.uint64(32)).astype(float), total).astype(np.uint64)
    filled = np.bincount(cell, minlength=total)

    def others(per_part: np.ndarray) -> np.ndarray:
        """For each part, the sum of its partition's other parts."""
        grouped = per_part.reshape(-1, PARTS)
        return (grouped.sum(axis=1, keepdims=True, dtype=per_part.dtype) - grouped).ravel()

    empty = others(filled) == 0
    owner = np.repeat(np.arange(len(chosen)), cells)
    place = (np.arange(total) - np.repeat(base, cells)).astype(np.uint64)
    band = bands.astype(np.uint64)[owner]
    found = mixed(others(low) * _C[47] + others(high) * _C[48] + place * _C[49] + band * _C[51])
    bare = np.bincount(owner.reshape(-1, PARTS)[:, 0], empty.reshape(-1, PARTS).any(axis=1), len(chosen))
    given = ~empty | (bare > SPARE)[owner]
    yield chosen[owner[given]], found[given]
