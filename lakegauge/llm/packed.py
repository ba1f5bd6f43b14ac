"""Integer arrays as bytes that compress well: differences, with bytes of equal weight side by side."""

from __future__ import annotations

import numpy as np


def pack_integers(values: np.ndarray) -> bytes:
    """Non-negative integers of up to 64 bits; leading planes that are all zero are left out."""
    values = np.ascontiguousarray(values, "<u8")
    planes = values.view(np.uint8).reshape(-1, 8).T
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + planes[:width].tobytes()


def unpack_integers(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.zeros((8, (len(data) - 1) // width), np.uint8)
    planes[:width] = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack_integers(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_integers(data), dtype=np.uint64)
