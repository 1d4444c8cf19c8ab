"""Words of many texts at once: runs of bytes other than ASCII white space, as flat arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLACK = np.ones(256, dtype=bool)
BLACK[[0x20, *range(0x09, 0x0E)]] = False


def split(array: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another, and each text's first word among them (one entry more than texts).

    A null text has none.
    """
    array = array.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(array.buffers()[2] or b"", dtype=np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    black = BLACK[data]
    start = black.copy()
    start[1:] &= ~black[:-1]
    heads = bounds[:-1][np.diff(bounds) > 0]
    start[heads] = black[heads]
    first = np.searchsorted(np.flatnonzero(start), bounds)
    kept = data[black]
    offsets = np.append(np.flatnonzero(start[black]), len(kept))
    words = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(kept))
    return words, first


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each word's number among the distinct words, and those."""
    found = words.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def joined(words: pa.Array, first: np.ndarray, stays: np.ndarray | None = None) -> list[bytes]:
    """Each text's words, or those that stay, joined by one space, in UTF-8."""
    if stays is not None and not stays.all():
        words = words.filter(pa.array(stays))
        first = np.append(0, np.cumsum(stays))[first]
    lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), words)
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.large_binary()).to_pylist()
