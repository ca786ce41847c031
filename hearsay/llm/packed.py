"""Texts of an Arrow batch as flat byte arrays, with the words, windows and keys in them.

All functions work on one slice of a batch: ``data`` holds the UTF-8 bytes of its texts one after the
other, ``offsets`` where each begins and, last, where the slice ends. Null texts are empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


SPACE = byte_set((0x20, 0x20), (0x09, 0x0D))
NOT_ALNUM = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits; a bijection (Steele et al. 2014)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_KEYS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def powers(n: int, base: int = BASE) -> np.ndarray:
    result = np.full(n + 1, base, dtype=np.uint64)
    result[0] = 1
    return np.multiply.accumulate(result)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """(first row, end row, data, offsets) of consecutive rows of at most ``limit`` bytes, or of one row."""
    texts = pc.fill_null(batch.column(column).cast(pa.large_binary()), b"")
    rows = len(texts)
    if not rows:
        return
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + rows + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    low = 0
    while low < rows:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + limit, "right")) - 1)
        yield low, high, data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]
        low = high


def find_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray):
    """(starts, ends, word_offsets): the words' bytes, and the first word of each text and the end."""
    inside = ~separators[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = inside[begins]
    stops = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[stops] = inside[stops]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def prefix_keys(data: np.ndarray) -> np.ndarray:
    """Running polynomial of the bytes, from which ``span_keys`` takes the key of any span."""
    result = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_KEYS[data] * powers(len(data))[:-1], out=result[1:])
    return result


def span_keys(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit keys of spans of bytes; equal bytes have equal keys wherever they stand."""
    back = powers(len(prefix), INVERSE)
    return mix((prefix[ends] - prefix[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_keys(prefix_keys(data), starts, ends)


def window_keys(keys: np.ndarray, words: int) -> np.ndarray:
    """Key of the window of ``words`` words that starts at each word; 0 at the last few words."""
    count = len(keys) - words + 1
    result = np.zeros(len(keys), dtype=np.uint64)
    if count > 0:
        total = np.zeros(count, dtype=np.uint64)
        for i in range(words):
            total = total * np.uint64(BASE) + keys[i : i + count]
        result[:count] = mix(total + np.uint64(words))
    return result


def window_starts(word_offsets: np.ndarray, words: int) -> np.ndarray:
    """Whether a window of ``words`` words that starts at each word ends in the same text."""
    lengths = np.diff(word_offsets)
    left = np.repeat(word_offsets[1:], lengths) - np.arange(word_offsets[-1])
    return left >= words


def cover(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of ``size`` places are in a window of ``length`` that starts at a marked place."""
    edge = np.zeros(size + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + length, size), -1)
    return np.cumsum(edge[:-1]) > 0
