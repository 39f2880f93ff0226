"""Arrow text as flat byte arrays: bounded blocks, word and line bounds, n-gram and shingle hashes.

Every function works on whole texts. A null text counts as empty. Memory follows the block (``LIMIT`` bytes of text, or one
longer document), never the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LIMIT = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts behind each other, and where each text begins (one more at the end)."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    first, last = (int(ends[0]), int(ends[-1])) if len(ends) else (0, 0)
    made = np.frombuffer(data, np.uint8, last - first, first) if data is not None and last > first else np.zeros(0, np.uint8)
    return made, (ends - first if len(ends) else np.zeros(1, np.int64))


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = LIMIT) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``limit`` bytes of text; a longer document is a piece of its own."""
    for batch in batches:
        _, at = raw(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; all other bytes stay."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def blank(data: np.ndarray) -> np.ndarray:
    """Whether a byte is a space or one of tab to carriage return."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the splitmix finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


def word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word, and where each text's words begin among them."""
    inside = ~blank(data)
    left = np.empty(len(data), bool)
    if len(data):
        left[0] = True
        left[1:] = ~inside[:-1]
        left[at[:-1][at[:-1] < len(data)]] = True
    starts = np.flatnonzero(inside & left)
    right = np.empty(len(data), bool)
    if len(data):
        right[-1] = True
        right[:-1] = ~inside[1:]
        ends_at = at[1:][at[1:] > 0] - 1
        right[ends_at] = True
    ends = np.flatnonzero(inside & right) + 1
    return starts, ends, np.searchsorted(starts, at)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; the spans are in order, do not overlap and are not empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    value = _BYTE[data[place + np.repeat(starts, size)]] * powers(int(size.max()))[place]
    return mix(np.add.reduceat(value, np.cumsum(size) - size) + size.astype(np.uint64))


def shingles(data: np.ndarray, at: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Each text's set of distinct ``width``-word shingles as sorted 64-bit hashes.

    A-Z is lower-cased. A text with fewer words is one shingle, a text without words has none.
    """
    data = lowered(data)
    starts, ends, first = word_bounds(data, at)
    words = span_hashes(data, starts, ends)
    gram = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for j in range(width):
        gram = gram * np.uint64(_BASE) + words[j : j + len(gram)]
    gram = mix(gram)
    out = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if hi - lo >= width:
            one = np.sort(gram[lo : hi - width + 1])
            out.append(one[np.concatenate(([True], one[1:] != one[:-1]))])
        elif hi > lo:
            h = hi - lo
            for w in words[lo:hi].tolist():
                h = (h * _BASE + w) % 2**64
            out.append(mix(np.array([h], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def grams(data: np.ndarray, at: np.ndarray, sizes: tuple[int, ...], bits: int, spaces: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size: where n-grams of bytes begin and their hash buckets (``2 ** bits`` of them).

    With ``spaces`` an n-gram may begin or end with one blank, its word's edge, but none lies inside. N-grams do not cross texts.
    """
    empty = blank(data)
    value = _BYTE[np.where(empty, np.uint8(32), data)]
    gaps = np.concatenate(([0], np.cumsum(empty, dtype=np.int32)))
    left = np.repeat(at[1:], np.diff(at)) - np.arange(len(data))
    h = np.zeros(len(data), np.uint64)
    done = 0
    for n in sorted(sizes):
        while done < n:
            h = h[: len(data) - done] * np.uint64(_BASE) + value[done:]
            done += 1
        m = len(h)
        if m <= 0:
            continue
        fits = left[:m] >= n
        if n > 2:
            fits &= gaps[n - 1 : n - 1 + m] == gaps[1 : m + 1]
        where = np.flatnonzero(fits)
        yield where, ((h[where] ^ (h[where] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - bits)).astype(np.int64)
