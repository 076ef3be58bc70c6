"""Words of UTF-8 texts as 64-bit hashes, computed over whole Arrow batches with numpy.

Letters A-Z count as a-z; a word is a run of bytes other than space and
\\t \\n \\v \\f \\r. White-space bytes never occur inside a UTF-8 sequence, so
bytes and characters split alike."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text worked on at a time (a longer text is a piece of its own).
PIECE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.Generator(np.random.PCG64(20240229))
# a random odd 64-bit value per byte; A-Z as a-z
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_BYTE[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15 - 2  # 3 modulo 8: powers lose few low bits


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64's finish)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS = powers(256)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows (null: empty)."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``most`` bytes together, or one longer row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


#: For bare words: every ASCII byte but letters and digits separates.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the offsets of each row's words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    black = ~space[data]
    edge = np.zeros(len(data) + 1, bool)  # a row begins here
    edge[offsets] = True
    start, end = black.copy(), black.copy()
    start[1:] &= ~black[:-1] | edge[1:-1]
    end[:-1] &= ~black[1:] | edge[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and the offsets of each row's words."""
    global _POWERS
    starts, ends, of_row = word_spans(data, offsets, space)
    if not len(starts):
        return np.zeros(0, U), of_row
    lens = ends - starts
    longest = int(lens.max())
    if longest > len(_POWERS):
        _POWERS = powers(2 * longest)
    first = np.cumsum(lens) - lens
    within = np.arange(int(lens.sum())) - np.repeat(first, lens)
    value = _BYTE[data[within + np.repeat(starts, lens)]] * _POWERS[within]
    return mix(np.add.reduceat(value, first) ^ (lens.astype(U) * U(0xD6E8FEB86659FD93))), of_row


def shingle_hashes(words: np.ndarray, of_row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words of each row (of the whole row, if
    it has fewer; none without words), and their offsets by row."""
    n = np.diff(of_row)
    out = np.maximum(n - width + 1, (n > 0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(out)])
    total = np.zeros(max(len(words) - width + 1, 0), U)
    for k in range(width):
        total += mix(words[k : len(words) - width + 1 + k] + U(k + 1)) if len(total) else total
    long = n >= width
    where = np.arange(at[-1]) - np.repeat(at[:-1], out) + np.repeat(of_row[:-1], out)
    hashes = np.empty(at[-1], U)
    from_long = np.repeat(long, out)
    hashes[from_long] = mix(total[where[from_long]])
    for r in np.flatnonzero(~long & (n > 0)):
        w = words[of_row[r] : of_row[r + 1]]
        hashes[at[r]] = mix(np.array([sum(int(x) for x in mix(w + np.arange(1, len(w) + 1, dtype=U))) % 2**64 ^ (len(w) << 56)], dtype=U))[0]
    return hashes, at
