"""Vectorised text primitives over Arrow batches: words, word hashes, shingle hashes, sliding minima.

All hashes are 64-bit, computed modulo 2**64 from prefix sums, and equal on every machine.
Pieces of at most PIECE bytes are hashed at a time, so memory follows PIECE and the words of one
document, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 19
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=U)
    done = 1
    step = U(base)
    while done < n:
        take = min(done, n - done)
        out[done : done + take] = out[:take] * step
        done += take
        step = step * step
    return out


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)
        return self.up, self.down


BYTE_POWERS, WORD_POWERS, OTHER_POWERS = Powers(0x9E3779B97F4A7C15), Powers(0xD6E8FEB86659FD93), Powers(0xA0761D6478BD642F)
BYTES = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null rows are empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)), offsets


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of one text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    full = ~BLANK[data]
    edge = np.flatnonzero(full[1:] != full[:-1]) + 1
    if full[0]:
        edge = np.concatenate(([0], edge))
    if full[-1]:
        edge = np.concatenate((edge, [len(data)]))
    return edge[0::2], edge[1::2]


def _hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = BYTE_POWERS.get(len(data) + 1)
    total = np.empty(len(data) + 1, dtype=U)
    total[0] = 0
    np.cumsum(BYTES[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U))


def document_words(column: pa.Array, lower: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each row: its word hashes, and the starts and ends of its words in its bytes.

    Rows are hashed together in pieces; a longer row is cut at blanks, so a piece exceeds PIECE only by one word.
    """
    data, offsets = texts(column)
    row, n = 0, len(offsets) - 1
    with np.errstate(over="ignore"):
        while row < n:
            until = row + 1
            while until < n and offsets[until + 1] - offsets[row] <= PIECE:
                until += 1
            base = int(offsets[row])
            part = data[base : int(offsets[until])]
            if lower:
                part = LOWER[part]
            if len(part) <= PIECE:
                bounds = offsets[row : until + 1] - base
                starts, ends = word_bounds(part)
                cuts = bounds[1:-1]
                if len(cuts) and len(starts):  # a word may run over the border of two rows
                    inside = cuts[np.searchsorted(starts, cuts, "left") - np.searchsorted(ends, cuts, "right") == 1]
                    if len(inside):
                        inside = np.unique(inside)
                        starts, ends = np.sort(np.concatenate((starts, inside))), np.sort(np.concatenate((ends, inside)))
                hashes = _hash_words(part, starts, ends)
                at = np.searchsorted(starts, bounds, "left")
                for k in range(until - row):
                    i, j = at[k], at[k + 1]
                    yield hashes[i:j], starts[i:j] - bounds[k], ends[i:j] - bounds[k]
            else:
                starts, ends = word_bounds(part)
                out = np.empty(len(starts), dtype=U)
                i = 0
                while i < len(starts):
                    j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
                    lo = starts[i]
                    out[i:j] = _hash_words(part[lo : ends[j - 1]], starts[i:j] - lo, ends[i:j] - lo)
                    i = j
                yield out, starts, ends
            row = until


def shingles(words: np.ndarray, k: int, powers: Powers = WORD_POWERS) -> np.ndarray:
    """Hash of every run of k words; empty if there are fewer."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    with np.errstate(over="ignore"):
        up, down = powers.get(len(words) + 1)
        total = np.empty(len(words) + 1, dtype=U)
        total[0] = 0
        np.cumsum(words * up[: len(words)], out=total[1:])
        return mix((total[k:] - total[:n]) * down[:n])


def whole(words: np.ndarray) -> int:
    """Hash of the whole sequence."""
    with np.errstate(over="ignore"):
        up, _ = WORD_POWERS.get(len(words) + 1)
        return int(mix(np.array([(words * up[: len(words)]).sum(dtype=U) + U(len(words))], dtype=U))[0])


def last_minimum(x: np.ndarray, span: int) -> np.ndarray:
    """For each run of span values, the position of its smallest, the last of equals."""
    n = len(x) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.arange(len(x), dtype=np.int64)
    width = 1
    while width < span:  # best position of runs of doubling width
        step = min(width, span - width)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(x[right] <= x[left], right, left)
        width += step
    return at


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, dtype=np.int64).view(U)
