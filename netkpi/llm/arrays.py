"""Whole texts of an Arrow batch as byte arrays; words and polynomial hashes over them, without a loop over bytes."""
from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

U = np.uint64


def text_slices(column: pa.Array, limit: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of slices of about `limit` bytes; one longer text is a slice.

    Null counts as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offs = np.frombuffer(column.buffers()[1], np.int64, n + 1 + column.offset)[column.offset:]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def byte_table(text: bytes) -> np.ndarray:
    """A table of 256 booleans, true for the bytes given."""
    out = np.zeros(256, bool)
    out[list(text)] = True
    return out


#: Bytes of words set apart by blanks and control characters 9 to 13.
NOT_BLANK = ~byte_table(b" \t\n\x0b\x0c\r")
#: Bytes of words of digits, small letters and all characters beyond ASCII.
LETTERS_DIGITS = byte_table(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))
#: A-Z to a-z, all else as it is.
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def word_spans(data: np.ndarray, offs: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and the word offsets of each text; no word crosses texts."""
    m = np.zeros(len(data) + 1, bool)
    m[:-1] = inside[data]
    start, end = m.copy(), np.zeros(len(data) + 1, bool)
    start[1:] &= ~m[:-1]
    end[1:] = m[:-1] & ~m[1:]
    edges = offs[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    edges = edges[m[edges] & m[edges - 1]]
    start[edges] = True
    end[edges] = True
    s, e = np.flatnonzero(start), np.flatnonzero(end)
    return s, e, np.searchsorted(s, offs)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


#: Bytes of a word up to which the polynomial hash is used.
LONG_WORD = 256


class Rolling:
    """Polynomial hashes modulo 2^64 of any run of units, from running sums; equal runs have equal hashes anywhere."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self) -> None:
        self.powers = self.inverses = np.ones(1, U)
        # a fixed random value for each byte, so that short alphabets spread over all bits
        self.of_byte = mixed(np.arange(1, 257, dtype=U) * U(0xA0761D6478BD642F))

    def _hold(self, n: int) -> None:
        if len(self.powers) <= n:
            size = 1 << int(n).bit_length()
            steps = np.full(size, self.BASE, U)
            steps[0] = 1
            self.powers = np.cumprod(steps, dtype=U)
            steps[1:] = pow(self.BASE, -1, 1 << 64)
            self.inverses = np.cumprod(steps, dtype=U)

    def sums(self, units: np.ndarray) -> np.ndarray:
        self._hold(len(units) + 1)
        out = np.zeros(len(units) + 1, U)
        np.cumsum(units * self.powers[:len(units)], out=out[1:], dtype=U)
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((sums[end] - sums[start]) * self.inverses[start] + (end - start).astype(U))

    def fixed(self, sums: np.ndarray, k: int) -> np.ndarray:
        """Of every run of k units."""
        n = max(0, len(sums) - k)
        return mixed((sums[k:k + n] - sums[:n]) * self.inverses[:n] + U(k))

    def fixed_rows(self, rows: np.ndarray) -> np.ndarray:
        """What `fixed` gives for runs that are rows of an array."""
        self._hold(rows.shape[1] + 1)
        return mixed((rows * self.powers[:rows.shape[1]]).sum(axis=1, dtype=U) + U(rows.shape[1]))

    def words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of words. Unequal words of 1,024 bytes and more can have equal polynomial hashes, so long ones get another hash."""
        out = self.of(self.sums(self.of_byte[data]), start, end)
        for i in np.flatnonzero(end - start > LONG_WORD):
            out[i] = int.from_bytes(blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
        return out


def doc_sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums per text of one value per unit; texts without units get 0."""
    run = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=run[1:])
    return run[offs[1:]] - run[offs[:-1]]
