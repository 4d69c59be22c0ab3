"""Vectorised word and window hashing over Arrow text columns (numpy, inside Spark tasks).

A word is a maximal run of bytes other than space and 0x09-0x0D. Hashes are Rabin-Karp
hashes in prefix-sum form, modulo 2**64: with ``S[i] = sum(v[j] * B**j, j < i)`` the hash of
``[a, b)`` is ``(S[b] - S[a]) * B**-a``, whatever the place; B is odd and so invertible.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text is hashed in slices of about so many bytes (whole documents), which bounds a task's memory.
SLICE_BYTES = 1 << 20

_U = np.uint64
_SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and shift)."""
    with np.errstate(over="ignore"):
        h = h + _U((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
        h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
        return h ^ (h >> _U(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64 for i < n."""
    out = []
    for b in (base, pow(base, -1, 2**64)):
        p = np.full(max(n, 1), b, _U)
        p[0] = 1
        with np.errstate(over="ignore"):
            out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Roller:
    """Hashes of any ranges of a sequence; the power tables grow with the longest one seen."""

    def __init__(self, base: int):
        self.base = base | 1
        self.up, self.down = powers(self.base, 1 << 12)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        if len(values) >= len(self.up):
            self.up, self.down = powers(self.base, 2 * len(values) + 1)
        s = np.zeros(len(values) + 1, _U)
        with np.errstate(over="ignore"):
            np.cumsum(values * self.up[: len(values)], out=s[1:])
        return s

    def ranges(self, s: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (s[b] - s[a]) * self.down[a]

    def windows(self, s: np.ndarray, width: int) -> np.ndarray:
        """Of all windows of that width, in order; empty if the sequence is shorter."""
        n = len(s) - width
        if n <= 0:
            return np.zeros(0, _U)
        with np.errstate(over="ignore"):
            return (s[width:] - s[:n]) * self.down[:n]


def byte_values() -> np.ndarray:
    return mix(np.arange(256, dtype=_U), 11)


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def word_bytes() -> np.ndarray:
    """All bytes but the separators."""
    t = np.ones(256, bool)
    t[list(_SEPARATORS)] = False
    return t


def letter_bytes() -> np.ndarray:
    """Letters and digits, and all bytes of characters beyond ASCII: words without their punctuation."""
    t = np.zeros(256, bool)
    t[ord("0") : ord("9") + 1] = t[ord("A") : ord("Z") + 1] = t[ord("a") : ord("z") + 1] = t[128:] = True
    return t


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, n + 1 offsets); NULL counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    if col.null_count:
        col = pc.fill_null(col, "")
    big = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    kind = np.int64 if big else np.int32
    _, off, data = col.buffers()
    if off is None or not len(col):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    o = np.frombuffer(off, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None else np.zeros(0, np.uint8)
    return d, o - o[0]


def slices(n_bytes: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes, of at least one row each; n_bytes: text offsets."""
    a, n = 0, len(n_bytes) - 1
    while a < n:
        b = int(np.searchsorted(n_bytes, n_bytes[a] + most, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


class Words:
    """The words of some documents: ranges of bytes, and the range of words of each document.

    inside: for each byte (or other unit of ``data``) whether it belongs to a word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None):
        self.data, self.offsets = data, offsets
        n = len(data)
        inside = word_bytes()[data] if inside is None else inside
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        first, last = inside.copy(), inside.copy()
        if n:
            first[1:] &= ~inside[:-1] | cut[1:n]
            last[:-1] &= ~inside[1:] | cut[1:n]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.of_doc = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.of_doc)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, roller: Roller, values: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
        data = self.data if fold is None else fold[self.data]
        s = roller.prefix(values[data])
        return mix(roller.ranges(s, self.start, self.end), 1)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def gram_starts(self, reach: int) -> np.ndarray:
        """Indices of the words that have ``reach`` more words after them in their document."""
        return self.window_starts(reach + 1)

    def window_starts(self, width: int) -> np.ndarray:
        """Indices of the words at which a window of that width starts within its document."""
        ok = np.zeros(len(self.start) + 1, np.int32)
        n = np.maximum(self.counts - width + 1, 0)
        a = self.of_doc[:-1][n > 0]
        np.add.at(ok, a, 1)
        np.add.at(ok, a + n[n > 0], -1)
        return np.flatnonzero(np.cumsum(ok[:-1]))

    def joined(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and offsets of each document's kept words, joined by one space."""
        n = len(self.data)
        kept = np.flatnonzero(keep)
        edge = np.zeros(n + 1, np.int8)
        edge[self.start[kept]] += 1
        edge[self.end[kept]] -= 1
        mask = np.cumsum(edge[:n], dtype=np.int8) > 0
        doc = self.doc_of()[kept]
        gap = self.end[kept[:-1]][doc[:-1] == doc[1:]]  # the byte after a word is a separator if its document goes on
        out = self.data.copy()
        out[gap] = 0x20
        mask[gap] = True
        size = np.zeros(n + 1, np.int64)
        np.cumsum(mask, out=size[1:])
        return out[mask], size[self.offsets]


def string_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.string())
