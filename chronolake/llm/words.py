"""Byte-level word and shingle hashing over whole Arrow text columns, without per-document Python work."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WIDTH = 5
U = np.uint64
#: An odd base and its inverse modulo 2**64, and odd multipliers for the places of a shingle.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
PLACES = [pow(0xD1342543DE82EF95, j + 1, 1 << 64) for j in range(WIDTH)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    x = x ^ (x >> U(31))
    x = x * U(0x7FB5D329728EA185)
    x = x ^ (x >> U(27))
    x = x * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U(base))
    if n:
        out[0] = U(1)
    return np.cumprod(out, dtype=U)


class WordHasher:
    """Hashes the words of many texts at once. Words are runs of bytes other than ASCII white space; A-Z count as a-z."""

    def __init__(self) -> None:
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.solid = np.ones(256, dtype=bool)
        self.solid[[32, 9, 10, 11, 12, 13]] = False
        self.up = self.down = np.zeros(0, dtype=U)

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of its text, hash) of each word, in order."""
        n = len(data)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, U)
        if len(self.up) < n + 1:
            self.up, self.down = _powers(BASE, n + 1), _powers(INVERSE, n + 1)
        solid = self.solid[data]
        before, after = np.empty(n, bool), np.empty(n, bool)
        before[0], before[1:] = False, solid[:-1]
        after[-1], after[:-1] = False, solid[1:]
        edge = offsets[(offsets > 0) & (offsets < n)]
        before[edge] = False
        after[edge - 1] = False
        start = np.flatnonzero(solid & ~before)
        end = np.flatnonzero(solid & ~after) + 1
        total = np.zeros(n + 1, U)
        np.cumsum((self.lower[data].astype(U) + U(1)) * self.up[:n], out=total[1:])
        h = (total[end] - total[start]) * self.down[start]
        h = mix(h + (end - start).astype(U) * U(0xA24BAED4963EE407))
        return np.searchsorted(offsets, start, "right") - 1, h

    def shingles(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of its text, hash) of each distinct shingle, sorted by both. Shorter texts give their whole sequence."""
        doc, h = self.words(data, offsets)
        n = len(offsets) - 1
        docs, hashes = [], []
        if len(h) >= WIDTH:
            m = len(h) - WIDTH + 1
            s = np.zeros(m, U)
            for j in range(WIDTH):
                s += h[j : j + m] * U(PLACES[j])
            whole = doc[:m] == doc[WIDTH - 1 :]
            docs.append(doc[:m][whole])
            hashes.append(mix(s[whole]))
        count = np.bincount(doc, minlength=n)
        first = np.cumsum(count) - count
        for k in range(1, WIDTH):
            short = np.flatnonzero(count == k)
            if len(short):
                s = np.full(len(short), U(k))
                for j in range(k):
                    s += h[first[short] + j] * U(PLACES[j])
                docs.append(short)
                hashes.append(mix(s))
        if not docs:
            return np.zeros(0, np.int64), np.zeros(0, U)
        d, s = np.concatenate(docs), np.concatenate(hashes)
        order = np.lexsort((s, d))
        d, s = d[order], s[order]
        new = np.ones(len(d), bool)
        new[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1])
        return d[new], s[new]


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def chunks(column: pa.Array, size: int = 1 << 20):
    """(first row, end row, bytes, offsets) of runs of rows of about size bytes; a longer text stays whole."""
    data, offsets = text_buffers(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        end = min(end, n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end
