"""Word and shingle hashing over whole Arrow batches of texts (numpy).

A word is a maximal run of bytes other than ``0x20`` and ``0x09-0x0D``; A-Z
count as a-z.  Words hash to 64 bits by a polynomial over per-byte random
values, computed for every word of a block of texts with one running sum.
Texts are taken whole; blocks only bound the memory of a step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: spreads every input bit over the output."""
    x = np.asarray(x, dtype=U64).copy()
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _stream(seed: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: The same, and every other ASCII byte that is no letter or digit.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_BYTE = _stream(11, 256)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
SLOT = _stream(23, 64) | U64(1)
HEAD = U64(0xA0761D6478BD642F)
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POW or len(_POW["up"]) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(max(n, BLOCK_BYTES + 1), base, U64)
            steps[0] = 1
            _POW[name] = np.cumprod(steps, dtype=U64)
    return _POW["up"][:n], _POW["down"][:n]


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, last, bytes, offsets)`` of consecutive rows, at most ``limit``
    bytes together or one longer text.  A null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _IS_SPACE,
          heads: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """Start byte, end byte, text number and hash of every word of a block;
    ``breaks`` flags the bytes between words.  For each length in ``heads`` a
    further array has the hash of the word's first bytes (0: shorter word)."""
    n = len(data)
    if n == 0:
        e = np.zeros(0, np.int64)
        return e, e, e, *[np.zeros(0, U64)] * (1 + len(heads))
    inside = ~breaks[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | cut[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | cut[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    with np.errstate(over="ignore"):
        up, down = _powers(n)
        run = np.zeros(n + 1, U64)
        np.cumsum(_BYTE[data] * up, out=run[1:])
        h = mix((run[e] - run[s]) * down[s] + (e - s).astype(U64))
        first = [np.where(e - s > m, mix((run[np.minimum(s + m, n)] - run[s]) * down[s] + HEAD), U64(0)) for m in heads]
    return s, e, np.searchsorted(offsets, s, "right") - 1, h, *first


def combine(h: np.ndarray, k: int) -> np.ndarray:
    """Ordered hash of every ``k`` consecutive words (bounds not checked)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        acc = np.full(n, U64(k), U64)
        for j in range(k):
            acc += h[j : n + j] * SLOT[j]
    return mix(acc)


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct k-word shingle hashes)``; a text with fewer than
    ``k`` words has its whole sequence as one shingle, one without words none."""
    for first, last, data, offsets in text_blocks(column):
        _, _, doc, h = words(data, offsets)
        sh = combine(h, k)
        at = np.searchsorted(doc, np.arange(last - first + 1))
        for i in range(last - first):
            a, b = int(at[i]), int(at[i + 1])
            if b - a >= k:
                yield first + i, np.unique(sh[a : b - k + 1])
            elif b > a:
                yield first + i, combine(h[a:b], b - a)
            else:
                yield first + i, np.zeros(0, U64)


def list_column(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """Arrow list column of numpy rows."""
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat).cast(kind))
