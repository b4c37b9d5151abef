"""Vectorised text primitives over Arrow string columns.

A batch of texts is one byte buffer plus offsets. Everything here works on
that buffer with numpy: no per-character Python. Callers walk a batch in
chunks of half a MB (whole documents), so a task's memory follows the chunk and
its longest document, never the batch or partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
_U64 = np.uint64
_RADIX = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser, elementwise on uint64."""
    x = x.astype(_U64, copy=True)
    x ^= x >> _U64(30)
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


_BYTE_CODE = mix(np.arange(1, 257, dtype=_U64) * _U64(0xD1342543DE82EF95))
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# words of lower-cased letters, digits and every non-ASCII byte
IS_ALNUM = np.zeros(256, dtype=bool)
IS_ALNUM[0x30:0x3A] = IS_ALNUM[0x61:0x7B] = IS_ALNUM[0x80:] = True

_powers = {"n": 0}


def radix_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the radix and of its inverse, kept for the largest n asked."""
    if _powers["n"] < n:
        size = max(n, CHUNK_BYTES + 1)
        inverse = pow(_RADIX, -1, 1 << 64)
        for name, base in (("up", _RADIX), ("down", inverse)):
            step = np.full(size, base, dtype=_U64)
            step[0] = 1
            _powers[name] = np.cumprod(step, dtype=_U64)
        _powers["n"] = size
    return _powers["up"], _powers["down"]


class RangeHash:
    """64-bit hash of any byte range of a buffer in O(1), vectorised."""

    def __init__(self, buf: np.ndarray):
        up, self.down = radix_powers(len(buf) + 1)
        self.prefix = np.zeros(len(buf) + 1, dtype=_U64)
        np.cumsum(_BYTE_CODE[buf] * up[: len(buf)], out=self.prefix[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.prefix[end] - self.prefix[start]) * self.down[start]
        h += (end - start).astype(_U64) * _U64(0xA24BAED4963EE407)
        return mix(h)

    def fixed(self, k: int) -> np.ndarray:
        """Hashes of all k-byte ranges, by start."""
        n = len(self.prefix) - k
        if n <= 0:
            return np.zeros(0, dtype=_U64)
        return mix((self.prefix[k:] - self.prefix[:n]) * self.down[:n])


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield ``(first_row, buffer, offsets)`` for runs of whole texts of about
    ``limit`` bytes; a null is the empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(n, max(at + 1, end))
        yield at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def words(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, doc)`` of the maximal runs of bytes with ``is_word``;
    a run never crosses documents."""
    if not len(buf):
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    w = is_word[buf]
    before = np.empty_like(w)
    before[0] = False
    before[1:] = w[:-1]
    before[offsets[:-1][offsets[:-1] < len(buf)]] = False
    after = np.empty_like(w)
    after[-1] = False
    after[:-1] = w[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    start = np.flatnonzero(w & ~before)
    end = np.flatnonzero(w & ~after) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def per_doc(doc: np.ndarray, n_docs: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Count (or integer sum) per document."""
    out = np.bincount(doc, weights=weights, minlength=n_docs)
    return out if weights is None else np.rint(out).astype(np.int64)


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys in a sorted array."""
    if not len(sorted_keys):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))


def pack(*arrays: np.ndarray) -> bytes:
    """Equal-long arrays as one blob, byte plane by byte plane, so that the
    shuffle's compression removes what is constant or sorted."""
    return b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays)


def unpack(blob: bytes, *dtypes) -> list[np.ndarray]:
    widths = [np.dtype(t).itemsize for t in dtypes]
    n, raw, at, out = len(blob) // sum(widths), np.frombuffer(blob, dtype=np.uint8), 0, []
    for t, width in zip(dtypes, widths):
        planes = raw[at : at + n * width].reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(t).reshape(n))
        at += n * width
    return out


def by_bucket(key: np.ndarray, buckets: int, *arrays: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Blobs of the arrays by ``key % buckets``."""
    bucket = (key % _U64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    arrays = tuple(a[order] for a in arrays)
    starts = runs(bucket)
    for s, e in zip(starts, np.append(starts[1:], len(bucket))):
        yield int(bucket[s]), pack(*(a[s:e] for a in arrays))
