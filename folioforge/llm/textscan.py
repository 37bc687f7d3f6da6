"""Vectorised scanning of Arrow string arrays: words, word hashes and batches
of bounded size.  Every function works on the UTF-8 buffers with numpy, so no
Python object is made for a word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are scanned in slices of about this many bytes (one longer text is a
#: slice by itself), which bounds a worker's memory whatever the batch holds.
SLICE_BYTES = 1 << 20

_WORD = np.zeros(256, bool)
for _c in b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ_":
    _WORD[_c] = True
_WORD[128:] = True

_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {"p": np.ones(1, np.uint64), "i": np.ones(1, np.uint64)}


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """The splitmix64 finaliser of ``x + seed``, over uint64."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((seed * 0xD1B54A32D192ED03 + 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["p"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for k, base in (("p", _P), ("i", _P_INV)):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            with np.errstate(over="ignore"):
                _powers[k] = np.multiply.accumulate(t)
    return _powers["p"][:n], _powers["i"][:n]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (int64, starting at 0) and the bytes of a string array without
    nulls, as views of its buffers."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    raw = texts.buffers()
    off = np.frombuffer(raw[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(raw[2], np.uint8)[off[0] : off[-1]] if raw[2] is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return off - off[0], data


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, sub-array) pieces of about ``most`` bytes; nulls become ''."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = pc.fill_null(texts, "")
    if len(texts) == 0:
        return
    off, _ = buffers(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        yield at, texts.slice(at, to - at)
        at = to


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, 64-bit hash, byte length) of every word, in order.

    A word is a longest run of ASCII letters, digits, ``_`` or bytes above 127,
    after lower-casing.  Rows without a word simply have none.
    """
    off, data = buffers(pc.utf8_lower(texts))
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none
    inside = np.empty(len(data) + 1, bool)
    inside[0] = False
    np.take(_WORD, data, out=inside[1:])
    first = inside[1:] & ~inside[:-1]
    begins = off[:-1][off[:-1] < off[1:]]
    first[begins] = inside[1:][begins]
    start = np.flatnonzero(first)
    last = inside[1:].copy()
    last[:-1] &= ~inside[2:] | first[1:]
    end = np.flatnonzero(last) + 1
    p, inv = _tables(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.empty(len(data) + 1, np.uint64)
        total[0] = 0
        np.add(data, np.uint64(1), out=total[1:], casting="unsafe")
        total[1:] *= p[:-1]
        np.cumsum(total[1:], out=total[1:])
        h = (total[end] - total[start]) * inv[start]
    return np.searchsorted(off, start, "right") - 1, mix(h), end - start


def distinct(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (row, hash) pairs, ordered by row and then hash."""
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]
