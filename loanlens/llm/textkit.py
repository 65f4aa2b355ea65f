"""Vectorised text helpers used inside Arrow-batched tasks (numpy only).

Everything here works on one bounded chunk of documents: a contiguous UTF-8
buffer plus document offsets. Words and windows are identified by 64-bit
hashes: a polynomial hash over random per-byte values modulo 2**64, finished
with a bit mixer. Two different strings share an identifier with probability
about 2**-64 per pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = (1 << 20) - 64

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 2 ** 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_pw = np.ones(1, np.uint64)
_ipw = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    global _pw, _ipw
    if len(_pw) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("_pw", _BASE), ("_ipw", _BASE_INV)):
            out = np.empty(size, np.uint64)
            out[0] = 1
            have = 1
            step = base
            while have < size:
                m = min(have, size - have)
                out[have:have + m] = out[:m] * np.array([step], np.uint64)
                have += m
                step = step * step % (1 << 64)
            globals()[name] = out
    return _pw, _ipw


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and multiply rounds)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial hash; ``span_hash`` turns them into substring hashes."""
    pw, _ = _powers(len(data) + 1)
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(_BYTE[data] * pw[:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start, end) -> np.ndarray:
    """64-bit identifier of data[start:end] for arrays of starts and ends."""
    _, ipw = _powers(len(prefix))
    return mix64((prefix[end] - prefix[start]) * ipw[start])


def chunks(column: pa.Array, limit: int = CHUNK_BYTES):
    """Yield (first_row, data uint8[], offsets int64[]) for runs of rows of at most ``limit`` bytes.

    A single longer row is a chunk of its own. NULL texts are empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, buf = column.buffers()
    offs = np.frombuffer(off, np.int64 if wide else np.int32)[
        column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    i, n = 0, len(column)
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


#: Byte tables: 1 marks a separator. SPACE: \x20 \x09-\x0D. ALNUM: all but 0-9, A-Z, a-z, >= \x80.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
ALNUM = np.ones(256, bool)
for _lo, _hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    ALNUM[_lo:_hi] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def words(data: np.ndarray, offs: np.ndarray, sep: np.ndarray = SPACE):
    """Word starts, word ends and the number of words of each document of a chunk."""
    n = len(data)
    if not n:
        e = np.zeros(0, np.int64)
        return e, e, np.zeros(len(offs) - 1, np.int64)
    inside = ~sep[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    per_doc = np.searchsorted(starts, offs[1:]) - np.searchsorted(starts, offs[:-1])
    return starts, ends, per_doc


def word_hashes(data: np.ndarray, offs: np.ndarray, sep: np.ndarray = SPACE):
    """Hash of every lower-cased (A-Z) word of a chunk, and the words per document."""
    starts, ends, per_doc = words(data, offs, sep)
    return span_hash(prefix_hash(LOWER[data]), starts, ends), per_doc


def shingle_sets(hashes: np.ndarray, per_doc: np.ndarray, k: int):
    """Sorted distinct k-word shingle hashes of each document.

    A document of fewer than k words, but not none, has its whole word sequence as its one shingle;
    a document without words has the empty set.
    """
    keys = [_U(pow(0xD6E8FEB86659FD93, 2 * i + 1, 1 << 64)) for i in range(k)]
    n = len(hashes)
    full = np.zeros(max(n - k + 1, 0), np.uint64)
    for i in range(k):
        full += hashes[i:n - k + 1 + i] * keys[i]
    full = mix64(full)
    at = 0
    for m in per_doc:
        m = int(m)
        if m >= k:
            yield np.unique(full[at:at + m - k + 1])
        elif m:
            part = np.zeros(1, np.uint64)
            for i in range(m):
                part += hashes[at + i:at + i + 1] * keys[i]
            yield mix64(part + _U(0xA0761D6478BD642F * (k - m) % (1 << 64)))
        else:
            yield np.zeros(0, np.uint64)
        at += m
