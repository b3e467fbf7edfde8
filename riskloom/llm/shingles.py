"""Hashes of words and word shingles, computed over whole Arrow batches of text at once.

A word is a polynomial over its bytes modulo 2^64: prefix sums of byte values times powers
of an odd base give every word of a batch by one subtraction, and the base's inverse takes the
word's place out of it. Bytes stand for random 64-bit values, A-Z for those of a-z. Nothing is kept
between batches.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
#: Bytes that are hashed in one go.
PIECE = 1 << 18
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BASE = 0x5851F42D4C957F2D
_MOD = 1 << 64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _A
    return h ^ (h >> np.uint64(29))


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of bytes, powers of the base and of its inverse."""
    value = np.frombuffer(b"".join(hashlib.blake2b(bytes([b]), digest_size=8).digest() for b in range(256)), "<u8").copy()
    value[65:91] = value[97:123]

    def powers(base: int) -> np.ndarray:
        out = np.ones(PIECE, np.uint64)
        n = 1
        while n < PIECE:
            out[n : 2 * n] = out[:n] * np.uint64(pow(base, n, _MOD))
            n *= 2
        return out

    return value, powers(_BASE), powers(pow(_BASE, -1, _MOD))


def _giant(data: np.ndarray) -> int:
    """The polynomial of a word that is longer than a piece."""
    value, power, _ = _tables()
    total, scale, step = 0, 1, pow(_BASE, PIECE, _MOD)
    for at in range(0, len(data), PIECE):
        x = value[data[at : at + PIECE]]
        total = (total + scale * int((x * power[: len(x)]).sum())) % _MOD
        scale = scale * step % _MOD
    return total


def _pieces(offsets: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of PIECE bytes at most that no word crosses; a word that is longer is a stretch of its own."""
    at, stop = int(offsets[0]), int(offsets[-1])
    while at < stop:
        end = min(at + PIECE, stop)
        if end < stop:
            k = int(np.searchsorted(offsets, end, side="right")) - 1
            if offsets[k] > at:
                end = int(offsets[k])
            else:  # inside one text: behind its last white space so far
                white = np.flatnonzero(_SPACE[data[at:end]])
                if len(white):
                    end = at + int(white[-1]) + 1
                else:
                    limit = int(offsets[k + 1])
                    while end < limit and not _SPACE[data[end]]:
                        ahead = np.flatnonzero(_SPACE[data[end : min(end + PIECE, limit)]])
                        end = end + int(ahead[0]) if len(ahead) else min(end + PIECE, limit)
        yield at, end
        at = end


def text_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, cuts): the words of text i are hashes[cuts[i]:cuts[i + 1]]; a null text has none.

    Words are cut at ASCII white space and A-Z are folded.
    """
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    _, where, held = column.buffers()
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    value, power, inverse = _tables()
    hashes, begins = [], []
    for lo, hi in _pieces(offsets, data):
        part = data[lo:hi]
        edge = offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi)] - lo  # texts that start here
        solid = ~_SPACE[part]
        turn = np.empty(len(part) + 1, bool)
        turn[1:-1] = solid[1:] != solid[:-1]
        turn[0], turn[-1] = solid[0], solid[-1]
        starts = turn[:-1] & solid
        starts[edge] = solid[edge]
        ends = turn[1:] & solid
        inner = edge[edge > 0]
        ends[inner - 1] = solid[inner - 1]
        a, z = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        if len(part) > PIECE:
            hashes += [np.array([_giant(part[i:j])], np.uint64) for i, j in zip(a, z)]
        else:
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(value[part] * power[: len(part)], out=total[1:])
            hashes.append((total[z] - total[a]) * inverse[a])
        begins.append(a + lo)
    if not begins:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return mix(np.concatenate(hashes)), np.searchsorted(np.concatenate(begins), offsets)


def ngrams(w: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams, by their first word."""
    m = max(0, len(w) - n + 1)
    h = np.full(m, np.uint64(n))
    for k in range(n):
        h = mix((h * _B) ^ w[k : k + m])
    return h


def distinct(h: np.ndarray) -> np.ndarray:
    """The sorted distinct values."""
    h = np.sort(h)
    if len(h) < 2:
        return h
    return h[np.append(True, h[1:] != h[:-1])]


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """For each text its sorted distinct 5-word shingles; fewer words are one shingle, no word gives none."""
    w, cuts = text_words(column)
    all_of = ngrams(w, WORDS)
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield distinct(all_of[lo : hi - WORDS + 1]) if hi - lo >= WORDS else ngrams(w[lo:hi], hi - lo)[:1] if hi > lo else w[:0]


def shingle_set(text: str | None) -> np.ndarray:
    return next(shingle_sets(pa.array([text], pa.string())))


def pack(rows: np.ndarray) -> bytes:
    """Rows byte plane by byte plane, so that what the planes repeat compresses."""
    return rows.view(np.uint8).reshape(len(rows), rows.itemsize).T.tobytes()


def unpack(blobs: list[bytes], kind: np.dtype) -> np.ndarray:
    return np.concatenate([np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel() for x in blobs])


def set_key(s: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
