"""Words, their hashes and shingles of whole Arrow columns at once.

A word is a run of bytes other than space and 0x09 to 0x0D; A-Z count as lower case. These bytes never occur inside a
multi-byte UTF-8 character, so working on bytes and on characters is the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows that operators hash at once, of the batches that Spark hands them.
ROWS = 500
#: Bytes hashed at once; longer columns and texts are cut between words.
CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes between words, as flags; the second also splits at ASCII signs and control characters.
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
SIGNS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _weights(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    size = max(CHUNK, 1 << (n - 1).bit_length()) if n else CHUNK
    if size not in _powers:
        if len(_powers) > 1:
            _powers.popitem()  # that of one unusually long word
        up = np.full(size, _BASE, dtype=np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        _powers[size] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _powers[size]


def word_hashes(texts: pa.Array, between: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, number of words of each text). Null texts have no words.

    ``between`` flags the bytes that separate words.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    counts = np.zeros(len(texts), dtype=np.int64)
    if len(texts) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint64), counts
    data = np.frombuffer(texts.buffers()[2], np.uint8)
    found, at, end = [], int(offsets[0]), int(offsets[-1])
    while at < end:
        stop = min(at + CHUNK, end)
        if stop < end:
            spaces = np.flatnonzero(between[data[at:stop]])
            if len(spaces):
                stop = at + int(spaces[-1]) + 1
            else:
                while stop < end and not between[data[stop]]:
                    stop += 1
        piece = _LOWER[data[at:stop]]
        word = ~between[piece]
        edge = np.zeros(len(piece) + 1, dtype=bool)  # a text begins here
        edge[offsets[(offsets >= at) & (offsets <= stop)] - at] = True
        edge[0] = edge[-1] = True
        starts = np.flatnonzero(word & (edge[:-1] | ~np.concatenate(([False], word[:-1]))))
        ends = np.flatnonzero(word & (edge[1:] | ~np.concatenate((word[1:], [False])))) + 1
        up, down = _weights(len(piece))
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(_VALUE[piece] * up[: len(piece)], out=sums[1:])
        found.append(mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)))
        counts += np.bincount(np.searchsorted(offsets, starts + at, "right") - 1, minlength=len(texts))
        at = stop
    return np.concatenate(found), counts


def shingles(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every k-word shingle in order, number for each text). Fewer than k words: the whole sequence is one."""
    first = np.concatenate(([0], np.cumsum(counts)))
    number = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    out = np.zeros(int(number.sum()), dtype=np.uint64)
    to = np.concatenate(([0], np.cumsum(number)))
    multiplier = np.uint64(0xD6E8FEB86659FD93)
    if len(hashes) >= k:
        rolled = np.zeros(len(hashes) - k + 1, dtype=np.uint64)
        for j in range(k):
            rolled = rolled * multiplier + hashes[j : j + len(rolled)]
        long = np.flatnonzero(counts >= k)
        of = np.repeat(np.arange(len(long)), number[long])
        step = np.arange(len(of)) - np.repeat(np.cumsum(number[long]) - number[long], number[long])
        out[to[long][of] + step] = mix(rolled[first[long][of] + step] + np.uint64(k))
    for n in range(1, k):
        short = np.flatnonzero(counts == n)
        folded = np.zeros(len(short), dtype=np.uint64)
        for j in range(n):
            folded = folded * multiplier + hashes[first[short] + j]
        out[to[short]] = mix(folded + np.uint64(n))
    return out, number
