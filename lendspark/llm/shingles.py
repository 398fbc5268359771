"""Sets of word shingles as 64-bit hashes, and their minwise hashes.

All words of a batch of texts are hashed together: a running sum of bytes times powers
of an odd number gives the hash of any stretch as a difference.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
MIX = 0xBF58476D1CE4E5B9
CHUNK_BYTES = 128 << 10
CHUNK_VALUES = 256
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE ** i`` and its inverse, modulo 2 ** 64."""
    up, down = np.full(size, BASE, U64), np.full(size, pow(BASE, -1, 1 << 64), U64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``size`` powers and inverses."""
    return _powers(1 << max(18, int(size - 1).bit_length()))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(31))) * U64(MIX)
    return x ^ (x >> U64(29))


def running_sum(buffer: np.ndarray) -> np.ndarray:
    """Sums of bytes times powers before each place, one longer than ``buffer``."""
    up, _ = powers(len(buffer) + 1)
    sums = np.zeros(len(buffer) + 1, U64)
    np.cumsum((buffer.astype(U64) + U64(1)) * up[: len(buffer)], out=sums[1:])
    return sums


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each start to its end, wherever in the buffer they lie."""
    _, down = powers(len(sums))
    return mixed((sums[ends] - sums[starts]) * down[starts])


def _word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    buffer = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    blank = BLANK[buffer]
    edge = np.flatnonzero(np.diff(blank.view(np.int8), prepend=1))
    starts, ends = edge[::2], edge[1::2]
    hashes = stretch_hashes(running_sum(buffer), starts, ends)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    cuts = np.searchsorted(starts, np.cumsum(lengths)[:-1])
    return np.split(hashes, cuts)


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """Hashes of the words of each text, A-Z in lower case."""
    found: list[np.ndarray] = []
    part: list[bytes] = []
    size = 0
    for text in texts:
        part.append((text or "").encode().lower())
        size += len(part[-1])
        if size >= CHUNK_BYTES:
            found += _word_hashes(part)
            part, size = [], 0
    return found + (_word_hashes(part) if part else [])


def shingle_set(words: np.ndarray, size: int = 2) -> np.ndarray:
    """Sorted distinct shingles; a shorter text is one, an empty one has none."""
    if len(words) == 0:
        return words
    width = min(size, len(words))
    shingles = np.full(len(words) - width + 1, width, U64)
    for k in range(width):
        shingles = mixed(shingles * U64(BASE) + words[k : k + len(shingles)])
    shingles.sort()
    return shingles[np.concatenate([[True], shingles[1:] != shingles[:-1]])]


def shingle_sets(texts: list[str | None], size: int = 2) -> list[np.ndarray]:
    return [shingle_set(words, size) for words in word_hashes(texts)]


@lru_cache(maxsize=1)
def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.RandomState(20)
    odd = draw.randint(0, 1 << 31, count).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    return odd, draw.randint(0, 1 << 32, count, dtype=np.uint32)


def minwise(shingles: np.ndarray, count: int) -> np.ndarray:
    """The least value of a set, not empty, under each of ``count`` hash functions."""
    odd, shift = _multipliers(count)
    x = (shingles >> U64(32)).astype(np.uint32)[:, None]
    least = np.full(count, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), CHUNK_VALUES):  # a chunk stays in the cache
        hashes = x[at : at + CHUNK_VALUES] ^ shift
        hashes *= odd
        np.minimum(least, hashes.min(axis=0), out=least)
    return least
