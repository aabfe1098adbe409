"""Words of UTF-8 buffers and their 64-bit hashes, by numpy."""

from __future__ import annotations

import functools

import numpy as np

SLICE = 1 << 20  # bytes hashed at once

#: Lower-cases the bytes of A-Z.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

_LETTERS = np.random.default_rng(13).integers(1, 1 << 64, 256, dtype=np.uint64)


def byte_class(ranges: list[tuple[int, int]]) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for a, b in ranges:
        out[a:b] = True
    return out


@functools.lru_cache(maxsize=8)
def _powers(bits: int) -> np.ndarray:
    out = np.full(1 << bits, 0x9E3779B97F4A7C15, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def hashed_words(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the maximal runs of bytes of the class ``is_word``."""
    parts, at = [], 0
    while at < len(data):
        end = min(at + SLICE, len(data))
        while end < len(data) and is_word[data[end]] and is_word[data[end - 1]]:
            end += 1  # a slice ends where no word goes on
        part = data[at:end]
        inside = np.concatenate(([False], is_word[part], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        if len(starts):
            sizes = ends - starts
            chars = np.flatnonzero(inside[1:-1])
            first = np.cumsum(sizes) - sizes
            place = np.arange(len(chars)) - np.repeat(first, sizes)
            sums = np.add.reduceat(_LETTERS[part[chars]] * _powers(max(10, int(sizes.max()).bit_length()))[place], first)
            parts.append((starts + at, ends + at, mixed(sums)))
        at = end
    if not parts:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
