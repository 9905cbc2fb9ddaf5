"""Hashes of words, in numpy over the bytes of many texts at once; nothing is remembered between texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of texts that are worked on at once: a few arrays of 1 MB.
BLOCK = 1 << 17

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = _VALUES.copy()
_LOWER[65:91] = _VALUES[97:123]

_STEP, _BACK = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_STEP, BLOCK + 1), _powers(_BACK, BLOCK + 1)


def sums(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed polynomial hashes of values[begin:end] modulo 2**64."""
    n = len(values) + 1
    up, down = (_UP[:n], _DOWN[:n]) if n <= len(_UP) else (_powers(_STEP, n), _powers(_BACK, n))
    total = np.zeros(n, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    h = (total[ends] - total[begins]) * down[begins]
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(factor)
    return h ^ (h >> np.uint64(29))


def _of_block(data: np.ndarray, bounds: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, where it begins, words before each bound) of texts that lie side by side in `data`."""
    inside = ~SPACE[data]
    begin, last = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = bounds[(bounds > 0) & (bounds < len(data))]  # a text's first and last byte
    begin[edge], last[edge - 1] = inside[edge], inside[edge - 1]
    begins, ends = np.flatnonzero(begin), np.flatnonzero(last) + 1
    return sums((_LOWER if lower else _VALUES)[data], begins, ends), begins, np.searchsorted(begins, bounds)


def words(data: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, where it begins) of one text's bytes; lower: A-Z count as a-z."""
    hashes, begins, at = [], [], 0
    while len(data) - at > BLOCK:
        spaces = np.flatnonzero(SPACE[data[at : at + BLOCK]])
        end = at + (int(spaces[-1]) + 1 if len(spaces) else BLOCK)
        while not len(spaces) and end < len(data):  # a word longer than a block
            spaces = np.flatnonzero(SPACE[data[end : end + BLOCK]])
            end += int(spaces[0]) + 1 if len(spaces) else len(data[end : end + BLOCK])
        h, b, _ = _of_block(data[at:end], np.array([0, end - at]), lower)
        hashes.append(h)
        begins.append(b + at)
        at = end
    h, b, _ = _of_block(data[at:], np.array([0, len(data) - at]), lower)
    return np.concatenate([*hashes, h]), np.concatenate([*begins, b + at])


def of_texts(texts: pa.Array, lower: bool = False) -> Iterator[np.ndarray]:
    """The hashes of the words of each text in order; null is as empty."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK, "right")) - 1)
        part = data[offsets[i] : offsets[j]]
        if len(part) > BLOCK:
            yield words(part, lower)[0]
        else:
            hashes, _, first = _of_block(part, offsets[i : j + 1] - offsets[i], lower)
            yield from (hashes[a:b] for a, b in zip(first[:-1], first[1:]))
        i = j
