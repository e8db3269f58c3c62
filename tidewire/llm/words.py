"""Words as hashes of their bytes."""

from __future__ import annotations

import re

import numpy as np

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x2545F4914F6CDD1D, 0x9FB21C651E98DF25, 0x94D049BB133111EB], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes of text hashed at once; longer texts are cut where words end.
_BLOCK = 1 << 16
_WHITE = re.compile(rb"[ \t-\r]")
_of_byte = np.random.default_rng(5).integers(0, 1 << 64, 256, dtype=np.uint64)
_of_byte[[9, 10, 11, 12, 13, 32]] = 0
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n, base, np.uint64))))


_UP, _DOWN = _powers(_BASE, 2 * _BLOCK), _powers(pow(_BASE, -1, 1 << 64), 2 * _BLOCK)


def _hash_block(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values = _of_byte[np.frombuffer(text, np.uint8)]
    black = np.concatenate(([False], values != 0, [False]))
    edges = np.flatnonzero(black[1:] != black[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    up, down = (_UP, _DOWN) if len(text) <= len(_UP) else (_powers(_BASE, len(text)), _powers(pow(_BASE, -1, 1 << 64), len(text)))
    # A polynomial in the bytes of each word, whatever the word's place in the text.
    return mixed(np.add.reduceat(values * up[: len(values)], starts) * down[starts]), starts, ends


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, byte after the last) of the words of a text; see word_hashes."""
    parts, at = [], 0
    while at < len(text):
        cut = _WHITE.search(text, at + _BLOCK)
        end = cut.start() if cut else len(text)
        hashes, starts, ends = _hash_block(text[at:end])
        parts.append((hashes, starts + at, ends + at))
        at = end
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if len(parts) > 1 else parts[0]


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words (runs of bytes other than 9 to 13 and 32) of a text, in order, from its bytes at once."""
    return word_places(text)[0]


def distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct values."""
    x = np.sort(x)
    return x[np.concatenate((x[:1] == x[:1], x[1:] != x[:-1]))]


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive words."""
    size = max(0, len(hashes) - n + 1)
    total = np.zeros(size, np.uint64)
    for k in range(n):
        total += hashes[k : k + size] * _MULTIPLIERS[k]
    return mixed(total)


def is_in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in a sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values
