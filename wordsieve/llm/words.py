"""Hashes of words and word shingles of whole texts, by numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

from wordsieve.llm.common import SPACES, blocks
from wordsieve.llm.ngrams import PLAIN

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[ord(c) for c in SPACES]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

PRIME = np.uint64(0x9E3779B97F4A7C15)
POWERS = np.cumprod(np.full(256, PRIME, np.uint64), dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits, one to one."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(n: int) -> np.ndarray:
    global POWERS
    if n > len(POWERS):
        POWERS = np.cumprod(np.full(2 * n, PRIME, np.uint64), dtype=np.uint64)
    return POWERS


def word_bounds(data: np.ndarray, spaces: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end places of the words in an array of bytes."""
    inside = np.concatenate([[False], ~spaces[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def hashes_of(data: np.ndarray, first: np.ndarray, last: np.ndarray, spaces: np.ndarray = IS_SPACE) -> np.ndarray:
    """A 64-bit hash of the bytes of each word."""
    if not len(first):
        return np.zeros(0, np.uint64)
    sizes = last - first
    place = np.arange(len(data)) - np.repeat(np.concatenate([[0], first[1:]]), np.diff(np.concatenate([[0], first[1:], [len(data)]])))
    # Bytes that follow a word up to the next one count nothing.
    value = data.astype(np.uint64) + np.uint64(1)
    value[spaces[data]] = 0
    value *= powers(int(place.max()) + 1)[place]
    return mix(np.add.reduceat(value, first) + sizes.astype(np.uint64))


def word_hashes(texts: Sequence[str | None], plain: bool = False) -> Iterator[tuple[int, np.ndarray]]:
    """The row and the hashes of its words in order, for each text with a word.

    Words are what white space parts, with A-Z as a-z. ``plain`` words are lower-case in every script, and all
    ASCII marks part them.
    """
    spaces = PLAIN if plain else IS_SPACE
    row, held = -1, []
    for rows, parts in blocks(texts, spaces=SPACES):
        encoded = [(p.lower() if plain else p).encode() for p in parts]
        data = LOWER[np.frombuffer(b"\n".join(encoded), np.uint8)]
        first, last = word_bounds(data, spaces)
        found = hashes_of(data, first, last, spaces)
        cuts = np.searchsorted(first, np.cumsum([len(e) + 1 for e in encoded]))
        begin = 0
        for r, cut in zip(rows, cuts):
            if r != row:
                if held:
                    yield row, np.concatenate(held)
                row, held = r, []
            if cut > begin:
                held.append(found[begin:cut])
            begin = cut
    if held:
        yield row, np.concatenate(held)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words in order; of the whole sequence when there are fewer."""
    n = len(words) - size + 1
    if n < 1:
        size, n = len(words), 1
    total = np.full(n, np.uint64(size))
    for k in range(size):
        total = total * PRIME + words[k : k + n]
    return mix(total)
