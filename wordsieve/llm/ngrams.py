"""Hashed word and character n-grams of texts, by numpy, for the models of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

from wordsieve.llm.common import blocks

# Bytes that end a word: ASCII white space, or for ``plain`` words every ASCII character but letters and digits.
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
PLAIN = np.zeros(256, bool)
PLAIN[[b for b in range(128) if not chr(b).isalnum()]] = True

MULTIPLIER = np.uint32(0x9E3779B1)
SPREAD = np.uint32(0x85EBCA6B)


def slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Table slots of 32-bit hashes."""
    h = hashes ^ (hashes >> np.uint32(15))
    h = h * SPREAD
    return (h ^ (h >> np.uint32(13))) >> np.uint32(32 - bits)


def windows(data: np.ndarray, sizes: Sequence[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each size the hash of the window of so many bytes from each place on."""
    h = np.zeros(len(data), np.uint32)
    wide = data.astype(np.uint32) + np.uint32(1)
    for n in range(1, max(sizes) + 1):
        h = h[: len(data) - n + 1] * MULTIPLIER + wide[n - 1 :]
        if n in sizes:
            yield n, h + np.uint32(n)


class Block:
    """Words and n-grams of a block of texts as bytes.

    ``row`` gives the text of each piece, ``begin`` the place where it starts. Every piece is followed by a white space,
    so that no word crosses its end.
    """

    def __init__(self, rows: list[int], parts: list[str], ends: np.ndarray, lower: bool):
        encoded = [(" " + (p.lower() if lower else p) + " ").encode() for p in parts]
        self.rows = np.array(rows)
        self.data = np.frombuffer(b"".join(encoded), np.uint8)
        self.begin = np.concatenate([[0], np.cumsum([len(e) for e in encoded])[:-1]])
        space = ends[self.data]
        edges = np.flatnonzero(space[1:] != space[:-1])
        # A word is told by the white space before it and the one behind it.
        self.first, self.last = edges[::2] + 1, edges[1::2] + 1

    def piece_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, place, "right") - 1


def text_blocks(texts: Sequence[str | None], ends: np.ndarray, lower: bool, most_rows: int | None = None) -> Iterator[Block]:
    for rows, parts in blocks(texts, most_rows=most_rows):
        yield Block(rows, parts, ends, lower)


def word_ids(block: Block) -> np.ndarray:
    """A 32-bit hash of each word of a block."""
    if not len(block.first):
        return np.zeros(0, np.uint32)
    size = block.last - block.first
    total = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(total[-1]) - np.repeat(total[:-1], size)
    power = np.cumprod(np.concatenate([[1], np.full(int(size.max()), MULTIPLIER)]).astype(np.uint32), dtype=np.uint32)
    value = (block.data[place + np.repeat(block.first, size)].astype(np.uint32) + np.uint32(1)) * power[place]
    return np.add.reduceat(value, total[:-1], dtype=np.uint32) + size.astype(np.uint32)
