"""Token counts of a byte-level BPE vocabulary by finite-state transducers.

Two deterministic transducers are compiled from the vocabulary file. The first cuts a text into pretokens; its
transitions say where one starts. It runs over chunks of text at once: each chunk yields its map from
every state to the state at its end, a parallel prefix scan composes the maps, and a second pass reads the
starts off. The second runs over the bytes of a pretoken; its transitions say by how many tokens the encoding
of the prefix grows. Its states are made when first needed, by subset construction over the trie of tokens.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordsieve.llm.common import blocks, map_text, quoted

LIMIT = 1024

# Characters that a lane of the chunked run reads.
LANE = 256
# A worker's tables start anew beyond these sizes, looked at once a block; results don't depend on them.
MOST_STATES = 250_000
MOST_WORDS = 500_000

# Input classes of the pretokeniser.
LETTER, SHORT, R_V, E, L, NUMBER, OTHER, QUOTE, BLANK, SPACE, BREAK = range(11)
# Its states: nothing open; inside letters, numbers, others; after a blank, after other white space; after an
# apostrophe that opens a pretoken; after that and r or v; after that and l.
NONE, LETTERS, NUMBERS, OTHERS, AFTER_BLANK, AFTER_SPACE, QUOTED, QUOTED_E, QUOTED_L = range(9)
STATES, CLASSES = 9, 11
# What a transition says: a pretoken starts here, at the character before, or both.
HERE, BEFORE = 1, 2

# The white space of Unicode.
WHITE = (9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)


def classes() -> np.ndarray:
    """The class of each code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = LETTER
        elif kind == "N":
            table[code] = NUMBER
    table[list(WHITE)] = SPACE
    table[ord(" ")], table[ord("'")], table[ord("e")], table[ord("l")] = BLANK, QUOTE, E, L
    table[[ord(c) for c in "stmd"]] = SHORT
    table[[ord(c) for c in "rv"]] = R_V
    return table


def pretokeniser() -> tuple[np.ndarray, np.ndarray]:
    """Next state and starts for class times states plus state.

    The rules are those of byte-level BPE: a contraction ('s 't 'm 'd 're 've 'll), or one optional blank and a
    run of letters, of numbers or of other marks, or white space up to the last character before a word.
    """
    letters = {LETTER, SHORT, R_V, E, L}
    step = np.zeros((CLASSES, STATES), np.uint8)
    says = np.zeros((CLASSES, STATES), np.uint8)
    for c in range(CLASSES):
        run = LETTERS if c in letters else {NUMBER: NUMBERS, OTHER: OTHERS, QUOTE: OTHERS, BLANK: AFTER_BLANK, SPACE: AFTER_SPACE}.get(c, NONE)
        for s in range(STATES):
            to, starts = run, HERE
            if c == BREAK:
                # The blank before a break is no part of what follows.
                step[c, s], says[c, s] = NONE, HERE | (BEFORE if s in (QUOTED_E, QUOTED_L) else 0)
                continue
            if c == QUOTE and s not in (OTHERS, AFTER_BLANK, QUOTED):
                to = QUOTED
            if s == run and run in (LETTERS, NUMBERS, OTHERS) or s == QUOTED and run == OTHERS:
                starts = 0
            elif s in (AFTER_BLANK, AFTER_SPACE):
                white = run in (AFTER_BLANK, AFTER_SPACE)
                starts = 0 if white else BEFORE if s == AFTER_BLANK else BEFORE | HERE
            elif s == QUOTED and c == SHORT:
                to, starts = NONE, 0
            elif s == QUOTED and c in (R_V, L):
                to, starts = (QUOTED_E if c == R_V else QUOTED_L), 0
            elif s == QUOTED_E and c == E or s == QUOTED_L and c == L:
                to, starts = NONE, 0
            elif s in (QUOTED_E, QUOTED_L):
                # No contraction after all: the letter before opens a run.
                starts = BEFORE if run == LETTERS else BEFORE | HERE
            step[c, s], says[c, s] = to, starts
    return step.ravel(), says.ravel()


def starts(codes: np.ndarray, step: np.ndarray, says: np.ndarray) -> np.ndarray:
    """Where pretokens start, given the classes of characters, by chunk maps and a prefix scan."""
    size = len(codes)
    lanes = max(1, -(-size // LANE))
    grid = np.full(lanes * LANE, BREAK, np.int32)
    grid[:size] = codes
    grid = np.ascontiguousarray(grid.reshape(lanes, LANE).T) * STATES
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (lanes, 1))
    for row in grid:
        maps = step[row[:, None] + maps]
    # Inclusive scan: after round k a lane's map covers 2^k lanes up to it.
    reach = 1
    while reach < lanes:
        later = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), 1)
        maps = np.concatenate([maps[:reach], later])
        reach *= 2
    state = np.concatenate([np.array([NONE], np.uint8), maps[:-1, NONE]])
    told = np.empty(grid.shape, np.uint8)
    for k, row in enumerate(grid):
        move = row + state
        told[k] = says[move]
        state = step[move]
    told = told.T.ravel()
    here = (told[:size] & HERE) > 0
    here[:-1] |= (told[1:size] & BEFORE) > 0
    if size and len(told) > size:
        here[-1] |= bool(told[size] & BEFORE)
    return np.flatnonzero(here)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: itself if printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Transducer:
    """Tokens of a pretoken, counted by a deterministic transducer over its bytes.

    The encoding of a prefix is known by its last token: it is the longest token that ends the prefix and agrees
    with the last token of the prefix before it. A state is the set of tokens that may still be open, each with the
    last token before it and the tokens up to there, against those of the whole prefix. A transition carries
    the growth of the count, which may be negative, as a merge joins what were several tokens.
    """

    def __init__(self, merges: Sequence[Sequence[str]]):
        letters = byte_letters()
        self.ids: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: list[tuple[int, int] | None] = [None] * 256
        self.made = [-1] * 256
        for rank, (left, right) in enumerate(merges):
            a, b = (bytes(letters[c] for c in part) for part in (left, right))
            pair = (self.ids[a], self.ids[b])
            self.rank[pair] = rank
            if a + b not in self.ids:
                self.ids[a + b] = len(self.halves)
                self.halves.append(pair)
                self.made.append(rank)
        self.child: dict[int, int] = {}
        self.token: list[int] = [-1]
        for word, token in self.ids.items():
            node = 0
            for byte in word:
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(-1)
                node = self.child[key]
            self.token[node] = token
        self.inner = {key >> 8 for key in self.child}
        self.agrees: dict[tuple[int, int], bool] = {}
        self.counts: dict[str, int] = {}
        self.reset()

    def reset(self) -> None:
        self.states: list[tuple] = [((0, -1, 0),)]
        self.known = {self.states[0]: 0}
        self.go: dict[int, tuple[int, int]] = {}

    def spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts at one edge of a token, outermost first, each with the rank of the merge that takes it in."""
        parts, taken = [(token, len(self.rank) + 1)], 0
        while (halves := self.halves[token]) is not None:
            taken, token = self.made[token], halves[side]
            parts.append((token, taken))
        return parts

    def stays(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart: no merge over their border comes before those that take its parts in.

        Of merges of equal rank the leftmost comes first.
        """
        if left < 0:
            return True
        if (left, right) not in self.agrees:
            if len(self.agrees) > 2 * MOST_STATES:
                self.agrees.clear()
            other = self.spine(right, 0)
            self.agrees[left, right] = not any(
                (rank := self.rank.get((a, b))) is not None and rank < taken_a and rank <= taken_b
                for a, taken_a in self.spine(left, 1)
                for b, taken_b in other
            )
        return self.agrees[left, right]

    def transition(self, state: int, byte: int) -> tuple[int, int]:
        opened, last = [], None
        for node, before, count in self.states[state]:
            to = self.child.get(node << 8 | byte)
            if to is None:
                continue
            if to in self.inner:
                opened.append((to, before, count))
            if last is None and self.token[to] >= 0 and self.stays(before, self.token[to]):
                last = (self.token[to], count + 1)
        token, gain = last
        target = (*[(node, before, count - gain) for node, before, count in opened], (0, token, 0))
        if target not in self.known:
            self.known[target] = len(self.states)
            self.states.append(target)
        self.go[state << 8 | byte] = found = (self.known[target], gain)
        return found

    def count(self, words: list[str]) -> list[int]:
        """Tokens of each pretoken."""
        if len(self.states) > MOST_STATES:
            self.reset()
        if len(self.counts) > MOST_WORDS:
            self.counts.clear()
        sizes = list(map(self.counts.get, words))
        go = self.go
        for k, size in enumerate(sizes):
            if size is None:
                word = words[k]
                if (found := self.counts.get(word)) is None:
                    state, found = 0, 0
                    for byte in word.encode():
                        state, gain = go.get(state << 8 | byte) or self.transition(state, byte)
                        found += gain
                    self.counts[word] = found
                sizes[k] = found
        return sizes


class Counter:
    """Counts tokens of whole texts; ``specials`` in a text are one token each."""

    def __init__(self, merges: Sequence[Sequence[str]], specials: Sequence[str]):
        self.words = Transducer(merges)
        self.specials = specials
        self.table = classes()
        self.step, self.says = pretokeniser()

    def plain(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each piece of text, none of which holds a special token."""
        text = "\0".join(pieces)
        codes = self.table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
        codes[ends[:-1]] = BREAK
        at = starts(codes, self.step, self.says)
        edges = at.tolist()
        edges.append(len(text))
        sizes = np.array(self.words.count([text[a:b] for a, b in zip(edges, edges[1:])]), np.int64)
        # A break is a pretoken of its own and stands for no token.
        sizes[codes[at] == BREAK] = 0
        total = np.concatenate([[0], np.cumsum(sizes)])
        first = np.concatenate([[0], ends[:-1] + 1])
        return total[np.searchsorted(at, ends)] - total[np.searchsorted(at, first)]

    def __call__(self, texts: Sequence[str | None]) -> np.ndarray:
        sums = np.zeros(len(texts), np.int64)
        for special in self.specials:
            for row, text in enumerate(texts):
                if text and special in text:
                    sums[row] += text.count(special)
        for rows, parts in blocks(texts):
            pairs = [(r, p) for r, part in zip(rows, parts) for p in self.split(part) if p]
            if pairs:
                np.add.at(sums, [r for r, _ in pairs], self.plain([p for _, p in pairs]))
        return sums

    def split(self, text: str) -> list[str]:
        parts = [text]
        for special in self.specials:
            parts = [x for part in parts for x in part.split(special)]
        return parts


def load(path: str) -> tuple[list, list[str]]:
    """Merges and special tokens of a vocabulary file."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    merges = [m.split(" ") if isinstance(m, str) else m for m in found["model"]["merges"]]
    return merges, [t["content"] for t in found["added_tokens"]]


def token_counts(docs: DataFrame, path: str, text: str = "text", limit: int = LIMIT, keep_text: bool = False) -> DataFrame:
    """The columns of ``docs`` with n_bytes, n_tokens and over_limit of each whole text.

    The merges, bounded by the vocabulary, are read on the driver and sent to the tasks. Nothing is shuffled. A
    null or empty text has 0 tokens; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(path))
    sized = docs.withColumn("n_bytes", F.coalesce(F.octet_length(quoted(text)), F.lit(0)).cast("long"))

    def make():
        counter = Counter(*shared.value)
        return lambda texts: [pa.array(counter(texts))]

    out = T.StructType([T.StructField("n_tokens", T.LongType())])
    counted = map_text(sized, text, out, make, keep_text)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
