"""Dictionaries compiled to flat arrays and sent to the tasks, which find every entry in one pass over a text.

Between a set in the plan, for a few words, and joins of tokens with a table, for more than a task should hold. The automaton is
walked over a whole batch of texts at once, a step for all places together, in numpy; nothing is shuffled. What is a
letter, a word or lower case is decided in the JVM before, so that all paths agree.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from wordsieve.functions import tokens as T
from wordsieve.operators import joins
from wordsieve.session import share_package, stored

# Entries of scripts without blanks that a verdict may look up among the words it has cut.
SPACELESS_ENTRIES = 1_000_000

# Code points of text that are walked at once, texts that are decoded at once, and hits that leave at once.
BLOCK_CHARS = 1 << 19
DECODED_TEXTS = 512
LEAVING_HITS = 1 << 16

SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Automaton:
    """The entries of a dictionary as a tree of characters in flat arrays.

    Edges are numbered in the order of (state, character), level by level, so that edge k leads to state k + 1. They
    are looked up through a table of slots by a hash of state and character, half of it empty.
    """

    def __init__(self, words: Sequence[str]):
        self.words = sorted({w for w in words if w})
        sizes = np.array([len(w) for w in self.words], np.int64)
        begin = np.cumsum(sizes) - sizes
        codes = _codes("".join(self.words))
        self.kinds, kind = np.unique(codes, return_inverse=True)
        self.width = len(self.kinds) + 1
        # Which entry ends in a state, if any.
        parent = np.zeros(len(self.words), np.int64)
        ends, keys, states = [np.full(1, -1, np.int32)], [], 1
        for depth in range(int(sizes.max(initial=0))):
            open_ = np.flatnonzero(sizes > depth)
            found, child = np.unique(parent[open_] * self.width + kind[begin[open_] + depth] + 1, return_inverse=True)
            parent[open_] = states + child
            level = np.full(len(found), -1, np.int32)
            last = open_[sizes[open_] == depth + 1]
            level[parent[last] - states] = last
            ends.append(level)
            keys.append(found)
            states += len(found)
        self.entry = np.concatenate(ends)
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        if states * self.width < 1 << 32:
            self.keys = self.keys.astype(np.uint32)
        self.shift = np.uint64(64 - max(4, int(2 * len(self.keys)).bit_length()))
        self.slots = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self._fill()
        # Characters of the plane that most texts use, by table; the table of the others is searched.
        self.table = np.zeros(1 << 16, np.uint32)
        low = self.kinds < len(self.table)
        self.table[self.kinds[low]] = np.flatnonzero(low) + 1

    def __getstate__(self) -> dict:
        # The words go to tasks as one text, which is cut there only if they are asked for.
        return {**{k: v for k, v in self.__dict__.items() if k != "words"}, "_words": "\0".join(self.words) if not any("\0" in w for w in self.words) else self.words}

    def __getattr__(self, name: str):
        if name == "words" and "_words" in self.__dict__:
            held = self.__dict__.pop("_words")
            self.words = held if isinstance(held, list) else held.split("\0") if held else []
            return self.words
        raise AttributeError(name)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * SPREAD) >> self.shift).astype(np.int64)

    def _fill(self) -> None:
        waiting, at = np.arange(len(self.keys)), self._slot(self.keys)
        while len(waiting):
            free = np.flatnonzero(self.slots[at] == 0)
            _, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.slots[at[placed]] = waiting[placed] + 1
            rest = np.ones(len(waiting), bool)
            rest[placed] = False
            waiting, at = waiting[rest], (at[rest] + 1) & (len(self.slots) - 1)

    def kinds_of(self, codes: np.ndarray) -> np.ndarray:
        """The number of each character, 0 for those that no entry holds."""
        found = self.table[np.minimum(codes, len(self.table) - 1)]
        high = np.flatnonzero(codes >= len(self.table) - 1)
        if len(high):
            place = np.minimum(np.searchsorted(self.kinds, codes[high]), len(self.kinds) - 1)
            found[high] = np.where(self.kinds[place] == codes[high], place + 1, 0) if len(self.kinds) else 0
        return found

    def step(self, state: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """The next states, 0 where there is none."""
        keys = state * self.width + kind
        at, out, open_ = self._slot(keys), np.zeros(len(keys), np.int64), np.arange(len(keys))
        while len(open_):
            edge = self.slots[at]
            some = edge > 0
            hit = some & (self.keys[edge - 1] == keys[open_])
            out[open_[hit]] = edge[hit]
            go = some & ~hit
            open_, at = open_[go], (at[go] + 1) & (len(self.slots) - 1)
        return out

    def walk(self, kinds: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """All entries that begin at the places: (places, entries, their length), by length. ``kinds`` ends with a 0."""
        if not len(self.keys):
            return
        at = at[kinds[at] > 0]
        state, depth = np.zeros(len(at), np.int64), 0
        while len(at):
            state = self.step(state, kinds[at + depth])
            depth += 1
            at, state = at[state > 0], state[state > 0]
            ends = self.entry[state]
            if (some := ends >= 0).any():
                yield at[some], ends[some], depth
            on = kinds[at + depth] > 0
            at, state = at[on], state[on]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass
class Block:
    """Texts one after the other: rows, first places, code points, and where none of a text is."""

    rows: list[int]
    first: np.ndarray
    codes: np.ndarray
    gaps: np.ndarray

    def row_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, at, "right") - 1


def blocks(texts: Sequence[str | None]) -> Iterator[Block]:
    """Whole texts in blocks of about ``BLOCK_CHARS``, each followed by a gap."""
    rows: list[int] = []
    size = 0

    def block() -> Block:
        lengths = np.array([len(texts[r]) + 1 for r in rows], np.int64)
        codes = _codes("\n".join(texts[r] for r in rows) + "\n")
        first = np.cumsum(lengths) - lengths
        return Block(rows, first, codes, first + lengths - 1)

    for row, text in enumerate(texts):
        if text:
            rows.append(row)
            size += len(text) + 1
            if size >= BLOCK_CHARS:
                yield block()
                rows, size = [], 0
    if rows:
        yield block()


# --- which dictionaries are compiled ------------------------------------------------------------


def compiled(dictionary: DataFrame) -> list | None:
    """Broadcast automata of the distinct words, measured first; None for more than tasks should hold.

    A dictionary of more than ``AUTOMATON_CHARS`` characters is split by the beginnings of its entries, so that
    each part shares its paths, into up to ``AUTOMATON_PARTS`` automata.
    """
    words = dictionary.select("word").where(F.length("word") > 0)
    parts = _parts(words)
    return None if parts is None or parts > joins.AUTOMATON_PARTS else list(_broadcast(words, parts))


def compiled_passes(dictionary: DataFrame) -> list[list] | None:
    """The same for a dictionary of any size up to ``AUTOMATON_PASSES`` times as much: groups of automata, of which tasks hold one
    group at a time."""
    words = dictionary.select("word").where(F.length("word") > 0)
    parts = _parts(words)
    if parts is None or parts > joins.AUTOMATON_PARTS * joins.AUTOMATON_PASSES:
        return None
    if parts > joins.AUTOMATON_PARTS:
        words = stored(words.distinct(), "entries")
    automata = list(_broadcast(words, parts))
    return [automata[k : k + joins.AUTOMATON_PARTS] for k in range(0, parts, joins.AUTOMATON_PARTS)]


def _parts(words: DataFrame) -> int | None:
    """How many automata the words make, None if there should be none."""
    chars = words.agg(F.coalesce(F.sum(F.length("word") + 1), F.lit(0))).first()[0]
    return max(1, -(-chars // joins.AUTOMATON_CHARS)) if joins.AUTOMATON_CHARS else None


def _broadcast(words: DataFrame, parts: int) -> Iterator:
    spark = words.sparkSession
    share_package(spark)
    part = F.pmod(F.xxhash64(F.substring("word", 1, 2)), F.lit(parts))
    for k in range(parts):
        own = words if parts == 1 else words.where(part == k)
        yield spark.sparkContext.broadcast(Automaton(own.distinct().toPandas()["word"].tolist()))


# --- all places ---------------------------------------------------------------------------------


def found_at(automata: Sequence, texts: Sequence[str | None], inside: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row, start and length of every entry in every text, at most ``LEAVING_HITS`` at a time. Without ``inside``, none that begins
    between two ASCII letters."""
    for block in blocks(texts):
        places = np.arange(len(block.codes))
        if not inside:
            plain = (block.codes - 48 < 10) | (block.codes - 97 < 26)
            places = places[~(plain & np.concatenate([[False], plain[:-1]]))]
        rows, found = np.array(block.rows), []
        for one in automata:
            kinds = one.value.kinds_of(block.codes)
            kinds[block.gaps] = 0
            for at, _, n in one.value.walk(kinds, places):
                row = block.row_of(at)
                found.append((rows[row], at - block.first[row], np.full(len(at), n)))
        if found:
            hits = [np.concatenate(c) for c in zip(*found)]
            for k in range(0, len(hits[0]), LEAVING_HITS):
                yield tuple(c[k : k + LEAVING_HITS] for c in hits)


def find_all(df: DataFrame, ids: Sequence[str], text: Column, automata: Sequence, context: int, inside: bool, pad: str) -> DataFrame:
    """Every entry at every place of the texts: ids, start, n, word, and the text around it if asked."""
    rows = df.select(*ids, text.alias("_text"))
    fields = [S.StructField("start", S.LongType()), S.StructField("n", S.IntegerType()), S.StructField("word", S.StringType())]
    if context:
        fields.append(S.StructField("context", S.StringType()))
    schema = S.StructType([*rows.schema.fields[:-1], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, DECODED_TEXTS) for b in batches for k in range(0, b.num_rows, DECODED_TEXTS)):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for row, start, n in found_at(automata, texts, inside):
                places = list(zip(row.tolist(), start.tolist(), n.tolist()))
                columns = [c.take(pa.array(row)) for c in batch.columns[:-1]]
                columns += [pa.array(start, pa.int64()), pa.array(n, pa.int32()), pa.array([texts[r][s : s + k] for r, s, k in places], pa.string())]
                if context:
                    padded = {r: pad * context + texts[r] for r in set(row.tolist())}
                    columns.append(pa.array([padded[r][s : s + k + 2 * context] for r, s, k in places], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return rows.mapInArrow(run, schema)


# --- verdicts -----------------------------------------------------------------------------------


def _told(judge: Callable[[list], np.ndarray], text: Column) -> Column:
    """A verdict per text by Arrow batches; null for a null text."""

    def run(texts: pd.Series) -> pd.Series:
        given = [t if isinstance(t, str) else None for t in texts]
        told = judge(given)
        return pd.Series([None if t is None else bool(v) for t, v in zip(given, told)], dtype=object)

    return F.pandas_udf(run, S.BooleanType())(text)


def holds_anywhere(text: Column, automata: Sequence) -> Column:
    """Whether a text holds an entry, at any place."""

    def judge(texts: list) -> np.ndarray:
        told = np.zeros(len(texts), bool)
        for block in blocks(texts):
            for one in automata:
                kinds = one.value.kinds_of(block.codes)
                kinds[block.gaps] = 0
                for at, _, _ in one.value.walk(kinds, np.arange(len(kinds))):
                    told[np.array(block.rows)[block.row_of(at)]] = True
        return told

    return _told(judge, text)


class Table:
    """The entries of a dictionary as two numbers each, sorted by the first: 16 bytes an entry, however long it is."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        order = np.argsort(first, kind="stable")
        self.first, self.second = first[order], second[order]
        # How many entries share a first number, nearly always one.
        self.most = int(np.unique(self.first, return_counts=True)[1].max(initial=0))

    def holds(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        found, at = np.zeros(len(first), bool), np.searchsorted(self.first, first)
        for k in range(self.most):
            place = np.minimum(at + k, len(self.first) - 1)
            found |= (self.first[place] == first) & (self.second[place] == second)
        return found


def _first(entry: Column) -> Column:
    return F.xxhash64(entry)


def _second(entry: Column) -> Column:
    return F.xxhash64(F.lit(1), entry)


def hashed(dictionary: DataFrame):
    """A broadcast table of the distinct words, which tasks look whole tokens up in; None for more than the driver should gather.

    It takes 16 bytes an entry, and comes as columns: a row would take many times as much.
    """
    words = dictionary.select("word").where(F.length("word") > 0)
    if words.count() > min(joins.TABLE_WORDS, joins.AUTOMATON_CHARS * joins.AUTOMATON_PARTS):
        return None
    pairs = words.distinct().select(_first(F.col("word")).alias("a"), _second(F.col("word")).alias("b")).toArrow()
    share_package(dictionary.sparkSession)
    return dictionary.sparkSession.sparkContext.broadcast(Table(pairs.column("a").to_numpy(), pairs.column("b").to_numpy()))


def held_words(tokens: Column, sizes: Sequence[int], df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The rows of a dictionary whose word is a token, or a run of tokens of the given sizes, of some text.

    The distinct words of the texts meet the dictionary, each word once, so that a frequent one meets no single task.
    """
    words = df.select(F.explode(_grams(tokens, sizes)).alias("word")).distinct()
    return stored(dictionary.join(words, "word", "left_semi"), "held")


def _grams(tokens: Column, sizes: Sequence[int]) -> Column:
    return F.flatten(F.array(*[T.ngrams(tokens, n) for n in sorted(sizes)])) if sizes else F.slice(tokens, 1, 0)


def gram_numbers(tokens: Column, sizes: Sequence[int]) -> Column:
    """The numbers of all tokens and runs of tokens of the given sizes: the first numbers of all, then the second ones."""
    return T.bind(_grams(tokens, sizes), lambda g: F.concat(F.transform(g, _first), F.transform(g, _second)))


def holds_words(numbers: Column, joined: Column, table, cut: Sequence = (), listed: frozenset[str] = frozenset()) -> Column:
    """Whether a text, given as ``gram_numbers`` and as its tokens joined by blanks, holds an entry of whole tokens; null for no array.

    ``cut`` are automata of a dictionary of scripts without blanks. Tokens of these are segmented by it from left to
    right, the longest word first, and sought among ``listed``.
    """

    def hashed_hits(numbers: pd.Series) -> np.ndarray:
        told = np.zeros(len(numbers), bool)
        some = [(k, a, len(a) // 2) for k, a in enumerate(numbers) if a is not None and len(a)]
        if some:
            ends = np.cumsum([n for _, _, n in some])
            hit = table.value.holds(np.concatenate([a[:n] for _, a, n in some]), np.concatenate([a[n:] for _, a, n in some]))
            told[[k for k, _, _ in some]] = np.logical_or.reduceat(hit, np.concatenate([[0], ends[:-1]]))
        return told

    def verdicts(numbers: pd.Series, told: np.ndarray) -> pd.Series:
        return pd.Series([None if a is None else bool(v) for a, v in zip(numbers, told)], dtype=object)

    def run(numbers: pd.Series) -> pd.Series:
        return verdicts(numbers, hashed_hits(numbers))

    def run_cutting(numbers: pd.Series, joined: pd.Series) -> pd.Series:
        told = hashed_hits(numbers)
        texts = [t if isinstance(t, str) else None for t in joined]
        for block in blocks(texts):
            longest = longest_at(block, cut)
            for k, row in enumerate(block.rows):
                if not told[row]:
                    text = texts[row]
                    told[row] = any(w in listed for w in _greedy(text, longest[block.first[k] : block.first[k] + len(text)]))
        return verdicts(numbers, told)

    if not cut:
        return F.pandas_udf(run, S.BooleanType())(numbers)
    return F.pandas_udf(run_cutting, S.BooleanType())(numbers, joined)


def longest_at(block: Block, automata: Sequence) -> np.ndarray:
    """The length of the longest entry that begins at each place, 0 where none does."""
    longest = np.zeros(len(block.codes), np.int64)
    for one in automata:
        kinds = one.value.kinds_of(block.codes)
        kinds[block.gaps] = 0
        for at, _, n in one.value.walk(kinds, np.arange(len(kinds))):
            longest[at] = np.maximum(longest[at], n)
    return longest


def _greedy(text: str, longest: np.ndarray) -> Iterator[str]:
    """The words that a choice from left to right takes."""
    at = 0
    for start in np.flatnonzero(longest).tolist():
        if start >= at:
            at = start + int(longest[start])
            yield text[start:at]


def first_listed(text: Column, automata: Sequence, listed: Sequence) -> Column:
    """Of the words that a dictionary cuts out of a text from left to right, the first that is among the ``listed`` ones (automata
    too): start, word; null where there is none."""
    shape = S.StructType([S.StructField("start", S.LongType()), S.StructField("word", S.StringType())])

    def run(texts: pd.Series) -> pd.DataFrame:
        given = [t if isinstance(t, str) else None for t in texts]
        wanted = set().union(*(one.value.words for one in listed))
        found: list[tuple] = [(None, None)] * len(given)
        for block in blocks(given):
            longest = longest_at(block, automata)
            for k, row in enumerate(block.rows):
                body, at = given[row], 0
                own = longest[block.first[k] : block.first[k] + len(body)]
                for start in np.flatnonzero(own).tolist():
                    if start >= at:
                        at = start + int(own[start])
                        if body[start:at] in wanted:
                            found[row] = (start, body[start:at])
                            break
        return pd.DataFrame({"start": pd.array([s for s, _ in found], dtype="Int64"), "word": pd.Series([w for _, w in found], dtype=object)})

    return F.pandas_udf(run, shape)(text)


def spaceless(words: Sequence[str]) -> list[str]:
    """The words of scripts without blanks, as segmentation takes them."""
    return [w for w in words if w and all(unicodedata.category(c)[0] in "LMN" and not T.in_alphabet(c) for c in w)]


# --- segmentation -------------------------------------------------------------------------------


def segment_runs(runs: DataFrame, ids: Sequence[str], automata: Sequence) -> DataFrame:
    """Runs (ids, start, run) as tokens from left to right, the longest entry first: ids, start, end, term, known."""
    rows = runs.select(*ids, "start", "run")
    fields = [("start", S.LongType()), ("end", S.LongType()), ("term", S.StringType()), ("known", S.BooleanType())]
    schema = S.StructType([*rows.schema.fields[:-2], *(S.StructField(n, t) for n, t in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = batch.column(batch.num_columns - 2).to_pylist()
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for block in blocks(texts):
                owner, start, term, known = [], [], [], []
                longest = longest_at(block, automata).tolist()
                for k, row in enumerate(block.rows):
                    text, first, at = texts[row], int(block.first[k]), 0
                    while at < len(text):
                        n = longest[first + at]
                        owner.append(row)
                        start.append(base[row] + at)
                        term.append(text[at : at + (n or 1)])
                        known.append(n > 0)
                        at += n or 1
                columns = [c.take(pa.array(owner, pa.int64())) for c in batch.columns[:-2]]
                ends = [s + len(t) for s, t in zip(start, term)]
                columns += [pa.array(start, pa.int64()), pa.array(ends, pa.int64()), pa.array(term, pa.string()), pa.array(known, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return rows.mapInArrow(run, schema)
