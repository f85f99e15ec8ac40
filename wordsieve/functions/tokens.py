"""Tokens of one text, as array columns: no shuffle, no explode."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters, marks and digits of all scripts, as a character class. ``\w`` is ASCII only and would cut at accents.
LETTERS = "\\p{L}\\p{M}\\p{N}"

# Scripts that put no blanks between words: their runs are no words but need a dictionary.
SPACELESS = "".join(f"\\p{{Is{name}}}" for name in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar"))

# Letters of alphabets, of which a run is a word, and the others. The plain ones come first: asking for the script of a letter
# costs many times what a range does.
ALPHABET = f"a-z0-9[{LETTERS}&&[^{SPACELESS}]]"
OTHER = f"{LETTERS}&&[{SPACELESS}]"

# Words are grouped by these lengths, and sought by their first characters within a group.
HEADS = (1, 2, 4, 8)

# Items per step of the outer fold of a choice from left to right.
BLOCK = 32


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute a value once for an expression that needs it in several places, as inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits of any alphabet, in text order.

    A run of a script without blanks is one token here; ``segmented`` cuts it by a dictionary.
    """
    return F.regexp_extract_all(F.lower(text), F.lit(f"[{ALPHABET}]+|[{OTHER}]+"), F.lit(0))


def segmented(text: Column, dictionary: Sequence[str], latin_runs: bool = True) -> Column:
    """Lower-cased tokens by a few words, from left to right, the longest first.

    With ``latin_runs`` a run of letters of an alphabet is one token, as in ``words``, and only runs of scripts without
    blanks are cut; without it all letters are. Characters that no word covers are tokens of their own.
    """
    sought = [w for w in dictionary if w and all(unicodedata.category(c)[0] in "LMN" and not (latin_runs and in_alphabet(c)) for c in w)]
    parts = [f"[{ALPHABET}]+"] if latin_runs else []
    parts += [alternation(sought)] if sought else []
    parts.append(f"[{OTHER if latin_runs else LETTERS}]")
    return F.regexp_extract_all(F.lower(text), F.lit("|".join(parts)), F.lit(0))


def in_alphabet(char: str) -> bool:
    """Whether a letter belongs to a script that puts blanks between words."""
    return unicodedata.name(char, "").split(" ")[0] not in ("CJK", "IDEOGRAPHIC", "HIRAGANA", "KATAKANA", "HALFWIDTH", "THAI", "LAO", "KHMER", "MYANMAR")


def ngrams(tokens: Column, size: int) -> Column:
    """All runs of ``size`` neighbouring tokens, joined by a blank."""
    if size == 1:
        return tokens

    def grams(a: Column) -> Column:
        last = F.size(a) - size
        joined = lambda i: F.array_join(F.slice(a, i + 1, F.lit(size)), " ")
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), joined)).otherwise(F.array().cast("array<string>"))

    return bind(tokens, grams)


def blank_words(text: Column) -> Column:
    """Lower-cased text split at every blank; neighbouring blanks give empty strings."""
    return F.split(F.lower(text), "\\s")


def longer_than(tokens: Column, length: int = 1) -> Column:
    """Tokens longer than ``length`` characters."""
    return F.filter(tokens, lambda t: F.length(t) > length)


def context_ngrams(tokens: Column) -> Column:
    """Each token, followed by its join with the one before and with both neighbours.

    The first token stands alone, the last has no right neighbour. No tokens give no n-grams.
    """

    def grams(a: Column) -> Column:
        def around(now: Column, i: Column) -> Column:
            pair = F.concat(F.get(a, i - 1), now)
            triple = F.concat(pair, F.get(a, i + 1))
            return F.when(i == 0, F.array(now)).otherwise(F.array_compact(F.array(now, pair, triple)))

        return F.flatten(F.transform(a, around))

    return bind(tokens, grams)


def windows(text: Column, width: int) -> Column:
    """For each code point of the text, up to ``width`` code points from there on."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{width}}}))."), F.lit(1))


def chunks(text: Column, step: int, overlap: int) -> Column:
    """The text cut every ``step`` code points, each piece reaching ``overlap`` into the next.

    Position-wise work inside a piece stays linear in the text, and no array grows with it.
    """
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{step + overlap}}})).{{1,{step}}}"), F.lit(1))


def run_classes(latin_runs: bool) -> list[str]:
    """Character classes whose runs are segmented apart: alphabets and other scripts, or all letters as one."""
    return [ALPHABET, OTHER] if latin_runs else [LETTERS]


def letter_runs(text: Column, latin_runs: bool) -> Column:
    """Lower-cased runs of letters and digits."""
    pattern = "|".join(f"[{c}]+" for c in run_classes(latin_runs))
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def is_latin(run: Column) -> Column:
    """Whether a run is of an alphabet, and so a word."""
    return run.rlike(f"^[{ALPHABET}]")


def is_one_of(value: Column, words: Sequence[str]) -> Column:
    return value.isin(list(words)) if words else F.lit(False)


def left_to_right(
    items: Column,
    end: Callable[[Column, Column], Column],
    begin: Callable[[Column, Column], Column] = lambda item, i: i,
) -> Column:
    """Take items in order, each if it begins at or after the end of the one taken before: their indexes.

    A fold copies its state at every step, so a list that grew through all of them would cost the
    square of its length. The inner fold therefore runs over a short block and the outer one over blocks.
    """
    no_index = F.array().cast("array<int>")

    def block(first: Column, next_: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            item = F.get(items, i)
            taken = F.struct(end(item, i).alias("next"), F.array_append(acc["out"], i).alias("out"))
            return F.when(begin(item, i) >= acc["next"], taken).otherwise(acc)

        last = F.least(F.size(items), first + BLOCK) - 1
        return F.aggregate(F.sequence(first, last), F.struct(next_.alias("next"), no_index.alias("out")), step)

    def over_blocks(acc: Column, first: Column) -> Column:
        joined = lambda r: F.struct(r["next"].alias("next"), F.concat(acc["out"], r["out"]).alias("out"))
        return bind(block(first, acc["next"]), joined)

    firsts = F.sequence(F.lit(0), F.size(items) - 1, F.lit(BLOCK))
    none = F.struct(F.lit(0).alias("next"), no_index.alias("out"))
    return F.when(F.size(items) > 0, F.aggregate(firsts, none, over_blocks, lambda acc: acc["out"])).otherwise(no_index)


def alternation(words: Sequence[str]) -> str:
    """A pattern for the longest of some words, their common beginnings factored out.

    At a position it goes down the tree of their characters, so the work hangs on the text and not on how many
    words there are or how long they may be.
    """
    tree: dict = {}
    for w in words:
        node = tree
        for c in w:
            node = node.setdefault(c, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        inner = "|".join(literal(c) + pattern(deeper) for c, deeper in sorted(node.items()) if c)
        if not inner:
            return ""
        return f"(?:{inner})" + ("?" if "" in node else "")

    return pattern(tree)


def literal(char: str) -> str:
    """A character as a pattern."""
    return char if char.isalnum() else f"\\x{{{ord(char):x}}}"


def greedy(run: Column, words: Sequence[str]) -> Column:
    """Segment a run by a few words given in the plan: from left to right, the longest word first: term, known.

    Characters that no word covers are tokens of their own.
    """
    listed = [w for w in words if w]
    pattern = f"(?s){alternation(listed)}|." if listed else "(?s)."
    terms = F.regexp_extract_all(run, F.lit(pattern), F.lit(0))
    return F.transform(terms, lambda t: F.struct(t.alias("term"), is_one_of(t, listed).alias("known")))


def starts(tokens: Column) -> Column:
    """Offset of each token in the run that the tokens make up, by sums over blocks and inside them."""
    no_index = F.array().cast("array<int>")

    def sums(lengths: Column, base: Column) -> Column:
        first = F.struct(base.alias("next"), no_index.alias("out"))
        return F.aggregate(
            lengths, first, lambda acc, n: F.struct((acc["next"] + n).alias("next"), F.array_append(acc["out"], acc["next"]).alias("out"))
        )

    def over_blocks(lengths: Column) -> Column:
        step = lambda acc, at: bind(
            sums(F.slice(lengths, at + 1, F.lit(BLOCK)), acc["next"]),
            lambda r: F.struct(r["next"].alias("next"), F.concat(acc["out"], r["out"]).alias("out")),
        )
        firsts = F.sequence(F.lit(0), F.size(lengths) - 1, F.lit(BLOCK))
        none = F.struct(F.lit(0).alias("next"), no_index.alias("out"))
        return F.when(F.size(lengths) > 0, F.aggregate(firsts, none, step, lambda acc: acc["out"])).otherwise(no_index)

    return bind(F.transform(tokens, lambda t: F.length(t)), over_blocks)
