"""Words grouped with their spelling variants: words one edit apart, by asymmetric chunks."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordsieve.llm.common import quoted
from wordsieve.operators.joins import attach
from wordsieve.session import stored

RUN = "[a-zÀ-ÿ]+"
LEAST_LENGTH = 5
LEAST_COUNT = 3
# One occurrence in so many loses a code point, by a hash of its document and itself.
DAMAGED = 97
# A word's form has so many times its occurrences at least.
FORM_RATIO = 2

# Pairs under one key that are compared as they are; keys of more are chunked again.
KEY_PAIRS = 4096


def damaged_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(word, n): the runs of Latin letters of all texts with A-Z lowered, one in ``DAMAGED`` of them short of a letter.

    Counts are combined in the tasks before their shuffle. Null and empty texts have no word; a null id counts as
    an empty one.
    """
    lowered = F.translate(quoted(text), string.ascii_uppercase, string.ascii_lowercase)
    runs = docs.select(
        F.concat(F.coalesce(quoted(doc_id).cast("string"), F.lit("")), F.lit(":")).alias("key"),
        F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run"),
    )
    hashed = runs.select("run", F.crc32(F.concat("key", "run").cast("binary")).alias("h"))
    place = F.pmod("h", F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
    word = F.when(F.pmod("h", F.lit(DAMAGED)) == 0, short).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _left(word: Column, n: Column) -> Column:
    return F.substring(word, F.lit(1), n)


def _right(word: Column, size: Column, n: Column) -> Column:
    """The last ``n`` characters of a word of ``size``."""
    return F.substring(word, size - n + 1, n)


def _records(rows: DataFrame, spans: Column) -> DataFrame:
    """A row for each span (lo, hi) that may hold the edit, keyed by what lies before and behind it.

    ``size`` is the length of the word that contributes chunks; the same span is seen from the end of the other word,
    where the chunk behind the edit is shifted by the difference of their lengths.
    """
    spread = rows.select("word", "n", "gram", "size", F.explode(spans).alias("_s")).select("word", "n", "gram", "size", "_s.lo", "_s.hi")
    rest = F.col("size") - F.col("hi")
    key = F.xxhash64("size", "lo", "hi", _left(F.col("word"), F.col("lo")), _right(F.col("word"), F.length("word"), rest))
    return spread.withColumn("key", key)


def _halves(lo: Column, hi: Column) -> Column:
    """The edit is behind the first half, or inside it."""
    middle = (lo + F.floor((hi - lo) / 2)).cast("int")
    span = lambda a, b: F.struct(a.alias("lo"), b.alias("hi"))
    return F.array(span(middle, hi), span(lo, middle))


def near_pairs(words: DataFrame, key_pairs: int = KEY_PAIRS) -> DataFrame:
    """All pairs of the distinct ``words`` (word, n) one inserted, deleted or replaced code point apart: word, n, near, near_n.

    Asymmetric q-chunks: a word contributes two disjoint chunks, its halves; the other word, as long or one
    shorter, the grams of their lengths at their places. One edit leaves a chunk whole: the first where it is, the second
    moved by the difference of the lengths, so within a shift of one. Grams at other places could join nothing and are
    not listed. Chunks that too many words share are chunked again: what lies outside the chunk is halved, and joined
    by the chunk and one of its halves, until a key has at most ``key_pairs`` pairs or all but one code
    point. No pair is lost by that, and no group is compared whole. Each pair is verified, and given by the one
    key whose span holds the first place in which its words differ. Pairs come in both directions.

    The number of rounds is that of halvings of the longest word. Each writes its records and its hot keys. Words
    under two code points have no halves and are left out.
    """
    size = F.length("word")
    sized = words.select("word", "n", size.alias("size"), F.explode(F.array(F.struct(F.lit(False).alias("gram"), size.alias("of")), F.struct(F.lit(True).alias("gram"), size.alias("of")), F.struct(F.lit(True).alias("gram"), (size + 1).alias("of")))).alias("_r"))
    rows = sized.where("size > 1").select("word", "n", "_r.gram", F.col("_r.of").alias("size"))
    records = _records(rows, _halves(F.lit(0), F.col("size")))
    found = None
    while records is not None:
        counts = records.groupBy("key").agg(
            F.sum(F.when(F.col("gram"), 0).otherwise(1)).alias("chunks"), F.sum(F.when(F.col("gram"), 1).otherwise(0)).alias("grams"),
            F.max(F.col("hi") - F.col("lo")).alias("width"),
        )
        hot = stored(counts.where((F.col("chunks") * F.col("grams") > key_pairs) & (F.col("width") > 1)).select("key", F.lit(True).alias("hot")), "variants-hot")
        any_hot = not hot.isEmpty()
        cold = records
        if any_hot:
            marked = attach(records, hot, ["key"], "left", ["word"])
            cold = marked.where(F.col("hot").isNull())
        pairs = _compared(cold)
        found = pairs if found is None else found.unionByName(pairs)
        records = stored(_records(marked.where("hot").drop("key"), _halves(F.col("lo"), F.col("hi"))), "variants-records") if any_hot else None
    return found.select("word", "n", "near", "near_n").unionByName(
        found.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    )


def _compared(records: DataFrame) -> DataFrame:
    """The verified pairs among the records of each key."""
    chunks = records.where(~F.col("gram")).select("key", "word", "n", "size", "lo", "hi")
    grams = records.where("gram").select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    word, near, lo, hi, size = F.col("word"), F.col("near"), F.col("lo"), F.col("hi"), F.col("size")
    joined = chunks.join(grams, "key").where(
        # Of two words of one length each is listed on both sides.
        ((F.length(near) == size - 1) | ((F.length(near) == size) & (word < near)))
        & (_left(word, lo) == _left(near, lo))
        & (_left(word, hi) != _left(near, hi))
        & (_right(word, size, size - hi) == _right(near, F.length(near), size - hi))
        & (F.levenshtein(word, near, 1) == 1)
    )
    return joined.select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form (word, form): the last word that forms lead to.

    Every round follows twice as many forms. A form has more occurrences than its word, so there is no circle.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        beyond = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = attach(now, beyond, ["root"], "left", ["word"])
        now = stored(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variants-roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.drop("moved")


def variants(words: DataFrame, ratio: int = FORM_RATIO, key_pairs: int = KEY_PAIRS) -> DataFrame:
    """word, n, form, root, n_near, form_n of distinct words with their occurrences (word, n).

    ``form`` is the near word of most occurrences, of equal ones the first in code point order, if it has ``ratio`` times
    those of the word, else null. ``root`` is where forms lead from the word, the word itself if nowhere. Null words
    are left out; other columns are dropped; an empty table gives an empty result.
    """
    known = stored(words.where(F.col("word").isNotNull()).select("word", F.col("n").cast("long").alias("n")), "variants-words")
    nothing = known.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("minus"), F.col("near"))))
    per_word = near_pairs(known, key_pairs).unionByName(nothing).groupBy("word", "n").agg(F.count("near").alias("n_near"), best.alias("best"))
    enough = -F.col("best.minus") >= ratio * F.col("n")
    told = stored(
        per_word.select("word", "n", "n_near", F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n")),
        "variants-forms",
    )
    ends = roots(told.where(F.col("form").isNotNull()))
    return told.join(ends, "word", "left").select("word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")
