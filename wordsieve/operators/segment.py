"""Token rows: words of Latin text, dictionary segmentation of text without blanks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordsieve.functions import tokens as T
from wordsieve.operators import automaton
from wordsieve.operators.joins import attach, footprint, inline_words, within_bounds

# Code points per piece when a text is cut into runs.
RUN_STEP = 1024

# Code points per piece when every position is looked up.
STEP = 256

# Words up to this length are compared with the characters that follow a position, longer ones with its piece.
WINDOW = 64

# Two characters between which no word of an alphabet begins or ends.
INSIDE_WORD = f"^[{T.ALPHABET}]{{2}}$"

# Stands for the missing left neighbours at the start of a text.
PAD = "\u0000"


@dataclass(frozen=True)
class DictionaryShape:
    longest: int
    head_lengths: tuple[int, ...]
    broadcast: bool


def _head_length(word: Column) -> Column:
    length = F.length(word)
    picked = F.lit(T.HEADS[0])
    for n in T.HEADS[1:]:
        picked = F.when(length >= n, n).otherwise(picked)
    return picked


def dictionary_shape(dictionary: DataFrame) -> DictionaryShape:
    """What the plan needs to know of a dictionary: a few numbers from one aggregate."""
    word = F.col("word")
    longest, heads, rows, size = dictionary.agg(
        F.max(F.length(word)), F.sort_array(F.collect_set(_head_length(word))), *footprint(dictionary)
    ).first()
    return DictionaryShape(longest or 0, tuple(heads), within_bounds(rows, size))


def word_rows(df: DataFrame, ids: Sequence[str], text: Column) -> DataFrame:
    """One row per Latin token: ids, position in the text, term."""
    return df.select(*ids, F.posexplode(T.words(text)).alias("pos", "term"))


def _starts(pieces: Column) -> Column:
    """Offset of each piece: the summed length of those before it."""
    none = F.struct(F.lit(0).alias("next"), F.array().cast("array<int>").alias("starts"))
    total = F.aggregate(
        pieces,
        none,
        lambda acc, p: F.struct(
            (acc["next"] + F.length(p)).alias("next"), F.array_append(acc["starts"], acc["next"]).alias("starts")
        ),
    )
    return total["starts"]


def runs(df: DataFrame, ids: Sequence[str], text: Column, classes: Sequence[str]) -> DataFrame:
    """Maximal runs of characters of one class, with offsets: ids, start, run.

    A text is first cut every ``RUN_STEP`` code points, moved on to the end of the run, so that no run is
    cut; a long text becomes many short rows without leaving its task.
    """
    member = "".join(f"[{c}]" for c in classes)
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{RUN_STEP}}}[{member}]*+"), F.lit(0))
    run = "|".join(f"(?<![{c}])[{c}]++" for c in classes)
    pieces = df.select(*ids, cut.alias("_cut")).select(
        *ids, F.explode(F.arrays_zip(_starts(F.col("_cut")).alias("base"), F.col("_cut").alias("piece"))).alias("_p")
    )
    found = F.regexp_extract_all(F.col("_p.piece"), F.lit(f"(?s)(?=({run})?)."), F.lit(1))
    rows = pieces.select(*ids, F.col("_p.base").alias("_base"), F.posexplode(found).alias("_at", "run"))
    return rows.where(F.col("run") != "").select(*ids, (F.col("_base") + F.col("_at")).alias("start"), "run")


def word_spans(df: DataFrame, ids: Sequence[str], text: Column) -> DataFrame:
    """Latin tokens with their offsets in the text: ids, start, end, term."""
    rows = runs(df, ids, F.lower(text), [T.ALPHABET])
    return rows.select(*ids, "start", (F.col("start") + F.length("run")).alias("end"), F.col("run").alias("term"))


def find_all(
    df: DataFrame,
    ids: Sequence[str],
    text: Column,
    dictionary: DataFrame,
    context: int = 0,
    at_word_start: bool = False,
) -> DataFrame:
    """Every dictionary word at every position, overlaps included: ids, start, n, word, other dictionary columns.

    A dictionary that tasks can hold is compiled to automata, which find its words in one pass over each text, and one of some
    times that size to several groups of them, each with a pass of its own. Of a larger one each position is looked up by the first characters only (once per length of ``tokens.HEADS`` that the
    dictionary needs) and compared whole on a hit, so the work does not grow with the longest word.
    ``context`` adds a column of that many characters before and after the word; missing ones on the
    left are ``PAD``. ``at_word_start`` passes over positions inside a Latin word, and needs a context.
    """
    dictionary = dictionary.where(F.length("word") > 0)
    passes = automaton.compiled_passes(dictionary)
    if passes is not None:
        # Which places are inside a word is decided below, as on the other path; the automaton leaves out the plainest ones.
        around_word = max(context, 1) if at_word_start else context
        found = reduce(DataFrame.unionByName, [automaton.find_all(df, ids, text, own, around_word, not at_word_start, PAD) for own in passes])
        if at_word_start:
            found = found.where(~F.substring("context", around_word, 2).rlike(INSIDE_WORD))
        extra = [c for c in dictionary.columns if c != "word"]
        if extra:
            found = attach(found, dictionary, ["word"], "inner", [*ids, "start"])
        return found.select(*ids, "start", "n", "word", *extra, *(["context"] if context else []))
    shape = dictionary_shape(dictionary)
    if not shape.longest:
        shape = DictionaryShape(1, (1,), True)
    step = max(STEP, shape.longest)
    reach = shape.longest + 2 * context
    in_window = reach <= WINDOW
    width = reach if in_window else context + max(shape.head_lengths)
    padded = F.concat(F.lit(PAD * context), text) if context else text
    pieces = df.select(*ids, F.posexplode(T.chunks(padded, step, reach - 1)).alias("_no", "_piece"))
    # The last positions of a piece, and of a padded text, hold no start of a word.
    starts = F.least(F.lit(step), F.length("_piece") - context)
    found = F.slice(T.windows(F.col("_piece"), width), F.lit(1), F.greatest(starts, F.lit(0)))
    at = pieces.select(*ids, "_no", "_piece", F.posexplode(found).alias("_at", "_window"))
    if at_word_start:
        at = at.where(~F.substring("_window", context, 2).rlike(INSIDE_WORD))
    heads = [F.substring("_window", context + 1, k) for k in shape.head_lengths]
    if len(heads) > 1:
        at = at.select("*", F.posexplode(F.array(*heads)).alias("_tier", "_head"))
    else:
        at = at.select("*", F.lit(0).alias("_tier"), heads[0].alias("_head"))
    around = F.col("_window") if in_window else F.substring("_piece", F.col("_at") + 1, reach)

    n = _head_length(F.col("word"))
    tier = F.array_position(F.array(*[F.lit(k) for k in shape.head_lengths]), n) - 1
    words = dictionary.select(
        "*", F.length("word").alias("_n"), tier.cast("int").alias("_tier"), F.substring(F.col("word"), F.lit(1), n).alias("_head")
    )
    if shape.broadcast:
        # The window stays a column of the position, so that nothing is cut out again for each word compared.
        joined = at.alias("t").join(
            F.broadcast(words.alias("d")),
            (F.col("t._tier") == F.col("d._tier"))
            & (F.col("t._head") == F.col("d._head"))
            & (F.substring(around, F.lit(context + 1), F.col("d._n")) == F.col("d.word")),
        )
    else:
        narrow = at.select(*ids, "_no", "_at", "_tier", "_head", around.alias("_window"))
        around = F.col("_window")
        narrow = narrow.withColumn("_key", F.xxhash64(*ids, "_no", "_at"))
        matched = attach(narrow, words, ["_tier", "_head"], "inner", ["_key"], broadcast=False)
        joined = matched.where(F.substring("_window", F.lit(context + 1), F.col("_n")) == F.col("word"))
    start = (F.col("_no") * step + F.col("_at")).cast("bigint")
    extra = [c for c in dictionary.columns if c != "word"]
    columns = [*ids, start.alias("start"), F.col("_n").alias("n"), "word", *extra]
    if context:
        columns.append(F.substring(around, F.lit(1), F.col("_n") + 2 * context).alias("context"))
    return joined.select(*columns)


def _leftmost(found: Column) -> Column:
    """Left to right, the longest word that starts at or after the end of the one before: start, n."""
    by_start = F.transform(found, lambda w: F.struct(w["start"].alias("start"), (-w["n"]).alias("minus_n")))

    def chosen(words: Column) -> Column:
        taken = T.left_to_right(words, lambda w, _: (w["start"] - w["minus_n"]).cast("int"), lambda w, _: w["start"])

        def word(i: Column) -> Column:
            return F.struct(F.get(words, i)["start"].alias("start"), (-F.get(words, i)["minus_n"]).alias("n"))

        return F.transform(taken, word)

    return T.bind(F.array_sort(by_start), chosen)


def segment_greedy(
    df: DataFrame, ids: Sequence[str], text: Column, dictionary: DataFrame, latin_runs: bool = True
) -> DataFrame:
    """Non-overlapping tokens from left to right, the longest dictionary word first: ids, start, end, term, known.

    Characters that no word covers are tokens of their own. With ``latin_runs`` a run of Latin letters
    and digits is always one token, and only the other letters are segmented; without it all letters
    and digits are, as in a text whose blanks were removed.
    """
    pieces = runs(df, ids, F.lower(text), T.run_classes(latin_runs))
    whole = None
    if latin_runs:
        latin = pieces.where(T.is_latin(F.col("run")))
        known = dictionary.select(F.col("word").alias("term"), F.lit(True).alias("known")).distinct()
        whole = attach(
            latin.select(*ids, "start", (F.col("start") + F.length("run")).alias("end"), F.col("run").alias("term")),
            known, ["term"], "left", [*ids, "start"],
        ).select(*ids, "start", "end", "term", F.coalesce("known", F.lit(False)).alias("known"))
        pieces = pieces.where(~T.is_latin(F.col("run")))

    words = inline_words(dictionary)
    automata = automaton.compiled(dictionary) if words is None else None
    if words is not None:
        segmented = _inline_greedy(pieces, ids, words)
    elif automata is not None:
        segmented = automaton.segment_runs(pieces, ids, automata)
    else:
        segmented = _joined_greedy(pieces, ids, dictionary)
    return segmented if whole is None else whole.unionByName(segmented)


def greedy_terms(text: Column, words: Sequence[str], latin_runs: bool = True) -> Column:
    """The tokens of ``segment_greedy`` by a few words, as an array in text order: term, known. No row is exploded."""

    return F.transform(T.segmented(text, words, latin_runs), lambda t: F.struct(t.alias("term"), T.is_one_of(t, words).alias("known")))


def _inline_greedy(pieces: DataFrame, ids: Sequence[str], words: Sequence[str]) -> DataFrame:
    """Each run is segmented where it is read: no shuffle."""
    cut = pieces.select(*ids, F.col("start").alias("_run_start"), T.greedy(F.col("run"), words).alias("_ts"))
    placed = F.arrays_zip(T.starts(F.col("_ts.term")).alias("start"), F.col("_ts.term").alias("term"), F.col("_ts.known").alias("known"))
    tokens = cut.select(*ids, "_run_start", F.explode(placed).alias("_t"))
    start, term = F.col("_run_start") + F.col("_t.start"), F.col("_t.term")
    return tokens.select(
        *ids, start.alias("start"), (start + F.length(term)).alias("end"), term.alias("term"), F.col("_t.known").alias("known")
    )


def _joined_greedy(pieces: DataFrame, ids: Sequence[str], dictionary: DataFrame) -> DataFrame:
    """For any dictionary: the words found in each run are collected by run, then chosen from left to right."""
    placed = pieces.withColumnRenamed("start", "_run_start")
    found = find_all(placed, [*ids, "_run_start"], F.col("run"), dictionary.select("word"))
    places = found.select(*ids, "_run_start", F.lit(None).cast("string").alias("run"), F.struct("start", "n").alias("_at"))
    every = places.unionByName(placed, allowMissingColumns=True)
    per_run = every.groupBy(*ids, "_run_start").agg(F.max("run").alias("run"), F.collect_list("_at").alias("_found"))
    chars = F.regexp_extract_all(F.col("run"), F.lit("(?s)."), F.lit(0))
    chosen = per_run.select(*ids, "_run_start", chars.alias("_chars"), _leftmost(F.col("_found")).alias("_w"))
    tokens = chosen.select(*ids, "_run_start", F.explode(_fill(F.col("_w"), F.col("_chars"))).alias("_t"))
    start = (F.col("_run_start") + F.col("_t.start")).cast("int")
    return tokens.select(
        *ids, start.alias("start"), (start + F.col("_t.n")).alias("end"),
        F.col("_t.term").alias("term"), F.col("_t.known").alias("known"),
    )


def _fill(chosen: Column, chars: Column) -> Column:
    """The chosen words with single characters for what lies between them."""
    tokens = "array<struct<start:bigint,n:int,term:string,known:boolean>>"

    def singles(begin: Column, end: Column) -> Column:
        def single(p: Column) -> Column:
            at = F.get(chars, p.cast("int"))
            return F.struct(p.alias("start"), F.lit(1).alias("n"), at.alias("term"), F.lit(False).alias("known"))

        empty = F.array().cast(tokens)
        return F.when(end > begin, F.transform(F.sequence(begin, end - 1), single)).otherwise(empty)

    def with_gap(w: Column, i: Column) -> Column:
        before = F.get(chosen, i - 1)
        begin = F.when(i == 0, F.lit(0).cast("bigint")).otherwise(before["start"] + before["n"])
        term = F.array_join(F.slice(chars, (w["start"] + 1).cast("int"), w["n"]), "")
        here = F.struct(w["start"].alias("start"), w["n"].alias("n"), term.alias("term"), F.lit(True).alias("known"))
        return F.concat(singles(begin, w["start"]), F.array(here))

    last = F.get(chosen, F.size(chosen) - 1)
    tail = F.coalesce(last["start"] + last["n"], F.lit(0).cast("bigint"))
    return F.concat(F.flatten(F.transform(chosen, with_gap)), singles(tail, F.size(chars).cast("bigint")))
