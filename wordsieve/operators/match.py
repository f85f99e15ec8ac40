"""Meeting texts with a lexicon: verdicts, hits, first and widened hits, counts, routes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordsieve.functions import tokens as T
from wordsieve.functions.text import clean_text, removes_blanks
from wordsieve.operators import automaton
from wordsieve.operators.joins import attach, fits_broadcast, inline_words
from wordsieve.operators.lexicon import matchable
from wordsieve.operators.segment import INSIDE_WORD, PAD, find_all, segment_greedy, word_rows
from wordsieve.session import stored

Judge = Callable[[DataFrame, Column], DataFrame]

# Up to this many words are sought in a text one by one; more are looked up position by position.
SOUGHT_WORDS = 64


def lookup(terms: DataFrame, lexicon: DataFrame, term: str = "term") -> DataFrame:
    """Exact lookup: the id of the word equal to each term, else null."""
    found = lexicon.select(F.col("word").alias(term), "word_id")
    return attach(terms, found, [term], "left", terms.columns)


def phrase_search(lexicon: DataFrame, phrase: str) -> DataFrame:
    """Lexicon entries that contain a phrase."""
    return lexicon.where(F.contains("word", F.lit(phrase))).select("word", "word_id")


def phrase_search_many(queries: DataFrame, lexicon: DataFrame) -> DataFrame:
    """For many phrases at once: query, word, word_id.

    Entries are listed under their substrings, so this is an equality join. Only lengths that
    some query has are listed.
    """
    asked = queries.select("query").distinct()
    asked_lengths = asked.select(F.length("query").alias("n")).distinct().collect()
    lengths = F.array(*[F.lit(n) for n in sorted(r.n for r in asked_lengths if r.n)]).cast("array<int>")
    size = F.length("word")
    parts = F.flatten(
        F.transform(
            F.filter(lengths, lambda n: n <= size),
            lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda at: F.col("word").substr(at, n)),
        )
    )
    listed = lexicon.select("word", "word_id", F.explode(F.array_distinct(parts)).alias("query"))
    return attach(listed, asked, ["query"], "inner", ["word"]).select("query", "word", "word_id")


def entries(lexicon: DataFrame, profile: str | None) -> DataFrame:
    """The lexicon as texts can hold it: word, cleaned like the texts and in lower case."""
    return matchable(lexicon, profile).select("word")


def phrases(lexicon: DataFrame, profile: str | None) -> DataFrame:
    """Entries as tokens joined by blanks, and their number: word, n. A phrase is met by as many neighbouring tokens."""
    tokens = entries(lexicon, profile).select(T.words(F.col("word")).alias("_t"))
    return tokens.where(F.size("_t") > 0).select(F.array_join("_t", " ").alias("word"), F.size("_t").alias("n")).distinct()


def verdict(text: Column, words: Sequence[str], mode: str = "words", dictionary: Sequence[str] = ()) -> Column:
    """Whether a text holds one of a few words; null for a null text.

    ``words`` compares runs of letters, and phrases with neighbouring ones; ``segmented`` besides cuts scripts without
    blanks by the words and the dictionary, so that a longer harmless word covers a listed one; ``anywhere`` takes any
    stretch of the text. Phrases are joined by one blank, as ``phrases`` gives them. Of few words each is sought in the
    text first, and only texts that hold its letters are cut into tokens.
    """
    if mode != "anywhere" and 0 < len(words) <= SOUGHT_WORDS:
        parts = sorted({w.split(" ")[0] for w in words})
        may_hold = T.bind(F.lower(text), lambda t: reduce(or_, [F.contains(t, F.lit(w)) for w in parts]))
        return F.when(text.isNotNull(), F.when(may_hold, _holds_tokens(text, words, mode, dictionary)).otherwise(F.lit(False)))
    if mode != "anywhere":
        return _holds_tokens(text, words, mode, dictionary)
    if not words:
        return F.when(text.isNotNull(), F.lit(False))
    lowered = F.lower(text)
    if len(words) <= SOUGHT_WORDS:
        return T.bind(lowered, lambda t: reduce(or_, [F.contains(t, F.lit(w)) for w in words]))
    return lowered.rlike(T.alternation(words))


def _holds_tokens(text: Column, words: Sequence[str], mode: str, dictionary: Sequence[str]) -> Column:
    by_size: dict[int, list[str]] = {}
    for w in words:
        by_size.setdefault(w.count(" ") + 1, []).append(w)

    def holds(n: int) -> Column:
        return F.exists(T.ngrams(T.words(text), n), lambda t: T.is_one_of(t, by_size[n]))

    held = [holds(n) for n in sorted(by_size) if n > 1 or mode == "words"]
    if mode == "segmented":
        single = by_size.get(1, [])
        held.append(F.exists(T.segmented(text, sorted({*dictionary, *single})), lambda t: T.is_one_of(t, single)))
    return reduce(or_, held) if held else F.when(text.isNotNull(), F.lit(False))


def flag_messages(
    df: DataFrame,
    text: Column,
    lexicon: DataFrame,
    profile: str | None = "train",
    mode: str = "segmented",
    dictionary: DataFrame | None = None,
) -> DataFrame:
    """``df`` with ``is_sensitive``: true when a lexicon entry occurs in the cleaned text.

    The verdict hangs on the text alone: rows need no key, and may repeat. A small lexicon becomes a predicate, a larger one
    automata that every task holds; either way messages are marked where they are read, without a shuffle. Of one that is too
    large for that the entries are picked that the texts hold, so that the texts are read twice. If these are still too many, they
    are joined to the tokens (broadcast or salted, by their size), reduced to the numbers of the texts that have a hit, and
    these are joined back. Whole words can't be met in a text whose blanks the profile removes, so that
    pair is refused.
    """
    return prepared(lexicon, profile, mode, dictionary)(df, text)


def prepared(lexicon: DataFrame, profile: str | None = "train", mode: str = "segmented", dictionary: DataFrame | None = None) -> Judge:
    """``flag_messages`` for one lexicon, which is read, measured and compiled once: a function of a frame and its text."""
    if mode == "words" and removes_blanks(profile):
        raise ValueError(f"profile {profile!r} removes the blanks that mode 'words' needs; use mode 'segmented' or 'anywhere'")
    listed = entries(lexicon, profile) if mode == "anywhere" else phrases(lexicon, profile)
    words = inline_words(listed)
    others = [] if dictionary is None else inline_words(dictionary.select(F.lower("word").alias("word")))
    if words is not None and others is not None:
        return lambda df, text: df.withColumn("is_sensitive", verdict(clean_text(text, profile), words, mode, others))
    listed = stored(listed, "entries")
    if mode == "anywhere":
        automata = automaton.compiled(listed)
        if automata is not None:
            return lambda df, text: df.withColumn("is_sensitive", automaton.holds_anywhere(F.lower(clean_text(text, profile)), automata))
    else:
        compiled = _compiled(listed, profile, mode, dictionary)
        if compiled is not None:
            return compiled
    return lambda df, text: _joined_verdict(df, text, listed, profile, mode, dictionary)


def _joined_verdict(df: DataFrame, text: Column, listed: DataFrame, profile: str | None, mode: str, dictionary: DataFrame | None) -> DataFrame:
    body = F.col("_cleaned")
    rows = _numbered(df, text, clean_text(text, profile))
    if mode == "anywhere":
        return _with_hits(df, text, find_all(rows, NUMBER, F.lower(body), listed).select(*NUMBER))
    sizes = [r.n for r in listed.select("n").distinct().collect()]
    if mode == "segmented":
        sizes = [n for n in sizes if n > 1]
    grams = F.flatten(F.array(*[T.ngrams(T.words(body), n) for n in sizes])) if sizes else F.array().cast("array<string>")
    terms = rows.select(*NUMBER, F.posexplode(grams).alias("_pos", "word"))
    hits = attach(terms, listed.select("word"), ["word"], "left_semi", [*NUMBER, "_pos"]).select(*NUMBER)
    if mode == "segmented":
        single = listed.where("n = 1").select("word")
        every = single if dictionary is None else single.unionByName(dictionary.select(F.lower("word").alias("word"))).distinct()
        tokens = segment_greedy(rows, NUMBER, body, every, True).select(*NUMBER, "start", F.col("term").alias("word"))
        hits = hits.unionByName(attach(tokens, single, ["word"], "left_semi", [*NUMBER, "start"]).select(*NUMBER))
    return _with_hits(df, text, hits)


def _compiled(listed: DataFrame, profile: str | None, mode: str, dictionary: DataFrame | None) -> Judge | None:
    """A verdict on tokens by a table of the entries; and if an entry is of a script without blanks, by automata that cut such scripts.

    Where the entries are more than the driver should gather, the table is of those that the judged texts hold.
    """
    own, cut, other = frozenset(), [], listed.where(F.lit(False))
    if mode == "segmented":
        spaceless = F.col("word").rlike(f"^[{T.OTHER}]+$") & (F.col("n") == 1)
        other, listed = listed.where(spaceless), listed.where(~spaceless)
        few = other.limit(automaton.SPACELESS_ENTRIES + 1).select("word").toArrow().column("word").to_pylist()
        if len(few) > automaton.SPACELESS_ENTRIES:
            return None
        own = frozenset(automaton.spaceless(few))
    if own:
        every = other.select("word")
        if dictionary is not None:
            every = every.unionByName(dictionary.select(F.lower("word").alias("word")).where(F.col("word").rlike(f"^[{T.OTHER}]+$")))
        cut = automaton.compiled(every)
    if cut is None:
        return None
    table = automaton.hashed(listed)
    sizes = [r.n for r in listed.select("n").distinct().collect()]

    def judge(df: DataFrame, text: Column) -> DataFrame:
        tokens, known = T.words(clean_text(text, profile)), table
        if known is None:
            held = automaton.held_words(tokens, sizes, df, listed)
            known = automaton.hashed(held)
            if known is None:
                return _joined_verdict(df, text, held.unionByName(other), profile, mode, dictionary)
        # Generated, as a function in Python takes no argument that is computed by a lambda.
        rows = df.select("*", F.explode(F.array(automaton.gram_numbers(tokens, sizes))).alias("_numbers"))
        told = automaton.holds_words(F.col("_numbers"), F.array_join(tokens, " "), known, cut, own)
        return rows.withColumn("is_sensitive", told).drop("_numbers")

    return judge


# A text as two numbers, which stand for it in joins.
NUMBER = ["_a", "_b"]


def _number(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("_a"), F.xxhash64(F.lit(1), text).alias("_b")]


def _numbered(df: DataFrame, text: Column, cleaned: Column) -> DataFrame:
    """Texts that are not null by their numbers: _a, _b, _cleaned."""
    return df.where(text.isNotNull()).select(*_number(text), cleaned.alias("_cleaned"))


def flag_segmented(
    df: DataFrame,
    ids: Sequence[str],
    text: Column,
    lexicon: DataFrame,
    dictionary: DataFrame,
    profile: str | None = "filter",
    latin_runs: bool = True,
) -> DataFrame:
    """Verdict over segmented tokens, where a longer harmless word can cover a listed one: ids, is_sensitive.

    Without ``latin_runs`` words of alphabets are segmented too, as in a text whose blanks were removed.
    """
    cleaned = clean_text(text, profile)
    every = dictionary.select("word").unionByName(lexicon.select("word")).distinct()
    words = inline_words(every)
    if words is not None:
        listed = inline_words(lexicon)
        tokens = T.segmented(cleaned, words, latin_runs)
        return df.select(*ids, F.exists(tokens, lambda t: T.is_one_of(t, listed)).alias("is_sensitive"))
    rows = _numbered(df, text, cleaned)
    terms = segment_greedy(rows, NUMBER, F.col("_cleaned"), every, latin_runs)
    listed = lexicon.select(F.col("word").alias("term")).distinct()
    hits = attach(terms.where("known"), listed, ["term"], "left_semi", [*NUMBER, "start"])
    return _with_hits(df, text, hits).select(*ids, "is_sensitive")


def _with_hits(df: DataFrame, text: Column, hits: DataFrame) -> DataFrame:
    """Mark the rows whose text has a hit, told by its numbers; a row without a text has no verdict.

    The numbers of texts with a hit are written once. Where they are measured to be few they are broadcast; else the rows
    are joined by them with the rows of one text dealt over several tasks, those without a text over all.
    """
    flagged = stored(hits.select(*NUMBER).distinct().withColumn("_hit", F.lit(True)), "hits")
    a, b = _number(text)
    spread = F.monotonically_increasing_id()
    rows = df.withColumns({"_a": F.when(text.isNotNull(), a).otherwise(spread), "_b": b, "_none": text.isNull()})
    if fits_broadcast(flagged):
        joined = rows.join(F.broadcast(flagged), NUMBER, "left")
    else:
        joined = attach(rows.withColumn("_spread", spread), flagged, NUMBER, "left", ["_spread"], False).drop("_spread")
    found = F.when(~F.col("_none"), F.coalesce("_hit", F.lit(False)))
    return joined.withColumn("is_sensitive", found).drop("_hit", "_none", *NUMBER)


def word_hits(
    df: DataFrame, ids: Sequence[str], text: Column, lexicon: DataFrame, profile: str | None = "train"
) -> DataFrame:
    """Tokens that are in the lexicon, with position and category: ids, pos, word, category."""
    terms = word_rows(df, ids, clean_text(text, profile)).withColumnRenamed("term", "word")
    listed = lexicon.select("word", "category")
    return attach(terms, listed, ["word"], "inner", [*ids, "pos"]).select(*ids, "pos", "word", "category")


def phrase_hits(
    df: DataFrame, ids: Sequence[str], text: Column, lexicon: DataFrame, profile: str | None = "train"
) -> DataFrame:
    """Lexicon entries of any kind with offsets: ids, start, end, word, category.

    Entries may hold blanks or no Latin letter at all. Where an entry begins or ends with a Latin
    letter or digit, the text must not go on with another one.
    """
    lowered = F.lower(clean_text(text, profile))
    found = find_all(df, ids, lowered, lexicon.select("word", "category"), context=1, at_word_start=True)
    goes_on = F.col("context").substr(F.col("n") + 1, F.lit(2)).rlike(INSIDE_WORD)
    return found.where(~goes_on).select(
        *ids, "start", (F.col("start") + F.col("n")).alias("end"), "word", "category"
    )


def first_match(
    df: DataFrame, ids: Sequence[str], text: Column, lexicon: DataFrame, profile: str | None = "train"
) -> DataFrame:
    """The first listed token of each message that has one: ids, pos, word."""
    hits = word_hits(df, ids, text, lexicon, profile)
    first = hits.groupBy(*ids).agg(F.min(F.struct("pos", "word")).alias("_first"))
    return first.select(*ids, F.col("_first.pos").alias("pos"), F.col("_first.word").alias("word"))


def widened_match(
    df: DataFrame,
    ids: Sequence[str],
    text: Column,
    lexicon: DataFrame,
    dictionary: DataFrame,
    profile: str | None = "filter",
) -> DataFrame:
    """The first token in the lexicon, widened where the lexicon has a longer entry around it: ids, word, widened.

    Tokens come from segmenting the text, all letters as one run, by the dictionary, so that a longer harmless word
    covers a listed one. Tried in this order: the same start, then one and two characters earlier, each with
    one and then two characters more at the end, clamped to the text.
    """
    listed = lexicon.select("word").distinct()
    cleaned = F.lower(clean_text(text, profile))
    words, known = inline_words(dictionary), inline_words(listed)
    if words is not None and known is not None:
        # The characters between the runs are tokens as well, so that places in the text are sums of lengths.
        pattern = f"(?s){T.alternation(words)}|." if words else "(?s)."
        first = df.select(*ids, cleaned.alias("_text")).withColumn("_terms", F.regexp_extract_all("_text", F.lit(pattern), F.lit(0)))
        first = first.withColumn("_at", F.array_position(F.transform("_terms", lambda t: T.is_one_of(t, known)), True)).where("_at > 0")
        before = F.array_join(F.slice("_terms", 1, (F.col("_at") - 1).cast("int")), "")
        hits = first.select(*ids, "_text", F.length(before).cast("bigint").alias("start"), F.get("_terms", F.col("_at").cast("int") - 1).alias("word"))
        return widen(_with_context(hits), ids, listed)
    automata, own = automaton.compiled(dictionary), automaton.compiled(listed)
    if automata is not None and own is not None:
        told = df.select(*ids, cleaned.alias("_text")).withColumn("_first", automaton.first_listed(F.col("_text"), automata, own))
        hits = told.where(F.col("_first.start").isNotNull()).select(*ids, "_text", "_first.start", "_first.word")
        # Written, so that the texts are cut once however often the hits are read.
        return widen(stored(_with_context(hits), "first-hits"), ids, listed)
    tokens = segment_greedy(df, ids, cleaned, dictionary, False)
    found = attach(tokens.where("known").select(*ids, "start", F.col("term").alias("word")), listed, ["word"], "left_semi", [*ids, "start"])
    first = found.groupBy(*ids).agg(F.min(F.struct("start", "word")).alias("_f")).select(*ids, "_f.start", "_f.word")
    texts = df.select(*ids, F.concat(F.lit(PAD * 2), cleaned).alias("_text"))
    placed = first.join(texts, list(ids)).withColumn("n", F.length("word"))
    around = F.substring("_text", (F.col("start") + 1).cast("int"), F.col("n") + 4)
    return widen(placed.withColumn("context", around).drop("_text"), ids, listed)


def _with_context(hits: DataFrame) -> DataFrame:
    """Hits with the length of the word and the text around it in place of the whole text."""
    around = F.substring(F.concat(F.lit(PAD * 2), F.col("_text")), (F.col("start") + 1).cast("int"), F.length("word") + 4)
    return hits.withColumn("n", F.length("word")).withColumn("context", around).drop("_text")


def widen(first: DataFrame, ids: Sequence[str], lexicon: DataFrame) -> DataFrame:
    """Replace each hit by the first widening of it that the lexicon holds."""

    def candidate(rank: int, left: int, right: int) -> Column:
        back = F.least(F.lit(left), F.col("start")).cast("int")
        text = F.col("context").substr(F.lit(3) - back, F.col("n") + back + right)
        return F.struct(F.lit(rank).alias("rank"), text.alias("word"))

    # How far to the left and to the right, in the order of the attempts.
    tries = [(left, right) for left in (0, 1, 2) for right in (1, 2)]
    wider = F.array(*[candidate(i, left, right) for i, (left, right) in enumerate(tries)])
    attempts = first.select(*ids, F.col("word").alias("hit"), F.explode(wider).alias("_c"))
    attempts = attempts.select(*ids, "hit", F.col("_c.rank").alias("rank"), F.col("_c.word").alias("word"))
    listed = lexicon.select("word", F.lit(True).alias("listed"))
    checked = attach(attempts, listed, ["word"], "left", ids)
    best = checked.groupBy(*ids).agg(
        F.first("hit").alias("word"), F.min(F.when(F.col("listed"), F.struct("rank", "word"))).alias("_best")
    )
    return best.select(*ids, "word", F.coalesce("_best.word", "word").alias("widened"))


def match_counts(hits: DataFrame, ids: Sequence[str]) -> DataFrame:
    """How often each message holds each word: ids, word, category, n."""
    return hits.groupBy(*ids, "word", "category").agg(F.count(F.lit(1)).alias("n"))


def category_counts(hits: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Hits and messages per category, reduced per message before the distinct count."""
    per_message = hits.groupBy("category", *ids).agg(F.count(F.lit(1)).alias("_n"))
    return per_message.groupBy("category").agg(F.sum("_n").alias("hits"), F.count(F.lit(1)).alias("messages"))
