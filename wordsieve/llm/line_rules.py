"""Quality rules: words, symbols and repetition of a text, and lines that many documents of a host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordsieve.llm.common import WORD, quoted, without
from wordsieve.session import stored

SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
REPEATED_PERCENT = 20

# A line is boilerplate where more documents of one host than this hold it.
DOCS_PER_LINE = 10
# A document is depleted when less than this share of its words remains.
LEFT_PERCENT = 30

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
VERDICTS = ["base_failed", "n_removed_words", "kept"]


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def line_key(line: Column, host: Column) -> Column:
    """One number for a normalised line of a host: lower case, runs of white space and of digits made one."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(line), r"[\x09-\x0D ]+", " "), r"[0-9]+", "0")
    return F.xxhash64(host, F.trim(plain))


def with_repeats(df: DataFrame) -> DataFrame:
    """``n_repeat_words`` from ``_words``: words inside windows of ``WINDOW`` words found twice or more in the text.

    Windows are compared by 64-bit hashes inside the row. Texts without a repeated window, most of them, are told
    by the number of distinct windows; only the others sort theirs. Each step is a projection of its own, as its
    result is used several times.
    """
    at = lambda hashes, i: F.xxhash64(*[F.element_at(hashes, (i + k).cast("int")) for k in range(WINDOW)])
    ordered = F.col("_sorted")
    neighbour = lambda k: F.get(ordered, k)["h"]
    repeated = F.filter(
        F.transform(ordered, lambda x, k: F.when((x["h"] == neighbour(k - 1)) | (x["h"] == neighbour(k + 1)), x["i"])),
        lambda i: i.isNotNull(),
    )
    return (
        df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
        .withColumn("_starts", F.when(F.size("_hashes") >= WINDOW, F.sequence(F.lit(1), F.size("_hashes") - (WINDOW - 1))))
        .withColumn("_windows", F.transform("_starts", lambda i: at(F.col("_hashes"), i)))
        .withColumn("_some", F.coalesce(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.lit(False)))
        .withColumn("_sorted", F.when(F.col("_some"), F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
        .withColumn("_repeated", F.sort_array(repeated))
        .withColumn(
            "n_repeat_words",
            F.coalesce(
                F.aggregate(
                    "_repeated",
                    F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
                    lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")),
                    lambda a: a["n"],
                ),
                F.lit(0),
            ).cast("long"),
        )
        .drop("_hashes", "_starts", "_windows", "_some", "_sorted", "_repeated")
    )


def rules(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    docs_per_line: int = DOCS_PER_LINE,
    left_percent: int = LEFT_PERCENT,
    keep_text: bool = False,
) -> DataFrame:
    """The other columns of ``docs`` with the features of each text and the verdicts.

    A line that more than ``docs_per_line`` rows of its host hold is removed. ``kept`` is false for a text that fails the
    base rules and for one of which less than ``left_percent`` of the words remain. With ``keep_text`` the
    text stays and ``clean_text`` is the text without the removed lines.

    Features and line hashes are computed once and written, with a number for each row; rows that repeat an id
    are judged apart. Lines are counted by an aggregate that combines before its shuffle; the frequent ones are
    joined back by hash, a join whose hot keys adaptive execution splits. Null and empty texts have no words
    and fail the base rules; null hosts are one host; an empty table gives an empty result.
    """
    body, owner = quoted(text), quoted(host)
    added = [*FEATURES, *VERDICTS, *(["clean_text"] if keep_text else [])]
    kept = without(docs, *added, *([] if keep_text else [text]))
    lines = F.coalesce(lines_with_words(body), F.array().cast("array<string>"))
    inside = F.length(body) - F.length(F.translate(body, SYMBOLS, ""))
    base = docs.select(
        *[quoted(c) for c in kept],
        F.coalesce(F.regexp_extract_all(body, F.lit(WORD), F.lit(0)), F.array().cast("array<string>")).alias("_words"),
        F.coalesce(inside, F.lit(0)).cast("long").alias("n_symbols"),
        lines.alias("_texts"),
        owner.alias("_host"),
    )
    counted = (
        base.withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.concat_ws("", "_words")).cast("long"))
        .withColumn("n_dup_lines", (F.size("_texts") - F.size(F.array_distinct("_texts"))).cast("long"))
        .withColumn(
            "_lines",
            F.transform("_texts", lambda x: F.struct(line_key(x, F.col("_host")).alias("key"), F.regexp_count(x, F.lit(WORD)).alias("words"))),
        )
    )
    features = stored(
        with_repeats(counted)
        .withColumn("_row", F.monotonically_increasing_id())
        .select("_row", *[quoted(c) for c in kept], *FEATURES, "_lines"),
        "line-rules",
    )
    in_docs = features.select(F.explode(F.array_distinct(F.col("_lines.key"))).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("docs"))
    frequent = stored(in_docs.where(F.col("docs") > docs_per_line).select("key"), "line-rules-frequent")
    hits = features.select("_row", F.explode("_lines").alias("line")).select("_row", "line.key", "line.words").join(frequent, "key")
    removed = hits.groupBy("_row").agg(
        F.sum("words").alias("_removed"), *([F.collect_set("key").alias("_keys")] if keep_text else [])
    )
    n = F.col("n_words")
    failed = (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * n)
    gone = F.coalesce(F.col("_removed"), F.lit(0)).cast("long")
    judged = (
        features.join(removed, "_row", "left")
        .withColumn("base_failed", failed)
        .withColumn("n_removed_words", gone)
        .withColumn("kept", ~F.col("base_failed") & (100 * (n - gone) >= left_percent * n))
    )
    if keep_text:
        drop = F.coalesce(F.col("_keys"), F.array().cast("array<bigint>"))
        rest = F.filter(F.split(body, "\n"), lambda x: ~F.array_contains(drop, line_key(x, owner)))
        judged = judged.withColumn("clean_text", F.array_join(rest, "\n"))
    return judged.select(*[quoted(c) for c in kept], *added)
