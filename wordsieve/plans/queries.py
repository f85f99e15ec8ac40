"""The operators as queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordsieve.fixtures import insult_lexicon
from wordsieve.functions import messages as J
from wordsieve.functions import tokens as T
from wordsieve.functions.text import clean_text
from wordsieve.operators import classify, evaluate, features, grams, lexicon, match, models, segment, snapshots, trainset
from wordsieve.operators.joins import inline_words
from wordsieve.session import scratch_dir, stored
from wordsieve.sources import messages as queue
from wordsieve.sources import wordfiles
from wordsieve.sources.spool import use_spool
from wordsieve.sources.tables import read_table, stream_table
from wordsieve.streaming import discovery, flagging, frequencies, novelty, outbox

Query = Callable[[SparkSession, str], DataFrame]

DOC = ["doc_id"]
TURN = ["conv_id", "turn"]
PATH = ("data", "text")
DOC_BUCKETS = 4096

# Readers of a spool; a batch costs seconds however few messages it has, so they are more than cores.
READERS_PER_CORE = 4


# --- inputs -----------------------------------------------------------------------------------


def documents(spark: SparkSession, base: str, *more: str) -> DataFrame:
    return read_table(spark, base, "documents", ["doc_id", "text", *more], True)


def conversations(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "conversations", ["conv_id", "turn", "text"], True)


def pages(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "pages", ["page_id", "html"], True)


def conversation_words(spark: SparkSession, base: str) -> DataFrame:
    return trainset.corpus_words(conversations(spark, base), TURN, F.col("text"), None, 0)


def document_words(spark: SparkSession, base: str) -> DataFrame:
    return trainset.corpus_words(documents(spark, base), DOC, F.col("text"))


def benchmark_lexicon(spark: SparkSession, base: str, min_length: int = 0) -> DataFrame:
    items = read_table(spark, base, "benchmark", ["item_id", "text"])
    words = trainset.corpus_words(items, ["item_id"], F.col("text"), None, min_length)
    return lexicon.as_lexicon(words, "benchmark", "table")


def word_lexicon(spark: SparkSession, vocabulary: DataFrame) -> DataFrame:
    """Words whose md5 begins with 0 to 3, and the insults: enough positives to learn from."""
    chosen = vocabulary.where(F.substring(F.md5("word"), 1, 1).between("0", "3"))
    return chosen.unionByName(insult_lexicon(spark).select("word")).distinct()


def labelled_words(spark: SparkSession, base: str) -> DataFrame:
    vocabulary = trainset.vocabulary(document_words(spark, base))
    return trainset.label_words(word_lexicon(spark, vocabulary), vocabulary)


def labelled_documents(spark: SparkSession, base: str) -> DataFrame:
    labels = read_table(spark, base, "labels", ["doc_id", "toxic"])
    joined = documents(spark, base).join(labels, "doc_id")
    terms = T.words(clean_text(F.col("text"), "train")).alias("word")
    rows = joined.select("doc_id", terms, F.col("toxic").cast("double").alias("label"))
    return stored(trainset.hash_split(rows, F.col("doc_id").cast("string")), "training")


def raw_messages(spark: SparkSession, base: str) -> DataFrame:
    """Conversation turns as JSON messages of seven shapes, of which two are usable."""
    text = F.col("text")
    body = F.to_json(F.struct(text.alias("text")))
    whole = F.concat(F.lit('{"data":'), body, F.lit("}"))
    shape = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(7))
    value = (
        F.when(shape == 0, whole)
        .when(shape == 1, body)
        .when(shape == 2, F.concat(F.lit('{"data":null,'), F.substring(body, F.lit(2), F.length(body))))
        .when(shape == 3, F.concat(F.lit('{"data":'), F.to_json(F.struct(text.alias("body"))), F.lit("}")))
        .when(shape == 4, F.substring(whole, F.lit(1), F.length(whole) - 2))
        .when(shape == 5, F.concat(F.lit("["), body, F.lit("]")))
        .otherwise(F.lit('{"data":{"text":null}}'))
    )
    return conversations(spark, base).select(*TURN, value.alias("value"))


def document_messages(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("string").alias("key"), J.wrap(F.col("text")).alias("value"))


# --- cleaning ---------------------------------------------------------------------------------


def clean_filter(spark: SparkSession, base: str) -> DataFrame:
    return pages(spark, base).select("page_id", clean_text(F.col("html"), "filter").alias("cleaned"))


def clean_filter_cjk(spark: SparkSession, base: str) -> DataFrame:
    raw = F.concat(F.lit("“"), F.col("html"), F.lit("”？】"))
    return pages(spark, base).select("page_id", clean_text(raw, "filter_cjk").alias("cleaned"))


def clean_ascii(spark: SparkSession, base: str) -> DataFrame:
    return pages(spark, base).select("page_id", clean_text(F.col("html"), "ascii").alias("cleaned"))


def clean_train(spark: SparkSession, base: str) -> DataFrame:
    return trainset.corpus_lines(documents(spark, base), DOC, F.col("text"), "train")


def clean_stream(spark: SparkSession, base: str) -> DataFrame:
    raw = F.concat(F.lit("\t“"), F.col("text"), F.lit("%”？ \n"))
    return documents(spark, base).select("doc_id", clean_text(raw, "stream").alias("cleaned"))


# --- messages ---------------------------------------------------------------------------------


def json_extract(spark: SparkSession, base: str) -> DataFrame:
    return raw_messages(spark, base).select(*TURN, J.extract_strict(F.col("value"), PATH).alias("text"))


def json_extract_lenient(spark: SparkSession, base: str) -> DataFrame:
    return raw_messages(spark, base).select(*TURN, J.extract_lenient(F.col("value"), PATH).alias("text"))


def json_mark(spark: SparkSession, base: str) -> DataFrame:
    content = F.struct(F.col("text").alias("content")).alias("content")
    old = F.lit(1).alias(J.MARKER)
    odd = F.col("doc_id") % 2 == 1
    value = F.when(odd, F.to_json(F.struct(old, content))).otherwise(F.to_json(F.struct(content)))
    rows = documents(spark, base).select(F.col("doc_id").alias("key"), value.alias("value"))
    return flagging.mark_messages(rows, insult_lexicon(spark), profile="train").select("key", "value")


def json_reject_counts(spark: SparkSession, base: str) -> DataFrame:
    return flagging.reject_counts(raw_messages(spark, base), F.col("value"), PATH)


def message_envelope(spark: SparkSession, base: str) -> DataFrame:
    rows = conversations(spark, base).select(*TURN, F.encode("text", "UTF-8").alias("body"))
    sent = queue.envelope(rows, F.col("body"))
    number = F.col("num").cast("int")
    return sent.select(
        *TURN, "payload", F.length("msg_id").cast("bigint").alias("id_length"), number.between(1000, 9999).alias("in_range")
    )


# --- tokens -----------------------------------------------------------------------------------


def _joined_tokens(ids: list[str], tokens: Column) -> list:
    return [*ids, F.size(tokens).cast("bigint").alias("n"), F.array_join(tokens, " ").alias("tokens")]


def tokenize_words(spark: SparkSession, base: str) -> DataFrame:
    return documents(spark, base).select(*_joined_tokens(DOC, T.words(F.col("text"))))


def tokens_minlen(spark: SparkSession, base: str) -> DataFrame:
    return documents(spark, base).select(*_joined_tokens(DOC, T.longer_than(T.words(F.col("text")))))


def word_spans(spark: SparkSession, base: str) -> DataFrame:
    spans = segment.word_spans(documents(spark, base), DOC, F.col("text"))
    return spans.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("start").alias("starts"), F.sum("end").alias("ends")
    )


def context_ngrams(spark: SparkSession, base: str) -> DataFrame:
    return conversations(spark, base).select(*_joined_tokens(TURN, T.context_ngrams(T.words(F.col("text")))))


def segment_all(spark: SparkSession, base: str) -> DataFrame:
    text = F.lower(clean_text(F.col("text"), "filter"))
    found = segment.find_all(documents(spark, base), DOC, text, benchmark_lexicon(spark, base).select("word"))
    return found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("start").alias("starts"), F.sum(F.length("word")).alias("chars")
    )


def segment_all_large(spark: SparkSession, base: str) -> DataFrame:
    """Turns against the words of all documents, more than a plan should hold."""
    text = F.lower(clean_text(F.col("text"), "filter"))
    found = segment.find_all(conversations(spark, base), TURN, text, _all_document_words(spark, base))
    return found.groupBy(*TURN).agg(
        F.count(F.lit(1)).alias("n"), F.sum("start").alias("starts"), F.sum(F.length("word")).alias("chars")
    )


def segment_greedy(spark: SparkSession, base: str) -> DataFrame:
    text = clean_text(F.col("text"), "filter")
    words = inline_words(benchmark_lexicon(spark, base))
    if words is None:
        tokens = segment.segment_greedy(documents(spark, base), DOC, text, benchmark_lexicon(spark, base), latin_runs=False)
        ordered = F.array_sort(F.collect_list(F.struct("start", "term", "known")))
        terms = tokens.groupBy("doc_id").agg(ordered.alias("t"))
    else:
        found = segment.greedy_terms(text, words, latin_runs=False)
        # Generated, as a filter on the array would compute it a second time.
        some = F.explode(F.filter(F.array(found), lambda t: F.size(t) > 0))
        terms = documents(spark, base).select("doc_id", some.alias("t"))
    return terms.select(
        "doc_id",
        F.size("t").cast("bigint").alias("n"),
        F.size(F.filter("t", lambda t: t["known"])).cast("bigint").alias("n_known"),
        F.array_join("t.term", " ").alias("tokens"),
    )


def segment_positives(spark: SparkSession, base: str) -> DataFrame:
    words = lexicon.as_lexicon(conversation_words(spark, base), "conversation", "table")
    rows = trainset.segment_positives(words, benchmark_lexicon(spark, base))
    return rows.select(F.array_join("word", " ").alias("parts"), "label")


# --- matching ---------------------------------------------------------------------------------


def flag_messages(spark: SparkSession, base: str) -> DataFrame:
    flagged = match.flag_messages(documents(spark, base), F.col("text"), insult_lexicon(spark), "train")
    return flagged.select("doc_id", "is_sensitive")


def flag_messages_cjk(spark: SparkSession, base: str) -> DataFrame:
    flagged = match.flag_messages(
        documents(spark, base), F.col("text"), insult_lexicon(spark), "filter_cjk", "anywhere"
    )
    return flagged.select("doc_id", "is_sensitive")


def flag_large_lexicon(spark: SparkSession, base: str) -> DataFrame:
    """Conversation turns against a lexicon that grows with the documents and is joined."""
    path = scratch_dir(spark, "lexicon")
    word_lexicon(spark, trainset.vocabulary(document_words(spark, base))).write.parquet(path)
    flagged = match.flag_messages(conversations(spark, base), F.col("text"), wordfiles.read_lexicon(spark, path), "train")
    return flagged.select(*TURN, "is_sensitive")


def _all_document_words(spark: SparkSession, base: str, longer_than: int = 1) -> DataFrame:
    """The words of the documents and the insults: more than a plan should hold."""
    vocabulary = trainset.vocabulary(document_words(spark, base)).where(F.length("word") > longer_than)
    return stored(vocabulary.unionByName(insult_lexicon(spark).select("word")).distinct(), "lexicon")


def flag_keyless(spark: SparkSession, base: str) -> DataFrame:
    """Turns as JSON messages that all have one key or none, against a large lexicon."""
    key = F.when(F.col("turn") % 2 == 0, "word")
    rows = conversations(spark, base).select(key.alias("key"), J.wrap(F.col("text")).alias("value"))
    marked = flagging.mark_messages(rows, _all_document_words(spark, base), mode="words")
    return marked.select("key", J.extract_strict(F.col("value")).alias("text"), "is_sensitive")


def flag_mixed_scripts(spark: SparkSession, base: str) -> DataFrame:
    """Documents with Chinese text put in, of which a dictionary covers a listed word in every second one."""
    text = F.concat(F.col("text"), F.lit(" "), F.when(F.col("doc_id") % 2 == 0, "大红苹果树").otherwise("大红苹果甜"))
    listed = spark.createDataFrame([("苹果",)], "word string")
    dictionary = spark.createDataFrame([("苹果树",), ("红",)], "word string")
    flagged = match.flag_messages(documents(spark, base), text, listed, dictionary=dictionary)
    return flagged.select("doc_id", "is_sensitive")


def vocab_mixed_scripts(spark: SparkSession, base: str) -> DataFrame:
    """Words of turns in Latin, Polish, Cyrillic and Chinese letters."""
    text = F.concat(F.lit("Łódź šedá œuvre привет 红苹果 "), F.col("text"), F.lit("好"))
    return trainset.vocabulary(trainset.corpus_words(conversations(spark, base), TURN, text, "train", 0))


def flag_segmented(spark: SparkSession, base: str) -> DataFrame:
    return match.flag_segmented(
        documents(spark, base), DOC, F.col("text"), insult_lexicon(spark), benchmark_lexicon(spark, base),
        "filter", latin_runs=False,
    )


def first_match(spark: SparkSession, base: str) -> DataFrame:
    first = match.first_match(documents(spark, base), DOC, F.col("text"), insult_lexicon(spark))
    return first.withColumn("pos", F.col("pos").cast("bigint"))


def widened_match(spark: SparkSession, base: str) -> DataFrame:
    """The lexicon is the benchmark's words whose md5 is even, the dictionary all of them."""
    dictionary = benchmark_lexicon(spark, base)
    listed = dictionary.where(F.substring(F.md5("word"), 1, 1).isin(*"02468ace"))
    return match.widened_match(documents(spark, base), DOC, F.col("text"), listed, dictionary)


def _benchmark_phrases(spark: SparkSession, base: str) -> DataFrame:
    items = read_table(spark, base, "benchmark", ["text"])
    tokens = T.words(F.col("text"))
    pairs = F.transform(
        F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))),
        lambda t, i: F.concat(t, F.lit(" "), F.get(tokens, i + 1)),
    )
    return items.select(F.explode(pairs).alias("word")).distinct().withColumn("category", F.lit("phrase"))


def phrase_hits(spark: SparkSession, base: str) -> DataFrame:
    """Hits of words and of two-word phrases, the phrases being those of the benchmark items."""
    listed = _benchmark_phrases(spark, base).unionByName(insult_lexicon(spark).select("word", "category"))
    hits = match.phrase_hits(documents(spark, base), DOC, F.col("text"), listed, None)
    return hits.groupBy("doc_id", "word", "category").agg(
        F.count(F.lit(1)).alias("n"), F.min("start").alias("first_start"), F.sum("end").alias("ends")
    )


def phrase_hits_large(spark: SparkSession, base: str) -> DataFrame:
    """Documents against the words of all turns and the two-word phrases of the benchmark items."""
    words = conversation_words(spark, base).select("word").distinct().withColumn("category", F.lit("conversation"))
    listed = stored(words.unionByName(_benchmark_phrases(spark, base)), "lexicon")
    hits = match.phrase_hits(documents(spark, base), DOC, F.col("text"), listed, None)
    return hits.groupBy("doc_id", "category").agg(
        F.count(F.lit(1)).alias("n"), F.min("start").alias("first_start"), F.sum("end").alias("ends")
    )


def match_counts(spark: SparkSession, base: str) -> DataFrame:
    hits = match.word_hits(documents(spark, base), DOC, F.col("text"), insult_lexicon(spark))
    return match.match_counts(hits, DOC)


def category_counts(spark: SparkSession, base: str) -> DataFrame:
    benchmark = benchmark_lexicon(spark, base).select("word", "category")
    listed = benchmark.unionByName(insult_lexicon(spark).select("word", "category"))
    return match.category_counts(match.word_hits(documents(spark, base), DOC, F.col("text"), listed), DOC)


def route_counts(spark: SparkSession, base: str) -> DataFrame:
    flagged = match.flag_messages(documents(spark, base, "source"), F.col("text"), insult_lexicon(spark))
    return flagged.groupBy("source", "is_sensitive").agg(F.count(F.lit(1)).alias("n"))


# --- lexicon ----------------------------------------------------------------------------------


def lexicon_load(spark: SparkSession, base: str) -> DataFrame:
    """Word files, one folder per document source, written and loaded again."""
    path = scratch_dir(spark, "words")
    words = T.words(F.col("text"))
    rows = documents(spark, base, "source").select(F.col("source").alias("category"), F.explode(words).alias("word"))
    padded = F.concat(F.lit(" "), "word", F.lit("\t")).alias("value")
    rows.distinct().select("category", padded).write.partitionBy("category").text(path)
    return wordfiles.load_word_files(spark, path, "folder").select("word_id", "word", "category")


def lexicon_lookup(spark: SparkSession, base: str) -> DataFrame:
    terms = conversation_words(spark, base).select(F.col("word").alias("term")).distinct()
    return match.lookup(terms, benchmark_lexicon(spark, base))


def lexicon_phrase_search(spark: SparkSession, base: str) -> DataFrame:
    asked = benchmark_lexicon(spark, base).select(F.col("word").alias("query"))
    listed = lexicon.as_lexicon(conversation_words(spark, base), "conversation", "table")
    return match.phrase_search_many(asked, listed)


def lexicon_phrase_index(spark: SparkSession, base: str) -> DataFrame:
    """Words and their beginnings of one to three letters, sought in an index that has followed additions and deletions."""
    words, index = scratch_dir(spark, "lexicon"), scratch_dir(spark, "grams")
    listed = lexicon.as_lexicon(conversation_words(spark, base), "conversation", "table")
    snapshots.commit(spark, words, listed.withColumn("op", F.lit("add")))
    grams.follow(spark, words, index)
    gone = listed.where(F.startswith("word", F.lit("a")))
    snapshots.commit(spark, words, gone.withColumn("op", F.lit("delete")))
    snapshots.commit(spark, words, gone.where(F.startswith("word", F.lit("an"))).withColumn("op", F.lit("add")))
    grams.follow(spark, words, index)
    asked = benchmark_lexicon(spark, base).select("word")
    short = [asked.select(F.substring("word", 1, n).alias("query")) for n in (1, 2, 3)]
    found = grams.search(spark, index, short[0].union(short[1]).union(short[2]).union(asked).distinct())
    return found.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("word").alias("first"), F.max("word_id").alias("last_id"))


def lexicon_upsert_status(spark: SparkSession, base: str) -> DataFrame:
    incoming = conversations(spark, base).select(*TURN, F.posexplode(T.blank_words(F.col("text"))).alias("pos", "word"))
    incoming = incoming.withColumn("pos", F.col("pos").cast("bigint"))
    status = lexicon.upsert_status(incoming, benchmark_lexicon(spark, base), [*TURN, "pos"])
    return status.withColumn("status", F.col("status").cast("bigint"))


def lexicon_delete(spark: SparkSession, base: str) -> DataFrame:
    return lexicon.delete_status(benchmark_lexicon(spark, base), conversation_words(spark, base))


def lexicon_delete_id(spark: SparkSession, base: str) -> DataFrame:
    listed = lexicon.as_lexicon(conversation_words(spark, base), "conversation", "table")
    return lexicon.delete_ids(listed, benchmark_lexicon(spark, base)).select("word_id", "word")


def _write_versions(spark: SparkSession, base: str) -> str:
    """Version 1 adds the benchmark words, 2 the conversation words, 3 takes out those beginning with a."""
    path = scratch_dir(spark, "lexicon")
    first = benchmark_lexicon(spark, base)
    second = lexicon.as_lexicon(conversation_words(spark, base), "conversation", "table").join(first, "word", "left_anti")
    lexicon.append_version(first.withColumn("op", F.lit("add")), path, 1)
    lexicon.append_version(second.withColumn("op", F.lit("add")), path, 2)
    gone = lexicon.read_versions(spark, path).where(F.startswith("word", F.lit("a")))
    lexicon.append_version(gone.withColumn("op", F.lit("delete")), path, 3)
    return path


def lexicon_delta(spark: SparkSession, base: str) -> DataFrame:
    return lexicon.delta(lexicon.read_versions(spark, _write_versions(spark, base)), 1)


def lexicon_current(spark: SparkSession, base: str) -> DataFrame:
    return lexicon.current(lexicon.read_versions(spark, _write_versions(spark, base)))


def lexicon_feed(spark: SparkSession, base: str) -> DataFrame:
    """The changes read as a stream."""
    out = scratch_dir(spark, "feed")
    changes = lexicon.stream_versions(spark, _write_versions(spark, base))
    queue.write_stream(changes, "parquet", {}, scratch_dir(spark, "progress"), out).start().awaitTermination()
    return spark.read.parquet(out).select("word", "op", "version")


def lexicon_snapshots(spark: SparkSession, base: str) -> DataFrame:
    """Two writers, a compaction between them, deletions, and the words added after the first version."""
    path = scratch_dir(spark, "lexicon")
    first = benchmark_lexicon(spark, base)
    snapshots.clear(spark, path)
    snapshots.commit(spark, path, first.withColumn("op", F.lit("add")))
    snapshots.keep_new(spark, path, "conversation")(conversation_words(spark, base).select("word").distinct(), 0)
    snapshots.compact(spark, path)
    gone = snapshots.current(spark, path).where(F.startswith("word", F.lit("a")))
    snapshots.commit(spark, path, gone.withColumn("op", F.lit("delete")), "review")
    again = first.where(F.startswith("word", F.lit("an")))
    snapshots.commit(spark, path, again.withColumns({"op": F.lit("add"), "category": F.lit("again")}), "review")
    now = snapshots.current(spark, path).select(F.lit("current").alias("part"), "word", "category", "version")
    added = snapshots.delta(spark, path, 2).select(F.lit("added").alias("part"), "word", F.lit(None).cast("string").alias("category"), "version")
    return now.unionByName(added)


def lexicon_matchable(spark: SparkSession, base: str) -> DataFrame:
    """Entries cut from the pages at blanks, with all their marks."""
    html = read_table(spark, base, "pages", ["html"], pieces=True)
    entries = html.select(F.explode(F.split("html", "\\s")).alias("word"))
    return lexicon.matchable(entries)


def lexicon_size(spark: SparkSession, base: str) -> DataFrame:
    return lexicon.size(lexicon.as_lexicon(document_words(spark, base), "document", "table"))


def lexicon_review(spark: SparkSession, base: str) -> DataFrame:
    """Words of toxic documents are candidates; their md5 decides for the reviewer."""
    listed = benchmark_lexicon(spark, base)
    toxic = read_table(spark, base, "labels", ["doc_id", "toxic"]).where("toxic = 1").select("doc_id")
    texts = documents(spark, base).join(toxic, "doc_id", "left_semi")
    candidates = trainset.vocabulary(trainset.corpus_words(texts, DOC, F.col("text"), None))
    candidates = candidates.join(listed, "word", "left_anti")
    first = F.substring(F.md5("word"), 1, 1)
    decisions = (
        candidates.where(first.between("0", "7")).select("word", F.lit("confirm").alias("action"))
        .unionByName(candidates.where(first == "8").select(F.concat("word", F.lit("s")).alias("word"), F.lit("add").alias("action")))
        .unionByName(listed.where(first == "a").select("word", F.lit("delete").alias("action")))
    )
    return lexicon.review(listed, candidates, decisions).select("word_id", "word", "category")


# --- training sets and features ---------------------------------------------------------------


def corpus_lines(spark: SparkSession, base: str) -> DataFrame:
    return trainset.corpus_lines(documents(spark, base), DOC, F.col("text"))


def vocab_distinct(spark: SparkSession, base: str) -> DataFrame:
    return trainset.vocabulary(document_words(spark, base))


def vocab_count(spark: SparkSession, base: str) -> DataFrame:
    return trainset.vocabulary(document_words(spark, base)).agg(F.count(F.lit(1)).alias("n"))


def negatives(spark: SparkSession, base: str) -> DataFrame:
    kept = trainset.subtract(document_words(spark, base), benchmark_lexicon(spark, base), ["doc_id", "pos"])
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def train_set(spark: SparkSession, base: str) -> DataFrame:
    return labelled_words(spark, base)


def hash_split(spark: SparkSession, base: str) -> DataFrame:
    return trainset.hash_split(labelled_words(spark, base), F.col("word"))


def parse_labeled_points(spark: SparkSession, base: str) -> DataFrame:
    labels = read_table(spark, base, "labels", ["doc_id", "quality", "toxic"])
    line = F.concat_ws(
        " ", F.concat_ws(",", "toxic", "quality"), F.col("doc_id") % 5, F.concat(F.col("doc_id") % 3, F.lit(".5"))
    )
    points = trainset.parse_points(labels.select("doc_id", line.alias("line")), F.col("line"))
    return points.select("doc_id", "label", *[F.get("features", F.lit(i)).alias(f"f{i}") for i in range(3)])


def hashing_tf(spark: SparkSession, base: str) -> DataFrame:
    texts = read_table(spark, base, "documents", ["doc_id", "text"], pieces=True)
    return features.hashed_counts(texts, DOC, T.words(F.col("text")), classify.NB_BUCKETS)


def _tfidf(spark: SparkSession, rows: DataFrame, fitted_on: DataFrame, buckets: int) -> DataFrame:
    stages = [*features.tf_stages(spark, buckets, "md5"), features.idf_stage()]
    vectors = Pipeline(stages=stages).fit(fitted_on).transform(rows)
    values = features.vector_rows(vectors, DOC)
    return values.withColumn("value", F.round("value", 6))


def tfidf_docs(spark: SparkSession, base: str) -> DataFrame:
    rows = documents(spark, base).select("doc_id", T.words(F.col("text")).alias("word"))
    return _tfidf(spark, rows, rows, classify.NB_BUCKETS)


def tfidf_refit(spark: SparkSession, base: str) -> DataFrame:
    """Weights of the test documents, with document frequencies taken from the test documents."""
    rows = documents(spark, base).select("doc_id", T.words(F.col("text")).alias("word"))
    rows = trainset.hash_split(rows, F.col("doc_id").cast("string"))
    train, test = rows.where("part = 'train'"), rows.where("part = 'test'")
    stages = [*features.tf_stages(spark, classify.NB_BUCKETS, "md5"), features.idf_stage()]
    refitted = features.refit_idf(Pipeline(stages=stages).fit(train), test)
    return features.vector_rows(refitted.transform(test), DOC).withColumn("value", F.round("value", 6))


def tfidf_stream(spark: SparkSession, base: str) -> DataFrame:
    """Weights of documents by frequencies that were counted batch by batch, one of them twice, and in part summed up."""
    counts = scratch_dir(spark, "frequencies")
    rows = stored(documents(spark, base).select("doc_id", T.words(F.col("text")).alias("word")), "documents")
    for batch in (1, 0, 1, 2):
        frequencies.count_batch(rows.where(F.col("doc_id") % 3 == batch), F.col("word"), counts, batch, classify.NB_BUCKETS)
        if batch == 0:
            frequencies.compact(spark, counts, 0)
    stages = [*features.tf_stages(spark, classify.NB_BUCKETS, "md5"), features.idf_stage()]
    model = Pipeline(stages=stages).fit(rows.limit(1))
    told = frequencies.refreshed(spark, model, counts, classify.NB_BUCKETS).transform(rows)
    return features.vector_rows(told, DOC).withColumn("value", F.round("value", 6))


# --- classifiers and scores -------------------------------------------------------------------


def _word_predictions(spark: SparkSession, base: str, fit: Callable, **options) -> DataFrame:
    rows = trainset.hash_split(labelled_words(spark, base), F.col("word")).withColumn("term", F.col("word"))
    rows = stored(trainset.as_terms(rows), "training")
    model = fit(rows.where("part = 'train'").select("word", "label"), **options)
    scored = classify.predict(model, rows.where("part = 'test'"))
    return scored.select(F.col("term").alias("word"), "label", "prediction")


def nb_words(spark: SparkSession, base: str) -> DataFrame:
    return _word_predictions(spark, base, classify.fit_naive_bayes, hashing="md5")


def nb_bernoulli(spark: SparkSession, base: str) -> DataFrame:
    rows = labelled_documents(spark, base)
    model = classify.fit_bernoulli(rows.where("part = 'train'"), DOC_BUCKETS, "md5")
    return classify.predict(model, rows).select("doc_id", "label", "prediction")


def _english_documents(spark: SparkSession, base: str) -> DataFrame:
    rows = documents(spark, base, "lang").where(F.col("lang").isNotNull())
    labelled = rows.select("doc_id", T.words(F.col("text")).alias("word"), (F.col("lang") == "en").cast("double").alias("label"))
    return stored(trainset.hash_split(labelled, F.col("doc_id").cast("string")), "training")


def _checked(scored: DataFrame) -> DataFrame:
    """Test rows with whether the prediction is a class, and whether the model beats the larger class on all of them."""
    scored = stored(scored.select("doc_id", "label", "prediction"), "scored")
    share = scored.agg(F.avg("label")).first()[0] or 0.0
    better = classify.accuracy(scored) > max(share, 1 - share)
    return scored.select("doc_id", "label", F.col("prediction").isin(0.0, 1.0).alias("valid"), F.lit(better).alias("better"))


def mlp_docs(spark: SparkSession, base: str) -> DataFrame:
    """A perceptron that tells English documents from others."""
    rows = _english_documents(spark, base)
    model = classify.fit_perceptron(rows.where("part = 'train'").select("word", "label"))
    return _checked(classify.predict(model, rows.where("part = 'test'")))


def word2vec_docs(spark: SparkSession, base: str) -> DataFrame:
    """The same by vectors of the words of whole documents."""
    rows = _english_documents(spark, base)
    partitions = max(4, spark.sparkContext.defaultParallelism)
    model = classify.fit_word2vec(rows.where("part = 'train'").select("word", "label"), 8, 5, [8, 6, 2], partitions)
    scored = classify.predict(model, rows.where("part = 'test'"))
    return _checked(scored.withColumn("prediction", F.col("predictedLabel").cast("double")))


def nb_docs(spark: SparkSession, base: str) -> DataFrame:
    rows = labelled_documents(spark, base)
    model = classify.fit_naive_bayes(rows.where("part = 'train'"), DOC_BUCKETS, "md5")
    return classify.predict(model, rows).select("doc_id", "label", "part", "prediction")


def model_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """The document classifier, saved twice over the same path, loaded and applied."""
    rows = labelled_documents(spark, base)
    model = classify.fit_naive_bayes(rows.where("part = 'train'"), DOC_BUCKETS, "md5")
    path = scratch_dir(spark, "model")
    classify.save(model, path)
    classify.save(model, path)
    return classify.predict(classify.load(path), rows).select("doc_id", "prediction")


def confusion_words(spark: SparkSession, base: str) -> DataFrame:
    return evaluate.confusion(nb_words(spark, base))


def recall_lexicon(spark: SparkSession, base: str) -> DataFrame:
    scored = evaluate.lexicon_recall(nb_words(spark, base))
    return scored.withColumn("recall", F.round("recall", 6))


def confusion_docs(spark: SparkSession, base: str) -> DataFrame:
    return evaluate.confusion(nb_docs(spark, base).where("part = 'test'"))


def metrics_docs(spark: SparkSession, base: str) -> DataFrame:
    scores = evaluate.metrics(confusion_docs(spark, base))
    return scores.select(*[F.round(c, 6).alias(c) for c in scores.columns])


def onehot_argmax(spark: SparkSession, base: str) -> DataFrame:
    rows = read_table(spark, base, "embeddings", ["vec_id", "embedding", "label"], True)
    hot = classify.one_hot(F.col("label"), 10)
    return rows.select(
        "vec_id",
        F.array_join(F.transform(hot, lambda v: v.cast("int").cast("string")), "").alias("one_hot"),
        classify.argmax(hot).alias("decoded"),
        classify.argmax(F.col("embedding")).alias("largest"),
    )


# --- streams ----------------------------------------------------------------------------------


def stream_flag(spark: SparkSession, base: str) -> DataFrame:
    arriving = document_messages(stream_table(spark, base, "documents"))
    out = scratch_dir(spark, "marked")
    flagging.flag_stream(
        arriving, lambda: insult_lexicon(spark), flagging.batch_files(out), scratch_dir(spark, "progress"), deal=True, profile="train"
    ).start().awaitTermination()
    return spark.read.parquet(out).select("key", "value", "is_sensitive")


def stream_flag_large(spark: SparkSession, base: str) -> DataFrame:
    """Files of messages under one key, several batches of them, marked by the long words of all documents, routed and sent on."""
    arriving, clean, flagged, progress = (scratch_dir(spark, p) for p in ("arriving", "clean", "flagged", "progress"))
    sent = queue.outgoing(conversations(spark, base), F.col("conv_id"), J.wrap(F.col("text")), constant_key=True)
    sent.repartition(4).write.parquet(arriving)
    listed = _all_document_words(spark, base, 8)
    stream = spark.readStream.schema("key string, value string").option("maxFilesPerTrigger", 2).parquet(arriving)
    routes = flagging.route(flagging.batch_files(clean), flagging.batch_files(flagged))
    flagging.flag_stream(stream, lambda: listed, routes, progress).start().awaitTermination()
    both = [spark.read.parquet(path).select("key", "value", F.lit(route).alias("route")) for path, route in ((clean, "clean"), (flagged, "flagged"))]
    rows = both[0].unionByName(both[1])
    return rows.groupBy("key", "route", J.extract_strict(F.col("value")).alias("text")).agg(F.count(F.lit(1)).alias("n"))


def _turn_messages(spark: SparkSession, base: str) -> DataFrame:
    return conversations(spark, base).select(F.concat_ws("-", *TURN).alias("key"), J.wrap(F.col("text")).alias("value"))


def stream_outbox(spark: SparkSession, base: str) -> DataFrame:
    """Marked turns handed to a queue through an outbox, several batches of them, and read from the queue through an inbox."""
    arriving, box, sent, came, got = (scratch_dir(spark, p) for p in ("arriving", "outbox", "queue", "inbox", "received"))
    _turn_messages(spark, base).repartition(4).write.parquet(arriving)
    stream = spark.readStream.schema("key string, value string").option("maxFilesPerTrigger", 2).parquet(arriving)
    send = outbox.outbox(box, flagging.queue("parquet", {"path": sent}, outbox.MESSAGE))
    flagging.flag_stream(stream, lambda: insult_lexicon(spark), send, scratch_dir(spark, "progress")).start().awaitTermination()
    read = queue.read_stream(spark, "parquet", {"maxFilesPerTrigger": "4"}, sent, "sent_batch bigint, sent_seq bigint, key string, value string")
    take = outbox.inbox(came, flagging.batch_files(got))
    read.writeStream.foreachBatch(take).option("checkpointLocation", scratch_dir(spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(got).select("key", "value")


def stream_spool(spark: SparkSession, base: str) -> DataFrame:
    """Messages of seven shapes in a spool, read up to 500 at a time by each reader, marked, and written to another; and how many were
    rejected and why."""
    use_spool(spark)
    arriving, marked, refused = (scratch_dir(spark, p) for p in ("arriving", "marked", "refused"))
    rows = raw_messages(spark, base).select(F.concat_ws("-", *TURN).alias("key"), "value")
    rows.write.format("spool").mode("append").save(arriving)
    readers = READERS_PER_CORE * spark.sparkContext.defaultParallelism
    read = queue.read_stream(spark, "spool", {"prefetch": "500", "readers": str(readers)}, arriving)
    counted: dict[str, int] = {}

    def count(batch_id: int, reasons: dict[str, int]) -> None:
        for reason, n in reasons.items():
            counted[reason] = counted.get(reason, 0) + n

    marking = flagging.flag_stream(
        read, lambda: insult_lexicon(spark), flagging.queue("spool", {"path": marked}), scratch_dir(spark, "progress"),
        rejects=flagging.batch_files(refused), on_counts=count, path=PATH,
    )
    queue.drain(marking)
    used = spark.read.format("spool").load(marked).select("key", "value", F.lit(None).cast("long").alias("n"))
    reasons = spark.createDataFrame([(k, None, n) for k, n in counted.items() if n and k != "used"], "key string, value string, n long")
    return used.unionByName(reasons)


def lexicon_writers(spark: SparkSession, base: str) -> DataFrame:
    """A reviewer and a discovery job write versions of the same numbers; both stay."""
    path = scratch_dir(spark, "lexicon")
    lexicon.append_version(benchmark_lexicon(spark, base).withColumn("op", F.lit("add")), path, 1)
    reviewed = benchmark_lexicon(spark, base).where(F.startswith("word", F.lit("a")))
    lexicon.append_version(reviewed.withColumn("op", F.lit("delete")), path, 2, "review")
    keep = discovery.to_lexicon(spark, path, 2)
    found = conversation_words(spark, base).select("word").distinct()
    keep(found.where(~F.startswith("word", F.lit("a"))), 0)
    return lexicon.current(lexicon.read_versions(spark, path)).select("word", "category", "version")


def stream_hot_update(spark: SparkSession, base: str) -> DataFrame:
    """Two waves of messages through one running stream; between them the lexicon gains words."""
    arriving, words, out, progress = (scratch_dir(spark, p) for p in ("arriving", "lexicon", "marked", "progress"))
    all_messages = conversations(spark, base).select(
        F.concat_ws("-", *TURN).alias("key"), J.wrap(F.col("text")).alias("value"), (F.col("conv_id") % 2).alias("wave")
    )

    def arrive(wave: int) -> None:
        all_messages.where(F.col("wave") == wave).select("key", "value").write.parquet(f"{arriving}/wave{wave}")

    snapshots.commit(spark, words, insult_lexicon(spark).withColumn("op", F.lit("add")))
    arrive(0)
    stream = spark.readStream.schema("key string, value string").parquet(f"{arriving}/wave*")
    running = flagging.flag_stream(
        stream, snapshots.Newest(spark, words), flagging.batch_files(out), progress, every="1 second"
    ).start()
    try:
        running.processAllAvailable()
        snapshots.commit(spark, words, benchmark_lexicon(spark, base).withColumn("op", F.lit("add")))
        arrive(1)
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.parquet(out).select("key", "is_sensitive")


def _word_model(spark: SparkSession, base: str) -> tuple[PipelineModel, DataFrame]:
    """A classifier learned from the words of the documents, and the lexicon it learned from."""
    vocabulary = stored(trainset.vocabulary(document_words(spark, base)), "vocabulary")
    listed = stored(word_lexicon(spark, vocabulary), "lexicon")
    train = stored(trainset.as_terms(trainset.label_words(listed, vocabulary)), "training")
    return classify.fit_naive_bayes(train, hashing="md5"), listed


def stream_discover(spark: SparkSession, base: str) -> DataFrame:
    """New words in the conversations, as candidates for review."""
    model, listed = _word_model(spark, base)
    arriving = stream_table(spark, base, "conversations").select(J.wrap(F.col("text")).alias("value"))
    candidates = scratch_dir(spark, "candidates")
    keep = discovery.to_candidates(spark, lambda: listed, candidates)
    discovery.discovery_stream(arriving, model, keep, scratch_dir(spark, "progress")).start().awaitTermination()
    return discovery.read_candidates(spark, candidates).select("word")


def stream_novelty(spark: SparkSession, base: str) -> DataFrame:
    """Words of the conversations when they first come, those of the benchmark being known; with a restart between the
    second and the third part."""
    arriving, out, progress = (scratch_dir(spark, p) for p in ("arriving", "new", "progress"))
    rows = conversations(spark, base).withColumn("part", F.col("conv_id") % 4)
    known = stored(benchmark_lexicon(spark, base).select("word"), "lexicon")
    files = spark.sparkContext.defaultParallelism
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", novelty.STORE)
    try:
        for parts in ((0, 1), (2, 3)):
            for part in parts:
                rows.where(F.col("part") == part).select("text").repartition(files).write.mode("append").parquet(arriving)
            stream = spark.readStream.schema("text string").option("maxFilesPerTrigger", files).parquet(arriving)
            words = stream.select(F.explode(T.words(F.col("text"))).alias("word"))
            queue.write_stream(novelty.new_words(words, known), "parquet", {}, progress, out).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return spark.read.parquet(out).select("word")


def stream_hot_model(spark: SparkSession, base: str) -> DataFrame:
    """Two waves of turns through one running discovery; between them a model is published that says the opposite of the first."""
    vocabulary = stored(trainset.vocabulary(document_words(spark, base)), "vocabulary")
    listed = stored(word_lexicon(spark, vocabulary), "lexicon")
    train = stored(trainset.as_terms(trainset.label_words(listed, vocabulary)), "training")
    path, arriving, candidates = (scratch_dir(spark, p) for p in ("models", "arriving", "candidates"))
    rows = conversations(spark, base)

    def arrive(wave: int) -> None:
        rows.where(F.col("conv_id") % 2 == wave).select(J.wrap(F.col("text")).alias("value")).write.parquet(f"{arriving}/wave{wave}")

    models.publish(spark, path, classify.fit_naive_bayes(train, hashing="md5"))
    arrive(0)
    stream = spark.readStream.schema("value string").parquet(f"{arriving}/wave*")
    keep = discovery.to_candidates(spark, lambda: listed, candidates)
    running = discovery.discovery_stream(stream, models.Newest(spark, path), keep, scratch_dir(spark, "progress"), every="1 second").start()
    try:
        running.processAllAvailable()
        models.publish(spark, path, classify.fit_naive_bayes(train.withColumn("label", 1 - F.col("label")), hashing="md5"))
        arrive(1)
        running.processAllAvailable()
    finally:
        running.stop()
    return discovery.read_candidates(spark, candidates).select("word").distinct()


def stream_extend_lexicon(spark: SparkSession, base: str) -> DataFrame:
    """New words and joins of neighbouring words in plain texts, taken into the lexicon at once."""
    model, listed = _word_model(spark, base)
    words = scratch_dir(spark, "lexicon")
    first = listed.select("word", F.lit("known").alias("category"), F.lit("add").alias("op"))
    lexicon.append_version(first, words, 1)
    arriving = stream_table(spark, base, "conversations").select(F.col("text").alias("value"))
    discovery.discovery_stream(
        arriving, model, discovery.to_lexicon(spark, words, 2), scratch_dir(spark, "progress"),
        path=None, profile="ascii", ngrams=True, deal=True,
    ).start().awaitTermination()
    return lexicon.delta(lexicon.read_versions(spark, words), 1).select("word")


def stream_archive(spark: SparkSession, base: str) -> DataFrame:
    archive = scratch_dir(spark, "archive")
    arriving = stream_table(spark, base, "documents").select(J.wrap(F.col("text")).alias("value"))

    def run(batch: DataFrame, batch_id: int) -> None:
        texts = discovery.message_texts(batch, "value", J.DEFAULT_PATH, "stream")
        discovery.archive_batch(texts, archive, "documents", batch_id)

    writer = arriving.writeStream.foreachBatch(run).option("checkpointLocation", scratch_dir(spark, "progress"))
    writer.trigger(availableNow=True).start().awaitTermination()
    lines = spark.read.text(archive).where(F.length("value") > 0)
    return lines.groupBy("topic", F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        flag_messages, flag_messages_cjk, flag_large_lexicon, flag_keyless, flag_mixed_scripts, vocab_mixed_scripts, flag_segmented,
        clean_filter, clean_filter_cjk, clean_train, clean_stream, clean_ascii,
        json_extract, json_extract_lenient, json_mark, json_reject_counts, message_envelope,
        tokenize_words, tokens_minlen, word_spans, context_ngrams, segment_all, segment_all_large, segment_greedy, segment_positives,
        first_match, widened_match, phrase_hits, phrase_hits_large, match_counts, category_counts, route_counts,
        lexicon_load, lexicon_lookup, lexicon_phrase_search, lexicon_phrase_index, lexicon_upsert_status, lexicon_delete,
        lexicon_delete_id, lexicon_delta, lexicon_feed, lexicon_current, lexicon_snapshots, lexicon_matchable, lexicon_size, lexicon_review,
        corpus_lines, vocab_distinct, vocab_count, negatives, train_set, hash_split, parse_labeled_points,
        hashing_tf, tfidf_docs, tfidf_refit, tfidf_stream,
        nb_words, nb_docs, nb_bernoulli, mlp_docs, word2vec_docs, model_roundtrip,
        confusion_words, confusion_docs, metrics_docs, recall_lexicon, onehot_argmax,
        stream_flag, stream_flag_large, lexicon_writers, stream_hot_update, stream_discover, stream_extend_lexicon, stream_archive,
        stream_outbox, stream_spool, stream_novelty, stream_hot_model,
    )
}
