"""The registered queries and the pipeline over the smallest tables, against SQL or a plain Python version."""

import re
import zlib
from collections import Counter
from html.parser import HTMLParser
from pathlib import Path

import duckdb
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_models import auc
from tests.llm.test_near_dup import sets
from tests.llm.test_tables import shares
from tests.llm.test_texts import brute_matches, plain
from wordsieve.llm import sharding
from wordsieve.llm.oracles import ORACLES
from wordsieve.llm.queries import QUERIES

BASE = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(BASE).is_dir(), reason="no test tables")


def table(name):
    return pq.read_table(f"{BASE}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def documents():
    return {r["doc_id"]: r for r in table("documents")}


def rows(spark, name, key="doc_id"):
    found = QUERIES[name](spark, BASE).collect()
    assert len({r[key] for r in found}) == len(found)
    return {r[key]: r for r in found}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{BASE}/documents.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    df = QUERIES[name](spark, BASE)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(map(tuple, cursor.fetchall()))


def test_token_counts(spark, documents):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = rows(spark, "op1_token_counts")
    for i, r in documents.items():
        n = len(library.encode(r["text"], add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len(r["text"].encode()), n, n > 1024)


def test_shards(spark, documents):
    got = rows(spark, "op2_shuffle_shards")
    counts = Counter(r.shard for r in got.values())
    assert set(counts) <= set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for i, r in documents.items():
        data = r["text"].encode()
        assert (got[i].size, got[i].text_crc32, got[i].law, got[i].grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
    for shard, n in counts.items():
        assert sorted(r.slot for r in got.values() if r.shard == shard) == list(range(n))


def test_shards_are_written_with_whole_rows(spark, documents, monkeypatch):
    written, write = [], sharding.write_shards
    monkeypatch.setattr(sharding, "write_shards", lambda df, path, *a: (write(df, path, *a), written.append(path)))
    got = rows(spark, "op2_shuffle_shards")
    (path,) = written
    held = {r.doc_id: r for r in spark.read.parquet(path).collect()}
    assert held.keys() == documents.keys()
    for i, r in documents.items():
        assert {c: held[i][c] for c in r} == r
        assert (held[i].shard, held[i].slot) == (got[i].shard, got[i].slot)


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").is_dir(), reason="no larger tables")
def test_toxicity_ranks_held_out_rows(spark):
    """Some hundred toxic texts to learn from."""
    base = "/root/testdata/sf0.1"
    marks = spark.read.parquet(f"{base}/labels.parquet").select("doc_id", "toxic").where("toxic IS NOT NULL")
    kept = QUERIES["op10_toxicity"](spark, base).where("held_out").join(marks, "doc_id").select("score", "toxic").collect()
    assert sum(r.toxic for r in kept) > 50
    assert auc([r.score for r in kept], [r.toxic for r in kept]) >= 0.9


@pytest.mark.parametrize(("name", "label", "parts", "held", "least"), [("op3_quality", "quality", 5, 0, 0.9), ("op10_toxicity", "toxic", 4, 2, 0.0)])
def test_scores(spark, documents, name, label, parts, held, least):
    """The smallest table holds some tens of labels; its held-out ranking is checked where both labels are there."""
    got = rows(spark, name)
    assert set(got) == set(documents)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % parts == held) and r.predicted == (r.score >= 0.3)
    marks = {r["doc_id"]: r[label] for r in table("labels")}
    kept = [(got[i].score, y) for i, y in marks.items() if i in got and got[i].held_out]
    if {y for _, y in kept} == {0, 1}:
        assert auc(*zip(*kept)) >= least


class Article(HTMLParser):
    """The lines of a page's article by another parser, for pages that mark it and have no frames in it."""

    def __init__(self):
        super().__init__()
        self.inside, self.lines = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("p", "br", "h1", "h2", "ul", "li", "div"):
            self.lines.append("")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag in ("p", "h1", "h2", "ul", "li", "div"):
            self.lines.append("")

    def handle_data(self, data):
        if self.inside:
            self.lines[-1] += data


def test_pages(spark):
    got = rows(spark, "op4_main_text", "page_id")
    for r in table("pages"):
        other = Article()
        other.feed(r["html"])
        other.close()
        want = "\n".join(" ".join(line.split()) for line in other.lines if line.strip())
        assert got[r["page_id"]].text == want and got[r["page_id"]].n_chars == len(want)


def test_contamination(spark, documents):
    items = {r["item_id"]: " ".join(plain(r["text"])) for r in table("benchmark")}
    found = QUERIES["op5_decontaminate"](spark, BASE).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert len(got) == len(found) and all(r.similarity >= 0.8 and r.begin < r.end for r in found)
    held = {(i, k) for i, r in documents.items() for k, item in items.items() if f" {item} " in f" {' '.join(plain(r['text']))} "}
    assert held and held <= got
    for i, k in got - held:
        assert k in brute_matches(documents[i]["text"], [(x, " ".join(plain(t))) for x, t in items.items()])


def test_languages(spark, documents):
    got = rows(spark, "op7_languages")
    held = [i for i in documents if got[i].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in documents)
    assert sum(got[i].lang_pred == documents[i]["lang"] for i in held) >= 0.95 * len(held)


def component_of(documents, size, percent=80):
    found = {i: sets(r["text"], size) for i, r in documents.items()}
    parent = {i: i for i in documents}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(documents)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(found[a] & found[b])
            if both and 100 * both >= percent * len(found[a] | found[b]):
                parent[max(top(a), top(b))] = min(top(a), top(b))
    return {i: (len(found[i]), top(i)) for i in ids}


def test_near_duplicates(spark, documents):
    got = rows(spark, "op8_near_duplicates")
    want = component_of(documents, 4)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_pipeline(spark, documents):
    """Each stage on its own input, by brute force; the last holds all rows of the one before."""
    stages, docs = dict(corpus_pipeline.STAGES), spark.read.parquet(f"{BASE}/documents.parquet")
    columns = docs.columns
    clean = stages["toxicity"](spark, docs, BASE)
    marks = {r["doc_id"]: r["toxic"] for r in table("labels")}
    left = {r.doc_id: r.asDict() for r in clean.collect()}
    assert clean.columns == columns and not any(marks.get(i) == 1 for i in left)
    assert sum(marks[i] == 0 for i in left if i in marks) >= 0.95 * sum(y == 0 for y in marks.values())
    single = stages["near_duplicates"](spark, clean, BASE)
    kept = {r.doc_id: r.asDict() for r in single.collect()}
    assert single.columns == columns and set(kept) == {i for i, (_, top) in component_of(left, 5).items() if i == top}
    pure = stages["decontamination"](spark, single, BASE)
    got = Counter(r.doc_id for r in pure.collect())
    items = [" ".join(plain(r["text"])) for r in table("benchmark")]
    assert pure.columns == columns and set(got) == {i for i, r in kept.items() if not any(f" {x} " in f" {' '.join(plain(r['text']))} " for x in items)}
    mixed = stages["mixing"](spark, pure, BASE)
    copies = Counter(r.doc_id for r in mixed.collect())
    size = lambda i: len(re.findall(r"[^\x20\x09-\x0D]+", kept[i]["text"]))
    sizes = Counter()
    for i in got:
        sizes[kept[i]["source"]] += size(i)
    for source, target in shares(sizes).items():
        own = [i for i in got if kept[i]["source"] == source]
        assert abs(sum(copies[i] * size(i) for i in own) - target) <= max(map(size, own))
    assert mixed.columns == columns and max(copies.values()) <= 3
    dealt = stages["sharding"](spark, mixed, BASE).collect()
    assert Counter(r.doc_id for r in dealt) == copies
    shards = Counter(r.shard for r in dealt)
    assert max(shards.values()) - min(shards.values()) <= 1


def test_pipeline_on_odd_tables(spark, docs, tmp_path):
    """Nulls, empty texts, repeated rows, a clashing column; then no rows at all."""
    from pyspark.sql import functions as F

    base = str(tmp_path)
    odd = docs([(1, None, None), (1, None, None), (2, "", "a"), (None, "one two three four five six", "a"), (3, "One two three four five six", None)])
    for name, rows_of in (("odd", odd), ("none", odd.limit(0))):
        rows_of.withColumns({"score": F.lit("x"), "first": F.lit(1), "record": F.lit("r"), "size": F.lit(2)}).write.parquet(f"{base}/{name}/documents.parquet")
        for other in ("labels", "benchmark"):
            spark.read.parquet(f"{BASE}/{other}.parquet").write.parquet(f"{base}/{name}/{other}.parquet")
        out = corpus_pipeline.run(spark, f"{base}/{name}")
        assert out.columns == [*odd.columns, "score", "first", "record", "size", "shard", "slot"]
        got = out.collect()
        assert {r.record for r in got} <= {"r"} and bool(got) == (name == "odd")
