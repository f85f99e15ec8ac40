"""Mixing, sharding and line rules on small tables."""

import re
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from wordsieve.llm import line_rules, mixing, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shares(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing again and again, as the rule is worded."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        target = {s: weight[s] * left / sum(weight[r] for r in rest) for s in rest}
        above = [s for s in rest if target[s] >= most * sizes[s]]
        if not above:
            return fixed | target
        fixed |= {s: most * sizes[s] for s in above}


def mixed_rows(rng):
    rows = []
    for k in range(400):
        source = rng.choice(["a", "B", "ä", "c", None, "hot", "hot", "hot"])
        rows.append((k, prose(rng, rng.choice([1, 5, 30, 300])), source))
    return rows + [(400, None, "a"), (401, "", "void"), (402, " \n", "void"), (403, "one", "tiny"), (403, "one", "tiny")]


def test_mixing_meets_its_targets(docs, rng):
    rows = mixed_rows(rng)
    got = mixing.mix(docs(rows)).collect()
    assert len(got) == len(rows)
    sizes, taken, biggest = Counter(), Counter(), Counter()
    for r in got:
        assert r.size == len(WORD.findall(r.text or "")) and r.taken == r.copies * r.size and 0 <= r.copies <= 3
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        biggest[r.source] = max(biggest[r.source], r.size)
    want = shares(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    assert all(abs(taken[s] - want[s]) <= biggest[s] for s in sizes)
    again = mixing.mix(docs(rows).repartition(7)).select("doc_id", "copies").collect()
    assert Counter((r.doc_id, r.copies) for r in got) == Counter(map(tuple, again))
    assert mixing.emit(mixing.mix(docs(rows))).count() == sum(r.copies for r in got)


def test_mixing_clashing_names_and_empty_table(docs):
    df = docs([(1, "a b", "s")]).withColumns({"size": F.lit("x"), "target": F.lit("x"), "rate": F.lit(1), "slice": F.lit(2)})
    row = mixing.mix(df).first()
    assert (row.size, row.target, row.copies, row.slice) == (2, 2.0, 1, 2)
    assert mixing.mix(docs([])).collect() == []


def test_shuffle_keeps_all_rows_and_deals_evenly(docs, rng):
    rows = [(k, prose(rng, 5), "s") for k in range(300)] + [(7, "same", None)] * 300 + [(None, None, None)] * 20
    df = docs(rows).withColumn("shard", F.lit("old"))
    out = sharding.external_shuffle(df, shards=7, bucket_rows=50)
    got = out.collect()
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter(rows)
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    # Copies of one row are spread, and rows stand in another order than they came.
    assert max(Counter(r.shard for r in got if r.text == "same").values()) < 100
    first = [r.doc_id for r in sorted(got, key=lambda r: r.slot) if r.shard == 0 and r.text != "same"]
    assert first != sorted(first, key=lambda x: (x is None, x))


def test_shuffle_repeats_itself_and_writes_shards(spark, docs, rng, tmp_path):
    df = docs([(k, prose(rng, 5), "s") for k in range(100)]).coalesce(1)
    out = sharding.external_shuffle(df, shards=4)
    assert sorted(out.collect()) == sorted(out.collect())
    sharding.write_shards(out, str(tmp_path / "shards"), 4)
    assert sorted(p.name for p in (tmp_path / "shards").glob("shard=*")) == [f"shard={k}" for k in range(4)]
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 100
    assert sharding.external_shuffle(docs([])).collect() == []


def test_shards_are_written_in_slot_order_by_whole_rows(spark, docs, rng, tmp_path):
    rows = [(k, prose(rng, 5), "s") for k in range(300)] + [(None, None, None)] * 20
    out = sharding.external_shuffle(docs(rows), shards=4, bucket_rows=50)
    sharding.write_shards(out, str(tmp_path / "shards"), 4)
    found = []
    for shard in range(4):
        files = sorted((tmp_path / "shards" / f"shard={shard}").glob("*.parquet"))
        held = [r for f in files for r in pq.ParquetFile(f).read().to_pylist()]
        assert [r["slot"] for r in held] == list(range(80))
        found += held
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in found) == Counter(rows)


def brute_features(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_features_equal_brute_force(docs, rng):
    texts = [prose(rng, rng.randint(1, 80), 4) for _ in range(30)]
    texts += [None, "", " \n\t ", "é ü x", "a b c d e a b c d e", "a a a a a a a a", "x\ny\nx\nx \n\n", "a # | b\r\na # | b\r", "🙂 🙂"]
    texts += [t + "\n" + t for t in texts[:10]] + [" ".join(["w"] * 5000), "1 2 3 4 5 6 1 2 3 4 5 9 2 3 4 5 6"]
    got = line_rules.rules(docs([(k, t, "s") for k, t in enumerate(texts)]), docs_per_line=10**6).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute_features(texts[r.doc_id])
        assert tuple(r[c] for c in line_rules.FEATURES) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and r.kept == (not r.base_failed)


def test_lines_of_many_documents_of_a_host_go(docs, rng):
    common, other = "Read 12 more  stories", "read 9999 more stories "
    rows = [(k, f"{common}\n{prose(rng, 30)}", "a") for k in range(6)] + [(k, f"{prose(rng, 30)}\n{other}", "a") for k in range(6, 12)]
    rows += [(20, f"{common}\n{prose(rng, 30)}", "b"), (21, "\n".join([common] * 4) + "\n" + "one two three four", "a")]
    rows += [(30, "x y\n" + prose(rng, 30), None)] * 12
    got = {r.doc_id: r for r in line_rules.rules(docs(rows), docs_per_line=10, keep_text=True).collect()}
    assert all(got[k].n_removed_words == 4 and got[k].kept for k in range(12))
    assert common not in got[0].clean_text and got[0].clean_text.count(" ") == 29
    assert got[20].n_removed_words == 0 and got[20].clean_text == got[20].text
    assert got[21].n_removed_words == 16 and not got[21].kept
    # Rows that repeat an id are rows of their own; null hosts are one host.
    assert got[30].n_removed_words == 32


def test_rules_clashing_names_and_empty_table(docs):
    df = docs([(1, "a b c", "s")]).withColumns({"n_words": F.lit("x"), "key": F.lit("k"), "words": F.lit("w"), "line": F.lit("l")})
    row = line_rules.rules(df).first()
    assert (row.n_words, row.key, row.words, row.line) == (3, "k", "w", "l")
    assert line_rules.rules(docs([])).collect() == []
