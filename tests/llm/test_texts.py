"""Token counts, page text and decontamination."""

import random
import time
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import prose
from wordsieve.llm import decontaminate, html_text, token_counts

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(*token_counts.load(VOCABULARY))


def agree(counter, library, texts):
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [(t, int(n)) for t, n in zip(texts, counter(texts))] == list(zip(texts, want))


def test_counts_equal_the_library_on_mixed_text(counter, library):
    rng = random.Random(1)
    bits = ["'", "'s", "'re", "'r", "'ll", "'l", " ", "  ", "\n", "\t", "a", "the", "Hello", "12", "é", "日本", "!", "<|endoftext|>", "<|", "😀", " ", "́", "\x1c", "\x85", "_", "'M", "aaaa", "　", "\0"]
    agree(counter, library, ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(4000)])
    agree(counter, library, ["".join(rng.choice("abcdetn s") for _ in range(rng.randint(0, 200))) for _ in range(500)])


def test_counts_of_every_code_point(counter, library):
    agree(counter, library, [f"a{c}{c}b {c} 1{c}." for c in map(chr, range(1, 0x3000)) if not "\ud800" <= c <= "\udfff"])


def test_chunks_compose_at_any_length(counter, library, monkeypatch):
    text = "It's   we'll 'tis\n\n x're'r 'v 12 " * 40
    texts = [text[:n] for n in range(0, 700, 7)]
    for lane in (1, 2, 3, 64):
        monkeypatch.setattr(token_counts, "LANE", lane)
        agree(counter, library, texts)


def test_tables_may_start_anew(library, monkeypatch, rng):
    monkeypatch.setattr(token_counts, "MOST_STATES", 10)
    monkeypatch.setattr(token_counts, "MOST_WORDS", 10)
    agree(token_counts.Counter(*token_counts.load(VOCABULARY)), library, [prose(rng, 50) for _ in range(20)])


def test_long_text_and_table_cases(docs, library, rng):
    long = prose(rng, 300_000) + "x" * 50_000
    rows = [(1, long, "s"), (2, None, "s"), (2, "", "s"), (None, "one two", "s"), (None, "one two", "s")]
    df = docs(rows).withColumns({"n_tokens": F.lit("old"), "over_limit": F.lit("old")})
    got = token_counts.token_counts(df, VOCABULARY).collect()
    want = len(library.encode(long, add_special_tokens=False).ids)
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == [(0, 7, 2, False)] * 2 + [(1, len(long.encode()), want, True)] + [(2, 0, 0, False)] * 2
    assert token_counts.token_counts(docs([]), VOCABULARY).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var t="</p>";</script></head><body>
<div class="cookie-notice">We use cookies to make this page work as well as it does for you.</div>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><header><h2>The Daily Page, all the news that there is</h2></header>
<!-- ad --><div class="ad">Buy this now, it is very cheap and very good, and you need it.</div>
<article><h1>Caf&eacute;  &lt;open&gt;</h1><p>First <b>bold</b>\n line with a <a href="x">link</a> in it.
<p>Second &#8212; paragraph.<br>After the break.<aside>Read also: another long story of ours.</aside><ul><li>item one<li>item two</ul>
<form><p>Your mail</p><input name=q></form><blockquote>Quoted.</blockquote></article>
<section id="comments"><p>Reader: I do not agree with any word of this long article.</p></section>
<footer>&copy; 2020 all rights reserved by the owner of this page</footer></body></html>"""


def test_marked_article():
    assert html_text.main_text(PAGE) == "Café <open>\nFirst bold line with a link in it.\nSecond — paragraph.\nAfter the break.\nitem one\nitem two\nQuoted."


def test_article_without_marks_is_found_by_its_blocks():
    body = "".join(f"<p>Sentence number {k} of the article, which is long enough to weigh.</p>" for k in range(6))
    menu = "".join(f'<li><a href="/{k}">Topic {k}</a></li>' for k in range(8))
    page = f"<body><ul>{menu}</ul><p>Hi</p>{body}<ul>{menu}</ul></body>"
    assert html_text.main_text(page).split("\n")[-6:] == [f"Sentence number {k} of the article, which is long enough to weigh." for k in range(6)]
    assert "Topic" not in html_text.main_text(page)


STORY = "".join(f"<p>Sentence number {k} of the article, which is long enough to weigh.</p>" for k in range(3))
TOLD = html_text.main_text(f"<article>{STORY}</article>")


@pytest.mark.parametrize(
    ("before", "after"),
    [
        ('<body class="no-sidebar"><article>', "</article></body>"),
        ('<body class="sidebar ads"><main id="nav">', "</main></body>"),
        ('<body><article class="post comments-open tag-news tags">', "</article></body>"),
        ('<body><div class="site menu-closed"><div class="content with-sidebar">', "</div></div></body>"),
        ('<body><div class="has-sidebar">', "</div></body>"),
        ('<body><form id="aspnetForm"><nav>Home</nav><div>', "</div></form></body>"),
        ('<body><form><article>', "</article></form></body>"),
        ('<body><div class="widget"><article>', "</article></div></body>"),
        ('<body><div class="widget">', "</div></body>"),
        ('<body><div class="ad"><main>', "</main>"),
    ],
)
def test_wrappers_of_the_page_are_no_frames(before, after):
    assert html_text.main_text(before + STORY + after) == TOLD


def test_frames_beside_the_article_stay_out():
    remark = "<p>Reader: I do not agree with any word of this long article, not with one.</p>"
    for frame in ('<section id="comments">', '<div class="comments-area">', '<div class="box sidebar">', '<div class="related-posts">', '<div class="cookie-notice">'):
        name = frame[1:].split()[0]
        for held in (remark, f"<article>{remark}</article>"):
            assert html_text.main_text(f"<body><article>{STORY}</article>{frame}{held}</{name}></body>") == TOLD
        assert html_text.main_text(f"<body>{STORY}{frame}{remark}</{name}></body>") == TOLD
    assert html_text.main_text(f"<body>{STORY}<form>{remark}</form></body>") == TOLD


def test_odd_pages():
    assert [html_text.main_text(x) for x in (None, "", "   ", "<p></p>", "<nav>menu</nav>", "<script>x")] == [""] * 6
    assert html_text.main_text("plain text only") == "plain text only"
    assert html_text.main_text("<article><p>cut off in the middle of a t") == "cut off in the middle of a t"
    assert html_text.main_text("<article><p>a &lt b &unknown; &#x41;</p></article") == "a < b &unknown; A"
    assert html_text.main_text("<article>" + "<p>one</p>" * 20_000 + "</article>") == "\n".join(["one"] * 20_000)


def test_page_table(spark, docs):
    docs([])
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "x"), (2, None, None, "x")], "page_id long, url string, html string, text string")
    got = html_text.extract(pages).collect()
    assert sorted((r.page_id, r.n_chars) for r in got) == [(1, len(html_text.main_text(PAGE))), (2, 0), (2, 0)]
    assert html_text.extract(pages.limit(0)).collect() == []


def plain(text):
    return "".join(c.lower() if c.isalnum() or ord(c) > 127 else " " for c in text).split()


def brute_matches(text, items):
    """Items of which some window of as many words is similar enough."""
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, plain(t)) for i, t in items) if len(w) >= 5}
    held = Counter(s for own in sets.values() for s in own)
    weight = lambda s: 1 / max(1, held[s])
    words, found = plain(text or ""), set()
    for i, t in items:
        size = len(plain(t))
        if size >= 5:
            for k in range(max(1, len(words) - size + 1)):
                w = words[k : k + size]
                own = {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
                if own and sum(map(weight, own & sets[i])) >= 0.8 * sum(map(weight, own | sets[i])):
                    found.add(i)
    return found


def test_matches_equal_brute_force(rng):
    items = [(k, prose(rng, rng.randint(5, 70))) for k in range(25)] + [(90, "too short"), (91, "")]
    texts = []
    for k in range(160):
        words = prose(rng, rng.randint(0, 120)).split()
        if k % 2:
            own = rng.choice(items[:25])[1].split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 6])):
                own[rng.randrange(len(own))] = "changed"
            own = own[rng.choice([0, 0, 1]) : len(own) - rng.choice([0, 0, 1])]
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() + rng.choice(["", ",", "."]) for w in own]
        texts.append(" ".join(words))
    index = decontaminate.Index(items, 0.8)
    got = [{m["item_id"] for m in found} for found in index.search(texts)]
    want = [brute_matches(t, items) for t in texts]
    assert sum(map(len, want)) > 30
    assert got == want


def test_blocks_of_radius_miss_nothing(rng):
    index = decontaminate.Index([(1, prose(rng, 40))], 0.8)
    (size, (prints, _, _, lookups)), = index.tables.items()
    for _ in range(300):
        flipped = int(prints[0])
        for bit in rng.sample(range(64), decontaminate.RADIUS):
            flipped ^= 1 << bit
        keys = [flipped >> 16 * b & 0xFFFF for b in range(4)]
        assert any(0 in entries[first[k] : first[k + 1]] for k, (_, first, entries) in zip(keys, lookups))


def test_contaminated_table_in_one_or_more_blocks(spark, docs, rng, monkeypatch):
    items = [(k, prose(rng, 30)) for k in range(12)]
    passage = items[4][1]
    long = prose(rng, 80_000) + " " + passage + " " + prose(rng, 500)
    rows = [(1, long, "s"), (2, passage.upper(), "s"), (3, prose(rng, 200), "s"), (4, None, "s"), (4, "", "s"), (None, passage, "s"), (None, passage, "s")]
    table = spark.createDataFrame([*items, (4, passage), (50, None)], "item_id long, text string")
    want = [(-1, [4, 4]), (-1, [4, 4]), (1, [4, 4]), (2, [4, 4]), (3, []), (4, []), (4, [])]
    for size in (1 << 26, 20_000):
        monkeypatch.setattr(decontaminate, "INDEX_BYTES", size)
        df = docs(rows).withColumns({"matches": F.lit("old"), "m": F.lit("m")})
        got = decontaminate.contaminated(df, table).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, [m.item_id for m in r.matches]) for r in got) == want
    assert decontaminate.contaminated(docs([]), table).collect() == []
    assert [r.matches for r in decontaminate.contaminated(docs(rows[2:3]), table.limit(0)).collect()] == [[]]


def jaccard(a, b):
    a, b = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (plain(a), plain(b)))
    return len(a & b) / len(a | b)


@pytest.mark.parametrize(("copies", "size", "edits"), [(2, 50, 1), (2, 60, 1), (10, 100, 2)])
def test_edited_copies_of_equal_items_match_in_one_or_more_blocks(spark, docs, rng, monkeypatch, copies, size, edits):
    passage = [f"w{k}" for k in range(size)]
    items = [(k, " ".join(passage)) for k in range(copies)] + [(90 + k, prose(rng, 40)) for k in range(8)]
    for k in range(edits):
        passage[(k + 1) * size // (edits + 1)] = f"changed{k}"
    edited = " ".join(passage)
    assert 0.8 <= jaccard(edited, items[0][1]) < 0.9
    table = spark.createDataFrame(items, "item_id long, text string")
    found = []
    for most in (1 << 26, 20_000):
        monkeypatch.setattr(decontaminate, "INDEX_BYTES", most)
        got = decontaminate.contaminated(docs([(1, edited, "s"), (2, prose(rng, 60), "s")]), table).collect()
        found.append({r.doc_id: [tuple(m) for m in r.matches] for r in got})
    assert [m[0] for m in found[0][1]] == list(range(copies)) and found[0][2] == []
    assert found[0] == found[1]


def test_shared_passages_give_one_similarity_in_any_blocks(spark, docs, rng, monkeypatch):
    common = prose(rng, 20)
    items = [(k, f"{common} {prose(rng, 40)}") for k in range(10)]
    rows = [(k, " ".join(["another", "beginning"] + t.split()[2:]), "s") for k, t in items]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = []
    for most in (1 << 26, 20_000):
        monkeypatch.setattr(decontaminate, "INDEX_BYTES", most)
        got = decontaminate.contaminated(docs(rows), table).collect()
        found.append({r.doc_id: [tuple(m) for m in r.matches] for r in got})
    assert found[0] == found[1]
    assert all(any(m[0] == k for m in found[0][k]) for k, _ in items)


def test_no_plain_near_copy_is_rejected(rng):
    common = [prose(rng, 20) for _ in range(3)]
    items = [(k, " ".join([rng.choice(common), prose(rng, rng.randint(5, 50)), rng.choice(common)])) for k in range(30)]
    items += [(100 + k, t) for k, t in items[:10]]
    index = decontaminate.Index(items, 0.8)
    for k, (_, text) in enumerate(items):
        for edits in range(4):
            words = plain(text)
            for _ in range(edits):
                words[rng.randrange(len(words))] = "changed"
            (_, hashes), = decontaminate.word_hashes([" ".join(words)], plain=True)
            assert index.similar(k, hashes) >= jaccard(" ".join(words), text)


def test_index_of_short_items_is_bounded(rng):
    """4 MB of items of six words are cut into blocks, whose indexes stay under 200 MB."""
    item = " ".join(["syllab"] * 6)
    n = (4 << 20) // len(item)
    blocks = -(-n * (8 * len(item) + decontaminate.ENTRY_BYTES) // decontaminate.INDEX_BYTES)
    index = decontaminate.Index([(k, f"a{k} b{k * 7} c{k * 3} d{k} e{k * 11} f{k}") for k in range(-(-n // blocks))], 0.8)
    size = sum(a.nbytes for prints, item_, offset, lookups in index.tables.values() for a in (prints, item_, offset, *(x for look in lookups for x in look)))
    size += sum(x.nbytes for own in (index.words, index.shingles, index.weights) for x in own)
    assert size < 200 << 20


@pytest.mark.parametrize(
    "page",
    ["<a " * (1 << 18) + '"', "<b>" * (1 << 17) + "</i>" * (1 << 17), "<i><div>" + "<b>" * (1 << 17) + "</i>" * (1 << 17), '<a href="' * (1 << 16), "<nav>" * (1 << 15) + "<article>" * (1 << 15)],
)
def test_broken_pages_take_linear_time(page):
    started = time.perf_counter()
    html_text.main_text(page)
    assert time.perf_counter() - started < 20


@pytest.mark.parametrize("notice", ["© 2024 Example Press", "All rights reserved.", "Imprint", "Printed on 12 May"])
@pytest.mark.parametrize("tag", ["div", "span", "section", "td"])
def test_short_notices_in_plain_blocks_after_an_unmarked_article_go(notice, tag):
    assert html_text.main_text(f"<body><div>{STORY}</div><{tag}>{notice}</{tag}></body>") == TOLD
    # Within the article, or as prose, a short line is text.
    assert html_text.main_text(f"<body><div>{STORY}</div><p>{notice}</p></body>") == f"{TOLD}\n{notice}"
    assert html_text.main_text(f"<body><article>{STORY}<{tag}>{notice}</{tag}></article></body>") == f"{TOLD}\n{notice}"
