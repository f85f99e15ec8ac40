"""The main text of web pages by line-block distribution."""

from __future__ import annotations

import html
import re
from collections.abc import Collection, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordsieve.llm.common import map_text

# Lines to a window, and the weight of a window at which a surge begins; below it is a dive.
WINDOW = 3
SURGE = 40
# A line of which links hold this share or more is a menu.
LINKED = 0.6

# Elements by their part in a page.
HIDDEN = {"script", "style", "noscript", "template", "svg", "math", "head", "title", "iframe", "object", "canvas", "audio", "video", "select", "textarea"}
FRAME = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "fieldset"}
ARTICLE = {"article", "main"}
BREAKS = {
    "address", "article", "aside", "blockquote", "body", "br", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre",
    "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "title",
}
# Elements of prose: their lines weigh SURGE more, so that a short one is text too.
PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "blockquote", "pre", "figcaption", "caption", "summary"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
# Elements that hold a page or an article, whatever their classes say.
WHOLE = {"html", "body"} | ARTICLE
# Names in a class, id or role that mark a part of the page which is no article. A name counts as a whole: it is made up of
# such words and of plain words for parts of a page, so that "has-sidebar", "tag-news" or "menu-closed" on a wrapper mark nothing.
MARK = (
    r"ad|ads|advert[a-z]*|sponsor[a-z]*|promo[a-z]*|banner|cookies?|cookie(?:bar|consent|law|notice)|consent|gdpr|notice|popup|modal|newsletter|subscribe|signup|"
    r"comments?|commentlist|disqus[a-z]*|replies|reply|respond|sidebar|side-bar|widgets?|related|recommend[a-z]*|share|sharing|social|nav|navbar|menus?|"
    r"breadcrumbs?|pagination|pager|footer|copyright|masthead|site-header|page-header|navigation|complementary|contentinfo|search|toolbar|tag-list|tags"
)
PART = r"site|page|main|top|bottom|primary|secondary|global|area|list|box|block|bar|section|container|wrapper|wrap|inner|form|posts?|articles?|links?|items?|buttons?|text|title|message|thread|slot|unit|\d+"
MARKS = re.compile(rf"(?:(?:{PART})[_-]+)*(?:{MARK})(?:[_-]+(?:{MARK}|{PART}))*", re.A)
# The inside of a tag. Quotes bound a value behind an equals sign only; a tag, value or comment that isn't closed goes on to the
# end of the page, so that no match fails after reading on, and the work is linear in the page.
INSIDE = r"(?:[^>=]|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?)*+"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|textarea)\b{INSIDE}(?:>.*?(?:</\1\s*>|\Z)|\Z)"
    rf"|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)({INSIDE})(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|aria-hidden|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
# An element of these ends one of its kind that is still open, and any open inline element.
ENDS_P = BREAKS - {"br"}


def hidden(name: str, attributes: str) -> bool:
    """Whether an element is never seen."""
    if name in HIDDEN:
        return True
    found = ATTRIBUTE.findall(attributes) if name not in WHOLE else []
    return any(k.lower() == "hidden" or k.lower() == "aria-hidden" and "".join(v).lower() == "true" for k, *v in found)


def aside(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element holds no part of the article."""
    if name in WHOLE:
        return False
    if name in FRAME or name == "header" and not in_article or hidden(name, attributes):
        return True
    return any(
        MARKS.fullmatch(word) for key, *values in ATTRIBUTE.findall(attributes) if key.lower() in ("class", "id", "role") for word in "".join(values).lower().split()
    )


class Frames:
    """The frames of a page by the place of their tag: what they hold, to tell which are wrappers of the page instead."""

    def __init__(self) -> None:
        self.names: dict[int, str] = {}
        self.chars: dict[int, int] = {}
        self.with_article: set[int] = set()
        self.total = 0
        # An article stands outside all frames.
        self.article_outside = False

    def wrappers(self) -> set[int]:
        """Forms that hold an article or half of the page's text; any frames that hold the articles, if none is elsewhere."""
        forms = {at for at, name in self.names.items() if name == "form"}
        wide = {at for at in forms if 2 * self.chars.get(at, 0) >= self.total}
        return wide | (self.with_article & forms if self.article_outside else self.with_article)


def lines(page: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Lines of a page with their text, their weight, and whether an article holds them.

    Markup goes, and every block element and line break ends a line. A line weighs its length, and SURGE more in an element
    of prose; one that is mostly links weighs nothing. What is in a frame has no text and, where it is a line by itself, no
    weight. A frame that wraps the page is none.
    """
    frames = Frames()
    found = parsed(page, frames)
    wrappers = frames.wrappers()
    return parsed(page, Frames(), wrappers) if wrappers else found


def parsed(page: str, seen: Frames, spared: Collection[int] = (), unframed: bool = False) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The lines of a page; the ``spared`` elements are no frames, nor any but hidden ones if ``unframed``."""
    texts: list[str] = []
    weights: list[int] = []
    inside: list[bool] = []
    held: list[str] = []
    linked = dropped = 0
    # Open elements: name, whether it is a frame, place; and how many of the open ones are frames, hidden, articles, links.
    opened: list[tuple[str, bool, bool, int, int]] = []
    frames = unseen = articles = links = 0
    # Where the open elements of a name are, those that end lines, and the places of the open frames.
    named: dict[str, list[int]] = {}
    breaking: list[int] = []
    framing: list[int] = []

    def end_line() -> None:
        nonlocal linked, dropped
        text = " ".join(html.unescape("".join(held)).split()) if held else ""
        if text:
            menu = not articles and linked >= LINKED * len(text)
            prose = bool(breaking) and opened[breaking[-1]][0] in PROSE
            texts.append(text)
            weights.append(0 if menu else len(text) + prose * SURGE)
            inside.append(articles > 0)
        elif dropped:
            # A line of a frame.
            texts.append("")
            weights.append(0)
            inside.append(False)
        held.clear()
        linked = dropped = 0

    def close(upto: int) -> None:
        nonlocal frames, unseen, articles, links
        while len(opened) > upto:
            name, framed, out_of_sight, place, before = opened.pop()
            named[name].pop()
            if name in BREAKS:
                breaking.pop()
            if framed:
                framing.pop()
            frames -= framed
            unseen -= out_of_sight
            if framed:
                seen.chars[place] = seen.total - before
            articles -= name in ARTICLE
            links -= name == "a"

    at = 0
    for token in TOKEN.finditer(page):
        if not unseen and token.start() > at:
            there = len(page[at : token.start()].strip())
            seen.total += there
            dropped += there * (frames > 0)
        if not frames and token.start() > at:
            held.append(page[at : token.start()])
            linked += (token.start() - at) * (links > 0)
        at = token.end()
        name = (token[3] or "").lower()
        if not name:
            continue
        if name in BREAKS:
            end_line()
        if token[2]:
            at_name = named.get(name)
            # A closing inline tag doesn't reach beyond the block that it stands in.
            if at_name and (name in BREAKS or not breaking or at_name[-1] > breaking[-1]):
                close(at_name[-1])
        elif name not in VOID:
            if name in BREAKS and breaking:
                # Paragraphs and items may be left open.
                around, framed, *_ = opened[breaking[-1]]
                if around == "p" and not framed or around == name in ("li", "td", "th", "tr", "dt", "dd"):
                    close(breaking[-1])
            out_of_sight = hidden(name, token[4] or "") and token.start() not in spared
            framed = out_of_sight if unframed else aside(name, token[4] or "", articles > 0) and token.start() not in spared
            if name in ARTICLE:
                seen.article_outside |= not frames
                # Frames around one that is known to hold an article are known too.
                for place in reversed(framing):
                    if place in seen.with_article:
                        break
                    seen.with_article.add(place)
            if framed:
                seen.names[token.start()] = name
                framing.append(token.start())
            named.setdefault(name, []).append(len(opened))
            if name in BREAKS:
                breaking.append(len(opened))
            opened.append((name, framed, out_of_sight, token.start(), seen.total))
            frames += framed
            unseen += out_of_sight
            articles += name in ARTICLE
            links += name == "a"
    if not unseen:
        seen.total += len(page[at:].strip())
    if not frames and at < len(page):
        held.append(page[at:])
    end_line()
    close(0)
    return texts, np.array(weights, np.int64), np.array(inside, bool)


def spans(texts: list[str], weights: np.ndarray) -> list[str]:
    """The lines that weigh, from where a window of lines surges to SURGE to where one dives below it."""
    total = np.concatenate([[0], np.cumsum(weights)])
    n = len(texts)
    # blocks[k]: weight of the window of lines that starts at k.
    blocks = total[np.minimum(np.arange(n) + WINDOW, n)] - total[:-1]
    kept, open_span = [], False
    for k in range(n):
        # A window that begins with an empty line surges for the lines after it.
        open_span = blocks[k] >= SURGE and (open_span or weights[k] > 0)
        if open_span and weights[k]:
            kept.append(texts[k])
    return kept


def main_text(page: str | None) -> str:
    """The text between the surges and the dives of the line blocks, its lines joined by a newline.

    Line blocks are the weights of windows of WINDOW lines. Tags and classes only change what a line weighs: where a page marks
    an article, lines in it weigh SURGE more, so that they surge by themselves, and the others nothing. Of the spans, all are
    kept: an article may be broken by an advert. Without a mark the end of an article is where its windows dive, so that
    a short notice in a plain block after it is no text. Where nothing surges, all lines that weigh are the text; where frames leave nothing, the
    spans are those of all lines that are not hidden.
    """
    texts, weights, inside = lines(page or "")
    if (weights[inside] > 0).any():
        weights = np.where(inside & (weights > 0), weights + SURGE, 0)
    kept = spans(texts, weights)
    if not kept:
        # A page of less text than any surge: what weighs is its text.
        kept = [t for t, w in zip(texts, weights) if w]
    if not kept:
        texts, weights, _ = parsed(page or "", Frames(), unframed=True)
        kept = spans(texts, weights)
    return "\n".join(kept)


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """The columns of ``pages`` but the html, with text and n_chars (code points) of each whole page.

    Null and empty pages, and pages without text, give an empty text. Character references are decoded, white space
    inside a line is one blank. Nothing is shuffled; an empty table gives an empty result.
    """
    out = T.StructType([T.StructField("text", T.StringType())])

    def compute(found: Sequence[str | None]) -> list[pa.Array]:
        return [pa.array([main_text(x) for x in found], pa.string())]

    return map_text(pages, html_column, out, lambda: compute).withColumn("n_chars", F.length("text").cast("long"))
