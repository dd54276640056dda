"""Main text of web pages by line-block distribution.

Markup is stripped so that every block of text becomes one line. The lengths of the lines, summed
over a sliding window, rise steeply where the main text begins (surge) and fall to little where it
ends (dive); the text from the first surge to the last dive is kept, without the links of a stretch
that is mostly links. What markup itself names as menu, header, footer, sidebar, notice, advert,
form, script, style or comment counts as no text, unless it holds the article. Surge and dive are located on every
page, and move to the first and last line of the elements that hold the dense text, whatever these are called: so
short lines at either end stay in and neighbours do not. A heading right above joins the text; only lines that are links
for the most part stay out. Where an element names the article, what windows reach beyond it goes again.
"""

from __future__ import annotations

import html
import itertools
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from promolens.llm.common import chunks

#: Lines in a window, and code points in it from which a window counts as dense.
WINDOW, DENSE = 3, 80

#: Elements whose content is never shown as text; it may hold anything up to the end tag.
RAW = frozenset({"script", "style", "noscript", "template", "textarea", "iframe", "svg", "title"})
#: Those that reach to the page's end without an end tag; for the others a start tag without one counts for nothing.
TO_END = frozenset({"script", "style", "textarea", "title"})
#: Those that are not even a gap in the text around them.
HIDDEN = frozenset({"script", "style", "noscript", "template"})
#: Elements around the main text.
CHROME = frozenset({"nav", "footer", "aside", "form", "dialog", "menu", "select", "head", "label"})
#: Text in these is a line's only beside other text; they do not end it.
CONTROLS = frozenset({"button"})
#: Those that may be around all of a page.
DOUBTFUL = frozenset({"form"})
#: Words in class, id or role that say the same of any other element, if its whole name is made of them and of
#: words for pieces and places: "site-footer" and "ad-box", but not "has-sidebar" or "comments-open".
CHROME_WORDS = frozenset(
    """ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
    consent cookie cookies disclaimer footer header masthead menu modal nav navbar navigation
    newsletter notice notices notification popup promo promotion related replies reply respond share
    sharing sidebar social sponsor sponsored subscribe subscription toolbar widget widgets""".split()
)
#: What names the article: elements, which are roles as well, and one itemprop.
PIECES = frozenset(
    """area bar block bottom box button buttons center col column container cta desktop form global google group
    holder icons inner item items law left link links list main mobile outer page panel post posts primary right
    row secondary section signup site slot strip tab thread top unit wrap wrapper x""".split()
)
#: Those whose elements hold much text of their own, which is not the page's.
OTHERS = frozenset(
    """comment comments consent cookie cookies disclaimer newsletter notice notices related replies reply
    respond""".split()
)
ARTICLE = frozenset({"article", "main"})
ARTICLE_BODY = "articlebody"
HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})
#: Blocks that belong to the text of the element around them; all others hold a text of their own.
TEXT_BLOCKS = HEADINGS | frozenset(
    """address blockquote caption dd details dl dt figcaption figure hgroup li ol p pre summary table tbody td tfoot
    th thead tr ul""".split()
)
#: Lines between a heading and the text below it, such as a byline and a date.
BYLINES = 2
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements inside a line; every other tag ends it.
INLINE = frozenset(
    """a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt
    ruby s samp small span strike strong sub sup time tt u var wbr
    math menclose mfrac mi mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup
    mtext munder munderover semantics""".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?P<shut>>|\Z)|(?P<text>[^<]+|<(?![a-zA-Z/!?]))",
    re.DOTALL,
)
#: The same where a quote in a tag is never closed.
LOOSE = re.compile(r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>[^>]*)(?:>|\Z)|<(?P<text>)[^>]*(?:>|\Z)")
NAMED = re.compile(
    r"""(?<![^\s"'/])(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|"[^"]*"|'[^']*'""", re.IGNORECASE
)
WORDS = re.compile(r"[a-z]+")


def _marks(attrs: str) -> tuple[set[str], str]:
    """The words of class, id and role that name chrome, and "main" or "article" if role or itemprop name the article."""
    words: set[str] = set()
    names = ""
    for m in NAMED.finditer(attrs):
        kind, values = (m[1] or "").lower(), (m[2] or m[3] or m[4] or "").lower().split()
        if kind in ("class", "id", "role"):
            for v in values:
                parts = set(WORDS.findall(v))
                if parts & CHROME_WORDS and parts <= CHROME_WORDS | PIECES:
                    words |= parts & CHROME_WORDS
        if kind == "role" and "main" in values or kind == "itemprop" and ARTICLE_BODY in values:
            names = "main"
        elif kind == "role" and "article" in values:
            names = names or "article"
    return words, names


@dataclass(slots=True)
class Chrome:
    """An element around the main text, or so its markup says."""

    parent: int  # the one around it, -1: none
    doubtful: bool  # it and those around it may hold the main text after all
    others: bool  # it, or one around it, has much text that is not the page's
    body: bool = False  # a main element or an article's body begins in it


class Line(NamedTuple):
    text: str
    home: int  # the innermost element around it that holds a text of its own, 0: the page
    heading: bool
    article: int  # the outermost element around it that names the article, from 1; 0: none
    chrome: int  # the innermost chrome around it, -1: none
    linked: int  # how many of its characters are in links


def lines_of(page: str) -> tuple[list[Line], list[Chrome]]:
    """The page's lines of text in order, with those of doubtful chrome, and its elements of chrome."""
    lines: list[Line] = []
    parts: dict[int, list[str]] = {}  # of the line, for each chrome
    linked: Counter[int] = Counter()  # characters of them in links
    pressed: Counter[int] = Counter()  # characters of them in buttons
    open_: list[tuple[str, int, bool, int]] = []  # tag, chrome around it, article, home around it
    depth: Counter[str] = Counter()  # how many of a tag are open
    found: list[Chrome] = []
    endless: set[str] = set()  # tags that have no end tag any more
    chrome, article, articles = -1, 0, 0
    home, homes = 0, 0
    at, size = 0, len(page)

    def close() -> str:
        nonlocal chrome, article, home
        tag, chrome, a, home = open_.pop()
        depth[tag] -= 1
        article -= a
        return tag

    def end_line() -> None:
        # references are decoded per line: "&amp;" next to "lt;" in the next text stays two texts
        heading = any(depth[h] for h in HEADINGS)
        for c, texts in parts.items():
            text = " ".join("".join(texts).split())
            if text and pressed[c] < sum(len(t.strip()) for t in texts):
                lines.append(Line(text, home, heading, articles if article else 0, c, min(linked[c], len(text))))
        parts.clear()
        linked.clear()
        pressed.clear()

    while at < size:
        m = TOKEN.match(page, at) or LOOSE.match(page, at)
        at = m.end()
        if m["text"] is not None:
            if chrome < 0 or found[chrome].doubtful:
                text = html.unescape(m["text"])
                parts.setdefault(chrome, []).append(text)
                if depth["a"]:
                    linked[chrome] += len(text.strip())
                if depth["button"]:
                    pressed[chrome] += len(text.strip())
            continue
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag not in INLINE and tag not in HIDDEN and tag not in CONTROLS:
            end_line()
        elif tag == "br":
            parts.setdefault(chrome, []).append(" ")
        if m["end"]:
            if depth[tag]:
                while close() != tag:
                    pass
            continue
        attrs = m["attrs"]
        if tag in VOID or attrs.endswith("/"):
            continue
        if tag in RAW:
            shut = None
            if tag not in endless:
                shut = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
            if shut:
                at = shut.end()
            elif tag in TO_END:
                at = size
            else:
                endless.add(tag)
            continue
        if tag == "body":  # a head that was never closed ends here
            while open_:
                close()
        marks, names = _marks(attrs) if "=" in attrs else (set(), "")
        if article:
            marks.discard("header")  # the article's own
        is_article = tag in ARTICLE or bool(names)
        # an article inside an article may be a comment on it
        exempt = tag in ("html", "body", "main") or is_article and not article
        says_chrome = bool(marks) and not exempt
        is_article = is_article and not says_chrome
        certain = tag in CHROME - DOUBTFUL or (tag == "header" and not article)
        if tag in ("p", "li", "td", "th", "tr", "dt", "dd", "option", "a"):
            # these close the one before them where its end tag was left out
            if open_ and open_[-1][0] == tag:
                close()
        open_.append((tag, chrome, is_article, home))
        depth[tag] += 1
        if tag not in INLINE and tag not in TEXT_BLOCKS and tag not in ("html", "body", "button"):
            homes += 1
            home = homes
        if certain or says_chrome or tag in DOUBTFUL:
            around = found[chrome] if chrome >= 0 else Chrome(-1, True, False)
            others = around.others or bool(marks & OTHERS)
            found.append(Chrome(chrome, around.doubtful and not certain, others))
            chrome = len(found) - 1
        elif chrome >= 0 and is_article and "main" in (tag, names):
            found[chrome].body = True
        articles += is_article and not article
        article += is_article
    end_line()
    return lines, found


def shown(lines: Sequence[Line], found: Sequence[Chrome], window: int = WINDOW, dense: int = DENSE) -> list[set[int]]:
    """The chrome whose lines count as text: what holds the article, and, if there is such, also what has more
    dense text than all else."""
    kept = {-1}

    def keep(c: int, into: set[int]) -> None:
        while c not in into:
            into.add(c)
            c = found[c].parent

    size: Counter[int] = Counter()  # characters of the lines right in each chrome
    named: Counter[tuple[int, int]] = Counter()  # and of those of each article in it
    for line in lines:
        size[line.chrome] += len(line.text)
        if line.article:
            named[line.chrome, line.article] += len(line.text)
    if len(size.keys() | kept) == 1:
        return [kept]
    for c, x in enumerate(found):
        if x.body and x.doubtful:
            keep(c, kept)
    seen = {a for c, a in named if c in kept}
    if not any(n >= dense for (c, _), n in named.items() if c in kept):
        hidden = Counter(c for (c, a), n in named.items() if n >= dense and a not in seen)
        for c, n in hidden.items():
            if n == 1 and not found[c].others:  # several are a list of articles
                keep(c, kept)
    if any(c in kept for c, _ in named):
        return [kept]
    rest = sum(n for c, n in size.items() if c in kept)
    more = set(kept)
    own: dict[int, list[int]] = {}  # the lengths of the lines right in each chrome
    for line in lines:
        own.setdefault(line.chrome, []).append(len(line.text))
    for c, n in size.items():
        if c not in kept and n > rest and not found[c].others:
            lengths = own[c]
            if max(sum(lengths[i : i + window]) for i in range(len(lengths))) >= dense:
                keep(c, more)
                rest = n
    return [kept, more] if len(more) > len(kept) else [kept]


def dense_lines(lengths: np.ndarray, linked: np.ndarray, window: int = WINDOW, dense: int = DENSE) -> np.ndarray:
    """For each line whether it is between the first surge and the last dive and no link in a gap of links.

    All lines are if no window is dense.
    """
    n = len(lengths)
    total = np.concatenate([[0], np.cumsum(lengths)])
    ends = np.minimum(np.arange(n) + window, n)
    sums = total[ends] - total[:n]  # of the window that begins at each line
    thick = sums >= dense
    if not thick.any():
        return np.ones(n, np.bool_)
    # a surge begins a run of dense windows, its dive is the last line before the run's end that any window covers
    steps = np.diff(np.concatenate([[0], thick.astype(np.int8), [0]]))
    surges, dives = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    stops = np.minimum(dives + window - 1, n)
    links = np.concatenate([[0], np.cumsum(linked)])

    def in_links(first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return 2 * (links[last] - links[first]) > total[last] - total[first]

    text = ~in_links(surges, stops)
    if text.any():
        surges, stops = surges[text], stops[text]
    # a short stretch in the text does not end it
    broken = np.flatnonzero(in_links(stops[:-1], np.maximum(surges[1:], stops[:-1])))
    firsts, lasts = surges[np.concatenate([[0], broken + 1])], stops[np.concatenate([broken, [len(stops) - 1]])]
    keep = np.zeros(n, np.bool_)
    keep[firsts[0] : lasts[-1]] = True
    for first, last in zip(lasts[:-1], firsts[1:]):
        keep[first:last] = 2 * linked[first:last] <= lengths[first:last]
    return keep


def joined(keep: np.ndarray, lines: Sequence[Line], window: int = WINDOW, dense: int = DENSE) -> np.ndarray:
    """``keep`` and the lines that belong to it: those in the elements that hold its dense text, and headings right above.

    Neither may be a link for the most part. Lists, bylines and short lines at either end stay in by that, however many.
    """
    text: Counter[int] = Counter()
    for line, k in zip(lines, keep, strict=True):
        if k and 2 * line.linked <= len(line.text):
            text[line.home] += len(line.text)
    most = max(text.values(), default=0)
    # an element that merely reaches into the last window is none of them
    homes = {h for h, n in text.items() if n >= dense and 4 * n >= most or n == most}
    out = keep | np.fromiter((x.home in homes and 2 * x.linked <= len(x.text) for x in lines), np.bool_, len(lines))
    if 2 * sum(len(x.text) for x, o in zip(lines, out, strict=True) if o and x.article) >= sum(
        len(x.text) for x, o in zip(lines, out, strict=True) if o
    ):
        # an element that names the article corrects the bounds: lines that windows reach beyond it go
        named = [i for i, x in enumerate(lines) if out[i] and x.article]
        if named:
            out[: named[0]] = out[named[-1] + 1 :] = False
            return out
    for i in range(len(lines) - 1, 0, -1):
        if not out[i] or out[i - 1]:
            continue
        for j in range(i - 1, max(-1, i - 2 - BYLINES), -1):
            if out[j] or 2 * lines[j].linked > len(lines[j].text):
                break
            if lines[j].heading:
                out[j:i] = True
                break
    return out


def main_lines(lines: Sequence[Line]) -> np.ndarray:
    """For each line whether it is main text."""
    lengths = np.fromiter((len(x.text) for x in lines), np.int64, len(lines))
    linked = np.fromiter((x.linked for x in lines), np.int64, len(lines))
    return joined(dense_lines(lengths, linked), lines)


def main_text(page: str) -> str:
    lines, found = lines_of(page)
    keep = np.zeros(len(lines), np.bool_)
    for chrome in shown(lines, found):
        at = [i for i, x in enumerate(lines) if x.chrome in chrome]
        keep[np.array(at, np.int64)[main_lines([lines[i] for i in at])]] = True
    return "\n".join(x.text for x, k in zip(lines, keep, strict=True) if k)


def html_text(
    pages: DataFrame, *, page_id: str = "page_id", page: str = "html", keep: Sequence[str] = ()
) -> DataFrame:
    """``page_id``, the columns to ``keep`` and the main text, as ``text``, for every row of ``pages``.

    White space in a line is one space, lines are joined by a line feed; nothing in the main text
    is cut. A NULL or empty page has the empty text, and so has one without any text. Repeated rows
    come out as often as they go in, columns that are not named are left out, an empty table gives
    an empty result. ``keep`` cannot name a column ``text``.
    """
    if "text" in (page_id, *keep):
        raise ValueError("a column to keep is named text, as the result")
    carried = [page_id, *keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(carried).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(carried))
            sizes = pc.fill_null(pc.utf8_length(column), 0).to_pylist()
            for part in chunks([range(n) for n in sizes]):
                n = part.stop - part.start
                texts = [main_text(p or "") for p in column.slice(part.start, n).to_pylist()]
                columns = [batch.column(i).slice(part.start, n) for i in range(len(carried))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*carried, "text"])

    return pages.select(*carried, page).mapInArrow(run, f"{schema}, text string")
