"""Main text of pages: against a plain version, and what must stay and go."""

import random
import time
from html.parser import HTMLParser

import pytest

from promolens.llm.html_text import BYLINES, DENSE, WINDOW, html_text, main_text

LONG = " ".join(["word"] * 60)
BLOCKS = ("div", "section", "p", "h2", "ul", "li", "table", "tr", "td")


class Plain(HTMLParser):
    """Lines of a page of the elements above, links and bold text: [text, linked, home, heading]."""

    def __init__(self):
        super().__init__()
        self.lines, self.homes, self.count, self.text, self.linked = [], [0], 0, "", 0
        self.in_link = self.in_heading = False

    def end(self):
        text = " ".join(self.text.split())
        if text:
            self.lines.append((text, min(self.linked, len(text)), self.homes[-1], self.in_heading))
        self.text, self.linked = "", 0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.end()
        if tag in ("div", "section"):
            self.count += 1
            self.homes.append(self.count)
        self.in_link |= tag == "a"
        self.in_heading |= tag == "h2"

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.end()
        if tag in ("div", "section"):
            self.homes.pop()
        self.in_link &= tag != "a"
        self.in_heading &= tag != "h2"

    def handle_data(self, data):
        self.text += data
        if self.in_link:
            self.linked += len(data.strip())


def plain_text(page):
    """Surge and dive line by line, without arrays."""
    parser = Plain()
    parser.feed(page)
    parser.end()
    lines = parser.lines
    n = len(lines)
    size = [len(x[0]) for x in lines]
    link = [x[1] for x in lines]

    def mostly_links(a, b):
        return 2 * sum(link[a:b]) > sum(size[a:b])

    thick = [sum(size[i : i + WINDOW]) >= DENSE for i in range(n)]
    keep = [True] * n
    if any(thick):
        stretches = []
        for i in range(n):
            if thick[i] and (i == 0 or not thick[i - 1]):
                end = i
                while end < n and thick[end]:
                    end += 1
                stretches.append((i, min(end + WINDOW - 1, n)))
        texts = [s for s in stretches if not mostly_links(*s)] or stretches
        keep = [texts[0][0] <= i < texts[-1][1] for i in range(n)]
        for (_, end), (start, _) in zip(texts, texts[1:], strict=False):
            if start > end and mostly_links(end, start):
                for i in range(end, start):
                    keep[i] = 2 * link[i] <= size[i]
    held = {}
    for i in range(n):
        if keep[i] and 2 * link[i] <= size[i]:
            held[lines[i][2]] = held.get(lines[i][2], 0) + size[i]
    most = max(held.values(), default=0)
    homes = {h for h, k in held.items() if k == most or k >= DENSE and 4 * k >= most}
    inside = [lines[i][2] in homes for i in range(n)]
    out = list(keep)
    out = [o or inside[i] and 2 * link[i] <= size[i] for i, o in enumerate(out)]
    for i in range(n - 1, 0, -1):
        if out[i] and not out[i - 1]:
            for j in range(i - 1, max(-1, i - 2 - BYLINES), -1):
                if out[j] or mostly_links(j, j + 1):
                    break
                if lines[j][3]:
                    out[j:i] = [True] * (i - j)
                    break
    return "\n".join(x[0] for x, o in zip(lines, out, strict=True) if o)


def random_page(r, depth=0):
    parts = []
    for _ in range(r.randrange(1, 7)):
        kind = r.choice(["p", "p", "link", "list", "h2", "div", "section", "table"])
        words = " ".join(f"w{r.randrange(50)}" for _ in range(r.choice([1, 2, 4, 20, 60])))
        if kind in ("div", "section"):
            parts.append(f"<{kind}>{random_page(r, depth + 1) if depth < 3 else words}</{kind}>")
        elif kind == "link":
            parts.append(f"<p>{'and ' * r.randrange(3)}<a href=x>{words}</a></p>")
        elif kind == "list":
            parts.append("<ul>" + "".join(f"<li>{x} <b>{x}</b></li>" for x in words.split()[:9]) + "</ul>")
        elif kind == "table":
            parts.append(f"<table><tr><td>{words}</td><td><a>{words}</a></td></tr></table>")
        else:
            parts.append(f"<{kind}>{words}</{kind}>")
    return "".join(parts)


@pytest.mark.parametrize("seed", range(40))
def test_against_a_plain_version(seed):
    r = random.Random(seed)
    for _ in range(20):
        page = random_page(r)
        assert main_text(page) == plain_text(page), page


def test_no_line_of_an_unnamed_article_is_lost():
    items = [f"item {i}" for i in range(8)]
    listed = "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
    body = f"<p>{LONG}</p>" * 5
    assert main_text(f"<div>{body}{listed}</div>").split("\n") == [LONG] * 5 + items
    top = "<h1>Head</h1><p>By me</p>"
    assert main_text(f"<div>{top}{listed}{body}</div>").split("\n") == ["Head", "By me", *items, *[LONG] * 5]
    around = "<div><a href=a>Home</a> <a href=b>News</a></div>"
    shown = ["Head", "By me", *[LONG] * 5, *items]
    page = f"<body>{around}{top}<div>{body}{listed}</div><div>Copyright</div>{around}</body>"
    assert main_text(page).split("\n") in ([*shown, "Copyright"], shown)  # a window reaches two lines further
    sections = "".join(f"<section><h2>Part {i}</h2><p>{LONG}</p><p>Note {i}</p></section>" for i in range(3))
    expected = [x for i in range(3) for x in (f"Part {i}", LONG, f"Note {i}")]
    assert main_text(f"<div>{sections}</div>").split("\n") == expected
    assert main_text(f"<table><tr><td>{around}</td><td>{top}<p>{LONG}</p></td></tr></table>").split("\n") == ["Head", "By me", LONG]


def test_the_name_of_an_element_only_corrects_the_ends():
    inner = f"<h1>Head</h1><p>{LONG}</p><p>{LONG}</p><p>one</p><p>two</p><p>End</p>"
    expected = ["Head", LONG, LONG, "one", "two", "End"]
    for name in ("article", "main", "div", "section", "center"):
        got = main_text(f"<body><div>Site</div><{name}>{inner}</{name}><div>Legal</div></body>").split("\n")
        assert [x for x in got if x not in ("Site", "Legal")] == expected
        assert name not in ("article", "main") or got == expected


def test_buttons_in_a_sentence_are_text_and_alone_are_not():
    page = f"<article><p>Press <button>OK</button> to go on. {LONG}</p><button>Share</button><div><button>Like</button></div></article>"
    assert main_text(page) == f"Press OK to go on. {LONG}"


@pytest.mark.parametrize("part", ["<div class=ad>x</div>", "<form>x y</form>", "<div><p>x</p></div>", "<nav>x</nav>", "<svg>", "<h2>x</h2>"])
def test_time_grows_with_the_page(part):
    def seconds(n):
        page = f"<body>{part * n}<p>{LONG}</p></body>"
        best = 9.0
        for _ in range(3):
            begun = time.process_time()
            assert LONG in main_text(page)
            best = min(best, time.process_time() - begun)
        return best

    small, large = seconds(4_000), seconds(32_000)
    assert large < 30 * small + 0.5  # squared it would be 64 times


def test_a_long_page(spark):
    page = f"<body><nav>menu</nav><div>{f'<p>{LONG}</p><ul><li>a</li><li>b</li></ul>' * 5_000}</div></body>"
    pages = spark.createDataFrame([(1, page), (2, None)], "page_id int, html string")
    got = {r.page_id: r.text for r in html_text(pages).collect()}
    assert got[1].split("\n") == [LONG, "a", "b"] * 5_000
    assert got[2] == ""


def test_kept_columns_must_not_clash(spark):
    pages = spark.createDataFrame([(1, "<p>x</p>", "mine")], "page_id int, html string, text string")
    with pytest.raises(ValueError, match="text"):
        html_text(pages, keep=["text"])
