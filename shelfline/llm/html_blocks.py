"""Main text of web pages: flat text blocks, classified by a decision tree on their own and their neighbours' shallow features.

A page is cut into text blocks at block-level tags, without building its tree of elements. Each block has its word count and link
density, those of the block before and after it, whether it is a heading, a paragraph or a list item and ends like a sentence, and
what its open containers say of it: inside an article, inside navigation, a sidebar, a notice, an advert, a form, comments. The tree
(Gini splits) is fitted on a small table of labelled pages; the one built in is made by rule, in page styles with semantic tags,
with telling class names, and with neither.

Cases: NULL html is empty; pages without main text give an empty string; broken markup is read as far as it can be told (a tag or
comment without end takes the rest of the page); pages of any length are read whole, in time in proportion to their length; ids
may repeat or be NULL, each row gives one row; other columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import escape, unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages read for a fit at most, and pages of the table built in.
MAX_LABELLED = 2000
SAMPLE = 600

# Names of HTML elements, of ARIA roles, and words that class names use.
CONTAINERS = set("div section article main nav aside header footer form ul ol dl table dialog details fieldset figure menu blockquote search".split())
BLOCKS = CONTAINERS | set("p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption pre figcaption address summary legend hr body html head center optgroup option".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
ITEMS = set("li dt dd".split())
RAW = set("script style title textarea xmp iframe noembed noframes".split())
MUTE = set("select button template svg object audio video canvas noscript datalist map".split())
SIDE = set("nav aside footer form dialog menu search".split())
SIDE_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
SIDE_NAMES = set(
    "ad ads adv advert adverts advertisement adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert popup modal overlay "
    "newsletter subscribe subscription signup login nav navbar navigation menu breadcrumb breadcrumbs sidebar side widget related recommended recommendations "
    "share sharing social footer foot header masthead copyright legal comment comments commentlist disqus reply replies respond pagination pager toolbar search form "
    "skip hidden".split()
)
#: First words of class names that speak of the layout, not of the box: has-sidebar, with-menu.
LAYOUT = set("has with without no is js".split())
MAIN_NAMES = set("article post entry story content body text main articlebody".split())

TAG = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|(!--)|[!?/])")
TAG_END = re.compile(r"""(?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+>""")
HINT = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop|itemtype|style|hidden|aria-hidden)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"']++))?(?=[\s"'/>]|$)""", re.IGNORECASE)
NAME = re.compile(r"[a-z]+")
SENTENCE = re.compile(r"""[.!?…:;。！？]["'”’»)\]]*$""")


class Flags(NamedTuple):
    """What a container says of the text inside."""

    article: int
    side: int
    main: int
    mute: int


NOTHING = Flags(0, 0, 0, 0)


def _flags(tag: str, attributes: str) -> Flags:
    article, side, main, mute = int(tag in ("article", "main")), int(tag in SIDE), 0, int(tag in MUTE)
    for name, value in HINT.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            words = {w for token in value.split() if (found := NAME.findall(token)) and found[0] not in LAYOUT for w in found}
            names = words & SIDE_NAMES
            side += bool(names) and not (names == {"header"} and words & MAIN_NAMES)
            main += bool(words & MAIN_NAMES) and not names
        elif name == "role":
            side += value in SIDE_ROLES
            article += value in ("main", "article") and not article
        elif name == "itemprop":
            main += value == "articlebody"
            side += value == "comment"
        elif name == "itemtype":
            side += value.endswith(("/comment", "/usercomments", "/wpheader", "/wpfooter", "/wpsidebar", "/sitenavigationelement"))
        elif name == "style":
            side += "display:none" in re.sub(r"\s+", "", value)
        else:
            side += name == "hidden" or value == "true"
    return Flags(article, min(side, 1), min(main, 1), mute)


_kept_flags = lru_cache(4096)(_flags)


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    article: int
    side: int
    main: int
    kind: int
    sentence: bool


PLAIN, PARAGRAPH, ITEM, HEADING = range(4)


def text_blocks(page: str) -> tuple[list[Block], bool]:
    """Blocks of text in page order, and whether the page has an article or main element."""
    blocks: list[Block] = []
    stack: list[tuple[str, Flags]] = []
    opened: Counter[str] = Counter()
    article = side = main = mute = 0
    held: list[str] = []
    linked, link_depth, kind, has_article, own = 0, -1, PLAIN, False, NOTHING

    def flush() -> None:
        nonlocal linked
        words = "".join(held).split()
        if words:
            text = " ".join(words)
            blocks.append(Block(text, len(words), min(linked, len(words)), article, side + own.side, main + own.main, kind, bool(SENTENCE.search(text[-40:]))))
        held.clear()
        linked = 0

    at, size = 0, len(page)
    while at < size:
        found = TAG.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text and not mute:
            text = unescape(text) if "&" in text else text
            held.append(text)
            if link_depth >= 0:
                linked += len(text.split())
        if not found:
            break
        closing, tag, comment = found[1], found[2], found[3]
        if tag is None:
            end = page.find("-->" if comment else ">", found.end() - 2 * bool(comment))
            at = size if end < 0 else end + (3 if comment else 1)
            continue
        tag = tag.lower()
        end = TAG_END.match(page, found.end())
        if not end:
            break
        at = end.end()
        attributes = page[found.end() : at - 1]
        if tag in RAW and not closing:
            stop = _raw_end(tag).search(page, at)
            at = stop.start() if stop else size
        elif tag == "a":
            link_depth = -1 if closing else len(stack)
        elif tag == "br" or tag == "wbr":
            held.append(" " if tag == "br" else "")
        if tag in BLOCKS:
            flush()
            kind = PLAIN if closing else HEADING if tag in HEADINGS else PARAGRAPH if tag == "p" else ITEM if tag in ITEMS else PLAIN
            own = NOTHING
        flags = NOTHING if closing else _kept_flags(tag, attributes) if len(attributes) < 256 else _flags(tag, attributes)
        if tag not in CONTAINERS and tag not in MUTE:
            own = flags if tag in BLOCKS and tag not in ("html", "body") else own  # of this block alone
            continue
        if closing:
            while opened[tag]:
                name, flags = stack.pop()
                opened[name] -= 1
                article, side, main, mute = article - flags.article, side - flags.side, main - flags.main, mute - flags.mute
                if name == tag:
                    break
            link_depth = -1 if link_depth > len(stack) else link_depth
        elif not attributes.endswith("/") or tag in CONTAINERS:
            if tag == "header" and not article:
                flags = flags._replace(side=1)
            stack.append((tag, flags))
            opened[tag] += 1
            article, side, main, mute = article + flags.article, side + flags.side, main + flags.main, mute + flags.mute
            has_article |= flags.article > 0 and side == 0
    flush()
    return blocks, has_article


@lru_cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE)


FEATURES = ["words", "density", "words_before", "density_before", "words_after", "density_after", "article", "outside", "side", "main", "kind", "sentence"]


def features(blocks: list[Block], has_article: bool) -> np.ndarray:
    """One row for each block; beyond the ends of the page a neighbour has no words and no links."""
    own = np.array([(b.words, b.linked / b.words, min(b.article, 2), has_article and not b.article, b.side > 0, b.main > 0, b.kind, b.sentence) for b in blocks], np.float64).reshape(-1, 8)
    shallow = np.vstack([np.zeros((1, 2)), own[:, :2], np.zeros((1, 2))])
    return np.hstack([shallow[1:-1], shallow[:-2], shallow[2:], own[:, 2:]])


class Tree(NamedTuple):
    """Nodes by number, the root first: rows with feature <= cut go left; leaves have feature -1 and the share of main text."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while (inner := np.flatnonzero(self.feature[node] >= 0)).size:
            at = node[inner]
            node[inner] = np.where(x[inner, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
        return self.share[node]


def fit_tree(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 5) -> Tree:
    """Binary splits that lessen Gini impurity most, with `least` rows on either side; ties go to the first feature and cut."""
    nodes: list[list[float]] = []

    def grow(rows: np.ndarray, level: int) -> int:
        number, labels = len(nodes), y[rows]
        nodes.append([-1, 0.0, 0, 0, labels.mean() if len(rows) else 0.0])
        if level == depth or len(rows) < 2 * least or labels.min() == labels.max():
            return number
        best = (labels.mean() * (1 - labels.mean()) * len(rows) - 1e-9, -1, 0.0)
        for f in range(x.shape[1]):
            order = np.argsort(x[rows, f], kind="stable")
            values, sums = x[rows, f][order], np.cumsum(labels[order])
            n = np.arange(1, len(rows))
            split = (values[1:] > values[:-1]) & (n >= least) & (len(rows) - n >= least)
            if split.any():
                a, b, rest = sums[:-1], sums[-1] - sums[:-1], len(rows) - n
                impurity = np.where(split, a * (1 - a / n) + b * (1 - b / rest), np.inf)
                at = int(impurity.argmin())
                best = min(best, (impurity[at], f, (values[at] + values[at + 1]) / 2), key=lambda t: t[0])
        if best[1] >= 0:
            goes = x[rows, best[1]] <= best[2]
            nodes[number][:2] = best[1:]
            nodes[number][2] = grow(rows[goes], level + 1)
            nodes[number][3] = grow(rows[~goes], level + 1)
        return number

    grow(np.arange(len(y)), 0)
    columns = list(zip(*nodes, strict=True))
    return Tree(*(np.array(c, t) for c, t in zip(columns, (np.int64, np.float64, np.int64, np.int64, np.float64), strict=True)))


def fit(labelled: list[tuple[str, str]]) -> Tree:
    """A tree from (html, main text) of at most MAX_LABELLED pages; a block is main where its text is the next line of the text."""
    rows, labels = [], []
    for page, text in labelled[:MAX_LABELLED]:
        blocks, has_article = text_blocks(page)
        lines, at = text.split("\n"), 0
        for b in blocks:
            hit = at < len(lines) and b.text == lines[at]
            labels.append(hit)
            at += hit
        rows.append(features(blocks, has_article))
    return fit_tree(np.vstack(rows), np.array(labels, np.float64))


def extract_text(pages: DataFrame, tree: Tree | None = None, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Columns `keep`, text and n_chars (its code points) of every row: the blocks that the tree calls main, one \\n between two."""
    model = tree or fit(sample_pages(SAMPLE))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            for page in batch.column(batch.num_columns - 1):
                blocks, has_article = text_blocks(page.as_py() or "")
                chosen = model.predict(features(blocks, has_article)) >= 0.5
                texts.append("\n".join(b.text for b, main in zip(blocks, chosen, strict=True) if main))
            found = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], [*keep, "text", "n_chars"])

    chosen = pages.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{html_col}`").cast("string").alias("__html"))
    kinds = ", ".join(f"`{c}` {kind}" for c, kind in chosen.dtypes[:-1])
    return chosen.mapInArrow(scan, f"{kinds}, text string, n_chars long")


class _Page:
    """Writes one page of the labelled table and its main text."""

    def __init__(self, seed: int):
        self.rnd = random.Random(seed)
        self.style = self.rnd.choice(["tags", "tags", "names", "names", "bare"])
        self.html: list[str] = []
        self.lines: list[str] = []

    def prose(self, low: int, high: int) -> str:
        words = ["".join(self.rnd.choice("abcdefghijklmnop") for _ in range(self.rnd.randint(2, 9))) for _ in range(self.rnd.randint(low, high))]
        return " ".join(words).capitalize() + self.rnd.choice([".", ".", ".", "!", "?", ""])

    def link(self) -> str:
        return f'<a href="/x">{self.prose(1, 4).rstrip(".!?")}</a>'

    def box(self, tag: str, names: list[str], inner: str) -> str:
        """A part of the page as the style marks it: by its tag, by a class or id, or by nothing."""
        if self.style == "tags" and tag:
            return f"<{tag}>{inner}</{tag}>"
        if self.style == "bare":
            return f"<div>{inner}</div>"
        return f'<div {self.rnd.choice(["class", "id"])}="{self.rnd.choice(names)}">{inner}</div>'

    def links(self) -> str:
        return "<ul>" + "".join(f"<li>{self.link()}</li>" for _ in range(self.rnd.randint(2, 9))) + "</ul>"

    def aside(self, n: int) -> str:
        """A part that is not main text."""
        boxes = [
            lambda: self.box("", ["ad", "advert", "ad-box", "sponsored", "promo"], self.prose(3, 20)),
            lambda: self.box("aside", ["sidebar", "widget", "side-bar"], f"<h3>{self.prose(1, 4)}</h3>" + self.rnd.choice([self.links(), f"<p>{self.prose(5, 40)}</p>"])),
            lambda: self.box("", ["cookie-notice", "notice", "consent", "alert"], f"<p>{self.prose(6, 30)}</p><button>{self.prose(1, 2)}</button>"),
            lambda: f"<form><label>{self.prose(1, 3)}</label><input><button>{self.prose(1, 2)}</button></form>",
            lambda: self.box("", ["share", "social-links", "breadcrumbs"], " ".join(self.link() for _ in range(4))),
            lambda: self.box("nav", ["related", "recommended"], f"<h3>{self.prose(1, 3)}</h3>{self.links()}"),
        ]
        return boxes[n % len(boxes)]()

    def comments(self) -> str:
        each = "".join(f'<div class="{"comment" if self.style != "bare" else "c"}"><p>{self.prose(3, 60)}</p></div>' for _ in range(self.rnd.randint(1, 6)))
        return (f'<section class="comments"><h3>{self.prose(1, 2)}</h3>{each}</section>' if self.style != "bare" else f'<div id="comments">{each}</div>')

    def line(self, tag: str, text: str, inner: str = "") -> str:
        self.lines.append(text)
        return f"<{tag}>{inner or text}</{tag}>"

    def article(self) -> str:
        head = self.line("h1", self.prose(2, 14))
        out = [head if self.rnd.random() < 0.8 else f"<header>{head}</header>" if self.style == "tags" else head]
        for _ in range(self.rnd.choice([0, 1, 2, 4, 8, 12])):
            kind = self.rnd.random()
            if kind < 0.72:
                text = self.prose(*self.rnd.choice([(1, 3), (4, 15), (15, 60), (40, 150)]))
                words = text.split(" ")
                cut = len(words) // 3 if self.rnd.random() < 0.2 else 0
                inner = " ".join(words[:cut]) + f' <a href="/y">{" ".join(words[cut : 2 * cut])}</a> ' + " ".join(words[2 * cut :]) if cut else f"<b>{text}<br>" if self.rnd.random() < 0.15 else ""
                out.append(self.line("p", text, inner))
            elif kind < 0.8:
                out.append(self.line("h2", self.prose(1, 8)))
            elif kind < 0.88:
                out.append("<ul>" + "".join(self.line("li", self.prose(2, 15)) for _ in range(self.rnd.randint(2, 5))) + "</ul>")
            elif kind < 0.93:
                out.append("<blockquote>" + self.line("p", self.prose(5, 40)) + "</blockquote>")
            elif self.style != "bare":
                out.append(self.aside(self.rnd.randint(0, 5)))
        if self.rnd.random() < 0.2 and self.style != "bare":
            out.append(self.comments())
        inner = "".join(out)
        if self.style == "tags":
            return self.rnd.choice(["<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>"]).format(inner)
        return f'<div class="{self.rnd.choice(["content", "post-content", "entry", "article-body", "story"])}">{inner}</div>' if self.style == "names" else f"<div>{inner}</div>"

    def write(self) -> tuple[str, str]:
        parts = [self.box("header", ["header", "masthead"], f"<p>{self.prose(1, 6)}</p>")] if self.rnd.random() < 0.5 else []
        parts += [self.box("nav", ["menu", "nav", "navbar"], self.links())] if self.rnd.random() < 0.9 else []
        parts += [self.aside(self.rnd.randint(0, 5)) for _ in range(self.rnd.choice([0, 1, 1, 2]))]
        parts.append(self.article())
        parts += [self.aside(self.rnd.randint(0, 5)) for _ in range(self.rnd.choice([0, 0, 1, 2]))]
        parts += [self.comments()] if self.rnd.random() < 0.3 else []
        parts.append(self.box("footer", ["footer", "copyright"], f"&copy; {escape(self.prose(2, 16))}" + (f" {self.link()}" if self.rnd.random() < 0.4 else "")))
        return f"<!DOCTYPE html><html><head><title>{self.prose(2, 9)}</title><style>p{{}}</style></head><body>{''.join(parts)}</body></html>", "\n".join(self.lines)


def sample_pages(pages: int, seed: int = 0) -> list[tuple[str, str]]:
    """(html, main text) of labelled pages made by rule; other seeds give pages for a held-out test."""
    return [_Page(seed * 1_000_003 + i).write() for i in range(pages)]
