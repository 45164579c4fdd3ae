"""Main text of web pages: boosted trees over DOM-node features, decoded down the hierarchy.

Each block-level element is a node with features of its subtree, its attributes, its
place and its siblings. Gradient-boosted trees give the odds that a node holds main text.
The most likely labelling in which no node is kept below a dropped one is then found by
dynamic programming over the tree. The trees are trained here on generated, labelled
pages (htmlpages.py), never on the pages that they judge.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame

from silverloom.llm import htmlpages, trees
from silverloom.llm.common import map_texts

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Elements whose content is never text of the page.
HIDDEN = {"head", "script", "style", "noscript", "template", "iframe", "object", "svg", "canvas", "audio", "video", "select", "option", "button", "textarea", "title", "datalist"}
BLOCKS = (
    "body html div section article main nav header footer aside form p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "blockquote pre figure figcaption details summary address fieldset legend caption hgroup menu dialog center"
).split()
BLOCK = set(BLOCKS)
#: A start tag of the first kind ends open elements of the second, up to one of the third.
ENDS = {t: ({"p"}, {"table", "td", "th"}) for t in BLOCKS if t not in ("html", "body", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "legend", "summary", "figcaption")}
ENDS |= {"li": ({"p", "li"}, {"ul", "ol", "menu"}), "dt": ({"p", "dt", "dd"}, {"dl"}), "dd": ({"p", "dt", "dd"}, {"dl"})}
ENDS |= {"tr": ({"p", "tr", "td", "th"}, {"table"}), "td": ({"p", "td", "th"}, {"table", "tr"}), "th": ({"p", "td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select"})}
#: What a start tag doesn't look beyond, for each of ENDS: the third kind, and other blocks but lists and table parts.
BARRIER = {t: until | {b for b in BLOCKS if b not in ends and b not in ("ul", "ol", "tbody", "thead", "tfoot")} for t, (ends, until) in ENDS.items()}
#: Words in class, id and role, by what they tell.
GROUPS = [
    "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager",
    "header masthead topbar logo branding banner",
    "footer foot bottom copyright legal colophon",
    "sidebar side aside widget rail complementary",
    "ad ads adv advert adverts advertisement sponsor sponsored promo promotion promoted commercial",
    "cookie cookies consent notice notification alert popup modal overlay gdpr privacy message",
    "comment comments reply replies respond disqus discussion reactions reader feedback",
    "share sharing social follow like buttons tools",
    "form search subscribe subscription newsletter login signup register",
    "related recommended recommendations more popular trending also latest teaser links tags tag",
    "article post entry story content body text main hentry page single prose",
]
TOKENS = {w: i for i, g in enumerate(GROUPS) for w in g.split()}
TAGS = {t: i for i, t in enumerate(BLOCKS)}
UNDER = ["article", "main", "nav", "header", "footer", "aside", "form", "table", "ul", "section"]


#: Elements that are judged at once; a bound of memory.
NODES = 1 << 15


class Page(HTMLParser):
    """The block-level elements of a page with their texts, links and attribute words."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.groups, self.depth = ["html"], [-1], [0], [0]
        self.text, self.link, self.spans = [0], [0], [0]  # own characters, of them in links; elements
        self.runs: list[tuple[int, str]] = []  # (node, text) in page order; an empty text is a break
        self.open: list[tuple[str, int]] = [("html", 0)]  # open elements with their block node
        self.at: dict[str, list[int]] = defaultdict(list)  # places in `open`, but the first, by tag
        self.blocks_at: list[int] = []  # and of blocks
        self.hidden = self.links = 0
        self.feed(re.sub(r"<!\[[^>]*>?", " ", html))
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "html" or tag == "body" and self.at["body"]:
            return
        if tag in VOID:
            if not self.hidden and tag != "wbr":  # a place where a word may be broken isn't a space
                self.runs.append((self.open[-1][1], " ") if tag != "hr" else (self.open[-1][1], ""))
            return
        if tag in ENDS:
            ends = ENDS[tag][0]
            while (last := self.last(ends)) and last > self.last(BARRIER[tag]):
                self.cut(last)
        node = self.open[-1][1]
        self.spans[node] += 1
        if tag in BLOCK and not self.hidden:
            words = " ".join(v for k, v in attrs if v and k in ("class", "id", "role")).lower()
            own = 0
            for w in re.findall(r"[a-z]+", words):
                own |= 1 << TOKENS[w] if w in TOKENS else 0
            self.tag.append(tag)
            self.parent.append(node)
            self.groups.append(own)
            self.depth.append(self.depth[node] + 1)
            for x in (self.text, self.link, self.spans):
                x.append(0)
            node = len(self.tag) - 1
            self.runs.append((node, ""))
        self.hidden += tag in HIDDEN
        self.links += tag == "a"
        self.at[tag].append(len(self.open))
        if tag in BLOCK:
            self.blocks_at.append(len(self.open))
        self.open.append((tag, node))

    def last(self, tags: set[str]) -> int:
        """The place of the last open element of the tags, 0 if there is none."""
        return max((self.at[t][-1] for t in tags if self.at[t]), default=0)

    def cut(self, at: int) -> None:
        """Close the open elements from `at` on."""
        for tag, node in self.open[at:]:
            self.hidden -= tag in HIDDEN
            self.links -= tag == "a"
            self.at[tag].pop()
            if tag in BLOCK:
                self.blocks_at.pop()
                if not self.hidden:
                    self.runs.append((node, ""))
        del self.open[at:]

    def handle_endtag(self, tag: str) -> None:
        if self.at[tag] and (tag in BLOCK or not self.blocks_at or self.at[tag][-1] > self.blocks_at[-1]):
            self.cut(self.at[tag][-1])

    def handle_data(self, data: str) -> None:
        if not self.hidden and data:
            node, n = self.open[-1][1], len(data.strip())
            self.text[node] += n
            self.link[node] += n if self.links else 0
            self.runs.append((node, data))

    def unknown_decl(self, data: str) -> None:
        """Sections that HTML doesn't know are skipped."""


def features(page: Page) -> Iterator[np.ndarray]:
    """One row for each block-level element: tag, subtree sizes and densities, attribute words, depth, place, siblings.

    The rows of NODES elements at a time, so that a page of very many elements fills no memory with them.
    """
    n = len(page.tag)
    parent = page.parent
    text, link, spans = (np.asarray(x, float) for x in (page.text, page.link, page.spans))
    own = text.copy()
    stops, kids = np.zeros(n), np.zeros(n)
    for node, s in page.runs:
        stops[node] += s.count(".") + s.count(",") + s.count("?") + s.count("!")
    begin = np.concatenate([[0.0], np.cumsum(text)[:-1]])
    total_stops, nodes = stops.copy(), np.ones(n)
    has = np.zeros((n, 3), np.float32)
    above, under = np.zeros(n, np.int64), np.zeros((n, len(UNDER)), bool)
    index = {t: i for i, t in enumerate(UNDER)}
    child: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        p = parent[i]
        child[p].append(i)
        kids[p] += 1
        above[i] = above[p] | page.groups[p]
        under[i] = under[p]
        if page.tag[p] in index:
            under[i, index[page.tag[p]]] = 1
    for i in range(n - 1, 0, -1):
        p = parent[i]
        for x in (text, link, spans, total_stops, nodes):
            x[p] += x[i]
        t = page.tag[i]
        has[p] = np.maximum(has[p], has[i])
        if t in ("article", "main"):
            has[p, 0] = 1
        elif t[0] == "h" and t[1:].isdigit():
            has[p, 1] = 1
        elif t == "p":
            has[p, 2] += 1
    whole = max(text[0], 1.0)
    place, before, after, alike, share = (np.zeros(n) for _ in range(5))
    for c in child:
        if c:
            sizes, times = text[c], Counter(page.tag[i] for i in c)
            total = max(1.0, sizes.sum())
            for k, i in enumerate(c):
                place[i] = k / len(c)
                before[i] = sizes[k - 1] if k else -1
                after[i] = sizes[k + 1] if k + 1 < len(c) else -1
                alike[i] = times[page.tag[i]] / len(c)
                share[i] = sizes[k] / total
    siblings = np.asarray([kids[p] if p >= 0 else 1 for p in parent])
    groups, kinds, depth = np.asarray(page.groups), np.asarray([TAGS[t] for t in page.tag]), np.asarray(page.depth, float)
    log = np.log1p
    for at in range(0, n, NODES):
        s = slice(at, at + NODES)
        bits, bits_above = (x[s, None] >> np.arange(len(GROUPS)) & 1 for x in (groups, above))
        tags = kinds[s, None] == np.arange(len(BLOCKS))
        plain = [
            log(text[s]), log(own[s]), link[s] / np.maximum(text[s], 1), log(link[s]), log(spans[s]), text[s] / (spans[s] + nodes[s]), log(nodes[s]), depth[s], kids[s], place[s],
            siblings[s], log(before[s] + 1), log(after[s] + 1), alike[s], share[s], total_stops[s] / np.maximum(text[s], 1), begin[s] / whole, (begin[s] + text[s]) / whole, text[s] / whole, *has[s].T,
        ]
        yield np.column_stack([*plain, bits, bits_above, under[s], tags]).astype(np.float32)


def decoded(page: Page, odds: np.ndarray) -> np.ndarray:
    """The likeliest labels (kept or not) of the nodes in which nothing is kept below a dropped node."""
    yes, no = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    dropped, kept = no.copy(), yes.copy()
    for i in range(len(odds) - 1, 0, -1):
        dropped[page.parent[i]] += dropped[i]
        kept[page.parent[i]] += max(kept[i], dropped[i])
    out = np.zeros(len(odds), bool)
    for i in range(len(odds)):
        out[i] = kept[i] >= dropped[i] and (i == 0 or out[page.parent[i]])
    return out


def blocks(page: Page, kept: np.ndarray) -> list[str]:
    """Texts of the blocks of kept nodes in page order, white space collapsed, empty ones left out."""
    out, part, last = [], [], -1
    for node, s in [*page.runs, (-1, "")]:
        if s == "" or node != last:
            if text := " ".join("".join(part).split()):
                out.append(text)
            part = []
        if s and kept[node]:
            part.append(s)
        last = node
    return out


@lru_cache(maxsize=2)
def model(pages: int = 1000, seed: int = 3) -> trees.Boosted:
    """Trees fitted to `pages` generated pages; the training is deterministic, on the driver, about ten seconds once a session."""
    xs, ys = [], []
    for html in htmlpages.generated(pages, seed):
        page = Page(html)
        label = np.zeros(len(page.tag), bool)
        for node, s in page.runs:
            label[node] |= htmlpages.MARK in s
        for i in range(len(label) - 1, 0, -1):
            label[page.parent[i]] |= label[i]
        page.runs = [(n, s.replace(htmlpages.MARK, "")) for n, s in page.runs]
        xs += features(page)
        ys.append(label)
    return trees.fit(np.concatenate(xs), np.concatenate(ys).astype(float))


def main_texts(pages: list[str], fitted: trees.Boosted) -> list[str]:
    """The main text of each page; small pages are judged together, up to NODES elements."""
    parsed = [Page(p) for p in pages]
    odds, waiting, size = [], [], 0
    for p in parsed:
        for x in features(p):
            waiting.append(x)
            size += len(x)
            if size >= NODES:
                odds.append(fitted.log_odds(np.concatenate(waiting)))
                waiting, size = [], 0
    odds = np.concatenate([np.empty(0), *odds, *([fitted.log_odds(np.concatenate(waiting))] if waiting else [])])
    ends = np.cumsum([len(p.tag) for p in parsed])[:-1] if parsed else []
    return ["\n\n".join(blocks(p, decoded(p, o))) for p, o in zip(parsed, np.split(odds, ends))]


def extract(df: DataFrame, keep: list[str], html_col: str = "html", fitted: trees.Boosted | None = None, at_once: int = 256) -> DataFrame:
    """The columns `keep` of every row with its main text: (..., text, n_chars).

    One narrow pass over whole pages. Null, empty and text-free pages give an empty text;
    broken markup is read as far as it goes. Repeated rows get equal texts.
    """
    fitted = fitted or model()

    def make(htmls: list[str]) -> tuple[None, list]:
        out = [t for at in range(0, len(htmls), at_once) for t in main_texts(htmls[at : at + at_once], fitted)]
        return None, [out, [len(t) for t in out]]

    return map_texts(df, keep, html_col, {"text": "string", "n_chars": "long"}, make)
