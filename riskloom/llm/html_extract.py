"""Main text of web pages by tag-path ratios.

A page is cut into text blocks, each with its path of block tags from the root. Per path, the text
length and the punctuation over the number of blocks give two ratios, weighed down by the share of
link text. The product of the ratios is smoothed over neighbouring blocks with a Gaussian kernel,
fused with the path's own score, and cut at a share of the mean score per block. The least container that holds all
blocks above the cut, and the page's headings of the first level, holds the article; every block in
it that no boilerplate element encloses is kept, in page order.

Elements that a tag, role or hiding attribute marks as boilerplate give no text; words of a class or
id lower the score of what is inside, which then counts only above the cut. An element that holds
most of the text above the cut, as scored without any marks, is the page's own and no boilerplate,
unless an unmarked article or main element lies outside it.

Null or empty html gives an empty text. Unclosed and stray tags are tolerated; comments, scripts
and styles never count. Only scripts, styles, titles and text areas run to the page's end if unclosed.
Work grows with a page's length alone, however deep or broken it is. Repeated rows repeat; carried
columns may have any names, those of the result come first.
"""

from __future__ import annotations

import bisect
import functools
import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.storage import carried, made, spread, table, text_slices

#: Width of the kernel in blocks, and the share of the mean score where content starts.
SIGMA, CUT = 1.0, 0.5
#: Share of a path's score that is left inside an element with a marked class or id; share of the scored text that lifts a mark.
NAMED, MOST = 0.01, 0.5
#: Share of links in a path's text above which it is a menu, unless it scores above the cut.
MENU = 0.5
#: Words of a label at most.
LABEL = 4

#: HTML elements by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var ruby rt rp wbr img br".split())
CONTAINER = frozenset("html body div main article section td table tbody tr center form".split())
RAW = "script|style|title|textarea"
UNSEEN = frozenset("noscript template select svg math iframe object canvas audio video".split())
BOILERPLATE = frozenset("head nav header footer aside form button menu dialog fieldset".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSES |= {t: {"p"} for t in "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol pre section table ul".split()}
#: What an implied end tag never reaches beyond.
SCOPE = frozenset("html body div main article section td th table ul ol dl blockquote aside nav header footer form".split())
#: What such an end tag may close.
CLOSABLE = frozenset().union(*CLOSES.values())
#: End tags that, if stray, close nothing beyond these elements.
STRAY, HELD = frozenset("p li div span".split()), ("article", "main", "body")
#: Words of a class or id that mark boilerplate, and words that say nothing beside them.
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promos promotion comment comments disqus discussion feedback guestbook reply replies respond responses talkback cookie cookies consent gdpr"
    " notice notices alert popup modal overlay sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar topbar header masthead footer copyright"
    " legal related recommended recirc share sharing social newsletter subscribe signup login search widget skip toc".split()
)
PLAIN = frozenset(
    "area bar block body bottom box btn button buttons center col column container content footer form global group head header heading icon icons inner item items js label left link links list main"
    " media nav outer page panel post primary right row secondary section site slot story text title top unit widget wrap wrapper".split()
)
MARKED_ROLE = frozenset("navigation banner contentinfo complementary search alert dialog alertdialog form menu menubar toolbar".split())

REST = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+"
NAME = r"[a-zA-Z][^\s/>]{0,63}"
TOKEN = re.compile(
    rf"<!--(?:.*?-->|.*\Z)|<(?P<raw>{RAW})(?=[\s/>]){REST}(?:(?<=/)>|>.*?(?:</(?P=raw)\s*>|\Z))"
    rf"|<(?P<end>/?)(?P<tag>{NAME})(?P<rest>{REST})>|<[!?/][^>]*>|(?P<text>[^<]+)",
    re.S | re.I,
)
TAG = re.compile(rf"<(/?)({NAME})")
RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW.split("|")}
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
BLANKS = re.compile(r"\s+")
MARKS = re.compile(r"[.,;:!?…。，、；：！？·]")


@dataclass(slots=True)
class Node:
    """An element that was opened; elements are numbered from 0, the page itself, in the order of their start tags."""

    tag: str
    parent: int
    #: The number of its tag path: the names from the root down to it.
    path: int
    #: Marked by tag, role or hiding; marked by class or id.
    boilerplate: bool
    named: bool


@dataclass(slots=True)
class Block:
    node: int
    text: str
    links: int


class Slow:
    """Tags of a page with broken quotes or ends, in one pass: where a tag ends is looked up, and failed searches are remembered."""

    def __init__(self, page: str):
        self.page, self.dead = page, set()
        self.at = [m.start() for m in re.finditer("[>\"']", page)]
        self.next_same, last = [len(page)] * len(self.at), {}
        for i in range(len(self.at) - 1, -1, -1):
            c = page[self.at[i]]
            self.next_same[i] = last.get(c, -1)
            last[c] = i
        self.ends = [i for i in self.at if page[i] == ">"]

    def tag_end(self, start: int) -> int:
        """The '>' that ends a tag, quoted ones passed over, else -1."""
        tried, i = [], bisect.bisect_left(self.at, start)
        while i < len(self.at) and i not in self.dead:
            if self.page[self.at[i]] == ">":
                return self.at[i]
            tried.append(i)
            if self.next_same[i] < 0:
                break
            i = self.next_same[i] + 1
        self.dead.update(tried)
        return -1

    def first_end(self, start: int) -> int:
        i = bisect.bisect_left(self.ends, start)
        return self.ends[i] if i < len(self.ends) else -1

    def tokens(self, at: int) -> Iterator[tuple[int, int, str | None, bool, str, str | None]]:
        page = self.page
        while at < len(page):
            start, name, end_tag, rest, text = at, None, False, "", None
            if page[at] != "<":
                at = n if (n := page.find("<", at)) >= 0 else len(page)
                text = page[start:at]
            elif page.startswith("<!--", at):
                at = n + 3 if (n := page.find("-->", at + 4)) >= 0 else len(page)
            elif m := TAG.match(page, at):
                stop = self.tag_end(m.end())
                stop = self.first_end(m.end()) if stop < 0 else stop
                if stop < 0:
                    at, text = at + 1, "<"
                else:
                    end_tag, name, rest, at = bool(m[1]), m[2].lower(), page[m.end() : stop], stop + 1
                    if name in RAW_END and not end_tag:
                        if not rest.endswith("/"):
                            at = e.end() if (e := RAW_END[name].search(page, at)) else len(page)
                        name = None
            elif page[at + 1 : at + 2] in ("!", "?", "/") and (stop := self.first_end(at)) >= 0:
                at = stop + 1
            else:
                at, text = at + 1, "<"
            yield start, at, name, end_tag, rest, text


def tokens_of(page: str) -> Iterator[tuple[int, int, str | None, bool, str, str | None]]:
    """(start, end, tag, whether it is an end tag, its attributes, or text): one expression while tags are whole, then Slow."""
    at = 0
    while at < len(page):
        m = TOKEN.match(page, at)
        if m is None:  # a '<' that opens nothing, or a tag with broken quotes
            if TAG.match(page, at) or page[at + 1 : at + 2] in ("!", "?", "/"):
                yield from Slow(page).tokens(at)
                return
            yield at, at + 1, None, False, "", "<"
            at += 1
            continue
        start, at = at, m.end()
        tag = m["tag"]
        yield start, at, tag and tag.lower(), bool(m["end"]), m["rest"] or "", m["text"]


@functools.lru_cache(maxsize=4096)
def _says_boilerplate(word: str) -> bool:
    """Is one name of a class or id made of marked words, with nothing but plain ones beside: cookie-notice is, notice-board isn't."""
    parts = {p.rstrip("0123456789") for p in re.split(r"[-_]+", word)} - {""}
    return bool(parts & MARKED) and parts <= MARKED | PLAIN


def _marked(tag: str, rest: str) -> tuple[str, bool, bool]:
    """The element's name in a path, whether it is boilerplate, and whether its class or id suggests so."""
    boilerplate, named, name = tag in BOILERPLATE, False, tag
    if rest:
        for key, a, b, c in ATTRIBUTE.findall(rest):
            key, value = key.lower(), a or b or c
            if key in ("class", "id"):
                if tag not in ("html", "body", "article", "main"):
                    named |= any(map(_says_boilerplate, value.lower().split()))
                if key == "class" and value:
                    name = f"{tag}.{value.split()[0]}" if value.split() else tag
            elif key == "role":
                boilerplate |= value.lower() in MARKED_ROLE
            elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and "display:none" in value.replace(" ", "").lower():
                boilerplate = True
    return name, boilerplate, named


def unseen_ends(tokens: list) -> dict[int, int]:
    """The token that ends each closed element of UNSEEN, by the one that starts it; an end tag belongs to the last one open."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for i, (_, _, tag, end, rest, _) in enumerate(tokens):
        if tag in UNSEEN and not rest.endswith("/"):
            starts = opened.setdefault(tag, [])
            if not end:
                starts.append(i)
            elif starts:
                ends[starts.pop()] = i
    return ends


def blocks_of(page: str) -> tuple[list[Node], list[Block]]:
    """The page's elements and text blocks; every step looks at a bounded number of open elements, or closes them."""
    nodes = [Node("", -1, 0, False, False)]
    paths: dict[tuple[int, str], int] = {}
    blocks: list[Block] = []
    stack = [0]  # numbers of open elements
    near: list[dict[str, int]] = [{}]  # by open element: places of the closable ones in its scope
    opens: dict[str, list[int]] = {}  # by tag: places in the stack
    parts: list[str] = []
    linked = in_link = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            if text := BLANKS.sub(" ", html.unescape("".join(parts))).strip():
                blocks.append(Block(stack[-1], text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def close(place: int) -> None:
        nonlocal in_link
        for n in stack[place:]:
            opens[nodes[n].tag].pop()
        del stack[place:], near[place:]
        in_link = 0

    tokens = list(tokens_of(page))
    ends, i = unseen_ends(tokens), -1
    while (i := i + 1) < len(tokens):
        _, _, tag, end, rest, text = tokens[i]
        if text is not None:
            parts.append(text)
            if in_link:
                linked += len(text)
        elif tag is None:
            continue
        elif tag in UNSEEN:
            i = ends.get(i, i)
        elif tag in INLINE:
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                in_link = 0 if end else 1
        elif end:
            flush()
            place = opens[tag][-1] if opens.get(tag) else 0
            if place and not (tag in STRAY and any(opens.get(t, [0])[-1:] > [place] for t in HELD)):
                close(place)
        else:
            flush()
            if shuts := CLOSES.get(tag):
                place = max((near[-1].get(t, 0) for t in shuts), default=0)
                if place:
                    close(place)
            if tag in VOID:
                continue
            name, boilerplate, named = _marked(tag, rest)
            path = paths.setdefault((nodes[stack[-1]].path, name), len(paths) + 1)
            nodes.append(Node(tag, stack[-1], path, boilerplate, named))
            seen = {} if tag in SCOPE else near[-1]
            near.append({**seen, tag: len(stack)} if tag in CLOSABLE else seen)
            opens.setdefault(tag, []).append(len(stack))
            stack.append(len(nodes) - 1)
    flush()
    return nodes, blocks


def path_scores(nodes: list[Node], blocks: list[Block], left: np.ndarray) -> np.ndarray:
    """Per block: its path's text ratio times its punctuation ratio, less links, times what marks leave, smoothed and fused."""
    sums: dict[int, list[float]] = {}
    for b in blocks:
        s = sums.setdefault(nodes[b.node].path, [0, 0, 0, 0])
        s[0] += 1
        s[1] += len(b.text)
        s[2] += len(MARKS.findall(b.text))
        s[3] += b.links
    score = {p: (length / n) * math.log1p(1 + marks / n) * max(0.0, 1 - links / length) for p, (n, length, marks, links) in sums.items()}
    own = np.array([score[nodes[b.node].path] for b in blocks]) * left
    reach = np.arange(-int(3 * SIGMA), int(3 * SIGMA) + 1)
    kernel = np.exp(-(reach**2) / (2 * SIGMA**2))
    smooth = np.convolve(own, kernel / kernel.sum(), "full")[len(kernel) // 2 :][: len(own)]
    return np.sqrt(own * smooth)


def below(nodes: list[Node], own: list[int]) -> list[int]:
    """Sums over each element and all in it."""
    out = list(own)
    for n in range(len(nodes) - 1, 0, -1):
        out[nodes[n].parent] += out[n]
    return out


def mark_shares(nodes: list[Node], blocks: list[Block]) -> np.ndarray:
    """Per block: the share of its score that marks leave; 0 in boilerplate."""
    if not any(n.boilerplate or n.named for n in nodes):
        return np.ones(len(blocks))
    scores = path_scores(nodes, blocks, np.ones(len(blocks)))
    cut, length = CUT * scores.mean(), [0] * len(nodes)
    for b, f in zip(blocks, scores):
        if f >= cut:
            length[b.node] += len(b.text)
    total, held = sum(length), below(nodes, length)
    # article and main elements that hold text which nothing marks
    plain = [False] * len(nodes)
    marked = [False] * len(nodes)
    for i, n in enumerate(nodes):
        marked[i] = n.boilerplate or n.named or (i > 0 and marked[n.parent])
    for b in blocks:
        plain[b.node] |= not marked[b.node]
    for i in range(len(nodes) - 1, 0, -1):
        plain[nodes[i].parent] |= plain[i]
    article = [p and n.tag in ("article", "main") for p, n in zip(plain, nodes)]
    articles, outside = sum(article), [0] * len(nodes)  # how many of them lie around an element
    share = [1.0] * len(nodes)
    for i, n in enumerate(nodes):
        if i:
            outside[i] = outside[n.parent] + article[n.parent]
            lifted = held[i] > MOST * total and outside[i] == articles
            share[i] = min(share[n.parent], 1.0 if lifted or not (n.boilerplate or n.named) else 0.0 if n.boilerplate else NAMED)
    return np.array([share[b.node] for b in blocks])


def main_text(page: str | None) -> str:
    nodes, blocks = blocks_of(page) if page else ([], [])
    left = mark_shares(nodes, blocks) if blocks else np.zeros(0)
    if not left.any():
        return ""
    fused = path_scores(nodes, blocks, left)
    plain = left == left.max()
    above = (left > 0) & (fused >= CUT * fused[plain].mean())
    # h1 elements stand for the blocks in them
    titled = [False] * len(nodes)
    for i, n in enumerate(nodes):
        titled[i] = n.tag == "h1" or (i > 0 and titled[n.parent])
    own = [0] * len(nodes)
    for b, p, f in zip(blocks, plain, above):
        own[b.node] += bool(f or p and titled[b.node])
    held, last = below(nodes, own), list(range(len(nodes)))
    for i in range(len(nodes) - 1, 0, -1):
        last[nodes[i].parent] = max(last[nodes[i].parent], last[i])
    # the innermost container that holds all of them: elements with all of them are nested, hence in this order
    at = 0
    for i in range(1, len(nodes)):
        if held[i] == held[0]:
            if nodes[i].parent != at or nodes[i].tag not in CONTAINER:
                break
            at = i
            if nodes[i].tag == "article":
                break
    kept = above | plain & ~outlying(nodes, blocks, above, [titled[b.node] for b in blocks])
    return "\n".join(b.text for b, k in zip(blocks, kept) if k and at <= b.node <= last[at])


def outlying(nodes: list[Node], blocks: list[Block], above: np.ndarray, titled: list[bool]) -> np.ndarray:
    """Per block: below the cut it is no part of the article, as its path is mostly links, or as it is a label before or after
    the article (a few words without a mark, in no paragraph, heading or list) on a path of which no block is above the cut."""
    text, links = {}, {}
    for b in blocks:
        path = nodes[b.node].path
        text[path], links[path] = text.get(path, 0) + len(b.text), links.get(path, 0) + b.links
    good = {nodes[b.node].path for b, f, h in zip(blocks, above, titled) if f or h}
    inside = np.flatnonzero(above | np.array(titled, bool))
    order = np.arange(len(blocks))
    beyond = (order < inside[0]) | (order > inside[-1]) if len(inside) else np.zeros(len(blocks), bool)
    menu = np.array([links[nodes[b.node].path] > MENU * text[nodes[b.node].path] for b in blocks])
    label = np.array([nodes[b.node].path not in good and nodes[b.node].tag in CONTAINER and len(b.text.split()) <= LABEL and not MARKS.search(b.text) for b in blocks])
    return ~above & (menu | beyond & label)


def extract_text(pages: DataFrame, html_column: str = "html", key: str = "page_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """key, the carried columns, text and n_chars for every row of `pages`; one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "content"):
                texts = [main_text(h) for h in batch.column("content").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["row", "text", "n_chars"])

    keep = (key, *carry)
    given = carried(pages, keep, html_column)
    return spread(given.mapInArrow(run, made(given, "text string, n_chars long")), keep, ("text", "n_chars"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"), carry=("url",))
