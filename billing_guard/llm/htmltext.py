"""Main text of web pages by tag-path ratios.

A page is read into elements, each linked to its parent, and text nodes.  Per path (the
tags from the root to a text) the text length and the punctuation count are divided by the
number of its nodes (text-to-path and punctuation-to-path ratios); link text counts
against its path.  The two ratios are smoothed over the page's order with a Gaussian, fused
by multiplication and weighted by what the markup says: article and main elements speak
for a path, class, id and role names of what surrounds an article against it.  Names of
menus, adverts, dialogs and reader comments always do, unless their element holds the
page's first article element or its h1.  Names that content carries too (sidebar-right,
tag-news, legal, related) do not where their element holds most of the page's text and of
its articles', nor inside an article unless the text agrees: mostly links, or short beside
the article's.  Nodes above a share of the page's deviation are content, on every page and
wherever they lie.  The element that holds all of them bounds the article: its other nodes
belong to it too (short paragraphs and headings score low by themselves) unless a name
speaks against them.  Nodes in elements that never hold an article (nav, footer, aside,
forms) are not looked at.  Everything is summed from children to parents and handed down
again, so time and memory are linear in the page whatever its depth.

Blocks: a text node run between block tags.  Character references are decoded after
the tags are gone, white space inside a block becomes one space, empty blocks vanish,
blocks are joined by a line feed in page order.

Edge cases: NULL and empty html give an empty text; text without any tag is one
block of the page; unclosed tags, comments, scripts and styles end with the page;
repeated rows each get their row; only page_id, url and html are read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# HTML's element classes.
_BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend
li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead
title tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea svg iframe object canvas".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose text is never the article's.
_FURNITURE = frozenset("""head nav footer aside form menu dialog button select option label input
title fieldset legend address""".split())
#: Names, in class, id or role, of what is never an article's text ...
_FURNITURE_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adbox|banner\w*|sponsor\w*|promo\w*|nav\w*|menu\w*|"
    r"breadcrumbs?|footer\w*|comments?\w*|replies|reply|disqus|respond|"
    r"cookies?\w*|consent|gdpr|popup|modal|newsletter|subscribe|signup|login|"
    r"share\w*|sharing|social\w*|pagination|pager|hidden|complementary|contentinfo|navigation)"
    r"(?:$|[\s_-])", re.I)
#: ... and of what often surrounds one, but may also name a part or a kind of it.
_DOUBTFUL_NAME = re.compile(
    r"(?:^|[\s_-])(?:side\w*|foot|header|masthead|notices?|alert|overlay|search\w*|related\w*|"
    r"recommend\w*|widgets?|toolbar|tags?|copyright|legal|disclaimer|skip\w*)(?:$|[\s_-])", re.I)
_TAG = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…、。，！？]")
_CONTAINERS = frozenset("html body div section center td dd".split())
_ARTICLE_FIRST = ("article", "main")
#: Class names that say what an element has or lacks, not what it is.
_HAVING = re.compile(r"(?:^|(?<=\s))(?:no|not|has|have|with|without)[_-]\S+", re.I)
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_FOR, _AGAINST = 2.0, 0.1  # weights of a path in an article element, and under a furniture name


@dataclass(eq=False, slots=True)
class Element:
    """A block element; the page itself is the one without a parent."""

    parent: "Element | None" = None
    tag: str = ""
    path: int = 0             # one number for all elements with the same tags and names up to the root
    depth: int = 0
    furniture: bool = False   # in an element whose text is never the article's
    against: bool = False     # its name always speaks against it
    doubtful: bool = False    # its name may speak against it
    article: bool = False     # in an article or main element (one of comments and the like does not count)
    first: bool = False       # holds the page's first article element or its h1
    dropped: bool = False     # a name speaks against it or what holds it
    certain: bool = False     # and without a doubt
    inside: bool = False      # in the element that holds all content
    text: int = 0             # characters in it, links left out
    articles: int = 0         # those of them in article elements
    links: int = 0            # characters of links in it
    nodes: int = 0            # text nodes in it
    content: int = 0          # content nodes in it


@dataclass(eq=False, slots=True)
class Node:
    """A run of text between tags."""

    element: Element
    block: int                # runs of one block share it
    text: str
    link: bool


def _label(tag: str, attributes: str) -> str:
    names = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes)) if "=" in attributes else ""
    return f"{tag}.{names.lower()}" if names else tag


def _hidden(attributes: str) -> bool:
    return bool(_HIDDEN.search(attributes)) and (
        _HIDDEN.search(_QUOTED.sub('""', attributes)) is not None
        or re.search(r"aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", attributes, re.I) is not None)


def read_page(page: str) -> tuple[list[Element], list[Node]]:
    """The page's elements, parents before children, and its text runs in order."""
    top = Element()
    elements, nodes, stack = [top], [], [top]
    paths: dict[tuple[int, str], int] = {}
    is_open: dict[str, int] = {}           # open elements by tag
    seen_first: set[str] = set()
    block = links = place = 0

    def add(text: str) -> None:
        if text and not text.isspace():
            nodes.append(Node(stack[-1], block, text, links > 0))
        elif text and nodes and nodes[-1].block == block:
            nodes[-1].text += " "  # white space between inline elements

    def close(k: int) -> None:
        for e in stack[k:]:
            is_open[e.tag] -= 1
        del stack[k:]

    while place < len(page):
        found = _TAG.search(page, place)
        if not found:
            add(page[place:])
            break
        add(page[place:found.start()])
        place = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in _BLOCKS:
                block += 1
                if is_open.get(tag):
                    k = len(stack) - 1
                    while stack[k].tag != tag:
                        k -= 1
                    close(k)
                    links = 0
            continue
        if tag in _RAW:
            if not found[3].endswith("/"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, place)
                place = end.end() if end else len(page)
            continue
        if tag == "a":
            links += 1
        elif tag == "br":
            if nodes and nodes[-1].block == block:
                nodes[-1].text += " "  # a line break inside a block is white space
        elif tag in _BLOCKS:
            block += 1
            close(_implied_end(stack, is_open, tag))
            if tag not in _VOID:
                parent = stack[-1]
                label = _label(tag, found[3])
                names = _HAVING.sub("", label.split(".", 1)[1]) if "." in label and tag not in ("html", "body") else ""
                against = bool(names) and _FURNITURE_NAME.search(names) is not None
                doubtful = bool(names) and not against and _DOUBTFUL_NAME.search(names) is not None
                outside_article = not any(is_open.get(t) for t in _ARTICLE_FIRST)
                e = Element(
                    parent, tag, paths.setdefault((parent.path, label), len(paths) + 1), parent.depth + 1,
                    (parent.furniture or tag in _FURNITURE or (tag == "header" and outside_article)
                     or (bool(found[3]) and tag not in ("html", "body") and _hidden(found[3]))),
                    against, doubtful,
                    parent.article or (tag in _ARTICLE_FIRST and not against and not doubtful))
                kind = "article" if tag in _ARTICLE_FIRST else tag
                if kind in ("article", "h1") and kind not in seen_first and not e.furniture:
                    seen_first.add(kind)
                    e.first = not (against and kind == "article")
                elements.append(e)
                stack.append(e)
                is_open[tag] = is_open.get(tag, 0) + 1
                links = 0
    return elements, nodes


#: Elements that the start of another of a kind ends, and what they never end beyond.
_IMPLIED = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
            "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr",)), "th": (("td", "th"), ("tr",)),
            "option": (("option",), ("select",))}


def _implied_end(stack: list[Element], is_open: dict[str, int], tag: str) -> int:
    """From where on the start of a block element closes the open ones without an end tag."""
    k = len(stack)
    if tag in _IMPLIED:
        same, ends = _IMPLIED[tag]
        if any(is_open.get(t) for t in same):
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag in (*same, *ends)), len(stack))
            if k < len(stack) and stack[k].tag in ends:
                k = len(stack)
    elif stack[-1].tag == "p":
        k -= 1
    if tag == "body" and is_open.get("head"):
        k = min(k, next(i for i, e in enumerate(stack) if e.tag == "head"))
    return k


def weigh_names(elements: list[Element], nodes: list[Node]) -> None:
    """Sets ``dropped`` of every element: a name speaks against it or an element around it."""
    for n in nodes:
        e, size = n.element, len(n.text)
        e.nodes += 1
        if n.link:
            e.links += size
        else:
            e.text += size
            e.articles += size if e.article else 0
    for e in reversed(elements[1:]):
        up = e.parent
        up.text, up.articles, up.links, up.nodes = (
            up.text + e.text, up.articles + e.articles, up.links + e.links, up.nodes + e.nodes)
        up.first |= e.first
    page = elements[0]
    usual = page.text / max(1, page.nodes)
    for e in elements[1:]:
        e.certain = e.parent.certain or (e.against and not e.first)
        if e.against:
            spoken = not e.first
        elif e.doubtful and e.parent.article:
            spoken = e.links >= e.text or 2 * e.text < usual * e.nodes
        elif e.doubtful:
            spoken = 2 * e.text <= page.text or 2 * e.articles < page.articles
        else:
            spoken = False
        e.dropped = e.parent.dropped or spoken
    if nodes and all(n.element.dropped for n in nodes) and not any(e.against for e in elements):
        for e in elements:  # doubtful names on everything tell nothing apart
            e.dropped = False


def path_scores(nodes: list[Node], deviation: float = 0.5, width: float = 1.0) -> list[bool]:
    """For each node, whether its smoothed, fused and weighted path ratio passes the threshold."""
    lengths: dict[int, float] = {}
    marks: dict[int, float] = {}
    counts: dict[int, int] = {}
    for n in nodes:
        size, path = len(n.text), n.element.path
        lengths[path] = lengths.get(path, 0.0) + (-size if n.link else size)
        marks[path] = marks.get(path, 0.0) + (0 if n.link else len(_PUNCTUATION.findall(n.text)))
        counts[path] = counts.get(path, 0) + 1
    text = np.array([max(0.0, lengths[n.element.path]) / counts[n.element.path] for n in nodes])
    punctuation = np.array([marks[n.element.path] / counts[n.element.path] for n in nodes])
    reach = np.arange(-3, 4)
    kernel = np.exp(-reach ** 2 / (2 * width ** 2))
    kernel /= kernel.sum()

    def smooth(x: np.ndarray) -> np.ndarray:
        return np.convolve(np.pad(x, 3, mode="edge"), kernel, mode="valid")

    fused = smooth(text) * (1 + smooth(punctuation))
    fused *= [_FOR if n.element.article else 1.0 for n in nodes]
    own = _AGAINST * np.minimum(fused, text * (1 + punctuation))  # borrows nothing of its neighbours
    against = np.array([n.element.dropped for n in nodes], bool)
    fused = np.where(against, own, fused)
    # on an even page the deviation says little: such a path also has to reach a share of the mean
    least = deviation * np.where(against, max(fused.std(), fused.mean()), fused.std())
    return list(fused >= least)


def main_text(page: str | None) -> str:
    """The article's blocks, joined by line feeds."""
    if not page:
        return ""
    elements, every = read_page(page)
    nodes = [n for n in every if not n.element.furniture]
    weigh_names(elements, nodes)
    nodes = [n for n in nodes if not n.element.certain]
    if not nodes:
        return ""
    content = path_scores(nodes)
    if not any(content):
        content = [not n.link for n in nodes]
    inside = _article(elements, nodes, content)
    blocks: dict[int, list[str]] = {}
    for n, keep in zip(nodes, inside):
        if keep:
            blocks.setdefault(n.block, []).append(n.text)
    lines = (" ".join(entities.unescape("".join(parts)).split()) for _, parts in sorted(blocks.items()))
    return "\n".join(line for line in lines if line)


def _article(elements: list[Element], nodes: list[Node], content: list[bool]) -> list[bool]:
    """The content nodes, and what no name speaks against in the element that holds them all."""
    total = sum(content)
    for n, c in zip(nodes, content):
        n.element.content += c
    for e in reversed(elements[1:]):
        e.parent.content += e.content
    if total:
        common = next(n.element for n, c in zip(nodes, content) if c)
        while common.content < total:
            common = common.parent
        while common.depth > 1 and common.tag not in (*_CONTAINERS, *_ARTICLE_FIRST):
            common = common.parent  # a lone paragraph's element is the one around it
    else:
        common = elements[0]
    for e in elements:
        e.inside = e is common or (e.parent is not None and e.parent.inside)
    return [c or (not n.element.dropped and n.element.inside) for n, c in zip(nodes, content)]


def main_text_column(page: Column) -> Column:
    """Main text of a whole html page."""

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p) for p in pages], dtype=object)

    return extract.asNondeterministic()(page)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""
    return (pages.select("page_id", "url", main_text_column(F.col("html")).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
