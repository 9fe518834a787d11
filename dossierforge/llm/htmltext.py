"""Main text of web pages by tag-path ratios: text and punctuation per root-to-leaf path, smoothed, fused and thresholded."""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common

#: Markup: comments, declarations, and tags. A quote counts behind an equals sign, and if another one follows; a tag that never ends goes on to the end.
_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
#: Elements whose content is text up to their end tag.
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that don't begin a block and aren't part of a path.
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var".split())
#: Elements that hold no text of the page.
_DROPPED = set("head script style noscript template svg iframe select option textarea canvas audio video".split())
#: Elements that stand apart from the article as a rule: what is in them scores less.
_APART = set("nav footer aside form object button dialog map menu".split())
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Words in class, id or role that mark what is not the article.
_MARKED = set(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer contentinfo complementary masthead ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored "
    "cookie cookies consent gdpr notice notices notification alert disclaimer popup modal overlay dialog newsletter subscribe subscription signup login social share sharing sharebar related recommended recommendations "
    "comment comments commentlist disqus reply replies respond discussion widget toolbar pagination pager search skip".split()
)
_HEADER = {"header", "topbar", "masthead", "banner"}
#: Words that make a class tell of a page's layout or state: has-sidebar, no-sidebar, comments-open.
_BEFORE = {"has", "no", "not", "with", "without", "hide", "show"}
_AFTER = {"open", "opened", "closed", "on", "off", "enabled", "disabled", "active", "inactive", "visible", "collapsed"}
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")
#: Elements that may be the article's container.
_CONTAINERS = {"", "html", "body", "article", "main", "section", "div", "td", "center"}
#: What a start tag closes if it is open (in the same container).
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_STOPS = {"ul": {"li"}, "ol": {"li"}, "dl": {"dt", "dd"}, "table": {"tr", "td", "th"}}
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
#: A block is content if its score is this share of the score that the page's characters have on average.
THRESHOLD = 0.6
#: The article's container is the smallest that holds this share of the content's characters.
SHARE = 0.6
#: What stands apart has so much of its score.
APART = 0.03
#: A block inside the content's container is worth so much of the container's own score, if that is more than its path's.
LENT = 0.9


class _Element:
    __slots__ = ("tag", "parent", "depth", "path", "block", "outer", "dropped", "apart", "article", "marked", "banner", "keeps", "text", "mass", "worth", "chosen", "inside", "header", "link")

    def __init__(self, tag: str, label: str, parent: _Element | None, dropped: bool, words: set[str], paths: dict[tuple[int, str], int]):
        self.tag, self.parent, self.link = tag, parent, tag == "a"
        self.depth = 0 if parent is None else parent.depth + 1
        self.path = paths.setdefault((-1 if parent is None else parent.path, label), len(paths))  # the root-to-leaf path, by number
        self.block = parent.block if tag in _INLINE else self
        self.article = tag in ("article", "main") or parent is not None and parent.article
        self.outer = parent.outer if parent is not None and parent.outer is not None else self if self.article else None
        self.header = tag == "header" or parent is not None and parent.header
        self.dropped = dropped or parent is not None and parent.dropped
        self.apart = tag in _APART or tag == "header" and not self.article or parent is not None and parent.apart
        self.marked, self.banner = not words.isdisjoint(_MARKED), not words.isdisjoint(_HEADER)
        self.keeps = self.inside = False
        self.text = self.chosen = 0
        self.mass = self.worth = 0.0


class _Block:
    __slots__ = ("pieces", "parts", "element", "linked")

    def __init__(self, element: _Element):
        self.pieces: list[tuple[str, _Element, bool]] = []
        self.parts: list[str] = []
        self.element = element
        self.linked = 0


def _element(tag: str, attributes: str, parent: _Element, paths: dict[tuple[int, str], int]) -> _Element:
    label, dropped = tag, tag in _DROPPED
    words: set[str] = set()
    if attributes and not attributes.isspace():
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            name = name.lower()
            value = a or b or c
            if name in ("class", "id", "role"):
                for one in value.split():
                    found = [w.lower() for w in _WORDS.findall(one)]
                    if len(found) < 2 or found[0] not in _BEFORE and found[-1] not in _AFTER:
                        words.update(found)
                if name == "class" and value.strip():
                    label = f"{tag}.{value.split()[0]}"
            elif name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                dropped = True
    return _Element(tag, label, parent, dropped, set() if tag in ("html", "body") or tag in _HEADINGS else words, paths)


def _judge(elements: list[_Element], blocks: list[_Block]) -> None:
    """Fill in the blocks' parts, and say which elements stand apart because a class, id or role says so.

    A mark sets no element apart that holds an article, nor, on a page without one, most of the text. If only headings
    and links are outside the marks, the marks say nothing. elements has parents first."""
    for b in blocks:
        for piece, e, on_link in b.pieces:
            if not on_link:
                e.text += len(piece.strip())
    for e in reversed(elements):
        e.keeps = e.keeps or e.tag in ("article", "main") and not e.marked and e.text > 0
        if e.parent is not None:
            e.parent.text += e.text
            e.parent.keeps = e.parent.keeps or e.keeps
    root = elements[0]
    hidden, banners = set(), set()
    for e in elements[1:]:
        if e.parent in hidden:
            hidden.add(e)
        elif (e.marked or e.banner) and e.tag not in ("main", "article") and not (e.keeps if root.keeps else 2 * e.text > root.text):
            if e.marked or not e.parent.article:
                hidden.add(e)
            else:
                banners.add(e)
        if e.parent in banners:
            banners.add(e)
    if not any(e not in hidden and not e.apart and not on_link and b.element.tag not in _HEADINGS and not piece.isspace() for b in blocks for piece, e, on_link in b.pieces):
        hidden = banners = set()
    for e in banners:
        e.header = True
    for e in hidden:
        e.apart = True
    for b in blocks:
        for piece, _, on_link in b.pieces:
            if b.parts or not piece.isspace():
                b.parts.append(piece)
                if on_link:
                    b.linked += len(piece)


def _blocks(page: str) -> tuple[list[_Block], list[_Element]]:
    """The page's blocks in order, and its elements, parents first."""
    paths: dict[tuple[int, str], int] = {}
    root = _Element("", "", None, False, set(), paths)
    stack, elements, blocks, current, at, links = [root], [root], [], None, 0, 0
    opened: dict[str, int] = defaultdict(int)
    find, last = _MARKUP.search, max(page.rfind(">"), page.rfind("<!--"))

    def close(i: int) -> None:
        """Close the open elements from the i-th on."""
        nonlocal links
        for e in stack[i:]:
            links -= e.link
            opened[e.tag] -= 1
        del stack[i:]

    def text(piece: str) -> None:
        nonlocal current
        if not piece or stack[-1].dropped:
            return
        if current is None:
            if piece.isspace():
                return
            current = _Block(stack[-1].block)
            blocks.append(current)
        current.pieces.append((piece, stack[-1], links > 0))

    while True:
        m = find(page, at) if at <= last else None
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:  # an end tag
            if tag not in _INLINE:
                current = None
            for i in range(len(stack) - 1 if opened[tag] else 0, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if tag in _INLINE and stack[i].tag not in _INLINE:  # an inline end tag closes nothing outside its block
                    break
            continue
        attributes = m[3]
        if tag == "br":
            if current is not None:
                current.pieces.append((" ", stack[-1], False))
            continue
        if tag not in _INLINE:
            current = None
            for i in range(len(stack) - 1 if opened["p"] and tag not in _VOID else 0, 0, -1):
                if stack[i].tag == "p":  # a block closes an open paragraph
                    close(i)
                    break
                if stack[i].tag not in _INLINE:
                    break
            if tag in _CLOSES and any(opened[x] for x in _CLOSES[tag]):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in _CLOSES[tag]:
                        close(i)
                        break
                    if stack[i].tag in _STOPS and tag in _STOPS[stack[i].tag] or stack[i].tag in _CONTAINERS and stack[i].tag != "td":
                        break
        if tag in _VOID:
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if attributes.rstrip().endswith("/") and tag in _DROPPED | _APART:
            continue
        if tag == "html" and len(stack) > 1 or tag == "body" and opened["body"]:
            continue
        if tag == "body":  # an open head ends here
            close(next((i + 1 for i, e in enumerate(stack) if e.tag == "html"), 1))
        stack.append(_element(tag, attributes, stack[-1], paths))
        elements.append(stack[-1])
        opened[tag] += 1
        links += stack[-1].link
    _judge(elements, blocks)
    return blocks, elements


def _smooth(x: np.ndarray) -> np.ndarray:
    """A Gaussian of three taps over the nodes in page order."""
    if len(x) < 3:
        return x
    wide = np.concatenate([x[:1], x, x[-1:]])
    return 0.25 * wide[:-2] + 0.5 * wide[1:-1] + 0.25 * wide[2:]


def _scores(blocks: list[_Block], texts: list[str], linked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score of each block's path, fused value of each block, characters outside links).

    A path's ratios are its characters and its punctuation, outside links, by block; they are smoothed over the blocks in page order
    and fused, and the mean over a path's blocks is its score. What stands apart has a share of it.
    """
    _, path, count = np.unique([b.element.path for b in blocks], return_inverse=True, return_counts=True)
    length = np.array([len(t) for t in texts]) * (1 - linked)
    marks = np.array([len(_PUNCTUATION.findall(t)) for t in texts]) * (1 - linked)
    of_path = np.bincount(path, weights=length)
    fused = _smooth((of_path / count)[path]) * (1 + _smooth((np.bincount(path, weights=marks) / count)[path]))
    score = np.bincount(path, weights=fused) / count
    share = np.array([APART if _apart(b) else 1.0 for b in blocks])
    return np.where(of_path > 0, score, 0.0)[path] * share, fused * share, length


def _apart(b: _Block) -> bool:
    """Of an article's header only headings belong to it."""
    return b.element.apart or b.element.header and b.element.tag not in _HEADINGS


def _lend(blocks: list[_Block], elements: list[_Element], linked: np.ndarray, fused: np.ndarray, length: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """What the container of the content lends each block: a share of the score that the container's characters have on average.

    The container is the article that has all chosen blocks, or else the smallest element that holds them all, which lends to headings, paragraphs
    and parts of articles that have content. What is in links to a part gets that much less."""
    for b, n, f, on in zip(blocks, length, fused, chosen, strict=True):
        if on:
            b.element.mass += n
            b.element.chosen += 1
        b.element.worth += n * f
        b.element.text += n
    for e in reversed(elements[1:]):
        e.parent.mass += e.mass
        e.parent.chosen += e.chosen
        e.parent.worth += e.worth
        e.parent.text += e.text
    root = elements[0]
    holds = [e for e in elements if e.tag in _CONTAINERS]
    best = max((e for e in holds if e.mass >= SHARE * root.mass), key=lambda e: e.depth, default=root)
    area = max((e for e in holds if e.chosen == root.chosen), key=lambda e: e.depth, default=root)
    best = best.outer or best
    articles = {b.element.outer for b, on in zip(blocks, chosen, strict=True) if on} - {None}
    if articles == {best}:
        area = best
    for e in elements:
        e.inside = e is area or e.parent is not None and e.parent.inside
    open_ = np.array([b.element.inside and not _apart(b) and (b.element.tag in _HEADINGS or b.element.tag == "p" or b.element.outer in articles) for b in blocks])
    kept = np.array([1.0 if b.element.tag in _HEADINGS else 1.0 - x for b, x in zip(blocks, linked, strict=True)])
    return np.where(open_, LENT * area.worth / max(area.text, 1e-9) * np.where(kept > 0.5, kept, 0.0), 0.0)


def extract(page: str, threshold: float = THRESHOLD) -> str:
    """The article's blocks, white space in each made one space, joined by line feeds: those whose score reaches the threshold.

    A block's score is its path's, or what the content's container lends it, if that is more.
    """
    found, elements = _blocks(page)
    blocks, texts = [], []
    for b in found:
        t = " ".join(entities.unescape("".join(b.parts)).split())
        if t:
            blocks.append(b)
            texts.append(t)
    if not blocks:
        return ""
    linked = np.array([min(1.0, b.linked / max(1, sum(map(len, b.parts)))) for b in blocks])
    if linked.min() == 1:  # all is links
        linked[:] = 0
    score, fused, length = _scores(blocks, texts, linked)
    limit = threshold * (length * fused).sum() / max(length.sum(), 1e-9)
    for e in elements:
        e.text = 0.0
    score = np.maximum(score, _lend(blocks, elements, linked, fused, length, (score >= limit) & (score > 0)))
    return "\n".join(t for t, x in zip(texts, score, strict=True) if x >= limit and x > 0)


def extract_text(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) with text and n_chars: the main text of each page.

    Null and empty html give an empty text, as do pages without text of their own; page_id and url are carried as they are, null or
    repeated. Broken markup is read as it stands: what is never closed ends with its parent. Extra columns are ignored. A page is worked on alone, whole, whatever its length.
    """
    types = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                texts = [extract(x.as_py() or "") for x in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars bigint")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(common.table(spark, sf_dir, "pages"))
