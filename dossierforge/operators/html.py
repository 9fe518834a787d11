"""Reading pages: links, footers, visible and structured text, favicons, metadata, main text. Arrow UDFs around the standard parser."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import domains as D
from ..functions import text as T
from ..functions import vocab as V

_BLOCK = frozenset(V.BLOCK_TAGS)
_SKIP = frozenset({"script", "style", "noscript"})
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_ITEMPROPS = ("streetAddress", "postalCode", "addressLocality", "addressRegion", "addressCountry")


#: Elements around the main text, and those that hold blocks of it.
_APART = frozenset({"nav", "footer", "aside", "header"})
_HOLDERS = frozenset({"", "html", "body", "main", "article", "section", "div", "td"})
#: Precision takes blocks whose holder scores so much of what the best one does; a mark of punctuation is worth so many characters.
HOLDER_SHARE, MARK = 0.2, 20


class _Block:
    """Text between the edges of block elements. node: the element that it stands in."""

    def __init__(self, node: int):
        self.node, self.parts, self.linked = node, [], 0


class _Page(HTMLParser):
    """One pass over a page, collecting what all operators need."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.base, self.links, self.icons, self.meta, self.json = None, [], [], {}, []
        self.footers: list[list[str]] = []
        self.addresses: list[list[str]] = []
        self.body: list[str] = []
        self.items: dict[str, list[str]] = {}
        self.title: list[str] = []
        self.source, self.title_source, self._title_from = "", None, None
        self.nodes: list[tuple[str, int]] = [("", -1)]  # (tag, parent) of every element that can hold text
        self.blocks: list[_Block] = []
        self._at: list[int] = [0]
        self._fresh = True
        self._item: tuple[str, int] | None = None
        self._ld: list[str] | None = None

    def feed(self, data):
        self.source += data
        super().feed(data)

    def _here(self) -> int:
        """Where the tag that is being read begins in the source."""
        line, offset = self.getpos()
        at = 0
        for _ in range(line - 1):
            at = self.source.index("\n", at) + 1
        return at + offset

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "title" and self._title_from is None:
            self._title_from = self._here() + len(self.get_starttag_text())
        if tag == "base" and self.base is None:
            self.base = a.get("href")
        elif tag == "a" and "href" in a:
            self.links.append(a["href"])
        elif tag == "link" and "icon" in a.get("rel", "").lower():
            self.icons.append((a.get("rel", "").lower(), a.get("href", ""), a.get("sizes", "").lower()))
        elif tag == "meta":
            name = (a.get("property") or a.get("name") or "").lower()
            self.meta.setdefault(name, a.get("content", ""))
            if a.get("itemprop") in _ITEMPROPS:
                self.items.setdefault(a["itemprop"], []).append(a.get("content", ""))
        if tag == "script" and a.get("type", "").lower() == "application/ld+json":
            self._ld = []
        if tag in _BLOCK:
            self._text("\n")
            self._fresh = self._fresh or tag != "br"
        if tag in _VOID:
            return
        self.stack.append(tag)
        self.nodes.append((tag, self._at[-1]))
        self._at.append(len(self.nodes) - 1)
        if tag == "footer":
            self.footers.append([])
        elif tag == "address":
            self.addresses.append([])
        if a.get("itemprop") in _ITEMPROPS:
            self._item = (a["itemprop"], len(self.stack))
            self.items.setdefault(a["itemprop"], []).append("")

    def handle_endtag(self, tag):
        if tag in _BLOCK:
            self._text("\n")
            self._fresh = True
        if tag == "title" and self._title_from is not None and self.title_source is None:
            self.title_source = self.source[self._title_from : self._here()]
        if tag in self.stack:
            closed = ""
            while closed != tag:
                closed = self.stack.pop()
                self._at.pop()
        if self._item and len(self.stack) < self._item[1]:
            self._item = None
        if tag == "script" and self._ld is not None:
            self.json.append("".join(self._ld))
            self._ld = None

    def handle_data(self, data):
        if self._ld is not None:
            self._ld.append(data)
        elif not _SKIP & set(self.stack[-1:]):
            self._text(data)

    def _text(self, s):
        if "title" in self.stack:
            self.title.append(s)
            return
        if "head" in self.stack and "body" not in self.stack:
            return
        self.body.append(s)
        if "footer" in self.stack and self.footers:
            self.footers[-1].append(s)
        if "address" in self.stack and self.addresses:
            self.addresses[-1].append(s)
        if self._item:
            self.items[self._item[0]][-1] += s
        if not _APART & set(self.stack):
            if self._fresh and s.strip():
                self.blocks.append(_Block(next((i for i in reversed(self._at) if self.nodes[i][0] in _BLOCK or self.nodes[i][0] in _HOLDERS), 0)))
                self._fresh = False
            if not self._fresh:
                self.blocks[-1].parts.append(s)
                if "a" in self.stack:
                    self.blocks[-1].linked += len(s.strip())


def _lines(parts: list[str]) -> str | None:
    text = re.sub("[ \t\xa0\r\f\v]+", " ", "".join(parts))
    return "\n".join(x for x in (s.strip() for s in text.split("\n")) if x) or None


def _inline(text: str) -> str:
    return re.sub(r"\s+", " ", text).strip()


def _postal(node) -> list[str]:
    """The parts of every PostalAddress in a JSON-LD value, in a fixed order."""
    out = []
    if isinstance(node, list):
        for x in node:
            out += _postal(x)
    elif isinstance(node, dict):
        kind = node.get("@type")
        if any(isinstance(k, str) and k.lower() == "postaladdress" for k in (kind if isinstance(kind, list) else [kind])):
            country = node.get("addressCountry")
            values = [node.get(k) for k in _ITEMPROPS[:4]] + [country.get("name") if isinstance(country, dict) else country]
            line = ", ".join(_inline(v) for v in values if isinstance(v, str) and v.strip())
            if line:
                out.append(line)
        for v in node.values():
            out += _postal(v)
    return out


def _parse(page: str | None, p: HTMLParser | None = None) -> HTMLParser:
    p = p or _Page()
    try:
        p.feed(page or "")
        p.close()
    except (AssertionError, ValueError):  # the parser's own limits; what was read so far counts
        pass
    return p


def _structured(p: _Page) -> str | None:
    out = []
    for raw in p.json:
        try:
            out += _postal(json.loads(raw))
        except ValueError:
            continue
    out += [x for x in (_lines(a) for a in p.addresses) if x]
    line = ", ".join(_inline(x) for k in _ITEMPROPS for x in p.items.get(k, []) if x.strip())
    return "\n".join(dict.fromkeys([*out, line] if line else out)) or None


def _main(p: _Page) -> tuple[str | None, str | None]:
    """(precision, recall): the main text with headings and items marked, each block once.

    A block is worth its characters outside links and its punctuation; one that is mostly links is worth nothing. What blocks are worth goes to the element that
    holds them, and half of it to the one around that. Recall takes every block that isn't mostly links; precision those of holders that
    come near the best one.
    """
    found, score = [], {}
    for b in p.blocks:
        text = _inline("".join(b.parts))
        tag = p.nodes[b.node][0]
        heading = tag[:1] == "h" and tag[1:].isdigit()
        if not text or 2 * b.linked > len(text) and not heading:
            continue
        holder = b.node
        while p.nodes[holder][0] not in _HOLDERS:
            holder = p.nodes[holder][1]
        worth = 0 if heading else len(text) - b.linked + MARK * len(re.findall(r"[.,;:!?]", text))
        score[holder] = score.get(holder, 0) + worth
        around = p.nodes[holder][1]
        if around >= 0:
            score[around] = score.get(around, 0) + worth / 2
        found.append((holder, ("#" * int(tag[1]) + " " if heading else "- " if tag == "li" else "") + text))
    least = HOLDER_SHARE * max(score.values(), default=0)
    join = lambda texts: "\n\n".join(dict.fromkeys(texts)) or None
    return join(t for h, t in found if score[h] >= least), join(t for _, t in found)


PAGE = "links array<string>, base string, icons array<struct<rel:string,href:string,sizes:string>>, title string, title_source string, description string, sitename string, footer_text string, visible_text string, structured_text string, markdown string, recall string"
_TEXTS = pa.list_(pa.string())
_KINDS = {"string": pa.string(), "array<string>": _TEXTS, "array<struct<rel:string,href:string,sizes:string>>": pa.list_(pa.struct([(k, pa.string()) for k in ("rel", "href", "sizes")]))}
_PAGE = pa.struct([(name, _KINDS[kind]) for name, kind in (c.split(" ") for c in re.split(r", (?![^<]*>)", PAGE))])

#: A task hands on what it made of its rows when it has so many of them, or has read so many characters: both ends of it then stay small, whatever Spark sends at once.
ROWS, CHARS = 256, 1 << 20


def _portions(made: Iterable[tuple[int, object]], kind: pa.DataType) -> Iterator[pa.Array]:
    """(characters read, result) of each row to arrays of results."""
    out, chars = [], 0
    for n, x in made:
        out.append(x)
        chars += n
        if len(out) >= ROWS or chars >= CHARS:
            yield pa.array(out, kind)
            out, chars = [], 0
    if out:
        yield pa.array(out, kind)


def _once(f: Callable, kind: str) -> Callable[..., Column]:
    """f as a function of columns that runs once a row: a filter on what it gives would otherwise be pushed below it and run it a second time, before rows are spread."""
    return F.arrow_udf(f, kind).asNondeterministic()


def read_page(html: Column | str) -> Column:
    """Everything that the operators below take from a page, as a struct; broken markup is read as far as it goes.

    title is the page's best title as a reader sees it, title_source what its first title element holds, character references as they are spelled."""
    return _once(_read, PAGE)(html)


def _read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    pages = (x.as_py() for html in batches for x in html)
    return _portions(((len(page or ""), _row(page)) for page in pages), _PAGE)


def _row(page: str | None) -> dict:
    p = _parse(page)
    title = _inline("".join(p.title)) or None
    precision, recall = _main(p)
    return {
        "links": p.links, "base": p.base, "icons": [{"rel": r, "href": h, "sizes": s} for r, h, s in p.icons],
        "title": p.meta.get("og:title") or title, "title_source": p.title_source, "description": p.meta.get("description") or p.meta.get("og:description") or None, "sitename": p.meta.get("og:site_name") or None,
        "footer_text": "\n".join(x for x in (_lines(f) for f in p.footers) if x) or None, "visible_text": _lines(p.body), "structured_text": _structured(p),
        "markdown": precision, "recall": recall,
    }


def absolute(base: Column, own: Column, links: Column) -> Column:
    """links resolved against the page's base, or its own URL; those that can't be are left out."""
    return _once(_absolute, "array<string>")(base, own, links)


def _absolute(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    rows = ([x.as_py() for x in row] for columns in batches for row in zip(*columns, strict=True))
    return _portions(((sum(len(x or "") for x in links or []), _resolved(base, own, links or [])) for base, own, links in rows), _TEXTS)


def _resolved(base: str | None, own: str | None, links: list[str]) -> list[str]:
    out = []
    for x in links:
        try:
            out.append(urljoin(urljoin(own, base) if base else own, x))
        except ValueError:
            continue
    return out


class _Links(HTMLParser):
    """The base and the links of a page, nothing else."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.base, self.links = None, []

    def handle_starttag(self, tag, attrs):
        if tag in ("a", "base"):
            href = next((v or "" for k, v in reversed(attrs) if k == "href"), None)
            if tag == "a" and href is not None:
                self.links.append(href)
            elif tag == "base" and self.base is None:
                self.base = href


def page_links(html: Column | str, url: Column | str) -> Column:
    """The absolute links of a page in document order, read and resolved in one pass."""
    return _once(_page_links, "array<string>")(html, url)


def _page_links(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    rows = ((x.as_py(), own.as_py()) for html, url in batches for x, own in zip(html, url, strict=True))
    return _portions(((len(page or ""), _links(page, own)) for page, own in rows), _TEXTS)


def _links(page: str | None, own: str | None) -> list[str]:
    p = _parse(page, _Links())
    return _resolved(p.base, own, p.links)


def spread(d: DataFrame) -> DataFrame:
    """d over all cores, if it has fewer partitions than those: a small file is one partition, however long its pages take to read."""
    n = d.sparkSession.sparkContext.defaultParallelism
    return d.repartition(n) if d.rdd.getNumPartitions() < n else d


def internal_links(pages: DataFrame, url: str = "url", key: str = "page_id", links: Column | None = None) -> DataFrame:
    """pages(key, url, page struct) to a row per internal link, in document order, each once: pos, link. links: the page's absolute links, where they are there already."""
    found = absolute(F.col("page.base"), F.col(url), F.col("page.links")) if links is None else links
    d = pages.select(key, F.col(url).alias("own"), found.alias("found")).where(F.size("found") > 0).withColumn("own_domain", D.registered_domain(F.col("own")))
    d = d.select(key, "own", "own_domain", F.posexplode("found").alias("pos", "link"))
    d = d.where(F.col("link").rlike("(?i)^https?://")).where(D.registered_domain(F.col("link")) == F.col("own_domain"))
    d = d.where(~T.has_excluded_extension(T.url_path(F.col("link"))))
    d = d.withColumn("link", F.regexp_replace("link", r"[?#].*$", "")).where(F.col("link") != F.regexp_replace("own", r"[?#].*$", ""))
    first = Window.partitionBy(key, "link").orderBy("pos")
    return d.withColumn("rn", F.row_number().over(first)).where("rn = 1").select(key, "pos", "link")


def favicon_rank(rel: Column, sizes: Column, pos: Column) -> Column:
    """Least is best: 512 and above ascending, then below descending, others before shortcut icons, then document order."""
    edges = F.transform(F.regexp_extract_all(F.coalesce(sizes, F.lit("")), F.lit("([0-9]+)x([0-9]+)"), F.lit(0)), lambda x: F.greatest(F.substring_index(x, "x", 1).cast("int"), F.substring_index(x, "x", -1).cast("int")))
    size = F.when(F.coalesce(sizes, F.lit("")).contains("any"), 512).when(F.size(edges) > 0, F.array_max(edges)).otherwise(16)
    return F.struct((size < 512).cast("int"), F.when(size >= 512, size).otherwise(-size), rel.contains("shortcut").cast("int"), pos)


def best_favicon(icons: DataFrame, key: str) -> DataFrame:
    """icons(key, rel, href, sizes, pos) to the best href of each key."""
    return icons.groupBy(key).agg(F.min_by("href", favicon_rank(F.col("rel"), F.col("sizes"), F.col("pos"))).alias("favicon_url"))


def first_blocks(blocks: DataFrame, scope: str, page: str, pos: str = "pos", text: str = "text") -> DataFrame:
    """Each block of text once in its scope, where it is first."""
    w = Window.partitionBy(scope, F.xxhash64(text), text).orderBy(page, pos)
    return blocks.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
