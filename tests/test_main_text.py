"""Main text against a plain version that looks at every element for every block."""

import os
import re
from html.parser import HTMLParser

import pytest

from dossierforge.operators import html as H
from tests.test_oracles import SF

BLOCKS = "address article aside blockquote br div dd dl dt fieldset footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead tr ul".split()
HOLDERS = ("root", "html", "body", "main", "article", "section", "div", "td")


class Plain(HTMLParser):
    """Well-formed pages as a list of (chain of elements, text, in a link)."""

    def __init__(self, page):
        super().__init__()
        self.open, self.out, self.n = [("root", 0)], [], 0
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        if tag in ("br", "meta", "img", "link", "input", "hr"):
            self.out.append((None, " " if tag == "br" else "\n", False))
            return
        self.n += 1
        self.open.append((tag, self.n))
        if tag in BLOCKS:
            self.out.append((None, "\n", False))

    def handle_endtag(self, tag):
        names = [t for t, _ in self.open]
        if tag in names:
            del self.open[len(names) - 1 - names[::-1].index(tag) :]
        if tag in BLOCKS:
            self.out.append((None, "\n", False))

    def handle_data(self, data):
        names = [t for t, _ in self.open]
        if not {"script", "style", "noscript", "title", "nav", "footer", "aside", "header"} & set(names) and ("head" not in names or "body" in names):
            self.out.append((tuple(self.open), data, "a" in names))


def plain(page):
    runs, fresh = [], True
    for chain, text, link in Plain(page).out:
        if chain is None:
            fresh = fresh or text == "\n"
            if text == " " and runs and not fresh:
                runs[-1][1] += text
        elif fresh and not text.strip():
            continue
        else:
            if fresh:
                runs.append([chain, "", 0])
                fresh = False
            runs[-1][1] += text
            runs[-1][2] += len(text.strip()) if link else 0
    blocks = []
    for chain, text, linked in runs:
        text = " ".join(text.split())
        own = [e for e in chain if e[0] in BLOCKS or e[0] in HOLDERS][-1]
        heading = re.fullmatch("h[1-6]", own[0])
        if text and (heading or 2 * linked <= len(text)):
            inside = chain[: chain.index(own) + 1]
            holders = [i for i, e in enumerate(inside) if e[0] in HOLDERS]
            mark = "#" * int(own[0][1]) + " " if heading else "- " if own[0] == "li" else ""
            worth = 0 if heading else len(text) - linked + 20 * sum(text.count(c) for c in ".,;:!?")
            blocks.append((inside[holders[-1]], inside[holders[-1] - 1] if holders[-1] else None, worth, mark + text))
    elements = {e for h, a, _, _ in blocks for e in (h, a)} - {None}
    score = {e: sum(w for h, _, w, _ in blocks if h == e) + sum(w / 2 for _, a, w, _ in blocks if a == e) for e in elements}
    least = 0.2 * max(score.values(), default=0)
    join = lambda texts: "\n\n".join(dict.fromkeys(texts)) or None
    return join(t for h, _, _, t in blocks if score[h] >= least), join(t for _, _, _, t in blocks)


MADE = [
    "<html><body><div><a href=/>Home</a> <a href=/b>Blog</a></div><div><div><h1>Title</h1><p>A longer paragraph, with commas, and so on, and more of it, as texts go. One, two. Three<br>four.</p><ul><li>item</li><li><a href=x>link</a></li></ul></div><div><p>Second part, of the text.</p></div></div><div>Buy.</div></body></html>",
    "<body>Bare text, here. <b>Bold</b> end<table><tr><td>Cell, one.</td><td><a href=x>Only a link</a></td></tr></table></body>", "<p>Same.</p><p>Same.</p><h2><a href=x>Linked head</a></h2>", "", "<nav>no</nav><footer>no</footer>", "plain",
]


@pytest.mark.parametrize("page", MADE)
def test_made_pages(page):
    assert H._main(H._parse(page)) == plain(page)


def test_precision_leaves_out_what_is_apart():
    precision, recall = H._main(H._parse(MADE[0]))
    assert "Buy." not in precision and "Buy." in recall and "Home" not in recall and "Three four." in precision and "# Title" in precision and "- item" in precision


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_given_pages(spark):
    pages = [r["html"] for d in (SF, SF.replace("0.001", "0.01")) for r in spark.read.parquet(f"{d}/pages.parquet").collect()]
    # an unclosed paragraph ends where the next begins in a browser; the plain version needs that written out
    assert [H._main(H._parse(x)) for x in pages] == [plain(x) for x in pages]
    assert all(p and len(p) <= len(r) for p, r in (H._main(H._parse(x)) for x in pages))
