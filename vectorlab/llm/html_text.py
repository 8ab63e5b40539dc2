"""Main text of web pages by composite text density.

A page is read into a tree of its elements. For every block element the characters, tags, link characters and
link tags below it give its composite text density: characters per tag, adjusted by how much of the text is
linked, here and on the whole page. The densities of an element's children (and of its own text) are added up,
and the element with the largest sum is the core. The smallest density on the way from the body to the core is
the threshold: beside that way, other elements that reach it belong to the text too, and so do headings. Where the
core stands in an `article` or `main` element, that element is the text.

Elements that never hold main text (scripts, buttons, hidden ones) are left out before anything is counted. So are those that
seldom do: forms, menus, page headers and footers, asides, and those with a class, id or role that names a notice,
advert, sidebar, comments and so on. A class names what its last word says, boxes and lists aside: `post-comments` and `comment-list`
do, `search-result` and `no-sidebar` don't. But these stay, for the density to decide, where they wrap the page: where the
page's only articles or main elements are in such elements, or where one holds most of the unlinked text and a main heading or nearly
all that is not left out. If only labels have left nothing, they don't count.

Null, empty and unparsable pages give an empty text. Unclosed and misplaced tags, quotes and comments are
closed where browsers would, or at the end of the page. A page's cost is linear in its length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARKUP = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
LABEL = re.compile(r"[a-z]+")

# Fixed values of HTML and of common page layouts
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rb rt rp s samp small span "
                    "strike strong sub sup time tt u var wbr").split())
#: These are no blocks either: they leave the text around them in one piece, whatever they hold.
UNSPACED = INLINE | frozenset(("audio button canvas embed iframe img input map math noscript object picture script select source style svg template "
                               "textarea track video").split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINER = frozenset("article main".split())
NEVER = RAW | frozenset("head nav footer aside form button select option input dialog menu svg math canvas object audio video map datalist fieldset".split())
CLOSES_P = frozenset(("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                      "header hgroup hr main menu nav ol p pre section table ul").split())
#: These may wrap a page by mistake or for technical reasons; the others of NEVER can't hold main text.
WRAPS = frozenset("nav footer aside form dialog menu fieldset".split())
#: An element of the key closes an open element of the value's names, unless one of the value's bounds is in between.
CLOSES = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"),
    "th": ("td th", "tr table"), "tbody": ("thead tbody tfoot", "table"), "tfoot": ("thead tbody tfoot", "table"), "option": ("option", "select"),
}
CLOSES = {tag: (frozenset(names.split()), frozenset(bounds.split())) for tag, (names, bounds) in CLOSES.items()}
NOISE = frozenset(("ad ads advert advertisement adverts advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
                   "alert sidebar sidenav nav navbar navigation menu breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar comment "
                   "comments disqus replies respond share sharing social related recommended newsletter subscribe subscription signup login popup "
                   "modal overlay widget widgets skip contentinfo complementary search").split())
#: Last words of a class that say nothing of its role, and words that say that something else has what is named, or has not.
BOX = frozenset(("area bar block body box col column container content group inner item items link links left list outer panel right section sections "
                 "top bottom unit wrap wrapper").split())
ABOUT = frozenset("no not non without with has have hide hidden show is in to after before".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar toolbar".split())


KEPT, LABELLED, WRAP, LEFT_OUT = range(4)


@lru_cache(4096)
def names_noise(token: str) -> bool:
    """Whether a class or id names a part of a page beside the main text."""
    words = LABEL.findall(token)
    while len(words) > 1 and words[-1] in BOX:
        words.pop()
    return bool(words) and words[-1] in NOISE and ABOUT.isdisjoint(words)


class Page:
    """Elements in the order they open, each with its parent, and the texts between tags."""

    def __init__(self, html: str):
        self.tag, self.parent, self.last, self.flag, self.label = [""], [-1], [0], [KEPT], [False]
        self.texts: list[tuple[int, str]] = []
        self.stack = [0]
        #: Where in the stack the open elements of a tag are, and those that are not inline.
        self.open: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self._read(html)
        while self.stack:
            self._pop()

    def _pop(self) -> None:
        node = self.stack.pop()
        self.last[node] = len(self.tag)
        tag = self.tag[node]
        if node:
            self.open[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()
        if tag not in UNSPACED:
            self.texts.append((max(self.parent[node], 0), " "))

    def _top(self, names: Iterable[str]) -> int:
        """Place in the stack of the innermost open element of these tags; 0 without one."""
        return max((self.open[name][-1] for name in names if self.open.get(name)), default=0)

    def _pop_to(self, names: frozenset[str], bounds: frozenset[str]) -> None:
        at = self._top(names)
        if at > self._top(bounds):
            while len(self.stack) > at:
                self._pop()

    def _open(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body") and tag in self.tag[:4]:
            return
        if tag in CLOSES_P:
            self._pop_to(frozenset(["p"]), frozenset("td th table button caption div article section".split()))
        if tag in HEADING:
            self._pop_to(HEADING, frozenset("div section article td".split()))
        if tag in CLOSES:
            self._pop_to(*CLOSES[tag])
        if tag == "body":
            self._pop_to(frozenset(["head"]), frozenset())
        here = self.stack[-1]
        if tag == "br" or tag == "hr":
            self.texts.append((here, " "))
        elif tag not in UNSPACED:
            self.texts.append((here, " "))
        self.tag.append(tag)
        self.parent.append(here)
        self.last.append(len(self.tag))
        flag, label = self._flag(tag, attributes)
        self.flag.append(flag)
        self.label.append(label)
        if tag not in VOID:
            self.open.setdefault(tag, []).append(len(self.stack))
            if tag not in INLINE:
                self.blocks.append(len(self.stack))
            self.stack.append(len(self.tag) - 1)

    def _flag(self, tag: str, attributes: str) -> tuple[int, bool]:
        """Whether an element is left out, taken by itself, and whether its attributes name noise."""
        if tag in NEVER and tag not in WRAPS:
            return LEFT_OUT, False
        label = False
        for name, *values in ATTRIBUTE.findall(attributes) if attributes and tag not in ("html", "body") else ():
            name, value = name.lower(), "".join(values).lower()
            if tag not in CONTAINER:
                if name == "hidden" or name == "aria-hidden" and value == "true":
                    return LEFT_OUT, False
                if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                    return LEFT_OUT, False
            label |= name == "role" and value.strip() in NOISE_ROLES or name in ("class", "id") and any(map(names_noise, value.split()))
        if tag in WRAPS or tag == "header" and not self._top(CONTAINER):
            return WRAP, label
        return LABELLED if label and tag not in CONTAINER else KEPT, label

    def _close(self, tag: str) -> None:
        at = self._top([tag])
        bound = self.blocks[-1] if tag in INLINE and self.blocks else 0
        if tag not in ("html", "body", "table"):
            bound = max(bound, self._top(("body", "table")))
        if at > bound:
            while len(self.stack) > at:
                self._pop()

    def _read(self, html: str) -> None:
        at = 0
        while at < len(html):
            found = MARKUP.search(html, at)
            end = found.start() if found else len(html)
            if end > at:
                self.texts.append((self.stack[-1], unescape(html[at:end])))
            if not found:
                return
            at = found.end()
            tag = (found[2] or "").lower()
            if not tag:
                continue
            if found[1]:
                self._close(tag)
                continue
            self._open(tag, found[3])
            if tag in RAW:
                close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(html, at)
                at = close.start() if close else len(html)


def _density(chars: float, tags: float, link_chars: float, link_tags: float, page_links: float) -> float:
    """Composite text density; page_links: linked share of the page's characters."""
    if not chars:
        return 0.0
    plain = chars / max(tags, 1)
    if not page_links:
        return plain
    ratio = chars / max(link_chars, 1) * max(tags, 1) / max(link_tags, 1)
    base = math.log(chars / max(chars - link_chars, 1) * link_chars + page_links * chars + math.e)
    return plain * max(math.log(ratio), 0.0) / math.log(base)


def _noise(page: Page, sizes: list[int], linked: list[bool]) -> list[bool]:
    """Which elements are left out, themselves or with one above. sizes: characters of the page's texts."""
    n, tag, flag = len(page.tag), page.tag, page.flag

    def above(wanted: list[bool]) -> list[int]:
        """How many wanted elements each element stands in or is."""
        out = [0] * n
        for v in range(1, n):
            out[v] = out[page.parent[v]] + wanted[v]
        return out

    never, deep = above([f == LEFT_OUT for f in flag]), above([f != KEPT for f in flag])
    plain = [0] * n
    for (v, _), size in zip(page.texts, sizes):
        if not never[v] and not linked[v]:
            plain[v] += size
    own = plain[:]
    mains = [v for v in range(n) if tag[v] in CONTAINER and not never[v] and not page.label[v]]
    least = min((deep[v] for v in mains), default=0)
    main, title = [False] * n, [tag[v] == "h1" and not never[v] for v in range(n)]
    for v in mains:
        main[v] = deep[v] == least
    for v in range(n - 1, 0, -1):
        up = page.parent[v]
        plain[up] += plain[v]
        main[up] |= main[v]
        title[up] |= title[v]
    flag = [KEPT if f in (LABELLED, WRAP) and main[v] else f for v, f in enumerate(flag)]
    # at most one way down the tree holds most of the text: from outside in, with the text that stays beside each element
    most = [f in (LABELLED, WRAP) and 2 * plain[v] > plain[0] for v, f in enumerate(flag)]
    apart, at, rest = above([f != KEPT and not most[v] for v, f in enumerate(flag)]), above(most), [0] * n
    for v in range(n):
        rest[at[v]] += 0 if apart[v] else own[v]
    for k, v in enumerate((v for v in range(n) if most[v]), 1):
        rest[k] += rest[k - 1]
        if not title[v] and 10 * rest[k - 1] >= plain[v]:
            break
        flag[v] = KEPT
    noise = above([f != KEPT for f in flag])
    if all(noise[v] for (v, _), size in zip(page.texts, sizes) if size):
        noise = above([f in (WRAP, LEFT_OUT) for f in flag])
    return list(map(bool, noise))


def main_text(html: str) -> str:
    page = Page(html)
    n = len(page.tag)
    block = list(range(n))  # the block element that a node's text belongs to
    chars, tags, link_chars, link_tags, own = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    linked = [False] * n
    for v in range(1, n):
        up = page.parent[v]
        linked[v] = linked[up] or page.tag[v] == "a"
        if page.tag[v] in INLINE:
            block[v] = block[up]
    sizes = [len("".join(text.split())) for _, text in page.texts]
    noise = _noise(page, sizes, linked)
    for (v, _), size in zip(page.texts, sizes):
        if not noise[v]:
            chars[v] += size
            own[block[v]] += size
            if linked[v]:
                link_chars[v] += size
    for v in range(n - 1, 0, -1):
        if not noise[v]:
            up = page.parent[v]
            chars[up] += chars[v]
            link_chars[up] += link_chars[v]
            tags[up] += tags[v] + 1
            link_tags[up] += link_tags[v] + (page.tag[v] == "a")
    if not chars[0]:
        return ""
    share = link_chars[0] / chars[0]
    density = [_density(chars[v], tags[v], link_chars[v], link_tags[v], share) if block[v] == v else 0.0 for v in range(n)]
    total = [_density(own[v], 1, 0, 0, share) if own[v] else 0.0 for v in range(n)]
    for v in range(1, n):
        if block[v] == v and not noise[v]:
            total[block[page.parent[v]]] += density[v]
    core = max((v for v in range(n) if block[v] == v and not noise[v]), key=lambda v: (total[v], v))
    path = [core]
    while page.parent[path[-1]] >= 0:
        path.append(page.parent[path[-1]])
    containers = [v for v in path if page.tag[v] in CONTAINER]
    if containers:
        kept = [(containers[0], page.last[containers[0]])]
    else:
        on_path, body = set(path), next((v for v in path if page.tag[v] == "body"), 0)
        threshold = min(density[v] for v in path if v >= body)
        kept = [(core, page.last[core])] + [
            (v, page.last[v]) for v in range(1, n)
            if page.parent[v] in on_path and page.parent[v] != core and v not in on_path and block[v] == v and chars[v]
            and (page.tag[v] in HEADING or density[v] >= threshold and 2 * link_chars[v] < chars[v])]
    wanted = bytearray(n)
    for first, end in kept:
        wanted[first:end] = b"\1" * (end - first)
    return " ".join("".join(text for v, text in page.texts if wanted[v] and not noise[v]).split())


@F.arrow_udf(T.StringType())
def _main_texts(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(html.as_py() or "") for html in pages], pa.string())


def extracted(html: str = "html") -> Column:
    return _main_texts(F.coalesce(F.col(html).cast("string"), F.lit("")))


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    found = pages.select("page_id", "url", extracted().alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
