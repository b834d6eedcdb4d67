"""Main text of web pages by line-block distribution.

Markup is stripped first: tags cut the page into blocks of text, one line each, and
elements that never hold the article (scripts, menus, forms, and elements whose
class, id or role names an advert, a notice, comments and the like) go with all they
hold.  Outside an article element, the borders of containers leave empty lines.  Text
lengths, without link texts, are summed over sliding windows of ``WINDOW`` lines: a
sum over a share of the page's highest is a surge, a sum of zero a dive, and
the text between the first surge and the last dive is kept.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import map_arrow

WINDOW = 3
SHARE = 0.25              # of the highest window sum, from which on a window is a surge

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe noembed noframes xmp".split())
DROPPED = set("nav aside form footer button select svg canvas object audio video menu dialog template map".split())
MAIN = {"article", "main"}
CONTAINER = set("div section article main header footer nav aside ul ol dl table form body html blockquote figure details "
                "fieldset center menu dialog hgroup address".split())
BLOCK = CONTAINER | set("p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption pre figcaption summary hr option".split())
HEADING = {"h1", "h2"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "a": {"a"}, "option": {"option"}}
ROLES = set("navigation banner complementary contentinfo search form alert dialog alertdialog menu menubar toolbar".split())
NAMES = set("ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsors sponsored promo promos promotion "
            "sidebar nav navbar navigation navi menu menus breadcrumb breadcrumbs footer masthead banner banners comment comments "
            "commentlist disqus respond reply replies cookie cookies consent gdpr notice notices notification alert popup modal overlay "
            "newsletter subscribe subscription signup login share sharing social related recommended recommendations widget widgets "
            "toolbar pagination pager paginator skip copyright".split())
OUTSIDE = {"header", "topbar"}                        # these go only outside an article
NEGATIONS = set("has with no not without is".split())
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTES = re.compile(r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+""")
_MARK = re.compile(r"""\b(class|id|role|style|aria-hidden|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_RAW_END = {n: re.compile(f"</{n}(?=[\\s/>])", re.I) for n in RAW}


def boilerplate(name: str, attributes: str, in_main: bool) -> bool:
    """Whether an element and all it holds is left out, by its name and attributes."""
    if name in MAIN or name in ("html", "body"):
        return False
    if name in DROPPED or name == "header" and not in_main:
        return True
    if "=" not in attributes and "hidden" not in attributes:
        return False
    for key, value in _MARK.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "role" and value.lower() in ROLES:
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if key in ("class", "id"):
            for own in value.split():
                words = [w.lower() for w in _WORD.findall(own)]
                said = next((i for i, w in enumerate(words) if w in NEGATIONS), len(words))      # "with-sidebar" isn't one
                words = [*words[:said], *(["".join(words)] if said == len(words) else [])]
                if any(w in NAMES or w in OUTSIDE and not in_main for w in words):
                    return True
    return False


class _Page:
    """Blocks of a page: (text, length without links, heading, in an article, empty lines before)."""

    def __init__(self):
        self.blocks, self.pieces = [], []
        self.stack, self.open = [], {}
        self.dropped = None           # place in the stack of the element that is left out
        self.gap, self.heading = 0, False

    def text(self, raw: str) -> None:
        if self.dropped is None and raw:
            self.pieces.append((raw, "a" in self.open))

    def cut(self) -> None:
        """End the block."""
        if self.pieces:
            whole = " ".join(unescape("".join([p for p, _ in self.pieces])).split())
            if whole:
                linked = any(link for _, link in self.pieces)
                plain = len(" ".join(unescape("".join([p for p, link in self.pieces if not link])).split())) if linked else len(whole)
                self.blocks.append((whole, plain, self.heading, self.in_main(), self.gap))
                self.gap = 0
            self.pieces = []

    def in_main(self) -> bool:
        return "article" in self.open or "main" in self.open

    def border(self, name: str) -> None:
        self.cut()
        if name in CONTAINER and not self.in_main():
            self.gap = WINDOW

    def pop(self, at: int) -> None:
        """Close the elements from place ``at`` of the stack on."""
        for name in self.stack[at:]:
            self.open[name] -= 1
            if not self.open[name]:
                del self.open[name]
        del self.stack[at:]
        if self.dropped is not None and self.dropped >= at:
            self.dropped = None

    def close(self, names, stop) -> None:
        """Close the nearest of ``names``, unless an element of ``stop`` lies above it."""
        if not any(n in self.open for n in names):
            return
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at] in names:
                self.pop(at)
                return
            if self.stack[at] in stop:
                return

    def start(self, name: str, attributes: str) -> None:
        if name in VOID:
            if name == "br":
                self.text(" ")
            elif name == "hr":
                self.cut()
            return
        if name in BLOCK:
            self.border(name)
            self.close({"p"}, CONTAINER)
        if name in SIBLINGS:
            self.close(SIBLINGS[name], CONTAINER)
        leaves = self.dropped is None and boilerplate(name, attributes, self.in_main())
        if leaves:
            self.cut()
            self.gap = max(self.gap, 0 if self.in_main() else WINDOW)
            self.dropped = len(self.stack)
        elif self.dropped is not None and (name == "main" or name == "article" and self.stack[self.dropped] == "form"):
            self.dropped = None       # a form, or an element of a misleading name, around the whole page
        self.stack.append(name)
        self.open[name] = self.open.get(name, 0) + 1
        if name in HEADING and self.dropped is None:
            self.heading = True

    def end(self, name: str) -> None:
        if name in BLOCK:
            self.border(name)
            self.heading = False
        self.close({name}, MAIN if name in BLOCK and name not in MAIN else () if name in BLOCK else BLOCK)
        if name in BLOCK:
            self.border(name)


def page_blocks(html: str) -> list[tuple[str, int, bool, bool, int]]:
    """Blocks of the page without the elements that are left out.  Unclosed and
    wrongly nested tags, comments and quotes are taken as browsers take them."""
    page, at, n = _Page(), 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            page.text(html[at:])
            break
        page.text(html[at:lt])
        at = lt
        nxt = html[lt + 1:lt + 2]
        if nxt == "!" or nxt == "?":
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4) if not html.startswith(("<!-->", "<!--->"), lt) else html.find(">", lt) - 2
                at = n if end < 0 else end + 3
            elif html.startswith("<![CDATA[", lt):
                end = html.find("]]>", lt)
                at = n if end < 0 else end + 3
            else:
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            continue
        name = _NAME.match(html, lt + 2 if nxt == "/" else lt + 1)
        if not name:
            if nxt == "/":            # a malformed end tag goes
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                page.text("<")
                at = lt + 1
            continue
        tail = _ATTRIBUTES.match(html, name.end()).end()
        if html[tail:tail + 1] != ">":
            tail = html.find(">", name.end())
            if tail < 0:              # the page ends within a tag
                break
        at, own = tail + 1, name.group().lower()
        if nxt == "/":
            page.end(own)
        elif own in RAW:
            end = _RAW_END[own].search(html, at)
            if not end:
                break
            at = html.find(">", end.end()) + 1 or n
        else:
            page.start(own, html[name.end():tail])
    page.cut()
    return page.blocks


def main_blocks(blocks: list[tuple[str, int, bool, bool, int]]) -> list[str]:
    """The texts between the first surge and the last dive of the line-block distribution."""
    if any(b[3] and b[1] for b in blocks):
        blocks = [b for b in blocks if b[3]]
    lines, owner = [], []
    for i, (_, plain, _, _, gap) in enumerate(blocks):
        lines += [0] * gap + [plain]
        owner += [-1] * gap + [i]
    sums = [sum(lines[i:i + WINDOW]) for i in range(len(lines))]
    least = SHARE * max(sums, default=0)
    surges = [i for i, s in enumerate(sums) if s >= least and s > 0]
    if not surges:
        return []
    first, last = surges[0], surges[-1]
    while first > 0 and sums[first - 1] > 0:      # back to the rise from zero,
        first -= 1
    while last < len(sums) and sums[last] > 0:    # and on to the dive
        last += 1
    use = [i for i in owner[first:last] if i >= 0]
    start = use[0]
    while start > 0 and blocks[start - 1][2]:     # headings right before the surge
        start -= 1
    return [b[0] for b in blocks[start:use[-1] + 1]]


def main_text(html: str) -> str:
    return " ".join(main_blocks(page_blocks(html)))


def extract_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars, n_blocks, n_kept): one row per input row.

    ``text`` is the page's main text, blocks joined by one space; ``n_blocks`` are the
    blocks that stripping the markup leaves and ``n_kept`` those between surge and dive.
    Null and empty pages, and pages of markup only, have the empty text.  Null ids and
    urls and repeated rows are kept; an empty table gives an empty result.  A page is
    read whole, in time linear in its length."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                pages = [page_blocks(h or "") for h in part.column(2).to_pylist()]
                kept = [main_blocks(p) for p in pages]
                texts = [" ".join(k) for k in kept]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()),
                     pa.array(map(len, pages), pa.int32()), pa.array(map(len, kept), pa.int32())],
                    names=["id", "url", "text", "n_chars", "n_blocks", "n_kept"])

    src = df.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    kind = src.schema["id"].dataType.simpleString()
    return map_arrow(src, run, f"id {kind}, url string, text string, n_chars long, n_blocks int, n_kept int")
