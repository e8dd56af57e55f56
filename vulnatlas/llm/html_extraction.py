"""Main text of web pages by tree scoring.

A page becomes a tree, with the ends that HTML leaves out put in: a paragraph ends where the next block begins, a
list item at the next one, and so on. Scripts, styles, menus, headers, footers, sidebars, notices, adverts, forms
and comments are cut off, by their tag, role or the words of their class and id. Each paragraph that is left has
points for its length and its commas, which pass to its parent, by halves to the parent's parent, and so on
upwards; an element's score is discounted by the share of its text that is links. The best container, with the
article around it if there is one, and those of its siblings that score well beside it or read like paragraphs
make the main text. Lists and tables of links within it are menus and go too.

Elements are numbered in page order, so all passes are loops over arrays; deep nesting costs no stack.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnatlas.llm.text import slices

# Tags by what they do to the text around them.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
FRAME = frozenset(("html", "head", "body"))
NO_TEXT = RAW | frozenset(
    "applet aside audio button canvas datalist dialog footer map math menu nav object optgroup option search select svg template video".split()
)
#: What an element that begins closes, and where the search for it stops.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot"), ("table",)), "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)), "option": (("option",), ("select", "datalist")), "a": (("a",), ("td", "th", "table")),
}
P_SCOPE = ("td", "th", "table", "caption", "button", "object", "template")

# Words of a class or id. The first kind is cut wherever it stands, the second unless a word of the third is there.
NEVER = frozenset(
    "ad ads adsense advert advertisement advertising advertorial adverts breadcrumb breadcrumbs comment commentlist comments consent cookie "
    "cookies disqus gdpr nav navbar navigation newsletter paywall popup promo recommended related replies respond share sharing sidebar "
    "skyscraper social sponsor sponsored subscribe subscription".split()
)
SELDOM = frozenset(
    "alert aside banner bar bottom byline contact copyright foot footer form header login masthead menu modal notice notices notification "
    "overlay pager pagination pagenav promotion register reply search signin signup submenu tags toolbar top topbar widget widgets".split()
)
LIKELY = frozenset("article articlebody blog body column content entry main post story text".split())
# A word before that turns the next one round: has-sidebar, no-comments.
LAYOUT = frozenset(("has", "no", "with", "without"))
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar tooltip".split())
INLINE_KEPT = frozenset(("a", "abbr", "b", "cite", "code", "em", "i", "mark", "q", "s", "strong", "sub", "sup", "u"))
BONUS = {"article": 10, "main": 10, "td": 3, "pre": 3, "blockquote": 3, "div": 5, "section": 5,
         "address": -3, "ol": -3, "ul": -3, "dl": -3, "dd": -3, "dt": -3, "li": -3, "form": -3, "th": -5}

TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^=>]++|=\s*+\"[^\"]*\"|=\s*+'[^']*'|=)*+)>|<[a-zA-Z][^>]*\Z", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
COMMAS = re.compile("[,،、，]")
SENTENCE = re.compile(r"[.!?…。]['\"”’»)\]]*$")


class Page:
    """The tree of a page: parallel lists over its elements in page order, and the text events between them."""

    def __init__(self, source: str):
        self.tag, self.parent, self.odd, self.good = ["html"], [-1], [0], [0]
        self.link, self.linked, self.block = [False], [False], [0]  # a link; inside one; the block element it is in
        self.events: list[tuple[int, str | None]] = []  # (element, text), or (element, None) where a block begins or ends
        self.stack = [0]
        self.open: Counter[str] = Counter()  # elements of each tag on the stack
        at = 0
        while at < len(source):
            found = TAG.search(source, at)
            if not found:
                break
            if found.start() > at:
                self._text(source[at:found.start()])
            at = found.end()
            if found[1]:
                self._end(found[1].lower())
            elif found[2]:
                name = found[2].lower()
                self._start(name, found[3])
                if name in RAW:
                    close = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(source, at)
                    at = close.start() if close else len(source)
        if at < len(source):
            self._text(source[at:])
        self._ends()

    def _text(self, text: str) -> None:
        self.events.append((self.stack[-1], html.unescape(text) if "&" in text else text))

    def _pop_to(self, names: tuple[str, ...], stop: tuple[str, ...]) -> None:
        if not any(self.open[name] for name in names):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.tag[self.stack[depth]]
            if tag in names:
                self._close(depth)
                return
            if tag in stop:
                return

    def _close(self, depth: int) -> None:
        for n in reversed(self.stack[depth:]):
            self.open[self.tag[n]] -= 1
            if self.tag[n] in BLOCKS:
                self.events.append((self.parent[n], None))
        del self.stack[depth:]

    def _start(self, name: str, attributes: str) -> None:
        if name in FRAME:
            return
        if name in BLOCKS:
            self._pop_to(("p",), P_SCOPE)
        if name in HEADINGS and self.tag[self.stack[-1]] in HEADINGS:
            self._close(len(self.stack) - 1)
        if name in CLOSES:
            self._pop_to(*CLOSES[name])
        if name in VOID:
            if name == "br":
                self.events.append((self.stack[-1], " "))
            elif name == "hr":
                self.events.append((self.stack[-1], None))
            return
        parent = self.stack[-1]
        if name in BLOCKS:
            self.events.append((parent, None))
        odd, good, link = self._looks(name, attributes) if attributes and not attributes.isspace() else (0, 0, False)
        n = len(self.tag)
        self.stack.append(n)
        self.open[name] += 1
        for values, value in (
            (self.tag, name), (self.parent, parent), (self.odd, odd), (self.good, good), (self.link, link),
            (self.linked, link or self.linked[parent]), (self.block, n if name in BLOCKS else self.block[parent]),
        ):
            values.append(value)

    def _end(self, name: str) -> None:
        if name == "br":
            self.events.append((self.stack[-1], " "))
        if not (self.open[name] or (name in HEADINGS and any(self.open[heading] for heading in HEADINGS))):
            return
        block = name in BLOCKS or name in NO_TEXT
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.tag[self.stack[depth]]
            if tag == name or (name in HEADINGS and tag in HEADINGS):
                self._close(depth)
                return
            if tag in ("td", "th", "table") and name not in ("table", "tr", "tbody", "thead", "tfoot") or not block and tag in BLOCKS:
                return  # such an end tag belongs to nothing that is open here

    @staticmethod
    def _looks(name: str, attributes: str) -> tuple[int, int, bool]:
        """How an element is named: 2 never main text, 1 seldom, 0 nothing against it; 1 likely; whether it is a link."""
        odd = good = 0
        link = False
        for key, *values in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), next(filter(None, values), "")
            if key in ("class", "id"):
                words = [word.lower() for word in NAME.findall(value)]
                words = [word for n, word in enumerate(words) if not (n and words[n - 1] in LAYOUT)]
                good |= any(word in LIKELY for word in words)
                if name not in INLINE_KEPT:
                    odd = max(odd, 2 if any(word in NEVER for word in words) else any(word in SELDOM for word in words))
            elif key == "role":
                odd = max(odd, 2 * (value.lower() in ROLES))
                good |= value.lower() in ("main", "article")
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and HIDDEN.search(value)):
                odd = 3
            elif key == "href":
                link = name == "a"
        return odd, int(good), link

    def _ends(self) -> None:
        """``end[n]``: the number after the last element inside element n."""
        self.end = list(range(1, len(self.tag) + 1))
        for n in range(len(self.tag) - 1, 0, -1):
            self.end[self.parent[n]] = max(self.end[self.parent[n]], self.end[n])

    def cuts(self, by_name: bool) -> list[bool]:
        """Elements whose text is no main text, whatever they score; those inside them too."""
        size = len(self.tag)
        holds, heads = [False] * size, [False] * size  # an article or the main part, or a first heading
        for n in range(size - 1, 0, -1):
            up = self.parent[n]
            holds[up] |= holds[n] or (self.tag[n] in ("article", "main") and self.odd[n] < 2)
            heads[up] |= heads[n] or self.tag[n] == "h1"
        cut, inside, header = [False] * size, [False] * size, [False] * size
        for n in range(1, size):
            tag, up = self.tag[n], self.parent[n]
            inside[n] = inside[up] or tag in ("article", "main")
            header[n] = (header[up] or (tag == "header" and inside[up])) and tag not in HEADINGS
            odd = self.odd[n] if by_name or self.odd[n] == 3 else 0
            around = holds[n] and not inside[up]  # the article itself is in there
            cut[n] = (
                cut[up] or tag in NO_TEXT or (tag == "header" and not inside[up] and not around)
                or (tag == "form" and not around and not heads[n])
                or odd == 3 or (odd and not around and tag not in ("article", "main") and (odd == 2 or not self.good[n]))
                or (odd == 2 and tag == "article")
            )
        # Of a header inside an article, the headings stay.
        self.in_header = header
        return cut

    def blocks(self, kept: list[bool]) -> Iterator[tuple[int, str, int]]:
        """``(element, text, characters in links)`` of each block of text in elements that are kept."""
        held: list[tuple[int, str]] = []
        for n, text in (*self.events, (0, None)):
            if text is not None:
                if kept[n] and not self.in_header[n]:
                    held.append((n, text))
            elif held:
                block = " ".join("".join(text for _, text in held).split())
                if block:
                    linked = sum(len(text) for n, text in held if self.linked[n])
                    yield self.block[held[0][0]], block, min(linked, len(block))
                held = []

    def scores(self, kept: list[bool]) -> tuple[list[float], list[float]]:
        """Each element's score, and the share of its text that is links."""
        size = len(self.tag)
        points, chars, linked, given = [0.0] * size, [0] * size, [0] * size, [False] * size
        for n, text, link in self.blocks(kept):
            chars[n] += len(text)
            linked[n] += link
            if self.tag[n] in HEADINGS:
                continue
            worth = (len(text) >= 25) + len(COMMAS.findall(text)) + len(text) / 100
            worth *= 1 - link / len(text)
            # A paragraph passes its points on; text that stands in a container by itself counts for it.
            to = self.parent[n] if self.tag[n] in ("p", "pre", "li", "dd", "dt", "td", "blockquote", "figcaption") and n > 0 else n
            while to >= 0 and worth > 0.01:
                points[to] += worth
                given[to] = True
                to, worth = self.parent[to], worth / 2
        for n in range(size - 1, 0, -1):
            chars[self.parent[n]] += chars[n]
            linked[self.parent[n]] += linked[n]
        density = [link / many if many else 0.0 for link, many in zip(linked, chars, strict=True)]
        self.chars = chars
        return [
            (points[n] + (BONUS.get(self.tag[n], 0) + 5 * self.good[n] if n else 0)) * (1 - density[n]) if given[n] else 0.0 for n in range(size)
        ], density

    def main_text(self) -> str:
        for by_name in (True, False):
            cut = self.cuts(by_name)
            kept = [not c for c in cut]
            scores, density = self.scores(kept)
            best = max(range(len(scores)), key=lambda n: (scores[n], -n))
            if scores[best] > 0 or any(self.chars):
                break
        else:
            return ""
        roots = self._roots(best, scores, density, kept)
        menus = self._menus(density)
        chosen = [False] * len(self.tag)
        for n in range(len(self.tag)):
            chosen[n] = kept[n] and (n in roots or (n > 0 and chosen[self.parent[n]])) and not (menus[n] and n not in roots)
        return "\n".join(text for _, text, _ in self.blocks(chosen))

    def _roots(self, best: int, scores: list[float], density: list[float], kept: list[bool]) -> set[int]:
        """The best container, or the article around it, and the siblings that go with it."""
        for tags in (("article",), ("main",)):
            n = best
            while n > 0 and self.tag[n] not in tags:
                n = self.parent[n]
            if n > 0:
                best = n
                break
        roots = {best}
        siblings = [n for n in range(1, len(self.tag)) if self.parent[n] == self.parent[best] and kept[n] and n != best] if best else []
        texts: dict[int, str] = {}
        if any(self.tag[n] == "p" for n in siblings):
            for n, text, _ in self.blocks(kept):
                texts[n] = f"{texts[n]} {text}" if n in texts else text
        for n in siblings:
            text = texts.get(n, "") if self.tag[n] == "p" else ""
            if (
                (self.tag[n] in HEADINGS and n < best)
                or (scores[n] > 0 and scores[n] >= max(10, 0.2 * scores[best]))
                or (len(text) > 80 and density[n] < 0.25)
                or (text and density[n] == 0 and SENTENCE.search(text))
            ):
                roots.add(n)
        return roots

    def _menus(self, density: list[float]) -> list[bool]:
        """Lists, tables and groups that are links for the most part, two at least."""
        links = [int(link) for link in self.link]
        for n in range(len(self.tag) - 1, 0, -1):
            links[self.parent[n]] += links[n]
        return [
            self.tag[n] in ("ul", "ol", "dl", "div", "section", "table") and links[n] > 1 and density[n] > 0.66 for n in range(len(self.tag))
        ]


def main_text(source: str) -> str:
    """The main text of one page: a line per block, empty if there is none."""
    return Page(source).main_text()


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (page_id, url, html).

    ``text`` is the page's main text: blocks in page order, a line each, character references decoded, white space
    (line breaks too) inside a block one space; ``n_chars`` counts its code points. A null or empty page, or one
    without any text, gives an empty text. Where everything is cut by its class or id, those are not looked at.
    Repeated rows and rows without an id or url get a row each; other columns are ignored.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = [main_text(source) for source in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return rows.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
