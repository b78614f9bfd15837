"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import map_batches, values

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_NAMED = re.compile(r"(?i)(?:^|[\s\"'])(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody"
    " td tfoot th thead tr ul".split()
)
#: What a start tag ends, up to the nearest of the tags after it.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "button": ({"button"}, {"object", "table", "td", "template", "th"}),
    **dict.fromkeys(("tbody", "thead", "tfoot"), ({"tbody", "thead", "tfoot"}, {"table"})),
}
_IN_PARAGRAPH = _BLOCK - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
#: Start tags that don't end an open head.
_IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: Elements that an end tag inside doesn't reach beyond, and the tags that only a table inside keeps back.
_SCOPE = frozenset("button caption object table td template th".split())
_TABLE_PARTS = frozenset("caption table tbody td tfoot th thead tr".split())
#: Elements, and words of class, id and role, that aren't the article.
_ASIDE = frozenset("head nav footer aside form script style noscript template iframe object svg button select textarea menu dialog".split())
_ASIDE_NAMES = frozenset(
    "ad ads advert advertisement advertising adverts adsense alert banner breadcrumb breadcrumbs comment comments complementary consent"
    " contentinfo cookie cookies dialog discussion disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter"
    " notice notices notification pager pagination popup promo promotion related replies reply respond search share sharing"
    " sidebar signup skip social sponsor sponsored subscribe toc toolbar widget".split()
)
_COMMENTS = frozenset("comment comments discussion disqus replies reply respond".split())
#: Words of a name that say where or what kind of box something is, not what it holds.
_BOXES = frozenset(
    "area bar block body bottom box button buttons center col column container content count desktop fixed form group icon icons inner item items label left"
    " link links list main message mobile module outer overlay page panel placeholder posts primary region right row secondary section site slot"
    " sticky text title top unit widgets wrap wrapper".split()
)
_ARTICLE = frozenset(("article", "main"))
#: Words by which a name tells what an element has beside it, or whose header it is.
_BESIDE = frozenset("has with without no".split())
_OWN = frozenset("article content entry post story".split())
_HIDDEN = re.compile(r"(?i)(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true)")
_QUOTED = re.compile(r"(?<=[^\s=])(\"[^\"]*\"|'[^']*')|=\s*(?:\"(?!true\")[^\"]*\"|'(?!true')[^']*')")

#: What an element is: the article's, beside it by its name or as a form, or beside it whatever it holds.
_KEPT, _SOFT, _HARD = range(3)


def _aside(tag: str, attributes: str, inside: bool) -> int:
    """Whether an element is something beside the article; inside: in an article already."""
    if tag == "form":
        return _SOFT
    if tag in _ASIDE or tag == "header" and not inside or "idden" in attributes and _HIDDEN.search(_QUOTED.sub(" ", attributes)):
        return _HARD
    if tag in ("html", "body", "article", "main", "h1") and not inside or not attributes:
        return _KEPT
    return max((_aside_name(name, inside) for m in _NAMED.finditer(attributes) for name in m[1].strip("\"'").split()), default=_KEPT)


def _aside_name(name: str, inside: bool) -> int:
    """Whether a class, id or role names something beside the article.

    The last word that says more than a box's kind or place is what counts: `share-buttons` and
    `cookie-notice` name something beside, `share-price` and `ad-free` don't.
    """
    words = re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower().replace("_", " ").replace("-", " ").split()
    if words == ["table", "of", "contents"]:
        return _SOFT
    if _BESIDE.intersection(words):
        return _KEPT
    telling = [w for w in words if w not in _BOXES and not w.isdigit()]
    found = _ASIDE_NAMES.intersection(words)
    if not found or telling and telling[-1] not in _ASIDE_NAMES or found == {"header"} and (inside or _OWN.intersection(words)):
        return _KEPT
    if found == {"discussion"} and inside:
        return _KEPT
    return _HARD if found & _COMMENTS else _SOFT


#: An element that is beside the article by its name, or a form, wraps the article if it holds over
#: half of the page's text, and what is kept without it is less than this share of its own.
OUTSIDE = 0.1


class Page:
    """Nodes in page order, without what isn't the article, and the text pieces that they hold.

    wrappers: numbers of start tags that are kept whatever their names say.
    """

    def __init__(self, source: str, wrappers: frozenset[int] = frozenset()) -> None:
        self.tags, self.parents = ["#page"], [0]
        self.pieces: list[tuple[int, str | None]] = []
        # Open elements: the node that each one's text belongs to, its tag, and the places of each tag.
        self._stack, self._names = [0], ["#page"]
        self._at: defaultdict[str, list[int]] = defaultdict(list)
        # Place of the outermost open element that isn't the article; what it holds makes no nodes. 0: none.
        self._skipped = 0
        # Start tags so far; characters left out so far; open elements beside the article by name or
        # as forms (place, number, characters before); and when they ended, characters in them.
        self._wrappers, self._started, self._left_out = wrappers, 0, 0
        self._soft: list[tuple[int, int, int]] = []
        self._held: dict[int, int] = {}
        self._read(source)
        self._cut(1)

    def wrappers(self) -> frozenset[int]:
        """Elements left out that hold nearly all there is to read: they wrap the article."""
        if not self._held:
            return frozenset()
        kept = sum(len(t) - t.count(" ") for _, t in self.pieces if t and not t.isspace())
        return frozenset(n for n, held in self._held.items() if 2 * held > kept + self._left_out and kept < OUTSIDE * held)

    def _last(self, tags: Iterable[str]) -> int:
        """Place of the innermost open element of these tags; 0 without any."""
        return max((self._at[t][-1] for t in tags if self._at[t]), default=0)

    def _push(self, node: int, tag: str) -> None:
        self._at[tag].append(len(self._stack))
        self._stack.append(node)
        self._names.append(tag)

    def _cut(self, i: int) -> None:
        """End the element at place i and all in it."""
        if any(n in _BLOCK for n in self._names[i : self._skipped or None]):
            self.pieces.append((self._stack[i], None))
        for n in self._names[i:]:
            self._at[n].pop()
        while self._soft and self._soft[-1][0] >= i:
            _, number, before = self._soft.pop()
            self._held[number] = self._left_out - before
        del self._stack[i:], self._names[i:]
        if i <= self._skipped:
            self._skipped = 0

    def _end_implied(self, tag: str) -> None:
        """End what a start tag ends."""
        if self._names[self._skipped] == "head" and tag not in _IN_HEAD:
            self._cut(self._skipped)
        if tag in _BLOCK and self._at["svg"] and not self._at["foreignobject"]:
            self._cut(self._at["svg"][-1])
        if tag in _IN_PARAGRAPH and self._at["p"]:
            i, barrier = self._at["p"][-1], self._last(_SCOPE) if self._skipped else 0
            if barrier < max(i, self._skipped):
                self._cut(i)
        if tag in _ENDS:
            ended, limits = _ENDS[tag]
            i = self._last(ended)
            if i > self._last(limits):
                self._cut(i)

    def _open(self, tag: str, attributes: str) -> None:
        self._end_implied(tag)
        self._started += 1
        aside = _KEPT if self._started in self._wrappers else _aside(tag, attributes, self._last(_ARTICLE) > 0)
        if aside == _SOFT and tag not in _VOID and not attributes.endswith("/"):
            self._soft.append((len(self._stack), self._started, self._left_out))
        if self._skipped:
            if tag not in _VOID and not (self._at["svg"] and attributes.endswith("/")):
                self._push(self._stack[-1], tag)
            return
        if tag in _BLOCK:
            self.pieces.append((self._stack[-1], None))
        if aside:
            if tag not in _VOID and not attributes.endswith("/"):
                self._skipped = len(self._stack)
                self._push(self._stack[-1], tag)
            return
        self.parents.append(self._stack[-1])
        self.tags.append(tag)
        if tag not in _VOID:
            self._push(len(self.tags) - 1, tag)

    def _close(self, tag: str) -> None:
        i = self._last((tag,))
        if tag in ("body", "html"):
            if i or self._skipped and self._names[self._skipped] != "head":
                self._cut(i or self._skipped)
            return
        if not i or tag not in _BLOCK and self._last(("article", "body", "main", "td")) > i:
            return
        if i <= self._skipped:
            # From within a skipped element, the rules by which an end tag is ignored count.
            barrier = self._last(("table", "template") if tag in _TABLE_PARTS else _SCOPE if tag in _BLOCK else _BLOCK | _SCOPE)
            if barrier > i and barrier >= self._skipped:
                return
        self._cut(i)

    def _text(self, text: str) -> None:
        if text:
            self.pieces.append((self._stack[-1], text))

    def _read(self, source: str) -> None:
        at = 0
        # Nothing after the last `>` is a tag, so no search need look for its end there.
        tagged = source.rfind(">") + 1
        while True:
            m = _TOKEN.search(source, at, tagged)
            text = source[at : m.start()] if m else source[at:].partition("<!--")[0]
            if not self._skipped:
                self._text(text)
            elif self._names[-1] not in _RAW and not text.isspace():
                self._left_out += len(text) - text.count(" ")
            if not m:
                return
            at = m.end()
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                return
            closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not tag:
                if not self._skipped and m[0].startswith("<![CDATA["):
                    self._text(html.escape(m[0][9:].removesuffix("]]>"), quote=False))
                continue
            tag = tag.lower()
            if not closing and tag in _RAW:
                end = re.compile(f"</{tag}", re.I).search(source, at)
                at = end.start() if end else len(source)
            if closing:
                self._close(tag)
            else:
                self._open(tag, attributes)

    def main_nodes(self) -> set[int]:
        """The nodes whose subtrees are the article: the one with the densest sum, and those
        beside the way to it that are as dense as that way (they, or their children together), or
        hold the page's heading.

        Inline elements pass their characters, tags and links on to the block they stand in;
        only blocks have densities to add up. A block without blocks in it adds up to its own.
        """
        count = len(self.tags)
        chars, links, tags, link_tags = ([0] * count for _ in range(4))
        linked, headed = [False] * count, [t == "h1" for t in self.tags]
        for n in range(1, count):
            linked[n] = self.tags[n] == "a" or linked[self.parents[n]]
        for n, text in self.pieces:
            if text:
                size = len(text) - text.count(" ")
                chars[n] += size
                links[n] += size * linked[n]
        for n in range(count - 1, 0, -1):
            p = self.parents[n]
            chars[p] += chars[n]
            links[p] += links[n]
            tags[p] += tags[n] + 1
            link_tags[p] += link_tags[n] + (self.tags[n] == "a")
            headed[p] |= headed[n]
        density = [_density(chars[n], tags[n], links[n], link_tags[n], chars[0], links[0]) for n in range(count)]
        block = [n == 0 or t in _BLOCK for n, t in enumerate(self.tags)]
        sums, leaf = [0.0] * count, [True] * count
        around = [0] * count
        for n in range(1, count):
            p = self.parents[n]
            p = around[n] = p if block[p] else around[p]
            if block[n] and self.tags[n] != "br":
                sums[p] += density[n]
                leaf[p] = False
        sums = [density[n] if leaf[n] else sums[n] for n in range(count)]
        best = max((n for n in range(count) if block[n]), key=lambda n: (sums[n], -n))
        path = [best]
        while path[-1] and self.tags[path[-1]] != "body":
            path.append(self.parents[path[-1]])
        # The least density on the way from the body to the densest sum is what others must reach.
        threshold = min(density[n] for n in path)
        above, way = set(path[1:]), set(path)
        beside = (n for n in range(1, count) if self.parents[n] in above and n not in way and chars[n])
        return {best, *(n for n in beside if headed[n] or max(density[n], sums[n]) >= threshold)}

    def text(self) -> str:
        """Blocks of the article, white space in each made one space, joined by newlines."""
        inside = self.main_nodes()
        for n in range(1, len(self.tags)):
            if self.parents[n] in inside:
                inside.add(n)
        blocks, parts = [], []
        for n, text in [*self.pieces, (0, None)]:
            if text is None:
                if parts:
                    blocks.append(" ".join("".join(parts).split()))
                    parts = []
            elif n in inside:
                parts.append(html.unescape(text))
        return "\n".join(b for b in blocks if b)


def _density(chars: int, tags: int, links: int, link_tags: int, all_chars: int, all_links: int) -> float:
    """Characters for each tag, lowered by the share of characters in links."""
    if not chars:
        return 0.0
    tags, plain, linked, link_tags = max(tags, 1), max(chars - links, 1), max(links, 1), max(link_tags, 1)
    base = math.log(chars / plain * links + all_links / max(all_chars, 1) * chars + math.e)
    return chars / tags * math.log(max(chars / linked * tags / link_tags, 1.0) + 1) / max(math.log(base + 1), 0.1)


def main_text(source: str | None) -> str:
    """The article's text; a page whose article lies in a form or an element named like something
    beside it is read again with these kept."""
    if not source:
        return ""
    page = Page(source)
    if wrappers := page.wrappers():
        page = Page(source, wrappers)
    return page.text()


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.

    Null and empty html and pages without an article have an empty text. Pages are read whole;
    broken markup is read as far as it goes. Null ids and urls and repeated rows each give a
    row; an empty table gives an empty result; other columns are ignored.
    """
    frame = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))

    def per_batch(batch):
        texts = [main_text(x) for x in values(batch, "html")]
        return {"page_id": values(batch, "page_id"), "url": values(batch, "url"), "text": texts, "n_chars": list(map(len, texts))}

    kind = frame.schema["page_id"].dataType.simpleString()
    return map_batches(frame, per_batch, f"page_id {kind}, url string, text string, n_chars bigint")
