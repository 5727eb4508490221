"""Main text of a web page by two passes over its text blocks.

A page is cut into blocks at block-level tags. The first pass decides a block by where it stands
(menus, headers, footers, adverts, forms and such do not hold the article), by link density, and by
length and stop-word density. A word in a class counts for what it names, not on the page's body, article
or main element, nor if it tells a state (``has-sidebar``); and an element that holds more than half of
the page's prose is the page, though it be a form or have such a word. Readers' comments never are. A long block without known stop words is text if it has no links to speak
of and ends sentences, as in other languages; characters of scripts without spaces count as half a word.
What stays open, short blocks above all, takes the label of the nearest decided block of its region in
the second pass: each article or main element is one region, all else another.

An element is a feature and no verdict: what the first pass finds to be text is kept wherever it stands.
The region with the most such text is the article. Where a region has no decided block, its open blocks
are text if it is the article and an element, or if it is an element and no region has text; others not.

Defined results: NULL or empty html, and html without text blocks, give the empty text. Character
references are decoded once, white space (also no-break) inside a block becomes one space. Unclosed
and stray tags are tolerated: an end tag closes the nearest open element of its name, or nothing; a head
ends at the first tag that cannot be in it; a button, option, title or embedded element without an end
leaves out nothing but itself. Text of any length is used whole, in time that grows with it. If the neighbours of either side are equally near and differ, the block
is text. Rows are independent of each other and of other columns; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from foldcat.llm.text import struct_udf

# Elements by their role in HTML.
_CODE = {"script", "style"}  # what they hold is no markup
_PLAIN = {"title", "textarea", "iframe", "noscript", "button", "select", "datalist", "option"}  # never inside themselves
_EMBEDDED = {"template", "svg", "math", "object", "canvas", "audio", "video"}
_IN_HEAD = {"title", "meta", "link", "base", "noscript", "template", *_CODE}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main",
    "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
_OUTSIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
_REGION = {"article", "main"}
_P_ENDS = _BLOCK - {"html", "body"}  # a start tag of these ends an open paragraph
_LISTS = ("ul", "ol", "menu")
_CELLS = ("td", "th", "table")
_WITHIN_CELL = {"p", "li", "b", "i", "a", "span"}  # their end tags close nothing outside a cell
# Words in class, id and role that mark what is not the article. What readers write and what
# is sold never is; the other words may also name a whole page that has such a thing.
_NEVER = re.compile(r"(?:user|reader|post|page)?comments?(?:list|area|form|section|thread|box|body|wrap|wrapper|container)?|respond|replies|reply|disqus")
_STRONG = re.compile(
    r"ads?|adv|advert(?:s|isement|isements|ising)?|ad(?:box|sense|slot|unit|banner)|banner|sponsor(?:ed)?|promo(?:tion)?|breadcrumbs?|footer|masthead|cookies?|consent|gdpr|"
    r"(?:top|main|side|sub|left|right|foot|footer|bottom|site|page|primary)?(?:nav|menu)(?:bar|list|igation|box)?|contentinfo"
)
_WEAK = re.compile(
    r"sidebar|siteheader|notice|popup|modal|overlay|newsletter|subscribe|signup|login|search|share|sharing|social|"
    r"related|recommended|widget|pagination|pager|toolbar|skip|complementary|alert"
)
# Words about the state or kind of a whole page, whatever they are joined to.
_STATE = re.compile(r"(?:has|no|with|without|is|not|single|page|template|layout)[-_]|.*[-_](?:open|opened|closed|enabled|disabled|page|layout|template)$")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORDS = re.compile(r"[\s_-]+")
# Frequent function words of four languages.
STOP_WORDS = frozenset(
    "the of and a to in is that it for was on are as with by at from be this an or he she not have has had but which they you we "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach "
    "le la les de des et un une du en que qui dans est pour pas par sur il elle au ne se plus avec ce sont "
    "el los las y del que se por con para una su al lo como más pero sus o no".split()
)
_SHORT_WORDS = 12
_LONG_WORDS = 25
_STOP_DENSITY = 0.12
_LINK_DENSITY = 0.5
# Ends of sentences in most scripts, and characters of scripts that put no spaces between words.
_SENTENCE = re.compile(r"[.!?\u2026](?=[\s\"'\u00bb\u201d\u2019)]|\Z)|[\u3002\uff01\uff1f\u0964\u06d4\u061f\u17d4\u1362]")
_UNSPACED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\U00020000-\U0003ffff]")

# Quantifiers take what they can and give nothing back, and nothing outside quotes runs over a "<", so that
# a page of any make is read in time that grows with its length. A quote counts after "=" only.
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*+)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^<>]*+>?"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/<>]*+)(?P<attributes>(?:[^<>\"'=]|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>][^\s>]*+)))?+")
_INVISIBLE = re.compile(r"display\s*:\s*none", re.I)
_BLOCK_TAG = re.compile(rf"</?(?:{'|'.join(sorted(_BLOCK))})\b", re.I)
# How far an element's word reaches: over all it holds, unless it holds the article, or most of the prose.
_ALWAYS, _BUT_ARTICLE, _BUT_PROSE = 0, 1, 2


@dataclass
class Block:
    away: int
    region: int
    parts: list[tuple[str, bool]] = field(default_factory=list)

    def text(self) -> str:
        return " ".join(html.unescape("".join([p for p, _ in self.parts])).split())


def _reach(name: str, attributes: str) -> int | None:
    """Whether an element is not of the article by its class, id, role or style, and how far that goes."""
    values = {m[1].lower(): next((v for v in m.groups()[1:] if v is not None), "") for m in _ATTRIBUTE.finditer(attributes)}
    if name in ("html", "body"):
        return None
    if "hidden" in values or values.get("aria-hidden", "").lower() == "true" or _INVISIBLE.search(values.get("style", "")):
        return _ALWAYS
    named = _CAMEL.sub("-", html.unescape(" ".join(values.get(k, "") for k in ("class", "id", "role")))).lower().split()
    if name in _REGION:
        # Only what an article is as a whole counts, as that of a reader's comment.
        return _ALWAYS if any(_NEVER.fullmatch(t.partition("-")[0]) and not _STATE.match(t) for t in named) else None
    words = [w for t in named if not _STATE.match(t) for w in (*_WORDS.split(t), _WORDS.sub("", t))]
    for pattern, reach in ((_NEVER, _ALWAYS), (_STRONG, _BUT_ARTICLE), (_WEAK, _BUT_PROSE)):
        if any(map(pattern.fullmatch, words)):
            return reach
    return None


class _Page:
    """One reading of a page: its blocks, and its elements that are not of the article.

    ``reaches``, ``parents`` and whether they stand ``inside`` an article or main element describe these
    elements by number; number 0 is the page itself.
    """

    def __init__(self, page: str):
        self.page, self.at = page, 0
        self.found: list[Block] = []
        self.reaches, self.parents, self.inside, self.regions = [-1], [0], [False], 0
        self.current: Block | None = None
        self.stack: list[tuple[str, int, int]] = []  # name, away, region
        # Where elements of a name, and blocks, are open: no search of the stack.
        self.open: dict[str, list[int]] = {}
        self.open_blocks: list[int] = []
        self.away = self.region = 0
        self.none_after: dict[str, int] = {}
        self.read()

    def add(self, text: str) -> None:
        if text:
            if self.current is None:
                self.current = Block(self.away, self.region)
                self.found.append(self.current)
            self.current.parts.append((text, bool(self.open.get("a"))))

    def depth(self, *names: str) -> int:
        return max((self.open[n][-1] for n in names if self.open.get(n)), default=-1)

    def push(self, name: str) -> None:
        if name in _BLOCK:
            self.open_blocks.append(len(self.stack))
        self.open.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, self.away, self.region))

    def close(self, depth: int) -> None:
        """Close the element at a depth and all in it."""
        while len(self.stack) > depth:
            name, _, _ = self.stack.pop()
            self.open[name].pop()
            if name in _BLOCK:
                self.open_blocks.pop()
        _, self.away, self.region = self.stack[-1] if self.stack else ("", 0, 0)

    def next_tag(self, pattern: str) -> re.Match | None:
        """The next match, not looked for again where there was none."""
        if self.at >= self.none_after.get(pattern, len(self.page) + 1):
            return None
        match = re.compile(pattern, re.I).search(self.page, self.at)
        if match is None:
            self.none_after[pattern] = min(self.at, self.none_after.get(pattern, self.at))
        return match

    def skip(self, name: str) -> None:
        """Go behind an element whose content is left out; one that is not closed ends at the next tag."""
        if name in _CODE:
            end = self.next_tag(rf"</{name}\b[^<>]*>?")
            following = None if end else _BLOCK_TAG.search(self.page, self.at)
            self.at = end.end() if end else following.start() if following else len(self.page)
            return
        # The content of a title is no markup, but a block tag before its end shows that it has none.
        end = self.next_tag(rf"<(/?){name}\b[^<>]*>?" + (rf"|{_BLOCK_TAG.pattern}|</head\b" if name == "title" else ""))
        if end is not None and end[1]:
            self.at = end.end()

    def read(self) -> None:
        page = self.page
        while (token := _TOKEN.search(page, self.at)) is not None:
            self.add(page[self.at : token.start()])
            self.at = token.end()
            if token["cdata"] is not None:
                self.add(html.escape(token["cdata"], quote=False))
            if token["name"] is None:
                continue
            name = token["name"].lower()
            if name in _BLOCK:
                self.current = None
            elif name == "br":
                self.add(" ")
            if token["end"]:
                depth = self.depth(name)
                if depth >= 0 and not (name in _WITHIN_CELL and depth < self.depth(*_CELLS)):
                    self.close(depth)
                continue
            if self.open.get("head") and name not in _IN_HEAD:
                self.close(self.depth("head"))
            attributes = token["attributes"]
            if name in _VOID or attributes.rstrip().endswith("/") and name not in _BLOCK:
                continue
            if name in _CODE or name in _PLAIN:
                self.skip(name)
            elif name not in _EMBEDDED or self.next_tag(rf"</{name}\b") is not None:
                self.start(name, attributes)
        self.add(page[self.at :])

    def start(self, name: str, attributes: str) -> None:
        if name in _P_ENDS and self.open_blocks and self.stack[self.open_blocks[-1]][0] == "p":
            self.close(self.open_blocks[-1])
        if name == "li" and self.depth("li") > self.depth(*_LISTS):
            self.close(self.depth("li"))
        if name in _REGION and not self.region:
            self.regions += 1
            region = self.regions
        else:
            region = self.region
        reach = _reach(name, attributes) if attributes else None
        if name == "head" or name in _EMBEDDED:
            reach = _ALWAYS
        elif reach is None and name in _OUTSIDE and not (name == "header" and self.region):
            # A header inside the article is its own heading, not the page's; a form may hold all of a page.
            reach = _BUT_PROSE if name == "form" else _BUT_ARTICLE
        if reach is not None:
            self.reaches.append(reach)
            self.parents.append(self.away)
            self.inside.append(self.region > 0)
            self.away = len(self.reaches) - 1
        self.region = region
        self.push(name)


def blocks(page: str) -> list[tuple[str, float, bool, int]]:
    """Text, link density, whether it stands outside the article, and region, in page order."""
    read, shaped = _Page(page), []
    for block in read.found:
        text = block.text()
        if text:
            linked = sum([len("".join(p.split())) for p, link in block.parts if link])
            size = sum([len("".join(p.split())) for p, _ in block.parts])
            shaped.append((text, linked / max(1, size), block))
    # How much prose each element holds, and how much of it in an article or main element.
    prose, in_region = [0] * len(read.reaches), [0] * len(read.reaches)
    for text, density, block in shaped:
        if len(read.reaches) > 1 and decide(text, density, False):
            prose[block.away] += len(text)
            in_region[block.away] += len(text) * (block.region > 0)
    for k in range(len(prose) - 1, 0, -1):
        prose[read.parents[k]] += prose[k]
        in_region[read.parents[k]] += in_region[k]
    away = [False] * len(prose)
    for k in range(1, len(prose)):
        held = (0, 0 if read.inside[k] else in_region[k], prose[k])[read.reaches[k]]
        away[k] = away[read.parents[k]] or 2 * held <= prose[0]
    return [(text, density, away[block.away], block.region) for text, density, block in shaped]


def decide(text: str, link_density: float, outside: bool) -> bool | None:
    """First pass: True for text, False for what is not, None for open."""
    if outside:
        return False
    words = text.lower().split()
    size = len(words) + len(_UNSPACED.findall(text)) // 2
    stops = sum([w.strip(".,;:!?\"'()") in STOP_WORDS for w in words]) / max(1, len(words))
    if link_density > _LINK_DENSITY:  # a long paragraph full of links may still be one
        return None if link_density < 1 and size >= _LONG_WORDS and stops >= _STOP_DENSITY else False
    if size < _SHORT_WORDS:
        return None
    few_links = link_density <= _LINK_DENSITY / 2
    if stops >= _STOP_DENSITY and few_links:
        return True
    if size >= _LONG_WORDS and stops < _STOP_DENSITY / 3:
        if not few_links:
            return False
        if _SENTENCE.search(text):
            return True
    return None


def settle(labels: list[bool | None], regions: list[int], articles: set[int] | None = None) -> list[bool]:
    """Second pass: open blocks take the label of the nearest decided block of their region.

    Without one they are text in ``articles``, by default all elements.
    """
    n = len(labels)
    before: list[tuple[int, bool] | None] = [None] * n
    after: list[tuple[int, bool] | None] = [None] * n
    for order, side in ((range(n), before), (range(n - 1, -1, -1), after)):
        last: dict[int, tuple[int, bool]] = {}
        for i in order:
            if labels[i] is not None:
                last[regions[i]] = (i, labels[i])
            side[i] = last.get(regions[i])
    result = []
    for i, label in enumerate(labels):
        if label is None:
            near = [(abs(found[0] - i), not found[1]) for found in (before[i], after[i]) if found]
            label = not min(near)[1] if near else regions[i] > 0 and (articles is None or regions[i] in articles)
        result.append(label)
    return result


def main_text(page: str | None) -> str:
    """The article of a page, its blocks joined by an empty line."""
    if not page:
        return ""
    found = blocks(page)
    labels = [decide(*b[:3]) for b in found]
    # What is known to lie outside says nothing about the article around it.
    regions = [-1 if outside else region for _, _, outside, region in found]
    amounts: dict[int, int] = {}
    for (text, *_), label, region in zip(found, labels, regions):
        if label:
            amounts[region] = amounts.get(region, 0) + len(text)
    # The first of equals is the article, an element before all else.
    articles = {max(amounts, key=lambda r: (amounts[r], r > 0, -r))} if amounts else None
    return "\n\n".join([b[0] for b, keep in zip(found, settle(labels, regions, articles)) if keep])


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""

    def per_row(page: str | None) -> tuple[str, int]:
        text = main_text(page)
        return text, len(text)

    extract = struct_udf(per_row, ["text", "n_chars"], ["string", "long"])
    return pages.select("page_id", "url", extract(F.col("html").cast("string")).alias("main")).select("page_id", "url", "main.*")
