"""Main text of web pages by the distribution of text over lines of blocks.

The markup is read once. Every block element with text gives a line; what lies in scripts, styles, forms,
navigation, asides, notices, adverts, comments of readers and the like is left out and parts
nothing, and text in links weighs nothing. The weights of ``WINDOW`` lines in a row are summed. Main
text starts at a surge, where a sum rises over the limit, and ends at a dive, where the
sums fall to nothing. The stretch with the most text is kept, and with it, however short, what lies
in the same block of the page; others are kept if they come near it. All
of every ``article`` or ``main`` that is not left out is main text, one inside another being part of the
outermost; stretches outside them are kept if they come near the text inside or the largest stretch. A class, id or
form marks nothing where the element holds most of the text of articles, or of a page without them.

Defined results: NULL and empty pages, and pages without text, give ''; unclosed elements run
to the end of what holds them; broken tags are text; equal pages give equal texts; rows keep their other
columns on request.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from dugout.llm.common import PerText

WINDOW = 3
SURGE = 80
NEAR = 0.3

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is not markup and not text.
RAW = frozenset("script style noscript template textarea title iframe svg math canvas object".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search "
    "section select summary table tbody td tfoot th thead tr ul".split()
)
# Blocks of running text, which pages without wrappers have in the body itself.
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr".split())
SKIPPED = frozenset(
    "nav footer aside form menu select button dialog search fieldset head audio video map label datalist".split()
)
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsense alert banner breadcrumb breadcrumbs byline comment "
    "comments commentlist consent cookie cookies copyright disclaimer disqus discussion footer gdpr header legal login "
    "masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination "
    "paywall popup promo promoted promotion recommended related replies reply respond search share sharing sidebar "
    "signup skip social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets".split()
)
# What these mark is never main text, however long.
NEVER = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsense comment comments commentlist consent cookie cookies "
    "disqus gdpr promo promoted promotion recommended related replies reply respond sponsor sponsored".split()
)
# Parts of an article have such names too.
IN_ARTICLE = frozenset("banner byline copyright disclaimer header legal masthead notice notices overlay tags".split())
# Places on a page: only as a whole name, not as a word of one.
PLACES = frozenset("banner footer header menu modal nav navbar overlay popup sidebar toolbar topbar widget widgets".split())
BESIDE = frozenset("left right top bottom primary secondary site page main global fixed sticky inner area box block".split())
# What may stand beside a hint in a name inside an article.
KINDS = frozenset("reader readers user users visitor visitors list section wrap wrapper container thread bar button buttons link links unit slot".split())
STATES = frozenset("has have no not with without show hide is".split())
MAY_WRAP = frozenset("form fieldset header dialog".split())
EMPTY = frozenset("svg math iframe".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
CLOSES_P = BLOCK - {"option"}

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"""|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>|<[!?/][^>]*>|<[a-zA-Z/!?][^>]*\Z""",
    re.S,
)
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_BARE = re.compile(r"""(?:^|\s)hidden(?:\s|/|$)""", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")


REGIONS = ("article", "main")


@dataclass
class Element:
    """An element, the place of the one around it or -1, and whether its lines are left out or in a region."""

    parent: int
    name: str
    aside: int
    size: int = 0  # characters in it that are in no link and not surely left out
    held: int = 0  # those of them in articles
    out: bool = False
    region: bool = False
    top: int = -1  # the outermost block below the body


@dataclass
class Line:
    """A block's text, what of it is in links, its innermost element or -1, whether it is left out or in a region."""

    text: str
    links: int
    at: int
    out: bool = False
    region: bool = False

    @property
    def weight(self) -> int:
        return 0 if self.out or 2 * self.links > len(self.text) else len(self.text) - self.links


SURE, UNLESS_MAIN = 2, 1


def _hint(value: str, in_article: bool) -> int:
    """What a class or id says, name by name."""
    found = 0
    for name in value.split():
        parts = [x for x in _PARTS.split(_CAMEL.sub(" ", name).lower()) if x]
        if not parts or not STATES.isdisjoint(parts):
            continue
        hints = HINTS.intersection(parts)
        if not {x for x in parts if not x.isdigit()} <= BESIDE | PLACES:
            hints -= PLACES
        if in_article:
            # Parts of an article are named after what they are about: only a name made of nothing else counts.
            hints = hints - IN_ARTICLE if {x for x in parts if not x.isdigit()} <= HINTS | BESIDE | KINDS else set()
        if hints:
            found = max(found, UNLESS_MAIN if NEVER.isdisjoint(hints) else SURE)
    return found


def is_aside(name: str, attrs: str, in_article: bool) -> int:
    """Whether an element's name or attributes mark it as not main text: SURE, UNLESS_MAIN or 0."""
    found = 0
    if name in SKIPPED or (name == "header" and not in_article):
        if name not in MAY_WRAP:
            return SURE
        found = UNLESS_MAIN
    if not attrs or name in ("html", "body", "main") or (name == "article" and not in_article):
        return found
    if _BARE.search(re.sub(r""""[^"]*"|'[^']*'""", "", attrs)):
        return SURE
    for key, a, b, c in _ATTR.findall(attrs):
        key, value = key.lower(), a or b or c
        if key in ("class", "id"):
            found = max(found, _hint(value, in_article))
        elif key == "role":
            if value.strip().lower() in ROLES:
                found = max(found, UNLESS_MAIN if value.strip().lower() in MAY_WRAP else SURE)
        elif key == "style":
            if "display:none" in value.replace(" ", "").lower():
                return SURE
        elif key == "aria-hidden" and value.strip().lower() == "true":
            return SURE
    return found


class _Reader:
    """Walks the markup and collects lines."""

    def __init__(self) -> None:
        self.lines: list[Line] = []
        self.elements: list[Element] = []
        self.open: list[tuple[str, int]] = []  # name, place in elements
        self.names: Counter[str] = Counter()  # of the open elements
        self.parts: list[str] = []
        self.links = 0

    def add(self, raw: str) -> None:
        text = html.unescape(raw)
        self.parts.append(text)
        if self.names["a"]:
            self.links += len(_SPACE.sub(" ", text).strip())

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            self.lines.append(Line(text, min(self.links, len(text)), self.open[-1][1] if self.open else -1))
        self.parts, self.links = [], 0

    def start(self, name: str, attrs: str) -> None:
        if name in CLOSES_P and self.names["p"]:
            self.end("p")
        if name in ("li", "option", "tr", "td", "th", "dd", "dt") and self.open and self.open[-1][0] == name:
            self.end(name)
        around = any(self.names[n] for n in REGIONS)
        self.elements.append(Element(self.open[-1][1] if self.open else -1, name, is_aside(name, attrs, around)))
        self.open.append((name, len(self.elements) - 1))
        self.names[name] += 1

    def end(self, name: str) -> None:
        if not self.names[name]:
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == name:
                if any(n in BLOCK for n, _ in self.open[at:]) and self.parts:
                    self.flush()
                self.names.subtract(n for n, _ in self.open[at:])
                del self.open[at:]
                return

    def weigh(self) -> None:
        """Sums up the text of each element, what is surely left out aside."""
        sure, within = [], []
        for x in self.elements:
            sure.append(x.aside == SURE or (x.parent >= 0 and sure[x.parent]))
            within.append(x.name in REGIONS or (x.parent >= 0 and within[x.parent]))
        for line in self.lines:
            if line.at >= 0 and not sure[line.at]:
                self.elements[line.at].size += len(line.text) - line.links
                self.elements[line.at].held += (len(line.text) - line.links) * within[line.at]
        for x in reversed(self.elements):
            if x.parent >= 0:
                self.elements[x.parent].size += x.size
                self.elements[x.parent].held += x.held

    def settle(self) -> list[Line]:
        """The lines, told what the elements around them make of them."""
        self.weigh()
        size = sum(x.size for x in self.elements if x.parent < 0) + sum(len(x.text) - x.links for x in self.lines if x.at < 0)
        held = sum(x.held for x in self.elements if x.parent < 0)
        for i, x in enumerate(self.elements):
            up = self.elements[x.parent] if x.parent >= 0 else None
            is_main = 2 * x.held > held or (x.held == held and 2 * x.size > size)
            x.out = x.aside == SURE or (x.aside > 0 and not is_main) or (up is not None and up.out)
            x.region = not x.out and (x.name in REGIONS or (up is not None and up.region))
            x.top = up.top if up is not None and up.top >= 0 else i if x.name in BLOCK - {"html", "body"} else -1
        for line in self.lines:
            if line.at >= 0:
                line.out, line.region = self.elements[line.at].out, self.elements[line.at].region
        return self.lines

    def read(self, page: str) -> list[Line]:
        at, n = 0, len(page)
        while at < n:
            tag = _TAG.search(page, at)
            if tag is None:
                self.add(page[at:])
                break
            if tag.start() > at:
                self.add(page[at : tag.start()])
            at = tag.end()
            name = tag["name"] or tag["name2"]
            if not name:
                continue
            name, attrs = name.lower(), tag["attrs"] or tag["attrs2"] or ""
            if tag["end"] or tag["end2"]:
                if name in BLOCK:
                    self.flush()
                self.end(name)
                continue
            if name == "br":
                self.parts.append(" ")
            if name in BLOCK:
                self.flush()
                if name == "body":
                    self.end("head")
            if name in EMPTY and attrs.endswith("/"):
                continue
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}\s*>|\Z", re.I).search(page, at)
                at = close.end()
            elif name not in VOID and not attrs.endswith("/"):
                self.start(name, attrs)
            elif name not in VOID and name not in BLOCK:
                self.start(name, attrs[:-1])
        self.flush()
        return self.settle()


def _stretches(weights: list[int]) -> list[tuple[int, int, int]]:
    """(first, surge, end) of the lines between dives; the surge is at the end if there is none."""
    sums = [sum(weights[i : i + WINDOW]) for i in range(len(weights))]
    limit = min(SURGE, max(sums, default=0) / 2)
    found, start, surge = [], None, None
    for i, total in enumerate([*sums, 0]):
        if start is None and total and weights[i]:
            start = i
        if start is not None and surge is None and total >= limit and weights[i]:
            surge = i
        if start is not None and not total:
            found.append((start, i if surge is None else surge, i))
            start = surge = None
    return found


def _chosen(lines: list[Line], elements: list[Element]) -> list[Line]:
    """The lines of main text: all in regions, and what the distribution finds outside them."""
    inside = sum(len(x.text) for x in lines if x.region)
    shown = [x for x in lines if not x.out]
    weights = [0 if x.region else x.weight for x in shown]
    found = _stretches(weights)
    size = [sum(weights[surge:end]) for _, surge, end in found]
    most = max([inside, *size])
    tops = [elements[x.at].top if x.at >= 0 else -1 for x in shown]
    near = [False] * len(shown)
    if found and max(size) == most and most:
        # The block below the body that holds most of the largest stretch; else the flow of the body itself.
        _, surge, end = found[size.index(most)]
        share: dict[int, int] = {}
        for i in range(surge, end):
            share[tops[i]] = share.get(tops[i], 0) + weights[i]
        box = max(share, key=share.get)
        if 2 * share[box] > most and box >= 0 and elements[box].name not in FLOW:
            near = [top == box for top in tops]
        else:
            box, near = -1, [top < 0 or elements[top].name in FLOW for top in tops]
    else:
        box = 0
    keep = {i for i, x in enumerate(shown) if x.region}
    for (first, surge, end), n in zip(found, size, strict=True):
        keep.update(i for i in range(first, end) if near[i])
        if n and (n >= NEAR * most or box < 0):
            keep.update(range(surge, end))
    return [x for i, x in enumerate(shown) if i in keep]


def main_text(page: str | None) -> str:
    """The article of a page, its blocks joined by an empty line."""
    if not page:
        return ""
    reader = _Reader()
    return "\n\n".join(x.text for x in _chosen(reader.read(page), reader.elements))


def extract(pages: DataFrame, columns: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """``columns`` of ``pages`` with text and n_chars, read from the whole html."""

    def read(pages: list[str | None]) -> list[tuple]:
        texts = [main_text(page) for page in pages]
        return [(text, len(text)) for text in texts]

    return PerText(pages, columns, "html", {"text": "string", "n_chars": "long"}, read).with_columns()
