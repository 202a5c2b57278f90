"""The visible lines of one HTML page, with what the markup itself says of their place."""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from html import unescape

# Elements that begin a line of their own, those never shown as text of the page's subject,
# those without content, and those whose content is no markup.
BLOCKS = frozenset(
    "address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "applet aside audio button canvas dialog footer iframe map menu nav noframes noscript object search select svg "
    "template video".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "iframe|noembed|noframes|script|style|textarea|title|xmp"
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An element ends an open one of these, unless one of the bounds was opened since.
ENDS = {"li": (("li",), ("ul", "ol")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
        "td": (("td", "th"), ("table",)), "th": (("td", "th"), ("table",)), "tr": (("tr",), ("table",))}
CELLS = ("td", "th", "caption")
# Words in a class, id or role that mark menus, headers, sidebars, notices, adverts, forms and comments.
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising alert alertdialog banner breadcrumb breadcrumbs comment commentlist "
    "comments complementary consent contentinfo cookie cookies dialog disqus footer form gdpr login menu menus modal nav "
    "navbar navigation newsletter notice notices overlay pager pagination popup promo promoted promotion related replies "
    "respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar "
    "widget".split()
)
NOT_NOISE = frozenset("has is no not with without".split())

_ATTRS = r"""(?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?+)*+"""
TOKEN = re.compile(
    rf"""<!--(?:-?>|.*?(?:--!?>|\Z))
    |<(?P<raw>{RAW})(?=[\s/>]){_ATTRS}(?:>|\Z).*?(?:</(?P=raw)(?=[\s/>])[^>]*(?:>|\Z)|\Z)
    |<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>{_ATTRS})(?:>|\Z)
    |<[!?][^>]*(?:>|\Z)
    |</[^>]*>""",
    re.IGNORECASE | re.DOTALL | re.VERBOSE,
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Places, as bits: dropped, in a header inside an article, in an article, in the main element, in a form or an element
# named as noise, and in an article or main element inside of such a one.
NOWHERE, HEADER, ARTICLE, MAIN, SUSPECT, LIFTED = (1 << i for i in range(6))
# Above them stands the number of the article element, from 1.
NUMBER = 6


def noise_of(attrs: str) -> str:
    """'' for shown content, else 'hidden', 'header' or 'noise', by the element's attributes."""
    for name, *values in ATTRIBUTE.findall(attrs):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return "hidden"
        if name == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
            return "hidden"
        if name in ("class", "id", "role"):
            for one in value.split():
                parts = [p.lower() for p in NAME_PART.findall(one)]
                if parts and parts[0] not in NOT_NOISE:
                    if "header" in parts:
                        return "header"
                    if not NOISE.isdisjoint(parts):
                        return "noise"
    return ""


def place_of(name: str, attrs: str, place: int) -> int:
    """The place inside an element that opens at `place`."""
    if name in HEADINGS:
        place &= ~HEADER
    kind = noise_of(attrs) if attrs else ""
    # An article in an article is a comment on it.
    if name in DROPPED or kind == "hidden" or (name == "article" and place & ARTICLE):
        return place | NOWHERE
    if name in ("article", "main"):
        if place & SUSPECT:
            place = place & ~SUSPECT | LIFTED
        return place | (ARTICLE if name == "article" else MAIN)
    if name == "header" or (kind == "header" and name not in HEADINGS):
        return place | (HEADER if place & ARTICLE else NOWHERE if name == "header" else SUSPECT)
    if kind or name == "form":
        return place | (NOWHERE if place & ARTICLE else SUSPECT)
    return place


def placed_lines(html: str) -> list[tuple[int, str]]:
    """(place, text) of the lines, those that the markup drops too. Linear in the page's length."""
    out: list[tuple[int, str]] = []
    held: list[str] = []
    unheld: list[str] = []
    articles = 0
    stack: list[tuple[str, int]] = []
    where: dict[str, list[int]] = defaultdict(list)
    line_place = 0

    def last(names: tuple[str, ...]) -> int:
        return max((where[n][-1] for n in names if where[n]), default=-1)

    def close(at: int) -> None:
        while len(stack) > at:
            where[stack.pop()[0]].pop()

    def flush() -> None:
        # Dropped words inside a line do not part it: they are a line beside it.
        for parts, place in ((held, line_place), (unheld, NOWHERE)):
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                out.append((place, text))

    def add(text: str) -> None:
        nonlocal line_place
        place = stack[-1][1] if stack else 0
        if text and place & (NOWHERE | HEADER):
            unheld.append(text)
        elif text:
            line_place = place
            held.append(text)

    at = 0
    for token in TOKEN.finditer(html):
        add(unescape(html[at : token.start()]))
        at = token.end()
        name = (token["name"] or "").lower()
        if name == "br":
            add(" ")
        elif name in BLOCKS or name == "hr":
            flush()
        if not name or name in VOID or name in ("html", "head", "body"):
            continue
        top = stack[-1] if stack else ("", 0)
        if token["end"]:
            if name not in BLOCKS:
                # Only elements that change the place are kept on the stack.
                if top[0] == name:
                    close(len(stack) - 1)
            elif where[name] and (where[name][-1] > last(CELLS) or name in ("table", "tbody", "thead", "tfoot", "tr", *CELLS)):
                close(where[name][-1])
            continue
        if name in BLOCKS:
            names, bounds = ENDS.get(name, ((), ()))
            for ended, bound in ((names, bounds), (("p",), CELLS)):
                if last(ended) > last(bound):
                    close(last(ended))
            top = stack[-1] if stack else ("", 0)
        elif token["attrs"].endswith("/"):
            continue
        place = place_of(name, token["attrs"], top[1])
        if place & ARTICLE and not top[1] & ARTICLE:
            articles += 1
            place |= articles << NUMBER
        if name in BLOCKS or place != top[1] or top[0] == name:
            where[name].append(len(stack))
            stack.append((name, place))
    add(unescape(html[at:]))
    flush()
    return out


@dataclass
class Lines:
    """All lines of a page, and those that the markup leaves: their positions and the number of their article (0: none)."""

    every: list[str]
    at: list[int]
    article: list[int]

    @property
    def left(self) -> list[str]:
        return [self.every[i] for i in self.at]


def judged_lines(html: str | None) -> Lines:
    """The lines, with what the markup says: left are those of the article, else those that it does not drop.

    An article inside a form or an element named as noise counts where the rest of
    the page has less text; a page that has nothing else keeps what is in them.
    """
    lines = placed_lines(html or "")
    shown = [i for i, (place, _) in enumerate(lines) if not place & NOWHERE]
    chosen = lambda has, lacks: [i for i in shown if lines[i][0] & has == has and not lines[i][0] & lacks]
    size = lambda found: sum(len(lines[i][1]) for i in found)
    at = chosen(ARTICLE, LIFTED)
    if not at:
        lifted, rest = chosen(ARTICLE, 0), chosen(MAIN, LIFTED | ARTICLE) or chosen(0, SUSPECT | ARTICLE)
        at = lifted if size(lifted) > size(rest) else rest or shown
    return Lines([text for _, text in lines], at, [lines[i][0] >> NUMBER for i in at])


def page_lines(html: str | None) -> tuple[bool, list[str], list[str]]:
    """Whether the markup names the article, and its lines; else the lines that the markup does not drop. Then all lines."""
    lines = judged_lines(html)
    return any(lines.article), lines.left, lines.every
