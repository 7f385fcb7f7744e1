"""Main text of web pages by two passes of block rules.

The first pass cuts a page into blocks and classifies each by stop-word density, length and link
density, after blocks in menus, adverts and the like are set aside by their elements and names. The
second pass gives ambiguous blocks the label of their nearest decided neighbours. An article element
that holds a fair share of the text moves the thresholds for its blocks and bounds neighbourhoods; it
decides nothing alone.
"""

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from math import comb
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.batches import small_batches

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = frozenset(
    """
    a an and are as at be been but by can for from had has have he her his how i if in is it its more
    not of on or our she so than that the their them there they this to was we were what when which
    who will with you your
    au aux avec ce ces cette dans de des du elle elles en est et il ils je la le les leur lui mais
    ne nous ont ou par pas plus pour qu que qui sa se ses son sont sur un une vous à été être
    aber als am auch auf aus bei das dass dem den der des die durch ein eine einem einen einer es für
    haben hat ich ihr im ist kann mit nach nicht noch nur oder sein sich sie sind so über um und von
    vor war wenn werden wie wird zu zum zur
    al como con cuando del desde donde el ella ellos era es esta este está fue ha hay la las lo los
    me mi muy más no nos o para pero por porque que se ser si sin sobre son su sus también te un una
    y ya
    """.split()
)
HIDDEN = "script style noscript template svg math iframe object canvas audio video select textarea button".split()
ASIDE = frozenset("nav aside footer form menu dialog fieldset".split())
MAIN = frozenset(("article", "main"))
BLOCK = frozenset(
    """
    address article aside blockquote body caption center dd details dialog div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre
    section summary table tbody td tfoot th thead title tr ul
    """.split()
)
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote".split())
VOID = frozenset(("hr", "br"))
ENDS_ITSELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th")}
# Names and roles that set an element aside wherever it is, and those that do outside the article. The
# name is a whole word of the class, id or role, made of these and of words that say where or what kind.
ASIDE_NAME = (
    r"(?:ads?|adverts?|advertisement|advertising|adsense|adbox|sponsor(?:ed)?|promo(?:tion)?|banner"
    r"|nav(?:bar|igation)?|menu|breadcrumbs?|side-?bar|widgets?|related|recommended|footer|cookies?"
    r"|consent|gdpr|notices?|pop-?up|modal|overlay|newsletter|subscribe|signup|login|share|sharing"
    r"|social|comments?|comment-?list|commentary|disqus|respond|replies|reply|pagination|pager"
    r"|copyright|toolbar|search|alert|complementary|contentinfo|teasers?|sr-only|visually-hidden)"
)
OUTER_NAME = r"(?:header|masthead|top-?bar|site-?title)"
PLACE = (
    r"(?:site|page|post|main|global|primary|secondary|top|bottom|left|right|upper|lower|sticky|fixed|float"
    r"|mobile|desktop|google|author|user|area|bar|block|body|box|button|buttons|card|cards|code|container"
    r"|content|dialog|field|form|group|holder|icons|inner|item|items|label|link|links|list|message|network"
    r"|outer|panel|posts|articles|stories|region|row|section|slot|space|text|thread|title|toggle|unit|wrap|wrapper|[0-9]+)"
)


def _named(names: str) -> re.Pattern:
    # What follows a name is read in one way only, else long names would be tried in very many.
    return re.compile(rf"(?:^|\s)(?:{PLACE}-)*{names}[0-9]*(?:-(?:{names}|{PLACE})(?=[-\s]|$))*+(?=\s|$)")


ASIDE_NAMED, OUTER_NAMED = _named(ASIDE_NAME), _named(OUTER_NAME)
NAMED = re.compile(r"""(?i)(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
NOT_SHOWN = re.compile(r"""(?i)\shidden(?=[\s=/>])|aria-hidden\s*=\s*["']?true|display\s*:\s*none""")
# Possessive throughout, so that no position is tried twice. A quote counts after an equals sign only,
# and only if it is closed.
TAG_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)")
TAG_REST = re.compile(r"""(?:[^=>]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>""")
CLOSED = {name: re.compile(rf"(?i)</{name}\s*+>") for name in [*HIDDEN, "title"]}
WORD = re.compile(r"[^\W\d_]+")
NOTICE = re.compile(r"(?i)^\W*(?:©|\(c\)|copyright\b)|\ball rights reserved\b")


class Tag(NamedTuple):
    start: int
    stop: int
    name: str = ""  # empty for what is not shown: comments, declarations, titles, hidden elements
    closes: bool = False
    attributes: str = ""


def markup(page: str) -> Iterator[Tag]:
    """Markup in page order, found in one pass that never goes back.

    A comment or a hidden element that nothing closes, and a tag without any ``>`` after it, reach to
    the page's end. Where quotes hide every ``>``, tags end at the first one from there on.
    """
    at, quotes, cdata = 0, True, True
    while (start := page.find("<", at)) >= 0:
        at = start + 1
        if page.startswith("<!--", start):
            at = page.find("-->", start + 4) + 3
            at = at if at > 2 else len(page)
            yield Tag(start, at)
            continue
        if page.startswith(("<!", "<?"), start):
            stop = page.find("]]>", start + 9) if cdata and page[start : start + 9].upper() == "<![CDATA[" else -2
            cdata = cdata and stop != -1
            at = stop + 3 if stop >= 0 else page.find(">", start + 2) + 1
            at = at or len(page)
            yield Tag(start, at)
            continue
        named = TAG_NAME.match(page, start)
        if not named:
            continue
        rest = TAG_REST.match(page, named.end()) if quotes else None
        if rest:
            at = rest.end()
        else:
            quotes = False
            at = page.find(">", named.end()) + 1
            if not at:
                yield Tag(start, len(page))
                return
        closes, name, attributes = bool(named[1]), named[2].lower(), page[named.end() : at - 1]
        if not closes and name == "title":
            stop = page.find("<", at)
            closed = CLOSED[name].match(page, stop) if stop >= 0 else None
            at = closed.end() if closed else stop if stop >= 0 else len(page)
            name = ""
        elif not closes and name in CLOSED:
            if not attributes.endswith("/"):
                closed = CLOSED[name].search(page, at)
                at = closed.end() if closed else len(page)
            name = ""
        yield Tag(start, at, name, closes, attributes)


class Block(NamedTuple):
    text: str
    linked: int  # characters inside links
    heading: bool
    main: int  # number of the article it is in, 0 outside
    parent: int  # number of the element that holds it and its like


class _Element(NamedTuple):
    name: str
    aside: bool  # for good
    named: int  # number of the outermost element around it that a name sets aside, or 0
    main: int
    number: int
    holder: int  # number of the innermost element around its text that is no leaf


def blocks_of(page: str, enough: int = 200) -> list[Block]:
    """Blocks in page order, without those that elements or names set aside.

    A name sets an element aside unless an article is in it, or unless fewer than ``enough``
    characters are left without it and it holds two thirds of the page's text.
    """
    out: list[tuple[Block, int]] = []
    parts: list[tuple[str, bool]] = []
    stack: list[_Element] = []
    opened: Counter = Counter()  # elements on the stack by name
    holders: set[int] = set()  # elements set aside by name that hold an article
    in_link, heading, breaks, articles, elements, lost = False, False, 0, 0, 0, 0
    outside = _Element("", False, 0, 0, 0, 0)

    def flush() -> None:
        nonlocal in_link, breaks, lost
        text = " ".join("".join(t for t, _ in parts).split())
        top = stack[-1] if stack else outside
        if text and top.aside:
            lost += len(text)
        elif text:
            linked = sum(len("".join(t.split())) for t, link in parts if link)
            out.append((Block(text, linked, heading, top.main, top.holder), top.named))
        parts.clear()
        in_link, breaks = False, 0

    def leave() -> str:
        name = stack.pop().name
        opened[name] -= 1
        return name

    def say(raw: str) -> None:
        nonlocal breaks
        if raw:
            parts.append((unescape(raw), in_link))
            if not raw.isspace():
                breaks = 0

    at = 0
    for tag in markup(page):
        say(page[at : tag.start])
        at, name = tag.stop, tag.name
        if name == "br":
            parts.append((" ", in_link))
            breaks += 1
            if breaks > 1:
                flush()
        elif name == "a":
            in_link = not tag.closes
        elif name in BLOCK:
            flush()
            if tag.closes:
                if opened[name]:
                    while leave() != name:
                        pass
                heading = False
                continue
            while stack and (stack[-1].name == "p" or stack[-1].name in ENDS_ITSELF.get(name, ())):
                leave()
            heading = len(name) == 2 and name[0] == "h" and name[1].isdigit()
            if name in VOID:
                continue
            _, aside, named, main, _, holder = stack[-1] if stack else outside
            aside = aside or _set_aside(name, tag.attributes, main)
            elements += 1
            if name in MAIN and not aside and not main:
                articles += 1
                main = articles
                holders.add(named)
                named = 0
            elif not named and _named_aside(name, tag.attributes, main):
                named = elements
            holder = holder if name in LEAF else elements
            stack.append(_Element(name, aside, named, main, elements, holder))
            opened[name] += 1
    say(page[at:])
    flush()
    sizes: dict[int, int] = {}
    for block, named in out:
        sizes[named] = sizes.get(named, 0) + len(block.text)
    most = max((n for n in sizes if n), key=sizes.get, default=0)
    free = sum(n for k, n in sizes.items() if not k or k in holders)
    if most and free < enough and 3 * sizes[most] > 2 * (sum(sizes.values()) + lost):
        holders.add(most)
    return [block for block, named in out if not named or named in holders]


def _set_aside(name: str, attributes: str, main: int) -> bool:
    if name in ASIDE or (name == "header" and not main):
        return True
    return name not in ("html", "body") and bool(attributes and NOT_SHOWN.search(attributes + ">"))


def _named_aside(name: str, attributes: str, main: int) -> bool:
    if not attributes or name in ("html", "body", "main") or (name == "article" and not main):
        return False
    # The id of a heading is an anchor that says what it is about.
    heading = len(name) == 2 and name[0] == "h"
    called = " ".join("".join(g[1:]) for g in NAMED.findall(attributes) if not (heading and g[0].lower() == "id"))
    called = called.lower().replace("_", "-")
    return bool(called) and bool(ASIDE_NAMED.search(called) or (not main and OUTER_NAMED.search(called)))


class Rules(NamedTuple):
    """Thresholds of the first pass: lengths in code points, densities as shares."""

    short: int = 70
    long: int = 200
    few_stops: float = 0.12
    many_stops: float = 0.2
    most_links: float = 0.33
    only_links: float = 0.8
    article_share: float = 0.5
    chance: float = 0.001


GOOD, BAD, NEAR, SHORT = "good", "bad", "near", "short"


def _stops(text: str, once: bool = False) -> tuple[int, int]:
    """Stop words and words; ``once``: each counts once."""
    words = WORD.findall(text.lower())
    if once:
        words = set(words)
    return sum(w in STOP_WORDS for w in words), len(words)


def _density(text: str) -> float:
    stops, words = _stops(text)
    return stops / max(1, words)


def _links(block: Block) -> float:
    return block.linked / max(1, len("".join(block.text.split())))


def classify(block: Block, rules: Rules) -> str:
    """First pass: a block by itself."""
    links = _links(block)
    if links > rules.most_links or NOTICE.search(block.text):
        return BAD
    if len(block.text) < rules.short:
        return BAD if links else SHORT
    stops = _density(block.text)
    if stops >= rules.many_stops:
        return GOOD if len(block.text) > rules.long else NEAR
    return NEAR if stops >= rules.few_stops else BAD


def classify_article(blocks: list[Block], rules: Rules) -> list[str]:
    """First pass for the blocks of one article, which are text unless something speaks against it.

    That is links all over, or few stop words, and fewer than chance would give at the density of the
    rest, where each word of a block counts once.
    """
    counts = [_stops(b.text, once=True) if _links(b) <= rules.most_links else (0, 0) for b in blocks]
    all_stops, all_words = (sum(c) for c in zip(*counts))
    out = []
    for b, (stops, words) in zip(blocks, counts):
        links = _links(b)
        if links > rules.only_links:
            out.append(BAD)
        elif links > rules.most_links or len(b.text) < rules.short or (b.heading and not links):
            out.append(SHORT)
        elif _density(b.text) >= rules.few_stops:
            out.append(GOOD)
        else:
            rest = (all_stops - stops) / max(1, all_words - words)
            tail = sum(comb(words, k) * rest**k * (1 - rest) ** (words - k) for k in range(stops + 1)) if words < 500 else 1.0
            known = rest >= rules.few_stops and all_words - words >= words
            out.append(BAD if known and tail < rules.chance else NEAR)
    return out


def settle(
    labels: list[str],
    parents: list[int],
    regions: list[int] | None = None,
    priors: list[bool | None] | None = None,
) -> list[bool]:
    """Second pass: ambiguous blocks inherit the label of their nearest decided neighbours.

    Neighbours in the same element come first, and the nearest of them decides. Elsewhere both
    sides must agree; where they differ a near-good block is good and a short one bad. A side
    without a decided block counts as the other; with none decided at all near-good blocks are good.
    Neighbours lie in the same run of ``regions``. Where neighbours do not tell, a prior goes first.
    """
    regions, priors = regions or [0] * len(labels), priors or [None] * len(labels)

    def decided(order: list[int]) -> list[tuple[int | None, int | None]]:
        last, of_parent, out, region = None, {}, [], None
        for i in order:
            if regions[i] != region:
                last, region = None, regions[i]
            out.append((last, of_parent.get(parents[i])))
            if labels[i] in (GOOD, BAD):
                last = of_parent[parents[i]] = i
        return out

    order = list(range(len(labels)))
    before, after = decided(order), decided(order[::-1])[::-1]
    out = []
    for i, label in enumerate(labels):
        if label in (GOOD, BAD):
            out.append(label == GOOD)
            continue
        near = [j for j in (before[i][1], after[i][1]) if j is not None]
        if near:
            least = min(abs(i - j) for j in near)
            sides = {labels[j] for j in near if abs(i - j) == least}
        else:
            sides = {labels[j] for j in (before[i][0], after[i][0]) if j is not None}
        likely = label == NEAR if priors[i] is None else priors[i]
        out.append(likely if len(sides) != 1 else sides == {GOOD})
    return out


def _long_text(block: Block, rules: Rules) -> bool:
    few_links = block.linked < rules.most_links * len(block.text)
    return len(block.text) > rules.long and few_links and not NOTICE.search(block.text)


def main_text(page: str | None, rules: Rules = Rules()) -> str:
    """The text of a page, one line per block; empty if there is none."""
    blocks = blocks_of(page or "", rules.long)
    labels = [classify(b, rules) for b in blocks]
    # An article vouches for its blocks if it holds a fair share of what is text by itself.
    good, size = {}, {}
    for b, label in zip(blocks, labels):
        good[b.main] = good.get(b.main, 0) + (len(b.text) if label == GOOD else 0)
        size[b.main] = size.get(b.main, 0) + (len(b.text) if _links(b) <= rules.most_links else 0)
    total = sum(good.values())
    vouched = {m for m in size if m and size[m] and size[m] >= rules.article_share * (total - good[m])}
    places: dict[int, list[int]] = {m: [] for m in vouched}
    for i, b in enumerate(blocks):
        if b.main in vouched:
            places[b.main].append(i)
    for at in places.values():
        for i, label in zip(at, classify_article([blocks[i] for i in at], rules)):
            labels[i] = label
    regions = [b.main if b.main in vouched else 0 for b in blocks]
    priors = [True if r else False if vouched else None for r in regions]
    kept = settle(labels, [b.parent for b in blocks], regions, priors)
    if GOOD not in labels:
        # Text in a language without known stop words: long blocks are it.
        kept = [k or _long_text(b, rules) for k, b in zip(kept, blocks)]
    # A heading leads its text: it stays if a block up to the next heading does.
    led = False
    for i in range(len(blocks) - 1, -1, -1):
        last = i + 1 == len(blocks) or regions[i] != regions[i + 1]
        if last:
            led = False
        if blocks[i].heading and labels[i] == SHORT:
            if not last:
                kept[i] = led if regions[i] else kept[i + 1]
            led = kept[i]
        else:
            led = led or kept[i]
    return "\n".join(b.text for b, k in zip(blocks, kept) if k)


def extract(html: Column, rules: Rules = Rules()) -> Column:
    """Main text of a page. Null and empty pages give an empty text."""

    @F.pandas_udf("string")
    def of(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: main_text(p, rules), na_action=None)

    return of(html)


def extract_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with a column ``text``; a column of that name is replaced, ``html_col`` left out.

    A page is read whole, however long. Without an element that holds an article, text that no
    rule decides on is left out, so a page of a few short lines gives an empty text. Every row
    stays, also repeated ones.
    """
    small_batches(pages.sparkSession)
    return pages.withColumn("text", extract(F.col(html_col))).drop(html_col)
