"""Main text of web pages.

Method: a page is cut into blocks at block tags. Pass one decides blocks by
where they stand (menus, notices, forms, comments are out), by link density, and
by stop-word density and length. What stays open, short or middling blocks, takes
in pass two the label of the nearest decided neighbours. A wrapper put out by its
names alone comes back at an article or main inside it, or if it holds most of
the page's dense text; within an article only names of comments, notices,
menus and advertising count. A page's mark of its article shifts the limits: inside, fewer stop words or less
length make a block text, and what stays open goes by the article's own blocks; outside, none suffices. Blocks of links
inside it go with the text of the article, but for menus.

Cases: a null or empty page has an empty text. Broken markup is read as far as
it goes: unclosed tags end with their container, an unclosed comment or script
ends with the page. Repeated rows are read each for itself, pages whole; other
columns than id, url and html are left out; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import map_rows

_NO_TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>""", re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_MARK = re.compile(r"""[>"']""")
_ATTR = re.compile(r"""([^\s=/>"']+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav object ol optgroup option p pre section select summary table "
    "tbody td template textarea tfoot th thead title tr ul".split()
)
#: Containers that the end tag of an element outside them, which is no block, does not close.
BOUNDS = frozenset(("article", "main", "body", "td"))
#: Elements whose content is no markup: read up to their end tag.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: Elements that never hold main text.
OUT = frozenset(
    "head script style noscript template iframe object svg canvas audio video map nav footer aside form menu dialog button select option "
    "textarea input label fieldset title".split()
)
#: Words of class, id and role that mark what is around an article.
AROUND = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu menubar "
    "masthead sidebar aside footer cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login signin register share sharing social related recommended recommendations recirculation breadcrumb breadcrumbs "
    "pagination pager paging comment comments commentlist disqus respond reply replies discussion toolbar widget copyright legal disclaimer "
    "skip search complementary contentinfo search hidden".split()
)
#: Parts that mark it inside longer words, too.
_WITHIN = re.compile(r"cookie|advert|sidebar|navbar|footer|newsletter|breadcrumb|disqus|sponsor|^ad(box|slot|unit|wrap|banner|container)|^comments|comments$|menu$")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
#: Of these, what still counts on the element that marks an article.
_NOT_ARTICLE = frozenset("comment comments commentlist reply replies respond ad ads advert advertisement sponsored promo related recommended teaser".split())
#: Of these, names of comments and of other pages.
_OTHER = frozenset("comment comments commentlist reply replies respond related recommended".split())
#: Names that count within an article, besides those with a part of ``_WITHIN``.
_IN_ARTICLE = _OTHER | frozenset("ad ads advert advertisement sponsored promo adv adverts advertisements advertising adsense promotion navbar menubar hidden".split())
#: Notices: never the main text, however long.
_NOTICE = re.compile(r"cookie|advert|sponsor|newsletter|^(consent|gdpr|ads?|promo)$|^ad(box|slot|unit|wrap|banner|container)")
#: A name that only tells what else is there: has-sidebar, comments-open.
_ABOUT = re.compile(r"^(?:has|with|no|without)[-_]|^(?:has|with|no|without)(?=[A-Z])|[-_](?:open|closed|enabled|disabled|on|off|free|supported)$")
#: With these, related or recommended is a list of other pages; else (related-work) a topic.
_LISTS = frozenset("related recommended recommendations".split())
_HEADING = re.compile(r"h[1-6]")
_OTHERS = frozenset(
    "posts post articles article stories story links link content news items item topics pages videos products reads reading list box widget "
    "block entries container wrapper section grid module area".split()
)
_ENDS_P = BLOCK - {"br", "button", "option", "optgroup", "select", "textarea", "title", "iframe", "object"}

STOP_WORDS = frozenset(
    # fixed values: the most frequent function words
    "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which you were her all she there "  # en
    "le la les de du des et en un une est que qui dans pour pas sur par au aux avec ce il elle ne se plus son sa ou "  # fr
    "der die das und den von zu mit sich auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer "  # de
    "el los las y a una por con no su para es al lo como más del se o pero sus".split()  # es
)
_WORD = re.compile(r"[^\W\d_]+")

#: So many blocks of links in a row within an article, of so many code points on average at most, are a menu.
RUN, RUN_SHORT = 3, 40
#: Limits of pass one: share of stop words (high, low), code points (short, long), share of link text.
STOP_HIGH, STOP_LOW, SHORT, LONG, LINKS, LINKS_IN_ARTICLE = 0.30, 0.15, 70, 200, 0.35, 0.75


@dataclass
class Block:
    text: str
    linked: float
    out: bool
    article: int  # the number of the article or main around it, 0 outside
    heading: bool
    label: str = ""


#: How firmly an element stands around an article: by a name that within an article only bars links; by a name; by that of
#: a notice or advertising, which no mass of text brings back; by that of comments or other pages, whose articles are not the
#: page's; by its kind.
DOUBT, NAMED, NOTICE, OTHERS, SURE = 1, 2, 3, 4, 5


@dataclass
class Root:
    """An element put out by its names: the one around it and its dense text."""

    above: int
    level: int
    dense: int = 0
    out: bool = True


class Tags:
    """Ends of tags. What was found open up to the end of the page is known from then on, so all searches together are linear."""

    def __init__(self, html: str):
        self.html, self.last = html, html.rfind(">")
        self.open: set[int] = set()  # quotes from which no tag ends

    def end(self, at: int) -> int:
        """Where the first ``>`` outside quotes from ``at`` on stands; -1 if there is none."""
        passed = []
        while at <= self.last:
            found = _MARK.search(self.html, at)
            if found is None:
                break
            if found.group() == ">":
                return found.start()
            quote = found.start()
            if quote in self.open:
                break
            passed.append(quote)
            closed = self.html.find(found.group(), quote + 1)
            if closed < 0:
                break
            at = closed + 1
        self.open.update(passed)
        return -1


class Stack:
    """Open elements. Where each name, block and container stands last is kept, so no tag walks through them."""

    def __init__(self) -> None:
        self.items: list[tuple[str, bool, int, int]] = []  # name, out, article, root
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.bounds: list[int] = []

    def push(self, name: str, *rest) -> None:
        at = len(self.items)
        self.items.append((name, *rest))
        self.places.setdefault(name, []).append(at)
        if name in BLOCK:
            self.blocks.append(at)
        if name in BOUNDS:
            self.bounds.append(at)

    def cut(self, at: int) -> None:
        """Closes the elements from place ``at`` on."""
        while len(self.items) > at:
            name = self.items.pop()[0]
            self.places[name].pop()
            for kept in (self.blocks, self.bounds):
                if kept and kept[-1] == len(self.items):
                    kept.pop()

    def close(self, name: str) -> None:
        """An end tag: closes its element, if one is open and, for what is no block, within the same container."""
        places = self.places.get(name)
        if places and (name in BLOCK or not self.bounds or self.bounds[-1] <= places[-1]):
            self.cut(places[-1])

    def imply(self, name: str) -> None:
        """A block starts: a paragraph ends, and an element of a list or table before the next."""
        if self.blocks:
            last = self.items[self.blocks[-1]][0]
            if last == "p" or last == name and name in ("li", "dd", "dt", "td", "th", "tr"):
                self.cut(self.blocks[-1])


def blocks(html: str) -> list[Block]:
    """The non-empty blocks of a page, in order."""
    done: list[Block] = []
    within: list[int] = []  # root of each block
    roots = [Root(0, 0)]
    stack, tags = Stack(), Tags(html)
    parts: list[str] = []
    linked = links = 0
    out = heading = False
    root = article = articles = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", unescape("".join(parts))).strip()
            if text:
                done.append(Block(text, min(1.0, linked / len(text)), out, article, heading))
                within.append(root)
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if links:
                linked += len(_SPACE.sub(" ", unescape(text)).strip())

    def settle() -> None:
        nonlocal out, article, root
        out, article, root = stack.items[-1][1:] if stack.items else (False, 0, 0)

    at = 0
    while True:
        start = html.find("<", at)
        if start < 0:
            add(html[at:])
            break
        special = html.startswith(("<!", "<?"), start)
        found = _NO_TAG.match(html, start) if special and (start < tags.last or html.startswith(("<!--", "<![CDATA["), start)) else None
        if found is not None:
            add(html[at:start])
            at = found.end()
            if found["cdata"]:
                add(found["cdata"].replace("&", "&amp;"))
            continue
        found = _TAG.match(html, start) if start < tags.last else None
        if found is None:  # a lone sign
            add(html[at : start + 1])
            at = start + 1
            continue
        add(html[at:start])
        end = tags.end(found.end())
        # a tag whose quotes don't close ends at the next sign
        attrs = html[found.end() : end] if end >= 0 else ""
        at = (end if end >= 0 else html.index(">", found.end())) + 1
        name, closing = found[2].lower(), bool(found[1])
        if name == "a":
            links = 0 if closing else 1
            continue
        if name in VOID:
            if name in BLOCK:
                flush()
            continue
        if closing:
            if name in BLOCK:
                flush()
            stack.close(name)
            links = 0 if name in BLOCK else links
            heading = heading and name not in BLOCK
            settle()
            continue
        if name in BLOCK:
            flush()
            heading = len(name) == 2 and name[0] == "h" and name[1] in "123456"
        if name in _ENDS_P:
            stack.imply(name)
            settle()
            links = 0
        level = _around(name, attrs, article)
        marks = name in ("article", "main") or "articleBody" in attrs or 'role="main"' in attrs
        if marks and level <= NAMED and (roots[root].level < OTHERS or name == "main"):
            root = level = 0
        elif 0 < level < SURE:
            roots.append(Root(root, max(level, OTHERS if roots[root].level == OTHERS else 0)))
            root = len(roots) - 1
        articles += marks and not article
        stack.push(name, out or level == SURE, article or (articles if marks else 0), root)
        settle()
        if name in RAW:
            end = re.compile(rf"</{name}\b", re.I).search(html, at)
            add(html[at : end.start()] if end else html[at:])
            at = end.start() if end else len(html)
    flush()
    _settle(done, within, roots)
    return done


def _settle(done: list[Block], within: list[int], roots: list[Root]) -> None:
    """Put out the blocks below the roots, but for a root that holds most of the dense text."""
    if len(roots) == 1:
        return
    dense = 0
    for b, root in zip(done, within) if any(r.level == NAMED for r in roots) else ():
        if not b.out and roots[root].level < NOTICE and b.linked <= LINKS and len(b.text) >= SHORT and _stops(b.text) >= STOP_LOW:
            roots[root].dense += len(b.text)
            dense += len(b.text)
    for root in reversed(roots[1:]):
        roots[root.above].dense += root.dense
    roots[0].out = False
    for root in roots[1:]:
        root.out = roots[root.above].out or root.level > NAMED or root.level == NAMED and 2 * root.dense <= dense
    for b, root in zip(done, within):
        b.out = b.out or roots[root].out or roots[root].level == DOUBT and b.linked > LINKS


def _around(name: str, attrs: str, article: int) -> int:
    """How firmly an element stands around an article, by its name, class, id, role or by being hidden; 0 if it does not."""
    if name in OUT or name == "header" and not article:
        return SURE
    if not attrs or name in ("html", "body"):
        return 0
    words: set[str] = set()
    topics: set[str] = set()
    for found in _ATTR.finditer(attrs):
        key, value = found[1].lower(), found[2] or found[3] or found[4] or ""
        if key in ("class", "id", "role"):
            # the id of a heading or section is its topic
            into = topics if key == "id" and (name == "section" or _HEADING.fullmatch(name)) else words
            for one in value.split():
                if not _ABOUT.search(one):
                    parts = {*re.split(r"[_\-:]+", one.lower()), *re.split(r"[_\-:]+", _CAMEL.sub("-", one).lower())}
                    into.update(parts if len(parts) == 1 and into is words or parts & _OTHERS else parts - _LISTS)
            continue
        value = value.lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return SURE
    if name in ("article", "main"):
        return OTHERS if words & _NOT_ARTICLE else 0
    if words & _OTHER or name == "section" and topics & _OTHER:
        return OTHERS
    if name == "section" and not article:
        words.update(t for t in topics if _WITHIN.search(t))
    inside = any(map(_WITHIN.search, words))
    if inside or words & (_IN_ARTICLE if article else AROUND):
        return NOTICE if any(map(_NOTICE.search, words)) else NAMED
    if words & AROUND:
        return DOUBT
    return NAMED if "header" in words and not article and not words & {"article", "entry", "post", "content"} else 0


def _stops(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def classify(page: list[Block]) -> list[Block]:
    """The blocks with their labels set, ``text`` or ``rest``."""
    marked = any(b.article and not b.out and b.linked <= LINKS_IN_ARTICLE for b in page)
    for b in page:
        b.label = _first(b, marked)
    _links(page)
    if not any(b.label == "text" for b in page):
        for b in page:
            if b.label == "near":
                b.label = "text"
    # what is out by its place says nothing about the blocks beside that place; an article's blocks go by its own
    decided: dict[int, list[tuple[int, str]]] = {}
    group = (lambda b: b.article) if marked else (lambda b: 0)
    for i, b in enumerate(page):
        if b.label in ("text", "rest") and not b.out:
            decided.setdefault(group(b), []).append((i, b.label))
    passed = dict.fromkeys(decided, 0)
    for i, b in enumerate(page):
        if b.label in ("text", "rest"):
            if not b.out:
                passed[group(b)] += 1
            continue
        mine, at = decided.get(group(b), []), passed.get(group(b), 0)
        before = mine[at - 1] if at else None
        after = mine[at] if at < len(mine) else None
        if marked:  # within an article with text, what stands between two menus is none
            b.label = "rest" if before and after and before[1] == after[1] == "rest" and any(t == "text" for _, t in mine) else "text"
        else:
            b.label = _second(b, i, before, after)
    return page


def _links(page: list[Block]) -> None:
    """Labels of blocks of links in articles: text in an article with text, but for menus, runs of several short ones."""
    texts = {b.article for b in page if b.label in ("text", "near", "short") and b.article}
    run: list[Block] = []
    for b in [*page, None]:
        if b is not None and b.label == "link":
            b.label = "text" if b.article in texts else "rest"
            if not b.heading:
                run.append(b)
                continue
        if len(run) >= RUN and sum(len(r.text) for r in run) <= RUN_SHORT * len(run):
            for r in run:
                r.label = "rest"
        run = []


def _first(b: Block, marked: bool) -> str:
    if b.out or "©" in b.text[:3]:
        return "rest"
    if marked and not b.article:
        return "rest"
    if marked and b.linked > LINKS_IN_ARTICLE:
        return "link"
    # the mark of an article lowers the limits: all but bare short blocks and thin ones is text at once
    if not marked and b.linked > LINKS:
        return "rest"
    if len(b.text) < SHORT:
        return "rest" if b.linked and not marked else "short"
    stops = _stops(b.text)
    if marked:
        return "text" if stops >= STOP_LOW or len(b.text) >= LONG else "near"
    if stops >= STOP_HIGH:
        return "text" if len(b.text) >= LONG else "near"
    if stops >= STOP_LOW or not b.linked and len(b.text) >= LONG:
        return "near"
    return "rest" if b.linked else "short"


def _second(b: Block, i: int, before: tuple[int, str] | None, after: tuple[int, str] | None) -> str:
    """Label from the nearest decided neighbours; where they differ, a heading goes with what follows it."""
    sides = [s for s in (before, after) if s]
    if not sides:
        return "text" if b.label == "near" else "rest"
    if len({label for _, label in sides}) == 1:
        return sides[0][1]
    if b.label == "near":
        return "text"
    if b.heading:
        return after[1]
    return min(sides, key=lambda s: (abs(s[0] - i), s[1] == "rest"))[1]


def main_text(html: str | None) -> str:
    if not html:
        return ""
    return " ".join(b.text for b in classify(blocks(html)) if b.label == "text")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, ``text string``, ``n_chars long`` of each row."""
    source = pages.select(F.col(id_col), F.col(url_col), F.col(html_col))

    def row(key, url, html):
        text = main_text(html)
        return key, url, text, len(text)

    kinds = dict(source.dtypes)
    return map_rows(source, lambda: row, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long")
