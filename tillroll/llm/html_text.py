"""Main text of web pages by tree scoring.

A page becomes a tree of elements with blocks of text. Subtrees that are never article text (menus,
footers, forms, scripts, whatever a role names as such) are left out first, and so are those that class
or id names as such, if they are comments, or no article or main element and hold little of the text or
many links; others so named only earn less. Each remaining block then passes points for its length and commas to its ancestors, less the further they are; an
element's points are discounted by the share of its text that is in links. Article and main elements
compete with all others, with a bonus in proportion to what they earned, and a further one around the only h1 of a
page, which is large only where no container outside has several paragraphs. The best
container is kept, widened to the article or else main element it lies in, together with siblings that
score well, head what is kept or read like its paragraphs. Article elements beside the best container
in a widened one have to score like siblings.

Null and empty pages, and pages without text, give an empty text. Unclosed and stray tags, missing
end tags and unclosed comments or scripts are taken as browsers take them, near enough. If nothing
is left once named boilerplate is out, names are ignored. Long pages are read whole, repeated rows
give equal rows, an empty table no rows.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# HTML element groups.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe textarea xmp noembed noframes svg object audio video canvas select title annotation annotation-xml".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr output q ruby rb rt rp s samp small span strike strong"
    " sub sup time tt u var wbr"
    # formulas are text of the sentence they stand in
    " math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover munderover"
    " mmultiscripts mprescripts none mtable mtr mtd semantics".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
SCOPES = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
LEFT_OUT = set("head nav aside footer form button dialog menu fieldset datalist".split())
LEFT_OUT_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
BOILERPLATE = set(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs footer sidebar aside ad ads adv advert adverts advertisement advertising banner sponsor sponsored"
    " promo promotion cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription share sharing social related recommended"
    " recommendations comment comments discussion disqus respond replies reply login signin signup register search pagination pager toolbar masthead"
    " widget widgets skip copyright legal disclaimer topbar tracking paywall".split()
)
COMMENTS = set("comment comments discussion disqus respond replies reply".split())
# Words that a part of an article may be about: only links or the lack of prose then speak against it.
SUBJECTS = set("share sharing social related recommended recommendations legal disclaimer copyright search register discussion widget widgets tracking".split())
PROSE = 80  # characters of a block that counts as prose
BESIDE = {"with", "has", "no", "without"}  # a name like content-with-sidebar is the content's
NAMED_LARGE = 0.25  # share of the page's text from which a named element that is not made of links only earns less
NAMED_POINTS = 0.3
START = {"article": 6, "main": 6, "section": 5, "div": 5, "pre": 3, "td": 3, "blockquote": 3, "ul": -3, "ol": -3, "dl": -3, "address": -3, "th": -5}
PARAGRAPHS = set("p pre li td th dd dt blockquote h1 h2 h3 h4 h5 h6 figcaption".split())
HEADINGS = set("h1 h2 h3".split())
MARKED_MOST = 25  # article and main get what they earned once more, up to this
SHORT_LINK = 40  # characters of an item in a menu
TITLE = 25  # the article, else main element around the only h1 gets what it earned once more, up to this
TITLE_ALONE = 100  # if no container outside it has RUN paragraphs of prose
BEFORE_TITLE = 0.2  # then what is left of the points of containers before it
RUN = 3
LEVELS = 40  # ancestors that get points from a block; what further ones would get is below 1 %


class Element:
    __slots__ = ("block", "children", "depth", "links", "n_links", "named", "out", "own", "parent", "points", "prose", "size", "strength", "subject", "tag")

    def __init__(self, tag: str, parent: Element | None, out: bool, named: bool = False, subject: bool = False):
        self.tag, self.parent, self.out, self.named, self.subject = tag, parent, out, named, subject
        inline = tag in INLINE and parent is not None
        self.block: Element = parent.block if inline else self  # the innermost element that is not inline
        self.depth: int = 0 if parent is None else parent.depth + (not inline)  # elements around it that are not inline
        self.prose = 0
        self.children: list[Element] = []
        self.points, self.own, self.strength, self.size, self.links, self.n_links = 0.0, 0.0, 0.0, 0, 0, 0
        if parent is not None:
            parent.children.append(self)


def named_boilerplate(attributes: dict[str, str], words: set[str] = BOILERPLATE) -> bool:
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        parts = {p.lower() for p in NAME_WORDS.findall(name)}
        if parts & words and not parts & BESIDE:
            return True
    return False


def _judged(tag: str, raw: str, in_article: bool, by_name: bool) -> tuple[bool, bool, bool]:
    """Whether an element is left out, whether its names speak against it, and whether they may be its subject."""
    if tag in LEFT_OUT or (tag == "header" and not in_article):
        return True, False, False
    if not raw.strip() or tag in ("html", "body"):
        return False, False, False
    attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)}
    hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower()
    if hidden or attributes.get("role", "").lower() in LEFT_OUT_ROLES:
        return True, False, False
    # an article may be called anything but a comment
    if not by_name or tag == "main" or not named_boilerplate(attributes):
        return False, False, False
    comments = named_boilerplate(attributes, COMMENTS - SUBJECTS)
    return comments, tag != "article" and not comments, not named_boilerplate(attributes, BOILERPLATE - SUBJECTS)


def parse(html: str, by_name: bool = True) -> tuple[Element, list[tuple[Element, str]]]:
    """The tree and the blocks of text that may belong to the article, in page order."""
    root = Element("#root", None, False)
    stack, blocks = [root], []
    text: list[str] = []
    in_links, link_size = 0, 0
    is_open: dict[str, list[int]] = defaultdict(list)  # places of open elements by tag

    def close_block() -> None:
        nonlocal link_size
        words = " ".join("".join(text).split())
        text.clear()
        if words and not holder().out:
            blocks.append((holder(), words))
            holder().size += len(words)
            holder().links += min(link_size, len(words))
            holder().prose += len(words) if len(words) >= PROSE and link_size < 0.25 * len(words) else 0
        link_size = 0

    def holder() -> Element:
        return stack[-1].block

    def pop_to(place: int) -> None:
        nonlocal in_links
        for e in stack[place:]:
            is_open[e.tag].pop()
        in_links = len(is_open["a"])
        del stack[place:]

    def say(raw: str) -> None:
        nonlocal link_size
        if raw:
            words = unescape(raw)
            text.append(words)
            if in_links:
                link_size += len(words.strip())

    at = 0
    while (hit := MARKUP.search(html, at)) is not None:
        say(html[at : hit.start()])
        at = hit.end()
        tag = (hit[2] or hit[5] or "").lower()
        if not tag:
            continue
        closing, raw = hit[1] or hit[4], hit[3] or hit[6] or ""
        if tag == "br":
            text.append(" ")
        elif closing:
            if tag not in INLINE:
                close_block()
            place = is_open[tag][-1] if is_open[tag] else 0
            if place and not (tag in INLINE and stack[-1].depth > stack[place].depth):
                pop_to(place)
        elif tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            if not raw.rstrip().endswith("/"):
                at = end.end() if end else len(html)
        else:
            if tag not in INLINE:
                close_block()
                if is_open["p"]:  # any block ends a paragraph
                    pop_to(is_open["p"][-1])
                scope = max((is_open[t][-1] for t in SCOPES.get(tag, ()) if is_open[t]), default=0)
                ended = [places[bisect(places, scope)] for places in (is_open[t] for t in CLOSES.get(tag, ()) if tag in SCOPES) if places and places[-1] > scope]
                if ended:
                    pop_to(min(ended))
            if tag not in VOID and not raw.rstrip().endswith("/"):
                out, named, subject = _judged(tag, raw, bool(is_open["article"] or is_open["main"]), by_name)
                is_open[tag].append(len(stack))
                stack.append(Element(tag, stack[-1], stack[-1].out or out, named, subject))
                if tag == "a":
                    in_links = len(is_open["a"])
                    holder().n_links += 1
    say(html[at:])
    close_block()
    return root, _without_named(root, blocks) if by_name else blocks


def _in_order(root: Element) -> list[Element]:
    order, todo = [], [root]
    while todo:
        element = todo.pop()
        order.append(element)
        todo += reversed(element.children)
    return order


def _within(order: list[Element], test: Callable[[Element], bool]) -> set[int]:
    """Elements that pass the test or lie in one that does; ``order`` has parents before children."""
    found: set[int] = set()
    for e in order:
        if (e.parent is not None and id(e.parent) in found) or test(e):
            found.add(id(e))
    return found


def _without_named(root: Element, blocks: list[tuple[Element, str]]) -> list[tuple[Element, str]]:
    """The blocks but those of named elements with many links, or little text that is not prose on a subject."""
    order = _in_order(root)
    if not any(e.named for e in order):
        return blocks
    totals = {id(e): [e.size, e.links, e.prose] for e in order}
    for e in reversed(order):
        if e.parent is not None:
            for i in (0, 1, 2):
                totals[id(e.parent)][i] += totals[id(e)][i]
    for e in order:
        size, links, prose = totals[id(e)]
        e.subject = e.named and e.subject and prose >= 0.5 * size
        small = size < NAMED_LARGE * totals[id(root)][0] and not e.subject
        e.out = e.out or (e.parent is not None and e.parent.out) or (e.named and (small or links >= 0.25 * size))
        if e.out:
            e.size = e.links = e.n_links = 0
    return [(e, words) for e, words in blocks if not e.out]


def _score(root: Element, blocks: list[tuple[Element, str]]) -> list[Element]:
    """Points for all elements; text and link sizes become those of whole subtrees. In page order."""
    order = _in_order(root)
    named = _within(order, lambda e: e.named)
    for element, words in blocks:
        points = 1 + sum(words.count(c) for c in ",;،、，") + min(len(words) / 100, 3) if len(words) >= 25 else 0.2
        points *= NAMED_POINTS if id(element) in named else 1
        up, level = element.parent if element.tag in PARAGRAPHS and element.parent else element, 0
        while up is not None and level < LEVELS:
            up.strength += points if level == 0 else 0
            up.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            up, level = up.parent, level + 1
    for element in reversed(order):
        if element.parent is not None:
            for name in ("size", "links", "n_links"):
                setattr(element.parent, name, getattr(element.parent, name) + getattr(element, name))
    for element in reversed(order):  # strength: the most that one element within earned by blocks of its own
        linkless = 1 - element.links / element.size if element.size else 0
        element.own = element.strength * linkless
        element.strength = max([element.own, *(e.strength for e in element.children)])
        if element.size and element.points:
            more = min(element.points, MARKED_MOST) if element.tag in ("article", "main") else 0
            element.points = (element.points + more + START.get(element.tag, 0)) * linkless
    return order


def _above(element: Element, tags: tuple[str, ...]) -> Element | None:
    """The innermost of the element and those around it with one of the tags."""
    while element is not None and element.tag not in tags:
        element = element.parent
    return element


def _title_holder(order: list[Element]) -> Element | None:
    """The article, else main element around the page's only h1."""
    titles = [e for e in order if e.tag == "h1" and e.size and not e.out and e.links < 0.5 * e.size]
    return (_above(titles[0], ("article",)) or _above(titles[0], ("main",))) if len(titles) == 1 else None


def _paragraphs_beside(order: list[Element], title: Element) -> int:
    """The most paragraphs of prose in one container outside the title's element."""
    inside = _within(order, lambda e: e is title)
    counts: Counter[int] = Counter(id(e.parent) for e in order if e.prose and e.tag in PARAGRAPHS and id(e) not in inside)
    return max(counts.values(), default=0)


def _kept(order: list[Element], texts: dict[int, str]) -> tuple[set[int], set[int]]:
    """The container with the siblings that belong to it, and article elements within that do not."""
    choices = [e for e in order if e.size and not e.out and e.tag not in PARAGRAPHS and e.tag not in INLINE and e.tag != "#root"]
    title = _title_holder(order)
    if title is not None:
        if _paragraphs_beside(order, title) >= RUN:
            title.points += min(max(title.points, 0), TITLE)
        else:  # nothing else reads like an article, only single blocks such as notices
            title.points += TITLE_ALONE
            around = _line(title)
            for element in choices:
                if element is title:
                    break
                if id(element) not in around:
                    element.points *= BEFORE_TITLE
    best = max(choices or [order[0]], key=lambda e: e.points)
    top = _above(best, ("article",)) or _above(best, ("main",)) or best
    teasers = _teasers(order, best, title, top)
    while top.parent is not None and top.parent.tag not in ("#root", "body", "html") and sum(1 for e in top.parent.children if e.size) == 1:
        top = top.parent
    if top.parent is None:
        return {id(top)}, teasers
    marked = _above(best, ("article", "main"))
    row = [e for e in top.parent.children if e.size and not e.out]
    at = next(i for i, e in enumerate(row) if e is top)
    found = {id(top)}
    for i, other in enumerate(row):
        if other is top or other.tag in HEADINGS or (other.named and id(other) in teasers):
            continue
        density = other.links / other.size
        words = texts.get(id(other), "")
        like = other.tag == "p" and (density < 0.25 if other.size > 80 else density == 0 and words[-1:] in tuple(".!?"))
        if other.tag == "article":
            like = id(other) not in teasers
        elif i < at and title is not None and title is marked:
            like = False  # it stands before the title
        elif marked is not None and not like:
            like = other.strength >= 10 and other.strength > top.strength  # more than what is marked as the article
        else:
            like = like or other.points >= max(10, 0.2 * best.points)
        if like:
            found.add(id(other))
    for i, other in enumerate(row):
        if other is not top and other.tag in HEADINGS and other.links < 0.25 * other.size:
            part = i + 1  # a heading goes with what follows it, up to one of its rank
            while part < len(row) and not (row[part].tag in HEADINGS and row[part].tag <= other.tag):
                if id(row[part]) in found:
                    found.add(id(other))
                part += 1
    return found, teasers


def _line(element: Element | None) -> set[int]:
    """The element and all around it."""
    out = set()
    while element is not None:
        out.add(id(element))
        element = element.parent
    return out


def _teasers(order: list[Element], best: Element, title: Element | None, top: Element) -> set[int]:
    """Outer article elements that earned little, or by links, and named ones beside the strongest part of the page."""
    core = max(reversed(order), key=lambda e: e.own)
    around = _line(core) | _line(best)
    linked = core.size and core.links >= 0.25 * core.size
    in_article = _above(core, ("article",)) is not None  # then articles without links may be short parts of it
    out = set()
    articles, in_core, in_top = (_within(order, test) for test in (lambda e: e.tag == "article", lambda e: e is core, lambda e: e is top))
    for e in order:
        beside = e.parent is None or id(e.parent) not in in_core
        if e.tag == "article" and e.size and e is not title and id(e) not in around and (e.parent is None or id(e.parent) not in articles) and beside:
            if (e.strength < 0.2 * core.own and (e.n_links or not in_article)) or (e.links >= 0.25 * e.size and not linked):
                out.add(id(e))
        # outside articles a named element has to hold the strongest part
        if e.named and e.size and id(e) not in around and id(e) not in articles and beside and not (e.subject and id(e) in in_top):
            out.add(id(e))
    return out


def _menus(order: list[Element], blocks: list[tuple[Element, str]], top: set[int]) -> set[int]:
    """Lists of links: most of their text, or within the chosen container nothing but short links that no sentence or heading leads to."""
    lists = {id(e): e for e in order if e.tag in ("ul", "ol") and e.n_links >= 2 and e.links >= 0.8 * e.size}
    before: dict[int, str] = {}
    words_in: dict[int, list[str]] = {}
    around: dict[int, Element | None] = {}  # the innermost list that an element lies in
    for e in order if lists else ():
        around[id(e)] = e if id(e) in lists else around.get(id(e.parent)) if e.parent is not None else None
    last, last_words = None, ""
    for element, words in blocks if lists else ():
        up, level = around[id(element)], 0
        while up is not None and level < LEVELS:
            if id(up) not in words_in:
                before[id(up)] = "" if last is None else last_words if last.tag not in HEADINGS | {"h4", "h5", "h6"} else "heading:"
            words_in.setdefault(id(up), []).append(words)
            up, level = around[id(up.parent)] if up.parent is not None else None, level + 1
        last, last_words = element, words
    chosen = _within(order, lambda e: id(e) in top and e.tag not in ("body", "html", "#root"))
    out = set()
    for key, e in lists.items():
        led = before.get(key, "")[-1:] in tuple(".:!?…;。：")
        inside = e.parent is not None and id(e.parent) in chosen
        if not inside or (e.links >= e.size and not led and all(len(x) <= SHORT_LINK for x in words_in.get(key, []))):
            out.add(key)
    return out


def main_text(html: str | None) -> str:
    """Blocks of the article, one white space between words, two line feeds between blocks."""
    if not html:
        return ""
    for by_name in (True, False):
        root, blocks = parse(html, by_name)
        if not blocks:
            continue
        order = _score(root, blocks)
        texts: dict[int, str] = {id(e): words for e, words in blocks}
        top, teasers = _kept(order, texts)
        menus = _menus(order, blocks, top)
        inside = _within(order, lambda e: id(e) in top)
        left_out = _within(order, lambda e: id(e) in teasers or id(e) in menus)
        out = [words for element, words in blocks if id(element) in inside and id(element) not in left_out]
        if out:
            return "\n\n".join(out)
    return ""


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars), one row per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    slim = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return slim.mapInArrow(run, "page_id long, url string, text string, n_chars long")
