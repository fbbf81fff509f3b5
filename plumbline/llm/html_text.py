"""Main text of web pages by tree scoring.

A page becomes a tree of elements. Every paragraph-like block gives points for its
length and commas to its parent and, less, to its further ancestors; a container's
points are discounted by the share of its text that is in links. The best container is
kept, with whatever beside it, or beside what holds it, scores well or reads like
paragraphs; beside an ``<article>`` outside ``<main>`` only what scores well or is an
article too.

Furniture gives no points and is left out. It is told by element (navigation, asides,
footers; a header outside articles; a form that does not hold the page), by names that
are whole class tokens, ids or roles, and, for names that an article's own section may
bear (discussion, legal, related), only where links, brevity or the repeated structure
of a thread agree. Outside articles, unnamed boxes are left out if their headings are
links to other stories, if they are short notices, or if they are threads.

One page is one row and never leaves its task. The page is read once, from left to
right, and every step of the tree takes constant time, so the work is linear in the page.
An attribute's quote that is never closed ends the page, as HTML says.
"""

from __future__ import annotations

import html
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plumbline.llm.common import map_rows

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody "
    "td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - {"body", "html", "option", "legend", "tbody", "td", "tfoot", "th", "thead", "tr"}
IN_HEAD = frozenset("base link meta noscript script style template title".split())
NEVER_TEXT = RAW | frozenset("head button select option input label legend object canvas audio video map".split())
FURNITURE = frozenset("nav header footer aside form fieldset menu dialog search".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"))
# an item ends the open item of its kind in the same list or table: items, what bounds them
KINDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
ENDS = {"li": "li", "dt": "dd", "dd": "dd", "tr": "tr", "td": "td", "th": "td", "option": "option"}
# words that make a class token, an id or a role a name of furniture, if all its other
# words are of these lists, too
STRONG = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted "
    "nav navbar navigation menubar topbar toolbar breadcrumb breadcrumbs sidebar header masthead footer copyright "
    "cookie cookies consent gdpr popup modal overlay newsletter subscribe signup login paywall "
    "comment comments commentlist disqus replies respond share sharing recommended recommendations trending teaser teasers "
    "pagination pager complementary contentinfo dialog alertdialog".split()
)
# names that a section of an article may bear as well
WEAK = frozenset(
    "menu legal notice notices alert banner subscription promotion reply discussion feedback response responses thread threads "
    "social related popular side rail aside foot form search skip widget widgets".split()
)
ALWAYS_SHORT = frozenset("notice notices alert banner subscription promotion skip form search".split())
FILLERS = frozenset(
    "area article bar block body bottom box button buttons card center col column container content dfp div entry global google gpt "
    "group holder inner item items label left link links list main message more outer page panel policy post posts primary right "
    "section secondary site slot sticky stories story text top unit user wrap wrapper".split()
)
CONTENT_NAMES = frozenset("article content entry main post story text".split())
SPACE = re.compile(r"[\s/]*")
TAG_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
ATTRIBUTE_NAME = re.compile(r"=?[^\s/>=]*")
EQUALS = re.compile(r"\s*=\s*")
UNQUOTED = re.compile(r"[^\s>]+")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none(?![\w-])", re.I)
HIDDEN_CLASSES = frozenset("hidden is-hidden visually-hidden".split())
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SENTENCE_END = re.compile(r"""[.!?…。！？｡؟۔।።][\s"'”’»)\]」』]*$""")
NOTICE = re.compile(
    r"\b(?:(?:uses?|accept|necessary|our|of) (?:\w+ )?cookies|cookie (?:policy|settings)|privacy policy|all rights reserved|"
    r"(?:sign up|subscribe) (?:to|for) (?:our|the)|verwende\w* (?:\w+ )?cookies|utilis\w* (?:des |\w+ )?cookies|utiliza\w* cookies)\b",
    re.I,
)
PARAGRAPH_CHARS = 80  # a block of so many reads as a paragraph without a sentence end, too
SHORT_CHARS = 240  # a box with a name that a section may bear is furniture below this, outside articles
NOTICE_CHARS = 400
STRONG_NAME, WEAK_NAME, SHORT_NAME = "strong", "weak", "short"


class Node:
    """An element, with what a step of the parser needs of its ancestors."""

    __slots__ = (
        "tag", "parent", "order", "block", "open_p", "items", "inline", "never", "name", "kind", "children",
        "points", "chars", "link_chars", "prose", "paragraphs", "shorts", "headings", "linked_headings", "notices", "holds", "out", "article",
    )

    def __init__(self, tag: str, parent: Node | None, order: int) -> None:
        self.tag, self.parent, self.order = tag, parent, order
        self.name: str | None = None
        self.kind = ""
        self.inline: dict[str, int] = {}
        if parent is None:
            self.block, self.open_p, self.items, self.never = self, None, {}, False
            return
        self.never = parent.never
        self.block = self if tag in BLOCKS else parent.block
        self.open_p = self if tag == "p" else None if tag in ("td", "th", "button", "object") else parent.open_p
        self.items = parent.items
        for kind, (same, bounds) in KINDS.items() if tag in BLOCKS or tag == "select" else ():
            if tag in bounds and kind in self.items:
                self.items = {k: v for k, v in self.items.items() if k != kind}
            if tag in same and kind not in self.items:
                self.items = {**self.items, kind: self}

    def clear(self) -> None:
        self.children: list[Node] = []
        self.points = 0.0
        self.chars = self.link_chars = self.prose = self.paragraphs = self.shorts = 0
        self.headings = self.linked_headings = self.notices = 0
        self.holds: frozenset[str] = frozenset()


class Block:
    __slots__ = ("node", "text", "links")

    def __init__(self, node: Node, text: str, links: int) -> None:
        self.node, self.text, self.links = node, text, links

    def is_paragraph(self) -> bool:
        """Whether it reads as one: no heading, mostly outside links, and a sentence or long."""
        if self.node.tag in HEADINGS or self.links > len(self.text) / 2:
            return False
        return len(self.text) >= PARAGRAPH_CHARS or bool(SENTENCE_END.search(self.text))


def read_attributes(page: str, at: int) -> tuple[dict[str, str] | None, int]:
    """The attributes of a tag from ``at`` and the place after it; None if the page ends inside it.

    Of repeated names the first counts, as in HTML.
    """
    found: dict[str, str] = {}
    end = len(page)
    while True:
        at = SPACE.match(page, at).end()
        if at >= end:
            return None, end
        if page[at] == ">":
            return found, at + 1
        name = ATTRIBUTE_NAME.match(page, at)
        at, value = name.end(), ""
        equals = EQUALS.match(page, at)
        if equals:
            at = equals.end()
            if at < end and page[at] in "\"'":
                closing = page.find(page[at], at + 1)
                if closing < 0:
                    return None, end
                value, at = page[at + 1 : closing], closing + 1
            elif at < end and page[at] != ">":
                unquoted = UNQUOTED.match(page, at)
                value, at = unquoted[0], unquoted.end()
        key = name[0].lower()
        if key not in found:
            found[key] = html.unescape(value) if "&" in value else value


def is_hidden(attributes: dict[str, str]) -> bool:
    """Whether an element is not shown: by an attribute of its own, by style or by the plain class."""
    if "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true":
        return True
    return bool(NO_DISPLAY.search(attributes.get("style", "")))


def has_hidden_class(attributes: dict[str, str]) -> bool:
    classes = attributes.get("class", "").split()
    return not HIDDEN_CLASSES.isdisjoint(classes) and not any(":" in c for c in classes)  # md:block shows it again


def name_of(attributes: dict[str, str]) -> str | None:
    """What the class tokens, id and role of an element say: certainly furniture, perhaps, or nothing."""
    found = None
    for token in " ".join(attributes.get(a, "") for a in ("class", "id", "role")).split():
        words = {w.lower() for w in PART.findall(token)}
        if not words <= STRONG | WEAK | FILLERS:
            continue
        strong, weak = words & STRONG, words & WEAK
        if strong == {"header"} and words & CONTENT_NAMES:
            continue  # the head of the article
        if strong:
            return "header" if strong == {"header"} else STRONG_NAME
        if weak:
            found = SHORT_NAME if weak & ALWAYS_SHORT else found or WEAK_NAME
    return found


def parse(page: str) -> list[Block]:
    """The text blocks of a page in order, in their tree; broken markup is closed where HTML would."""
    root = node = Node("#root", None, 0)
    order = 0
    blocks: list[Block] = []
    parts: list[str] = []
    links = 0
    in_link = False
    open_tags: Counter[str] = Counter()

    def text(raw: str) -> None:
        nonlocal links
        if raw and not node.never:
            raw = html.unescape(raw) if "&" in raw else raw
            parts.append(raw)
            if in_link:
                links += len(raw)

    def flush() -> None:
        nonlocal links
        if parts:
            whole = " ".join("".join(parts).split())
            if whole:
                blocks.append(Block(node.block, whole, min(links, len(whole))))
            parts.clear()
        links = 0

    def closed(to: Node) -> None:
        nonlocal node, in_link
        while node is not to:
            if node.tag in BLOCKS:
                open_tags[node.tag] -= 1
            else:
                node.block.inline[node.tag] -= 1
                if node.tag == "a":
                    in_link = False
            node = node.parent

    at, end = 0, len(page)
    while at < end:
        start = page.find("<", at)
        if start < 0:
            text(page[at:])
            break
        if start > at:
            text(page[at:start])
        tag_name = TAG_NAME.match(page, start)
        if not tag_name:
            sign = page[start + 1 : start + 2]
            if sign in ("!", "?", "/") and sign:
                opening, closing = next(
                    ((o, c) for o, c in (("<!--", "-->"), ("<![CDATA[", "]]>")) if page.startswith(o, start)), (page[start : start + 2], ">")
                )
                found = page.find(closing, start + len(opening))
                at = end if found < 0 else found + len(closing)
            else:
                text("<")
                at = start + 1
            continue
        tag = tag_name[2].lower()
        at = tag_name.end()
        if page.startswith(">", at):
            attributes: dict[str, str] | None = {}
            at += 1
        else:
            attributes, at = read_attributes(page, at)
            if attributes is None:
                break
        block = tag in BLOCKS
        if tag_name[1]:
            if tag == "a":
                in_link = False
            if (open_tags[tag] if block else node.block.inline.get(tag, 0)) > 0:
                if block:
                    flush()
                up = node
                while up.tag != tag:
                    up = up.parent
                closed(up.parent)
            elif tag in ("p", "br"):
                flush() if tag == "p" else text(" ")
            continue
        if tag in ("br", "wbr"):
            text(" " if tag == "br" else "")
            continue
        if block:
            flush()
        if node.tag == "head" and tag not in IN_HEAD:
            closed(node.parent)
        if tag in CLOSES_P and node.open_p is not None:
            closed(node.open_p.parent)
        if tag in ENDS and ENDS[tag] in node.items:
            closed(node.items[ENDS[tag]].parent)
        if tag == "html" and node is not root or tag == "body" and open_tags["body"] > 0:
            continue
        if tag in VOID:
            continue
        never = tag in NEVER_TEXT or is_hidden(attributes) or tag not in ("article", "main", "body", "html") and has_hidden_class(attributes)
        if tag in RAW:
            if tag in ("svg", "math") and page[at - 2] == "/":
                continue
            ending = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
            at = ending.end() if ending else end
            continue
        name = name_of(attributes) if attributes and tag not in ("main", "body", "html") else None
        if not block:
            never = never or name == STRONG_NAME and node.block.tag != "pre"
            if tag == "a":
                in_link = True
            elif not never and tag != "object" and not node.block.inline.get(tag):
                continue  # an inline element that changes nothing needs no place in the tree
            node.block.inline[tag] = node.block.inline.get(tag, 0) + 1
        else:
            open_tags[tag] += 1
        order += 1
        node = Node(tag, node, order)
        node.never = node.never or never
        node.name, node.kind = name, attributes.get("class", "")
    flush()
    return blocks


def measure(blocks: list[Block]) -> list[Node]:
    """The elements that hold text, parents first, with sums over their blocks."""
    touched: dict[int, Node] = {}
    for block in blocks:
        above = block.node
        while above is not None and above.order not in touched:
            above.clear()
            touched[above.order] = above
            above = above.parent
        node, n = block.node, len(block.text)
        node.chars += n
        node.link_chars += block.links
        if block.node.tag in HEADINGS:
            node.headings += 1
            node.linked_headings += block.links > n / 2
        elif block.is_paragraph():
            node.paragraphs += 1
            node.prose += n
            node.notices += n < NOTICE_CHARS and bool(NOTICE.search(block.text))
        else:
            node.shorts += 1
    nodes = [touched[i] for i in sorted(touched)]
    for node in reversed(nodes):
        up = node.parent
        if node.tag in ("article", "main", "h1"):
            node.holds |= {node.tag}
        if up is not None:
            for field in ("chars", "link_chars", "prose", "paragraphs", "shorts", "headings", "linked_headings", "notices"):
                setattr(up, field, getattr(up, field) + getattr(node, field))
            up.holds |= node.holds
    for node in nodes:
        if node.parent is not None:
            node.parent.children.append(node)
    return nodes


def is_thread(node: Node) -> bool:
    """Two or more parts of one kind, each with paragraphs after a short line such as an author's name."""
    kinds = Counter((c.tag, c.kind) for c in node.children if c.paragraphs and c.shorts and not c.headings and c.tag in ("li", "div", "article", "section"))
    return bool(kinds) and max(kinds.values()) >= 2


def mark_furniture(nodes: list[Node]) -> None:
    """Sets ``out`` and ``article`` of every element, parents first."""
    all_chars, all_prose = nodes[0].chars, nodes[0].prose
    for node in nodes:
        up = node.parent
        node.article = up is not None and (up.article or up.tag == "article")
        inside = node.article or up is not None and up.tag == "main"
        node.out = up is not None and (up.out or _is_furniture(node, inside, all_chars, all_prose))


def _is_furniture(node: Node, inside: bool, all_chars: int, all_prose: int) -> bool:
    tag, name = node.tag, node.name
    many_links = node.link_chars > node.chars / 2
    if tag in ("form", "fieldset"):
        # around the page it is a wrapper
        return not (node.holds or node.prose * 2 > all_prose)
    if "main" in node.holds:
        return False
    if tag == "header" or name == "header":
        return not inside or many_links
    if tag == "footer":
        return node.parent.tag != "blockquote"
    if tag in FURNITURE or name == STRONG_NAME:
        return True
    if name is not None:
        if many_links or is_thread(node):
            return True
        if node.chars < SHORT_CHARS and (name == SHORT_NAME and not node.headings or not node.article) and node.chars * 2 < all_chars:
            return True
    if node.article or node.chars * 4 > all_chars or node.holds & {"main", "h1"} or tag not in ("article", "div", "section", "ul", "ol"):
        return False
    teaser = node.headings > 0 and node.linked_headings == node.headings
    notice = node.notices > 0 and node.notices == node.paragraphs and node.chars < NOTICE_CHARS
    return teaser or notice or tag != "article" and is_thread(node)


def score(blocks: list[Block]) -> None:
    """Points of paragraphs to their containers: length and commas, less to further ancestors."""
    for block in blocks:
        n = len(block.text)
        if block.links > n / 2 or block.node.tag in HEADINGS:
            continue  # headings and lists of links do not make a container an article
        gain = 1 + block.text.count(",") + min(n / 100, 20.0)
        up = block.node.parent if block.node.tag in ("p", "pre", "li", "td", "blockquote", "dd") else block.node
        if up is None or up.parent is None:
            up = block.node
        share, depth = 1.0, 0
        while up is not None and depth < 6:
            up.points += gain * share
            depth += 1
            share = 0.5 if depth == 1 else 1.0 / (depth * 3)
            up = up.parent


def worth(node: Node) -> float:
    """Points discounted by link density."""
    bonus = 1.25 if node.tag in ("article", "main") else 1.0
    return node.points * bonus * (1 - node.link_chars / node.chars if node.chars else 0.0)


def main_blocks(page: str | None) -> list[str]:
    """The blocks of the article, in page order."""
    blocks = parse(page or "")
    if not blocks:
        return []
    mark_furniture(measure(blocks))
    blocks = [b for b in blocks if not b.node.out]
    if not blocks:
        return []
    nodes = measure(blocks)
    score(blocks)
    best = max(nodes, key=lambda x: (worth(x), -x.order))
    # a lone section of an article is part of it
    up = best
    while up is not None:
        if up.tag in ("article", "main"):
            best = up
            break
        up = up.parent
    outer = best.parent
    while outer is not None and outer.tag != "main":
        outer = outer.parent
    # where the article is not marked, its parts may be anywhere around the best container;
    # beside an <article>, look as far as the <main> around it, or at its next siblings alone
    alone = best.tag == "article" and outer is None
    chosen, around, inner = {best.order}, set(), best
    while inner.parent is not None and inner.tag not in ("body", "html", "main"):
        if not alone:
            around.add(inner.parent.order)
        for sibling in inner.parent.children:
            if sibling.order == inner.order:
                continue
            clean = 1 - sibling.link_chars / sibling.chars >= 0.5
            reads = sibling.paragraphs or sibling.tag in ("p", "blockquote", "pre", *HEADINGS)
            if clean and reads and (not alone or sibling.tag == "article") or inner is best and worth(sibling) >= max(3.0, 0.2 * worth(best)):
                chosen.add(sibling.order)
        inner = inner.parent
        if alone:
            break

    kept: dict[int, bool] = {}
    for node in nodes:
        kept[node.order] = node.order in chosen or node.parent is not None and kept[node.parent.order]
    return [b.text for b in blocks if kept[b.node.order] or b.node.order in around and b.is_paragraph()]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text, n_chars`` per page.

    ``text``: the article's blocks, white space inside a block as one space, joined by
    one line end; empty for null or empty html and for pages without article text.
    Repeated rows are extracted one by one.
    """
    schema = T.StructType(
        [pages.schema[id_col], pages.schema[url_col], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def step(ids, urls, texts):
        found = ["\n".join(main_blocks(t)) for t in texts]
        return ids, urls, found, [len(f) for f in found]

    return map_rows(pages, [id_col, url_col, html_col], step, schema)
