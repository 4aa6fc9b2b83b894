"""A small forgiving HTML reader: a tree of elements, and the text of its blocks."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

#: A tag that another one begins in before its end is text, so no search runs over the next tag.
TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/<>]*+)((?:[\s/](?:"[^"]*"|'[^']*'|[^<>"'])*+)?)>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME = re.compile(r"[a-z0-9]+")

# Element names of HTML by what they do.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe textarea title svg".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p "
    "pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: A start tag closes an open element of these names, unless one of the limits lies between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

# Names that mark what is no part of an article.
SKIPPED = RAW | set("head nav footer aside form button select dialog menu object audio video".split())
MARKS = set(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies disqus footer masthead menu modal nav navbar "
    "navigation newsletter notice pagination popup promo related reply replies search share "
    "sidebar social sponsor sponsored subscribe toolbar widget".split()
)


class Element:
    """An element: its name, the names in its class, id and role, and its parts in order."""

    __slots__ = ("name", "marks", "parts")

    def __init__(self, name: str, marks: str = ""):
        self.name = name
        self.marks = marks
        self.parts: list[Element | str] = []

    def elements(self) -> list[Element]:
        return [part for part in self.parts if not isinstance(part, str)]


def marks_of(attributes: str) -> str:
    found = [a or b or c for _, a, b, c in ATTRIBUTE.findall(attributes)]
    return " ".join(" ".join(found).lower().split())


def close(
    stack: list[Element], open_names: Counter[str], names: set[str], limits: set[str]
) -> None:
    """Close the innermost open element of the names, if no limit is inside of it.

    ``open_names`` counts the elements on the stack, so that none is looked for in vain.
    """
    if not any(open_names[name] for name in names):
        return
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].name in names:
            open_names.subtract(element.name for element in stack[depth:])
            del stack[depth:]
            return
        if stack[depth].name in limits:
            return


def parse(html: str) -> Element:
    """The tree of a page. Text is kept as it stands; scripts and the like are empty."""
    root = Element("#page")
    stack = [root]
    open_names: Counter[str] = Counter()
    at = 0
    while True:
        found = TAG.search(html, at)
        if found is None:
            if at < len(html):
                stack[-1].parts.append(html[at:])
            return root
        if found.start() > at:
            stack[-1].parts.append(html[at : found.start()])
        at = found.end()
        name = found.group(2)
        if name is None:
            continue
        name = name.lower()
        if found.group(1):
            limits = set() if name in BLOCK else BLOCK
            close(stack, open_names, {name}, limits)
            continue
        if name in BLOCK:
            close(stack, open_names, {"p"}, {"table", "td", "th", "button", "object"})
        if name in CLOSES:
            close(stack, open_names, *CLOSES[name])
        element = Element(name, marks_of(found.group(3)) if found.group(3) else "")
        stack[-1].parts.append(element)
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif name not in VOID and not found.group(3).endswith("/"):
            stack.append(element)
            open_names[name] += 1


def is_skipped(element: Element, in_article: bool) -> bool:
    """Whether the element is a menu, an advert, a form, comments or the like."""
    if element.name in SKIPPED or (element.name == "header" and not in_article):
        return True
    if not element.marks or element.name in ("html", "body", "main"):
        return False
    if element.name == "article":
        # Articles often name their topics and tools; only a whole name makes one a comment.
        return not MARKS.isdisjoint(element.marks.split())
    return not MARKS.isdisjoint(NAME.findall(element.marks))


def squeezed(text: str) -> str:
    return " ".join(unescape(text).split())


def blocks(root: Element, skip: set[int], in_article: bool) -> list[str]:
    """The texts of the blocks below an element, in order, without skipped ones.

    ``skip`` has the ids of elements whose own text is left out. Walks with a list of its own, as
    pages can nest deeper than Python calls.
    """
    out: list[str] = []
    line: list[str] = []

    def finish() -> None:
        text = squeezed("".join(line))
        if text:
            out.append(text)
        line.clear()

    walk: list[tuple[Element, int, bool]] = [(root, 0, in_article)]
    while walk:
        element, at, inside = walk.pop()
        if at == 0 and element.name in BLOCK:
            finish()
        parts = element.parts
        while at < len(parts):
            part = parts[at]
            at += 1
            if isinstance(part, str):
                if id(element) not in skip:
                    line.append(part)
            elif part.name == "br":
                line.append("\n")
            elif part.name == "hr":
                finish()
            elif not is_skipped(part, inside):
                walk.append((element, at, inside))
                walk.append((part, 0, inside or part.name == "article"))
                break
        else:
            if element.name in BLOCK:
                finish()
    finish()
    return out
