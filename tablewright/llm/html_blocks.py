"""Leaf text blocks of an HTML page, in document order, with their tag paths.

A small tag scanner: start tags open elements, end tags close up to the matching
element, ``p``, ``li``, ``td`` and the like close themselves when the next one
starts, void elements never open. Comments, doctypes, scripts, styles and the
other raw-text elements give no text, nor do drawings and templates that are closed;
formulas, fallbacks of objects and whatever stands in an element that is never closed
are text like any other. A block ends wherever a block-level
element starts or ends; inline elements and ``br`` (white space) stay inside.
Character references are decoded, white space becomes one space.
"""

from __future__ import annotations

import html
import re

# Element names of the HTML standard by how they parse.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "iframe", "title", "textarea")
HIDDEN = ("svg", "template")  # left out as a whole, if they end
FOREIGN = frozenset(("svg", "math"))  # may close themselves
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
# Elements that the next one of a group closes, and the elements that search does not leave.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "option": (("option",), ("select",)),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<hidden>" + "|".join(HIDDEN) + r")\b(?:[^>\"'/]|/(?!>)|\"[^\"]*\"|'[^']*')*>.*?</(?P=hidden)\s*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
_MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)


def _labels(attrs: str) -> tuple[str, ...]:
    """Words of the class, id and role attributes."""
    if not attrs or "=" not in attrs:
        return ()
    found = []
    for groups in _MARKED.findall(attrs):
        found += re.split(r"[^a-z0-9]+", "".join(groups).lower())
    return tuple(w for w in found if w)


class Leaf:
    """A text block: ``path`` of (tag, labels) from the root, ``text`` and characters inside links."""

    __slots__ = ("path", "text", "linked")

    def __init__(self, path, text, linked):
        self.path, self.text, self.linked = path, text, linked


def leaves(page: str) -> list[Leaf]:
    """The non-empty leaf blocks of a page."""
    out: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, links = 0, 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Leaf(tuple(stack), text, min(linked, len(text))))
            parts, linked = [], 0

    def pop_to(i: int) -> None:
        nonlocal links
        links -= sum(1 for t, _ in stack[i:] if t == "a")
        del stack[i:]

    def close_group(names, walls) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in walls:
                return
            if stack[i][0] in names:
                pop_to(i)
                return

    for m in _TOKEN.finditer(page):
        text = m.group("text")
        if text is not None:
            if "&" in text:
                text = html.unescape(text)
            parts.append(text)
            if links:
                linked += len(text.strip())
            continue
        name = m.group("name")
        if name is None:
            continue  # comment, doctype, raw text or a hidden element
        name = name.lower()
        block = name in BLOCK
        if block:
            flush()
        elif name == "br":
            parts.append(" ")
        if m.group("end"):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    pop_to(i)
                    break
                if not block and stack[i][0] in BLOCK:
                    break  # an inline end tag never closes a block
            continue
        if name in VOID or (name in FOREIGN and m.group("attrs").endswith("/")):
            continue
        if block:
            close_group(("p",), ("table", "button", "td", "th"))
        if name in CLOSES:
            close_group(*CLOSES[name])
        stack.append((name, _labels(m.group("attrs"))))
        if name == "a":
            links += 1
    flush()
    return out
