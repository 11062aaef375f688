"""Leaf blocks of an HTML page: its runs of inline text, with what is known of the elements around them.

Tags are read one after the other with the rules that matter for text: elements that end an open
paragraph, list item or cell; elements without content; raw text of scripts and the like, which is no
text of the page; objects, lists to choose from, drawings and templates, which are none up to their end tag,
or, without one, up to the end of the element around them or the next block; end tags without a start, which
are ignored. A head without an end tag and without a body ends at the first text or block. Character references are decoded, and white
space inside a block becomes one space.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol option p pre search"
    " section summary table tbody td tfoot th thead tr ul".split()
)
RAW = "script style textarea title noscript iframe"
APART = frozenset("object select svg template".split())
ENDS_PARAGRAPH = BLOCK - frozenset("body html button caption dd dt label legend li option tbody td tfoot th thead tr summary".split())
ENDS_SAME = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "tr": ("tr", "table"), "option": ("option", "select"), "tbody": ("tbody thead tfoot", "table"), "tfoot": ("tbody thead tfoot", "table"),
}

_RAW = "|".join(RAW.split())
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
    r"|<[!?/][^>]*>?",
    re.DOTALL | re.IGNORECASE,
)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
_PART = re.compile(r"[a-z]+")
_ENDS = re.compile(r"<(?:object|select|svg|template|head)\b", re.IGNORECASE)
_CACHED = 20_000


class Block(NamedTuple):
    text: str
    tag: str
    around: tuple[str, ...]
    linked: int  # characters inside links
    parent: str


def _marks(name: str, rest: str) -> tuple[str, ...]:
    """Features of an element for the blocks inside: its name, and the words of class, id and role."""
    out = [f"in:{name}"]
    for value in _NAMED.findall(rest):
        out += [f"is:{w}" for w in _PART.findall(html.unescape(value).lower())]
    return tuple(dict.fromkeys(out))


class _Page:
    def __init__(self):
        self.blocks: list[Block] = []
        self._stack: list[tuple[str, tuple[str, ...]]] = []
        self._open: dict[str, int] = {}
        self._around: dict[str, int] = {}
        self._texts: list[str] = []
        self._linked = 0
        self._where: tuple | None = None
        self._known: dict[tuple[str, str], tuple[str, ...]] = {}
        self.head_ends = True  # by its own end tag, or by the start of the body

    def push(self, name: str, rest: str) -> None:
        marks = self._known.get((name, rest))
        if marks is None:
            marks = _marks(name, rest)
            if len(self._known) < _CACHED:
                self._known[name, rest] = marks
        self._stack.append((name, marks))
        self._open[name] = self._open.get(name, 0) + 1
        for m in marks:
            self._around[m] = self._around.get(m, 0) + 1

    def pop(self) -> str:
        name, marks = self._stack.pop()
        self._open[name] -= 1
        for m in marks:
            if self._around[m] == 1:
                del self._around[m]
            else:
                self._around[m] -= 1
        return name

    def close(self, names: str, within: str = "") -> None:
        """End the innermost open element of these names, unless one of `within` is nearer."""
        if not any(self._open.get(n) for n in names.split()):
            return
        if within:
            for name, _ in reversed(self._stack):
                if name in names.split():
                    break
                if name in within.split():
                    return
        while self._stack and self.pop() not in names.split():
            pass

    def text(self, raw: str) -> None:
        if self._open.get("head"):
            if self.head_ends or raw.isspace():
                return
            self.close("head")
        if any(self._open.get(n) for n in APART):
            return
        if self._where is None:
            if raw.isspace():
                return
            names = [n for n, _ in self._stack if n in BLOCK]
            self._where = (names[-1] if names else "", tuple(self._around), names[-2] if len(names) > 1 else "")
        self._texts.append(raw)
        if self._open.get("a"):
            self._linked += len(raw.strip())

    def flush(self) -> None:
        if self._where is not None:
            text = " ".join(html.unescape("".join(self._texts)).split())
            if text:
                tag, around, parent = self._where
                self.blocks.append(Block(text, tag, around, self._linked, parent))
        self._texts, self._linked, self._where = [], 0, None

    def start(self, name: str, rest: str) -> None:
        if name in BLOCK:
            self.flush()
            if name not in ("option", "legend"):
                for n in APART:
                    self.close(n)
        if name == "body" or (name in BLOCK and name != "html" and not self.head_ends):
            self.close("head")
        if name in ENDS_PARAGRAPH and self._open.get("p"):
            self.close("p", "button table")
        if name in ENDS_SAME:
            self.close(*ENDS_SAME[name])
        if name in VOID:
            self._texts.append(" ")
        elif not rest.endswith("/"):
            self.push(name, rest)
        if name in APART:
            self._texts.append(" ")

    def end(self, name: str) -> None:
        if name in BLOCK or name == "head":
            self.flush()
        self.close(name)


def _ends(page: str) -> tuple[dict[int, int], bool]:
    """Where the elements of APART end that have an end tag, by their start; and whether a head is ended."""
    ends, opened, head_ends = {}, {n: [] for n in APART}, False
    for m in _TAG.finditer(page):
        name = (m["name"] or "").lower()
        if name in APART:
            if not m["end"]:
                if name != "svg" or not m["rest"].endswith("/"):
                    opened[name].append(m.start())
            elif opened[name]:
                ends[opened[name].pop()] = m.end()
        elif name == ("head" if m["end"] else "body"):
            head_ends = True
    return ends, head_ends


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page, in order."""
    page = page or ""
    state, at = _Page(), 0
    ends, state.head_ends = _ends(page) if _ENDS.search(page) else ({}, True)
    for m in _TAG.finditer(page):
        if m.start() < at:
            continue  # inside an element without text
        if m.start() > at:
            state.text(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if m.start() in ends:
            state._texts.append(" ")
            at = ends[m.start()]
        elif name:
            if m["end"]:
                state.end(name.lower())
            else:
                state.start(name.lower(), m["rest"])
        elif m["raw"]:
            state._texts.append(" ")
    if at < len(page):
        state.text(page[at:])
    state.flush()
    return state.blocks
