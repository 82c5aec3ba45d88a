"""Per-page helper: one scan over the markup of a page, then first or all matches in it.

The scan is one regular expression over the tags.  It fills plain lists in document order:
per element its tag, its unparsed attributes, its parent and the ranges of its subtree in
elements and text nodes.  Attributes are parsed only for elements that a match looks at.
Markup errors are handled as a lenient reader does: an end tag closes up to its nearest
open partner, and is ignored without one; a ``<`` that opens no tag is text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from html import unescape
from html.entities import html5

# The void elements of the HTML standard and of its earlier versions, elements
# whose content is no markup, and elements whose content is no text.
VOID = frozenset({
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image", "img", "input",
    "isindex", "keygen", "link", "menuitem", "meta", "nextid", "param", "source", "spacer", "track", "wbr",
})
RAW = frozenset({"script", "style"})
NO_TEXT = RAW | {"template"}

_TAG = re.compile(
    r"""<(?:
        ([a-zA-Z][^\s/>]*)                               # start tag with its attributes
        ((?:[^>"'=]+|=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*)?|["'])*+)>
      | /([a-zA-Z][^\s/>]*)[^>]*>                        # end tag
      | !--(?:>|->|.*?(?:--!?>|\Z))                      # comment
      | [!?/][^>]*>                                      # declaration and the like
    )""",
    re.X | re.S,
)
_START = "[\"'])*+)>"
# The same, with a start tag the text and the end tag of an element that holds nothing else.
_ELEMENT = re.compile(_TAG.pattern.replace(_START, _START + r"(?:([^<]*+)</\1>)?"), re.X | re.S)
_ATTR = re.compile(r"""([^\s/=>]+)(?:\s*=+\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)|))?""")
_VALUE_WITH_SLASH = re.compile(r"""=\s*[^\s>"'][^\s>]*/\Z""")
_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|([a-zA-Z][a-zA-Z0-9]*)(;?)(=?))")


def raw_end(tag: str) -> re.Pattern:
    """What ends the content of an element that is no markup."""
    return re.compile(rf"</{tag}(?=[\s/>])", re.I)


_RAW_END = {tag: raw_end(tag) for tag in RAW}


_DIGITS = re.compile(r"&#([0-9]{8,})(;?)")


def decoded(text: str) -> str:
    """A text with its character references read, however many digits a number has."""
    if "&" not in text:
        return text

    def short(m: re.Match) -> str:
        digits = m[1].lstrip("0")
        return "\ufffd" if len(digits) > 7 else f"&#{digits or 0}{m[2]}"

    return unescape(_DIGITS.sub(short, text) if "&#" in text else text)


def unescape_attribute(value: str) -> str:
    """References of an attribute.  A name without its semicolon before ``=`` or more letters
    is part of an address, as in ``?a=1&copy=2``, and stays."""

    def one(m: re.Match) -> str:
        name, end, equals = m.groups()
        if name and not end and (equals or name not in html5):
            return m[0]
        return decoded(m[0])

    return _REFERENCE.sub(one, value) if "&" in value else value


def events(html: str, raw: dict[str, re.Pattern] = _RAW_END) -> Iterator[tuple[str, str, str]]:
    """``("text", text, "")``, ``("start", tag, attributes)`` and ``("end", tag, "")`` in page order.

    The content of ``raw`` elements is passed over.  A tag that closes itself, or a void one, gives
    ``"void"`` instead of a start, and has no end.  Linear in the page, whatever is left open in it.
    """
    at, last = 0, html.rfind(">") + 1
    found = _TAG.search(html, 0, last)
    while found:
        start = found.start()
        if start > at:
            yield "text", html[at:start], ""
        at = found.end()
        tag, attrs, closing = found.groups()
        if tag:
            tag = tag.lower()
            alone = tag in VOID or bool(attrs and attrs[-1] == "/" and not _VALUE_WITH_SLASH.search(attrs))
            yield "void" if alone else "start", tag, attrs
            if tag in raw and not alone:
                close = raw[tag].search(html, at)
                at = close.start() if close else len(html)
        elif closing:
            yield "end", closing.lower(), ""
        elif html.startswith("<!--", start) and not html.endswith(("-->", "--!>"), start + 2, at):
            at = len(html)
        found = _TAG.search(html, at, last)
    if at < len(html):
        yield "text", html[at:], ""


def attributes(raw: str) -> dict[str, str]:
    """The attributes of a tag by name; of repeated ones the last."""
    found = _ATTR.findall(raw)
    if "&" in raw:
        return {name.lower(): unescape_attribute(double or single or bare) for name, double, single, bare in found}
    return {name.lower(): double or single or bare for name, double, single, bare in found}


# Attributes read before.  Templates write the same classes in tag after tag, so a few short ones spare
# most of the work; the number is bounded, and long ones are not kept.
_KNOWN: dict[str, dict[str, str]] = {}
_MOST_KNOWN, _LONGEST_KNOWN = 1024, 200


def attributes_once(raw: str) -> dict[str, str]:
    known = _KNOWN.get(raw)
    if known is None:
        known = attributes(raw)
        if len(raw) <= _LONGEST_KNOWN:
            if len(_KNOWN) >= _MOST_KNOWN:
                _KNOWN.clear()
            _KNOWN[raw] = known
    return known


class Page:
    """``until`` ends the scan where the first element that it matches ends."""

    def __init__(self, html: str, until: Match | None = None):
        self._until = until
        self.tags: list[str] = []
        self.raw_attrs: list[str] = []
        self.parents: list[int] = []
        self.ends: list[int] = []
        self.text_from: list[int] = []
        self.text_to: list[int] = []
        self.texts: list[str] = []
        self.by_tag: dict[str, list[int]] = {}
        self._attrs: dict[int, dict[str, str]] = {}
        self._scan(html)

    def __len__(self):
        return len(self.tags)

    def _scan(self, html: str) -> None:
        tags, raw_attrs, parents, ends = self.tags, self.raw_attrs, self.parents, self.ends
        text_from, text_to, texts, by_tag = self.text_from, self.text_to, self.texts, self.by_tag
        until, goal = self._until, None
        looking = until is not None
        open_, parent, open_count = [], -1, {}
        push, pop, add_tag, add_attrs, add_parent = open_.append, open_.pop, tags.append, raw_attrs.append, parents.append
        add_end, add_from, add_to = ends.append, text_from.append, text_to.append
        at, hidden = 0, 0
        last = html.rfind(">") + 1  # beyond it no tag can end
        again = True
        while again:  # once, and once more where what follows a start tag has to be read in another way
            again = False
            for found in _ELEMENT.finditer(html, at, last):
                start, end = found.span()
                if start > at and not hidden:
                    texts.append(html[at:start])
                at = end
                tag, attrs, leaf, closing = found.groups()
                if tag:
                    tag = tag.lower()
                    i, text = len(parents), len(texts)
                    add_tag(tag)
                    add_attrs(attrs)
                    add_parent(parent)
                    add_end(i + 1)
                    add_from(text)
                    add_to(text)
                    same = by_tag.get(tag)
                    if same is None:
                        same = by_tag[tag] = []
                        open_count[tag] = 0
                    same.append(i)
                    if looking and until.accepts(self, i):
                        goal, looking = i, False
                    if tag in VOID or attrs and attrs[-1] == "/" and not _VALUE_WITH_SLASH.search(attrs):
                        if leaf is not None:  # its end tag, if it is one, ends something else
                            at, again = found.start(3), True
                            break
                    elif leaf is not None:
                        if leaf and not hidden and tag not in NO_TEXT:
                            texts.append(leaf)
                            text_to[i] = text + 1
                        if i == goal:
                            return
                    else:
                        push(i)
                        open_count[tag] += 1
                        parent = i
                        if tag in NO_TEXT:
                            hidden += 1
                            if tag in RAW:
                                close = _RAW_END[tag].search(html, at)
                                at = close.start() if close else len(html)
                                again = True
                                break
                elif closing:
                    tag = closing.lower()
                    if open_count.get(tag):
                        closed, stop, seen = None, len(parents), len(texts)
                        while closed != tag:
                            inner = pop()
                            ends[inner], text_to[inner] = stop, seen
                            closed = tags[inner]
                            open_count[closed] -= 1
                            if hidden and closed in NO_TEXT:
                                hidden -= 1
                            if inner == goal:
                                return
                        parent = open_[-1] if open_ else -1
                elif html.startswith("<!--", start) and not html.endswith(("-->", "--!>"), start + 2, at):
                    at = len(html)  # a comment without an end
                    break
        if at < len(html) and not hidden:
            texts.append(html[at:])
        for i in open_:
            ends[i], text_to[i] = len(tags), len(texts)

    def attrs(self, i: int) -> dict[str, str]:
        known = self._attrs.get(i)
        if known is None:
            known = self._attrs[i] = attributes_once(self.raw_attrs[i])
        return known

    def inside(self, i: int) -> range:
        return range(i + 1, self.ends[i])

    def text(self, i: int, strip: bool = True) -> str:
        return self._read(self.texts[self.text_from[i] : self.text_to[i]], strip)

    def whole_text(self) -> str:
        """Each text node trimmed, nodes joined without a gap."""
        return self._read(self.texts, True)

    @staticmethod
    def _read(nodes: list[str], strip: bool) -> str:
        if len(nodes) == 1:
            node = decoded(nodes[0])
            return node.strip() if strip else node
        nodes = [decoded(n) if "&" in n else n for n in nodes]
        return "".join([n.strip() for n in nodes]) if strip else "".join(nodes)

    def first(self, path: tuple[Match, ...], scope: range, root: int = -1) -> int | None:
        """The first element that ``matches`` gives."""
        target, above = path[-1], path[:-1]
        same, stop = scope, scope.stop
        if target.tag is not None:
            same = self.by_tag.get(target.tag, ())
            same = same[bisect_left(same, scope.start) :] if scope.start else same
        needle, raw_attrs = target.needle, self.raw_attrs
        for i in same:
            if i >= stop:
                return None
            if needle:
                raw = raw_attrs[i]
                if needle not in raw and "&" not in raw or not target.holds(self.attrs(i)):
                    continue
            if not above or self._below(i, above, root):
                return i
        return None

    def matches(self, path: tuple[Match, ...], scope: range, root: int = -1):
        """Elements of ``scope`` that match the path; ancestors count up to ``root``."""
        target, above = path[-1], path[:-1]
        tag, needle, raw_attrs = target.tag, target.needle, self.raw_attrs
        if tag is not None:
            same = self.by_tag.get(tag)
            if same is None:
                return
            scope = same[bisect_left(same, scope.start) : bisect_left(same, scope.stop)]
        for i in scope:
            if needle:
                raw = raw_attrs[i]
                if needle not in raw and "&" not in raw:
                    continue
                if not target.holds(self.attrs(i)):
                    continue
            if not above or self._below(i, above, root):
                yield i

    def _below(self, i: int, above: tuple[Match, ...], root: int) -> bool:
        left = len(above)
        i = self.parents[i]
        while left and i > root:
            if above[left - 1].accepts(self, i):
                left -= 1
            i = self.parents[i]
        return not left


@dataclass(frozen=True)
class Match:
    """One element test; a path of them reads outermost first, like a descendant selector."""

    tag: str | None = None
    classes: tuple[str, ...] = ()
    id: str | None = None
    attr: tuple[str, str] | None = None
    class_attr: str | None = None  # the whole class attribute, not one class of it

    @cached_property
    def needle(self) -> str:
        """A text the attributes must contain, unless they use character references."""
        wanted = [self.id, self.attr and self.attr[1], *self.classes, *(self.class_attr or "").split()]
        return max(filter(None, wanted), key=len, default="")

    def accepts(self, page: Page, i: int) -> bool:
        if self.tag is not None and page.tags[i] != self.tag:
            return False
        if not self.needle:
            return True
        if self.needle not in page.raw_attrs[i] and "&" not in page.raw_attrs[i]:
            return False
        return self.holds(page.attrs(i))

    def holds(self, attrs: dict[str, str]) -> bool:
        """Whether the attributes pass."""
        if self.id is not None and attrs.get("id") != self.id:
            return False
        if self.attr is not None and attrs.get(self.attr[0]) != self.attr[1]:
            return False
        if not self.classes and self.class_attr is None:
            return True
        own = attrs.get("class", "").split()
        for c in self.classes:
            if c not in own:
                return False
        return self.class_attr in (None, " ".join(own))
