"""Records of plainly written pages by built-in expressions, without a Python worker.

A page is plain if its tags are lower-case, its attributes in double quotes and without markup,
its references a few common ones, and if it has no comment, declaration, script, style or template.  Listing pages that a shop's
templates write are like that.  ``operators.pages`` reads the others in its Arrow pass; both
give the same records.  Plain pages are read in one of two ways.

A page is nested if each end tag closes the element opened last and none is left open, as templates
write them too.  One pattern tells that, with a level of it per level of elements.  An element then
ends where its name has been closed as often as opened, so regions, records, ancestors and fields
are cut out of the text by patterns.

The text of any other plain page is cut at ``<`` into pieces, and a fold over them keeps the path of open elements, such
as ``0:html/4:body/9:div/``.  A piece gets the path of the element that it starts and the path
that is open after it.  An element lies inside another one if its path begins with the other's,
and a text belongs to all elements on the path that is open where it stands; so regions, records,
ancestors and texts are comparisons of paths, and nothing is searched twice.  That takes several times as long.
"""

from __future__ import annotations

import re
import string
from typing import TYPE_CHECKING

from pyspark.sql import Column, functions as F

from .html import NO_TEXT, VOID, Match

if TYPE_CHECKING:
    from .pages import Profile, Rule

#: Pieces beyond which a page is left to the Arrow pass: the fold copies its list once per piece.
MOST_PIECES = 20_000
#: Levels of elements beyond which a page counts as not nested: its pattern has one part per level.
MOST_LEVELS = 24

# The references that plain pages may use, the ampersand last.
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
NO_BREAK = dict(REFERENCES)["&nbsp;"]
# Characters are listed one by one: a class of them is one look-up, one of ranges is a test per range.
_LOWER, _NAME_MORE = f"[{string.ascii_lowercase}]", f"[{string.ascii_lowercase}{string.digits}]"
_COMMON = f"[{''.join(re.escape(chr(c)) for c in range(0x20, 0x7F) if chr(c) not in '<>&' + chr(34))}]"
# Runs of common characters are taken at once.
_VALUE = rf"{_COMMON}*+(?:(?:[^\x00-\x7F\p{{Z}}\p{{Cc}}]++|&(?:amp|lt|gt|quot|#39);){_COMMON}*+)*+"
# A value that ends like the start of an attribute would be taken for one.
_NO_START = r"(?:(?<!=)|(?<! [a-z\-]{1,60}=))"
_KEY = rf"{_LOWER}[{string.ascii_lowercase}\-]*+"
_ATTRIBUTES = rf'(?: {_KEY}="{_VALUE}{_NO_START}")*+'
_NAME = rf'(?!(?:{"|".join(sorted(NO_TEXT))})[ >]){_LOWER}{_NAME_MORE}*+'
_CLOSED = "(?:(?<=<br|<hr) ?/)?"
_TEXT = r"[^<>&]*+(?:&(?:amp|lt|gt|quot|#39|nbsp);[^<>&]*+)*+"
PLAIN = rf"\A{_TEXT}(?:<(?:{_NAME}{_ATTRIBUTES}{_CLOSED}|/{_LOWER}{_NAME_MORE}*+)>{_TEXT})*+\z"
_VOID = rf"(?:{'|'.join(sorted(VOID))})(?!{_NAME_MORE})"


def _nested(levels: int) -> str:
    """What plain pages are whose elements end in the order opposite to that of their starts."""
    inner = _TEXT
    for n in range(levels):
        element = rf"{_VOID}{_ATTRIBUTES}{_CLOSED}>|(?<n{n}>{_NAME}){_ATTRIBUTES}>{inner}</\k<n{n}>>"
        inner = rf"{_TEXT}(?:<(?={_LOWER})(?:{element}){_TEXT})*+"
    return rf"\A{inner}\z"


NESTED = _nested(MOST_LEVELS)
# White space as a reader of text trims it.
_SPACES = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _decoded(value: str) -> str:
    read = value
    for reference, character in REFERENCES:
        read = f"replace({read}, {_quoted(reference)}, {_quoted(character)})"
    return f"if(contains({value}, '&'), {read}, {value})"


def _attribute(attrs: str, name: str) -> str:
    """An attribute's value; of repeated ones the last; null without it."""
    found = f"substring_index(substring_index({attrs}, ' {name}=\"', -1), '\"', 1)"
    return f"if(contains({attrs}, ' {name}=\"'), {_decoded(found)}, null)"


def _is(match: Match, node: str) -> str:
    """Whether an element passes a test; cheap conditions first."""
    tests = [f"{node}.name = {_quoted(match.tag)}"] if match.tag else []
    if match.needle:
        tests.append(f"(contains({node}.attrs, {_quoted(match.needle)}) or contains({node}.attrs, '&'))")
    if match.id is not None:
        tests.append(f"coalesce({_attribute(f'{node}.attrs', 'id')} = {_quoted(match.id)}, false)")
    if match.attr is not None:
        tests.append(f"coalesce({_attribute(f'{node}.attrs', match.attr[0])} = {_quoted(match.attr[1])}, false)")
    own = f"concat(' ', coalesce({_attribute(f'{node}.attrs', 'class')}, ''), ' ')"
    tests += [f"contains({own}, {_quoted(f' {c} ')})" for c in match.classes]
    if match.class_attr is not None:
        tests.append(f"trim(regexp_replace({own}, ' +', ' ')) = {_quoted(match.class_attr)}")
    return " and ".join(tests) or "true"


def _inside(node: str, path: str) -> str:
    return f"startswith({node}.path, {path}) and {node}.path <> {path}"


def _below(node: str, above: tuple[Match, ...], root: str) -> str:
    """Whether the element has ancestors that match, innermost last, below ``root``."""
    if not above:
        return "true"
    outer = f"a{len(above)}"
    within = f"startswith({node}.path, {outer}.path) and {outer}.path <> {node}.path and {_inside(outer, root)}"
    return f"exists(p.nodes, {outer} -> {within} and {_is(above[-1], outer)} and {_below(outer, above[:-1], root)})"


def _matches(path: tuple[Match, ...], scope: str | None, root: str, node: str, among: str = "p.nodes") -> str:
    """The elements of a scope that match a path, in page order; ``among`` holds them, and only them without a scope."""
    inside = f"{_inside(node, scope)} and " if scope else ""
    return f"filter({among}, {node} -> {inside}{_is(path[-1], node)} and {_below(node, path[:-1], root)})"


def _text(node: str, strip: bool) -> str:
    """The text of an element: its nodes one after the other, each trimmed if wanted."""
    piece = _decoded("t.text")
    trimmed = f"trim(both {_quoted(''.join(map(chr, _SPACES)))} from {piece})" if strip else piece
    own = f"filter(p.texts, t -> startswith(t.path, {node}.path))"
    return f"array_join(transform({own}, t -> {trimmed}), '')"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with a value that is evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _read(rule: Rule, among: str, root: str) -> str:
    """The SQL of one field of a record; ``among`` holds the elements inside it."""

    def within(scope: str | None) -> str:
        found = _matches(rule.path, scope, root, "x", among)
        if rule.kind == "texts":
            return f"transform({found}, x -> {_text('x', True)})"
        if rule.kind == "present":
            return f"size({found}) > 0"
        value = _attribute("f.attrs", rule.attr) if rule.kind == "attr" else _text("f", rule.kind == "text")
        return _let("f", f"get({found}, 0)", f"if(f is null, cast(null as string), {value})")

    if rule.within is None:
        return within(None)
    nothing = {"texts": "cast(array() as array<string>)", "present": "false"}.get(rule.kind, "cast(null as string)")
    return _let("h", f"get({_matches((rule.within,), None, root, 'x', among)}, 0)", f"if(h is null, {nothing}, {within('h.path')})")


def page_nodes(html: str) -> str:
    """SQL of a struct of a page's elements (``path, name, attrs``) and texts (``path, text``).

    An end tag closes up to its nearest open partner, and is passed over without one.
    """
    void = ", ".join(_quoted(name + end) for name in sorted(VOID) for end in ("", "/"))
    pieces = f"transform(slice(split({html}, '<'), 2, {MOST_PIECES}), x -> split(x, '>'))"
    names = "transform(q, v -> substring_index(v[0], ' ', 1))"
    now, partner = "element_at(s, -1)", "concat(':', substring(v, 2), '/')"
    before = f"left({now}, length({now}) - length(substring_index({now}, {partner}, -1)) - length(v) - 1)"
    cut = f"left({before}, length({before}) - length(substring_index({before}, '/', -1)))"
    after = f"""case when startswith(v, '/') then if(contains({now}, {partner}), {cut}, {now})
        when v in ({void}) then {now} else concat({now}, size(s), ':', v, '/') end"""
    # The paths that are open before the first piece, and after each one.
    open_ = f"aggregate({names}, array(''), (s, v) -> concat(s, array({after})))"
    own = "if(o[i + 1] = o[i], concat(o[i], i, ':/'), o[i + 1])"
    element = f"if(startswith(v[0], '/'), null, struct({own} as path, replace(substring_index(v[0], ' ', 1), '/', '') as name, v[0] as attrs))"
    nodes = f"filter(transform(q, (v, i) -> {element}), n -> n is not null)"
    texts = "filter(transform(q, (v, i) -> if(v[1] = '', null, struct(o[i + 1] as path, v[1] as text))), n -> n is not null)"
    return _let("q", pieces, _let("o", open_, f"struct({nodes} as nodes, {texts} as texts)"))


def _folded(profile: Profile, html: str) -> str:
    """SQL of the records of a plain page, by the paths of its elements."""
    def fields(own: str, outer: str, root: str) -> str:
        read = ", ".join(f"{_read(rule, 'wide' if rule.outer else 'own', root)} as {name}" for name, rule in profile.fields.items())
        read = _let("own", f"filter(p.nodes, x -> {_inside('x', own)})", f"struct({read})")
        return _let("wide", f"filter(p.nodes, x -> {_inside('x', outer)})", read) if any(r.outer for r in profile.fields.values()) else read

    regions = [f"r{i}" for i in range(len(profile.regions))]
    root, last = (f"{regions[0]}.path", f"{regions[-1]}.path") if regions else ("''", "''")
    if profile.record is None:
        body = f"array({fields(last, root, root)})"
    else:
        body = f"transform({_matches((profile.record,), last, root, 'x')}, rec -> {fields('rec.path', root, root)})"
    none = _no_records(profile)
    for i in reversed(range(len(regions))):
        scope = f"{regions[i - 1]}.path" if i else "''"
        found = f"get({_matches((profile.regions[i],), scope, root if i else scope, 'x')}, 0)"
        body = _let(regions[i], found, f"if({regions[i]} is null, {none}, {body})")
    return _let("p", page_nodes(html), body)


def _no_records(profile: Profile) -> str:
    kinds = ", ".join(f"{name}: {rule.type}" for name, rule in profile.fields.items())
    return f"cast(array() as array<struct<{kinds}>>)"


# Patterns for the text of a nested page, or of a part of one.


def _start(match: Match) -> str:
    """The beginning of a start tag that passes a test, up to its name; of repeated attributes the last counts."""
    wanted = [("id", re.escape(match.id))] if match.id is not None else []
    wanted += [(match.attr[0], re.escape(match.attr[1]))] if match.attr is not None else []
    wanted += [("class", f'(?:[^"]* )?{re.escape(c)}(?: [^"]*)?') for c in match.classes]
    if match.class_attr is not None:
        wanted.append(("class", f" *{' +'.join(map(re.escape, match.class_attr.split()))} *"))
    tests, other = "", rf'{_KEY}="[^"]*"'
    for key, value in wanted:
        again = f'(?=[^>]* {key}=")'
        last = f'{value}"{again.replace("=", "!", 1)}'
        tests += f'(?=(?: (?!{key}=){other})*+ {key}="(?:{last}|[^"]*"{again}(?: {other})*? {key}="{last}))'
    return f"<{f'{match.tag}(?=[ />])' if match.tag else f'(?<name>{_LOWER}{_NAME_MORE}*+)'}{tests}"


def _rest(match: Match) -> str:
    """The rest of an element that is not void, without its end tag; what it holds is the last group."""
    name = match.tag or r"\k<name>"
    inner = other = rf"[^<]*+(?:<(?!/?{name}[ >])[^<]*+)*+"
    for _ in range(MOST_LEVELS):
        inner = rf"{other}(?:<{name}[ >][^<]*+{inner}</{name}>{other})*+"
    return f"[^>]*+>({inner})(?=</{name}>)"


_AFTER_VOID = f"<(?:{'|'.join(sorted(VOID))}))"


def _needle(match: Match) -> str:
    """What the start tags that pass a test have."""
    return match.needle or f"<{match.tag or ''}"


def _less(text: str, match: Match) -> str:
    return f"replace({text}, {_quoted(_needle(match))}, '')"


def _where(text: str, match: Match, found: str, nothing: str = "''") -> str:
    """What is found in a text, unless it lacks what the elements have."""
    return f"if(contains({text}, {_quoted(_needle(match))}), {found}, {nothing})"


def _first(text: str, match: Match, whole: bool = True) -> str:
    """The first element that passes a test, without its end tag, or no more than its start tag; empty if there is none."""
    rest = "[^>]*+>"
    if whole and match.tag not in VOID:
        rest = _rest(match) if match.tag else f"(?:(?<={_AFTER_VOID}[^>]*+>|{_rest(match)})"
    return _where(text, match, f"regexp_extract({text}, {_quoted(_start(match) + rest)}, 0)")


def _inner(element: str) -> str:
    return f"substr({element}, instr({element}, '>') + 1)"


def _each(text: str, match: Match) -> str:
    """What each element that passes a test holds, those inside of others too."""
    rest = f"(?={_rest(match)})" if match.tag else f"(?:(?<={_AFTER_VOID}|(?={_rest(match)}))"
    pattern = _start(match) + ("()" if match.tag in VOID else rest)
    return f"regexp_extract_all({text}, {_quoted(pattern)}, {1 if match.tag else 2})"


def _outermost(text: str, match: Match, held: bool) -> str:
    """The elements that pass a test, or what they hold, of those inside of each other the outermost, as one text."""
    pattern = _start(match) + ("" if match.tag else f"(?<!{_AFTER_VOID}") + _rest(match)
    group = 0 if not held else 1 if match.tag else 2
    found = f"array_join(regexp_extract_all({text}, {_quoted(pattern)}, {group}), '')"
    return "''" if match.tag in VOID else _where(text, match, found)


def _read_text(held: str, strip: bool) -> str:
    """The text in what an element holds."""
    if not strip:
        return _let("y", f"regexp_replace({held}, '<[^>]*+>', '')", _decoded("y"))
    space = "".join(f"\\u{c:04x}" for c in _SPACES)
    bare = rf"<[^>]*+>[{space}]*+|\A[{space}]++|(?![!-~])[{space}](?<![{space}][{space}])[{space}]*+(?=<|\z)"
    return _let("y", f"regexp_replace(replace({held}, '&nbsp;', '{NO_BREAK}'), {_quoted(bare)}, '')", _decoded("y"))


def _source(rule: Rule, text: str) -> str:
    """The part of a text in which the last element of a rule's path counts."""
    if rule.within is not None:
        text = _let("h", _first(text, rule.within), _inner("h"))
    for above in rule.path[:-1]:
        text = _let("c", text, _outermost("c", above, held=True))
    return text


def _cut(rule: Rule, text: str) -> str:
    """The SQL of one field of a record."""
    target = rule.path[-1]
    if rule.kind == "present":
        return _where(text, target, f"regexp_like({text}, {_quoted(_start(target))})", "false")
    if rule.kind == "texts":
        return f"transform({_each(text, target)}, x -> {_read_text('x', True)})"
    value = _attribute("f", rule.attr) if rule.kind == "attr" else _read_text(_inner("f"), rule.kind == "text")
    return _let("f", _first(text, target, rule.kind != "attr"), f"if(f = '', cast(null as string), {value})")


def _by_patterns(profile: Profile) -> bool:
    """Whether patterns can stand for the profile's tests: names and values as plain pages write them, in one way only."""
    rules = profile.fields.values()
    tested = [*profile.regions, *([profile.record] if profile.record else [])]
    for m in tested + [m for r in rules for m in (*r.path, *([r.within] if r.within else []))]:
        values = [*m.classes, *(v for v in (m.id, m.attr and m.attr[1], m.class_attr) if v is not None)]
        if any(not v or re.search(r"[&<>\"']", v) for v in values) or any(c.split() != [c] for c in m.classes):
            return False
        if m.class_attr is not None and " ".join(m.class_attr.split()) != m.class_attr:
            return False
        if not re.fullmatch("[a-z][a-z0-9]*", m.tag or "a") or not re.fullmatch("[a-z][a-z-]*", m.attr[0] if m.attr else "a"):
            return False
    return all(r.within is None or len(r.path) == 1 for r in rules)


def _by_nesting(profile: Profile, html: str) -> str:
    """SQL of the records of a nested page; null if an ancestor that a field asks for holds a record.

    Fields are searched in the text of their record, which does not show what that lies in.
    """
    n, rules = len(profile.regions), profile.fields.values()
    last, root = (f"i{n - 1}", "i0") if n else (html, html)

    def fields(own: str) -> str:
        scopes = [root if r.outer else own for r in rules]
        sources = [_source(r, scope) for r, scope in zip(rules, scopes)]
        names = {s: f"s{i}" for i, s in enumerate(dict.fromkeys(sources)) if s not in scopes}
        read = ", ".join(f"{_cut(r, names.get(s, s))} as {name}" for (name, r), s in zip(profile.fields.items(), sources))
        read = f"struct({read})"
        for source, name in names.items():
            read = _let(name, source, read)
        return read

    scope = profile.record or (profile.regions[-1] if n > 1 else None)
    above = dict.fromkeys(r.path[0] for r in rules if len(r.path) > 1 and not r.outer and scope)
    held = " or ".join(f"regexp_like({_outermost(root, a, held=False)}, {_quoted(_start(scope))})" for a in above)
    if profile.record is None:
        body = f"array({fields(last)})"
    else:
        body = f"transform(own_, own -> {fields('own')})"
        # No ancestor holds a record if all are inside of records, and those not inside of each other.
        apart = [f"contains(all_, {_quoted(_needle(profile.record))})"]
        apart += [f"octet_length({root}) - octet_length(all_) <> octet_length({_less(root, a)}) - octet_length({_less('all_', a)})" for a in above]
        held = held and _let("all_", "array_join(own_, '>')", f"({' or '.join(apart)}) and ({held})")
    if held:
        body = f"if({held}, null, {body})"
    if profile.record is not None:
        body = _let("own_", _each(last, profile.record), body)
    for i in reversed(range(n)):
        found = _first(f"i{i - 1}" if i else html, profile.regions[i])
        body = _let(f"r{i}", found, f"if(r{i} = '', {_no_records(profile)}, {_let(f'i{i}', _inner(f'r{i}'), body)})")
    return body


def is_nested(html: Column) -> Column:
    """Whether a page is nested; a null one is not."""
    return F.coalesce(_few(html) & html.rlike(NESTED), F.lit(False))


def records(profile: Profile, html: str) -> Column:
    """The records of a plain page as an array of structs; null if the page is not plain."""
    folded = F.when(is_plain(F.expr(html)), F.expr(_folded(profile, html)))
    if not _by_patterns(profile):
        return folded
    return F.coalesce(F.when(is_nested(F.expr(html)), F.expr(_by_nesting(profile, html))), folded)


def _few(html: Column) -> Column:
    """Whether a page has few enough pieces; a short one needs no count."""
    pieces = F.length(html) - F.length(F.replace(html, F.lit("<"), F.lit("")))
    return (F.octet_length(html) <= MOST_PIECES) | (pieces <= MOST_PIECES)


def is_plain(html: Column) -> Column:
    """Whether a page is plain; a null one is not."""
    return F.coalesce(_few(html) & html.rlike(PLAIN), F.lit(False))
