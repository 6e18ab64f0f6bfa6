"""A linear HTML tokenizer, and CSS selectors matched while it runs.

Every character is looked at a bounded number of times: a comment, tag or raw element that is never closed runs to the end of
the page, as browsers take it, and nothing is searched for twice. Selectors are compiled to steps; an open element carries the
set of steps that it and its ancestors fulfil, so that no tree is kept and no ancestor visited again.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

# Fixed values of the HTML standard: elements without content; elements whose content is no markup; which starts end an open
# element of their own or another kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: An open element of these kinds is as far up as a start ends anything.
WALLS = frozenset("article body div dl footer header main nav ol section select table ul".split())

_SPACE = re.compile(r"[\s/]*+")
_NAME = re.compile(r"[^\s/>]++")
_KEY = re.compile(r"[^\s/>=][^\s/>=]*+|=[^\s/>=]*+")
_EQUALS = re.compile(r"\s*+=\s*+")
_PLAIN = re.compile(r"[^\s>]*+")
_CLOSE = {name: re.compile(rf"</{name}(?=[\s/>]|$)", re.IGNORECASE) for name in RAW}


#: What ``html.escape`` writes, and what it stands for.
ESCAPES = {"&quot;": '"', "&#x27;": "'", "&lt;": "<", "&gt;": ">", "&amp;": "&"}
_ESCAPES = re.compile("|".join(ESCAPES))


def unescape_closed(text: str) -> str:
    """Undo ``html.escape`` and nothing else: other references stay as they are, and so does one that a cut left without its
    semicolon, which browsers would take too."""
    return _ESCAPES.sub(lambda m: ESCAPES[m[0]], text)


def tokens(page: str, decode: Callable[[str], str] = entities.unescape) -> Iterator[tuple]:
    """("start", name, attributes, begin, end), ("end", name, begin, end), ("text", text, begin, end), names in lower case,
    begin and end places in the page. ``decode``: what is done to the references in texts."""
    i, n = 0, len(page)
    while i < n:
        at = page.find("<", i)
        while 0 <= at < n - 1 and not (page[at + 1].isalpha() or page[at + 1] in "/!?"):
            at = page.find("<", at + 1)  # a bare "<" is text
        if at < 0 or at == n - 1:
            yield "text", decode(page[i:]), i, n
            return
        if at > i:
            yield "text", decode(page[i:at]), i, at
        if page[at + 1] in "!?" or (page[at + 1] == "/" and not page[at + 2 : at + 3].isalpha()):
            comment = page.startswith("<!--", at)
            end = page.find("-->" if comment else ">", at + (4 if comment else 2))
            if end < 0:
                return
            i = end + (3 if comment else 1)
            continue
        closing = page[at + 1] == "/"
        m = _NAME.match(page, at + 1 + closing)
        name, attributes, p = m[0].lower(), {}, m.end()
        while True:
            p = _SPACE.match(page, p).end()
            if p >= n:
                return  # a tag that never ends
            if page[p] == ">":
                break
            m = _KEY.match(page, p)
            key, p, value = m[0].lower(), m.end(), ""
            if m := _EQUALS.match(page, p):
                p = m.end()
                if page[p : p + 1] in ('"', "'") and p < n:
                    end = page.find(page[p], p + 1)
                    if end < 0:
                        return
                    value, p = page[p + 1 : end], end + 1
                else:
                    m = _PLAIN.match(page, p)
                    value, p = m[0], m.end()
            attributes.setdefault(key, entities.unescape(value))
        i = p + 1
        if closing:
            yield "end", name, at, i
            continue
        yield "start", name, attributes, at, i
        if name in RAW:
            m = _CLOSE[name].search(page, i)
            end = m.start() if m else n
            if end > i:
                yield "text", decode(page[i:end]) if name in ("textarea", "title") else page[i:end], i, end
            i = end


# Selectors ------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Step:
    """A compound selector and whether its parent (and not any ancestor) must fulfil the step before."""

    tag: str | None
    tests: tuple[tuple[str, str, str], ...]
    child: bool

    def fits(self, name: str, attributes: dict[str, str]) -> bool:
        return (self.tag is None or self.tag == name) and all(_test(op, attributes.get(key), value) for key, op, value in self.tests)


def _test(op: str, have: str | None, value: str) -> bool:
    if have is None:
        return False
    if op in ("^=", "$=", "*=") and not value:
        return False
    return {
        "": lambda: True, "=": lambda: have == value, "~=": lambda: value in have.split(), "^=": lambda: have.startswith(value),
        "$=": lambda: have.endswith(value), "*=": lambda: value in have, "|=": lambda: have == value or have.startswith(value + "-"),
    }[op]()


_IDENT = r"-?[A-Za-z_\u0080-\U0010ffff][\w\u0080-\U0010ffff-]*"
_COMPOUND = re.compile(rf"(\*|{_IDENT})|#([\w-]+)|\.({_IDENT})|\[\s*({_IDENT})\s*(?:([~^$*|]?=)\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\]]+))\s*)?\]")


def compile_selector(selector: str) -> tuple[tuple[Step, ...], ...]:
    """Chains of steps, one for each selector between commas: tags, ``*``, ``#id``, ``.class``, ``[attr]`` with ``=``, ``~=``,
    ``^=``, ``$=``, ``*=``, ``|=``, descendants and children. A closing ``::text`` is left out; anything else is an error."""
    chains = []
    for part in _split(selector):
        part, steps, i, child = re.sub(r"\s*::text\s*$", "", part).strip(), [], 0, False
        while i < len(part):
            tag, tests, begin = None, [], i
            while m := _COMPOUND.match(part, i):
                if m[1] and i > begin:
                    break
                tag = m[1].lower() if m[1] and m[1] != "*" else tag
                tests += [("id", "=", m[2])] * bool(m[2]) + [("class", "~=", m[3])] * bool(m[3])
                if m[4]:
                    tests.append((m[4].lower(), m[5] or "", next((g for g in m.groups()[5:8] if g is not None), "")))
                i = m.end()
            if i == begin:
                raise ValueError(f"selector {selector!r} at {part[i:]!r}")
            steps.append(Step(tag, tuple(tests), child))
            m = re.compile(r"\s*(>?)\s*").match(part, i)
            if m.end() == i < len(part):
                raise ValueError(f"selector {selector!r} at {part[i:]!r}")
            i, child = m.end(), bool(m[1])
        if not steps or child:
            raise ValueError(f"selector {selector!r}")
        chains.append(tuple(steps))
    return tuple(chains)


def _split(selector: str) -> list[str]:
    """At commas outside brackets and quotes."""
    return re.split(r",(?![^\[]*\])", selector)


@dataclass
class _Open:
    name: str
    own: list[set]
    above: list[set]
    fits: tuple[int, ...]


@dataclass
class Found:
    """What a selector found: text nodes in order, each once; for every matching element the range of its texts among them,
    and of its source in the page."""

    texts: list[str] = field(default_factory=list)
    ranges: list[list[int]] = field(default_factory=list)
    spans: list[list[int]] = field(default_factory=list)

    def elements(self) -> list[list[str]]:
        return [self.texts[a:b] for a, b in self.ranges]


def select(page: str, selectors: list[tuple[tuple[Step, ...], ...]], skip: frozenset[str] = frozenset(), decode: Callable[[str], str] = entities.unescape) -> list[Found]:
    """One ``Found`` for each compiled selector. Texts in elements of ``skip`` don't count. An element that is never closed
    runs to the end of its parent. ``decode`` as in ``tokens``."""
    chains = [(k, chain) for k, group in enumerate(selectors) for chain in group]
    found = [Found() for _ in selectors]
    stack: list[_Open] = []
    places: dict[str, list[int]] = {}  # depths of the open elements of a name, and of walls
    inside: list[list[int]] = [[] for _ in selectors]  # numbers of the open matching elements
    skipped = 0

    def close(upto: int, end: int) -> None:
        nonlocal skipped
        while len(stack) > upto:
            gone = stack.pop()
            for x in (gone.name, *["<"] * (gone.name in WALLS)):
                places[x].pop()
            skipped -= gone.name in skip
            for k in gone.fits:
                number = inside[k].pop()
                found[k].spans[number][1], found[k].ranges[number][1] = end, len(found[k].texts)

    def end_before(names: tuple[str, ...], at: int) -> None:
        """Close the nearest open element of these names, if no wall is between."""
        depth = max(((places.get(x) or [-1])[-1] for x in names), default=-1)
        if depth >= 0 and depth >= (places.get("<") or [-1])[-1]:
            close(depth, at)

    for token in tokens(page, decode):
        if token[0] == "text":
            if not skipped:
                for k, open_ in enumerate(inside):
                    if open_:
                        found[k].texts.append(token[1])
        elif token[0] == "start":
            _, name, attributes, begin, end = token
            if name in ENDS_P:
                end_before(("p",), begin)
            for _ in ENDS.get(name, ()):  # a row ends a cell, then the row before
                end_before(ENDS[name], begin)
            up = stack[-1] if stack else None
            own, above, fits = [], [], set()
            for c, (k, chain) in enumerate(chains):
                mine = {j for j, s in enumerate(chain) if (j == 0 or (up is not None and j - 1 in (up.own if s.child else up.above)[c])) and s.fits(name, attributes)}
                own.append(mine)
                above.append(mine | up.above[c] if up is not None and up.above[c] else mine)
                if len(chain) - 1 in mine:
                    fits.add(k)
            for k in fits:
                found[k].ranges.append([len(found[k].texts)] * 2)
                found[k].spans.append([begin, end])
            if name not in VOID:
                for k in fits:
                    inside[k].append(len(found[k].ranges) - 1)
                for x in (name, *["<"] * (name in WALLS)):
                    places.setdefault(x, []).append(len(stack))
                stack.append(_Open(name, own, above, tuple(fits)))
                skipped += name in skip
        elif places.get(token[1]):
            depth = places[token[1]][-1]
            close(depth + 1, token[2])
            close(depth, token[3])
    close(0, len(page))
    return found
