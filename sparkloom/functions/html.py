"""A small document tree on the standard library's parser, and the CSS selectors that extractors need.

The parser recovers as ``html.parser`` trees do: unclosed elements nest, nothing is closed by implication, an
end tag closes the nearest open element of its name, and text of script and style is raw.

A selector is compiled to states, one for each compound of each of its alternatives and of those inside ``:is``, ``:not`` and
``:has``. One pass in document order gives each node the set of states it meets, as a bit mask, from its own tests and the
masks of its ancestors and elder siblings; a pass backwards answers ``:has``. Both run once for each depth of nested ``:has``, so
that time is linear in the nodes, however deep or wide the tree.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr basefont bgsound command frame image isindex nextid spacer".split())
SILENT = frozenset(["script", "style", "template"])


class Node:
    """An element; children are nodes and strings, an empty one where a node was removed."""

    __slots__ = ("attrs", "children", "name", "parent", "place")

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None):
        self.name, self.attrs, self.parent, self.children = name, attrs, parent, []
        self.place = 0
        if parent is not None:
            self.place = len(parent.children)
            parent.children.append(self)

    def walk(self) -> Iterator[Node]:
        """Elements below, in document order."""
        stack = [iter(self.children)]
        while stack:
            for x in stack[-1]:
                if isinstance(x, Node):
                    yield x
                    stack.append(iter(x.children))
                    break
            else:
                stack.pop()

    @property
    def text(self) -> str:
        """All text below; that of scripts and styles only where the node is one itself."""
        out, stack = [], [iter(self.children)]
        while stack:
            for x in stack[-1]:
                if not isinstance(x, Node):
                    out.append(x)
                elif x.name not in SILENT:
                    stack.append(iter(x.children))
                    break
            else:
                stack.pop()
        return "".join(out)

    def remove(self) -> None:
        if self.parent is not None:
            self.parent.children[self.place] = ""
            self.parent = None

    def previous(self) -> Node | str | None:
        """What stands before the node below the same parent."""
        if self.parent is None:
            return None
        return next((x for x in (self.parent.children[i] for i in range(self.place - 1, -1, -1)) if isinstance(x, Node) or x), None)

    def select(self, selector: str) -> list[Node]:
        """The elements below that match, in document order."""
        program = compiled(selector)
        if self.name == "" or not program.linked:
            return program.run(self)
        top, above = self, set()
        while top.parent is not None:
            top = top.parent
        for x in self.walk():
            above.add(id(x))
        return [x for x in program.run(top) if id(x) in above]

    def first(self, selector: str) -> Node | None:
        return next(iter(self.select(selector)), None)


class _Builder(HTMLParser):
    def __init__(self, written: bool):
        super().__init__(convert_charrefs=True)
        self.written = written
        self.root = self.here = Node("", {}, None)
        self.open: Counter[str] = Counter()

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {}, self.here)
        for k, v in attrs:
            node.attrs.setdefault(k, v or "")
        if tag not in VOID:
            self.here = node
            self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.here = self.here.parent
            self.open[tag] -= 1

    def handle_endtag(self, tag):
        while self.open[tag]:
            name, self.here = self.here.name, self.here.parent
            self.open[name] -= 1
            if name == tag:
                break

    def handle_data(self, data):
        # The parser resolves no references in scripts and styles.
        self.here.children.append(data.replace("&amp;", "&") if self.written and self.cdata_elem else data)


def parse(html: str, written: bool = False) -> Node:
    """The tree of a page; with ``written`` character references stay as the page has them."""
    builder = _Builder(written)
    builder.feed(html.replace("&", "&amp;") if written else html)
    builder.close()
    return builder.root


_NAME = re.compile(r"[-\w]+")
_ATTR = re.compile(r"""\[\s*([-\w]+)\s*(?:([*^$~]?=)\s*(?:"([^"]*)"|'([^']*)'|([^\s\]]+))\s*(i)?\s*)?\]""")


def _pieces(text: str) -> list[str]:
    """Alternatives of a selector list, cut at commas outside brackets."""
    out, depth, start, quote = [], 0, 0, ""
    for i, c in enumerate(text):
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        elif c in "([":
            depth += 1
        elif c in ")]":
            depth -= 1
        elif c == "," and not depth:
            out.append(text[start:i])
            start = i + 1
    return [x.strip() for x in [*out, text[start:]] if x.strip()]


def _closing(text: str, at: int) -> int:
    depth = 0
    for i in range(at, len(text)):
        depth += (text[i] == "(") - (text[i] == ")")
        if not depth:
            return i
    raise ValueError(f"unclosed bracket in {text!r}")


Test = Callable[[Node], bool]


def _attribute(m: re.Match) -> Test:
    name, how = m[1].lower(), m[2]
    wanted = m[3] if m[3] is not None else m[4] if m[4] is not None else m[5]
    fold = str.lower if m[6] else str
    if how is None:
        return lambda x: name in x.attrs
    wanted = fold(wanted)
    test = {"=": str.__eq__, "*=": lambda v, w: bool(w) and w in v, "^=": lambda v, w: bool(w) and v.startswith(w), "$=": lambda v, w: bool(w) and v.endswith(w), "~=": lambda v, w: w in v.split()}[how]
    return lambda x: name in x.attrs and test(fold(x.attrs[name]), wanted)


class State:
    """A node meets it by ``tests`` on itself, by states in ``any_of`` and none of ``none_of``, by what ``has`` found, and by a
    relative that meets the state before it."""

    __slots__ = ("any_of", "bit", "depth", "has", "link", "name", "need", "none_of", "nth", "tests")

    def __init__(self):
        self.name: str | None = None
        self.tests: list[Test] = []
        self.any_of: list[int] = []
        self.none_of: list[int] = []
        self.nth: list[tuple[int, int, int]] = []  # place of the counter, which one, of what
        self.has: list[int] = []
        self.depth, self.link, self.need, self.bit = 0, "", 0, 0


class Program:
    """A compiled selector list."""

    def __init__(self, selector: str):
        self.states: list[State] = []
        self.searches: list[tuple[int, str, int]] = []  # by bit of ``has``: depth, lead, states that answer it
        self.counters: list[tuple[int, int]] = []  # depth, states that count
        self.linked = False
        self.final, _ = self._list(selector)
        self.depths = range(1 + max((s.depth for s in self.states), default=0))
        self._named: list[dict[tuple[str, bool], list[tuple]]] = [{} for _ in self.depths]

    def _list(self, text: str) -> tuple[int, int]:
        """States that stand for a match of a list, and how deep its ``:has`` are nested."""
        final, depth = 0, 0
        for piece in _pieces(text):
            state = self._complex(piece)
            final, depth = final | state.bit, max(depth, state.depth)
        return final, depth

    def _complex(self, text: str) -> State:
        at, link, last = 0, "", None
        while at < len(text):
            state, end = self._compound(text, at)
            if end == at:
                raise ValueError(f"cannot read selector {text!r} at {at}")
            state.link = link
            if last is not None:
                self.linked = True
                state.need, state.depth = last.bit, max(state.depth, last.depth)
            state.bit = 1 << len(self.states)
            self.states.append(state)
            last = state
            m = re.compile(r"\s*([>+~]?)\s*").match(text, end)
            link, at = m.group(1) or " ", m.end()
        return last

    def _compound(self, text: str, at: int) -> tuple[State, int]:
        own = State()
        while at < len(text):
            c = text[at]
            if c == "*":
                at += 1
            elif c in "#.":
                m = _NAME.match(text, at + 1)
                name, at = m.group(), m.end()
                own.tests.append((lambda x, v=name: x.attrs.get("id") == v) if c == "#" else (lambda x, v=name: v in x.attrs.get("class", "").split()))
            elif c == "[":
                m = _ATTR.match(text, at)
                at = m.end()
                own.tests.append(_attribute(m))
            elif c == ":":
                m = _NAME.match(text, at + 1)
                end = _closing(text, m.end())
                argument, at = text[m.end() + 1 : end].strip(), end + 1
                self._function(own, m.group(), argument)
            elif m := _NAME.match(text, at):
                at = m.end()
                own.name = m.group().lower()
            else:
                break
        return own, at

    def _function(self, own: State, kind: str, argument: str) -> None:
        if kind == "has":
            bits = 0
            for piece in _pieces(argument):
                lead = piece[0] if piece[0] in ">+~" else " "
                final, depth = self._list(piece.lstrip(">+~ "))
                bits |= 1 << len(self.searches)
                self.searches.append((depth, lead, final))
                own.depth = max(own.depth, depth + 1)
            own.has.append(bits)
            return
        if kind in ("not", "is", "where", "matches"):
            final, depth = self._list(argument)
            (own.none_of if kind == "not" else own.any_of).append(final)
        elif kind == "nth-child":
            n, _, of = argument.partition(" of ")
            final, depth = self._list(of or "*")
            own.any_of.append(final)
            own.nth.append((len(self.counters), int(n), final))
            self.counters.append((depth, final))
        else:
            raise ValueError(f"unknown selector :{kind}")
        own.depth = max(own.depth, depth)

    def states_for(self, depth: int, name: str, bare: bool) -> list[tuple]:
        """What a node of that name, ``bare`` if it has no attributes, may meet at that depth."""
        known = self._named[depth]
        if (name, bare) not in known:
            known[name, bare] = [
                (s.bit, s.link, s.need, s.tests, s.has, s.any_of, s.none_of, s.nth)
                for s in self.states
                if s.depth == depth and s.name in (None, name) and not (bare and s.tests)
            ]
        return known[name, bare]

    def run(self, top: Node) -> list[Node]:
        """The elements below ``top`` that match. The last place of each list is that of ``top``, which matches nothing."""
        nodes, parents = [], []
        stack = [(iter(top.children), -1)]
        while stack:
            below, parent = stack[-1]
            for x in below:
                if isinstance(x, Node):
                    parents.append(parent)
                    stack.append((iter(x.children), len(nodes)))
                    nodes.append(x)
                    break
            else:
                stack.pop()
        n = len(nodes)
        met, found = [0] * (n + 1), [0] * (n + 1)
        for depth in self.depths:
            self._forward(depth, nodes, parents, met, found)
            searches = [(1 << i, lead, final) for i, (d, lead, final) in enumerate(self.searches) if d == depth]
            if searches:
                _backward(searches, parents, met, found)
        return [x for x, m in zip(nodes, met, strict=False) if m & self.final]

    def _forward(self, depth: int, nodes: list[Node], parents: list[int], met: list[int], found: list[int]) -> None:
        n = len(nodes)
        above, elder, before = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        counters = [i for i, (d, _) in enumerate(self.counters) if any(s.depth == depth for s in self.states for k, _, _ in s.nth if k == i)]
        counted: dict[tuple[int, int], int] = {}
        for i, x in enumerate(nodes):
            p = parents[i]
            m, here = met[i], above[p] | met[p]
            above[i] = here
            for bit, link, need, tests, has, any_of, none_of, nth in self.states_for(depth, x.name, not x.attrs):
                if need and not (here if link == " " else met[p] if link == ">" else before[p] if link == "+" else elder[p]) & need:
                    continue
                if has and not all(found[i] & b for b in has) or any_of and not all(m & f for f in any_of) or none_of and any(m & f for f in none_of):
                    continue
                if tests and not all(t(x) for t in tests) or nth and any(counted.get((p, k), 0) != which - 1 for k, which, _ in nth):
                    continue
                m |= bit
            met[i] = m
            elder[p] |= m
            before[p] = m
            for k in counters:
                if m & self.counters[k][1]:
                    counted[p, k] = counted.get((p, k), 0) + 1


def _backward(searches: list[tuple[int, str, int]], parents: list[int], met: list[int], found: list[int]) -> None:
    """Marks the nodes for which a search of a child, descendant or younger sibling succeeds."""
    n = len(parents)
    below, younger, behind = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    leads = {lead: sum(bit for bit, own, _ in searches if own == lead) for lead in " >+~"}
    for i in range(n - 1, -1, -1):
        p, m = parents[i], met[i]
        answers = 0
        if m:
            for bit, _, final in searches:
                if m & final:
                    answers |= bit
        found[i] |= below[i] | younger[p] & leads["~"] | behind[p] & leads["+"]
        below[p] |= below[i] & leads[" "] | answers & (leads[" "] | leads[">"])
        younger[p] |= answers
        behind[p] = answers


@lru_cache(maxsize=1024)
def compiled(selector: str) -> Program:
    return Program(selector)
