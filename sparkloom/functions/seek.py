"""Matches of many patterns in time linear in the text: each runs only where a string stands that its matches hold.

One automaton over the required strings of a pack finds all their places in one pass. What a pattern allows before
that string bounds where a match can begin: so many characters, or a run of one class with so many on either side of it.
Results are those of ``re``. Patterns without a required string, or with more than that before it, run as they are.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain, product
from re import _compiler, _parser
from re import _constants as sre

import ahocorasick

#: Strings that a required place may spell, at most; characters that count as bounded before it.
SPELLINGS, NEAR = 24, 64
_ANYTHING = (sre.IN, [(sre.CATEGORY, sre.CATEGORY_SPACE), (sre.CATEGORY, sre.CATEGORY_NOT_SPACE)])


def _flat(parsed) -> list:
    """Items that must be met one after another."""
    out = []
    for op, arg in parsed:
        if op is sre.SUBPATTERN and not arg[1] and not arg[2]:
            out += _flat(arg[3])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] == arg[1] == 1:
            out += _flat(arg[2])
        else:
            out.append((op, arg))
    return out


def _letters(op, arg) -> list[str] | None:
    """The characters that an item spells, if they are few."""
    if op is sre.LITERAL:
        return [chr(arg)]
    if op is sre.IN and all(kind is sre.LITERAL for kind, _ in arg):
        return [chr(value) for _, value in arg]
    return None


def _singles(items) -> list | None:
    """One-character items that ``items`` are made of; None if that can't be told."""
    out = []
    for op, arg in items:
        if op in (sre.LITERAL, sre.NOT_LITERAL, sre.ANY, sre.IN):
            out.append((op, arg))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.SUBPATTERN, sre.BRANCH):
            parts = arg[1] if op is sre.BRANCH else [arg[2] if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) else arg[3]]
            for part in parts:
                if (own := _singles(part)) is None:
                    return None
                out += own
        elif op not in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
            return None
    return out


def _width(state, items) -> int:
    return _parser.SubPattern(state, list(items)).getwidth()[1]


def _outside(state, items, flags: int) -> re.Pattern | None:
    """Finds a character that none of ``items`` takes."""
    singles = _singles(items)
    if singles is None:
        return None
    either = _parser.SubPattern(state, [(sre.BRANCH, (None, [_parser.SubPattern(state, [x]) for x in singles]))]) if singles else None
    test = [(sre.ASSERT_NOT, (1, either))] if either else []
    return _compiler.compile(_parser.SubPattern(state, [*test, _ANYTHING]), flags)


def _found(text: str, part: str) -> list[int]:
    out, at = [], text.find(part)
    while at >= 0:
        out.append(at)
        at = text.find(part, at + 1)
    return out


class Sought:
    """A pattern by the strings that each of its matches holds."""

    def __init__(self, pattern: str | re.Pattern):
        self.pattern = pattern = re.compile(pattern)
        parsed = _parser.parse(pattern.pattern, pattern.flags & ~re.UNICODE)
        self.strings: list[str] = []
        if pattern.flags & (re.IGNORECASE | re.MULTILINE | re.VERBOSE) or parsed.getwidth()[0] == 0:
            return
        state, items = parsed.state, _flat(parsed)
        runs = self._runs(items)
        plans = [(r, plan) for r in runs if (plan := self._lead(state, items[: r[0]], pattern.flags))]
        if not plans:
            return
        (lo, hi, strings), (self.before, self.inside, self.after, self.bare) = max(plans, key=lambda p: min(map(len, p[0][2])))
        self.strings = strings
        self._tail(state, items, hi, [r for r in runs if r[0] >= hi], pattern.flags)

    @staticmethod
    def _runs(items) -> list[tuple[int, int, list[str]]]:
        """Runs of items that spell few strings, of one length each."""
        out, at = [], 0
        while at < len(items):
            end, spelled = at, [""]
            while end < len(items) and (letters := _letters(*items[end])) and len(spelled) * len(letters) <= SPELLINGS:
                spelled = [a + b for a, b in product(spelled, letters)]
                end += 1
            if end > at:
                out.append((at, end, list(dict.fromkeys(spelled))))
            at = max(end, at + 1)
        return out

    @staticmethod
    def _lead(state, items, flags) -> tuple[int, re.Pattern | None, int, bool] | None:
        """What stands before the strings: so many characters, a run of a class, so many characters; and whether the first can be none."""
        wide = [i for i, x in enumerate(items) if _width(state, [x]) > NEAR]
        if not wide:
            return _width(state, items), None, 0, False
        i = wide[0]
        op, arg = items[i]
        if len(wide) > 1 or op not in (sre.MAX_REPEAT, sre.MIN_REPEAT) or arg[0] > 1 or arg[1] is not sre.MAXREPEAT:
            body = None
        else:
            body = _flat(arg[2])
        if body is None or len(body) != 1 or body[0][0] not in (sre.LITERAL, sre.NOT_LITERAL, sre.ANY, sre.IN):
            return None
        ahead = _parser.SubPattern(state, list(items[:i])).getwidth()
        return ahead[1], _outside(state, body, flags), _width(state, items[i + 1 :]), not ahead[0]

    def _tail(self, state, items, hi: int, later: list, flags: int) -> None:
        """What must follow: a string that the next gap reaches, or the end; and strings anywhere behind."""
        self.gap, self.next, self.ends = None, None, False
        self.behind = [re.compile("|".join(map(re.escape, r[2]))) for r in later]
        if later:
            self.gap, self.next = _outside(state, items[hi : later[0][0]], flags), self.behind[0]
            self.reach = max(map(len, later[0][2]))
        elif items[-1] == (sre.AT, sre.AT_END):
            self.gap, self.ends = _outside(state, items[hi:-1], flags), True

    def finditer(self, text: str, places: list[int] | None = None) -> Iterator[re.Match]:
        """As of ``re``. ``places``: where the strings begin, in order, if that is known."""
        if not self.strings:
            yield from self.pattern.finditer(text)
            return
        if places is None:
            places = sorted(chain.from_iterable(_found(text, x) for x in self.strings))
        if not places:
            return
        last = [self._last(p, text, places[0]) for p in self.behind]
        done, tried, run_end, fails_to = 0, 0, -1, -1
        breaks, broken_to = [0], 0
        i = 0
        while i < len(places):
            p = places[i]
            if p < done:
                i += 1
                continue
            if any(p > x for x in last):
                return
            if self.gap is not None:
                begin = p + len(self.strings[0])
                if begin > run_end:
                    m = self.gap.search(text, begin)
                    run_end = m.start() if m else len(text)
                    found = self.next.search(text, begin, min(len(text), run_end + self.reach)) if self.next else None
                    fails_to = run_end if self.next and not found or self.ends and run_end < len(text) - 1 else -1
                    if found:
                        run_end = found.start()  # the next string beyond this place is looked for anew
                if begin <= fails_to:
                    i += 1
                    continue
            lo = p - self.before - self.after
            skip_from = skip_to = -1
            if self.inside is not None:
                # Characters outside the class, as far as the place; a start lies in the run that comes near enough to it.
                if broken_to < p:
                    breaks += [m.end() for m in self.inside.finditer(text, broken_to, p)]
                    broken_to = p
                near = max(p - self.after, 0)
                edge = breaks[bisect_left(breaks, near + 1) - 1]
                lo = edge - self.before
                if self.bare:  # what fails from the run's beginning fails from within it
                    skip_from, skip_to = edge, near - self.before
            s = max(lo, tried, done, 0)
            match = None
            while s <= p:
                if match := self.pattern.match(text, s):
                    break
                s = max(s + 1, skip_to) if s == skip_from else s + 1
            if match:
                yield match
                done = match.end()
            tried = max(s, tried)
            i += 1

    @staticmethod
    def _last(pattern: re.Pattern, text: str, start: int) -> int:
        """Where the last match begins, -1 without one."""
        out = -1
        for m in pattern.finditer(text, start):
            out = m.start()
        return out

    def search(self, text: str, places: list[int] | None = None) -> re.Match | None:
        return next(self.finditer(text, places), None)


class Pack:
    """Patterns with one automaton over the strings that they require."""

    def __init__(self, patterns: list[str | re.Pattern]):
        self.sought = [Sought(p) for p in patterns]
        self.owners: dict[str, list[int]] = {}
        for i, one in enumerate(self.sought):
            for x in one.strings:
                self.owners.setdefault(x, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for x in self.owners:
            self.automaton.add_word(x, x)
        self.automaton.make_automaton()

    def places(self, text: str) -> list[list[int]]:
        """For each pattern, where its strings begin."""
        out: list[list[int]] = [[] for _ in self.sought]
        if self.owners:
            for end, x in self.automaton.iter(text):
                for i in self.owners[x]:
                    out[i].append(end + 1 - len(x))
        for own in out:
            own.sort()
        return out
