"""Arrow-batched functions for what needs Python's own Unicode and regular expressions.

All are marked as not deterministic: else a filter on a result is pushed below and evaluates it twice.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from re import _compiler, _parser
from re import _constants as sre

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import columns
from .delimiters import Strip
from .seek import Sought

# What the english and number replacers look for.
ENGLISH = re.compile(r"[a-zA-z][a-zA-z\s\d]+")
NUMBER = re.compile(r"\d+")
#: Of a batch that Spark sends, what is worked on at once.
PIECE_BYTES, PIECE_ROWS = 1 << 20, 1024


def nfkc_text(text: str) -> str:
    """Compatibility composition, then white space collapsed."""
    return " ".join((text if text.isascii() else unicodedata.normalize("NFKC", text)).split())


def _python(pattern: str) -> re.Pattern:
    """A pattern of ``columns`` in Python's notation."""
    pattern = pattern.replace(columns.WS[:-1], r"\s").replace(r"\p{Nd}", r"\d")
    return re.compile(re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), pattern))


URL, EMOJI, NOT_KEPT = map(_python, (columns.URL, columns.EMOJI, columns.NOT_KEPT))


def delimited_text(text: str, left: str, right: str, by: str = "", keep: bool = False, unclosed: str = "reference") -> str:
    """One text as ``delimiters.Strip`` has it."""
    return Strip(left, right, by, keep, unclosed)(pa.array([text], pa.string()))[0].as_py()


def english_text(text: str) -> str:
    """Latin stretches of two characters or more become ``<en>``, but not inside angle brackets."""
    return ENGLISH.sub(lambda m: m.group() if text[m.start() - 1 : m.start()] == "<" and text[m.end() : m.end() + 1] == ">" else "<en>", text)


def number_text(text: str, tags: tuple[str, ...] = ()) -> str:
    """Digits become ``<num>``, unless what stands since the last replacement ends with a tag's name."""
    done = 0

    def one(m: re.Match) -> str:
        nonlocal done
        if tags and text[done : m.start()].endswith(tags):
            return m.group()
        done = m.end()
        return "<num>"

    return NUMBER.sub(one, text)


Need = frozenset[str]


def _best(needs: list[Need]) -> Need:
    """The need that fewest texts meet, as far as can be told."""
    return max(needs, key=lambda need: (min(map(len, need)), not any(x.isascii() for x in need), -len(need)))


def _needs(parsed, folded: bool) -> list[Need]:
    """Sets of strings of which a text must hold one each, for the pattern to match anywhere in it. Where case is folded,
    characters that have one are passed over."""
    out: list[Need] = []
    run = ""
    plain = lambda code: not folded or chr(code).lower() == chr(code).upper()
    for op, arg in [*parsed, (None, None)]:
        if op is sre.LITERAL and plain(arg):
            run += chr(arg)
            continue
        if run:
            out.append(frozenset([run]))
            run = ""
        if op is sre.IN and all(kind is sre.LITERAL and plain(value) for kind, value in arg):
            out.append(frozenset(chr(value) for _, value in arg))
        elif op is sre.SUBPATTERN and not arg[1] & re.IGNORECASE:
            out += _needs(arg[3], folded)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0]:
            out += _needs(arg[2], folded)
        elif op is sre.BRANCH:
            branches = [_needs(b, folded) for b in arg[1]]
            if all(branches):
                out.append(frozenset().union(*map(_best, branches)))
    return out


def _needs_of_some(parsed, folded: bool) -> list[Need]:
    """The same for a pattern that can match nothing, to match something: one of its parts must."""
    parts: list[Need] = []
    for op, arg in parsed:
        if op in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
            continue
        body = arg[2] if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) else arg[3] if op is sre.SUBPATTERN and not arg[1] & re.IGNORECASE else None
        own = [] if body is None else _needs(body, folded) or (_needs_of_some(body, folded) if body.getwidth()[0] == 0 else [])
        if not own:
            return []
        parts.append(_best(own))
    return [frozenset().union(*parts)] if parts else []


def _met(text: str, held: set[str], needs: list[Need]) -> bool:
    return all(any(x[0] in held and x in text for x in need) for need in needs)


class Rule:
    """A pattern and its replacement, in time linear in most texts that the pattern can't match.

    A text that lacks a string that each match holds is left alone without a search; of a pattern with many branches only
    those that the text can match are tried; a run of a class at the end is looked for from the end. None changes a result.
    """

    #: Branches from which on a pattern is cut down to a text; texts that a pattern is tried on everywhere.
    MANY, SHORT = 6, 200_000

    def __init__(self, pattern: str, by: str):
        self.pattern, self.by = re.compile(pattern), by
        self.parsed = _parser.parse(pattern)
        folded = bool(self.pattern.flags & re.IGNORECASE)
        self.needs = _needs(self.parsed, folded)
        if by == "" and self.parsed.getwidth()[0] == 0:
            self.needs = _needs_of_some(self.parsed, folded)
        self.needs.sort(key=len)
        self.branches, self.cut_down = None, {}
        for i, (op, arg) in enumerate(self.parsed):
            inner = arg[3] if op is sre.SUBPATTERN and not arg[1] & re.IGNORECASE else None
            if inner is not None and len(inner) == 1 and inner[0][0] is sre.BRANCH and len(inner[0][1][1]) >= self.MANY:
                self.branches = (i, inner[0][1][1], [_needs(b, folded) for b in inner[0][1][1]])
                break
        self.sought = Sought(self.pattern)
        self.tail = None
        if by == "" and pattern.endswith("+$") and len(self.parsed) == 2 and self.parsed[1] == (sre.AT, sre.AT_END) and self.parsed[0][0] is sre.MAX_REPEAT:
            least, most, body = self.parsed[0][1]
            if least == 1 and most is sre.MAXREPEAT and len(body) == 1 and body[0][0] is sre.IN:
                self.tail = re.compile(pattern[:-2])

    def _with(self, alive: tuple[int, ...]) -> re.Pattern:
        """The pattern with some of its branches alone."""
        if alive not in self.cut_down:
            if len(self.cut_down) > 1000:
                self.cut_down.clear()
            i, branches, _ = self.branches
            state, items = self.parsed.state, list(self.parsed)
            group, on, off, _ = items[i][1]
            inner = _parser.SubPattern(state, [(sre.BRANCH, (None, [branches[k] for k in alive]))])
            items[i] = (sre.SUBPATTERN, (group, on, off, inner))
            self.cut_down[alive] = _compiler.compile(_parser.SubPattern(state, items), self.pattern.flags)
        return self.cut_down[alive]

    def matches(self, text: str, held: set[str]) -> list[re.Match]:
        """What ``re`` finds; ``held`` has all characters of the text."""
        if not _met(text, held, self.needs):
            return []
        if self.tail and not text.endswith("\n"):
            end = len(text)
            while end and self.tail.fullmatch(text, end - 1, end):
                end -= 1
            return [m] if end < len(text) and (m := self.pattern.match(text, end)) else []
        if self.branches:
            alive = tuple(i for i, needs in enumerate(self.branches[2]) if _met(text, held, needs))
            if not alive:
                return []
            if len(alive) < len(self.branches[1]):
                return list(self._with(alive).finditer(text))
        return list((self.sought if len(text) > self.SHORT else self.pattern).finditer(text))

    def replaced(self, match: re.Match) -> str:
        return match.expand(self.by) if "\\" in self.by else self.by

    def __call__(self, text: str, held: set[str]) -> str:
        out, at = [], 0
        for m in self.matches(text, held):
            out += [text[at : m.start()], self.replaced(m)]
            at = m.end()
        return "".join([*out, text[at:]])


@functools.cache
def _joining() -> frozenset[str]:
    """Characters that can compose or change places with what stands before them."""
    out = {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}
    for c in map(chr, range(0x300, 0x110000)):
        if unicodedata.combining(c):
            out.add(c)
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and parts[0][0] != "<":
            out.add(chr(int(parts[1], 16)))
    return frozenset(out)


def spliced(text: str, edits: list[tuple[int, int, str]]) -> str:
    """``nfkc_text`` of a text with stretches replaced, which is in that form itself: only places where parts meet can
    need a change, unless one begins with a character that joins the one before it."""
    out, at, last = [], 0, " "
    for start, stop, by in [*edits, (len(text), len(text), "")]:
        for part in (text[at:start], by):
            if not part:
                continue
            if part[0] >= "\u0300" and part[0] in _joining() or part is by and (not by.isascii() and not unicodedata.is_normalized("NFKC", by) or "  " in by or " ".join(by.split()) != by.strip(" ")):
                return nfkc_text("".join([*(x for a, b, y in _parts(text, edits) for x in (text[a:b], y))]))
            if part[0] == " " and last == " ":
                part = part.lstrip(" ")
            if part:
                out.append(part)
                last = part[-1]
        at = stop
    return "".join(out).rstrip(" ")


def _parts(text: str, edits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    ends = [0, *(stop for _, stop, _ in edits)]
    return [(a, start, by) for a, (start, _, by) in zip(ends, [*edits, (len(text), len(text), "")], strict=True)]


def cascade_text(text: str, rules: list[Rule]) -> str:
    """Every rule in order, each followed by NFKC and collapsing. Once that has been done, it is needed only where a rule has
    changed something, and ``held`` need not forget characters, which only rules out rules."""
    held, normal = set(text), False
    for rule in rules:
        if not normal:
            text, normal = nfkc_text(rule(text, held)), True
            held = set(text)
        elif matches := rule.matches(text, held):
            edits = [(m.start(), m.end(), rule.replaced(m)) for m in matches]
            text = spliced(text, edits)
            if any(by for _, _, by in edits) or len(text) < 64:
                held = set(text)
    return text


def _runs(columns: list[pa.Array], most: int, step: int = 1) -> Iterator[tuple[int, int]]:
    """First row and row after the last of runs of whole rows of about ``most`` bytes in the string columns, of a multiple of
    ``step`` rows but for the last; a longer row is one of its own."""
    n = len(columns[0])
    ends = np.zeros(n + 1, np.int64)
    for texts in columns:
        large = pa.types.is_large_string(texts.type)
        if n and (large or pa.types.is_string(texts.type)) and texts.buffers()[1] is not None:
            ends += np.frombuffer(texts.buffers()[1], np.int64 if large else np.int32)[texts.offset : texts.offset + n + 1]
    lo = 0
    while lo < n:
        # Rows count too, where texts are null or empty.
        rows = min(max(1, int(np.searchsorted(ends, int(ends[lo]) + most, side="right")) - 1 - lo), PIECE_ROWS)
        hi = min(lo + -(-rows // step) * step, n)
        yield lo, hi
        lo = hi


def pieces(texts: pa.Array) -> list[pa.Array]:
    """Runs of whole texts of about ``PIECE_BYTES``, in order."""
    return [texts.slice(lo, hi - lo) for lo, hi in _runs([texts], PIECE_BYTES)]


def frame_pieces(batch: pa.RecordBatch, texts: list[str], most: int = PIECE_BYTES, step: int = 1) -> Iterator[pa.RecordBatch]:
    """A batch's rows in runs by the bytes of its columns ``texts``."""
    return (batch.slice(lo, hi - lo) for lo, hi in _runs([batch.column(c) for c in texts], most, step))


def lists(rows: Iterable[list], kind: pa.DataType) -> pa.Array:
    """An array of lists, of which a few at a time are Python objects."""
    made = [pa.array(own, kind) for own in itertools.batched(rows, 16)]
    return pa.concat_arrays(made) if made else pa.array([], kind)


def _piece_stepped(texts: pa.Array, steps: list[Callable[[str], str] | Strip]) -> pa.Array:
    for whole, group in itertools.groupby(steps, lambda step: isinstance(step, Strip)):
        if whole:
            texts = functools.reduce(lambda x, step: step(x), group, texts)
        else:
            own = list(group)
            texts = pa.array([None if t is None else functools.reduce(lambda x, step: step(x), own, t) for t in texts.to_pylist()], pa.string())
    return texts


def stepped(texts: pa.Array, steps: list[Callable[[str], str] | Strip]) -> pa.Array:
    """Steps on a batch's texts in order, a piece at a time: the rest of the batch is held as its bytes alone, not as strings."""
    done = pa.concat_arrays([_piece_stepped(piece, steps) for piece in pieces(texts)] or [texts])
    pa.default_memory_pool().release_unused()
    return done


def chained(text: Column, steps: list[Callable[[str], str] | Strip]) -> Column:
    """Steps on texts in order, as one function; a ``Strip`` takes a whole piece of a batch at once."""

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return stepped(texts, steps)

    return run.asNondeterministic()(text)


def pieced(texts: list[Column], kind: T.StructType, work: Callable[..., list[pa.Array]]) -> Column:
    """A struct of what ``work`` makes of a piece of the columns' texts, all in one Python process; results go back to Spark piece by
    piece, so that of a batch only what came in is held whole."""
    names = [str(i) for i in range(len(texts))]

    @F.arrow_udf(kind)
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for whole in batches:
            whole = whole if isinstance(whole, tuple) else (whole,)
            for piece in frame_pieces(pa.RecordBatch.from_arrays(list(whole), names=names), names):
                yield pa.StructArray.from_arrays(work(*piece.columns), names=kind.names)
            pa.default_memory_pool().release_unused()

    return run.asNondeterministic()(*texts)


@dataclass(frozen=True)
class Between:
    """A step on rows: those stay whose article is as long as ``columns.length_between`` has it."""

    least: int = 0
    most: int = -1

    def __post_init__(self):
        columns.check_bounds(self.least, self.most)

    def __call__(self, articles: pa.Array) -> pa.Array:
        chars = pc.utf8_length(articles)
        kept = pc.greater_equal(chars, self.least)
        return pc.fill_null(kept if self.most == -1 else pc.and_(kept, pc.less_equal(chars, self.most)), False)


def cleaned_piece(title: pa.Array, article: pa.Array, steps: list[Callable[[str], str] | Strip | Between]) -> list[pa.Array]:
    """Titles and articles after all steps, and which rows stay; the texts of others are null from there on."""
    kept = pa.repeat(True, len(article))
    for bound, group in itertools.groupby(steps, lambda step: isinstance(step, Between)):
        own = list(group)
        if bound:
            kept = functools.reduce(lambda k, step: pc.and_(k, step(article)), own, kept)
            title, article = (pc.if_else(kept, x, pa.scalar(None, x.type)) for x in (title, article))
        else:
            title, article = (_piece_stepped(x, own) for x in (title, article))
    return [title, article, kept]


def cleaned(title: Column, article: Column, steps: list[Callable[[str], str] | Strip | Between], others: dict[str, Column] | None = None) -> Column:
    """A struct of title and article after all steps, of ``kept``, whether the row stays, and of ``others`` as ``nfkc_if_any`` has them."""
    others = others or {}
    kind = T.StructType([T.StructField(c, T.BooleanType() if c == "kept" else T.StringType()) for c in ("title", "article", "kept", *others)])
    return pieced([title, article, *others.values()], kind, lambda t, a, *more: [*cleaned_piece(t, a, steps), *(_piece_stepped(x, [_nfkc_if_any]) for x in more)])


def _mapped(function: Callable[[str], str]) -> Callable[[Column], Column]:
    return lambda text: chained(text, [function])


def nfkc(text: Column) -> Column:
    return _mapped(nfkc_text)(text)


def _nfkc_if_any(text: str) -> str:
    return nfkc_text(text) if text else text


def nfkc_if_any(text: Column) -> Column:
    """NFKC of texts that aren't null or empty; those stay as they are."""
    return _mapped(_nfkc_if_any)(text)


def strip_delimited(text: Column, left: str, right: str, by: str = "", keep: bool = False, unclosed: str = "reference") -> Column:
    return chained(text, [Strip(left, right, by, keep, unclosed)])


def mask_english(text: Column) -> Column:
    return _mapped(english_text)(text)


def mask_numbers(text: Column, tags: tuple[str, ...] = ()) -> Column:
    return _mapped(lambda t: number_text(t, tags))(text)


def mask_guillemets(text: Column, unclosed: str = "reference") -> Column:
    return strip_delimited(text, "《", "》", "<unk>", True, unclosed)


@functools.cache
def _compiled(rules: tuple[tuple[str, str], ...]) -> list[Rule]:
    return [Rule(p, by) for p, by in rules]


def rewrite(text: Column, rules: list[tuple[str, str]]) -> Column:
    """A whole cascade of (pattern, replacement) in one function."""
    return _mapped(lambda t: cascade_text(t, _compiled(tuple(rules))))(text)


def rewrites(text: Column, packs: dict[str, list[tuple[str, str]]]) -> Column:
    """A struct of the results of several cascades over the same text, of which a piece at a time is held."""

    def work(texts: pa.Array) -> list[pa.Array]:
        own = texts.to_pylist()
        held = [_compiled(tuple(rules)) for rules in packs.values()]
        return [pa.array([None if t is None else cascade_text(t, rules) for t in own], pa.string()) for rules in held]

    return pieced([text], T.StructType([T.StructField(name, T.StringType()) for name in packs]), work)
