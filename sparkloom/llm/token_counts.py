"""Edit-aware token counts.

A document is cut into pre-tokens by the tokenizer's pattern; LEAF of them make a leaf of a segment tree, whose nodes hold
the code points and tokens below them. Trees are a column: ``build_trees`` makes them once, ``edit_trees`` takes them
with edits and gives them back renewed, encoding only leaves that an edit touches, from LEAD code points before it
to the first leaf behind it that begins where a pre-token ends: from there on the pattern, which never looks back, cuts
as before. Only the sums on the paths from these leaves to the root change.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._frames import passed
from ._shared import shipped

#: Pre-tokens of a new leaf; code points that the pattern looks ahead, at most.
LEAF, LEAD = 64, 3
CACHE = 200_000
#: The pre-token pattern of the byte-level BPE vocabularies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
EDIT = T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("removed", T.IntegerType()), T.StructField("added", T.StringType())]))
TREE = T.StructType([T.StructField("chars", T.ArrayType(T.LongType(), False)), T.StructField("tokens", T.ArrayType(T.LongType(), False))])
BUILT = T.StructType([T.StructField("tree", TREE), T.StructField("n_tokens", T.LongType())])
MADE = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("tree", TREE), *(T.StructField(n, T.LongType()) for n in ("n_tokens_before", "n_tokens", "n_leaves", "reencoded_chars"))]
)


class Counter:
    """Token counts of pre-tokens, with those seen lately kept."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.encoding = tiktoken.Encoding("counted", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.find = regex.compile(pattern).findall
        self.at = regex.compile(pattern).match
        self.known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        known = self.known
        out = [known.get(p) for p in pieces]
        if None in out:
            if len(known) > CACHE:
                known.clear()
            for i, n in enumerate(out):
                if n is None:
                    p = pieces[i]
                    out[i] = known[p] = len(self.encoding.encode_ordinary(p))
        return out


class CountTree:
    """Sums over leaves: node i has the children 2 i and 2 i + 1, node 1 is the root, the second half of the nodes are the leaves."""

    def __init__(self, counter: Counter, text: str, chars: list[int] | None = None, tokens: list[int] | None = None):
        """A new tree, or the kept one of ``text`` that ``chars`` and ``tokens`` are the sums of."""
        self.counter = counter
        if chars is None or tokens is None:
            self._grow(*self._leaves(counter.find(text), 0))
            return
        self.chars, self.tokens = list(chars), list(tokens)
        ends = list(accumulate(self.chars[len(self.chars) // 2 :]))
        self.leaves = [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _leaves(self, pieces: list[str], least: int) -> tuple[list[str], list[int]]:
        """Texts and token counts of leaves that hold ``pieces``; ``least`` of them where that leaves none with over 2 LEAF."""
        n = least if len(pieces) <= 2 * LEAF * least else -(-len(pieces) // LEAF)
        cuts = [len(pieces) * i // n for i in range(n + 1)] if n else [0]
        counts = self.counter.counts(pieces)
        return ["".join(pieces[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], [sum(counts[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]

    def _grow(self, leaves: list[str], tokens: list[int]) -> None:
        size = 1 << max(len(leaves) - 1, 0).bit_length()
        spare = size - len(leaves)
        self.leaves = leaves + [""] * spare
        self.chars, self.tokens = [0] * size + [*map(len, self.leaves)], [0] * size + tokens + [0] * spare
        self._renew(range(size, 2 * size))

    def _renew(self, nodes: Iterable[int]) -> None:
        """Sums above ``nodes``, which are neighbours of one level."""
        lo, hi = min(nodes) // 2, max(nodes) // 2
        while lo:
            for i in range(lo, hi + 1):
                self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
                self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]
            lo, hi = lo // 2, hi // 2

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    @property
    def total(self) -> int:
        return self.tokens[1]

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds the code point ``at``, or the last one, and where it begins."""
        node, start = 1, 0
        while node < len(self.leaves):
            node *= 2
            if at - start >= self.chars[node]:
                start += self.chars[node]
                node += 1
        return node - len(self.leaves), start

    def edit(self, at: int, removed: int, added: str) -> int:
        """Replaces ``removed`` code points from ``at`` on by ``added``; returns the code points encoded anew."""
        n = len(self.leaves)
        at = min(max(at, 0), self.chars[1])
        tail = min(at + max(removed, 0), self.chars[1])
        # A pre-token sees at most two code points behind its end, so those that end LEAD before the edit stay.
        lo, start = self._find(max(at - LEAD, 0))
        hi = self._find(tail)[0] + 1
        old = "".join(self.leaves[lo:hi])
        text = old[: at - start] + added + old[tail - start :]
        border, ahead, step, here, pieces = len(text), hi, 1, 0, []
        while True:
            while border < here:
                border += len(self.leaves[hi])
                hi += 1
            if here == border and (here or hi == n) or here == len(text) and ahead == n:
                break
            piece = self.counter.at(text, here)
            if ahead < n and (piece is None or piece.end() + LEAD > len(text)):
                text += "".join(self.leaves[ahead : ahead + step])
                ahead, step = min(ahead + step, n), 2 * step
                continue
            pieces.append(piece.group())
            here = piece.end()
        leaves, tokens = self._leaves(pieces, hi - lo)
        if len(leaves) == hi - lo:
            self.leaves[lo:hi], self.chars[n + lo : n + hi], self.tokens[n + lo : n + hi] = leaves, map(len, leaves), tokens
            self._renew(range(n + lo, n + hi))
        else:
            self._grow(self.leaves[:lo] + leaves + self.leaves[hi:], self.tokens[n : n + lo] + tokens + self.tokens[n + hi :])
        return here


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


_NODES = pa.struct([("chars", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))])
ROWS = 1000


def _build(shared, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared())
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                trees = [CountTree(counter, text.as_py() or "") for text in part.column("text")]
                made = [pa.array([(t.chars, t.tokens) for t in trees], _NODES), pa.array([t.total for t in trees], pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in columns] + made, names=columns + BUILT.names)

    return run


def _edit(shared, columns: list[str]):
    kinds = (pa.string(), _NODES, *[pa.int64()] * 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared())
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                made = []
                for text, kept, edits in zip(part.column("text"), part.column("tree"), part.column("edits"), strict=True):
                    kept = kept.as_py() or {}
                    tree = CountTree(counter, text.as_py() or "", kept.get("chars"), kept.get("tokens"))
                    before = tree.total
                    anew = sum(tree.edit(e["at"] or 0, e["removed"] or 0, e["added"] or "") for e in (edits.as_py() or ()) if e is not None)
                    made.append((tree.text, (tree.chars, tree.tokens), before, tree.total, len(tree.leaves), anew))
                own = [pa.array(x, t) for x, t in zip(zip(*made, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in columns] + own, names=columns + MADE.names)

    return run


def build_trees(docs: DataFrame, vocabulary: str, columns: list[str] | None = None) -> DataFrame:
    """``tree`` and ``n_tokens`` for every row of ``docs`` (text, and what else is passed through, the text too if named or all is).

    Null texts are empty. Rows are taken one by one, repeated ones too; a passed column named like a made one is
    replaced; a table without rows gives none.
    """
    kept, schema = passed(docs, columns, BUILT)
    rows = docs.select(*dict.fromkeys([*kept, "text"]))
    return rows.mapInArrow(_build(shipped(docs.sparkSession, load_ranks(vocabulary)), kept), schema)


def edit_trees(docs: DataFrame, vocabulary: str, columns: list[str] | None = None) -> DataFrame:
    """Texts, trees and counts after the edits of every row of ``docs`` (text, tree, edits, and what else is passed through).

    ``edits`` is an array of (at, removed, added) in code points, applied in order to the text as it then is; places
    outside the text are moved to its ends, nulls count as 0 or empty. Null texts are empty, null edits none; for a null
    tree one is built. The edited ``text`` and ``tree`` come back, with n_leaves and the code points that edits
    encoded anew. Rows are taken one by one, repeated ones too; a passed column named like a made one is replaced;
    a table without rows gives none.
    """
    kept, schema = passed(docs, columns, MADE)
    kept = [c for c in kept if c != "edits"]
    schema = T.StructType([f for f in schema.fields if f.name != "edits"])
    rows = docs.withColumn("edits", F.col("edits").cast(EDIT)).select(*dict.fromkeys([*kept, "text", "tree", "edits"]))
    return rows.mapInArrow(_edit(shipped(docs.sparkSession, load_ranks(vocabulary)), kept), schema)


def count_edited(docs: DataFrame, vocabulary: str, columns: list[str] | None = None) -> DataFrame:
    """``edit_trees`` of ``docs`` (text, edits, and what else is passed through) with trees made for the purpose."""
    return edit_trees(build_trees(docs, vocabulary), vocabulary, columns)
