"""Recognition of listed names: the longest name at the leftmost place, for whole batches at once.

Names are kept as a trie whose edges (node, code point) are one sorted array. All places of a batch step down the trie
together, a code point at a time; those without an edge drop out, and each keeps the last end of a name that it passed. Names
go to the executors in passes of bounded size; a place keeps the longest name over all passes.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrow import frame_pieces, lists
from ..schemas import TOKEN
from .entities import ARROW_TOKEN

#: Bytes of names in a pass, and code points of texts that step down together.
PASS_BYTES, AT_ONCE = 8 << 20, 1 << 18
_FOUND = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("size", T.IntegerType()), T.StructField("ner", T.StringType())]))
_ARROW_FOUND = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32()), ("ner", pa.string())]))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)


@dataclass
class Trie:
    """``edges`` are node << 21 | code point, sorted, and lead to node ``to``; ``name`` is a node's name or -1."""

    edges: np.ndarray
    to: np.ndarray
    name: np.ndarray
    first: np.ndarray

    @classmethod
    def build(cls, names: list[str]) -> Trie:
        """From distinct names that aren't empty. Level by level: a level's nodes are the distinct (node, code point) of its names."""
        flat, sizes = _points("".join(names)), np.fromiter(map(len, names), np.int64, len(names))
        at = np.cumsum(sizes) - sizes
        node, left, n_nodes = np.zeros(len(names), np.int64), np.arange(len(names)), 1
        edges, ends = [], [np.full(1, -1)]
        depth = 0
        while len(left):
            keys, which = np.unique(node[left] << 21 | flat[at[left] + depth], return_inverse=True)
            own = np.full(len(keys), -1)
            node[left] = n_nodes + which
            depth += 1
            done = sizes[left] == depth
            own[which[done]] = left[done]
            edges.append(keys)
            ends.append(own)
            n_nodes += len(keys)
            left = left[~done]
        made = np.concatenate(edges or [np.empty(0, np.int64)])
        order = np.argsort(made, kind="stable")
        first = np.full(0x110000, -1, np.int32)
        roots = made < 1 << 21
        first[made[roots]] = 1 + np.flatnonzero(roots)
        return cls(made[order], (1 + order).astype(np.int32), np.concatenate(ends).astype(np.int32), first)

    def longest(self, points: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places where a name begins, the longest one's length and which it is. ``ends``: where the text of each place ends."""
        at = np.flatnonzero(self.first[points] >= 0) if len(self.edges) else np.empty(0, np.int64)
        node = self.first[points[at]].astype(np.int64)
        size, best = np.zeros(len(at), np.int64), np.full(len(at), -1)
        going, step = np.arange(len(at)), 1
        while len(going):
            own = self.name[node]
            hit = own >= 0
            size[going[hit]], best[going[hit]] = step, own[hit]
            more = at[going] + step < ends[at[going]]
            going, node = going[more], node[more]
            key = node << 21 | points[at[going] + step]
            place = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            fits = self.edges[place] == key
            going, node = going[fits], self.to[place[fits]].astype(np.int64)
            step += 1
        some = best >= 0
        return at[some], size[some], best[some]


def _leftmost(found: list[tuple[int, int, str]], text: str) -> list[dict]:
    """Of the longest names at each place, in order, those that begin behind the one before."""
    out, done = [], 0
    for start, size, ner in found:
        if start >= done:
            out.append({"word": text[start : start + size], "ner": ner, "start": start, "end": start + size})
            done = start + size
    return out


def _search(shared: Broadcast, columns: list[str], texts: list[str], state: list[str], last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, kinds = shared.value
        for whole in batches:
            for batch in frame_pieces(whole, texts, AT_ONCE):
                arrays = []
                for text, kept in zip(texts, state, strict=True):
                    own = [t or "" for t in batch.column(text).to_pylist()]
                    known = batch.column(kept).to_pylist() if kept in batch.schema.names else [None] * len(own)
                    found = (_merged(new, [(x["start"], x["size"], x["ner"]) for x in old or []]) for new, old in zip(_places(trie, own, kinds), known, strict=True))
                    if last:
                        arrays.append(lists((_leftmost(f, t) for f, t in zip(found, own, strict=True)), ARROW_TOKEN))
                    else:
                        arrays.append(lists(([{"start": a, "size": n, "ner": k} for a, n, k in f] for f in found), _ARROW_FOUND))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *arrays], names=[*columns, *(f"{t}_tokens" if last else s for t, s in zip(texts, state, strict=True))])

    return run


def _places(trie: Trie, texts: list[str], kinds: list[str]) -> Iterator[list[tuple[int, int, str]]]:
    lo = 0
    while lo < len(texts):
        hi, size = lo + 1, len(texts[lo])
        while hi < len(texts) and size + len(texts[hi]) <= AT_ONCE:
            size += len(texts[hi])
            hi += 1
        sizes = np.fromiter(map(len, texts[lo:hi]), np.int64, hi - lo)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        at, length, which = trie.longest(_points("".join(texts[lo:hi])), np.repeat(bounds[1:], sizes))
        text = np.searchsorted(bounds, at, side="right") - 1
        cuts = np.searchsorted(text, np.arange(hi - lo + 1))
        rows = list(zip((at - bounds[text]).tolist(), length.tolist(), (kinds[k] for k in which.tolist()), strict=True))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield rows[a:b]
        lo = hi


def _merged(one: list[tuple[int, int, str]], two: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The longer one at each place; names differ between passes, so none are equal."""
    if not two:
        return one
    best: dict[int, tuple[int, int, str]] = {}
    for x in (*one, *two):
        if x[0] not in best or best[x[0]][1] < x[1]:
            best[x[0]] = x
    return [best[k] for k in sorted(best)]


def recognise_names(df: DataFrame, names: DataFrame, texts: tuple[str, ...] = ("title", "article"), pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``title_tokens`` and ``article_tokens`` (word, ner, start, end in code points) of the listed ``names`` (name, ner).

    At each place the longest name counts, and of names that overlap the one that begins first. A name with several classes has
    the least of them; null and empty names and names without a class are left out. Names are found inside words. Null
    texts are empty; texts of any length are searched whole. Names go out ``pass_bytes`` at a time; beyond that the texts are
    read once for each pass, and what earlier passes have found stays with the row. No other column's name clashes.
    """
    listed = names.filter("name is not null and name <> '' and ner is not null").groupBy("name").agg(F.min("ner").alias("ner"))
    size = listed.agg(F.sum(F.octet_length("name"))).first()[0] or 0
    passes = max(1, math.ceil(size / pass_bytes))
    state = [f"found_{uuid.uuid4().hex}" for _ in texts]
    out = [f"{t}_tokens" for t in texts]
    kept = [f for f in df.schema.fields if f.name not in out]
    for i in range(passes):
        own = listed.filter(F.pmod(F.xxhash64("name"), F.lit(passes)) == i).orderBy("name").collect()
        last = i == passes - 1
        fields = [T.StructField(n, TOKEN if last else _FOUND) for n in (out if last else state)]
        columns = [f.name for f in kept]
        shared = df.sparkSession.sparkContext.broadcast((Trie.build([r["name"] for r in own]), [r["ner"] for r in own]))
        df = df.mapInArrow(_search(shared, columns, list(texts), state, last), T.StructType([*kept, *fields]))
    return df
