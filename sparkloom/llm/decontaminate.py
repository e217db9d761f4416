"""Benchmark decontamination by Wu-Manber search over words.

The patterns are windows of benchmark words. A shift table, keyed by the hash of the block of two words that ends at
a position, tells how far the search may move on. Where it says none, the block's hash selects a bucket of test
strings, those of them that begin with the same block as the window here are picked, and their bytes are compared
with the text's. The search runs over many stretches of text in step.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _bytes as tb
from ._frames import passed
from ._shared import Scratch, shipped

WINDOW = 13
#: Contaminated from one hit word in this many.
SHARE = 20
#: Benchmark bytes searched for in one pass; a larger benchmark takes more passes.
PASS_BYTES = 16 << 20
STRETCH = 1024
#: Bytes of windows that are compared at a time.
COMPARED = 4 << 20
MADE = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.LongType())),
        T.StructField("contaminated", T.BooleanType()),
    ]
)


class Words:
    """Lower-cased words of texts: their hashes, their bytes with a space after each, and where each begins."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        low = tb.LOWER[buf]
        starts, ends, self.first = tb.spans(low, offsets, tb.ALNUM)
        self.hashes = tb.range_hashes(low, starts, ends)
        sizes = ends - starts
        self.at = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.raw = np.full(self.at[-1], 32, dtype=np.uint8)
        self.raw[np.repeat(self.at[:-1] - starts, sizes) + np.flatnonzero(tb.ALNUM[low])] = low[tb.ALNUM[low]]

    def blocks(self, at: np.ndarray, block: int) -> np.ndarray:
        """Hashes of the blocks that end with the words at ``at``."""
        if block == 1:
            return self.hashes[at]
        return tb.splitmix(self.hashes[at - 1] * np.uint64(0xD1342543DE82EF95) + self.hashes[at])


def _runs(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of ``sizes``."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def equal_windows(a: Words, at: np.ndarray, b: Words, other: np.ndarray, k: int) -> np.ndarray:
    """Whether the ``k`` words from ``at`` on in ``a`` are, byte by byte, those from ``other`` on in ``b``."""
    sizes = a.at[at + k] - a.at[at]
    same = sizes == b.at[other + k] - b.at[other]
    left = np.flatnonzero(same)
    ends = np.cumsum(sizes[left])
    lo = 0
    while lo < len(left):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + COMPARED, side="right")))
        rows = left[lo:hi]
        steps, n = _runs(sizes[rows]), sizes[rows]
        agree = a.raw[np.repeat(a.at[at[rows]], n) + steps] == b.raw[np.repeat(b.at[other[rows]], n) + steps]
        same[rows] = np.logical_and.reduceat(agree, np.cumsum(n) - n)
        lo = hi
    return same


def _bound(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
    """In each stretch from ``lo`` to ``hi`` of ``values``, sorted there, the first place not before ``wanted``, or behind it."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        middle = np.where(open_, (lo + hi) // 2, 0)
        right = (values[middle] <= wanted if after else values[middle] < wanted) & open_
        lo = np.where(right, middle + 1, lo)
        hi = np.where(open_ & ~right, middle, hi)
    return lo


class Patterns:
    """The windows of one length: the shift table, and buckets of test strings by the hash of their last block."""

    def __init__(self, words: Words, starts: np.ndarray, items: np.ndarray, length: int):
        """``starts`` are first words of windows, which stand in ``items``; equal windows become one pattern."""
        self.words, self.length, self.block = words, length, min(2, length)
        chained = tb.chain(words.hashes, length)[starts]
        _, one, which = np.unique(chained, return_index=True, return_inverse=True)
        alike = equal_windows(words, starts, words, starts[one][which], length)
        which[~alike] = len(one) + np.arange((~alike).sum())  # hashes that meet by chance: patterns of their own
        firsts = np.concatenate([starts[one], starts[~alike]])
        suffix, prefix = words.blocks(firsts + length - 1, self.block), words.blocks(firsts + self.block - 1, self.block)
        order = np.lexsort((prefix, suffix))
        self.firsts, suffix, self.prefixes = firsts[order], suffix[order], prefix[order]
        self.suffixes, begins = np.unique(suffix, return_index=True)
        self.begins = np.append(begins, len(suffix))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        pairs = np.unique(np.stack([place[which], items], axis=1), axis=0)
        self.items, self.items_at = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(order) + 1))
        bits = max(12, math.ceil(math.log2(len(firsts) * length + 1)) + 3)
        self.right = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, min(length - self.block + 1, 127), dtype=np.int8)
        for end in range(self.block - 1, length):
            cells = (words.blocks(firsts + end, self.block) >> self.right).astype(np.int64)
            np.minimum.at(self.shift, cells, np.int8(min(length - 1 - end, 127)))

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Last word and pattern of each occurrence."""
        a, b = words.first[:-1] + self.length - 1, words.first[1:]
        long = a < b
        a, b = a[long], b[long]
        counts = -(-(b - a) // STRETCH)
        at = np.repeat(a, counts) + STRETCH * _runs(counts)
        end = np.minimum(at + STRETCH, np.repeat(b, counts))
        stops = []
        while len(at):
            move = self.shift[(words.blocks(at, self.block) >> self.right).astype(np.int64)]
            stops.append(at[move == 0])
            at = at + np.maximum(move, 1)
            going = at < end
            at, end = at[going], end[going]
        stop = np.concatenate(stops) if stops else np.empty(0, np.int64)
        if not len(stop):
            return stop, stop
        suffix = words.blocks(stop, self.block)
        bucket = np.minimum(np.searchsorted(self.suffixes, suffix), len(self.suffixes) - 1)
        some = self.suffixes[bucket] == suffix
        stop, bucket = stop[some], bucket[some]
        prefix = words.blocks(stop - self.length + self.block, self.block)
        lo, hi = self.begins[bucket], self.begins[bucket + 1]
        lo, hi = _bound(self.prefixes, lo, hi, prefix, False), _bound(self.prefixes, lo, hi, prefix, True)
        stop, pattern = np.repeat(stop, hi - lo), np.repeat(lo, hi - lo) + _runs(hi - lo)
        exact = equal_windows(words, stop - self.length + 1, self.words, self.firsts[pattern], self.length)
        return stop[exact], pattern[exact]


def build_patterns(ids: list[int], texts: list[str | None]) -> list[Patterns]:
    words = Words(*tb.utf8(pa.array(texts, pa.large_string())))
    first, sizes, ids = words.first[:-1], np.diff(words.first), np.array(ids, np.int64)
    length = np.minimum(sizes, WINDOW)
    out = []
    for k in np.unique(length[length > 0]).tolist():
        own = np.flatnonzero(length == k)
        per = sizes[own] - k + 1
        out.append(Patterns(words, np.repeat(first[own], per) + _runs(per), np.repeat(ids[own], per), k))
    return out


def _search(shared, columns: list[str], kind: pa.DataType, state: list[str], last: bool):
    """``state``: the columns that passes before this one have left; their names are no passed column's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns, ids = shared()
        for batch in batches:
            buf, offsets = tb.utf8(batch.column("text"))
            before = state[0] in batch.schema.names
            for lo, hi, part, own in tb.slices(buf, offsets):
                words = Words(part, own)
                first = words.first
                hit = np.zeros(first[-1] + 1, dtype=bool)
                items: list[set[int] | set[str]] = [set() for _ in range(hi - lo)]
                if before:
                    known, ends = tb.utf8(batch.column(state[0]).slice(lo, hi - lo))
                    hit[: len(known)] = known
                    items = [set(x or ()) for x in batch.column(state[1]).slice(lo, hi - lo).to_pylist()]
                for p in patterns:
                    stop, pattern = p.find(words)
                    for back in range(p.length):
                        hit[stop - back] = True
                    texts = np.searchsorted(first, stop, side="right") - 1
                    for text, k in {*zip(texts.tolist(), pattern.tolist(), strict=True)}:
                        items[text].update(ids[i] for i in p.items[p.items_at[k] : p.items_at[k + 1]].tolist())
                rows = [batch.column(c).slice(lo, hi - lo) for c in columns]
                if last:
                    total = np.zeros(len(hit) + 1, dtype=np.int64)
                    np.cumsum(hit, out=total[1:])
                    n_words, n_hit = np.diff(first), total[first[1:]] - total[first[:-1]]
                    made = [pa.array(n_words), pa.array(n_hit), pa.array([sorted(x, key=str) for x in items], pa.list_(kind)), pa.array((n_hit > 0) & (SHARE * n_hit >= n_words))]
                else:
                    made = [pa.array([hit[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary()), pa.array([sorted(x) for x in items], pa.list_(kind))]
                yield pa.RecordBatch.from_arrays(rows + made, names=columns + (MADE.names if last else state))

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """n_words, n_hit, items and contaminated for every row of ``docs`` (text, and what else is passed through).

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A window is 13 consecutive words of a
    benchmark item (item_id, text), or all its words where it has fewer; an item without a word has none. A
    document's word inside any occurrence is hit; ``items`` are the items whose windows occur, by their ids
    as strings (longs where ``item_id`` is a whole number, else strings); contaminated from one hit word in twenty. Null texts have no word and aren't contaminated;
    benchmark rows without item_id are left out; rows of one item_id count as one item. The benchmark goes to the
    executors PASS_BYTES at a time; a larger one is searched for in several passes over the documents. Rows of ``docs``
    are taken one by one, repeated ones too; a passed column named like a made one is replaced, and
    no other name clashes; without rows there is none. Texts of any length are searched whole.
    """
    spark = docs.sparkSession
    own = benchmark.schema["item_id"].dataType
    of = T.LongType() if isinstance(own, T.IntegralType) else T.StringType()
    kind = pa.int64() if isinstance(own, T.IntegralType) else pa.string()
    listed = T.ArrayType(of)
    kept, schema = passed(docs, columns, T.StructType([T.StructField(f.name, listed) if f.name == "items" else f for f in MADE.fields]))
    items = benchmark.select(F.col("item_id").cast(of).alias("item_id"), "text").filter("item_id is not null")
    passes = max(1, math.ceil((items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / PASS_BYTES))
    scratch = Scratch(spark, "decontaminate") if passes > 1 else None
    frame = docs.select(*dict.fromkeys([*kept, "text"]))
    through = [c for c in frame.columns]
    state = [f"{n}_{uuid.uuid4().hex}" for n in ("hits", "items")]
    left = T.StructType([*(docs.schema[c] for c in through), T.StructField(state[0], T.BinaryType()), T.StructField(state[1], listed)])
    for i in range(passes):
        part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == i).orderBy("item_id", "text").collect()
        ids = sorted({r[0] for r in part})
        place = {x: j for j, x in enumerate(ids)}
        shared = shipped(spark, (build_patterns([place[r[0]] for r in part], [r[1] for r in part]), ids))
        if i == passes - 1:
            return frame.mapInArrow(_search(shared, kept, kind, state, True), schema)
        frame = scratch.save(frame.mapInArrow(_search(shared, through, kind, state, False), left))
    raise AssertionError
