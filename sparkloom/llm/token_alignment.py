"""Alignment of two tokenizers: which tokens of one overlap which of the other, and how often over a corpus.

Texts are cut before single spaces, where both tokenizers begin a token anyhow, so that each distinct piece of text of a
block is encoded and aligned once. Ends of tokens are running sums of their bytes; ends that both have cut a text into groups,
and repeats expand each token into its links. A block sends each pair of ids once, with its count; counts meet in two
salted stages. What they came to is sent back to the blocks, a row for each pair and block again, to be added up by text.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _bytes as tb
from ._shared import Scratch, shipped
from .token_counts import PATTERN

#: Bytes of text of a block; parts that a pair's counts are first summed in; pieces encoded at once.
BLOCK, SALTS, AT_ONCE = 1 << 22, 16, 20_000
MARK = "▁"
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_IDS = T.ArrayType(T.IntegerType(), False)
_WHITE = np.array([b <= 0x20 or b == 0x7F for b in range(256)])
#: First bytes of characters that may be white space beyond ASCII; no cut is made beside these.
_ODD = np.array([b in (0xC2, 0xE1, 0xE2, 0xE3) for b in range(256)])


def byte_names() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else one from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


class Table:
    """Byte strings by number."""

    def __init__(self, texts: list[bytes]):
        self.at = np.cumsum([0, *map(len, texts)])
        self.sizes = np.diff(self.at)
        self.buf = np.frombuffer(b"".join(texts), np.uint8)

    def gather(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        return self.buf[np.repeat(self.at[ids], sizes) + _runs(sizes)]


class Tokenizers:
    """A: byte-level BPE, by ranks; B: the SentencePiece model; and what the ids of both are in bytes."""

    def __init__(self, a_file: bytes, b_file: bytes):
        model = json.loads(a_file)["model"]
        names = byte_names()
        ranks = {bytes(names[c] for c in token): i for token, i in model["vocab"].items() if all(c in names for c in token)}
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != sorted(set(merged)):
            raise ValueError("ids don't follow the order of the merges")
        self.a = tiktoken.Encoding("aligned", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        by_id = {i: t for t, i in ranks.items()}
        self.a_bytes = Table([by_id.get(i, b"") for i in range(max(by_id) + 1)])
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        n = self.b.get_piece_size()
        self.b_bytes = Table([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(map(self.b.id_to_piece, range(n)))])
        pieces = [self.b.id_to_piece(i) for i in range(n) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        self.apart = not any(MARK in p.lstrip(MARK) for p in pieces)  # a piece never goes from a word over to the next
        written = [[f"{i},", f"{i}{end}"] for end, size in (("|", len(self.a_bytes.sizes)), (";", n)) for i in range(size)]
        self.written = pa.array([x for pair in written for x in pair], pa.large_binary())

    def encode(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of pieces, which begin with a space each; B puts that before a text by itself."""
        return [self.a.encode_ordinary(p) for p in pieces], self.b.encode([p[1:] for p in pieces], num_threads=1)


@functools.lru_cache(2)
def tokenizers(a_file: bytes, b_file: bytes) -> Tokenizers:
    return Tokenizers(a_file, b_file)


def _runs(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of ``sizes``."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of the runs of ``values`` that begin at ``at``."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[at[1:]] - total[at[:-1]]


def cut(buf: np.ndarray, offsets: np.ndarray, apart: bool) -> np.ndarray:
    """Where pieces begin in texts that have a space before them: there, and at single spaces between two that aren't white."""
    at = np.flatnonzero(buf[1:-1] == 0x20) + 1 if apart and len(buf) > 2 else np.empty(0, np.int64)
    odd = lambda d: _ODD[buf[np.maximum(at - d, 0)]]
    before, after = buf[at - 1], buf[np.minimum(at + 1, len(buf) - 1)]
    at = at[~(_WHITE[before] | _WHITE[after] | _ODD[after] | (before >= 0x80) & (odd(2) | odd(3)))]
    return np.union1d(at, offsets[:-1][np.diff(offsets) > 0])


@dataclass
class Alignment:
    """Of a block of texts: the pieces of each text (``pieces[first[i]:first[i + 1]]``, none where a text has no tokens), and by
    piece its tokens on both sides with their group in the piece, its counts, and its links as places in ``pairs``."""

    tools: Tokenizers
    pieces: np.ndarray
    first: np.ndarray
    a_ids: np.ndarray
    a_at: np.ndarray
    a_group: np.ndarray
    b_ids: np.ndarray
    b_at: np.ndarray
    b_group: np.ndarray
    counts: np.ndarray
    links: np.ndarray
    link_at: np.ndarray
    pairs: np.ndarray
    times: np.ndarray

    def by_text(self, of_pieces: np.ndarray) -> np.ndarray:
        return _sums(of_pieces[self.pieces], self.first)

    def written(self) -> pa.Array:
        """Each piece's groups as ``a1,a2|b1;`` with decimal ids."""
        n = len(self.a_bytes_sizes)
        of_a, of_b = (np.repeat(np.arange(len(at) - 1), np.diff(at)) for at in (self.a_at, self.b_at))
        first_group = np.concatenate([[0], np.cumsum(self.counts[:, 2])])
        ga, gb = first_group[of_a] + self.a_group, first_group[of_b] + self.b_group
        n_groups = int(first_group[-1])
        sizes = np.stack([np.bincount(ga, minlength=n_groups), np.bincount(gb, minlength=n_groups)], axis=1)
        starts = (np.cumsum(sizes.ravel()) - sizes.ravel()).reshape(-1, 2)
        line = np.empty(len(ga) + len(gb), np.int64)
        for side, (ids, g, base) in enumerate(((self.a_ids, ga, 0), (self.b_ids, gb, 2 * n))):
            last = np.ones(len(g), bool)
            last[:-1] = g[1:] != g[:-1]
            line[starts[g, side] + _runs(sizes[:, side])] = base + 2 * ids + last
        text = self.tools.written.take(pa.array(line))
        buf, at = tb.utf8(text)
        ends = np.concatenate([[0], np.cumsum(np.diff(self.a_at) + np.diff(self.b_at))])
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(at[ends].astype(np.int64)), pa.py_buffer(np.ascontiguousarray(buf))])

    @property
    def a_bytes_sizes(self) -> np.ndarray:
        return self.tools.a_bytes.sizes


def align(tools: Tokenizers, buf: np.ndarray, offsets: np.ndarray) -> Alignment:
    """Aligns texts, with a space put before each that isn't empty."""
    begins = cut(buf, offsets, tools.apart)
    at = np.append(begins, len(buf))
    coded = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(buf))).dictionary_encode()
    which = coded.indices.to_numpy().astype(np.int64)
    first = np.searchsorted(begins, offsets)
    # The most frequent pieces first: their numbers are small, and so are what blocks keep of them.
    order = np.argsort(-np.bincount(which, minlength=len(coded.dictionary)), kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    which, distinct = rank[which], coded.dictionary.take(pa.array(order))
    made = [[_flat(side) for side in tools.encode(distinct[i : i + AT_ONCE].to_pylist())] for i in range(0, len(distinct), AT_ONCE)]
    empty = np.empty(0, np.int64)
    (a_ids, a_sizes), (b_ids, b_sizes) = ([np.concatenate([m[side][j] for m in made] or [empty]) for j in (0, 1)] for side in (0, 1))
    text, text_at = tb.utf8(distinct)
    fit = _same(tools.a_bytes, a_ids, a_sizes, text, text_at) & _same(tools.b_bytes, b_ids, b_sizes, text, text_at)
    a_ids, b_ids = a_ids[np.repeat(fit, a_sizes)], b_ids[np.repeat(fit, b_sizes)]
    a_sizes, b_sizes = np.where(fit, a_sizes, 0), np.where(fit, b_sizes, 0)
    whole = _sums((~fit)[which].astype(np.int64), first) == 0
    used = np.repeat(whole, np.diff(first))
    pieces, first = which[used], np.concatenate([[0], np.cumsum(np.where(whole, np.diff(first), 0))])

    a_ends, b_ends = np.cumsum(tools.a_bytes.sizes[a_ids]), np.cumsum(tools.b_bytes.sizes[b_ids])
    a_at, b_at = np.concatenate([[0], np.cumsum(a_sizes)]), np.concatenate([[0], np.cumsum(b_sizes)])
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    piece_ends = np.cumsum(np.where(fit, np.diff(text_at), 0))
    groups = np.diff(np.searchsorted(common, np.concatenate([[0], piece_ends]), side="right"))
    group_at = np.cumsum(groups) - groups
    a_of, b_of = np.repeat(np.arange(len(fit)), a_sizes), np.repeat(np.arange(len(fit)), b_sizes)
    a_group, b_group = np.searchsorted(common, a_ends) - group_at[a_of], np.searchsorted(common, b_ends) - group_at[b_of]
    lo = np.searchsorted(b_ends, a_ends - tools.a_bytes.sizes[a_ids], side="right")
    n_links = np.searchsorted(b_ends, a_ends) - lo + 1
    keys = np.repeat(a_ids, n_links) << 32 | b_ids[np.repeat(lo, n_links) + _runs(n_links)]
    by_piece = _sums(n_links, a_at)
    times = np.bincount(pieces, minlength=len(fit))
    pairs, links = np.unique(keys, return_inverse=True)
    each = np.bincount(links, weights=np.repeat(times, by_piece), minlength=len(pairs)).astype(np.int64)
    order = np.argsort(-each, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    counts = np.stack([a_sizes, b_sizes, groups, by_piece], axis=1)
    return Alignment(
        tools, pieces, first, a_ids, a_at, a_group, b_ids, b_at, b_group, counts, rank[links], np.concatenate([[0], np.cumsum(by_piece)]), pairs[order], each[order]
    )


def _same(table: Table, ids: np.ndarray, sizes: np.ndarray, text: np.ndarray, text_at: np.ndarray) -> np.ndarray:
    """Of which pieces the ids' bytes are the text's."""
    at = np.concatenate([[0], np.cumsum(sizes)])
    fit = (_sums(table.sizes[ids], at) == np.diff(text_at)) & (_sums((table.sizes[ids] == 0).astype(np.int64), at) == 0)
    some = np.repeat(fit, np.diff(text_at))
    differ = np.zeros(len(text), np.int64)
    differ[some] = table.gather(ids[np.repeat(fit, sizes)]) != text[some]
    return fit & (_sums(differ, text_at) == 0)


Report = Callable[[Alignment], list[pa.Array]]
LISTS = T.StructType([T.StructField(n, _IDS) for n in ("a_ids", "b_ids", "a_groups", "b_groups")])
DIGEST = T.StructType([T.StructField("groups_sha256", T.StringType())])


def id_lists(of: Alignment) -> list[pa.Array]:
    """Ids of both sides, and the group that each token is in."""
    out: list[pa.Array] = []
    groups = of.counts[of.pieces, 2]
    starts = np.concatenate([[0], np.cumsum(groups)])[:-1]
    starts = starts - np.repeat(np.append(starts, 0)[of.first[:-1]], np.diff(of.first)) if len(starts) else starts
    for ids, at, group in ((of.a_ids, of.a_at, of.a_group), (of.b_ids, of.b_at, of.b_group)):
        sizes = np.diff(at)[of.pieces]
        line = np.repeat(at[of.pieces], sizes) + _runs(sizes)
        bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)])[of.first].astype(np.int32))
        out += [pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int32))) for x in (ids[line], group[line] + np.repeat(starts, sizes))]
    return [out[0], out[2], out[1], out[3]]


def digests(of: Alignment) -> list[pa.Array]:
    """The hex digest of each text's groups, written ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
    buf, at = tb.utf8(of.written().take(pa.array(of.pieces)))
    raw, ends = np.ascontiguousarray(buf).data, at[of.first].tolist()
    return [pa.array([hashlib.sha256(raw[a : b - 1]).hexdigest() if b > a else "" for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string())]


def _spaced(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of texts with a space before each that isn't empty."""
    buf, offsets = tb.utf8(column.cast(pa.large_string()))
    some = np.diff(offsets) > 0
    new = offsets + np.concatenate([[0], np.cumsum(some)])
    out = np.full(int(new[-1]), 0x20, np.uint8)
    keep = np.ones(len(out), bool)
    keep[new[:-1][some]] = False
    out[keep] = buf
    return out, new


_CODEC = "zstd"


def _packed(values: np.ndarray) -> bytes:
    raw = values.astype(np.uint32).tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec(_CODEC).compress(raw, asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(pa.Codec(_CODEC).decompress(raw[8:], int.from_bytes(raw[:8], "little"), asbytes=True), np.uint32).astype(np.int64)


_BLOCK = [
    T.StructField("pairs", T.ArrayType(T.LongType(), False)), T.StructField("times", T.ArrayType(T.LongType(), False)),
    *(T.StructField(n, T.BinaryType()) for n in ("pieces", "links", "link_at")),
]


def align_tokenizers(
    docs: DataFrame, a_path: str, b_path: str, columns: list[str] | None = None, report: Report = id_lists, reported: T.StructType = LISTS
) -> DataFrame:
    """For every row of ``docs`` (text, and what else is passed through): n_a, n_b, n_groups, n_links, n_best and count_sum (long), and
    what ``report`` makes of a block's texts (their ids and groups, unless another is given).

    A is the byte-level BPE of ``a_path`` (json) over a space and the text, B the SentencePiece model of ``b_path`` over the
    text; strings of special tokens are plain text. Tokens are linked where their bytes overlap. A pair of ids counts how many
    links of all rows have it; ``count_sum`` adds that up over a row's links, ``n_best`` counts the links whose
    count is the highest that their B id has with any A id. Null and empty texts, and those that the tokens' bytes don't
    give back (one with U+2581, say), have no tokens: zeros. Repeated rows count each time; an empty table gives none. A
    passed column named like a made one is replaced; no other name clashes.

    Blocks are written to the shared folder: rows without texts, and one row with the block's pairs and pieces, packed.
    A pair goes out once for each block that has it, so that even the most frequent one has no more rows than
    there are blocks. The highest counts of B's ids are broadcast, one for each piece of B's vocabulary at most.
    """
    spark = docs.sparkSession
    with open(a_path, "rb") as f, open(b_path, "rb") as g:
        files = shipped(spark, (f.read(), g.read()))
    made = [T.StructField(n, T.LongType()) for n in COUNTS] + list(reported.fields)
    last = [T.StructField(n, T.LongType()) for n in ("n_best", "count_sum")]
    names = {f.name for f in made + last}
    kept = [f for f in docs.schema.fields if f.name not in names and (columns is None or f.name in columns)]
    inner = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(kept)]
    head = [T.StructField("block", T.LongType()), T.StructField("nth", T.IntegerType()), T.StructField("n_pieces", T.IntegerType())]
    schema = T.StructType([*head, *inner, *(T.StructField(f"m{i}", f.dataType) for i, f in enumerate(made)), *_BLOCK])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = tokenizers(*files())
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            buf, offsets = _spaced(batch.column("text"))
            for lo, hi, part, own in tb.slices(buf, offsets, BLOCK):
                of = align(tools, part, own)
                rows = batch.slice(lo, hi - lo)
                n = hi - lo
                per = np.diff(of.first)
                arrays = [pa.array(np.full(n, block)), pa.array(np.arange(n, dtype=np.int32)), pa.array(per.astype(np.int32))]
                arrays += [rows.column(f"c{i}") for i in range(len(inner))]
                arrays += [pa.array(of.by_text(of.counts[:, i])) for i in range(len(COUNTS))] + report(of)
                kinds = [a.type for a in arrays]
                tail = [pa.list_(pa.int64())] * 2 + [pa.binary()] * 3
                yield pa.RecordBatch.from_arrays(arrays + [pa.nulls(n, t) for t in tail], names=schema.names)
                sums = [pa.array([x], t) for x, t in zip((of.pairs, of.times, _packed(of.pieces), _packed(of.links), _packed(of.link_at)), tail, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([block])] + [pa.nulls(1, t) for t in kinds[1:]] + sums, names=schema.names)
                block += 1

    scratch = Scratch(spark, "alignment")
    chosen = [F.col(f.name).alias(i.name) for f, i in zip(kept, inner, strict=True)]
    blocks = scratch.save(docs.select(*chosen, F.col("text")).mapInArrow(run, schema), "blocks")
    seen = scratch.save(pair_counts(blocks), "pairs")
    each = F.explode("pairs").alias("pair")
    asked = blocks.filter("pairs is not null").select(F.col("block").alias("asks"), each).join(seen.hint("merge"), "pair")

    n_inner, n_made = len(inner), len(made)
    final = T.StructType([*blocks.schema.fields[len(head) :][: n_inner + n_made], *(T.StructField(f"l{i}", f.dataType) for i, f in enumerate(last))])

    def answer(rows: pa.Table, counted: pa.Table) -> pa.Table:
        texts = rows.filter(pa.compute.is_valid(rows.column("nth"))).sort_by("nth")
        block = rows.filter(pa.compute.is_valid(rows.column("pairs")))
        first = np.concatenate([[0], np.cumsum(texts.column("n_pieces").to_numpy())]).astype(np.int64)
        pieces, links, link_at = (_unpacked(block.column(n)[0].as_py()) for n in ("pieces", "links", "link_at"))
        pairs = block.column("pairs").combine_chunks().flatten().to_numpy()
        known = counted.column("pair").to_numpy()
        order = np.argsort(known)
        place = order[np.searchsorted(known, pairs, sorter=order)] if len(pairs) else order
        sums = [_sums(_sums(counted.column(n).to_numpy()[place].astype(np.int64)[links], link_at)[pieces], first) for n in ("best", "times")]
        own = [texts.column(f.name) for f in final.fields[: n_inner + n_made]]
        return pa.Table.from_arrays([*own, *map(pa.array, sums)], names=final.names)

    done = blocks.groupBy("block").cogroup(asked.groupBy("asks")).applyInArrow(answer, final)
    return done.select(*(F.col(i.name).alias(f.name) for i, f in zip(final.fields, [*kept, *made, *last], strict=True)))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair`` (A id times 2**32 plus B id), ``times`` over all blocks, and ``best`` whether no pair of its B id has more."""
    flat = blocks.filter("pairs is not null").select("block", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    flat = flat.select(F.pmod(F.xxhash64("block"), F.lit(SALTS)).alias("salt"), F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    parts = flat.groupBy("pair", "salt").agg(F.sum("times").alias("times"))
    seen = Scratch(blocks.sparkSession, "pairs").save(parts.groupBy("pair").agg(F.sum("times").alias("times")), "sums")
    b_id = F.col("pair").bitwiseAND(0xFFFFFFFF)
    top = seen.groupBy(b_id.alias("b")).agg(F.max("times").alias("most"))
    return seen.join(F.broadcast(top), b_id == F.col("b")).select("pair", "times", (F.col("times") == F.col("most")).alias("best"))
