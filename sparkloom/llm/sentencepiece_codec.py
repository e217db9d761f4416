"""SentencePiece encoding and decoding by a batched Viterbi recursion in numpy.

Texts are cut into segments that no piece can span. Equal segments are encoded once for each batch, and segments of
equal length advance together: substring hashes probe the sorted piece keys, and vectorised maxima store
backpointers. A unigram model gains a piece's score at each step. A BPE model is defined by greedy merges; there a
step gains nothing if merging would leave the piece before it and this one side by side, and is ruled out else. Merges
across a border of two pieces depend on these two alone, so exactly one path is left, which is the merges' result.

That holds where equal scores are those of equal pieces. Segments that can hold a piece whose score another
piece has too, and those of over LONG characters, are merged one by one, with linked symbols and a heap.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import _bytes as tb
from ._frames import passed
from ._shared import shipped

MARK = "▁"
UNIGRAM, BPE = 1, 2
SLICE = 1 << 21
LONG = 48
#: Segments that advance together, at most.
ROWS = 20_000
#: A rank that no merge has.
NEVER = 1 << 30
MADE = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("n_tokens", T.LongType())])


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, raw[at : at + size]
            at += size


@dataclass
class Bigrams:
    """A set of pairs of characters."""

    ascii: np.ndarray
    other: np.ndarray

    @classmethod
    def of(cls, pairs: set[str]) -> Bigrams:
        table = np.zeros((128, 128), dtype=bool)
        for p in pairs:
            if p.isascii():
                table[ord(p[0]), ord(p[1])] = True
        return cls(table, np.sort(hash_all([p.encode() for p in sorted(pairs)])))


@dataclass
class Merges:
    """By place of a piece among the sorted keys: its rank (that of its score; -1 for a character), the two pieces that
    merge into it last, and whether merging its text gives it at all. ``pairs`` are left * n + right of all pieces that
    make a piece together, sorted, and ``makes`` the ranks of what they make."""

    rank: np.ndarray
    left: np.ndarray
    right: np.ndarray
    whole: np.ndarray
    pairs: np.ndarray
    makes: np.ndarray
    seen: np.ndarray = field(default_factory=lambda: np.full(1 << 18, -1, np.int64))
    held: np.ndarray = field(default_factory=lambda: np.zeros(1 << 18, bool))

    def stay(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves pieces ``a`` and ``b`` as they are where they stand side by side; answers are kept."""
        key = a * len(self.rank) + b
        slot = (tb.splitmix(key.astype(np.uint64)) >> np.uint64(46)).astype(np.int64)
        out, fresh = self.held[slot], np.flatnonzero(self.seen[slot] != key)
        if len(fresh):
            kinds, which = np.unique(key[fresh], return_inverse=True)
            answer = self._stay(kinds // len(self.rank), kinds % len(self.rank))[which]
            out[fresh] = answer
            self.seen[slot[fresh]], self.held[slot[fresh]] = key[fresh], answer
        return out

    def _stay(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undoes the merges of both from the last to the first; between two of them the pieces at the border were there,
        and would have merged if what they make came before the merge that is undone. Of equal ranks the left one is first.
        """
        out = np.ones(len(a), dtype=bool)
        rows, n = np.arange(len(a)), len(self.rank)
        limit = np.full(len(a), 2 * NEVER)
        while len(rows):
            key = a * n + b
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            made = np.where(self.pairs[at] == key, self.makes[at], NEVER)
            broken = 2 * made < limit
            out[rows[broken]] = False
            going = ~broken & ((self.rank[a] >= 0) | (self.rank[b] >= 0))
            rows, a, b = rows[going], a[going], b[going]
            right = self.rank[b] >= self.rank[a]
            limit = np.where(right, 2 * self.rank[b] + 1, 2 * self.rank[a])
            a, b = np.where(right, a, self.right[a]), np.where(right, self.left[b], b)
        return out


@dataclass
class Pieces:
    """The pieces that texts are made of, by sorted hash, and what ids stand for."""

    kind: int
    keys: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    joins: Bigrams
    tied: Bigrams
    merges: Merges | None
    ranks: dict[bytes, int]
    byte_ids: np.ndarray
    unknown: int
    longest: int
    out: np.ndarray
    out_at: np.ndarray

    @classmethod
    def load(cls, raw: bytes) -> Pieces:
        """From a ``.model`` file with the identity normaliser and a space put before each text."""
        kind, listed = UNIGRAM, []
        for number, value in _fields(raw):
            if number == 1:
                piece = dict(_fields(value))
                listed.append((piece.get(1, b"").decode(), float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]), piece.get(3, 1)))
            elif number == 2:
                kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3 and dict(_fields(value)).get(1, b"identity") != b"identity":
                raise ValueError("only models with the identity normaliser are supported")
        return cls.build(kind, listed)

    @classmethod
    def build(cls, kind: int, listed: list[tuple[str, float, int]]) -> Pieces:
        """From (piece, score, type) by id; types as in the format: 1 normal, 2 unknown, 3 control, 6 byte."""
        normal = [(p.replace(MARK, " ").encode(), s, i) for i, (p, s, t) in enumerate(listed) if t == 1]
        normal = [normal[i] for i in np.argsort(hash_all([p for p, _, _ in normal]))]
        byte_ids = np.full(256, -1, dtype=np.int32)
        for i, (p, _, t) in enumerate(listed):
            if t == 6:
                byte_ids[int(p[3:5], 16)] = i
        unknown = next((i for i, (_, _, t) in enumerate(listed) if t == 2), 0)
        texts = [p.replace(MARK, " ").encode() if t == 1 else bytes([int(p[3:5], 16)]) if t == 6 else " ⁇ ".encode() if t == 2 else b"" for p, _, t in listed]
        chars = [p.decode() for p, _, _ in normal]
        falling = {s: rank for rank, s in enumerate(sorted({s for _, s, _ in normal}, reverse=True))}
        ranks = {p: falling[s] for p, s, _ in normal}
        merges, tied = _merges(ranks) if kind == BPE else (None, set())
        return cls(
            kind, hash_all([p for p, _, _ in normal]), np.array([i for _, _, i in normal], np.int32), np.array([s for _, s, _ in normal]),
            Bigrams.of({c[i : i + 2] for c in chars for i in range(len(c) - 1)}), Bigrams.of(tied), merges, ranks,
            byte_ids, unknown, max(map(len, chars), default=1), np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]),
        )

    def probe(self, hashes: np.ndarray) -> np.ndarray:
        """Place among the sorted keys, or -1."""
        if not len(self.keys):
            return np.full(hashes.shape, -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)


def hash_all(texts: list[bytes]) -> np.ndarray:
    ends = np.cumsum([0, *map(len, texts)])
    return tb.range_hashes(np.frombuffer(b"".join(texts), np.uint8), ends[:-1], ends[1:])


def merged(ranks: dict[bytes, int], parts: list[bytes]) -> tuple[list[bytes], int]:
    """Greedy merges of ``parts``, the best rank first and of equal ones the leftmost, and the size of the last merge's left part.

    Symbols are linked and pairs wait in a heap, so time grows with n log n.
    """
    n = len(parts)
    parts, after, before = list(parts), list(range(1, n + 1)), list(range(-1, n - 1))
    waiting = [ranks.get(parts[i] + parts[i + 1], NEVER) for i in range(n - 1)] + [NEVER] * min(n, 1)
    heap = [r << 32 | i for i, r in enumerate(waiting) if r < NEVER]
    heapq.heapify(heap)
    last = 0

    def renew(i: int) -> None:
        j = after[i]
        waiting[i] = ranks.get(parts[i] + parts[j], NEVER) if j < n else NEVER
        if waiting[i] < NEVER:
            heapq.heappush(heap, waiting[i] << 32 | i)

    while heap:
        rank, i = divmod(heapq.heappop(heap), 1 << 32)
        if waiting[i] != rank:
            continue
        j = after[i]
        last = len(parts[i])
        parts[i] += parts[j]
        after[i], waiting[j], parts[j] = after[j], NEVER, b""
        if after[i] < n:
            before[after[i]] = i
        renew(i)
        if before[i] >= 0:
            renew(before[i])
    return [p for p in parts if p], last


def _merges(ranks: dict[bytes, int]) -> tuple[Merges, set[str]]:
    """How pieces (in the order of ``ranks``) merge, and the first two characters of those that have no rank of their own, or
    not one behind those of their parts, on which the recursion doesn't rely."""
    names = list(ranks)
    place = {p: i for i, p in enumerate(names)}
    rank, left, right, whole, tied = [], [], [], [], set()
    pairs, shared = [], {}
    for p in names:
        shared.setdefault(ranks[p], []).append(p)
    for p in names:
        text = p.decode()
        single = len(text) == 1
        done, at = merged(ranks, [c.encode() for c in text])
        parts = [place.get(p[:at], -1), place.get(p[at:], -1)] if not single and len(done) == 1 else [-1, -1]
        whole.append(single or len(done) == 1)
        rank.append(-1 if single else ranks[p])
        left.append(parts[0])
        right.append(parts[1])
        if not single and (len(shared[ranks[p]]) > 1 or whole[-1] and (min(parts) < 0 or any(len(x.decode()) > 1 and ranks[x] >= ranks[p] for x in (p[:at], p[at:])))):
            tied.add(text[:2])
        for cut in range(1, len(text)):
            a, b = place.get(text[:cut].encode()), place.get(text[cut:].encode())
            if a is not None and b is not None:
                pairs.append((a * len(names) + b, ranks[p]))
    keys, makes = np.array(sorted(pairs) or [(-1, NEVER)], np.int64).T
    return Merges(np.array(rank, np.int64), np.array(left, np.int64), np.array(right, np.int64), np.array(whole, bool), np.ascontiguousarray(keys), np.ascontiguousarray(makes)), tied


def _runs(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of ``sizes``."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def encode(pieces: Pieces, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after another, and where each text's begin. Spaces are to be put before texts already."""
    n = len(buf)
    if not n:
        return np.empty(0, np.int32), np.zeros(len(offsets), np.int64)
    sums, down = tb.prefix_sums(buf)
    chars = np.flatnonzero((buf & 0xC0) != 0x80)
    char_ends = np.append(chars[1:], n)
    def pairs_in(bigrams: Bigrams) -> np.ndarray:
        """Which neighbouring characters are a pair of the set."""
        a, b = buf[chars[:-1]], buf[chars[1:]]
        ascii_ = (a < 128) & (b < 128)
        out = bigrams.ascii[a & 127, b & 127] & ascii_
        other = np.flatnonzero(~ascii_)
        if len(other) and len(bigrams.other):
            h = tb.ranged(sums, down, chars[other], char_ends[other + 1])
            out[other] = bigrams.other[np.minimum(np.searchsorted(bigrams.other, h), len(bigrams.other) - 1)] == h
        return out

    # Cut between neighbouring characters that no piece holds side by side, and between texts.
    cut = np.ones(len(chars), dtype=bool)
    cut[1:] = ~pairs_in(pieces.joins)
    cut[np.searchsorted(chars, offsets[:-1][offsets[:-1] < n])] = True
    first = np.flatnonzero(cut)
    sizes = np.diff(np.append(first, len(chars)))
    starts, ends = chars[first], np.append(chars[first[1:]], n)
    _, kinds, which = np.unique(tb.ranged(sums, down, starts, ends), return_index=True, return_inverse=True)
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    alone = np.zeros(len(kinds), dtype=bool)
    if pieces.kind == BPE:
        ties = np.concatenate([[0], np.cumsum(pairs_in(pieces.tied)), [0]])
        lo, hi = first[kinds], first[kinds] + sizes[kinds] - 1
        alone = (sizes[kinds] > LONG) | (ties[hi] > ties[lo])
    for size in np.unique(sizes[kinds[~alone]]).tolist():
        own = np.flatnonzero((sizes[kinds] == size) & ~alone)
        at = first[kinds[own]]
        edges = np.concatenate([chars[at[:, None] + np.arange(size)], char_ends[at + size - 1][:, None]], axis=1)
        for lo in range(0, len(own), ROWS):
            left = own[lo : lo + ROWS]
            for rows, begins, stops in _viterbi(pieces, sums, down, edges[lo : lo + ROWS]):
                if begins is None:
                    alone[left[rows]] = True
                else:
                    parts.append((left[rows], begins, stops))
    for kind in np.flatnonzero(alone).tolist():
        at = first[kinds[kind]] + np.arange(sizes[kinds[kind]])
        raw, base = buf[chars[at[0]] : char_ends[at[-1]]].tobytes(), int(chars[at[0]])
        places = (chars[at] - base).tolist() + [len(raw)]
        done, _ = merged(pieces.ranks, [raw[a:b] for a, b in zip(places, places[1:], strict=False)])
        stops = base + np.cumsum([0, *map(len, done)])
        parts.append((np.array([kind]), stops[None, :-1], stops[None, 1:]))
    flat_of, flat_ids = [], []
    for own, lo, hi in parts:
        per = np.repeat(own, lo.shape[1])
        lo, hi = lo.ravel(), hi.ravel()
        at = pieces.probe(tb.ranged(sums, down, lo, hi))
        width = np.where(at >= 0, 1, hi - lo)
        ids = np.repeat(np.where(at >= 0, pieces.ids[at], pieces.unknown).astype(np.int32), width)
        fallen = np.flatnonzero(np.repeat(at < 0, width))
        if len(fallen):
            ids[fallen] = pieces.byte_ids[buf[(np.repeat(lo, width) + _runs(width))[fallen]]]
            if (ids < 0).any():  # without byte pieces an unknown character is one id
                starting = np.flatnonzero(_runs(width) == 0)
                ids, width = np.where(ids < 0, pieces.unknown, ids)[starting], np.ones(len(lo), np.int64)
        flat_ids.append(ids)
        flat_of.append(np.repeat(per, width))
    of, ids = np.concatenate(flat_of), np.concatenate(flat_ids)
    order = np.argsort(of, kind="stable")
    ids = ids[order]
    counts = np.bincount(of, minlength=len(kinds))
    begins = np.cumsum(counts) - counts
    per = counts[which]
    out = ids[np.repeat(begins[which], per) + _runs(per)]
    ends_at = np.concatenate([[0], np.cumsum(per)])
    return out, ends_at[np.searchsorted(starts, offsets)]


def _viterbi(pieces: Pieces, sums: np.ndarray, down: np.ndarray, edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray | None, np.ndarray | None]]:
    """Best paths of segments with as many characters each; yields (rows, starts, ends), by number of pieces, and rows
    without a path, which only a BPE model can have, with None."""
    n, size = len(edges), edges.shape[1] - 1
    total = np.full((n, size + 1), -np.inf)
    total[:, 0] = 0
    back = np.zeros((n, size + 1), np.int64)
    last = np.full((n, size + 1), -1)
    lost = (pieces.scores.min() if len(pieces.scores) else 0.0) - 10
    line = np.arange(n)
    for end in range(1, size + 1):
        begins = np.arange(max(0, end - pieces.longest), end)
        at = pieces.probe(tb.ranged(sums, down, edges[:, begins], edges[:, end][:, None]))
        if pieces.merges is None:
            gain = np.where(at >= 0, pieces.scores[at] if len(pieces.scores) else 0.0, -np.inf)
            gain[:, -1] = np.where(at[:, -1] >= 0, gain[:, -1], lost)
        else:
            gain = np.full(at.shape, -np.inf)
            fits = (at >= 0) & pieces.merges.whole[at] & (total[:, begins] > -np.inf)
            if begins[0] == 0:
                gain[fits[:, 0], 0] = 0.0
                fits[:, 0] = False
            row, col = np.nonzero(fits)
            if len(row):
                gain[row, col] = np.where(pieces.merges.stay(last[row, begins[col]], at[row, col]), 0.0, -np.inf)
        reach = total[:, begins] + gain
        best = reach.argmax(axis=1)
        total[:, end], back[:, end], last[:, end] = reach[line, best], begins[best], at[line, best]
    stops = np.zeros((n, size + 1), dtype=bool)
    at = np.full(n, size)
    for _ in range(size + 1):
        stops[line, at] = True
        at = back[line, at]
    sizes = np.where(total[:, size] > -np.inf, stops.sum(axis=1), 0)
    for k in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == k)
        if not k:
            yield rows, None, None
            continue
        ends = edges[rows][stops[rows]].reshape(len(rows), k)
        yield rows, ends[:, :-1], ends[:, 1:]


def decode(pieces: Pieces, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts that id sequences stand for, without the space put before each."""
    sizes = np.diff(pieces.out_at)[ids]
    buf = pieces.out[np.repeat(pieces.out_at[ids], sizes) + _runs(sizes)]
    offsets = np.concatenate([[0], np.cumsum(sizes)])[first]
    spaced = offsets[:-1][(np.diff(offsets) > 0)]
    spaced = spaced[buf[spaced] == 32]
    keep = np.ones(len(buf), dtype=bool)
    keep[spaced] = False
    return buf[keep], offsets - np.searchsorted(spaced, offsets)


def spaced(column: pa.Array) -> pa.Array:
    """Texts as models see them: marks are spaces, and a space stands before each text that isn't empty."""
    column = pc.replace_substring(pc.fill_null(column, ""), MARK, " ")
    return pc.if_else(pc.equal(column, ""), "", pc.binary_join_element_wise(pa.scalar(" ", column.type), column, pa.scalar("", column.type)))


def encode_batches(batches: Iterator[pa.RecordBatch], pieces: Pieces) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with their ids and where each row's begin."""
    for batch in batches:
        column = spaced(batch.column("text").cast(pa.large_string()))
        buf, offsets = tb.utf8(column)
        for lo, hi, part, own in tb.slices(buf, offsets, SLICE):
            ids, first = encode(pieces, part, own)
            yield batch.slice(lo, hi - lo), ids, first


def _encode(shared, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, first in encode_batches(batches, shared()):
            made = [pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids)), pa.array(np.diff(first))]
            yield pa.RecordBatch.from_arrays([rows.column(c) for c in columns] + made, names=columns + MADE.names)

    return run


def _decode(shared, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: Pieces = shared()
        for batch in batches:
            lists = pc.fill_null(batch.column("ids"), pa.scalar([], batch.column("ids").type)) if batch.column("ids").null_count else batch.column("ids")
            sizes = lists.value_lengths().to_numpy()
            first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            buf, offsets = decode(pieces, lists.flatten().to_numpy(), first)
            texts = [buf[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + [pa.array(texts, pa.string())], names=[*columns, "text"])

    return run


def load_model(spark, model_path: str):
    """A function for tasks that returns the model, which is read once on the driver; it is some megabytes at most."""
    with open(model_path, "rb") as f:
        return shipped(spark, Pieces.load(f.read()))


def sentencepiece_encode(docs: DataFrame, model_path: str, columns: list[str] | None = None) -> DataFrame:
    """``ids`` and ``n_tokens`` for every row of ``docs`` (text, and what else is passed through), as the library encodes.

    Null and empty texts have no id. U+2581 in a text is the model's own mark for a space and counts as one.
    Rows are taken one by one; a passed column named like a made one is replaced.
    """
    kept, schema = passed(docs, columns, MADE)
    return docs.select(*dict.fromkeys([*kept, "text"])).mapInArrow(_encode(load_model(docs.sparkSession, model_path), kept), schema)


def sentencepiece_decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``text`` for every row of ``encoded`` (ids, and what else is passed through); null ids give an empty text.

    Bytes that aren't UTF-8, which encoded texts never give, are replaced by U+FFFD.
    """
    made = T.StructType([T.StructField("text", T.StringType())])
    kept, schema = passed(encoded, None, made)
    kept = [c for c in kept if c != "ids"]
    schema = T.StructType([f for f in schema.fields if f.name != "ids"])
    return encoded.mapInArrow(_decode(load_model(encoded.sparkSession, model_path), kept), schema)
