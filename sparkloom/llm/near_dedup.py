"""MinHash near-duplicates through a multi-index Hamming join.

Each distinct shingle set gets a signature of ``CHUNKS * WIDTH`` MinHash symbols of b = 8 bits. Two
signatures that differ in at most ``2 * CHUNKS - 1`` symbols have, by the pigeonhole principle, a chunk
with at most one differing symbol; each chunk is therefore looked up once for each place of its one
allowed error, as a key of the other symbols. The join thus finds *every* pair under that distance.
At a Jaccard similarity of 0.8 a symbol differs with probability 0.2: a pair of exactly that similarity
is further apart than 39 of 100 symbols once in about 500,000 pairs, a closer pair more rarely still.
Every link is confirmed on the full shingle sets.

Groups of copies cost no pairs: equal sets are one node; a bucket links its members to one centre, and
then those still apart to another. Members of buckets that are in several parts even then meet by size-sorted
prefixes: with shingles in one fixed order, the rarest first, two sets of that similarity, the smaller one y, share a
shingle among the first n - ceil(s n) + 1 of the larger and the first m - ceil(2 s m / (1 + s)) + 1 of y. Pages of
one template that differ in a ninth of their shingles thus never meet, however many they are. Where sets do meet, it
is in blocks that emit near pairs alone, and not within the largest part.
Beside the symbols each signature has the parities of its shingles in ``PARITY_BITS`` cells. Each
shingle that only one of two sets has flips one cell, so the cells that differ bound the symmetric
difference from below and rule out, without error, most near pairs that aren't links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bytes as tb
from ._shared import Scratch, shipped
from .components import connected_components

CHUNKS, WIDTH = 20, 5
SYMBOLS = CHUNKS * WIDTH
MOST_APART = 2 * CHUNKS - 1
PARITY_BITS = 2048
#: Bytes of the symbols, padded to whole 64-bit words, and of a signature.
PADDED = -(-SYMBOLS // 8) * 8
SIGNATURE = PADDED + PARITY_BITS // 8
BLOCK = 1024
#: Cells in which shingles are counted, to tell rare from frequent ones.
CELLS = 1 << 18
#: Ids up to this count (about 32 MB as a hash table) are broadcast to pick texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000

_SEEDS = tb.splitmix(np.arange(1, 2 * SYMBOLS + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_MUL = (_SEEDS[:SYMBOLS] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_ADD = (_SEEDS[SYMBOLS:] >> np.uint64(32)).astype(np.uint32)


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct k-word shingle hashes of each text, one after another, and where each text's begin."""
    low = tb.LOWER[buf]
    starts, ends, first = tb.spans(low, offsets, tb.NOT_SPACE)
    words = tb.range_hashes(low, starts, ends)
    chained = tb.chain(words, k)
    sets, sizes = [], np.zeros(len(offsets), dtype=np.int64)
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        if b - a >= k:
            own = np.unique(chained[a : b - k + 1])
        elif b > a:
            own = tb.chain(words[a:b], b - a)
        else:
            continue
        sets.append(own)
        sizes[i + 1] = len(own)
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), np.cumsum(sizes)


def signatures(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash symbols and parities of the non-empty sets that ``first`` bounds."""
    x = (sets >> np.uint64(32)).astype(np.uint32)
    out = np.zeros((len(first) - 1, SIGNATURE), dtype=np.uint8)
    for j in range(SYMBOLS):
        v = x * _MUL[j] + _ADD[j]
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x2C1B3C6D)
        out[:, j] = np.minimum.reduceat(v, first[:-1]) & np.uint32(0xFF)
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    cells = np.bincount(rows * PARITY_BITS + (sets & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=(len(first) - 1) * PARITY_BITS)
    out[:, PADDED:] = np.packbits((cells & 1).astype(np.uint8).reshape(-1, PARITY_BITS), axis=1)
    return out


def bucket_keys(sig: np.ndarray) -> np.ndarray:
    """For each signature the ``CHUNKS * WIDTH`` keys: chunk, place of the allowed error, the other symbols."""
    parts = sig.reshape(len(sig), CHUNKS, WIDTH).astype(np.int64)
    keys = np.empty((len(sig), CHUNKS, WIDTH), dtype=np.int64)
    for gap in range(WIDTH):
        value = np.zeros((len(sig), CHUNKS), dtype=np.int64)
        for j in range(WIDTH):
            if j != gap:
                value = (value << 8) | parts[:, :, j]
        keys[:, :, gap] = (value << 8) | (np.arange(CHUNKS) * WIDTH + gap)
    return keys.reshape(len(sig), SYMBOLS)


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as one binary value."""
    raw = np.ascontiguousarray(rows)
    width = raw.shape[1] * raw.itemsize
    offsets = np.arange(len(raw) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def _matrix(column: pa.Array, width: int, kind=np.uint8) -> np.ndarray:
    buf, _ = tb.utf8(column)
    return np.frombuffer(np.ascontiguousarray(buf).data, dtype=kind).reshape(-1, width)


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = tb.utf8(batch.column("text"))
            ids = batch.column("doc_id")
            for lo, hi, part, own in tb.slices(buf, offsets):
                sets, first = shingle_sets(part, own, k)
                sizes = np.diff(first)
                some = np.flatnonzero(sizes)
                edges = np.append(first[some], len(sets))
                sig = np.zeros((hi - lo, SIGNATURE), dtype=np.uint8)
                marks = np.zeros((hi - lo, 2), dtype=np.uint64)
                if len(some):
                    sig[some] = signatures(sets, edges)
                    marks[some, 0] = np.add.reduceat(sets, edges[:-1])
                    marks[some, 1] = np.add.reduceat(tb.splitmix(sets + np.uint64(0x632BE59BD9B4E019)), edges[:-1])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(sizes), pa.array(marks[:, 0].view(np.int64)), pa.array(marks[:, 1].view(np.int64)), _binary(sig)],
                    names=["doc_id", "n_shingles", "h1", "h2", "sig"],
                )

    return run


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            keys = bucket_keys(_matrix(part.column("sig"), SIGNATURE)[:, :SYMBOLS])
            every = np.repeat(np.arange(part.num_rows), SYMBOLS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), part.column("rep").take(pa.array(every)), part.column("n").take(pa.array(every))], names=["key", "rep", "n"]
            )


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = tb.utf8(batch.column("text"))
            for lo, hi, part, own in tb.slices(buf, offsets):
                sets, first = shingle_sets(part, own, k)
                blob = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer((first * 8).astype(np.int32)), pa.py_buffer(sets)])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), blob], names=["doc_id", "shingles"])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = np.zeros(batch.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(batch.column("shingles_u"), batch.column("shingles_v"), strict=True)):
                a, b = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
                both = np.concatenate([a, b])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                hit[i] = 100 * common >= percent * (len(a) + len(b) - common)
            yield batch.select(["u", "v"]).filter(pa.array(hit))

    return run


def _words(column: pa.Array) -> np.ndarray:
    """Signatures as rows of 64-bit words."""
    return _matrix(column, SIGNATURE).view(np.uint64)


def _may_link(a: np.ndarray, b: np.ndarray, both: np.ndarray, percent: int) -> np.ndarray:
    """Whether signatures are within the distance and their parities allow a link of sets of ``both`` shingles together.

    Symbols that differ are counted as the non-zero bytes of the words' exclusive or. A similarity of at least
    s means a symmetric difference of at most both * (1 - s) / (1 + s).
    """
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    x = a[..., : PADDED // 8] ^ b[..., : PADDED // 8]
    apart = np.bitwise_count((((x & low) + low) | x) & ~low).sum(axis=-1, dtype=np.int64)
    flipped = np.bitwise_count(a[..., PADDED // 8 :] ^ b[..., PADDED // 8 :]).sum(axis=-1, dtype=np.int64)
    return (apart <= MOST_APART) & (flipped * (100 + percent) <= both * (100 - percent))


def _near(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column("n").to_numpy() + batch.column("n_v").to_numpy()
            near = _may_link(_words(batch.column("sig_u")), _words(batch.column("sig_v")), both, percent)
            yield batch.select(["u", "v"]).filter(pa.array(near))

    return run


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(CELLS, np.int64)
    for batch in batches:
        buf, _ = tb.utf8(batch.column("shingles"))
        counts += np.bincount(_cell(np.frombuffer(np.ascontiguousarray(buf).data, np.uint64)), minlength=CELLS)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["cell", "n"])


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def _prefixes(percent: int, counts):
    """A row for each shingle of a set's prefix; ``tells`` for those of the prefix that counts for the smaller set.

    Keys are those of a shingle and a band of sizes: a set tells in its own band and asks in this and the one below,
    in which all smaller sets are that could be linked with it. Bands are a little wider than the sizes allow.
    """
    width = np.log(100.001 / percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = counts()
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                keys, sizes, tells = [], [], []
                for blob in part.column("shingles"):
                    own = np.frombuffer(blob.as_buffer(), np.uint64)
                    n = len(own)
                    asking, telling = n + (-percent * n) // 100 + 1, n + (-2 * percent * n) // (100 + percent) + 1
                    keys.append(own[np.lexsort((own, often[_cell(own)]))[:asking]])
                    sizes.append(asking)
                    tells.append(np.arange(asking) < telling)
                if keys:
                    every = pa.array(np.repeat(np.arange(part.num_rows), sizes))
                    band = (np.log(part.column("n").to_numpy()) / width).astype(np.int64)[every]
                    shingles, telling = np.concatenate(keys), np.concatenate(tells).astype(np.int64)
                    for below in (0, 1):
                        own = tb.splitmix(shingles + tb.splitmix((band - below).view(np.uint64)))
                        made = [pa.array(own.view(np.int64)), *(part.column(c).take(every) for c in ("rep", "n", "component")), pa.array(telling * (1 - below))]
                        yield pa.RecordBatch.from_arrays(made, names=["key", "rep", "n", "component", "tells"])

    return run


def _block_pairs(percent: int):
    """Of each key's block of larger sets, which ask, and smaller ones, which tell: the pairs that are near and apart.

    The rows come sorted by block; a block that a batch cuts waits for the next batch.
    """

    def pairs(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        asks = table.column("asks").to_numpy().astype(bool)
        ids, comp, n = (table.column(c).to_numpy() for c in ("rep", "component", "n"))
        sig = _words(table.column("sig"))
        edges = np.append(_block_starts(table), len(ids))
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            few, many = lo + np.flatnonzero(asks[lo:hi]), lo + np.flatnonzero(~asks[lo:hi])
            if turned := len(few) > len(many):
                few, many = many, few
            for i in few if len(many) else ():
                larger, smaller = (n[many], n[i]) if turned else (n[i], n[many])
                others = many[(comp[many] != comp[i]) & (smaller <= larger) & (100 * smaller >= percent * larger)]
                others = others[_may_link(sig[others], sig[i], n[others] + n[i], percent)]
                if len(others):
                    yield np.full(len(others), ids[i]), ids[others]

    def out(table: pa.Table) -> pa.RecordBatch:
        found = list(pairs(table))
        u, v = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 2
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v), pa.int64()), pa.array(np.minimum(u, v), pa.int64())], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            table = pa.Table.from_batches([*waiting, batch])
            cut = int(_block_starts(table)[-1]) if table.num_rows else 0
            if cut:
                yield out(table.slice(0, cut))
            waiting = table.slice(cut).to_batches()
        if waiting:
            yield out(pa.Table.from_batches(waiting))

    return run


def _block_starts(table: pa.Table) -> np.ndarray:
    key, ask, told = (table.column(c).to_numpy() for c in ("key", "ask", "told"))
    return np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (ask[1:] != ask[:-1]) | (told[1:] != told[:-1])])[: len(key)])


def _meetings(prefixes: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """Near pairs (u, v) of sets in different parts that a shingle of their prefixes brings together.

    Of a shingle's sets those outside its largest part ask all that tell, and those in it only the ones outside.
    """
    parts = prefixes.groupBy("key", "component").agg(F.count("*").alias("asks"), F.sum("tells").alias("tells"))
    keys = parts.groupBy("key").agg(F.max(F.struct("asks", "component", "tells")).alias("top"), F.sum("asks").alias("asks"), F.sum("tells").alias("tells"), F.count("*").alias("parts"))
    keys = keys.filter("parts > 1 and tells > 0").select(
        "key",
        F.col("top.component").alias("top"),
        F.array(F.struct((F.col("asks") - F.col("top.asks")).alias("asks"), F.col("tells").alias("tells")), F.struct(F.col("top.asks").alias("asks"), (F.col("tells") - F.col("top.tells")).alias("tells"))).alias("sizes"),
    )
    rows = prefixes.join(keys, "key").withColumn("in_top", (F.col("component") == F.col("top")).cast("int"))
    asking = rows.withColumn("phase", F.col("in_top")).withColumn("asks", F.lit(1))
    telling = rows.filter("tells = 1").withColumn("phase", F.explode(F.when(F.col("in_top") == 1, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1))))).withColumn("asks", F.lit(0))
    rows = asking.unionByName(telling).withColumn("size", F.get("sizes", F.col("phase"))).filter("size.asks > 0 and size.tells > 0")
    rows = rows.withColumn("ask_blocks", F.expr(f"size.asks div {BLOCK} + 1")).withColumn("told_blocks", F.expr(f"size.tells div {BLOCK} + 1"))
    rows = rows.withColumn("own", F.expr("if(asks = 1, pmod(xxhash64(rep, 7), ask_blocks), pmod(xxhash64(rep, 11), told_blocks))"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0L, if(asks = 1, told_blocks, ask_blocks) - 1)")))
    rows = rows.withColumn("ask", F.expr("2 * if(asks = 1, own, other) + phase")).withColumn("told", F.expr("if(asks = 1, other, own)"))
    blocks = rows.select("key", "ask", "told", "rep", "n", "component", "asks").join(signatures, "rep").repartition("key", "ask", "told").sortWithinPartitions("key", "ask", "told")
    return blocks.mapInArrow(_block_pairs(percent), "u long, v long").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text).

    Two texts are linked when their sets of distinct k-word shingles have a Jaccard similarity of at least
    ``percent`` / 100; component_id is the least doc_id reachable over links, and the row with that id is kept.
    A text of fewer than k words has its whole word sequence as its one shingle; a null or wordless text
    has no shingle and stays alone. Repeated rows are copies of each other. A row without doc_id
    joins no group: its component_id is null and it is not kept. Other columns of ``docs`` are ignored.
    A doc_id must stand for one text: where several texts share one, links are confirmed on the set of any of
    them, so that callers give such rows ids of their own first.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = scratch.save(docs.mapInArrow(_sign(k), "doc_id long, n_shingles long, h1 long, h2 long, sig binary"), "signed")

    nodes = signed.filter("n_shingles > 0 and doc_id is not null").groupBy("h1", "h2", F.col("n_shingles").alias("n")).agg(F.min(F.struct("doc_id", "sig")).alias("least"))
    nodes = scratch.save(nodes.select("h1", "h2", "n", F.col("least.doc_id").alias("rep"), F.col("least.sig").alias("sig")), "nodes")

    keys = nodes.select("rep", "n", "sig").mapInArrow(_keys, "key long, rep long, n long")
    buckets = keys.groupBy("key").agg(F.min("rep").alias("centre"), F.count("*").alias("size")).filter("size > 1")
    members = scratch.save(keys.join(buckets, "key"), "members")

    def bounded(ids: DataFrame) -> DataFrame:
        """Broadcast where their number, which is counted, allows it."""
        return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    found = bounded(members.select("rep").distinct())
    sets = scratch.save(docs.join(found.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi").mapInArrow(_sets(k), "doc_id long, shingles binary").dropDuplicates(["doc_id"]), "sets")

    def linked(pairs: DataFrame) -> DataFrame:
        """Near pairs whose sets are as similar as wanted; only the sets that they name are shuffled."""
        pairs = scratch.save(pairs, "near")
        ids = pairs.select(F.col("u").alias("doc_id")).union(pairs.select("v")).distinct()
        own = sets.join(bounded(ids), "doc_id", "left_semi")
        for end in ("u", "v"):
            pairs = pairs.join(own.select(F.col("doc_id").alias(end), F.col("shingles").alias(f"shingles_{end}")), end)
        return pairs.mapInArrow(_confirm(percent), "u long, v long")

    def confirmed(pairs: DataFrame) -> DataFrame:
        close = pairs.join(nodes.select(F.col("rep").alias("u"), F.col("sig").alias("sig_u")), "u").join(nodes.select(F.col("rep").alias("v"), F.col("sig").alias("sig_v")), "v").mapInArrow(_near(percent), "u long, v long")
        return linked(close)

    sizes = nodes.select(F.col("rep").alias("v"), F.col("n").alias("n_v"))

    def fitting(pairs: DataFrame) -> DataFrame:
        """Distinct pairs whose set sizes allow the similarity."""
        return pairs.distinct().join(sizes, "v").filter(F.expr(f"100 * least(n, n_v) >= {percent} * greatest(n, n_v)"))

    def joined(components: DataFrame, more: DataFrame) -> DataFrame:
        more = scratch.save(more, "more")
        if more.isEmpty():
            return components
        return scratch.save(connected_components(components.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more), scratch), "components")

    stars = members.filter("rep <> centre").select(F.col("rep").alias("u"), F.col("centre").alias("v"), "n")
    components = scratch.save(connected_components(confirmed(fitting(stars)), scratch), "components")

    def labelled() -> DataFrame:
        """Members of larger buckets with the part that they are in."""
        labels = components.select(F.col("node").alias("rep"), "component")
        return members.filter("size > 2").select("key", "rep", "n").join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep"))

    def open_keys(apart: DataFrame) -> DataFrame:
        """Buckets in several parts, with a member to be the next centre."""
        return apart.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.min(F.struct(F.xxhash64("rep", "key"), "rep", "component")).alias("pick")).filter("a <> b")

    # Members of a bucket that the first centre left apart: another centre, then all that are still apart by their prefixes.
    apart = labelled()
    stars = apart.join(open_keys(apart).select("key", "pick"), "key").filter("component <> pick.component").select(F.col("rep").alias("u"), F.col("pick.rep").alias("v"), "n")
    components = joined(components, confirmed(fitting(stars)))

    apart = labelled()
    still = scratch.save(apart.join(open_keys(apart).select("key"), "key").select("rep", "n", "component").distinct(), "still")
    if not still.isEmpty():
        own = sets.withColumnRenamed("doc_id", "rep").join(bounded(still), "rep")
        often = np.zeros(CELLS, np.int64)
        for row in own.select("shingles").mapInArrow(_cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
            often[row["cell"]] = row["n"]
        prefixes = own.mapInArrow(_prefixes(percent, shipped(spark, often)), "key long, rep long, n long, component long, tells long")
        prefixes = scratch.save(prefixes, "prefixes")
        signatures = nodes.select("rep", "sig").join(bounded(still.select("rep")), "rep", "left_semi")
        components = joined(components, linked(_meetings(prefixes, signatures, percent)))

    labels = nodes.select("h1", "h2", F.col("n").alias("n_shingles"), "rep").join(components.withColumnRenamed("node", "rep"), "rep", "left").select("h1", "h2", "n_shingles", F.coalesce("component", "rep").alias("found"))
    out = signed.select("doc_id", "n_shingles", "h1", "h2").join(labels, ["h1", "h2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))
