"""Line dedup over levelled sorted runs of line hashes.

Documents come in batches. A batch's keys (hashes of lines) are counted and merge-anti-joined with the runs so far:
those that no run has are stored as a sorted run of their own, the others only as updates of counts. When a level
has FANOUT runs they are compacted into one of the next level. A key thus stands in one run, with what its first batch
held, and in an update for each later batch that has it. Runs are bucketed and sorted by the key, so that joins
don't shuffle them; all are tables in the shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._frames import passed
from ._shared import Scratch

#: (line, document) rows of a batch, and bounds of the number of batches.
BATCH_LINES, LEAST_BATCHES, MOST_BATCHES = 4_000_000, 2, 8
FANOUT = 2
#: Lines held by over this share of all (line, document) rows are fewer than its inverse; they are broadcast.
HOT_SHARE = 1 / 1000
_KEY = ["h1", "h2"]
MADE = T.StructType([T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_text", T.StringType())])


def line_key(line: bytes) -> bytes:
    """The line without outer ``[\\x20\\x09-\\x0D]``, with A-Z lower-cased (as ``bytes`` does both)."""
    return line.strip(b" \t\n\v\f\r").lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= 4 * least or (len(key) >= least and len(key.decode()) >= least)


def _hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _lines(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                own = {_hash(k) for k in {line_key(x) for x in raw.split(b"\n")} if _long_enough(k, least)}
                ids += [doc] * len(own)
                hashes += own
            halves = np.frombuffer(b"".join(hashes), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(ids, pa.int64())], names=[*_KEY, "doc_id"])

    return run


def _apply(columns: list[str], gone_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            for text, gone in zip(batch.column("text"), batch.column(gone_name), strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                total = raw.count(b"\n") + 1
                if gone.is_valid and len(gone):
                    out = {a.to_bytes(8, "little", signed=True) + b.to_bytes(8, "little", signed=True) for a, b in ((x["h1"], x["h2"]) for x in gone.as_py())}
                    left = [x for x in raw.split(b"\n") if _hash(line_key(x)) not in out]
                    n_dropped.append(total - len(left))
                    raw = b"\n".join(left)
                else:
                    n_dropped.append(0)
                n_lines.append(total)
                kept.append(raw.decode())
            made = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + made, names=columns + MADE.names)

    return run


class LineRuns:
    """Levels of sorted runs (h1, h2, n_docs, top_doc), each key in one run, and updates of the same form."""

    def __init__(self, scratch: Scratch, fanout: int = FANOUT):
        self.scratch, self.fanout, self.levels, self.updates = scratch, fanout, [[]], []
        self.buckets = max(1, int(scratch.spark.conf.get("spark.sql.shuffle.partitions")))

    def _save(self, df: DataFrame, name: str) -> DataFrame:
        return self.scratch.save_bucketed(df, name, _KEY, self.buckets)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> None:
        """A batch of (h1, h2, doc_id). No document may come in two batches."""
        own = lines.groupBy(*_KEY, "doc_id").count().groupBy(*_KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("top_doc"))
        self._compact()
        if not (runs := self.runs()):
            self.levels[0].append(self._save(own, "run"))
            return
        own = self._save(own, "batch")
        fresh = self._save(reduce(lambda left, run: left.join(run.select(*_KEY), _KEY, "left_anti"), runs, own), "run")
        # Updates aren't bucketed: Spark 4.1 sums over a union of bucketed tables without a shuffle, and then reads them unbucketed.
        self.updates.append(self.scratch.save(own.join(fresh.select(*_KEY), _KEY, "left_anti"), "update"))
        self.levels[0].append(fresh)
        self.scratch.drop(own)

    def _compact(self) -> None:
        """Full levels become one run of the next; no key is in two runs, so rows are merged as they are."""
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fanout:
                old, self.levels[level] = self.levels[level], []
                merged = self._save(reduce(DataFrame.union, old).repartition(self.buckets, *_KEY), "run")
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(merged)
                for x in old:
                    self.scratch.drop(x)
            level += 1

    def keys(self) -> DataFrame:
        """Every key with its figures over all batches."""
        runs = self.runs()
        if not self.updates:
            return reduce(DataFrame.union, runs)
        more = reduce(DataFrame.union, self.updates).groupBy(*_KEY).agg(F.sum("n_docs").alias("more"), F.max("top_doc").alias("later"))
        more = self._save(more, "more")
        whole = [run.join(more, _KEY, "left").select(*_KEY, (F.col("n_docs") + F.coalesce("more", F.lit(0))).alias("n_docs"), F.greatest("top_doc", "later").alias("top_doc")) for run in runs]
        return reduce(DataFrame.union, whole)

    def drop(self) -> None:
        for x in [*self.runs(), *self.updates]:
            self.scratch.drop(x)


def line_dedup(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, columns: list[str] | None = None) -> DataFrame:
    """n_lines, n_dropped and kept_text for every row of ``docs`` (doc_id, text, and what else is passed through).

    Lines are split at newlines; a null or empty text is one empty line. Keys (lines stripped of outer white
    space, A-Z lower-cased) of ``least_chars`` code points, held by ``least_docs`` different doc_ids, lose all
    their lines except in the largest doc_id that holds them; the other lines stay, joined by newlines.
    Rows of one doc_id count as one document. A row without doc_id neither counts nor loses lines. An empty table gives
    none. A passed column named like a made one is replaced, and no other name clashes. Texts of any length are taken whole.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    kept, schema = passed(docs, columns, MADE)
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null and text is not null")
    lines = lines.mapInArrow(_lines(least_chars), "h1 long, h2 long, doc_id long")
    lines = scratch.save(lines, "lines")
    total = lines.count()
    batches = min(max(-(-total // BATCH_LINES), LEAST_BATCHES), MOST_BATCHES)
    runs = LineRuns(scratch)
    for i in range(batches):
        runs.add(lines.filter(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == i))
    common = scratch.save(runs.keys().filter(F.col("n_docs") >= least_docs), "common")
    runs.drop()
    hot = F.col("n_docs") > total * HOT_SHARE
    often, rarer = common.filter(hot), common.filter(~hot)
    rest = lines.join(F.broadcast(often.select(*_KEY)), _KEY, "left_anti").join(rarer, _KEY)
    found = lines.join(F.broadcast(often), _KEY).unionByName(rest).filter("doc_id <> top_doc")
    of, out = (f"{n}_{uuid.uuid4().hex}" for n in ("doc", "gone"))  # no passed column's names
    gone = scratch.save(found.groupBy(F.col("doc_id").alias(of)).agg(F.collect_set(F.struct(*_KEY)).alias(out)), "gone")
    whole = docs.withColumn(of, F.col("doc_id").cast("long")).join(gone, of, "left")
    return whole.select(*dict.fromkeys([*kept, "text", out])).mapInArrow(_apply(kept, out), schema)
