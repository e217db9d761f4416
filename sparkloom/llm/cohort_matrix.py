"""Cohort retention matrix over two or more states of what is known.

A task that scans clients' periods scatters their contributions with ``numpy.add.at`` into blocks of a tensor (state,
segment, cohort, period); only blocks that something fell into exist, and they leave the task as places and values.
Blocks are then merged by a tree, FAN partial blocks at a time, as ``treeAggregate`` does it, but level by level under the
block's own key. So neither the driver nor one task ever holds the whole matrix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import Scratch

DAY = 86_400_000_000
WEEK = 7 * DAY
#: Cohorts, and periods, of a block; partial blocks that one step of the tree merges; blocks that a task holds at once.
SIDE, FAN, HELD = 16, 16, 2048
MEASURES = ["users", "users_crc32", "moved", "cents"]
PLACE = ["state", "segment", "cohort_block", "period_block"]
_LONGS = T.ArrayType(T.LongType(), False)
PARTIAL = T.StructType(
    [T.StructField("part", T.IntegerType()), T.StructField("state", T.IntegerType()), T.StructField("segment", T.StringType())]
    + [T.StructField(n, T.LongType()) for n in PLACE[2:]]
    + [T.StructField("cells", _LONGS), *(T.StructField(m, _LONGS) for m in MEASURES)]
)
_ARROW = pa.schema(
    [("part", pa.int32()), ("state", pa.int32()), ("segment", pa.string()), ("cohort_block", pa.int64()), ("period_block", pa.int64()), ("cells", pa.list_(pa.int64()))]
    + [(m, pa.list_(pa.int64())) for m in MEASURES]
)


def micros(at: Column) -> Column:
    """Microseconds since 1970 of a timestamp without a zone, whatever the session's zone."""
    at = at.cast("timestamp_ntz")
    seconds = F.unix_date(at.cast("date")).cast("long") * 86_400 + F.hour(at) * 3600 + F.minute(at) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("long")


class Blocks:
    """Sparse blocks of the tensor, as many as fell due; ``rows`` gives them out and forgets them."""

    def __init__(self) -> None:
        self.places: dict[tuple[int, str, int, int], int] = {}
        self.sums = np.zeros((16, SIDE * SIDE, len(MEASURES)), np.int64)

    def slots(self, places: list[tuple[int, str, int, int]]) -> np.ndarray:
        out = np.array([self.places.setdefault(p, len(self.places)) for p in places], np.int64)
        while len(self.places) > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
        return out

    def scatter(self, batch: pa.RecordBatch) -> None:
        """Adds one contribution a row: state, segment, cohort, period and the measures."""
        names = batch.column("segment").dictionary_encode()
        state, cohort, period = (batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("state", "cohort", "period"))
        keys = np.stack([state, names.indices.to_numpy(zero_copy_only=False).astype(np.int64), cohort // SIDE, period // SIDE], axis=1)
        kinds, which = np.unique(keys, axis=0, return_inverse=True)
        segments = names.dictionary.to_pylist()
        slots = self.slots([(s, segments[n], c, p) for s, n, c, p in kinds.tolist()])
        values = np.stack([batch.column(m).to_numpy(zero_copy_only=False).astype(np.int64) for m in MEASURES], axis=1)
        np.add.at(self.sums, (slots[which.ravel()], cohort % SIDE * SIDE + period % SIDE), values)

    def rows(self, part: int) -> pa.RecordBatch:
        made: list[list] = [[] for _ in _ARROW]
        for place, slot in self.places.items():
            cells = np.flatnonzero(self.sums[slot, :, 0])
            for column, value in zip(made, [part, *place, cells, *self.sums[slot, cells].T], strict=True):
                column.append(value)
        self.sums[: len(self.places)] = 0
        self.places = {}
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, _ARROW, strict=True)], schema=_ARROW)


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blocks, part = Blocks(), TaskContext.get().partitionId()
    for batch in batches:
        blocks.scatter(batch)
        if len(blocks.places) > HELD:
            yield blocks.rows(part)
    yield blocks.rows(part)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of partial blocks with one key, which come one after another."""
    blocks, last = Blocks(), None
    for batch in batches:
        for row in batch.to_pylist():
            place = tuple(row[n] for n in PLACE)
            if last is not None and (row["part"], place) != last:
                yield blocks.rows(last[0])
            last = row["part"], place
            np.add.at(blocks.sums[blocks.slots([place])[0]], np.array(row["cells"], np.int64), np.array([row[m] for m in MEASURES], np.int64).T)
    if last is not None:
        yield blocks.rows(last[0])


def tree_merge(partial: DataFrame, parts: int) -> DataFrame:
    """One row a block from partial blocks of ``parts`` tasks at most; no task merges over FAN partials of a block at a level."""
    while True:
        parts = -(-parts // FAN)
        key = [*PLACE, "part"]
        partial = partial.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).repartition(*key).sortWithinPartitions(*key).mapInArrow(_merge, PARTIAL)
        if parts <= 1:
            return partial


def cohort_matrix(
    events: DataFrame, clients: DataFrame, known: list[Column], begins: Column, *,
    client: str = "client_id", at: str = "ts", value: str = "value", segment: str = "source",
) -> DataFrame:
    """Per nonempty cell state (int), segment, and as long cohort, period, users, users_crc32, moved, cents.

    ``known`` holds for each state which events it knows, ``begins`` which events can start a client: its start in a
    state is the earliest ``at`` of those known there. The cohort is the week since 1970 of the start's day, and a known event
    at or behind the start counts in period floor((at - start) / 7 days). Equal rows of ``events``, all columns alike, count once;
    those without ``at`` or client go. A condition that is null doesn't hold. ``users`` counts clients, ``users_crc32`` adds up
    the crc32 of their numbers, ``moved`` counts those whose first and last state both have a start, in different cohorts,
    and ``cents`` adds up floor(100 * value + 0.5), 0 for null and for what isn't finite. A client's segment is that of
    its row in ``clients``, the least of several, '' for none. Empty tables give no cell. Further columns of ``events`` only
    tell rows apart, whatever their names.

    Events are dealt by all their columns to drop repeats, then by client, where Spark splits a partition that one client
    fills; what comes out is summed by (client, state, period) before it is dealt again, so that no client is large then.
    Starts, a row a client, are written to the shared folder.
    """
    scratch = Scratch(events.sparkSession, "cohorts")
    states = range(len(known))
    there = events.filter(F.col(at).isNotNull() & F.col(client).isNotNull())
    firsts = [F.min(F.when(k, F.col(at))).alias(f"start_{i}") for i, k in enumerate(known)]
    starts = there.filter(begins).groupBy(F.col(client).alias("client")).agg(*firsts)
    starts = starts.select("client", *(micros(F.col(f"start_{i}")).alias(f"start_{i}") for i in states)).filter(F.coalesce(*(F.col(f"start_{i}") for i in states)).isNotNull())
    named = clients.filter(F.col(client).isNotNull()).groupBy(F.col(client).alias("client")).agg(F.min(segment).alias("segment"))
    cohort = lambda start: _floor_div(start, WEEK)  # noqa: E731 - of whole days, floor(day / 7) is floor(start / week)
    moved = (cohort(F.col("start_0")) != cohort(F.col(f"start_{len(known) - 1}"))).cast("long")
    starts = starts.join(named.hint("merge"), "client", "left").select(
        "client", F.coalesce("segment", F.lit("")).alias("segment"), F.coalesce(moved, F.lit(0)).cast("long").alias("moved"), *(f"start_{i}" for i in states)
    )
    starts = scratch.save(starts, "starts")
    cents = F.floor(100 * F.col(value) + 0.5)
    finite = F.col(value).isNotNull() & ~F.isnan(F.col(value)) & (F.abs(F.col(value)) < float("inf"))
    seen = there.dropDuplicates().select(
        F.col(client).alias("client"), micros(F.col(at)).alias("at"), F.when(finite, cents).otherwise(0).cast("long").alias("cents"),
        *(F.coalesce(k, F.lit(False)).alias(f"known_{i}") for i, k in enumerate(known)),
    )
    one = lambda i: F.struct(F.lit(i).alias("state"), F.col(f"known_{i}").alias("known"), F.col(f"start_{i}").alias("start"))
    counted = seen.join(starts.hint("merge"), "client").select(
        "client", "segment", "moved", "at", "cents",
        F.explode(F.filter(F.array(*map(one, states)), lambda s: s["known"] & (s["start"] <= F.col("at")))).alias("s"),
    )
    # By the number's text, which crc32 takes: what the join has in one place by client need not stay there, so Spark may split it.
    keys = [
        F.col("client").cast("string").alias("number"), F.col("s.state").alias("state"), F.col("segment"), cohort(F.col("s.start")).alias("cohort"),
        _floor_div(F.col("at") - F.col("s.start"), WEEK).alias("period"), F.col("moved"),
    ]
    periods = counted.groupBy(*keys).agg(F.sum("cents").alias("cents"))
    crc = F.crc32(F.col("number").cast("binary")).alias("users_crc32")
    partial = periods.select("state", "segment", "cohort", "period", F.lit(1).cast("long").alias("users"), crc, "moved", "cents").mapInArrow(_scatter, PARTIAL)
    whole = tree_merge(partial, int(events.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cell = F.explode(F.arrays_zip("cells", *MEASURES)).alias("c")
    return whole.select("state", "segment", "cohort_block", "period_block", cell).select(
        "state", "segment",
        (F.col("cohort_block") * SIDE + _floor_div(F.col("c.cells"), SIDE)).alias("cohort"),
        (F.col("period_block") * SIDE + F.col("c.cells") % SIDE).alias("period"),
        *(F.col(f"c.{m}").alias(m) for m in MEASURES),
    )


def _floor_div(a: Column, b: int) -> Column:
    """Whole-number quotient, rounded down."""
    return F.call_function("div", a - F.pmod(a, F.lit(b)), F.lit(b)).cast("long")
