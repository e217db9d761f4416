"""Keyed dedup, merge, split, cutoff and counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import KEY


def dedup_first(df: DataFrame, order: list[str], key: tuple[str, ...] = KEY, target: DataFrame | None = None) -> DataFrame:
    """The first row of each key by ``order`` (a total order); keys that ``target`` holds already are left out.

    Nulls in a key are equal to each other here, and come first in the order. Spark keeps the first row of a key in each
    task already before the shuffle (WindowGroupLimit), so that a frequent key sends one row a task.
    """
    kept = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_rank = 1").drop("_rank")
    if target is None:
        return kept
    have = target.select(*[F.col(k).alias(f"_{k}") for k in key]).distinct()
    return kept.join(have, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]), "left_anti")


def reject_nulls(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows without and with a null in ``columns``."""
    full = reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])
    return df.filter(full), df.filter(~full)


def append_first(target: DataFrame, batch: DataFrame, order: list[str]) -> DataFrame:
    """``target`` and the rows of ``batch`` whose keys are new; what stands in the target wins."""
    return target.unionByName(dedup_first(batch, order, target=target), allowMissingColumns=True)


def union_files(frames: list[DataFrame]) -> DataFrame:
    """Frames in order, each with its place as file_ord."""
    return reduce(DataFrame.unionByName, [f.withColumn("file_ord", F.lit(i)) for i, f in enumerate(frames)])


def merge_raw(frames: list[DataFrame], target: DataFrame | None = None) -> DataFrame:
    """Raw rows of all files; the first by file and id stays, and the target's before any."""
    return dedup_first(union_files(frames), ["file_ord", "id"], target=target)


def merge_parsed(frames: list[DataFrame], target: DataFrame | None = None) -> DataFrame:
    """Parsed rows of all files by time, then file, then id; of equal keys the earliest stays."""
    order = ["timestamp", "file_ord", "id"]
    return dedup_first(union_files(frames), order, target=target).orderBy(*order)


def numbered(df: DataFrame, order: list[str], name: str = "n") -> DataFrame:
    """Rows numbered from 1 in a total order, without gathering them in one task.

    Quantiles of the first column, which is a number, cut the rows into ranges. A value that more rows share than a range has is
    cut again by quantiles of the second column, if that is a number too: ranges are then pairs. The rows of the ranges
    before, summed up over the counts of all ranges, tell where one begins. A row's range follows from its values
    alone, so one that is computed again is the same. Nulls come first. There are twice as many cuts as shuffle partitions at most.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first, fine = F.col(order[0]), F.lit(0)
    if len(order) > 1 and isinstance(df.schema[order[1]].dataType, T.NumericType):
        share = df.count() / parts
        quantiles = F.percentile_approx(order[1], [i / parts for i in range(1, parts)] or [0.5], 10_000)
        tied = df.groupBy(first.alias("v")).agg(F.count("*").alias("k"), quantiles.alias("c")).filter(F.col("k") > share).collect()
        for r in tied:  # fewer than ``parts`` values have as many rows as that
            step = max(1, int(parts * share / r["k"]))
            own = F.array(*map(F.lit, sorted(set((r["c"] or [0])[step - 1 :: step]) or {0})))
            fine = F.when(first.eqNullSafe(F.lit(r["v"])), F.when(F.col(order[1]).isNull(), 1).otherwise(2 + _part(F.col(order[1]), own))).otherwise(fine)
    # Of the values of a range, one that many rows share is the last, for it is a cut; null is a range of its own.
    placed = df.withColumn("_part", F.struct(F.when(first.isNull(), -1).otherwise(_parts(df, order[0])).alias("a"), fine.alias("b")))
    counts = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_size")
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return placed.withColumn("_row", within).join(F.broadcast(before), "_part").withColumn(name, F.col("_row") + F.col("_before")).drop("_part", "_row", "_before")


def split_chunks(df: DataFrame, per_chunk: int, order: list[str]) -> DataFrame:
    """Rows with ``chunk`` from 0 on and the name's bounds, start and end from 1 on."""
    if not isinstance(per_chunk, int) or per_chunk <= 0:
        raise ValueError("per_chunk must be a positive integer")
    total = df.agg(F.count("*").alias("_total"))
    out = numbered(df, order, "_n").crossJoin(F.broadcast(total)).withColumn("chunk", F.floor((F.col("_n") - 1) / per_chunk))
    return out.withColumn("start", F.col("chunk") * per_chunk + 1).withColumn("end", F.least((F.col("chunk") + 1) * per_chunk, F.col("_total"))).drop("_n", "_total")


def page_of(df: DataFrame, limit: int = 100, offset: int = 0, order: str = "id") -> DataFrame:
    """A page of rows by ``order``."""
    for name, value, least in (("limit", limit, 1), ("offset", offset, 0)):
        if not isinstance(value, int) or isinstance(value, bool):
            raise TypeError(f"{name} must be an integer")
        if value < least:
            raise ValueError(f"{name} must be at least {least}")
    return df.orderBy(order).offset(offset).limit(limit)


def by_ids(df: DataFrame, ids: list[int]) -> DataFrame:
    """Whole rows by id."""
    return df.where(F.col("id") == ids[0]) if len(ids) == 1 else df.where(F.col("id").isin(ids))


def num_records(df: DataFrame) -> DataFrame:
    return df.agg(F.count("id").alias("num_records"))


def timestamp_bounds(df: DataFrame) -> DataFrame:
    """min_timestamp and max_timestamp; both null without rows."""
    return df.agg(F.min("timestamp").alias("min_timestamp"), F.max("timestamp").alias("max_timestamp"))


def error_histogram(df: DataFrame, error: str = "error") -> DataFrame:
    return df.filter(F.col(error).isNotNull()).groupBy(error).agg(F.count("*").alias("n"))


def failure_cutoff(log: DataFrame, most: int, group: list[str], seq: str = "seq", ok: str = "ok") -> DataFrame:
    """The successes of each group before its first run of ``most`` failures in a row, by ``seq``; without ``group`` all rows are one.

    A segmented scan: the log is cut into ranges of ``seq``, and each range of a group is scanned apart. What it hands on, its rows,
    and the failures at its end behind its last success, combines from range to range to the failures in a row that
    the next one begins with; only these sums, a row for each range and group, meet in one place. Rows equal in ``seq`` are
    in one range. Other columns than the group, ``seq`` and ``ok`` are joined to the cut alone. A null ``ok`` is neither.
    """
    names = [f"_g{i}" for i in range(len(group))]
    narrow = log.select(*(F.col(g).alias(n) for g, n in zip(group, names, strict=True)), F.col(seq).alias("_seq"), F.coalesce(F.col(ok), F.lit(False)).alias("_ok"), F.coalesce(~F.col(ok), F.lit(False)).alias("_bad"))
    placed = narrow.withColumn("_part", _parts(narrow, "_seq"))
    within = Window.partitionBy(*names, "_part").orderBy("_seq").rowsBetween(Window.unboundedPreceding, 0)
    seen = placed.withColumn("_run", F.sum(F.col("_ok").cast("int")).over(within))
    bad = F.sum(F.col("_bad").cast("int"))
    streaks = seen.withColumn("_streak", bad.over(Window.partitionBy(*names, "_part", "_run").orderBy("_seq").rowsBetween(Window.unboundedPreceding, 0)))
    handed = placed.groupBy(*names, "_part").agg(bad.alias("_n"), F.max(F.when(F.col("_ok"), F.col("_seq"))).alias("_last"))
    tails = placed.join(handed.select(*(F.col(n).alias(f"{n}h") for n in names), F.col("_part").alias("_parth"), F.col("_last").alias("_lasth")), _alike([*names, "_part"], "h"))
    tails = tails.filter(F.col("_lasth").isNotNull() & (F.col("_seq") > F.col("_lasth"))).groupBy(*names, "_part").agg(bad.alias("_tail"))
    parts = handed.alias("p").join(tails.select(*(F.col(n).alias(f"{n}t") for n in names), F.col("_part").alias("_partt"), "_tail"), _alike([*names, "_part"], "t"), "left")
    earlier = Window.partitionBy(*names).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*names).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.select(*names, "_part", F.col("_last").isNotNull().alias("_any"), "_n", F.coalesce("_tail", F.lit(0)).alias("_tail")).withColumn("_sum", F.sum("_n").over(upto))
    since = F.last(F.when(F.col("_any"), F.col("_tail") - F.col("_sum")), ignorenulls=True).over(earlier)
    parts = parts.withColumn("_carry", F.coalesce(F.col("_sum") - F.col("_n") + F.coalesce(since, F.lit(0)), F.lit(0)))
    parts = parts.select(*(F.col(n).alias(f"{n}c") for n in names), F.col("_part").alias("_partc"), "_carry")
    whole = F.col("_streak") + F.when(F.col("_run") == 0, F.col("_carry")).otherwise(0)
    reached = streaks.join(parts, _alike([*names, "_part"], "c")).filter(F.col("_bad") & (whole >= most))
    stops = reached.groupBy(*names).agg(F.min("_seq").alias("_stop"))
    if not group:
        stop = stops.first()["_stop"]
        return log.filter(ok) if stop is None else log.filter(F.col(ok) & (F.col(seq) < F.lit(stop)))
    same = reduce(Column.__and__, [F.col(g).eqNullSafe(F.col(n)) for g, n in zip(group, names, strict=True)])
    return log.join(stops, same, "left").filter(F.col(ok) & (F.col("_stop").isNull() | (F.col(seq) < F.col("_stop")))).drop("_stop", *names)


def _alike(names: list[str], ending: str) -> Column:
    return reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"{n}{ending}")) for n in names])


def _parts(df: DataFrame, number: str) -> Column:
    """Ranges of a column of numbers, about as many as there are shuffle partitions, by its quantiles; 0 for null."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = df.agg(F.percentile_approx(number, [i / parts for i in range(1, parts)] or [0.5], 10_000).alias("c")).first()["c"] or []
    return _part(F.col(number), F.array(*[F.lit(c) for c in sorted(set(cuts))])) if cuts else F.lit(0)


def _part(value: Column, cuts: Column) -> Column:
    """How many of ``cuts`` are below ``value``."""
    return F.coalesce(F.size(F.filter(cuts, lambda c: c < value)), F.lit(0))
