"""First-wins appends to a large target that read only the files which may hold a batch's keys.

Beside the target stands a table with a Bloom filter of the keys of each of its files. A batch's key hashes are held against
the filters in tasks; files that none of them can be in aren't read, and the rest decides by an exact anti-join. A file
without a filter, left by an append that broke off, is always read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import KEY
from .relops import dedup_first

#: Bits of a filter for a key, hashes of it, and keys of a batch beyond which all files are read.
BITS, HASHES, MOST_KEYS = 12, 8, 4_000_000
_TABLE = "file string, n_keys long, bits binary"


def _hash(key: tuple[str, ...]) -> Column:
    return F.xxhash64(*(F.col(k).cast("string") for k in key), *(F.col(k).isNull() for k in key))


def _slots(hashes: np.ndarray, size: int) -> np.ndarray:
    """The bits of each key: two halves of its hash, combined."""
    raw = hashes.astype(np.int64).view(np.uint64)
    a, b = raw & np.uint64(0xFFFFFFFF), raw >> np.uint64(32) | np.uint64(1)
    return ((a[:, None] + np.arange(HASHES, dtype=np.uint64) * b[:, None]) % np.uint64(size)).astype(np.int64)


def _filter(table: pa.Table) -> pa.Table:
    """The Bloom filter of a file's keys."""
    hashes = np.unique(table.column("hash").to_numpy())
    size = max(64, -(-BITS * len(hashes) // 8) * 8)
    bits = np.zeros(size, bool)
    bits[_slots(hashes, size).ravel()] = True
    return pa.table({"file": table.column("file")[:1].cast(pa.string()), "n_keys": pa.array([len(hashes)]), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})


def index_of(target: str) -> str:
    return f"{target.rstrip('/')}_keys"


def _read(spark: SparkSession, path: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # noqa: BLE001 - nothing has been written there yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def index_files(spark: SparkSession, target: str, schema, key: tuple[str, ...] = KEY) -> int:
    """Adds filters for the files of ``target`` that have none; returns how many."""
    whole = _read(spark, target, schema)
    known = _read(spark, index_of(target), _TABLE)
    have = {r["file"] for r in known.select("file").collect()} if known is not None else set()
    new = sorted(set(whole.inputFiles()) - have) if whole is not None else []
    if new:
        rows = spark.read.schema(schema).parquet(*new).select(F.input_file_name().alias("file"), _hash(key).alias("hash"))
        rows.groupBy("file").applyInArrow(_filter, _TABLE).write.mode("append").parquet(index_of(target))
    return len(new)


def files_with(batch: DataFrame, target: str, key: tuple[str, ...] = KEY, most_keys: int = MOST_KEYS) -> list[str]:
    """The files of ``target`` that may hold a key of ``batch``: all that do, and of the others about three in a thousand for a key."""
    spark = batch.sparkSession
    whole = _read(spark, target, batch.schema)
    if whole is None:
        return []
    files = whole.inputFiles()
    known = _read(spark, index_of(target), _TABLE)
    wanted = batch.select(_hash(key).alias("h")).distinct().limit(most_keys + 1).toPandas()["h"].to_numpy(np.int64)
    if known is None or len(wanted) > most_keys:
        return files
    shared = spark.sparkContext.broadcast(wanted)  # ``most_keys`` of 8 bytes at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows = []
            for bits in part.column("bits").to_pylist():
                own = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
                rows.append(any(bool(own[_slots(shared.value[i : i + 100_000], len(own))].all(axis=1).any()) for i in range(0, len(shared.value), 100_000)))
            yield pa.RecordBatch.from_arrays([part.column("file"), pa.array(rows, pa.bool_())], names=["file", "may"])

    judged = {r["file"]: r["may"] for r in known.select("file", "bits").mapInArrow(run, "file string, may boolean").collect()}
    return [f for f in files if judged.get(f, True)]


def new_rows(batch: DataFrame, target: str, order: list[str], key: tuple[str, ...] = KEY) -> DataFrame:
    """The first row of each key of ``batch`` by ``order`` whose key ``target`` doesn't hold. Nulls in a key are equal to each other."""
    files = files_with(batch, target, key)
    have = batch.sparkSession.read.schema(batch.schema).parquet(*files) if files else None
    return dedup_first(batch, order, key, have)


def append_new(batch: DataFrame, target: str, order: list[str], key: tuple[str, ...] = KEY) -> None:
    """Appends those rows to the Parquet table ``target``, and their files' filters to its index. A batch that is appended again
    after a failure finds its rows in the target, by files with or without filters, and adds none twice."""
    new_rows(batch, target, order, key).write.mode("append").parquet(target)
    index_files(batch.sparkSession, target, batch.schema, key)
