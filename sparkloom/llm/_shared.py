"""Tables cut out of the lineage, in the folder that driver and executors share, and values that tasks share."""

from __future__ import annotations

import atexit
import pickle
import tempfile
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def shipped(spark: SparkSession, value: object) -> Callable[[], object]:
    """A function for tasks that returns ``value``, which is broadcast with its classes where workers can't import them."""
    raw = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(raw.value)


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a temporary folder only where that is unset and the master is local (tests)."""
    sc = spark.sparkContext
    place = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not place:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="sparkloom-"))
        place = sc.getCheckpointDir()
    return place.rstrip("/")


class Scratch:
    """Written tables of one operator call. ``drop`` removes one early; the rest go when Python ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/sparkloom-{name}-{uuid.uuid4().hex}"
        self.n = 0
        atexit.register(self._quiet_drop, self.root)

    def save(self, df: DataFrame, name: str = "t") -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def save_bucketed(self, df: DataFrame, name: str, keys: list[str], buckets: int) -> DataFrame:
        """A table in ``buckets`` parts by the hash of ``keys``, each sorted by them: joins on the keys don't shuffle it."""
        path, table = self.path(name), f"sparkloom_{name}_{uuid.uuid4().hex}"
        df.write.format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
        out = self.spark.table(table)
        out._scratch_path, out._scratch_table = path, table
        return out

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def drop(self, df_or_path: DataFrame | str) -> None:
        if table := getattr(df_or_path, "_scratch_table", None):
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        path = df_or_path if isinstance(df_or_path, str) else df_or_path._scratch_path
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

    def _quiet_drop(self, path: str) -> None:
        try:
            if self.spark.sparkContext._jsc is not None:
                self.drop(path)
        except Exception:  # noqa: BLE001 - the JVM may be gone when Python ends
            pass
