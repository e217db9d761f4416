"""SQLite files as a Spark data source: ``spark.read.format("newsdb")``.

Options: paths (a JSON list of files and folders, walked in order) or path, table (raw_news, parsed_news,
preprocessed_news or news), chunk (rows of a partition; files are cut by rowid). Rows carry their
file's place as file_ord. Only the columns of the schema that is asked for are read (``columns`` of
``read_databases``). Writing appends with the first row of a key winning.
"""

from __future__ import annotations

import json
import os
import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from ..operators.relops import dedup_first
from ..schemas import LEGACY, PARSED, PREPROCESSED, RAW

TABLES = {"raw_news": RAW, "parsed_news": PARSED, "preprocessed_news": PREPROCESSED, "news": LEGACY}
MAGIC = b"SQLite format 3\0"
#: Folders of relative paths, by kind.
ROOTS = {"raw": "data/raw", "parsed": "data/parsed", "preprocessed": "data/preprocessed", "data": "data"}


def is_sqlite(path: str) -> bool:
    """Whether an absolute path is a readable SQLite file with a whole header."""
    try:
        if not os.path.isabs(path) or not os.path.isfile(path) or os.path.getsize(path) < 100:
            return False
        with open(path, "rb") as f:
            return f.read(16) == MAGIC
    except OSError:
        return False


def find_databases(paths: list[str]) -> list[str]:
    """SQLite files among ``paths`` and below their folders, in the order of the arguments and of the walk."""
    found = []
    for path in paths:
        if os.path.isdir(path):
            found += [x for top, _, names in os.walk(path) for x in (os.path.join(top, n) for n in names) if is_sqlite(x)]
        elif is_sqlite(path):
            found.append(path)
    return found


def resolve(path: str, kind: str, root: str) -> str:
    """Absolute paths stay, others lie in the folder of their kind below ``root``."""
    checked_name(path)
    return path if os.path.isabs(path) else os.path.join(root, ROOTS[kind], path)


def checked_name(name: str) -> str:
    if not isinstance(name, str):
        raise TypeError("a database's name must be a string")
    if not name:
        raise ValueError("a database's name must not be empty")
    return name


def connect(path: str) -> sqlite3.Connection:
    """A connection; folders are made, a path that is something else than a file is an error."""
    checked_name(path)
    if os.path.exists(path) and not os.path.isfile(path):
        raise FileExistsError(f"{path} is not a file")
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    return sqlite3.connect(path)


def create_statement(table: str) -> str:
    names = {"long": "INTEGER", "integer": "INTEGER", "string": "TEXT"}
    columns = ["id INTEGER PRIMARY KEY AUTOINCREMENT"]
    columns += [f'"{f.name}" {names[f.dataType.typeName()]}{"" if f.nullable else " NOT NULL"}' for f in TABLES[table].fields if f.name != "id"]
    if table != "news":
        columns.append("UNIQUE(company_id, url_pattern) ON CONFLICT IGNORE")
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)})"


def insert_rows(connection: sqlite3.Connection, table: str, rows: list[tuple]) -> None:
    """Rows without ids, in order; the first of a key stays."""
    names = [f.name for f in TABLES[table].fields if f.name != "id"]
    connection.execute(create_statement(table))
    marks = ", ".join("?" * len(names))
    connection.executemany(f"INSERT INTO {table} ({', '.join(names)}) VALUES ({marks})", rows)
    connection.commit()


@dataclass
class Part(InputPartition):
    path: str
    ordinal: int
    low: int
    high: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.table, self.schema = options["table"], schema
        paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.files, self.chunk = find_databases(paths), int(options.get("chunk", 100_000))

    def partitions(self) -> list[Part]:
        parts = []
        for i, path in enumerate(self.files):
            with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as c:
                low, high = c.execute(f"SELECT MIN(rowid), MAX(rowid) FROM {self.table}").fetchone()
            if low is not None:
                parts += [Part(path, i, at, min(at + self.chunk, high + 1)) for at in range(low, high + 1, self.chunk)]
        return parts or [Part("", 0, 0, 0)]

    def read(self, part: Part) -> Iterator[tuple]:
        if not part.path:
            return
        names = [f.name for f in self.schema.fields if f.name != "file_ord"]
        whole = [f.dataType.typeName() in ("long", "integer") for f in self.schema.fields if f.name != "file_ord"]
        ordinal = (part.ordinal,) if "file_ord" in self.schema.names else ()
        with sqlite3.connect(f"file:{part.path}?mode=ro", uri=True) as c:
            for row in c.execute(f"SELECT {', '.join(names) or '1'} FROM {self.table} WHERE rowid >= ? AND rowid < ? ORDER BY rowid", (part.low, part.high)):
                # A missing time may stand as an empty text in an integer column: it is 0 here.
                yield (*(int(v or 0) if w and v is not None else v for v, w in zip(row, whole, strict=False)), *ordinal)


@dataclass
class _Message(WriterCommitMessage):
    rows: list[tuple]


class _Writer(DataSourceWriter):
    """Tasks hand their rows over in staged files beside the target; the commit adds them in order of partition."""

    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.path, self.table, self.schema = options["path"], options["table"], schema

    def write(self, rows: Iterator) -> _Message:
        names = [f.name for f in TABLES[self.table].fields if f.name != "id"]
        from pyspark import TaskContext

        context = TaskContext.get()
        staged = f"{self.path}.{context.partitionId():06d}-{context.taskAttemptId()}.staged"
        with connect(staged) as c:
            c.execute(f"DROP TABLE IF EXISTS {self.table}")
            insert_rows(c, self.table, [tuple(r[n] if n in r else None for n in names) for r in (x.asDict() for x in rows)])
        c.close()
        return _Message([(context.partitionId(), staged)])

    def commit(self, messages: list[_Message | None]) -> None:
        target = connect(self.path)
        target.execute(create_statement(self.table))
        names = ", ".join(f.name for f in TABLES[self.table].fields if f.name != "id")
        for _, staged in sorted(x for m in messages if m is not None for x in m.rows):
            target.execute("ATTACH ? AS staged", (staged,))
            target.execute(f"INSERT INTO {self.table} ({names}) SELECT {names} FROM staged.{self.table} ORDER BY id")
            target.commit()
            target.execute("DETACH staged")
            os.remove(staged)
        target.close()

    def abort(self, messages: list[_Message | None]) -> None:
        for _, staged in (x for m in messages if m is not None for x in m.rows):
            if os.path.exists(staged):
                os.remove(staged)


class NewsDB(DataSource):
    @classmethod
    def name(cls) -> str:
        return "newsdb"

    def schema(self) -> T.StructType:
        return T.StructType([*[T.StructField(f.name, f.dataType) for f in TABLES[self.options["table"]].fields], T.StructField("file_ord", T.IntegerType())])

    def reader(self, schema: T.StructType) -> _Reader:
        return _Reader(dict(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options), schema)


def read_databases(spark: SparkSession, paths: list[str], table: str, chunk: int = 100_000, columns: list[str] | None = None) -> DataFrame:
    """All rows of a table in the SQLite files at ``paths``, with file_ord; only ``columns`` where they are given."""
    for path in paths:
        checked_name(path)
    spark.dataSource.register(NewsDB)
    reader = spark.read.format("newsdb").option("paths", json.dumps(paths)).option("table", table).option("chunk", str(chunk))
    if columns is not None:
        fields = {f.name: T.StructField(f.name, f.dataType) for f in [*TABLES[table].fields, T.StructField("file_ord", T.IntegerType())]}
        reader = reader.schema(T.StructType([fields[c] for c in columns]))
    return reader.load()


def write_database(df: DataFrame, path: str, table: str, order: list[str]) -> None:
    """Appends rows to one SQLite file by ``order``; the file's own rows win, then the first of a key."""
    df.sparkSession.dataSource.register(NewsDB)
    key = [c for c in ("company_id", "url_pattern") if c in df.columns]
    rows = dedup_first(df, order, tuple(key)) if len(key) == 2 else df
    names = [f.name for f in TABLES[table].fields if f.name != "id"]
    rows.orderBy(*order).select(*names).write.format("newsdb").option("path", path).option("table", table).mode("append").save()
