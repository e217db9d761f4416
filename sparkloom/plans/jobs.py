"""The jobs: parse, preprocess, migrate, merge and split. Each takes and returns DataFrames."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import arrow, columns
from ..functions.delimiters import Strip
from ..operators.entities import Recogniser, Tag, recognise, replace_entities
from ..operators.extract import Options, extract, quarantine, readable
from ..operators.relops import dedup_first, merge_parsed, merge_raw, reject_nulls, split_chunks

Stage = Callable[[DataFrame], DataFrame]
TextStep = Callable[[str], str] | Strip | arrow.Between


@dataclass(frozen=True)
class Preprocess:
    """What to do with title and article; the order is fixed, whatever the order of the flags."""

    urls: bool = False
    parens: bool = False
    brackets: bool = False
    curlies: bool = False
    lenticulars: bool = False
    emoji: bool = False
    non_cjk: bool = False
    least: int = 0
    most: int = -1
    recogniser: Recogniser | None = None
    tags: dict[str, Tag] = field(default_factory=dict)
    dates: bool = False
    batch_size: int = 8
    english: bool = False
    guillemets: bool = False
    numbers: bool = False
    unclosed: str = "reference"


REQUIRED = ["article", "company_id", "timestamp", "title", "url_pattern"]


def _texts(df: DataFrame, chain: list[TextStep], first: bool) -> DataFrame:
    """Title and article through ``chain`` in one function, without the rows that a length rules out, and with the first chain
    category and reporter through NFKC: in the same function, or of the rows that stay in one that Spark leaves out where neither is used."""
    done = f"done_{uuid.uuid4().hex}"
    short = ["category", "reporter"] if first else []
    bound = any(isinstance(step, arrow.Between) for step in chain)
    df = df.withColumn(done, arrow.cleaned(F.col("title"), F.col("article"), chain, {} if bound else {c: F.col(c) for c in short}))
    df = df.filter(F.col(done)["kept"]) if bound else df
    new = {c: arrow.nfkc_if_any(F.col(c)) if bound else F.col(done)[c] for c in short}
    return df.withColumns({c: F.col(done)[c] for c in ("title", "article")} | new).drop(done)


def stages(p: Preprocess) -> list[tuple[str, TextStep | None, Stage | None]]:
    """The stages asked for, in their fixed order, each on texts, with the length of articles among them, or on the table; NFKC is always the first."""
    strip = lambda a, b: Strip(a, b, unclosed=p.unclosed)
    gone = lambda pattern: lambda t: pattern.sub("", t)
    entities = bool(p.tags or p.dates)
    if entities and p.recogniser is None:
        raise ValueError("entities need a recogniser")
    tags = tuple(t.tag for t in p.tags.values())
    listed = [
        ("nfkc", True, arrow.nfkc_text, None),
        ("url", p.urls, gone(arrow.URL), None),
        ("paren", p.parens, strip("(", ")"), None),
        ("bracket", p.brackets, strip("[", "]"), None),
        ("curly", p.curlies, strip("{", "}"), None),
        ("lenticular", p.lenticulars, strip("【", "】"), None),
        ("emoji", p.emoji, gone(arrow.EMOJI), None),
        ("non_cjk", p.non_cjk, gone(arrow.NOT_KEPT), None),
        ("length", p.least != 0 or p.most != -1, arrow.Between(p.least, p.most), None),
        ("entities", entities, None, lambda df: replace_entities(recognise(df, p.recogniser, p.batch_size), p.tags, p.dates)),
        ("english", p.english, arrow.english_text, None),
        ("guillemet", p.guillemets, Strip("《", "》", "<unk>", True, p.unclosed), None),
        ("number", p.numbers, lambda t: arrow.number_text(t, tags), None),
    ]
    return [(name, change, stage) for name, wanted, change, stage in listed if wanted]


def preprocess(parsed: DataFrame, config: Preprocess) -> DataFrame:
    """All stages; those on texts that follow each other are one function, so that texts go to Python as seldom as possible."""
    chain, first = [], True
    for _, change, stage in [*stages(config), ("end", None, lambda df: df)]:
        if change is not None:
            chain.append(change)
            continue
        if chain:
            parsed, chain, first = _texts(parsed, chain, first), [], False
        parsed = stage(parsed)
    return parsed


def _order(df: DataFrame) -> list[str]:
    """Files in their order, and ids within a file: which row of a key is the first."""
    return ["file_ord", "id"] if "file_ord" in df.columns else ["id"]


def parse(raw: DataFrame, options: Options | None = None) -> tuple[DataFrame, DataFrame]:
    """Articles, the first of each key by file and id, and the pages that could not be read.

    Both come from one extraction; save or cache it where both are wanted.
    """
    done = extract(raw, options)
    good, bad = reject_nulls(readable(done), REQUIRED)
    lost = quarantine(done)
    lost = lost.unionByName(bad.withColumn("error", F.lit("null in a required column")).select(*lost.columns))
    return dedup_first(good, _order(good)), lost


def parse_to(raw: DataFrame, folder: str, options: Options | None = None) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """As ``parse``, from one extraction that is written to ``folder`` by outcome (Parquet): articles, the pages that could not be read,
    and how many pages were read and lost, counted while they were written. ``folder`` must not exist; a task that runs
    again replaces its own files. An empty table gives two empty ones.
    """
    done = extract(raw, options)
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in REQUIRED])
    done = done.withColumn("error", F.when(F.col("error").isNull() & missing, "null in a required column").otherwise(F.col("error")))
    seen = Observation("parse")
    outcome = F.when(F.col("error").isNull(), "article").otherwise("quarantine").alias("outcome")
    done.observe(seen, F.count("*").alias("read"), F.count("error").alias("lost")).select("*", outcome).write.partitionBy("outcome").parquet(folder)
    whole = raw.sparkSession.read.schema(done.schema.add("outcome", "string")).parquet(folder)
    good = whole.filter("outcome = 'article'").drop("outcome", "error")
    return dedup_first(good, _order(good)), quarantine(whole.filter("outcome = 'quarantine'")), seen.get


def migrate_v1(legacy: DataFrame) -> DataFrame:
    """Raw rows of a table with names and whole addresses."""
    company = columns.company_id(F.col("company"))
    ordinal = [c for c in ("file_ord",) if c in legacy.columns]
    out = legacy.select("id", company.alias("company_id"), columns.collapse_ws(F.col("raw_xml")).alias("raw_xml"), "url", *ordinal)
    return out.select("id", "company_id", "raw_xml", columns.compress_url(F.col("company_id"), F.col("url")).alias("url_pattern"), *ordinal)


MIGRATIONS: dict[str, Stage] = {"v1": migrate_v1}


def migrate(legacy: DataFrame, version: str) -> DataFrame:
    if version not in MIGRATIONS:
        raise ValueError(f"unknown version {version}; known: {sorted(MIGRATIONS)}")
    rows = MIGRATIONS[version](legacy)
    return dedup_first(rows, _order(rows))


def merge(frames: list[DataFrame], kind: str, target: DataFrame | None = None) -> DataFrame | None:
    """Files of one kind as one, or nothing without a file."""
    if kind not in ("raw", "parsed"):
        raise ValueError("kind must be raw or parsed")
    if not frames:
        return target
    return (merge_raw if kind == "raw" else merge_parsed)(frames, target)


def chunk_name(path: str, start: int, end: int, root: str) -> str:
    """The file of a chunk: the path below ``root``, or without its file system's anchor, with the bounds added."""
    inner = os.path.relpath(path, root) if os.path.abspath(path).startswith(os.path.abspath(root) + os.sep) else os.path.splitdrive(os.path.abspath(path))[1].lstrip(os.sep)
    stem, ending = os.path.splitext(inner)
    return f"{stem}__{start}_{end}{ending}"


def split(df: DataFrame, per_chunk: int = 1000, order: str = "id") -> DataFrame:
    """Rows with their chunk; write it with ``partitionBy("chunk")``."""
    return split_chunks(df, per_chunk, [order])
