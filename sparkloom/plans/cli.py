"""Command line of the jobs over SQLite files: ``python -m sparkloom.plans.cli JOB ...``."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.entities import CLASSES, tag_config
from ..operators.extract import Options
from ..sources.newsdb import TABLES, connect, find_databases, insert_rows, read_databases, write_database
from . import jobs
from .crawl import CRAWLERS, crawl, http_get

FLAGS = ["urls", "parens", "brackets", "curlies", "lenticulars", "emoji", "non_cjk", "english", "guillemets", "numbers"]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sparkloom")
    sub = top.add_subparsers(dest="job", required=True)
    p = sub.add_parser("crawl")
    p.add_argument("source", choices=sorted(CRAWLERS))
    p.add_argument("--save", required=True, help="absolute path of the file to append to")
    p.add_argument("--fetcher", help="module:function from an address to (status, body); HTTP by default")
    for flag in ("--past", "--current"):
        p.add_argument(flag, help="YYYY-mm-dd+zzzz; now and the day before it by default")
    p.add_argument("--first", type=int, default=1)
    p.add_argument("--latest", type=int, default=-1)
    for name in ("parse", "preprocess", "merge", "split", "migrate"):
        p = sub.add_parser(name)
        p.add_argument("--db", nargs="+", required=True, help="absolute paths of files or folders")
        p.add_argument("--save", required=name != "parse", help="absolute path of the file to append to; for split, the folder")
        if name == "parse":
            p.add_argument("--parquet", help="new folder for articles, counts of errors and all pages by outcome, written by tasks")
            p.add_argument("--host-zone", default="Asia/Taipei")
            p.add_argument("--corrected", action="store_true")
            p.add_argument("--strict", action="store_true")
        elif name == "preprocess":
            for flag in FLAGS:
                p.add_argument(f"--{flag.replace('_', '-')}", action="store_true")
            p.add_argument("--least", type=int, default=0)
            p.add_argument("--most", type=int, default=-1)
            p.add_argument("--table", default="preprocessed_news", choices=["preprocessed_news", "parsed_news"])
            p.add_argument("--recogniser", help="module:function that makes a recogniser, called once")
            p.add_argument("--batch-size", type=int, default=1, help="texts that the recogniser takes at a time")
            p.add_argument("--dates", action="store_true", help="mask the numbers of dates")
            for kind in CLASSES:
                group = p.add_mutually_exclusive_group()
                flag = kind.lower().replace("_", "-")
                group.add_argument(f"--tag-{flag}", metavar="TAG", help=f"tag that replaces {kind}")
                group.add_argument(f"--tag-{flag}-with-id", metavar="TAG", help="the same, with an id for each word")
        elif name in ("merge", "split"):
            p.add_argument("--kind", required=True, choices=["raw", "parsed"])
            if name == "split":
                p.add_argument("--per-chunk", type=int, default=1000)
                p.add_argument("--root", default="data")
        else:
            p.add_argument("--version", default="v1", choices=sorted(jobs.MIGRATIONS))
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if args.job == "crawl":
        sink = lambda rows: write_database(rows, args.save, "raw_news", ["id"])
        crawl(spark, args.source, sink, _named(args.fetcher) if args.fetcher else http_get, args.past, args.current, args.first, args.latest)
        return
    if args.job == "parse" and not (args.save or args.parquet):
        raise SystemExit("parse needs --save or --parquet")
    files = find_databases(args.db)
    if not files:
        return
    table = {"parse": "raw_news", "preprocess": "parsed_news", "migrate": "news"}.get(args.job) or f"{args.kind}_news"
    rows = read_databases(spark, files, table)
    if args.job == "parse":
        options = Options(args.host_zone, args.corrected, args.strict)
        if args.parquet:  # by tasks, and with what could not be read
            done, lost, counts = jobs.parse_to(rows, f"{args.parquet}/pages", options)
            done.write.parquet(f"{args.parquet}/articles")
            lost.groupBy("error").count().write.parquet(f"{args.parquet}/errors")
            print(f"{counts['read']} pages read, {counts['lost']} lost")
            if not args.save:
                return
        else:
            done, _ = jobs.parse(rows, options)
        write_database(done, args.save, "parsed_news", ["file_ord", "id"])
    elif args.job == "preprocess":
        write_database(jobs.preprocess(rows, preprocess_config(args)), args.save, args.table, ["file_ord", "id"])
    elif args.job == "migrate":
        write_database(jobs.migrate(rows, args.version), args.save, "raw_news", ["file_ord", "id"])
    elif args.job == "merge":
        order = ["file_ord", "id"] if args.kind == "raw" else ["timestamp", "file_ord", "id"]
        write_database(rows, args.save, table, order)
    else:
        for i, path in enumerate(files):
            split_file(rows.filter(F.col("file_ord") == i), path, table, args)


def preprocess_config(args: argparse.Namespace) -> jobs.Preprocess:
    """What the flags ask for; the recogniser's module is imported here and in the workers."""
    named = lambda ending: {c: tag for c in CLASSES if (tag := getattr(args, f"tag_{c.lower()}{ending}"))}
    tags = tag_config(named(""), named("_with_id"))
    recogniser = None
    if args.recogniser:
        recogniser = _named(args.recogniser)()
    return jobs.Preprocess(
        **{f: getattr(args, f) for f in FLAGS}, least=args.least, most=args.most, recogniser=recogniser, tags=tags, dates=args.dates, batch_size=args.batch_size
    )


def split_file(rows: DataFrame, path: str, table: str, args: argparse.Namespace) -> None:
    """Files of a file's chunks, numbered in one pass; a task writes whole chunks, and one that runs again adds no row twice."""
    names = [f.name for f in TABLES[table].fields if f.name != "id"]

    def write(frame: pd.DataFrame) -> pd.DataFrame:
        name = f"{args.save}/{jobs.chunk_name(path, int(frame['start'].iloc[0]), int(frame['end'].iloc[0]), args.root)}"
        ordered = frame.sort_values("id")[names].astype(object)
        connection = connect(name)
        insert_rows(connection, table, list(ordered.where(ordered.notna(), None).itertuples(index=False, name=None)))
        connection.close()
        return pd.DataFrame({"path": [name]})

    jobs.split(rows, args.per_chunk).groupBy("chunk").applyInPandas(write, "path string").count()


def _named(place: str):
    """What ``module:name`` stands for."""
    module, _, name = place.partition(":")
    return getattr(importlib.import_module(module), name)


if __name__ == "__main__":
    main()
