"""The crawl job: for each source the order of its pages, and when it is left. What a page says decides what is fetched next, so
the loop over commits runs on the driver; the addresses of one commit are fetched by tasks.

A fetcher is a function from an address to (status, body). A commit's rows go to a sink, which gets raw records.
"""

from __future__ import annotations

import json
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns, html
from ..operators import extract, frontier, relops
from ..schemas import COMPANIES, SHORT_NAMES

Sink = Callable[[DataFrame], None]
TIMEOUT = 20
PAGES_A_COMMIT = {"epochtimes": 100, "ntdtv": 100, "udn": 10}
# Listing pages (by category and number), the first of them, and the links in them.
LISTINGS = {
    "epochtimes": ("{base}{category}_{page}.htm", 2, "div.post_list.left_col > div.one_post div.text > div.title > a"),
    "ntdtv": ("{base}prog{category}/{page}", 1, "div.post_list > div.list_wrapper > div.one_post div.title > a"),
    "ltn": ("{base}{category}/{page}", 1, None),
    "setn": ("{base}ViewAll.aspx?PageGroupID={category}&p={page}", 1, "div.newsItems h3.view-li-title > a"),
    "udn": ("{base}api/more?page={page}&channelId=2&type=cate_latest_news&totalRecNo=100", 1, None),
}
TVBS_LIST = "{base}news/LoadMoreOverview?limit=100&offset=0&cateid={number}&cate={category}&newsid={idx}"
BY_ID = {"ettoday": "{base}{idx}", "storm": "{base}{idx}?mode=whole"}


def http_get(url: str) -> tuple[int, str]:
    """Status and body of an address; an error of the server is a status, too."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "Mozilla/5.0"}), timeout=TIMEOUT) as answer:  # noqa: S310
            return answer.status, answer.read().decode(answer.headers.get_content_charset() or "utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, ""


@dataclass
class Run:
    """One crawl of a source."""

    spark: SparkSession
    source: str
    fetcher: frontier.Fetcher
    sink: Sink
    past: datetime
    current: datetime
    first: int = 1
    latest: int = -1

    def __post_init__(self):
        self.company = SHORT_NAMES.index(self.source)
        self.base = COMPANIES[self.company][2]
        self.most = frontier.MOST_FAILURES[self.source]

    def page(self, url: str) -> str:
        """A page that is read on the driver; whatever isn't there is an error."""
        status, body = self.fetcher(url)
        if status != 200:
            raise LookupError(f"{status} at {url}")
        return body

    def listing(self, category: str, page: int) -> str:
        return LISTINGS[self.source][0].format(base=self.base, category=category, page=page)

    def log(self, urls: DataFrame) -> DataFrame:
        """The answers to ``urls`` (seq, url or choices); a page that says that there is none is a failure."""
        log = frontier.fetch_pages(urls, self.fetcher)
        if self.source in ("ftv", "storm"):
            log = extract.page_not_found(log, self.source, "body").withColumn("ok", F.col("ok") & ~F.col("missing")).drop("missing")
        return log

    def commit(self, urls: DataFrame | list[str], group: str | None = None) -> int:
        """Fetches, hands the rows of each ``group`` before its first run of failures to the sink, and counts them."""
        if isinstance(urls, list):
            urls = self.spark.createDataFrame(list(enumerate(urls)), "seq long, url string")
        log = self.log(urls)
        groups = [F.expr(group).alias("_group")] if group else [F.lit(0).alias("_group")]
        rows = relops.failure_cutoff(log.select("*", *groups), self.most, ["_group"])
        url = columns.compress_url(F.lit(self.company), F.col("url"))
        raw = rows.select(F.col("seq").alias("id"), F.lit(self.company).alias("company_id"), columns.collapse_ws(F.col("body")).alias("raw_xml"), url.alias("url_pattern"))
        raw = raw.persist()
        try:
            if n := raw.count():
                self.sink(raw)
            return n
        finally:
            raw.unpersist()

    def in_time(self, day: datetime | None) -> bool:
        return day is not None and self.past <= day <= self.current


def by_day(run: Run) -> None:
    """Numbered addresses of each day, the newest first; of the choices for a number the first that answers."""
    days = frontier.day_frontier(run.spark, run.past.date().isoformat(), run.current.date().isoformat())
    for row in days.orderBy("place").toLocalIterator():
        urls = frontier.index_frontier(days.filter(F.col("place") == row["place"]), run.source)
        if run.source == "chinatimes":
            tried = urls.groupBy(F.col("idx").cast("long").alias("seq")).agg(F.array_sort(F.collect_list(F.struct("rank", "url"))).alias("tried"))
            run.commit(tried.select("seq", F.col("tried.url").alias("choices")))
        elif run.source == "ftv":
            code = F.array_position(F.array(*[F.lit(c) for c in frontier.CATEGORIES["ftv"]]), F.col("category")) * 100_000
            run.commit(urls.select((code + F.col("idx")).alias("seq"), "url"), "seq div 100000")
        else:
            run.commit(urls.select(F.col("idx").cast("long").alias("seq"), "url"))


def by_id(run: Run) -> None:
    """Ranges of ids upwards, without an end up to the first range that is empty."""
    make = BY_ID[run.source]
    fetch = lambda a, b: run.commit([make.format(base=run.base, idx=i) for i in range(a, b)])
    for _ in frontier.index_chunks(run.first, run.latest, frontier.CHUNK[run.source], fetch):
        pass


def by_list(run: Run) -> None:
    """Ranges of ids downwards; for each category the ids that the source lists in the range."""
    for lo, hi in frontier.index_chunks_down(run.first, run.latest, frontier.CHUNK[run.source]):
        for category, number in frontier.TVBS_LISTS.items():

            def ask(idx: int, category=category, number=number) -> list[int]:
                said = json.loads(run.page(TVBS_LIST.format(base=run.base, number=number, category=category, idx=idx)))
                return [int(x) for x in frontier.quoted_ids(said.get("news_id_list") if isinstance(said, dict) else None)]

            top = _latest(ask, lo, hi, run.most)
            ids = frontier.walk_ids(lo, top, ask, run.most)
            run.commit([f"{run.base}{category}/{i}" for i in ids])


def _latest(ask: Callable[[int], list[int]], lo: int, hi: int, most: int) -> int:
    """The largest id of the range in the first list that there is, asked for from the end of the range down; ``lo`` without one."""
    for idx in range(hi + 1, max(lo, hi + 1 - most), -1):
        try:
            if own := [x for x in ask(idx) if lo <= x <= hi]:
                return max(own)
        except Exception:  # noqa: BLE001, S112 - the next one is asked for
            continue
    return lo


def by_page(run: Run) -> None:
    """Pages of each category from the first that reaches into the time, some to a commit; an empty one ends its category."""
    _, first, selector = LISTINGS[run.source]
    for category in frontier.CATEGORIES[run.source]:
        top = _top_page(run, category, first)
        step = PAGES_A_COMMIT[run.source]
        for page in range(_first_page(run, category, first, top, selector), top + 1, step):
            pages = [run.listing(category, p) for p in range(page, min(page + step, top + 1))]
            if not run.commit(_linked(run, pages, selector)):
                break


def _top_page(run: Run, category: str, first: int) -> int:
    try:
        return extract.max_page(run.page(run.listing(category, first)))
    except Exception:  # noqa: BLE001 - without a pager there is one page
        return 1


def _first_page(run: Run, category: str, first: int, top: int, selector: str) -> int:
    failed, page = 0, first
    for page in range(first, top + 1):
        try:
            links = [x.attrs["href"] for x in html.parse(run.page(run.listing(category, page))).select(selector)]
            days = [d for d in map(_day_of(run.source), links) if d]
            failed = 0
            if max(days) < run.past or any(map(run.in_time, days)):
                break
        except Exception:  # noqa: BLE001 - odd pages are passed over, up to a number
            failed += 1
        if failed >= run.most:
            break
    return page


def _day_of(source: str) -> Callable[[str], datetime | None]:
    return lambda url: extract.day_of_url(url, source)


def _linked(run: Run, pages: list[str], selector: str | None) -> DataFrame:
    """seq and url of the articles that listing pages name, in their order, those outside the time left out where it is known."""
    listed = relops.failure_cutoff(frontier.fetch_pages(run.spark.createDataFrame(list(enumerate(pages)), "seq long, url string"), run.fetcher).withColumn("_group", F.lit(0)), run.most, ["_group"])
    listed = listed.select(F.col("seq").alias("page"), F.col("body").alias("raw_xml"))
    past, current = (F.lit(t.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp") for t in (run.past, run.current))
    if run.source == "ltn":
        links = frontier.listed_urls(listed, "raw_xml", place=True)
    elif run.source == "udn":
        links = frontier.listed_items(listed, column="raw_xml", place=True).filter(F.col("stamp").between(past, current))
    else:
        links = extract.listing_links(listed, selector).withColumnRenamed("link", "url")
        if run.source in ("epochtimes", "ntdtv"):
            links = links.filter(columns.url_date(F.col("url"), run.source).cast("timestamp").between(past, current))
        else:
            links = links.withColumn("url", F.concat(F.lit(run.base), F.substr("url", F.lit(2))))
    return links.select((F.col("page") * 1_000_000 + F.col("place")).alias("seq"), "url")


def by_listing(run: Run) -> None:
    """A fixed number of listing pages of each category; setn is left at the first category without any article."""
    _, first, selector = LISTINGS[run.source]
    for category in frontier.CATEGORIES[run.source]:
        pages = [run.listing(category, p) for p in range(first, first + frontier.LISTING_PAGES[run.source])]
        if not run.commit(_linked(run, pages, selector)) and run.source == "setn":
            return


def by_time(run: Run) -> None:
    """Pages of a listing sorted by time, those that reach into the window, some to a commit."""

    def times(page: int) -> list[datetime]:
        try:
            lists = json.loads(run.page(run.listing("", page))).get("lists") or []
        except Exception:  # noqa: BLE001 - a page that can't be read has no items
            return []
        return [datetime.strptime(f"{x['time']['date']} +0000", "%Y-%m-%d %H:%M %z") for x in lists]

    last = frontier.last_available(lambda p: bool(times(p)))
    end = frontier.last_where(lambda p: max(times(p), default=run.past) >= run.past, last)
    begin = frontier.last_where(lambda p: min(times(p), default=run.current) > run.current, end) + 1
    step = PAGES_A_COMMIT[run.source]
    for page in range(begin, end + 1, step):
        run.commit(_linked(run, [run.listing("", p) for p in range(page, min(page + step, end + 1))], None))


#: How each source is crawled.
CRAWLERS: dict[str, Callable[[Run], None]] = {
    "chinatimes": by_day, "cna": by_day, "epochtimes": by_page, "ettoday": by_id, "ftv": by_day, "ltn": by_listing, "ntdtv": by_page, "setn": by_listing,
    "storm": by_id, "tvbs": by_list, "udn": by_time,
}


def crawl(spark: SparkSession, source: str, sink: Sink, fetcher: frontier.Fetcher = http_get, past: str | None = None, current: str | None = None, first: int = 1, latest: int = -1) -> None:
    """Crawls a source. Days are ``%Y-%m-%d%z``, now and the day before it where they aren't given; not every source takes them, or the ids."""
    if source not in CRAWLERS:
        raise ValueError(f"unknown source {source}; known: {sorted(CRAWLERS)}")
    earliest, newest = frontier.dates_of(past, current)
    frontier.check_range(earliest, newest)
    CRAWLERS[source](Run(spark, source, fetcher, sink, earliest, newest, first, latest))
