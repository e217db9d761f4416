"""The crawl as data: which addresses, in which order, and when to stop. Fetching is a function that is passed in."""

from __future__ import annotations

import random
import re
from collections.abc import Callable, Iterator
from datetime import UTC, datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import status_class
from ..schemas import COMPANIES, SHORT_NAMES

# Limits, seconds to wait, and categories of the sources.
MOST_FAILURES = {"chinatimes": 1000, "cna": 100, "epochtimes": 5, "ettoday": 500, "ftv": 100, "ltn": 5, "ntdtv": 5, "setn": 5, "storm": 500, "tvbs": 500, "udn": 5}
PER_DAY = {"chinatimes": 100_000, "cna": 10_000, "ftv": 10_000}
CHUNK = {"ettoday": 1000, "storm": 2000, "tvbs": 1000}
WAIT = {"chinatimes": 0.0, "cna": 0.0, "epochtimes": 0.0, "ettoday": 0.0, "ftv": 0.0, "ltn": 60.0, "ntdtv": 0.0, "setn": 60.0, "storm": 1.0, "tvbs": 0.0, "udn": 0.0}
WAIT_BANNED = {"chinatimes": 0.0, "cna": 0.0, "epochtimes": 0.0, "ettoday": 0.0, "ftv": 0.0, "ltn": 86400.0, "ntdtv": 0.0, "setn": 86400.0, "storm": 0.0, "tvbs": 120.0, "udn": 86400.0}
WAIT_429 = {"chinatimes": 120.0, "cna": 0.0, "epochtimes": 120.0, "ettoday": 0.0, "ftv": 0.0, "ltn": 120.0, "ntdtv": 120.0, "setn": 120.0, "storm": 0.0, "tvbs": 120.0, "udn": 120.0}
PATHS = {"chinatimes": ["newspapers", "realtimenews"]}
TVBS_LISTS = {"local": "1", "life": "2", "world": "3", "entertainment": "5", "china": "6", "politics": "7", "sports": "8", "tech": "12", "focus": "41", "fun": "50", "travel": "260", "health": "262", "cars": "269", "money": "270"}
# The lists of a source, by name and number.
CATEGORIES = {
    "chinatimes": ["260407", "260405", "260410", "260402", "260404", "260409", "260403", "260408", "260421", "260412", "260418", "260423", "260417", "262301", "262101", "262102", "262113", "262103", "262104", "262114", "262106", "262107", "262110", "260113", "262404", "260111", "260819", "260809", "260812", "260102"],
    "epochtimes": ["nsc413", "nsc412", "ncid1349362", "nsc418", "ncid1349361", "nsc419", "nsc420", "nsc2007"],
    "ftv": ["A", "C", "F", "I", "J", "L", "N", "P", "R", "S", "U", "W"],
    "ltn": ["politics", "society", "life", "world", "local", "novelty"],
    "ntdtv": ["202", "205", "208", "1255", "211", "203", "204", "647"],
    "setn": ["6", "41", "5", "4", "65", "34", "12", "97", "9", "42", "7", "2", "47"],
    "tvbs": [*TVBS_LISTS.values()],
}
LISTING_PAGES = {"ltn": 25, "setn": 20}

#: From an address to (status, body); a failed request raises.
Fetcher = Callable[[str], tuple[int, str]]


def jitter(most: float = 10.0, mean: float = 1.0, spread: float = 2.0, rng: random.Random | None = None) -> float:
    """A waiting time above 0 and up to ``most``, from a cut-off normal distribution."""
    rng = rng or random.Random()
    while not 0 < (x := rng.gauss(mean, spread)) <= most:
        pass
    return x


def wait_seconds(source: str, status: int) -> float:
    """How long to wait after a failed request."""
    base = {403: WAIT_BANNED, 429: WAIT_429}.get(status, WAIT)[source]
    return base + jitter() if base else 0.0


def check_range(past: datetime, current: datetime) -> None:
    for stamp in (past, current):
        if stamp.tzinfo is None or stamp.utcoffset() != timedelta(0):
            raise ValueError("times must be in UTC")
    if past > current:
        raise ValueError("past must not be after current")


def check_indexes(first: int, latest: int) -> None:
    if first <= 0 or latest != -1 and latest < first:
        raise ValueError("first must be positive, latest at least first or -1")


def dates_of(past: str | None, current: str | None, now: datetime | None = None) -> tuple[datetime, datetime]:
    """``%Y-%m-%d%z`` texts as UTC times; now and a day before it where not given."""
    now = now or datetime.now(UTC)
    read = lambda t: datetime.strptime(t, "%Y-%m-%d%z").astimezone(UTC)
    newest = read(current) if current else now
    return (read(past) if past else newest - timedelta(days=1)), newest


def day_frontier(spark: SparkSession, past: str, current: str) -> DataFrame:
    """Days from the newest to the oldest, both included, as ``place`` and ``day``."""
    days = F.sequence(F.to_date(F.lit(current)), F.to_date(F.lit(past)), F.expr("interval -1 day"))
    return spark.range(1).select(F.posexplode(days).alias("place", "day"))


def index_frontier(days: DataFrame, source: str, most: int | None = None) -> DataFrame:
    """The numbered addresses of each day, in order of ``idx``, with the choices to try for each as ``rank``."""
    base = COMPANIES[SHORT_NAMES.index(source)][2]
    most = PER_DAY[source] if most is None else most
    stamp = F.date_format("day", "yyyyMMdd")
    if source == "cna":
        rows = days.withColumn("idx", F.explode(F.sequence(F.lit(0), F.lit(most - 1)))).withColumn("rank", F.lit(0))
        return rows.withColumn("url", F.concat(F.lit(base), stamp, F.lpad(F.col("idx").cast("string"), 4, "0"), F.lit(".aspx")))
    if source == "chinatimes":
        choices = [(r, p, c) for r, (c, p) in enumerate((c, p) for c in CATEGORIES[source] for p in PATHS[source])]
        rows = days.withColumn("idx", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
        rows = rows.withColumn("choice", F.explode(F.array(*[F.struct(F.lit(r).alias("rank"), F.lit(p).alias("path"), F.lit(c).alias("category")) for r, p, c in choices])))
        url = F.concat(F.lit(base), F.col("choice.path"), F.lit("/"), stamp, F.lpad(F.col("idx").cast("string"), 6, "0"), F.lit("-"), F.col("choice.category"))
        return rows.withColumn("rank", F.col("choice.rank")).withColumn("url", url).drop("choice")
    if source == "ftv":
        rows = days.withColumn("category", F.explode(F.array(*[F.lit(c) for c in CATEGORIES[source]])))
        last = F.when(F.col("category") == "W", F.lit(most - 1)).otherwise(F.lit(30))
        rows = rows.withColumn("idx", F.explode(F.sequence(F.lit(1), last))).withColumn("rank", F.lit(0))
        width = F.when(F.col("category") == "W", F.lpad(F.col("idx").cast("string"), 4, "0")).otherwise(F.concat(F.lpad(F.col("idx").cast("string"), 2, "0"), F.lit("M1")))
        code = F.concat(F.date_format("day", "yyyy"), F.conv(F.month("day").cast("string"), 10, 16), F.date_format("day", "dd"), "category", width)
        return rows.withColumn("url", F.concat(F.lit(base), code))
    raise ValueError(f"{source} has no numbered addresses by day")


def first_hit(log: DataFrame, group: list[str]) -> DataFrame:
    """Of the choices tried for each ``group``, the first by rank that answered."""
    return log.filter(F.col("ok")).groupBy(*group).agg(F.min_by("url", "rank").alias("url"), F.min("rank").alias("rank"))


def listing_frontier(spark: SparkSession, source: str, pages: int | None = None) -> DataFrame:
    """category, page and place of listing pages, categories in order."""
    pages = LISTING_PAGES[source] if pages is None else pages
    rows = [(i, c, p) for i, c in enumerate(CATEGORIES[source]) for p in range(1, pages + 1)]
    return spark.createDataFrame(rows, "place int, category string, page int")


def index_chunks(first: int, latest: int, chunk: int, fetch: Callable[[int, int], int]) -> Iterator[tuple[int, int]]:
    """Half-open ranges of ids, handed to ``fetch``, which says how many articles came; without an end, up to
    the first range without any."""
    check_indexes(first, latest)
    at = first
    while latest == -1 or at <= latest:
        end = at + chunk if latest == -1 else min(at + chunk, latest + 1)
        came = fetch(at, end)
        yield at, end
        if latest == -1 and not came:
            return
        at = end


def index_chunks_down(first: int, latest: int, chunk: int) -> Iterator[tuple[int, int]]:
    """Ranges of ids, both ends included, from the newest down; as the source has it, a range reaches one below its part."""
    if first <= 0 or latest < first:
        raise ValueError("first must be positive and latest at least first")
    for at in range(latest, first - 1, -chunk):
        yield max(at - chunk, first - 1), at


def walk_ids(first: int, latest: int, ask: Callable[[int], list[int]], most: int = 500) -> list[int]:
    """Ids from ``first`` to ``latest`` of lists that ``ask`` gives for the id to go on from: the smallest one seen, downwards.

    It ends where a list is empty or has no smaller id, or after ``most`` failures in a row.
    """
    found, at, failed = {latest}, latest, 0
    while first <= at <= latest and failed < most:
        try:
            got = ask(at)
        except Exception:  # noqa: BLE001 - a failed request is asked again
            failed += 1
            continue
        own = [x for x in got if first <= x <= latest]
        found |= set(own)
        if not own or min(own) >= at:
            break
        at, failed = min(own), 0
    return sorted(found)


def fetch_pages(urls: DataFrame, fetcher: Fetcher) -> DataFrame:
    """status, body and error for every row of ``urls`` (seq, and url or choices); a request that raises has status 0.

    Of choices, which are tried in order, the first that answers counts, else the last.
    """
    tried = F.col("choices") if "choices" in urls.columns else F.array("url")

    def ask(url: str) -> tuple:
        try:
            return (url, *fetcher(url), None)
        except Exception as e:  # noqa: BLE001 - a failed request is a row
            return url, 0, "", str(e) or "request failed"

    def first(choices: list[str]) -> tuple:
        got = (None, 0, "", "nothing to fetch")
        for url in choices:
            got = ask(url)
            if got[1] == 200:
                break
        return got

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(seq, *first(list(choices))) for seq, choices in zip(frame["seq"], frame["choices"], strict=True)]
            yield pd.DataFrame(rows, columns=["seq", "url", "status", "body", "error"])

    got = urls.select("seq", tried.alias("choices")).mapInPandas(run, "seq long, url string, status int, body string, error string")
    label = F.when(F.col("status") == 0, F.col("error")).otherwise(F.nullif(status_class(F.col("status")), F.lit("ok")))
    return got.withColumn("error", label).withColumn("ok", label.isNull())


def in_dates(day: Column, past: Column, current: Column) -> Column:
    """Whether a day is in the window, bounds included; without a day, not."""
    return F.coalesce(day.between(past, current), F.lit(False))


def in_indexes(idx: Column, first: int, latest: int) -> Column:
    return idx.between(first, latest)


def start_page(items: DataFrame, past: Column, current: Column) -> DataFrame:
    """start_page by ``items`` (page, day), newest first: the first page with a day in the window, unless a page that
    lies wholly before it comes first."""
    pages = items.groupBy("page").agg(F.max("day").alias("newest"), F.max(in_dates(F.col("day"), past, current)).alias("hit"))
    found, over = F.min(F.when(F.col("hit"), F.col("page"))), F.min(F.when(F.col("newest") < past, F.col("page")))
    return pages.agg(found.alias("found"), over.alias("over")).select(F.when(F.col("over").isNull() | (F.col("found") < F.col("over")), F.col("found")).alias("start_page"))


def page_bounds(items: DataFrame, past: Column, current: Column) -> DataFrame:
    """first_page and last_page whose times reach into the window, for listings sorted by time."""
    pages = items.groupBy("page").agg(F.min("day").alias("oldest"), F.max("day").alias("newest")).filter((F.col("oldest") <= current) & (F.col("newest") >= past))
    return pages.agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"))


def last_available(has_items: Callable[[int], bool], most: int = 1 << 16) -> int:
    """The last page with items, 0 without any: steps that double, then halving."""
    low, high = 0, 1
    while high <= most and has_items(high):
        low, high = high, 2 * high
    high = min(high, most + 1)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if has_items(middle) else (low, middle)
    return low


def last_where(holds: Callable[[int], bool], most: int) -> int:
    """The last of the pages 1 to ``most`` that a test holds for which, once it fails, fails for all later ones; 0 without any."""
    low, high = 0, most + 1
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if holds(middle) else (low, middle)
    return low


def latest_id(ids: DataFrame, first: int, bound: int) -> DataFrame:
    """latest: the largest id from ``first`` to ``bound``, or ``first``."""
    return ids.agg(F.coalesce(F.max(F.when(F.col("idx").between(first, bound), F.col("idx"))), F.lit(first)).alias("latest"))


def quoted_ids(text: str | None) -> list[str]:
    """The ids of a list such as ``,'12','34'``."""
    return re.findall(r"\d+", text or "")


def listed_ids(api: DataFrame, column: str = "news_id_list") -> DataFrame:
    """Distinct ids of quoted lists such as ``,'12','34'``."""
    return api.select(F.explode(F.regexp_extract_all(F.col(column), F.lit(r"(\d+)"), F.lit(1))).alias("idx")).select(F.col("idx").cast("long").alias("idx")).distinct()


def _items(api: DataFrame, items: Column, place: bool) -> DataFrame:
    return api.select("*", F.posexplode(items).alias("place", "item")) if place else api.withColumn("item", F.explode(items))


def listed_urls(api: DataFrame, column: str = "body", place: bool = False) -> DataFrame:
    """Addresses of a listing's ``data``, which is an array of objects or, on later pages, a map of them."""
    as_list = F.from_json(F.col(column), "data array<struct<url:string>>")["data"]
    as_map = F.map_values(F.from_json(F.col(column), "data map<string,struct<url:string>>")["data"])
    return _items(api, F.coalesce(as_list, as_map), place).withColumn("url", F.col("item.url")).drop("item")


def listed_items(api: DataFrame, host: str = "https://udn.com", column: str = "body", place: bool = False) -> DataFrame:
    """url (without its query, with the host), stamp and day of a timed listing's ``lists``."""
    lists = F.from_json(F.col(column), "lists array<struct<time:struct<date:string>,titleLink:string>>")["lists"]
    rows = _items(api, lists, place).withColumn("stamp", F.try_to_timestamp("item.time.date", F.lit("yyyy-MM-dd HH:mm")))
    return rows.withColumn("url", F.concat(F.lit(host), F.substring_index("item.titleLink", "?", 1))).withColumn("day", F.col("stamp").cast("date")).drop("item")
