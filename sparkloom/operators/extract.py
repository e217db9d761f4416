"""Extraction of articles from pages: a description for each source, and one way to run them.

A row that fails keeps its reason in ``error`` and becomes quarantine; the others go on.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from types import ModuleType
from zoneinfo import ZoneInfo

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import html
from ..functions.arrow import Rule, cascade_text, frame_pieces, nfkc_text
from ..functions.rules import chinatimes, cna, epochtimes, ettoday, ftv, ltn, ntdtv, setn, storm, tvbs, udn
from ..functions.seek import Pack
from ..schemas import COMPANIES, PARSED, SHORT_NAMES

RESULT = T.StructType([*[T.StructField(f.name, f.dataType) for f in PARSED.fields], T.StructField("error", T.StringType())])


@dataclass(frozen=True)
class Options:
    """host_zone: where dates of addresses and local times hold. corrected: page times are local there, once; else
    they are shifted back by eight hours and then taken in ``host_zone``. strict: known faults of the rules stay."""

    host_zone: str = "Asia/Taipei"
    corrected: bool = False
    strict: bool = False


class Unreadable(Exception):
    pass


@dataclass
class Page:
    """A page on its way: its tree, and what has been read from it."""

    root: html.Node
    url: str
    options: Options
    article: str = ""
    title: str = ""
    category: str = ""
    reporter: str = ""
    timestamp: int = 0
    found: list[str] = field(default_factory=list)


def plain(text: str) -> str:
    """NFKC without inner white space touched."""
    return unicodedata.normalize("NFKC", text).strip()


def _rules(listed: list) -> list:
    return [Rule(*x) if isinstance(x, tuple) else re.compile(x) for x in listed]


def _texts(page: Page, selector: str, strip: bool = True) -> list[str]:
    return [x.text.strip() if strip else x.text for x in page.root.select(selector)]


def _one(page: Page, selector: str, at: int = 0) -> html.Node:
    found = page.root.select(selector)
    if not -len(found) <= at < len(found):
        raise Unreadable(f"nothing at {selector}")
    return found[at]


def _local(page: Page, stamp: datetime) -> int:
    return int(stamp.replace(tzinfo=ZoneInfo(page.options.host_zone)).timestamp())


def _page_time(page: Page, text: str, form: str) -> int:
    stamp = datetime.strptime(text, form)
    return _local(page, stamp if page.options.corrected else stamp - timedelta(hours=8))


def _harvest(page: Page, pack: Pack) -> None:
    """Every pattern's finds are reporters and leave the article."""
    page.article = nfkc_text(page.article)
    places = pack.places(page.article)
    for i, sought in enumerate(pack.sought):
        matches = list(sought.finditer(page.article, places[i]))
        if matches:
            page.found += ["".join(x or "" for x in m.groups()) if m.re.groups else m.group() for m in matches]
            ends = [0, *(m.end() for m in matches)]
            begins = [*(m.start() for m in matches), len(page.article)]
            page.article = nfkc_text("".join(page.article[a:b] for a, b in zip(ends, begins, strict=True)))
            places = pack.places(page.article)


def _cut_first(page: Page, pack: Pack, anchored: bool, strip: bool) -> None:
    """The first pattern found names the reporter and leaves the article."""
    places = None if anchored else pack.places(page.article)
    for i, sought in enumerate(pack.sought):
        if m := sought.pattern.match(page.article) if anchored else sought.search(page.article, places[i]):
            page.reporter = m.group(1)
            page.article = page.article[: m.start()] + page.article[m.end() :]
            if strip:
                page.article = page.article.strip()
            return


def _until(text: str, pack: Pack) -> str:
    """The text before what the first pattern found matches."""
    places = pack.places(text)
    return next((text[: m.start()] for p, at in zip(pack.sought, places, strict=True) if (m := p.search(text, at))), text)


def _softly(page: Page, name: str, read: Callable[[], object], default: object = "") -> None:
    """A field that may be missing."""
    try:
        setattr(page, name, read())
    except Exception:  # noqa: BLE001 - whatever is odd in a page, the field is empty then
        setattr(page, name, default)


def _strictly(what: str, read: Callable[[], None]) -> None:
    try:
        read()
    except Exception as e:
        raise Unreadable(f"no {what}: {e}") from e


class Extractor:
    """What holds for all sources; a source overrides what is its own."""

    name = ""
    rules: ModuleType
    empty_as_null = False
    repair: Callable[[str], str] = staticmethod(lambda raw: raw)

    def __init__(self):
        for key in ("REPORTERS_BEGIN", "ARTICLE", "TITLE", "ARTICLE_BAD", "TITLE_BAD", "ARTICLE_STOP", "ARTICLE_REMOVED"):
            setattr(self, key.lower(), _rules(getattr(self.rules, key, [])))
        for key in ("REPORTERS", "REPORTERS_END", "ARTICLE_END"):
            setattr(self, key.lower(), Pack(getattr(self.rules, key, [])))
        for key in ("ARTICLE_AT", "TITLE_AT", "REMOVED_AT"):
            setattr(self, key.lower(), getattr(self.rules, key, ""))

    def __call__(self, raw: str, url: str, options: Options) -> Page:
        page = Page(html.parse(self.repair(raw)), url, options)
        _strictly("article", lambda: self.article_of(page))
        _softly(page, "category", lambda: self.category_of(page))
        self.time_of(page)
        before = page.article
        try:
            self.reporter_of(page)
        except Exception:  # noqa: BLE001 - an odd byline leaves the article as it was
            page.reporter, page.article = "", before
        _strictly("title", lambda: self.title_of(page))
        _strictly("clean article", lambda: self.clean(page))
        return page

    def article_of(self, page: Page) -> None:
        raise NotImplementedError

    def category_of(self, page: Page) -> str:
        return ""

    def read_time(self, page: Page) -> int:
        return 0

    def time_of(self, page: Page) -> None:
        _softly(page, "timestamp", lambda: self.read_time(page), 0)

    def reporter_of(self, page: Page) -> None:
        pass

    def title_of(self, page: Page) -> None:
        raise NotImplementedError

    def clean(self, page: Page) -> None:
        page.article = cascade_text(page.article, self.article)
        page.title = cascade_text(page.title, self.title)


class Cascade(Extractor):
    """Sources with ordered rewrite rules."""

    def article_of(self, page: Page) -> None:
        if self.removed_at:
            for x in page.root.select(self.removed_at):
                x.remove()
        page.article = nfkc_text(" ".join(_texts(page, self.article_at, strip=False)))

    def title_of(self, page: Page) -> None:
        node = page.root.first(self.title_at)
        if node is None:
            raise Unreadable("nothing there")
        page.title = nfkc_text(node.text)

    def time_of(self, page: Page) -> None:
        def read() -> None:
            page.timestamp = self.read_time(page)

        _strictly("datetime", read)


class Chinatimes(Extractor):
    name, rules = "chinatimes", chinatimes
    bad = Pack(chinatimes.ARTICLE_BAD)

    def article_of(self, page):
        texts = _texts(page, "div.article-body > p")
        whole = " ".join(filter(None, texts)) if texts else _one(page, "div.article-body").text
        page.article = _until(plain(whole), self.bad)

    def category_of(self, page):
        return plain(_one(page, "nav.breadcrumb-wrapper > ol > li > a > span", -1).text)

    def read_time(self, page):
        return _page_time(page, _one(page, "header.article-header time[datetime]").attrs["datetime"], "%Y-%m-%d %H:%M")

    def reporter_of(self, page):
        author = _one(page, "div.author")
        page.reporter = plain((author.first("a") or author).text)

    def title_of(self, page):
        page.title = plain(_one(page, "h1.article-title").text)

    def clean(self, page):
        pass


class Cna(Cascade):
    name, rules, empty_as_null = "cna", cna, True

    def category_of(self, page):
        return nfkc_text(_one(page, "div.breadcrumb > a", 1).text)

    def read_time(self, page):
        return _local(page, datetime.strptime(page.url[:8], "%Y%m%d"))

    def reporter_of(self, page):
        _harvest(page, self.reporters)
        page.reporter = ",".join(map(nfkc_text, page.found))

    def title_of(self, page):
        page.title = nfkc_text("".join(_texts(page, self.title_at, strip=False)))


class Epochtimes(Cascade):
    name, rules, empty_as_null = "epochtimes", epochtimes, True

    def category_of(self, page):
        return ",".join(dict.fromkeys(nfkc_text(x) for x in _texts(page, "a.breadcrumbs")[1:]))

    def read_time(self, page):
        year, month, day, _ = page.url.split("-")
        return _local(page, datetime.strptime(f"20{year}{month}{day}", "%Y%m%d") if page.options.strict else datetime(2000 + int(year), int(month), int(day)))

    def reporter_of(self, page):
        _harvest(page, self.reporters)
        page.reporter = nfkc_text(re.sub(r"[\s、/]+", ",", ",".join(map(nfkc_text, page.found))))


def hoist_images(raw: str) -> str:
    """Images out of the strong text that they stand in, in one pass: an image goes before all tags of strong text that have
    nothing but text between each other and it. Where a tag holds another's beginning, images move step by step."""
    end = raw.rfind(">") + 1
    tokens = list(re.finditer(r"(<strong[^>]*>)|(<img[^>]*>)|(<)|[^<]+", raw[:end]))
    if any((m[1] or m[2] or "").count("<") > 1 for m in tokens):
        step = re.compile(r"(<strong[^>]*>[^<]*)(<img[^>]*>)")
        while (after := step.sub(r"\2\1", raw)) != raw:
            raw = after
        return raw
    out, chain = [], []
    for m in tokens:
        if m[1] or chain and not (m[2] or m[3]):
            chain.append(m[0])
            continue
        if m[3]:
            out += chain
            chain = []
        out.append(m[0])
    return "".join([*out, *chain, raw[end:]])


class Ettoday(Cascade):
    name, rules, empty_as_null = "ettoday", ettoday, True

    @staticmethod
    def repair(raw):
        first, *parts = re.split(r"<br\s*/>", raw)
        if parts:
            raw = " ".join([first.rstrip(), *filter(None, map(str.strip, parts[:-1])), parts[-1].lstrip()])
        return hoist_images(raw)

    def category_of(self, page):
        last = nfkc_text(_one(page, "div:is(.menu_bread_crumb, .part_breadcrumb) > div > a > span", -1).text)
        return re.sub(r"(?:ET)?(?:today)?([^雲]*)雲?$", r"\1", last)

    def read_time(self, page):
        return int(datetime.strptime(_one(page, 'meta[name="pubdate"]').attrs["content"], "%Y-%m-%dT%H:%M:%S%z").timestamp())

    def reporter_of(self, page):
        _harvest(page, self.reporters)
        steps = [("[、]+", ","), (r"([a-zA-Z\d])\s+(?=\w)", r"\1-"), (r"(?<=\w)\s+([a-zA-Z\d])", r"-\1"), (r"\s+", ",")]
        page.reporter = cascade_text(",".join(map(nfkc_text, page.found)), _rules(steps)).removesuffix(",")


class Ftv(Extractor):
    name, rules = "ftv", ftv

    def article_of(self, page):
        page.article = plain(" ".join(_texts(page, "div#preface > p, div#newscontent > p")))

    def category_of(self, page):
        return ftv.CATEGORIES[page.url.split("/")[-1][7]]

    def read_time(self, page):
        code = page.url.split("/")[-1]
        return _local(page, datetime(int(code[:4]), int(code[4], 16), int(code[5:7])))

    def reporter_of(self, page):
        for pattern in self.reporters_begin:
            if m := pattern.match(page.article):
                page.reporter, page.article = m.group(1).strip(), page.article[m.end() :].strip()
                break
        places = self.reporters_end.places(page.article)
        for i, sought in enumerate([] if page.reporter else self.reporters_end.sought):
            if m := sought.search(page.article, places[i]):
                page.reporter, page.article = m.group(1).strip(), page.article[: m.start()].strip()
                break

    def title_of(self, page):
        page.title = plain(_one(page, "div.col-article > h1.text-center").text)
        for pattern in self.title_bad:
            page.title = pattern.sub("", page.title, count=1)

    def clean(self, page):
        for pattern in self.article_bad:
            page.article = pattern.sub("", page.article)
        page.article = re.sub(r"\s+", " ", page.article).strip()
        if page.article and page.article[-1] not in "。!?":
            page.article += "。"


class Ltn(Extractor):
    name, rules = "ltn", ltn

    def article_of(self, page):
        nodes = page.root.select("div[itemprop=articleBody] div.boxText.text.boxTitle > p:not([class])")
        related = [i for i, x in enumerate(nodes) if isinstance(y := x.previous(), html.Node) and "相關新聞" in y.text]
        if related:
            if page.options.strict:
                raise Unreadable("related news")
            nodes = nodes[: related[0]]
        texts = [x.text.strip() for x in nodes]
        page.article = plain(" ".join(t for t in texts if not any(p.match(t) for p in self.article_bad)))

    def category_of(self, page):
        return plain(_one(page, "div.breadcrumbs > a", -1).text)

    def read_time(self, page):
        return _page_time(page, _one(page, "div.text.boxTitle.boxText > span.time").text, " %Y/%m/%d %H:%M")

    def reporter_of(self, page):
        _cut_first(page, self.reporters, anchored=False, strip=False)

    def title_of(self, page):
        page.title = plain(_one(page, "div.whitecon > h1").text)

    def clean(self, page):
        pass


class Ntdtv(Cascade):
    name, rules, empty_as_null = "ntdtv", ntdtv, True

    def category_of(self, page):
        return ",".join(dict.fromkeys(nfkc_text(x) for x in _texts(page, "div#breadcrumb > a")[2:]))

    def read_time(self, page):
        return _local(page, datetime.strptime(page.url[:10], "%Y-%m-%d"))

    def reporter_of(self, page):
        _harvest(page, self.reporters)
        page.reporter = nfkc_text(re.sub(r"[\s、]+", ",", ",".join(map(nfkc_text, page.found))))


class Setn(Extractor):
    name, rules = "setn", setn

    def article_of(self, page):
        texts = _texts(page, "div#Content1 > p:not([class]):not([style])")
        page.article = _until(plain(" ".join(filter(None, texts))), self.article_end).strip()

    def category_of(self, page):
        code = _one(page, "input[type=hidden]#pageGroupID, input[type=hidden]#hfPageGroupId").attrs["value"]
        return setn.CATEGORIES[code if page.options.strict else int(code)]

    def read_time(self, page):
        return _page_time(page, _one(page, "time.page-date").text, "%Y/%m/%d %H:%M:%S")

    def reporter_of(self, page):
        _cut_first(page, self.reporters, anchored=True, strip=True)

    def title_of(self, page):
        page.title = plain(_one(page, "h1.news-title-3").text)

    def clean(self, page):
        pass


class Storm(Cascade):
    name, rules = "storm", storm

    def category_of(self, page):
        return nfkc_text(",".join(_texts(page, "div#title_tags_wrapper a", strip=False)))

    def time_of(self, page):
        Extractor.time_of(self, page)

    def read_time(self, page):
        return _page_time(page, _one(page, "span#info_time").text.strip(), "%Y-%m-%d %H:%M")

    def reporter_of(self, page):
        page.reporter = nfkc_text(_one(page, "div#author_block span.info_author").text)

    def title_of(self, page):
        page.title = nfkc_text("".join(_texts(page, self.title_at, strip=False)))


class Tvbs(Extractor):
    name, rules = "tvbs", tvbs

    def article_of(self, page):
        body = _one(page, "div#news_detail_div > html > body")
        for x in body.select("div.img, div[style], span.endtext, b"):
            x.remove()
        parts = []
        for child in filter(None, body.children):
            text = child.text if isinstance(child, html.Node) else child
            if any(p.match(text) for p in self.article_stop):
                break
            for pattern in self.article_removed:
                text = pattern.sub("", text)
            if text:
                parts.append(text + " ")
        page.article = plain("".join(parts))

    def category_of(self, page):
        return tvbs.CATEGORIES[re.match(r"/(.*?)/\d+" if page.options.strict else r"(\w+)-\d+", page.url).group(1)]

    def read_time(self, page):
        stamp = datetime.fromisoformat(_one(page, "meta[name=pubdate]").attrs["content"])
        if not page.options.corrected:
            stamp -= timedelta(hours=8)
        return int(stamp.timestamp()) if stamp.tzinfo else _local(page, stamp)

    def reporter_of(self, page):
        page.reporter = plain(_one(page, "div.author_box > div.author > a").text)

    def title_of(self, page):
        page.title = plain(_one(page, "div.title_box > h1.title").text)

    def clean(self, page):
        pass


class Udn(Extractor):
    name, rules = "udn", udn
    EDITOR = "section.article-content__editor"

    @staticmethod
    def repair(raw):
        return raw.replace("<blockquote", "</p><blockquote").replace("</blockquote>", "</blockquote><p>")

    def article_of(self, page):
        for x in page.root.select("figure.article-content__image, style, script, div.inline-ads"):
            x.remove()
        for quoted in page.root.select("blockquote"):
            if any(a.text.strip() == "...more" for a in quoted.select("a")):
                quoted.remove()
        page.article = " ".join(_texts(page, f"{self.EDITOR} > p, {self.EDITOR} > blockquote"))
        for pattern in self.article_removed if page.options.strict else [self.article_removed[0], re.compile(re.escape("...more"))]:
            page.article = pattern.sub("", page.article)
        page.article = plain(page.article)

    def category_of(self, page):
        return plain(_one(page, "nav.article-content__breadcrumb > a.breadcrumb-items", -2).text)

    def read_time(self, page):
        return _page_time(page, _one(page, "section.authors > time.article-content__time").text, "%Y-%m-%d %H:%M")

    def reporter_of(self, page):
        page.reporter = plain(",".join(_texts(page, "section.authors > span.article-content__author > a", strip=False)))

    def title_of(self, page):
        page.title = plain(_one(page, "h1.article-content__title").text)

    def clean(self, page):
        pass


#: By company id; further sources are appended.
EXTRACTORS: list[Extractor] = [Chinatimes(), Cna(), Epochtimes(), Ettoday(), Ftv(), Ltn(), Ntdtv(), Setn(), Storm(), Tvbs(), Udn()]


def extract_one(company: int | None, raw: str | None, url: str | None, options: Options) -> tuple:
    """article, category, reporter, timestamp, title and error of a page."""
    try:
        if company is None or not 0 <= company < len(EXTRACTORS):
            raise Unreadable(f"unknown company {company}")
        own = EXTRACTORS[int(company)]
        page = own(raw or "", url or "", options)
        blank = None if own.empty_as_null else ""
        return page.article, page.category or blank, page.reporter or blank, page.timestamp, page.title, None
    except Exception as e:  # noqa: BLE001 - one page never stops the others
        name = COMPANIES[int(company)][1] if company is not None and 0 <= company < len(COMPANIES) else "unknown"
        return None, None, None, None, None, f"{name}: {e}"


def extract(raw: DataFrame, options: Options | None = None) -> DataFrame:
    """Articles of raw pages, with ``error`` where a page could not be read; no page is left out. file_ord is kept where ``raw`` has it.
    Pages of a batch, their trees and articles are Python objects a piece at a time."""
    options = options or Options()
    ordinal = [c for c in ("file_ord",) if c in raw.columns]
    names, schema = [*RESULT.names, *ordinal], T.StructType([*RESULT.fields, *(T.StructField(c, T.IntegerType()) for c in ordinal)])

    kinds = {f.name: {T.LongType: pa.int64(), T.IntegerType: pa.int32()}.get(type(f.dataType), pa.string()) for f in schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in frame_pieces(whole, ["raw_xml"]):
                pages = zip(*(batch.column(c).to_pylist() for c in ("company_id", "raw_xml", "url_pattern")), strict=True)
                made = list(zip(*(extract_one(c, r, u, options) for c, r, u in pages), strict=True))
                done = {c: pa.array(own, kinds[c]) for c, own in zip(("article", "category", "reporter", "timestamp", "title", "error"), made, strict=True)}
                done |= {c: batch.column(c).cast(kinds[c]) for c in ("id", "company_id", "url_pattern", *ordinal)}
                yield pa.RecordBatch.from_arrays([done[c] for c in names], names=names)

    return raw.select("id", "company_id", "raw_xml", "url_pattern", *(F.col(c).cast("int").alias(c) for c in ordinal)).mapInArrow(run, schema)


def readable(extracted: DataFrame) -> DataFrame:
    return extracted.filter("error is null").drop("error")


def quarantine(extracted: DataFrame) -> DataFrame:
    """Pages that could not be read, with the reason."""
    return extracted.filter("error is not null").select("id", "company_id", "url_pattern", "error", *[c for c in ("file_ord",) if c in extracted.columns])


def listing_links(pages: DataFrame, selector: str, column: str = "raw_xml") -> DataFrame:
    """A row for each address that ``selector`` finds in a listing page, as ``link``, in order at ``place``."""

    @F.pandas_udf("array<string>")
    def links(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [x.attrs["href"] for x in html.parse(t or "").select(selector) if "href" in x.attrs])

    return pages.select("*", F.posexplode(links.asNondeterministic()(column)).alias("place", "link"))


def page_not_found(pages: DataFrame, source: str, column: str = "raw_xml") -> DataFrame:
    """``missing`` for pages that say with status 200 that there is none: a script that alerts, or no title."""
    tests = {"ftv": lambda root: (x := root.first("script")) is not None and x.text.startswith("alert"), "storm": lambda root: root.first("h1#article_title") is None}
    test = tests[source]

    @F.pandas_udf("boolean")
    def missing(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: bool(test(html.parse(t or ""))))

    return pages.withColumn("missing", missing.asNondeterministic()(column))


def max_page(html_text: str) -> int:
    """The last page that a pager shows, 1 without one."""
    numbers = html.parse(html_text).select("a.page-numbers")
    return int(numbers[-2].text.replace(",", "")) if len(numbers) > 1 else 1


def day_of_url(url: str, source: str) -> datetime | None:
    """The day in an address of epochtimes or ntdtv, as ``columns.url_date`` has it; None without one."""
    m = re.match(re.escape(COMPANIES[SHORT_NAMES.index(source)][2]) + r"(\d+)/(\d+)/(\d+)/[an]\d+\.htm", url)
    if not m:
        return None
    year, month, day = map(int, m.groups())
    try:
        return datetime(year + 2000 if source == "epochtimes" else year, month, day, tzinfo=UTC)
    except ValueError:
        return None


def utc(seconds: int) -> datetime:
    return datetime.fromtimestamp(seconds, UTC)
