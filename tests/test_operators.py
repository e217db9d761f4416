import json
import random
import re
import sqlite3
import time
import zlib
from datetime import UTC, datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkloom import queries, schemas
from sparkloom.operators import entities, extract, frontier, gazetteer, keyindex, relops
from sparkloom.plans import cli, crawl, jobs
from sparkloom.sources import newsdb
from sparkloom.streaming.ingest import append_stream

CNA = """<html><div class="breadcrumb"><a>首頁</a><a>政治</a></div><div class="centralContent"><h1><span>標題★</span></h1>
<div class="paragraph"><p>(中央社記者王小明台北12日電)今天天氣好。</p><p>第二段。(編輯:李四)1101012</p></div><div class="paragraph"><p>不要</p></div></div></html>"""


def test_extract_isolates_errors(spark):
    rows = [(1, 1, CNA, "202110120001"), (2, 1, CNA, "not a date"), (3, 99, CNA, "x"), (4, 0, "", "y"), (5, None, None, None)]
    raw = spark.createDataFrame(rows, "id long, company_id int, raw_xml string, url_pattern string")
    done = extract.extract(raw).cache()
    good = extract.readable(done).collect()
    assert [(r["id"], r["title"], r["category"], r["timestamp"]) for r in good] == [(1, "標題", "政治", 1633968000)]
    assert good[0]["article"] == "今天天氣好。 第二段。" and "王小明" in good[0]["reporter"]
    lost = {r["id"]: r["error"] for r in extract.quarantine(done).collect()}
    assert set(lost) == {2, 3, 4, 5} and lost[2].startswith("cna: ") and "unknown company 99" in lost[3]


def test_other_sources():
    options = extract.Options()
    page = '<div class="article-body"><p> a </p><p></p><p>b 更多內容 x</p></div><h1 class="article-title">t</h1><header class="article-header"><time datetime="2021-10-12 08:00"></time></header>'
    assert extract.extract_one(0, page, "u", options)[:5] == ("a b ", "", "", 1633968000, "t")
    page = '<div class="col-article"><h1 class="text-center">快新聞/標題</h1></div><div id="newscontent"><p>記者王/台北報導 內文</p></div>'
    article, category, _, stamp, title, error = extract.extract_one(4, page, "2021A12W0001", options)
    assert (category, title, error) == ("一般", "標題", None) and article.endswith("。")
    assert stamp == int(datetime(2021, 10, 11, 16, tzinfo=UTC).timestamp())
    page = '<div class="whitecon"><h1>T</h1></div><div itemprop="articleBody"><div class="text boxTitle boxText"><p>〔記者王/台北報導〕內文</p><p>首次上稿 10:00</p></div></div>'
    assert extract.extract_one(5, page, "u", options)[:3] == ("內文", "", "王")
    page = '<input type="hidden" id="pageGroupID" value="6"><div id="Content1"><p>記者王/台北報導 文</p></div><h1 class="news-title-3">T</h1>'
    assert extract.extract_one(7, page, "u", options)[:3] == ("文", "政治", "王")
    assert extract.extract_one(7, page, "u", extract.Options(strict=True))[1] == ""
    page = '<h1 id="article_title">T</h1><div id="CMS_wrapper"><p aid="1">文</p><blockquote>x</blockquote></div><span id="info_time">2021-10-12 08:00</span>'
    assert extract.extract_one(8, page, "u", extract.Options(corrected=True))[3] == 1633996800
    page = '<div class="title_box"><h1 class="title">T</h1></div><div id="news_detail_div"><html><body>一<div class="img">圖</div><p>二</p>《TVBS》提醒您 尾</body></html></div>'
    assert extract.extract_one(9, page, "life-1", options)[:2] == ("一 二", "生活")
    page = '<h1 class="article-content__title">T</h1><section class="article-content__editor"><p>甲<blockquote>乙</blockquote>丙</p></section>'
    assert extract.extract_one(10, page, "u", options)[0].split() == ["甲", "乙", "丙"]
    page = '<meta name="pubdate" content="2021-10-12T08:00:00+08:00"><h1 class="title">T</h1><div class="story"><p>甲<br/>乙</p><p class="note">x</p></div>'
    assert extract.extract_one(3, page, "u", options)[3] == 1633996800
    for company, url in ((2, "21-10-12-1"), (6, "2021-10-12-1")):
        page = '<h1 class="title">T</h1><div class="main_title">T</div><div id="artbody"><p>文</p></div><div class="article_content"><p>文</p></div>'
        assert extract.extract_one(company, page, url, options)[3] == 1633968000


def test_page_not_found_and_links(spark):
    pages = spark.createDataFrame([(1, "<script>alert(1)</script>"), (2, '<h1 id="article_title">x</h1><a href="/a">a</a><a>b</a>')], "id long, raw_xml string")
    assert [r["missing"] for r in extract.page_not_found(pages, "ftv").orderBy("id").collect()] == [True, False]
    assert [r["missing"] for r in extract.page_not_found(pages, "storm").orderBy("id").collect()] == [True, False]
    assert [r["link"] for r in extract.listing_links(pages, "a").collect()] == ["/a"]
    assert extract.max_page('<a class="page-numbers">1</a><a class="page-numbers">1,234</a><a class="page-numbers">next</a>') == 1234
    assert extract.max_page("") == 1


def test_dedup_merge_and_cutoff_match_a_model(spark):
    rng = random.Random(1)
    rows = [(i, rng.randrange(3), str(rng.randrange(8)), rng.randrange(5)) for i in range(120)]
    frame = spark.createDataFrame(rows, "id long, company_id int, url_pattern string, timestamp long")
    seen = {}
    for r in rows:
        seen.setdefault(r[1:3], r[0])
    assert {r["id"] for r in relops.dedup_first(frame, ["id"]).collect()} == set(seen.values())
    target = frame.filter("id < 20")
    assert all(r["id"] >= 20 for r in relops.dedup_first(frame, ["id"], target=target).collect())
    merged = relops.merge_parsed([frame.filter("id % 2 = 0"), frame.filter("id % 2 = 1")]).collect()
    best = {}
    for r in sorted(rows, key=lambda r: (r[3], r[0] % 2, r[0])):
        best.setdefault(r[1:3], r[0])
    assert [r["id"] for r in merged] == list(best.values())
    log = [(1, i, rng.random() > 0.5) for i in range(60)]
    want, fails = [], 0
    for _, seq, ok in log:
        fails = 0 if ok else fails + 1
        if fails >= 3:
            break
        want += [seq] if ok else []
    got = relops.failure_cutoff(spark.createDataFrame(log, "g int, seq long, ok boolean"), 3, ["g"]).orderBy("seq").collect()
    assert [r["seq"] for r in got] == want


def test_split_and_pages(spark):
    rows = spark.range(2500).select((F.col("id") * 3).alias("id"))
    names = {(r["start"], r["end"]) for r in relops.split_chunks(rows, 1000, ["id"]).select("start", "end").distinct().collect()}
    assert names == {(1, 1000), (1001, 2000), (2001, 2500)}
    assert [r["n"] for r in relops.numbered(rows, ["id"]).orderBy("id").limit(3).collect()] == [1, 2, 3]
    assert jobs.chunk_name("/data/raw/a/b.db", 1, 1000, "/data/raw") == "a/b__1_1000.db"
    assert jobs.chunk_name("/other/b.db", 1, 10, "/data/raw") == "other/b__1_10.db"
    for bad, kind in ((0, ValueError), ("1", TypeError)):
        with pytest.raises(kind):
            relops.page_of(rows, bad)
    assert relops.timestamp_bounds(spark.createDataFrame([], "timestamp long")).first() == (None, None)


def test_database_round_trip(spark, tmp_path):
    path = str(tmp_path / "deep" / "a.db")
    rows = [(i, i % 3, f"<p>{i}</p>", str(i % 7)) for i in range(50)]
    frame = spark.createDataFrame(rows, schemas.RAW)
    newsdb.write_database(frame, path, "raw_news", ["id"])
    newsdb.write_database(frame, path, "raw_news", ["id"])
    assert newsdb.is_sqlite(path) and not newsdb.is_sqlite("a.db")
    assert newsdb.find_databases([str(tmp_path)]) == [path]
    back = newsdb.read_databases(spark, [str(tmp_path)], "raw_news", chunk=5)
    assert sorted((r["company_id"], r["raw_xml"], r["url_pattern"], r["file_ord"]) for r in back.collect()) == sorted((b, c, d, 0) for a, b, c, d in rows[:21])
    assert newsdb.read_databases(spark, [str(tmp_path / "none")], "raw_news").count() == 0
    with pytest.raises(TypeError):
        newsdb.checked_name(3)
    with pytest.raises(ValueError):
        newsdb.checked_name("")
    with sqlite3.connect(tmp_path / "old.db") as c:
        c.execute("CREATE TABLE news (id INTEGER, company TEXT, raw_xml TEXT, url TEXT)")
        c.execute("INSERT INTO news VALUES (1, '中央社', ' <p>  x </p>', 'https://www.cna.com.tw/news/aipl/1.aspx')")
    old = newsdb.read_databases(spark, [str(tmp_path / "old.db")], "news")
    assert tuple(jobs.migrate(old, "v1").select("company_id", "raw_xml", "url_pattern").first()) == (1, "<p> x </p>", "1")


def test_preprocess_order(spark):
    config = jobs.Preprocess(numbers=True, english=True, parens=True, least=1)
    assert [n for n, *_ in jobs.stages(config)] == ["nfkc", "paren", "length", "english", "number"]
    row = (1, "看(圖)Hello ①2", None, 1, "", 0, "題(x)", "u")
    done = jobs.preprocess(spark.createDataFrame([row], schemas.PARSED), config).first()
    assert (done["article"], done["title"], done["category"], done["reporter"]) == ("看<en>", "題", None, "")


def test_frontier(spark):
    with pytest.raises(ValueError):
        frontier.check_range(datetime(2021, 1, 2, tzinfo=UTC), datetime(2021, 1, 1, tzinfo=UTC))
    with pytest.raises(ValueError):
        frontier.check_indexes(0, 5)
    assert frontier.last_available(lambda p: p <= 37) == 37 and frontier.last_available(lambda p: False) == 0
    came = iter([3, 2, 0, 9])
    assert list(frontier.index_chunks(1, -1, 10, lambda a, b: next(came))) == [(1, 11), (11, 21), (21, 31)]
    assert list(frontier.index_chunks(1, 25, 10, lambda a, b: 0)) == [(1, 11), (11, 21), (21, 26)]
    assert all(0 < frontier.jitter(5) <= 5 for _ in range(100))
    assert frontier.wait_seconds("cna", 403) == 0 and frontier.wait_seconds("tvbs", 403) > 120

    def fetch(url):
        if url == "bad":
            raise TimeoutError("slow")
        return (200 if url == "good" else 404), "body"

    got = frontier.fetch_pages(spark.createDataFrame([(1, "good"), (2, "bad"), (3, "gone")], "seq long, url string"), fetch).orderBy("seq").collect()
    assert [(r["ok"], r["error"]) for r in got] == [(True, None), (False, "slow"), (False, "not found")]
    items = spark.createDataFrame([(json.dumps({"lists": [{"time": {"date": "2021-10-12 08:00"}, "titleLink": "/n/1?x=2"}]}),)], "body string")
    assert frontier.listed_items(items).first()["url"] == "https://udn.com/n/1"


SF_DIR = "/root/testdata/sf0.001"


def test_frontier_queries_cover_the_days(spark):
    """All numbers of all days of the events."""
    days = {str(r[0]) for r in spark.read.parquet(f"{SF_DIR}/events.parquet").select(F.to_date("ts")).distinct().collect()}
    cna = "https://www.cna.com.tw/news/aipl/"
    want = {(day, i, f"{cna}{day.replace('-', '')}{i:04}.aspx") for day in days for i in range(10_000)}
    got = queries.index_frontier(spark, SF_DIR).collect()
    assert len(got) == len(want) and {(str(r["day"]), r["idx"], r["url"]) for r in got} == want
    code = lambda day: f"{day[:4]}{int(day[5:7]):X}{day[8:]}"
    want = {(c, i, f"https://www.ftvnews.com.tw/news/detail/{code(day)}{c}{i:0{4 if c == 'W' else 2}}{'' if c == 'W' else 'M1'}") for day in days for c in "ACFIJLNPRSUW" for i in range(1, 10_000 if c == "W" else 31)}
    got = queries.hex_frontier(spark, SF_DIR).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert [str(r["day"]) for r in queries.day_frontier(spark, SF_DIR).orderBy("place").collect()] == sorted(days, reverse=True)
    grid = frontier.index_frontier(frontier.day_frontier(spark, "2021-10-12", "2021-10-12"), "chinatimes").select("idx", "rank", "url")
    choices = [(p, c) for c in frontier.CATEGORIES["chinatimes"] for p in frontier.PATHS["chinatimes"]]
    make = lambda i, rank: f"https://www.chinatimes.com/{choices[rank][0]}/20211012{i:06}-{choices[rank][1]}"
    by_rank = {r["rank"]: tuple(r)[1:] for r in grid.groupBy("rank").agg(F.count("*"), F.countDistinct("idx"), F.min("idx"), F.max("idx"), F.sum(F.crc32("url"))).collect()}
    assert by_rank == {rank: (100_000, 100_000, 0, 99_999, sum(zlib.crc32(make(i, rank).encode()) for i in range(100_000))) for rank in range(60)}


@pytest.mark.parametrize("name", ["index_frontier", "grid_frontier", "hex_frontier"])
def test_frontier_queries_match_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    events = duckdb.read_parquet(f"{SF_DIR}/events.parquet")  # noqa: F841 - read by the SQL
    got = queries.QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(duckdb.sql(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES[name]})").fetchall())


@pytest.mark.parametrize("turned", [False, True])
def test_first_row_of_a_key_over_files(spark, turned):
    """The first file wins with its first row, in whatever order rows arrive."""
    page = lambda t: CNA.replace("標題★", t)
    rows = [(1, 1, page("二"), "202110120001", 1), (2, 1, page("三"), "202110120001", 0), (1, 1, page("一"), "202110120001", 0), (1, 1, page("四"), "202110120002", 1)]
    raw = spark.createDataFrame(rows[::-1] if turned else rows, "id long, company_id int, raw_xml string, url_pattern string, file_ord int").coalesce(1)
    done, lost = jobs.parse(raw)
    assert sorted((r["url_pattern"], r["title"], r["file_ord"]) for r in done.collect()) == [("202110120001", "一", 0), ("202110120002", "四", 1)]
    assert lost.count() == 0
    legacy = raw.select("id", F.lit("中央社").alias("company"), F.col("raw_xml"), F.concat(F.lit("https://www.cna.com.tw/news/aipl/"), "url_pattern", F.lit(".aspx")).alias("url"), "file_ord")
    assert sorted((r["url_pattern"], r["id"], r["file_ord"]) for r in jobs.migrate(legacy, "v1").collect()) == [("202110120001", 1, 0), ("202110120002", 1, 1)]


def _site(pages):
    """Pages by address; every other address is missing."""
    return lambda url: (200, pages[url]) if url in pages else (404, "")


def _crawled(spark, source, pages, **more):
    found = []
    crawl.crawl(spark, source, lambda rows: found.append([(r["company_id"], r["url_pattern"], r["raw_xml"]) for r in rows.orderBy("id").collect()]), _site(pages), **more)
    return found


def _links(urls, css):
    return css.format("".join(f'<div class="one_post"><div class="text"><div class="title"><a href="{u}">x</a></div></div></div>' for u in urls))


def test_crawl_by_page_stops_a_category_at_an_empty_commit(spark, monkeypatch):
    monkeypatch.setitem(crawl.PAGES_A_COMMIT, "ntdtv", 2)
    monkeypatch.setitem(frontier.CATEGORIES, "ntdtv", ["202", "205"])
    base = "https://www.ntdtv.com/b5/"
    day = lambda d, n: f"{base}2021/10/{d:02}/a{n}.html"
    wrap = '<div class="post_list"><div class="list_wrapper">{}</div></div><a class="page-numbers">1</a><a class="page-numbers">6</a><a class="page-numbers">next</a>'
    listed = {1: [day(20, 1)], 2: [day(12, 2), day(11, 3)], 3: [day(11, 4)], 4: [day(2, 5)], 5: [day(2, 6)], 6: [day(11, 7)]}
    pages = {f"{base}prog202/{p}": _links(urls, wrap) for p, urls in listed.items()} | {u: f"<p> {u[-7:]} </p>" for urls in listed.values() for u in urls}
    found = _crawled(spark, "ntdtv", pages, past="2021-10-10+0000", current="2021-10-13+0000")
    assert [[x[1] for x in commit] for commit in found] == [["2021-10-12-2", "2021-10-11-3", "2021-10-11-4"]]
    assert found[0][0][::2] == (6, "<p> a2.html </p>")


def test_crawl_of_listings(spark, monkeypatch):
    monkeypatch.setitem(frontier.LISTING_PAGES, "setn", 2)
    monkeypatch.setitem(frontier.LISTING_PAGES, "ltn", 2)
    monkeypatch.setitem(frontier.CATEGORIES, "setn", ["6", "41", "5"])
    base = "https://www.setn.com/"
    item = '<div class="newsItems"><h3 class="view-li-title"><a href="/News.aspx?NewsID={}">x</a></h3></div>'
    pages = {f"{base}ViewAll.aspx?PageGroupID={c}&p={p}": item.format(n) for c, p, n in (("6", 1, 1), ("6", 2, 2), ("5", 1, 3))} | {f"{base}News.aspx?NewsID={n}": str(n) for n in (1, 2, 3)}
    assert [[x[1] for x in c] for c in _crawled(spark, "setn", pages)] == [["1", "2"]]  # 41 has none: the rest is left
    monkeypatch.setitem(frontier.CATEGORIES, "ltn", ["politics", "society", "life"])
    base, news = "https://news.ltn.com.tw/ajax/breakingnews/", "https://news.ltn.com.tw/news/life/breakingnews/"
    pages = {f"{base}politics/1": json.dumps({"data": [{"url": f"{news}1"}]}), f"{base}politics/2": json.dumps({"data": {"20": {"url": f"{news}2"}}}), f"{base}life/1": json.dumps({"data": [{"url": f"{news}3"}]})}
    pages |= {f"{news}{n}": str(n) for n in (1, 2, 3)}
    assert [[x[1] for x in c] for c in _crawled(spark, "ltn", pages)] == [["life-1", "life-2"], ["life-3"]]


def test_crawl_by_id_and_list(spark, monkeypatch):
    monkeypatch.setitem(frontier.CHUNK, "ettoday", 10)
    pages = {f"https://star.ettoday.net/news/{i}": str(i) for i in (1, 4, 15, 31)}
    assert [[x[1] for x in c] for c in _crawled(spark, "ettoday", pages)] == [["1", "4"], ["15"]]  # nothing from 21 to 30
    monkeypatch.setitem(frontier.CHUNK, "tvbs", 10)
    monkeypatch.setitem(frontier.CATEGORIES, "tvbs", ["1"])
    monkeypatch.setattr(frontier, "TVBS_LISTS", {"local": "1"})
    base = "https://news.tvbs.com.tw/"
    ids = [3, 7, 8, 12, 19, 20]
    lists = {crawl.TVBS_LIST.format(base=base, number="1", category="local", idx=i): json.dumps({"news_id_list": "".join(f",'{x}'" for x in sorted(ids, reverse=True) if x < i)[:11]}) for i in range(30)}
    got = _crawled(spark, "tvbs", lists | {f"{base}local/{i}": str(i) for i in ids}, first=1, latest=20)
    assert [sorted({x[1] for x in c}) for c in got] == [["local-12", "local-19", "local-20"], ["local-3", "local-7", "local-8"]]
    assert list(frontier.index_chunks_down(5, 25, 10)) == [(15, 25), (5, 15), (4, 5)]


def test_crawl_by_day_and_time(spark, monkeypatch):
    pages = {f"https://www.ftvnews.com.tw/news/detail/2021A12{x}": "<p>x</p>" for x in ("A01M1", "A30M1", "W0002")} | {"https://www.ftvnews.com.tw/news/detail/2021A12C01M1": "<script>alert(1)</script>"}
    got = _crawled(spark, "ftv", pages, past="2021-10-12+0000", current="2021-10-12+0000")
    assert [[x[1] for x in c] for c in got] == [["2021A12A01M1", "2021A12A30M1", "2021A12W0002"]]
    make, days = crawl.LISTINGS["udn"][0], {1: "2021-10-14", 2: "2021-10-13", 3: "2021-10-12", 4: "2021-10-11", 5: "2021-10-09"}
    pages = {make.format(base="https://udn.com/", category="", page=p): json.dumps({"lists": [{"time": {"date": f"{d} 08:00"}, "titleLink": f"/news/story/1/{p}?from=x"}]}) for p, d in days.items()}
    pages |= {f"https://udn.com/news/story/1/{p}": str(p) for p in days}
    got = _crawled(spark, "udn", pages, past="2021-10-11+0000", current="2021-10-13+0800")
    assert [[x[1] for x in c] for c in got] == [["1-3", "1-4"]]
    monkeypatch.setitem(frontier.PER_DAY, "chinatimes", 3)
    monkeypatch.setitem(frontier.CATEGORIES, "chinatimes", ["260407", "260405"])
    url = "https://www.chinatimes.com/{}/20211012{:06}-{}"
    pages = {url.format(*x): str(x) for x in (("realtimenews", 0, "260407"), ("newspapers", 2, "260405"), ("realtimenews", 2, "260405"))}
    got = _crawled(spark, "chinatimes", pages, past="2021-10-12+0000", current="2021-10-12+0000")
    assert [[x[1] for x in c] for c in got] == [["r-20211012000000-260407", "n-20211012000002-260405"]]
    with pytest.raises(ValueError, match="unknown source"):
        crawl.crawl(spark, "nobody", print)
    assert frontier.last_where(lambda p: p <= 3, 9) == 3 and frontier.last_where(lambda p: True, 4) == 4


def test_command_line(spark, tmp_path, monkeypatch):
    monkeypatch.syspath_prepend(str(tmp_path))
    (tmp_path / "own_ner.py").write_text("from sparkloom.operators.entities import dictionary_recogniser\ndef make():\n    return dictionary_recogniser({'甲': 'ORG', '丙': 'GPE'})\n")
    rows = [(i, f"甲在丙,1月{i}日,甲走(圖)", None, 1, None, i, "題", f"u{i}") for i in range(1, 6)]
    source = str(tmp_path / "in.db")
    newsdb.write_database(spark.createDataFrame(rows, schemas.PARSED), source, "parsed_news", ["id"])
    cli.main(["preprocess", "--db", source, "--save", str(tmp_path / "out.db"), "--parens", "--recogniser", "own_ner:make", "--tag-org-with-id", "org", "--tag-gpe", "loc", "--dates"])
    got = newsdb.read_databases(spark, [str(tmp_path / "out.db")], "preprocessed_news", columns=["id", "article"])
    assert got.columns == ["id", "article"]
    assert [r["article"] for r in got.orderBy("id").collect()] == ["<org0>在<loc>,<num>月<num>日,<org0>走"] * 5
    cli.main(["split", "--db", source, "--save", str(tmp_path / "parts"), "--kind", "parsed", "--per-chunk", "2", "--root", str(tmp_path)])
    parts = [f"{tmp_path}/parts/in__{a}_{b}.db" for a, b in ((1, 2), (3, 4), (5, 5))]
    assert sorted(newsdb.find_databases([str(tmp_path / "parts")])) == parts
    assert [[r["url_pattern"] for r in newsdb.read_databases(spark, [p], "parsed_news").orderBy("id").collect()] for p in parts] == [["u1", "u2"], ["u3", "u4"], ["u5"]]
    cli.main(["merge", "--db", *reversed(parts), "--save", str(tmp_path / "all.db"), "--kind", "parsed"])
    assert [r["url_pattern"] for r in newsdb.read_databases(spark, [str(tmp_path / "all.db")], "parsed_news").orderBy("id").collect()] == [f"u{i}" for i in range(1, 6)]
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["preprocess", "--db", "a", "--save", "b", "--tag-org", "x", "--tag-org-with-id", "y"])
    assert newsdb.resolve("a.db", "raw", "/r") == "/r/data/raw/a.db" and newsdb.resolve("/x/a.db", "raw", "/r") == "/x/a.db"
    assert newsdb.read_databases(spark, [source], "parsed_news", columns=["id", "timestamp"]).agg(F.sum("timestamp")).first()[0] == 15


def test_extract_pages_query_reads_every_source(spark, tmp_path):
    pages = [(i, f"<!DOCTYPE html><html><body><p>今天天氣好{i}度。<p>明天也好。<b>後天</body></html>") for i in range(24)]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    for r in queries.extract_pages(spark, str(tmp_path)).collect():
        if r["company_id"] == 11:
            assert r["error"] == "unknown: unknown company 11"
        else:
            assert r["error"] is None and r["title"] == "t" and r["timestamp"] // 86400 in (16381, 16382), r
            assert f"今天天氣好{r['id']}度" in r["article"] and "明天也好" in r["article"] and ("後天" in r["article"]) == (r["company_id"] not in (3, 9)), r


def test_stream_adds_each_key_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id long, company_id int, url_pattern string"
    for n, rows in enumerate([[(1, 0, "a"), (2, 0, "a")], [(3, 0, "a"), (4, 0, "b")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        append_stream(stream, target, str(tmp_path / "check"), ["id"]).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == [1, 4]


def test_entities_in_catalyst_are_the_plain_ones(spark):
    """Overlaps, shared tags, ties, nulls and dates."""
    rng = random.Random(12)
    config = entities.tag_config({"GPE": "loc", "LAW": "law"}, {"ORG": "org", "PERSON": "org", "FAC": "f"})
    rows = []
    for i in range(150):
        row = [i, *("".join(rng.choice("ab年月日1é𝄞 ") for _ in range(rng.randint(0, 25))) if rng.random() < 0.95 else None for _ in range(2))]
        for text in row[1:3]:
            tokens = None if rng.random() < 0.1 else []
            for _ in range(rng.randint(0, 5) if tokens is not None else 0):
                start = rng.randint(0, 20)
                end = start + rng.randint(0, 8)
                kind = rng.choice(["GPE", "LAW", "ORG", "PERSON", "FAC", "DATE", "NONE"])
                tokens.append(((text or "")[start:end] if kind != "DATE" else rng.choice(["1年1月1日", "a月b日", "x"]), kind, start, end))
            row.append(tokens)
        rows.append(tuple(row))
    df = spark.createDataFrame(rows, "id int, title string, article string, title_tokens array<struct<word:string,ner:string,start:int,end:int>>, article_tokens array<struct<word:string,ner:string,start:int,end:int>>")
    for dates in (False, True):
        made = entities.replace_entities(df, config, dates)
        assert made.columns == ["id", "title", "article"] and "Python" not in made._jdf.queryExecution().toString()
        for r in made.collect():
            _, title, article, *tokens = rows[r["id"]]
            tokens = [[dict(zip(("word", "ner", "start", "end"), t, strict=True)) for t in own or []] for own in tokens]
            want = entities.replace_spans(title or "", article or "", *tokens, config)
            for t in [*tokens[0], *tokens[1]] if dates else ():
                if t["ner"] == "DATE" and (mask := entities.date_mask(t["word"])):
                    want = tuple(x.replace(t["word"], mask) for x in want)
            assert (r["title"], r["article"]) == want
    assert entities.replace_entities(df, {}, False).count() == 150


def _first_run(rows, most, group):
    out = []
    for g in {r[0] if group else 0 for r in rows}:
        streak = 0
        for own, seq, ok, _ in rows:
            if group and own != g or ok is None:
                continue
            streak = 0 if ok else streak + 1
            if streak >= most:
                break
            out += [seq] * ok
    return sorted(out)


def test_cutoff_over_ranges_and_numbers_under_ties(spark):
    rng = random.Random(4)
    for chance, n, most in ((0.3, 1, 1), (0.6, 300, 4), (0.9, 300, 9), (0.8, 60, 2)):
        rows = [(rng.choice(["a", "b", None]), 2 * i, None if rng.random() < 0.05 else rng.random() > chance, "x") for i in range(n)]
        log = spark.createDataFrame(rows, "g string, seq long, ok boolean, _seq string").repartition(3)
        for group in (["g"], []):
            got = relops.failure_cutoff(log.withColumnRenamed("_seq", "body"), most, group)
            assert sorted(r["seq"] for r in got.collect()) == _first_run(rows, most, group) and got.columns == ["g", "seq", "ok", "body"]
        tied = spark.createDataFrame([(rng.choice([None, 1, 1, 1, 1, 5]), rng.choice([None, *range(40)]), i) for i in range(n)], "a int, b int, c long").repartition(3)
        got = [tuple(r) for r in relops.numbered(tied, ["a", "b", "c"]).orderBy("n").collect()]
        want = sorted((tuple(r) for r in tied.collect()), key=lambda r: tuple((x is not None, x or 0) for x in r))
        assert got == [(*r, i) for i, r in enumerate(want, 1)]
    assert relops.failure_cutoff(log.withColumnRenamed("_seq", "body").limit(0), 1, []).count() == 0


def test_names_are_the_leftmost_longest(spark):
    """Over all texts, in one pass and in several, against an alternation of the names, the longest first."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"].split("\n")[0], f"{r['text']} 𝄞{r['text'][:40]}") for r in docs.collect() if r["text"]] + [(-1, None, ""), (-2, "é", None)]
    listed = sorted({w.strip(".,") for r in rows[:-2] for w in r[1].split()[:3]} | {"the", "then", "e", "𝄞", "he n"} - {""})
    names = spark.createDataFrame([(w, "ORG" if len(w) % 2 else "GPE") for w in listed] + [("the", "AAA"), ("", "ORG"), (None, "ORG"), ("x", None)], "name string, ner string")
    kinds = {w: "AAA" if w == "the" else "ORG" if len(w) % 2 else "GPE" for w in listed}
    df = spark.createDataFrame(rows, "id long, title string, article string").withColumn("found", F.lit(1))
    either = re.compile("|".join(map(re.escape, sorted(listed, key=len, reverse=True))))
    for most in (gazetteer.PASS_BYTES, 400):
        got = gazetteer.recognise_names(df, names, pass_bytes=most).collect()
        assert len(got) == len(rows) and got[0]["found"] == 1
        for r in got:
            for c in ("title", "article"):
                want = [(m[0], kinds[m[0]], m.start(), m.end()) for m in either.finditer(r[c] or "")]
                assert [tuple(t) for t in r[f"{c}_tokens"]] == want
    assert all(not r["title_tokens"] for r in gazetteer.recognise_names(df, names.limit(0)).collect())


def test_a_trie_of_many_names():
    rng = random.Random(3)
    names = sorted({"".join(rng.choice("abcdefgh ") for _ in range(rng.randint(3, 14))) for _ in range(200_000)})
    began = time.time()
    trie = gazetteer.Trie.build(names)
    assert time.time() - began < 20 and trie.edges.nbytes + trie.to.nbytes + trie.name.nbytes < 64 << 20
    text = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    points = gazetteer._points(text)
    at, size, which = trie.longest(points, np.full(len(points), len(points)))
    known = set(names)
    want = {i: max((n for n in range(3, 15) if text[i : i + n] in known and i + n <= len(text)), default=0) for i in range(len(text))}
    assert {i: n for i, n in want.items() if n} == dict(zip(at.tolist(), size.tolist(), strict=True))
    assert all(names[k] == text[i : i + n] for i, n, k in zip(at.tolist(), size.tolist(), which.tolist(), strict=True))


def test_outcomes_of_one_extraction(spark, tmp_path):
    page = CNA.replace("標題★", "一")
    rows = [(1, 1, page, "202110120001", 0), (2, 1, page, "202110120001", 0), (3, 99, page, "x", 0), (4, 1, page, "bad", 1), (5, None, None, None, 1), (6, 1, page, None, 1)]
    raw = spark.createDataFrame(rows, "id long, company_id int, raw_xml string, url_pattern string, file_ord int")
    good, lost, counts = jobs.parse_to(raw, f"{tmp_path}/a")
    want_good, want_lost = jobs.parse(raw)
    assert sorted(map(tuple, good.select(*want_good.columns).collect())) == sorted(map(tuple, want_good.collect()))
    key = lambda rows: sorted((r["id"], r["error"]) for r in rows)
    assert key(lost.collect()) == key(want_lost.collect()) and counts == {"read": 6, "lost": 4}
    good, lost, counts = jobs.parse_to(raw.limit(0), f"{tmp_path}/b")
    assert good.count() == lost.count() == 0 and counts == {"read": 0, "lost": 0}


def test_only_files_that_may_hold_keys_are_read(spark, tmp_path):
    """The files read follow the batch, and what is appended is what a plain first-wins append gives."""
    target = f"{tmp_path}/t"
    schema = "id long, company_id int, url_pattern string"
    rows = spark.range(20_000).select("id", (F.col("id") % 11).cast("int").alias("company_id"), F.concat(F.lit("u"), (F.col("id") / 2).cast("long")).alias("url_pattern"))
    rows.repartitionByRange(10, "id").write.parquet(target)
    assert keyindex.index_files(spark, target, rows.schema) == 10 and keyindex.index_files(spark, target, rows.schema) == 0
    small, large = rows.filter("id between 4010 and 4019"), rows.filter("id % 500 = 0")
    news = spark.createDataFrame([(1, 1, "new"), (2, 1, "new"), (3, None, "new"), (4, None, "new"), (5, 1, None)], schema)
    assert len(keyindex.files_with(small, target)) <= 2 and len(keyindex.files_with(large, target)) == 10 and len(keyindex.files_with(news, target)) <= 1
    assert len(keyindex.files_with(small, target, most_keys=3)) == 10
    for batch, ids in ((small, []), (news.unionByName(small), [1, 3, 5]), (news, []), (news.limit(0), [])):
        before = spark.read.parquet(target).count()
        assert sorted(r["id"] for r in keyindex.new_rows(batch, target, ["id"]).collect()) == ids
        keyindex.append_new(batch, target, ["id"])
        assert spark.read.parquet(target).count() == before + len(ids)
    spark.createDataFrame([(9, 9, "unindexed")], schema).write.mode("append").parquet(target)
    again = spark.createDataFrame([(10, 9, "unindexed"), (11, 9, "fresh")], schema)
    assert [r["id"] for r in keyindex.new_rows(again, target, ["id"]).collect()] == [11]


def _in_pieces(run, columns: dict, texts: list[str]) -> list[pa.RecordBatch]:
    """What a function over Arrow batches gives for one batch; none of its own batches may hold much of it."""
    whole = pa.RecordBatch.from_pydict(columns)
    got = list(run(iter([whole])))
    assert sum(b.num_rows for b in got) == whole.num_rows and len(got) > 3
    size = sum(whole.column(c).nbytes for c in texts)
    assert max(b.num_rows for b in got) < whole.num_rows / 2 and size > 4 << 20
    return got


def test_pages_of_a_batch_are_read_in_pieces(spark, monkeypatch):
    seen = []
    frame = spark.createDataFrame([], "id long, company_id int, raw_xml string, url_pattern string, file_ord int")
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, run, schema: seen.append(run))
    extract.extract(frame)
    page = '<div class="centralContent"><h1><span>t</span></h1><div class="paragraph"><p>' + "a b. " * 400 + "</p></div></div>"
    n = 3000
    raw = [None if i % 7 == 0 else page for i in range(n)]
    columns = {"id": range(n), "company_id": pa.array([1 if i % 5 else None for i in range(n)], pa.int32()), "raw_xml": raw, "url_pattern": [f"20141108{i}" for i in range(n)], "file_ord": pa.array([0] * n, pa.int32())}
    got = pa.Table.from_batches(_in_pieces(seen[0], columns, ["raw_xml"])).to_pylist()
    for i in (0, 1, 5, 7, n - 1):
        article, category, reporter, timestamp, title, error = extract.extract_one(columns["company_id"][i].as_py(), raw[i], f"20141108{i}", extract.Options())
        assert got[i] == {"id": i, "article": article, "category": category, "company_id": columns["company_id"][i].as_py(), "reporter": reporter, "timestamp": timestamp, "title": title, "url_pattern": f"20141108{i}", "error": error, "file_ord": 0}
    assert got[1]["title"] == "t" and "unknown company" in got[5]["error"]


def test_names_of_a_batch_are_sought_in_pieces():
    class Shared:
        value = (gazetteer.Trie.build(["aa", "aab", "c"]), ["X", "Y", "Z"])

    n = 3000
    columns = {"id": range(n), "title": ["aab" if i % 2 else None for i in range(n)], "article": [("aab caa é " * 200) + str(i) for i in range(n)]}
    for last, out in ((True, "article_tokens"), (False, "f1")):
        run = gazetteer._search(Shared, ["id", "title", "article"], ["title", "article"], ["f0", "f1"], last)
        got = pa.Table.from_batches(_in_pieces(run, columns, ["article"]))
        assert got["id"].to_pylist() == list(range(n)) and len(got[out][n - 1].as_py()) == 600
    assert got["f0"][:2].to_pylist() == [[], [{"start": 0, "size": 3, "ner": "Y"}]]


def test_tokens_of_a_batch_come_in_pieces(spark):
    """One Python process for both texts; the recogniser's batches stay whole, and every row has its own tokens."""
    def of(texts):
        return [[(str(len(texts)), "ORG", 0, len(t or ""))] for t in texts]

    n = 1500
    rows = spark.range(0, n, 1, 1).select("id", F.lit(None).cast("string").alias("title"), F.repeat(F.lit("ab"), (F.col("id") % 5 * 1000).cast("int")).alias("article"))
    done = entities.recognise(rows, of, 7)
    assert done.columns == ["id", "title", "article", "title_tokens", "article_tokens"]
    assert done._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    got = done.select("id", F.col("article_tokens")[0]["word"].alias("k"), F.col("article_tokens")[0]["end"].alias("n"), F.col("title_tokens")[0]["end"].alias("m")).orderBy("id").collect()
    assert [(r["id"], r["n"], r["m"]) for r in got] == [(i, i % 5 * 2000, 0) for i in range(n)]
    assert {r["k"] for r in got} <= {"7", str(n % 7)} and [r["k"] for r in got][: n - n % 7] == ["7"] * (n - n % 7)
