"""Record types and the table of sources."""

from pyspark.sql import types as T

RAW = T.StructType([T.StructField("id", T.LongType()), T.StructField("company_id", T.IntegerType(), False), T.StructField("raw_xml", T.StringType(), False), T.StructField("url_pattern", T.StringType(), False)])
PARSED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("article", T.StringType(), False),
        T.StructField("category", T.StringType()),
        T.StructField("company_id", T.IntegerType(), False),
        T.StructField("reporter", T.StringType()),
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("url_pattern", T.StringType(), False),
    ]
)
PREPROCESSED = PARSED
LEGACY = T.StructType([T.StructField("id", T.LongType()), T.StructField("company", T.StringType()), T.StructField("raw_xml", T.StringType()), T.StructField("url", T.StringType())])
TOKEN = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("ner", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
KEY = ("company_id", "url_pattern")

# The sources in id order, as (name, short name, address, address pattern).
COMPANIES = [
    ("中時", "chinatimes", "https://www.chinatimes.com/", r"https://www.chinatimes.com/([rn])(?:ealtimenews|ewspapers)/(\d+)-(\d+)"),
    ("中央社", "cna", "https://www.cna.com.tw/news/aipl/", r"https://www.cna.com.tw/news/aipl/(\d+)\.aspx"),
    ("大紀元", "epochtimes", "https://www.epochtimes.com/b5/", r"https://www.epochtimes.com/b5/(\d+)/(\d+)/(\d+)/n(\d+)\.htm"),
    ("東森", "ettoday", "https://star.ettoday.net/news/", r"https://star.ettoday.net/news/(\d+)"),
    ("民視", "ftv", "https://www.ftvnews.com.tw/news/detail/", r"https://www.ftvnews.com.tw/news/detail/(.+)"),
    ("自由", "ltn", "https://news.ltn.com.tw/ajax/breakingnews/", r"https://news.ltn.com.tw/news/(\w+)/breakingnews/(\d+)"),
    ("新唐人", "ntdtv", "https://www.ntdtv.com/b5/", r"https://www.ntdtv.com/b5/(\d+)/(\d+)/(\d+)/a(\d+)\.html"),
    ("三立", "setn", "https://www.setn.com/", r"https://www.setn.com/News.aspx\?.*NewsID=(\d+)"),
    ("風傳媒", "storm", "https://www.storm.mg/article/", r"https://www.storm.mg/article/(\d+)\?mode=whole"),
    ("tvbs", "tvbs", "https://news.tvbs.com.tw/", r"https://news.tvbs.com.tw/(\w+)/(\d+)"),
    ("聯合報", "udn", "https://udn.com/", r"https://udn.com/news/story/(\d+)/(\d+)"),
]
COMPANY_IDS = {name: i for i, (name, *_) in enumerate(COMPANIES)}
SHORT_NAMES = [short for _, short, *_ in COMPANIES]


def company_dim(spark):
    """The table of sources: company_id, name, base_url, url_regex (eleven rows)."""
    return spark.createDataFrame([(i, n, u, p) for i, (n, _, u, p) in enumerate(COMPANIES)], "company_id int, name string, base_url string, url_regex string")
