import random
import re
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom import queries
from sparkloom.functions import arrow, columns, html
from sparkloom.functions.delimiters import Strip
from sparkloom.functions.rules import cna, epochtimes, ettoday, ntdtv, storm
from sparkloom.operators import entities
from sparkloom.plans import jobs
from sparkloom.schemas import COMPANIES


@pytest.mark.parametrize(
    ("text", "want"),
    [("a(b)c", "ac"), ("a(b(c)d)e", "ae"), ("a)b", "a)b"), ("a(b", "aa(b"), ("x(y)a(b", "xaa(b"), ("a((b)c", "aa((b)c")],
)
def test_strip_delimited(text, want):
    assert arrow.delimited_text(text, "(", ")") == want


@pytest.mark.parametrize(("text", "want"), [("讀《書》好", "讀《<unk>》好"), ("《a《b》c》", "《<unk>》"), ("a《b", "a《a《b")])
def test_guillemets(text, want):
    assert arrow.delimited_text(text, "《", "》", "<unk>", True) == want


def test_unclosed_kept():
    assert arrow.delimited_text("a(b", "(", ")", unclosed="keep") == "a(b"


def test_masks():
    assert arrow.english_text("看 Hello world 12 好 x <org>") == "看 <en>好 <en><org>"
    assert arrow.number_text("<org0>有12人", ("org",)) == "<org0>有<num>人"
    assert arrow.nfkc_text(" ① 　ab ") == "1 ab"


def test_collapse_and_urls(spark):
    rows = spark.createDataFrame([(" abc  def ", "x https://a.b/c?d=1 y"), ("a　\x1cb", "x"), (None, None)], "a string, b string")
    got = rows.select(columns.collapse_ws(F.col("a")), columns.strip_urls(F.col("b"))).collect()
    assert [tuple(r) for r in got] == [("abc def", "x y"), ("a b", "x"), (None, None)]


def test_compress_url(spark):
    cases = [
        (0, "https://www.chinatimes.com/realtimenews/20211012000001-260407?chdtv", "r-20211012000001-260407"),
        (2, "https://www.epochtimes.com/b5/21/10/12/n123.htm", "21-10-12-123"),
        (4, "https://www.ftvnews.com.tw/news/detail/2021A12W0001", "2021A12W0001"),
        (9, "https://news.tvbs.com.tw/life/123", "life-123"),
        (9, "nowhere", "nowhere"),
    ]
    got = spark.createDataFrame(cases, "c int, u string, w string").select(columns.compress_url(F.col("c"), F.col("u")), "w").collect()
    assert all(a == b for a, b in got)


def test_unknown_company(spark):
    rows = spark.createDataFrame([("nobody",)], "n string")
    with pytest.raises(Exception, match="unknown company"):
        rows.select(columns.company_id(F.col("n"))).collect()
    assert len(COMPANIES) == 11


def test_epoch_and_card(spark):
    row = spark.range(1).select(columns.epoch_text(F.lit(813456000)).alias("t"), columns.card(F.lit(813456000), title=F.lit("a"), category=F.lit(None).cast("string")).alias("c")).first()
    assert row["t"] == "1995-10-12 00:00:00+0000"
    assert "None" in row["c"] and len({len(x) for x in row["c"].split("\n")}) == 1


def test_selectors():
    page = html.parse('<div id=a class="x y"><p>1<p class=q>2</p></p><a href="ETtoday.net">l</a><b>s</b><script>no</script></div><div><p>3</p></div>')
    texts = lambda s: [x.text for x in page.select(s)]
    assert texts("div#a.x > p") == ["12"]
    assert texts("p:not([class])") == ["12", "3"]
    assert texts('a[href*="ettoday" i]') == ["l"]
    assert texts("div:has(> a) ~ div p, b") == ["s", "3"]
    assert texts("a + b") == ["s"]
    assert texts(":is(b, a):nth-child(1 of a)") == ["l"]
    assert page.first("div").text == "12ls"


def test_entities():
    config = entities.tag_config({"GPE": "loc"}, {"ORG": "org", "PERSON": "org"})
    find = entities.dictionary_recogniser({"甲": "ORG", "乙": "PERSON", "丙": "GPE"})
    title, article = "乙在丙", "甲見乙,2021年1月2日"
    tokens = [[{"word": w, "ner": c, "start": a, "end": b} for w, c, a, b in x] for x in find([title, article])]
    assert entities.replace_spans(title, article, *tokens, config) == ("<org0>在<loc>", "<org1>見<org0>,2021年1月2日")
    assert entities.date_mask("2021年1月2日") == "<num>年<num>月<num>日"
    assert entities.date_mask("1月2日") == "<num>月<num>日"
    with pytest.raises(ValueError, match="both"):
        entities.tag_config({"ORG": "x"}, {"GPE": "x"})


def plain_cascade(text, rules):
    for pattern, by in rules:
        text = arrow.nfkc_text(re.sub(pattern, by, text))
    return text


def test_cascade_shortcuts():
    """Searches that are left out change nothing."""
    packs = [p.ARTICLE + p.TITLE for p in (cna, epochtimes, ettoday, ntdtv, storm)]
    parts = [x for pack in packs for pattern, _ in pack for x in re.findall(r"[\u3000-\u9fff]+|[^\w\s]|[a-zA-Z]+", pattern)]
    draw = random.Random(7)
    for _ in range(400):
        text = "".join(draw.choice([draw.choice(parts), " ", "\n", "1", "ab ", "①"]) for _ in range(draw.randrange(1, 25)))
        for pack in packs:
            assert arrow.cascade_text(text, [arrow.Rule(*x) for x in pack]) == plain_cascade(text, pack)


def test_cascades_over_the_whole_table(spark):
    pq = pytest.importorskip("pyarrow.parquet")
    texts = [f"【快訊】{t or ''}★(更新)●" for t in pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()]
    for pack in (p.ARTICLE + p.TITLE for p in (cna, epochtimes, ettoday, ntdtv, storm)):
        rules = [arrow.Rule(*x) for x in pack]
        for text in texts:
            if len(text) < 4000:  # the plain version takes time in the square of the length
                assert arrow.cascade_text(text, rules) == plain_cascade(text, pack)


def test_needs_of_patterns():
    needs = lambda pattern, by="x": arrow.Rule(pattern, by).needs
    assert needs("ab[cd]+(e|fgh)") == [{"ab"}, {"c", "d"}, {"e", "fgh"}]
    assert needs("(?i)甲乙a(b|中)?") == [{"甲乙"}] and needs(r"\d*") == []
    assert needs("(a|b*)c?", "") == [] and needs("(甲|乙丙)?#*", "") == [{"甲", "乙丙", "#"}]
    rule = arrow.Rule("(one|two|three|four|five|six|se(ve)n).*$", r"<\1>")
    for text in ("a two b", "x seven six", "none", "five\n", ""):
        assert rule(text, set(text)) == re.sub(rule.pattern, rule.by, text)
    assert len(rule.cut_down) == 4


@pytest.mark.parametrize("pattern", ["URL", "EMOJI", "NOT_KEPT"])
def test_patterns_agree_in_both_notations(spark, pattern):
    draw = random.Random(3)
    pool = list("ab 1.,<>。、《》①😀🇹中\u3000\x1c\x85\u2028()[]【】+%/:~-!?*「」é٣") + ["http://", "https://a.b/c?d=1 "]
    texts = ["".join(draw.choice(pool) for _ in range(30)) for _ in range(300)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.regexp_replace("t", getattr(columns, pattern), "").alias("u")).collect()
    assert all(getattr(arrow, pattern).sub("", r["t"]) == r["u"] for r in rows)


def _scanned(text, left, right, by, keep, unclosed):
    """Delimited stretches by a walk over the characters."""
    out, done, depth, opened = "", 0, 0, 0
    for i, c in enumerate(text):
        if c == left:
            opened = opened if depth else i
            depth += 1
        elif c == right and depth:
            depth -= 1
            if not depth:
                out += text[done:opened] + (left + by + right if keep else by)
                done = i + 1
    return out + (text[done : opened + keep] if depth and unclosed == "reference" else "") + text[done:]


def test_delimiters_of_batches():
    rng = random.Random(6)
    for _ in range(1500):
        left, right, by, keep = rng.choice([("(", ")", "", False), ("《", "》", "<unk>", True), ("【", "】", "", False)])
        unclosed = rng.choice(["reference", "keep"])
        texts = [None if rng.random() < 0.1 else "".join(rng.choice([left, right, "a", "é", "書", " "]) for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 9))]
        got = Strip(left, right, by, keep, unclosed)(pa.array(["x" + left, *texts], pa.string()).slice(1))
        assert got.to_pylist() == [None if t is None else _scanned(t, left, right, by, keep, unclosed) for t in texts]
    long = "(" * 200_000 + "x" + ")" * 200_000 + "y"
    assert Strip("(", ")")(pa.array([long, long[:-200_000]])).to_pylist() == ["y", _scanned(long[:-200_000], "(", ")", "", False, "reference")]


def test_delimiters_with_either_treatment_of_unclosed(spark):
    rows = spark.createDataFrame([("a(b)c(d",), (None,), ("",), ("((x)",)], "t string")
    for unclosed in ("reference", "keep"):
        got = [r[0] for r in rows.select(arrow.strip_delimited(F.col("t"), "(", ")", unclosed=unclosed)).collect()]
        assert got == [None if t is None else _scanned(t, "(", ")", "", False, unclosed) for t in ("a(b)c(d", None, "", "((x)")]


def test_spliced_texts_are_normal():
    rng, letters = random.Random(5), "ab é́각가ｶﾞ̧ͅ 　①"
    for _ in range(4000):
        text = arrow.nfkc_text("".join(rng.choice(letters) for _ in range(rng.randint(0, 9))))
        cuts = sorted(rng.randint(0, len(text)) for _ in range(2 * rng.randint(0, 2)))
        edits = [(a, b, rng.choice(["", " ", "x", "́", "é ", "  ", "①", "\n"])) for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
        want, at = "", 0
        for start, stop, by in edits:
            want, at = want + text[at:start] + by, stop
        assert arrow.spliced(text, edits) == arrow.nfkc_text(want + text[at:])


def test_references_as_written():
    page = '<head><title>a &amp; &quot;b&quot; &amp c &#65; AT&T</title><script>x && "&amp;"</script></head><a href="?a=1&amp;b">&lt;</a>'
    root, plain = html.parse(page, written=True), html.parse(page)
    assert root.first("title").text == "a &amp; &quot;b&quot; &amp c &#65; AT&T"
    assert plain.first("title").text == 'a & "b" & c A AT&T'
    assert root.first("script").text == plain.first("script").text == 'x && "&amp;"'
    assert (root.first("a").attrs["href"], root.first("a").text) == ("?a=1&amp;b", "&lt;")


def test_page_titles_are_those_of_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    titles = ["a &amp; b", "a &quot;b&quot; &amp", "&amp;amp; &#65; AT&T &lt;", "", "ü &copy;"]
    rows = [(i, f"<html><head><title>{t}</title></head><body>&amp;</body></html>") for i, t in enumerate(titles)]
    spark.createDataFrame([*rows, (len(rows), None), (len(rows) + 1, "<p>x")], "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.QUERIES["page_title"](spark, str(tmp_path)).collect()
    want = duckdb.sql(queries.ORACLES["page_title"].replace("FROM pages", f"FROM '{tmp_path}/pages.parquet/*.parquet'")).fetchall()
    assert sorted(map(tuple, got)) == sorted(want)


def test_batches_go_through_steps_in_pieces(monkeypatch):
    texts = pa.array([None, "", "ü 12", *["(x)" + "😀 month 345 " * 300] * 4000, "7" * 3000, None, "(8)"])
    steps = [arrow.number_text, Strip("(", ")"), lambda t: t + "9", arrow.number_text]
    want = [None if t is None else arrow.number_text(arrow.delimited_text(arrow.number_text(t), "(", ")") + "9") for t in texts[:5].to_pylist() + texts[-3:].to_pylist()]
    tracemalloc.start()
    got = arrow.stepped(texts, steps)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[:5].to_pylist() + got[-3:].to_pylist() == want
    assert peak < 30e6 < 57e6 < 4 * 12 * 300 * 4000  # the last is what all texts take as strings
    monkeypatch.setattr(arrow, "PIECE_BYTES", 10)
    odd = pa.array(["12345678901", "", None, "1", "22", "", "333", "4444444444444", None]).slice(1)
    assert [p.to_pylist() for p in arrow.pieces(odd)] == [["", None, "1", "22", "", "333"], ["4444444444444"], [None]]
    assert arrow.stepped(odd, [str]).to_pylist() == odd.to_pylist()
    assert arrow.stepped(odd.slice(0, 0), [str]).to_pylist() == [] and arrow.stepped(pa.array([None, None], pa.string()), [str]).to_pylist() == [None, None]


def test_functions_of_a_table_share_a_worker(spark):
    """One step of the plan, as each has a Python process of its own in every task."""
    rows = jobs.preprocess(spark.createDataFrame([(1, "a 1", "b", None, "")], "id int, title string, article string, category string, reporter string"), jobs.Preprocess(urls=True))
    assert rows._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert tuple(rows.first()) == (1, "a 1", "b", None, "")


def test_cascades_of_a_batch_in_pieces(spark):
    """A batch of Spark's, of which all texts at once would be 150 MB of strings; every text comes out as it does alone."""
    own = ["【快訊】★" + "月 mars 😀 Ende. " * 900 + f"{i}(更新)●" for i in range(7)]
    rules = storm.ARTICLE + storm.TITLE
    held = arrow._compiled(tuple(rules))
    steps = [lambda t: arrow.cascade_text(t, held)]
    want = [steps[0](t) for t in own]
    texts = pa.array([*own, None] * 400)
    tracemalloc.start()
    got = arrow.stepped(texts, steps)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.equals(pa.array([*want, None] * 400)) and peak < 40e6 < 150e6 < 4 * 15 * 900 * 2800
    table = spark.range(3000).select("id", F.element_at(F.array(*map(F.lit, own)), (F.col("id") % 7 + 1).cast("int")).alias("t"))
    done = table.select("id", *(arrow.rewrite(F.col("t"), r).alias(n) for n, r in (("a", rules), ("b", cna.ARTICLE)))).filter("id in (5, 2998)").orderBy("id").collect()
    assert [r["a"] for r in done] == [want[5], want[2998 % 7]]


def test_the_flagship_needs_two_functions(spark):
    """One on each side of the length filter; each function of another kind is a Python process more in every task."""
    rows = spark.createDataFrame([(1, "題 1", "(x)" + "a文 " * 9, "ｃ", None)], "id int, title string, article string, category string, reporter string")
    done = jobs.preprocess(rows, jobs.Preprocess(urls=True, parens=True, brackets=True, emoji=True, least=5, most=500, english=True, guillemets=True, numbers=True))
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"ArrowEvalPython", plan)) == 2
    assert tuple(done.first())[1:] == ("題 <num>", "a文 " * 8 + "a文", "c", None)


def test_the_flagship_has_one_python_process_a_task(spark, tmp_path):
    """Its length filter is a step of the function, and category and reporter, which it doesn't use, have none."""
    texts = spark.range(3).select(F.col("id").alias("doc_id"), F.repeat(F.lit("月 "), F.col("id").cast("int") * 100).alias("text"), F.lit("zh").alias("lang"), F.lit("src1").alias("source"))
    texts.write.parquet(f"{tmp_path}/documents.parquet")
    done = queries.preprocess_news(spark, str(tmp_path))
    assert done._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted((r["id"], r["company_id"], r["article"][:3]) for r in done.collect()) == [(1, 1, "月 月"), (2, 1, "月 月")]


def test_lengths_as_a_step_keep_what_the_filter_keeps(spark):
    texts = [None, "", "a", "(x)", "ab", "😀é", "a(b)c", "abc", "月月月", "abcd", "😀" * 4, " ab ", "ＡＢ１"]
    rows = spark.createDataFrame([(i, t, t, t, None) for i, t in enumerate(texts)], "id int, title string, article string, category string, reporter string")
    for least, most in [(0, -1), (1, -1), (0, 0), (2, 3), (3, 2), (4, -1)]:
        got = jobs.preprocess(rows, jobs.Preprocess(parens=True, least=least, most=most, english=True, numbers=True)).collect()
        plain = jobs.preprocess(rows, jobs.Preprocess(parens=True)).filter(columns.length_between(F.col("article"), least, most) if (least, most) != (0, -1) else F.lit(True))
        want = jobs.preprocess(plain, jobs.Preprocess(english=True, numbers=True)).collect()
        assert sorted(got) == sorted(want) and ((least, most) != (2, 3) or {r["id"] for r in got} == {4, 5, 6, 7, 8, 11, 12})
    with pytest.raises(ValueError):
        jobs.preprocess(rows, jobs.Preprocess(least=-1))


def test_results_go_back_in_pieces(spark):
    """No piece of what a function gives back holds more than about ``PIECE_BYTES``, whatever the batch; a batch of Spark's has 10000 rows here."""
    table = spark.range(0, 20000, 1, 1).select("id", F.repeat(F.lit("月1 "), 200).alias("t"))
    kind = T.StructType([T.StructField("t", T.StringType()), T.StructField("n", T.IntegerType())])
    seen = table.select("id", arrow.pieced([F.col("t")], kind, lambda t: [t, pa.repeat(pa.scalar(len(t), pa.int32()), len(t))]).alias("x"))
    rows = seen.select("id", "x.*").collect()
    assert [r["id"] for r in rows] == list(range(20000)) and {r["t"] for r in rows} == {"月1 " * 200}
    assert max(r["n"] for r in rows) <= arrow.PIECE_ROWS < 10000 and max(r["n"] for r in rows) * 1000 <= arrow.PIECE_BYTES


def test_cascades_of_a_text_share_a_function_that_gives_back_pieces(spark, tmp_path, monkeypatch):
    """Spark's batch of 10000 rows comes back in pieces, not as five whole columns."""
    texts = [None, "", "【快訊】★月 mars 😀 Ende.(更新)●", "a  b"]
    packs = {"a": storm.ARTICLE + storm.TITLE, "b": cna.ARTICLE, "empty": []}
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = rows.select("id", arrow.rewrites(F.col("t"), packs).alias("x")).select("id", "x.*").orderBy("id").collect()
    want = [(i, *(None if t is None else arrow.cascade_text(t, arrow._compiled(tuple(r))) for r in packs.values())) for i, t in enumerate(texts)]
    assert [tuple(r) for r in got] == want
    rows.select(F.col("id").alias("doc_id"), F.col("t").alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    used = []
    pieced = arrow.pieced
    monkeypatch.setattr(arrow, "pieced", lambda *a: used.append(a) or pieced(*a))
    done = queries.rewrite_cascades(spark, str(tmp_path))
    assert len(used) == 1 and done._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert done.columns == ["id", "cna", "epochtimes", "ettoday", "ntdtv", "storm"] and done.count() == 4
