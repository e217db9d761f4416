"""Reporter patterns and selectors in linear time, against plain ``re`` and a plain matcher."""

import random
import re
import time

import pytest

from sparkloom import queries
from sparkloom.functions import html, seek
from sparkloom.functions.rules import chinatimes, cna, epochtimes, ettoday, ftv, ltn, ntdtv, setn, storm
from sparkloom.operators import extract

PACKS = (chinatimes, cna, epochtimes, ettoday, ftv, ltn, ntdtv, setn, storm)
PATTERNS = [
    p if isinstance(p, str) else p[0]
    for pack in PACKS
    for key in ("REPORTERS", "REPORTERS_BEGIN", "REPORTERS_END", "ARTICLE_BAD", "ARTICLE_END", "ARTICLE", "TITLE")
    for p in getattr(pack, key, [])
]
PARTS = ["新唐人", "新塘人", "記者", "责", "責任編輯:", "報導", "报导", "/", "(", ")", "[", "]", "〔", "〕", "◎", " ", "。", "王小明", "台北", "大紀元", "文:", "圖", "|", "abc", "12", "月", "日", "中央社", "駐",
         "特派員", "年", "作者:", "整理:", "・", "【", "】", "編譯", "●", "!", "\n", "報", "綜合", "採訪", "的", "影音編輯/", "$", "是", "轉自", "電視台", "旁白", "製作", ";", "文字:", "*"]


def _spans(matches):
    return [(m.span(), m.groups()) for m in matches]


def test_sought_matches_are_those_of_re():
    rng, pack = random.Random(4), seek.Pack(PATTERNS)
    assert sum(bool(s.strings) for s in pack.sought) > 0.8 * len(PATTERNS)
    for _ in range(500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40)))
        places = pack.places(text)
        for pattern, sought, at in zip(PATTERNS, pack.sought, places, strict=True):
            want = _spans(re.finditer(pattern, text))
            assert _spans(sought.finditer(text, at if sought.strings else None)) == want == _spans(sought.finditer(text)), (pattern, text)


def test_sought_matches_on_all_pages(spark):
    reporters = [p for pack in PACKS for p in getattr(pack, "REPORTERS", []) + getattr(pack, "REPORTERS_END", [])]
    pack = seek.Pack(reporters)
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        text = html.parse(r["html"] or "").text.replace("the", "記者").replace(" an", " 新唐人").replace("ion", "報導")
        for pattern, sought, at in zip(reporters, pack.sought, pack.places(text), strict=True):
            assert _spans(sought.finditer(text, at if sought.strings else None)) == _spans(re.finditer(pattern, text))


@pytest.mark.parametrize("ending", ["", "責任編輯:王 新唐人記者李報導 記者陳/台北"])
@pytest.mark.parametrize("company", queries._MARKUP)
def test_a_megabyte_without_punctuation(company, ending):
    form, before, after = queries._MARKUP[company]
    words = "lorem ipsum dolor amet tempora nisi quaerat voluptatem 台北市政府今天宣布新的交通措施 "
    began = time.time()
    *_, error = extract.extract_one(company, before + words * (1_000_000 // len(words)) + ending + after, form.format("123"), extract.Options())
    assert error is None and time.time() - began < 5  # about 0.5 s on an idle core; plain patterns took minutes


def _plain(x, selector):
    return any(_plain_complex(x, piece) for piece in html._pieces(selector))


def _elements(x):
    return [y for y in x.children if isinstance(y, html.Node)] if x is not None else []


def _elder(x):
    own = _elements(x.parent)
    return own[: [id(y) for y in own].index(id(x))][::-1]


def _plain_complex(x, text):
    """The last compound fits, and what stands before it fits a relative."""
    depth, at, quote = 0, 0, ""
    cuts = []
    for i, c in enumerate(text):
        quote = "" if c == quote else quote or (c if c in "\"'" else "")
        depth += (c in "([") - (c in ")]") if not quote else 0
        if not depth and not quote and c in " >+~" and text[:i].strip():
            cuts.append(i)
    if not cuts:
        return _plain_compound(x, text)
    at = cuts[-1]
    start = at
    while start - 1 in cuts:
        start -= 1
    link = text[start : at + 1].strip() or " "
    if not _plain_compound(x, text[at + 1 :]):
        return False
    rest = text[:start].strip()
    if link in " >":
        above, y = [], x.parent
        while y is not None and y.name:
            above.append(y)
            y = y.parent
        return any(_plain_complex(y, rest) for y in (above[:1] if link == ">" else above))
    return any(_plain_complex(y, rest) for y in (_elder(x)[:1] if link == "+" else _elder(x)))


def _plain_compound(x, text):
    at = 0
    while at < len(text):
        c = text[at]
        if c == ":":
            m = html._NAME.match(text, at + 1)
            end = html._closing(text, m.end())
            argument, at = text[m.end() + 1 : end].strip(), end + 1
            if m[0] == "has":
                found = False
                for piece in html._pieces(argument):
                    own = _elements(x.parent)
                    younger = own[len(_elder(x)) + 1 :]
                    near = {">": _elements(x), "+": younger[:1], "~": younger}.get(piece[0], list(x.walk()))
                    found |= any(_plain_complex(y, piece.lstrip(">+~ ")) for y in near)
                fits = found
            elif m[0] == "nth-child":
                n, _, of = argument.partition(" of ")
                fits = _plain(x, of or "*") and sum(_plain(y, of or "*") for y in _elder(x)) == int(n) - 1
            else:
                fits = _plain(x, argument) != (m[0] == "not")
        elif c == "[":
            m = html._ATTR.match(text, at)
            fits, at = html._attribute(m)(x), m.end()
        elif c == "*":
            fits, at = True, at + 1
        else:
            m = html._NAME.match(text, at + (c in "#."))
            fits = m[0] in x.attrs.get("class", "").split() if c == "." else x.attrs.get("id") == m[0] if c == "#" else x.name == m[0].lower()
            at = m.end()
        if not fits:
            return False
    return True


SELECTORS = [x for pack in PACKS for key in ("ARTICLE_AT", "TITLE_AT", "REMOVED_AT") if hasattr(pack, key) for x in html._pieces(getattr(pack, key))] + [
    "p:nth-child(2 of .a) b", "div > p:nth-child(2)", ":is(p,div) + :not(.a)", "p:has(> b)", "p:has(+ p)", "p:has(~ div.a)", "div:has(p:has(b)) ~ p", "*", "p b", "div div p", "a ~ a ~ a", "*:has(img)", "a, b.a",
]


def _random_page(rng):
    out, opened = [], []
    for _ in range(rng.randint(3, 40)):
        kind = rng.random()
        if kind < 0.6:
            tag = rng.choice(["p", "div", "a", "b", "strong", "img", "span", "blockquote", "hr"])
            attrs = "".join(
                f' {k}="{rng.choice(v)}"'
                for k, v, odds in (("class", ["a", "story", "paragraph", "a note", "ad_x"], 0.4), ("href", ["ETtoday", "bit.ly", "mall"], 0.2), ("id", ["artbody", "CMS_wrapper"], 0.2), ("style", ["color: red", "text-align: center"], 0.2))
                if rng.random() < odds
            )
            out.append(f"<{tag}{attrs}>")
            opened.append(tag)
        elif kind < 0.8 and opened:
            out.append(f"</{rng.choice(opened[-3:])}>")
        else:
            out.append("x")
    return "".join(out)


def test_selectors_are_those_of_a_plain_matcher():
    rng = random.Random(8)
    for _ in range(120):
        root = html.parse(_random_page(rng))
        nodes = list(root.walk())
        for selector in rng.sample(SELECTORS, 12):
            assert [id(x) for x in root.select(selector)] == [id(x) for x in nodes if _plain(x, selector)], selector
            if nodes:
                top = rng.choice(nodes)
                assert [id(x) for x in top.select(selector)] == [id(x) for x in top.walk() if _plain(x, selector)], selector
        for x in rng.sample(nodes, min(len(nodes), 3)):
            x.remove()
        assert all(x.parent is not None for x in root.walk())


@pytest.mark.parametrize("page", ["<div class=story>" + "<p>x</p>" * 100_000 + "</div>", "<p>x" * 100_000, "<p>x" * 50_000 + "</i>" * 50_000])
def test_selectors_on_wide_and_deep_pages(page):
    root = html.parse(page)
    began = time.time()
    assert not root.select(ettoday.REMOVED_AT)
    assert len(root.select("p")) == page.count("<p>") and time.time() - began < 10  # 1.5 s on an idle core


def test_images_are_hoisted_as_step_by_step():
    rng = random.Random(2)
    step = re.compile(r"(<strong[^>]*>[^<]*)(<img[^>]*>)([^<]*)")
    for _ in range(3000):
        raw = "".join(rng.choice(["<strong>", "<strong a='1'>", "</strong>", "<img>", "<img src='x'>", " ", "t", "<br/>", "<br />", "\n", "<b>", "<strong", "<img", ">", "<"]) for _ in range(rng.randint(0, 20)))
        want = re.sub(r"(\s*<br\s*/>)+\s*", " ", raw)
        while (after := step.sub(r"\2\1\3", want)) != want:
            want = after
        assert extract.Ettoday.repair(raw) == want
