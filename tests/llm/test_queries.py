"""Queries without SQL, and the pipeline, against plain versions over whole tables."""

import datetime
import hashlib
import re
import zlib
from collections import Counter as Bag
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkloom.llm import _bytes as tb
from sparkloom.llm import cohort_matrix, language_id, quality_classifier, queries, token_alignment, token_counts
from sparkloom.llm.quality_rules import BOILERPLATE, BOILERPLATE_WORDS, MOST_LOST_PERCENT, SEPARATORS, SHOUTS, STOPS

SF_DIR = "/root/testdata/sf0.001"
TOKENIZERS = queries.TOKENIZERS


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/piece_bpe_32k.model")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_token_counts_query(spark, texts):
    encode = token_counts.Counter(token_counts.load_ranks(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")).encoding.encode_ordinary
    got = queries.op3_token_counts(spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        old = new = texts[r["doc_id"]] or ""
        for share, removed, added in ((0.3, 0, f" (see entry {r['doc_id']}) "), (0.6, 40, ""), (0.9, 12, "\n\nAddendum: it's 2024. ")):
            at = int(len(old) * share)
            new = new[:at] + added + new[at + removed :]
        assert (r["n_tokens_before"], r["n_tokens"]) == (len(encode(old)), len(encode(new)))
        assert r["text_sha256"] == hashlib.sha256(new.encode()).hexdigest()


def test_sentencepiece_query(spark, texts, library):
    got = queries.op7_sentencepiece(spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]] or "")
        assert r["round_trip"] and (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest())


def test_classifier_query_on_held_out_rows(spark):
    """Every text's score is that of the gated attention, and held-out labels are met."""
    sf_dir = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.op9_quality_classifier(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality is not null").collect()}
    assert len(got) == docs.count() and all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3) for i, r in got.items())
    held = [i for i, r in got.items() if r["held_out"] and i in label]
    assert len(held) > 30 and np.mean([got[i]["predicted"] == label[i] for i in held]) >= 0.9
    labels = spark.createDataFrame([(i, y) for i, y in label.items() if zlib.crc32(str(i).encode()) % 5], "doc_id long, label int")
    model = quality_classifier.fit_quality(quality_classifier.draw(docs, labels))
    p = model.weights
    for r in docs.limit(100).collect():
        x, _ = quality_classifier.encode_passages(*tb.utf8(pa.array([r["text"]], pa.string())))
        codes = [np.tanh(np.clip((row - model.mean) / model.spread, -8, 8) @ p["W"] + p["b"]) for row in x.astype(float)]
        gates = [np.exp((np.tanh(h @ p["V"]) / (1 + np.exp(-(h @ p["U"])))) @ p["w"]) for h in codes]
        bag = sum(g * h for g, h in zip(gates, codes, strict=True)) / sum(gates)
        assert abs(got[r["doc_id"]]["score"] - 1 / (1 + np.exp(-(bag @ p["c"] + p["d"][0])))) < 1e-6


def _words(text):
    return text.encode().split()


def _windows(words, k):
    return [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]


def _bad_line(line):
    words = _words(line)
    chars = sum(len(w.decode()) for w in words)
    count = lambda kinds: sum(line.count(c) for c in kinds)
    parts = count(SEPARATORS) + words.count(b"/")
    return bool(words) and (
        (len(words) >= 10 and not count(STOPS))
        or (len(words) >= 3 and count(SHOUTS) > len(words))
        or 10 * count("#*$%&|<>") > chars
        or (parts >= 3 and 4 * parts >= len(words))
        or (len(words) <= BOILERPLATE_WORDS and any(p in line.encode().lower().decode() for p in BOILERPLATE))
    )


def _rules(docs):
    out = {}
    for doc, text in docs.items():
        words, lines = _words(text or ""), (text or "").split("\n")
        seen = Bag(_windows(words, 3))
        repeated = {p for i, w in enumerate(_windows(words, 3)) if seen[w] > 1 for p in range(i, i + 3)}
        weight = lambda part: sum(len(w.decode()) for w in _words(part))
        lost = sum(weight(x) for x in lines if _bad_line(x))
        if len(words) >= 50 and 2 * len(repeated) <= len(words) and 100 * lost <= MOST_LOST_PERCENT * weight(text):
            out[doc] = "\n".join(x for x in lines if not _bad_line(x))
    return out


def _lines(docs):
    key = lambda line: line.encode().strip(b" \t\n\v\f\r").lower().decode()
    held = defaultdict(set)
    for doc, text in docs.items():
        for line in text.split("\n"):
            held[key(line)].add(doc)
    gone = lambda line, doc: len(key(line)) >= 20 and len(held[key(line)]) >= 3 and max(held[key(line)]) != doc
    left = {doc: "\n".join(x for x in text.split("\n") if not gone(x, doc)) for doc, text in docs.items()}
    return {doc: text for doc, text in left.items() if _words(text)}


def _near(docs):
    sets, least = {}, {doc: doc for doc in docs}
    for doc, text in docs.items():
        words = text.encode().lower().split()
        sets[doc] = set(_windows(words, 5)) or {tuple(words)}
    root = lambda x: x if least[x] == x else root(least[x])
    for a in docs:
        for b in docs:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                least[high] = low
    return {doc: text for doc, text in docs.items() if least[doc] == doc}


def _clean(docs, items):
    cut = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower().decode())
    wanted = defaultdict(set)
    for words in map(cut, items):
        if words:
            k = min(13, len(words))
            wanted[k] |= set(_windows(words, k))
    out = {}
    for doc, text in docs.items():
        words = cut(text)
        hit = {p for k, own in wanted.items() for i, w in enumerate(_windows(words, k)) if w in own for p in range(i, i + k)}
        if not (hit and 20 * len(hit) >= len(words)):
            out[doc] = text
    return out


@pytest.fixture
def planted(spark, tmp_path, texts):
    """The documents with copies, near copies, a benchmark passage, a shared passage, junk lines and odd texts added."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    fresh = [" ".join(f"w{i}x{j}," for j in range(120)) for i in range(8)]
    passage = " ".join(f"shared{j}," for j in range(60))
    item = max(items, key=lambda t: len((t or "").split()))
    nav = "home | news | sport | more"
    more = [
        fresh[0], fresh[0], fresh[0].replace("w0x7,", "other,"), fresh[1].upper(), fresh[1], f"{fresh[2]}\n{passage}", f"{fresh[3]}\n {passage.upper()}", f"{fresh[4]}\n{passage}\n{nav}",
        f"{fresh[5]}\n{item}", f"{nav}\n{fresh[6]}\nAll rights reserved", "", None, passage, fresh[7] + "\n" * 500,
    ]
    start = max(texts) + 1
    extra = spark.createDataFrame([(start + i, t, "xx", "src1", len(t or "")) for i, t in enumerate(more)], docs.schema)
    docs.unionByName(extra).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_DIR}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), texts | {start + i: t for i, t in enumerate(more)}, items, start


def test_pipeline_matches_plain_version(spark, planted, library):
    pipeline = pytest.importorskip("corpus_pipeline")
    sf_dir, docs, items, start = planted
    want = _clean(_near(_lines(_rules(docs))), items)
    got = {r["doc_id"]: r for r in pipeline.run(spark, sf_dir).collect()}
    assert {doc: r["text"] for doc, r in got.items()} == want
    assert {start, start + 3, start + 13} <= set(want) and not {start + 1, start + 2, start + 4, start + 8, start + 10, start + 11} & set(want)
    for doc, r in got.items():
        assert r["ids"] == library.encode(want[doc]) and r["n_chars"] == len(want[doc]) and r["n_tokens"] == len(r["ids"])


def test_near_stage_keeps_unlinked_rows_without_an_id_of_their_own(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcde")
    rows = [(1, a), (1, b), (1, a), (None, c), (None, c), (None, d), (3, e), (2, e), (None, e)]
    docs = spark.createDataFrame([(i, t, "xx", "src1", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["text"]) for r in pipeline.near(spark, docs, "").collect()]
    assert Bag(got) == Bag([(1, a), (1, b), (None, c), (None, d), (2, e)])


def test_pipeline_of_empty_tables(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").filter(F.lit(False)).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def _aligned(text, a, b, names):
    """Ids, groups as text and linked id pairs of one text, by a plain walk over its bytes."""
    if not text:
        return [], [], "", 0, []
    ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)]
    raw = [[bytes(names[c] for c in a.id_to_token(i)) for i in ids[0]]]
    raw.append([bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]])
    if any(b"".join(r) != (" " + text).encode() for r in raw):
        return [], [], "", 0, []
    ends = [np.cumsum([len(x) for x in r]).tolist() for r in raw]
    groups, links, at = [], [], [0, 0]
    for cut in sorted(set(ends[0]) & set(ends[1])):
        own = [range(at[s], ends[s].index(cut, at[s]) + 1) for s in (0, 1)]
        at = [r.stop for r in own]
        groups.append("|".join(",".join(str(ids[s][k]) for k in own[s]) for s in (0, 1)))
        begins = [[ends[s][k] - len(raw[s][k]) for k in own[s]] for s in (0, 1)]
        for i, x in enumerate(own[0]):
            links += [(ids[0][x], ids[1][y]) for j, y in enumerate(own[1]) if max(begins[0][i], begins[1][j]) < min(ends[0][x], ends[1][y])]
    return ids[0], ids[1], ";".join(groups), len(groups), links


def _alignment_rows(texts):
    a = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/piece_bpe_32k.model")
    done = {i: _aligned(t, a, b, token_alignment.byte_names()) for i, t in texts.items()}
    times = Bag(pair for d in done.values() for pair in d[4])
    most = defaultdict(int)
    for (_, y), n in times.items():
        most[y] = max(most[y], n)
    return {
        i: (len(x), len(y), n, len(links), sum(times[p] == most[p[1]] for p in links), sum(times[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if x else "")
        for i, (x, y, text, n, links) in done.items()
    }


ALIGNED = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_query(spark, texts):
    got = {r["doc_id"]: tuple(r[c] for c in ALIGNED) for r in queries.op11_token_alignment(spark, SF_DIR).collect()}
    assert got == _alignment_rows(texts)


def test_alignment_of_odd_texts(spark, monkeypatch):
    odd = ["", None, " ", "  a", "a  b \n\n  c", "▁x y", "it's  é　b c d e", "<|endoftext|> hi </s> <s> <0x41>", "\0 \x1f a", "ab" * 700, "日本 語 \U0001f600 x", "a   b c"]
    rows = dict(enumerate(odd + ["the same again"] * 5))
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows.items()], "doc_id long, text string, block string, n_a int, pairs string").repartition(3)
    a, b = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
    want = _alignment_rows(rows)
    out = token_alignment.align_tokenizers(docs, a, b).collect()
    assert len(out) == len(rows)
    for r in out:
        assert tuple(r[c] for c in ALIGNED[:-1]) == want[r["doc_id"]][:-1] and (r["block"], r["pairs"]) == ("x", "y")
        sides = [[(g, i) for i, g in zip(r[f"{s}_ids"], r[f"{s}_groups"], strict=True)] for s in "ab"]
        text = ";".join("|".join(",".join(str(i) for g, i in side if g == k) for side in sides) for k in range(r["n_groups"]))
        assert (hashlib.sha256(text.encode()).hexdigest() if text else "") == want[r["doc_id"]][-1]
    empty = token_alignment.align_tokenizers(docs.limit(0), a, b)
    assert empty.columns == out[0].__fields__ and empty.count() == 0


def test_language_query_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.op12_language_id(spark, sf_dir).collect()}
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert got.keys() == docs.keys() and all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for i, r in got.items())
    held = [i for i, r in got.items() if r["held_out"]]
    assert len(held) > 150 and np.mean([got[i]["lang_pred"] == docs[i]["lang"] for i in held]) >= 0.98


def _labelled(scores, penalty):
    """Viterbi over one text's words, cell by cell."""
    best, back = [scores[0]], []
    for row in scores[1:]:
        top = max(range(len(row)), key=lambda j: (best[-1][j], -j))
        came = [j if best[-1][j] >= best[-1][top] - penalty else top for j in range(len(row))]
        best.append([row[j] + (best[-1][j] if came[j] == j else best[-1][top] - penalty) for j in range(len(row))])
        back.append(came)
    at = max(range(len(best[-1])), key=lambda j: (best[-1][j], -j))
    out = [at]
    for came in reversed(back):
        at = came[at]
        out.append(at)
    return out[::-1]


def test_language_labels_are_the_best_paths():
    rng = np.random.default_rng(5)
    scores = rng.normal(size=(60, 4)) * 6
    scores[rng.random((60, 4)) < 0.2] = -np.inf
    scores[:, 0] = np.maximum(scores[:, 0], -30)
    sizes = np.array([0, 1, 30, 0, 7, 200, 1])
    first = np.concatenate([[0], np.cumsum(sizes)])
    which = rng.integers(0, 60, first[-1])
    got = language_id.label(scores, which, first, 4.0)
    want = [j for a, b in zip(first, first[1:], strict=False) if b > a for j in _labelled(scores[which[a:b]].tolist(), 4.0)]
    assert got.tolist() == want


def test_languages_of_odd_texts(spark):
    said = {"en": "the cat and the dog went over the hill with them", "de": "der hund und die katze gingen nicht über den berg", "ru": "собака и кошка пошли через гору", "ja": "犬と猫は山を越えて行った"}
    rows = spark.createDataFrame([(t, x) for x, t in said.items() for _ in range(3)] + [("lost words", None), (None, "en"), ("", "de")], "text string, lang string")
    model = language_id.fit_languages(rows)
    again = language_id.fit_languages(rows.repartition(7))
    assert model.langs == ["de", "en", "ja", "ru"] and np.array_equal(model.log, again.log) and np.array_equal(model.candidate, again.candidate)
    mixed = f"{said['en']}. {said['de']}! {said['ru']} – {said['en']}"
    texts = [mixed, None, "", "12 + 3 …", "собака", "猫", "ΑΒΓ", "über " * 60_000]
    docs = spark.createDataFrame([(i, t, "z", 7) for i, t in enumerate(texts)], "doc_id long, text string, lang_pred string, lang int")
    got = {r["doc_id"]: r for r in language_id.identify_languages(docs, model).collect()}
    assert [mixed[s["begin"] : s["end"]] for s in got[0]["spans"]] == [said["en"], said["de"], said["ru"], said["en"]]
    assert [s["lang"] for s in got[0]["spans"]] == ["en", "de", "ru", "en"] and got[0]["lang_pred"] == "en" and got[0]["lang"] == 7
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and all(got[i]["score"] == 0 and not got[i]["spans"] for i in (1, 2, 3))
    assert (got[4]["lang_pred"], got[5]["lang_pred"], got[7]["lang_pred"]) == ("ru", "ja", "de") and got[6]["lang_pred"] in model.langs
    nothing = language_id.fit_languages(rows.limit(0))
    assert {r["lang_pred"] for r in language_id.identify_languages(docs, nothing).collect()} == {"und"}
    assert language_id.identify_languages(docs.limit(0), model).count() == 0


def test_cohort_matrix_of_odd_rows(spark, monkeypatch):
    """Null and repeated rows, starts before 1970, ties, clashing names and many blocks, against a plain count."""
    monkeypatch.setattr(cohort_matrix, "HELD", 3)
    base, week = datetime.datetime(1969, 12, 1), datetime.timedelta(days=7)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        ts = None if i % 50 == 0 else base + datetime.timedelta(microseconds=int(rng.integers(0, 40 * 604_800_000_000)))
        rows.append((i, ts, None if i % 41 == 0 else int(rng.integers(0, 12)), ["error", "view", None][i % 3], [None, 1.005, float("nan"), -2.5][i % 4], int(rng.integers(0, 2)), "c"))
    rows += rows[::7] + [(700, base, 99, "error", 1.0, 1, "c"), (701, base + week, 99, "view", 1.0, None, "c"), (702, base + week - datetime.timedelta(microseconds=1), 99, None, 0.1, 1, "c")]
    events = spark.createDataFrame(rows, "click_id long, ts timestamp_ntz, client_id long, kind string, value double, early int, state string")
    clients = spark.createDataFrame([(i, f"s{i % 3}" if i % 5 else None) for i in range(10)] + [(3, "a"), (None, "b")], "client_id long, source string")
    got = cohort_matrix.cohort_matrix(events, clients, [F.col("early") == 1, F.lit(True)], F.col("kind") == "error")
    assert dict(got.dtypes) == {"state": "int", "segment": "string"} | dict.fromkeys(["cohort", "period", "users", "users_crc32", "moved", "cents"], "bigint")
    epoch, micro = datetime.datetime(1970, 1, 1), datetime.timedelta(microseconds=1)
    starts, cells = {}, defaultdict(lambda: [set(), 0])
    plain = {repr(r): r for r in rows if r[1] is not None and r[2] is not None}.values()
    for _, ts, c, kind, _, early, _ in plain:
        for s in (0, 1):
            if kind == "error" and (s or early == 1):
                starts[s, c] = min(starts.get((s, c), ts), ts)
    cohort = lambda s, c: (starts[s, c] - epoch).days // 7
    segments = {i: f"s{i % 3}" if i % 5 else "" for i in range(10)} | {3: "a"}
    for _, ts, c, _, value, early, _ in plain:
        for s in (0, 1):
            if (s or early == 1) and (s, c) in starts and ts >= starts[s, c]:
                cell = cells[s, segments.get(c, ""), cohort(s, c), (ts - starts[s, c]) // micro // (7 * 86_400_000_000)]
                cell[0].add(c)
                cell[1] += 0 if value is None or value != value else int(np.floor(100 * value + 0.5))
    want = {
        (*k, len(cs), sum(zlib.crc32(str(c).encode()) for c in cs), sum((0, c) in starts and (1, c) in starts and cohort(0, c) != cohort(1, c) for c in cs), cents)
        for k, (cs, cents) in cells.items()
    }
    assert {tuple(r) for r in got.collect()} == want and len(want) > 100
    assert cohort_matrix.cohort_matrix(events.limit(0), clients, [F.lit(True)], F.col("kind") == "error").count() == 0
    assert cohort_matrix.cohort_matrix(events, clients.limit(0), [F.lit(True)], F.col("kind") == "error").filter("segment <> ''").count() == 0
