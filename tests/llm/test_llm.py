import base64
import gzip
import hashlib
import io
import random
import zlib
from collections import Counter as Bag

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import _bytes as tb
from sparkloom.llm import decontaminate as dc
from sparkloom.llm import hmm, near_dedup, token_counts, warc
from sparkloom.llm import quality_classifier as qc
from sparkloom.llm import sentencepiece_codec as codec
from sparkloom.llm.chat_format import format_chats, read_loss, read_turns
from sparkloom.llm import _shared, line_dedup as lines
from sparkloom.llm.line_dedup import line_dedup
from sparkloom.llm.quality_rules import quality_rules

TOKENIZERS = "/opt/tokenizers"
ODD = ["", None, "one", "two  words", "\n\n \n", "a" * 20_000, " ".join(["w"] * 30_000), "tab\tx\x0by", "é 中文 ß"]


def _docs(spark, texts, **more):
    """Documents with an odd row each: a null id, a repeated row, and a column named like a result."""
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "null id", "x"), (0, texts[0], "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string")


def _sentences(rng, n, words=60):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n * words // n))


def _near_truth(texts, k):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append(set(zip(*[w[i:] for i in range(k)], strict=False)) if len(w) >= k else ({tuple(w)} if w else set()))
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in range(len(texts))}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(spark, k):
    rng = random.Random(k)
    texts = list(ODD)
    for _ in range(8):
        base = _sentences(rng, 60).split()
        texts.append(" ".join(base))
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = "edit" + str(rng.randrange(10**6))
            texts.append(" ".join(copy))
    want = _near_truth(texts, k)
    got = near_dedup.near_duplicates(_docs(spark, texts), k).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and not r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]] and r["kept"] == (r["component_id"] == r["doc_id"])


@pytest.mark.parametrize("block", [1024, 7])
def test_near_duplicates_of_templates(spark, monkeypatch, block):
    """Pages of one template just under the threshold meet nobody; linked ones among them, and long texts, are found."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(4)
    base = [f"t{i}" for i in range(90)]
    texts = [" ".join(base + [f"p{i}w{j}" for j in range(14)]) for i in range(3000 if block > 7 else 300)]
    n = len(texts)
    texts += [f"{texts[i]} more" for i in range(0, n, 50)]
    texts += [" ".join(base + [f"q{i // 3}w{j}" for j in range(12)] + [f"r{i}"]) for i in range(60)]
    huge = [str(rng.randrange(10**6)) for _ in range(60_000)]
    texts += [" ".join(huge), " ".join(huge[:-3000]), " ".join(huge[20_000:])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs, 2).collect()}
    want = {i: i for i in range(len(texts))} | {n + i // 50: i for i in range(0, n, 50)}
    at = n + len(range(0, n, 50))
    want |= {at + i: at + i // 3 * 3 for i in range(60)} | {len(texts) - 2: len(texts) - 3}
    assert got == want


def test_prefixes_meet_every_linked_pair():
    rng = np.random.default_rng(3)
    often = rng.integers(0, 50, near_dedup.CELLS)
    run = near_dedup._prefixes(80, lambda: often)
    for _ in range(300):
        pool = tb.splitmix(rng.integers(1, 2**60, 400).astype(np.uint64))
        a = np.unique(rng.choice(pool, rng.integers(1, 300), replace=False))
        extra, fewer = rng.integers(0, len(a) // 5 + 1), rng.integers(0, len(a) // 5 + 1)
        b = np.unique(np.concatenate([rng.permutation(a)[fewer:], tb.splitmix(rng.integers(2**61, 2**62, extra).astype(np.uint64))]))
        common = len(np.intersect1d(a, b))
        if not len(b) or 100 * common < 80 * (len(a) + len(b) - common):
            continue
        large, small = sorted((a, b), key=len, reverse=True)
        batch = pa.RecordBatch.from_pydict({"rep": [1, 2], "n": [len(large), len(small)], "component": [1, 2], "shingles": [large.tobytes(), small.tobytes()]})
        rows = pa.Table.from_batches(run(iter([batch]))).to_pylist()
        assert {r["key"] for r in rows if r["rep"] == 1} & {r["key"] for r in rows if r["rep"] == 2 and r["tells"]}


def test_near_duplicates_empty(spark):
    assert near_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bucket_keys_meet_every_pair_in_distance():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 256, (200, near_dedup.SYMBOLS)).astype(np.uint8)
    b = a.copy()
    for row in b:
        at = rng.choice(near_dedup.SYMBOLS, near_dedup.MOST_APART, replace=False)
        row[at] += 1
    assert (near_dedup.bucket_keys(a) == near_dedup.bucket_keys(b)).any(axis=1).all()


def test_quality_rules(spark):
    rng = random.Random(3)
    good = _sentences(rng, 60) + "."
    nav = "home | news | sport | more | here"
    texts = [*ODD, good, good + "\n" + nav, "\n".join([nav.replace("home", f"h{i}x") for i in range(40)]), " ".join(f"w{i}***" for i in range(80)), good + "\n" + good, good.upper().replace(" ", "!! ")]
    rows = {r["doc_id"]: r for r in quality_rules(_docs(spark, texts)).filter("doc_id is not null").collect()}
    assert [rows[i]["kept"] for i in range(len(ODD), len(texts))] == [True, True, False, False, False, False]
    assert rows[len(ODD) + 1]["clean_text"] == good and rows[len(ODD) + 1]["n_failed_lines"] == 1
    for i, t in enumerate(texts):
        words = (t or "").encode().split()
        lines = [x for x in (t or "").split("\n") if x.encode().split()]
        windows = Bag(zip(words, words[1:], words[2:], strict=False))
        covered = {p for j in range(len(words) - 2) if windows[tuple(words[j : j + 3])] > 1 for p in (j, j + 1, j + 2)}
        r = rows[i]
        want = (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words))


def test_quality_rules_in_other_scripts(spark):
    word = lambda base, i: chr(base + i % 20) + chr(base + i % 7) + chr(base + i // 7 % 11)
    bodies = [" ".join(word(base, i) for i in range(60)) + stop for base, stop in ((0x0905, "।"), (0x0628, "؟"), (0x4E00, "。"), (0x0561, "։"), (0x1780, "។"))]
    bare = " ".join(word(0x0905, i) for i in range(12))
    menus = ["Start › Politik › Sport › Kultur", "inicio · deportes · cine · radio", "a / b / c / d", "Alle Rechte vorbehalten", "© 2024 Tous droits réservés", "Política de privacidad"]
    wide = "一 二 三！！！？"
    texts = [*bodies, *(f"{bodies[0]}\n{x}" for x in (bare, *menus, wide)), f"{bodies[0]}\n1/2/3/4 is no menu"]
    rows = {r["doc_id"]: r for r in quality_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [rows[i]["n_failed_lines"] for i in range(len(texts))] == [0] * len(bodies) + [1] * (len(menus) + 2) + [0]
    assert all(rows[i]["kept"] and rows[i]["clean_text"] == bodies[i] for i in range(len(bodies)))
    assert quality_rules(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_token_counts_after_edits(spark):
    counter = token_counts.Counter(token_counts.load_ranks(f"{TOKENIZERS}/byte_bpe_50k.tiktoken"))
    rng = random.Random(5)
    chars = "ab c'lls  \n\n  1é中!., "
    for _ in range(300):
        tree = token_counts.CountTree(counter, "".join(rng.choice(chars) for _ in range(rng.randint(0, 1500))))
        for _ in range(3):
            tree.edit(rng.randint(-1, len(tree.text) + 2), rng.randint(0, 40), "".join(rng.choice(chars) for _ in range(rng.randint(0, 30))))
            assert tree.total == len(counter.encoding.encode_ordinary(tree.text))
            assert tree.chars[1] == len(tree.text)
            tree = token_counts.CountTree(counter, tree.text, tree.chars, tree.tokens)
            assert all(x[i] == x[2 * i] + x[2 * i + 1] for x in (tree.chars, tree.tokens) for i in range(1, len(tree.leaves)))
    long = token_counts.CountTree(counter, "word and more " * 5000)
    was = list(long.tokens)
    assert long.edit(30_000, 2, "x") < 1000
    assert len(was) == len(long.tokens) and sum(a != b for a, b in zip(was, long.tokens, strict=True)) <= 2 * len(long.leaves).bit_length()
    for text in ("x" * 300_000, "a b" + " " * 300_000 + "c", "\n" * 1000 + "z"):
        tree = token_counts.CountTree(counter, text)
        for at, removed, added in ((5, 0, "y"), (150_000, 3, " q "), (0, 1, ""), (2, 10**6, "end")):
            tree.edit(at, removed, added)
            assert tree.total == len(counter.encoding.encode_ordinary(tree.text))
    docs = _docs(spark, ODD).withColumn("edits", F.expr("array(struct(1 as at, 2 as removed, 'new text' as added), null)"))
    path = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
    assert token_counts.count_edited(docs.filter("false"), path).count() == 0
    got = token_counts.count_edited(docs, path).filter("doc_id is not null").collect()
    assert len(got) == len(ODD) + 1
    again = token_counts.edit_trees(token_counts.count_edited(docs, path).withColumn("edits", F.expr("array(struct(2 as at, 1 as removed, 'Z' as added))")), path)
    for r in again.filter("doc_id is not null").collect():
        assert r["n_tokens"] == len(counter.encoding.encode_ordinary(r["text"])) and r["reencoded_chars"] <= len(r["text"])
    for r in got:
        old = ODD[r["doc_id"]] or ""
        assert r["text"] == old[:1] + "new text" + old[3:]
        assert (r["n_tokens_before"], r["n_tokens"]) == tuple(len(counter.encoding.encode_ordinary(x)) for x in (old, r["text"]))


def test_hmm_recursions_match_plain_ones():
    rng = np.random.default_rng(0)
    m = hmm.Model.first(rng.random(hmm.CLASSES) * 10)
    runs = [rng.integers(0, hmm.CLASSES, n).astype(np.uint16) for n in (1, 2, 63, 64, 65, 129, 300, 5)]
    classes, first = np.concatenate(runs), np.cumsum([0, *map(len, runs)])
    starts, moves, emits, total = np.zeros(hmm.STATES), np.zeros((hmm.STATES,) * 2), np.zeros((hmm.STATES, hmm.CLASSES)), 0.0
    logs = []
    for x in runs:
        a, s, b = [m.start * m.emit[:, x[0]]], [], [np.ones(hmm.STATES)]
        for t in range(len(x)):
            if t:
                a.append(a[-1] @ m.move * m.emit[:, x[t]])
            s.append(a[-1].sum())
            a[-1] = a[-1] / s[-1]
        for t in range(len(x) - 1, 0, -1):
            b.insert(0, m.move @ (m.emit[:, x[t]] * b[0]) / s[t])
        logs.append(np.log(s).sum())
        starts += a[0] * b[0]
        for t in range(len(x)):
            emits[:, x[t]] += a[t] * b[t]
            if t:
                moves += np.outer(a[t - 1], m.emit[:, x[t]] * b[t]) * m.move / s[t]
        total += logs[-1]
    assert np.allclose(m.log_likelihoods(classes, first), logs)
    got = m.expect(classes, first)
    assert all(np.allclose(g, w) for g, w in zip(got, (starts, moves, emits, total), strict=True))


def test_hmm_scores(spark, monkeypatch):
    rng = random.Random(2)
    texts = [*ODD, *(_sentences(rng, 50) for _ in range(40))]
    docs = _docs(spark, texts).withColumnRenamed("kept", "score")
    models, train = [], hmm.train
    monkeypatch.setattr(hmm, "train", lambda *args: models.append(train(*args)) or models[-1])
    monkeypatch.setattr(hmm, "BATCH_TOKENS", 20_000)
    rows = hmm.score_texts(docs, F.col("doc_id") % 4 == 1, rounds=2).collect()
    assert len(rows) == len(texts) + 2
    got = {r["doc_id"]: r for r in rows}
    model = models[0][0]
    words = {i: [*(t or "").encode().lower().split(), None] for i, t in enumerate(texts)} | {None: [b"null", b"id", None]}
    seen = Bag(w for i, x in words.items() if i is None or i % 4 != 1 for w in x)
    seen.update(words[0])  # the repeated row
    n, v = seen.total(), len(seen)
    kind = lambda w: 0 if w is None else int(hmm.tokens(*tb.utf8(pa.array([w.decode()])))[1][0])
    kinds = {w: kind(w) for x in words.values() for w in x}
    room = Bag()
    for w, c in seen.items():
        room[kinds[w]] += c + 1

    def score(x):
        weights, total = None, 0.0
        for w in x:
            weights = (model.start if weights is None else weights @ model.move) * model.emit[:, kinds[w]]
            total += np.log10(weights.sum()) + np.log10((seen[w] + 1) / (room[kinds[w]] + 1))
            weights = weights / weights.sum()
        return total

    for i, x in words.items():
        base = sum(np.log10((seen[w] + 1) / (n + v + 1)) for w in x)
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(x), sum(seen[w] > 0 for w in x), n, i is not None and i % 4 == 1)
        assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base))
        assert abs(r["score"] - score(x)) < 1e-6 * abs(r["score"])
    assert hmm.score_texts(docs.filter("false"), F.lit(False)).count() == 0


def test_likelihood_rises(spark):
    rng = np.random.default_rng(1)
    rows = [(bytes(rng.integers(1 + 300 * (i % 2), 300 + 300 * (i % 2), 80).astype(np.uint16).tobytes()),) for i in range(40)]
    _, seen = hmm.train(spark.createDataFrame(rows, "classes binary"), np.ones(hmm.CLASSES), 4)
    assert all(b > a for a, b in zip(seen, seen[1:], strict=False))


def test_chat_format(spark):
    rows = [
        (1, 0, "system", "s"), (1, 1, "user", "a<|im_end|>"), (1, 2, "user", "<\\|b<"), (1, 3, "assistant", "|c"), (1, 4, "assistant", None),
        (2, 0, "assistant", "<|im_sep|>\n<|im_start|>user\nhi"), (2, 0, "assistant", "<|im_sep|>\n<|im_start|>user\nhi"), (3, None, None, ""), (None, 1, "r%\n<|", "x"),
        (4, 0, "user", "<|x"), (4, 0, "user", "<b"), (4, 0, "user", None), *((5, i // 3, ("user", "assistant")[i // 7 % 2], f"text {i} <|im_end|>") for i in range(2000)),
    ]
    turns = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    made = format_chats(turns).select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    got = {r["conv_id"]: r for r in made.collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [(r[2], r[3] or "") for r in rows[:5]]
    assert got[1]["loss"] == "|c" and got[2]["loss"] == rows[5][3] * 2
    assert [tuple(t) for t in got[3]["turns"]] == [("", "")] and [tuple(t) for t in got[None]["turns"]] == [("r%\n<|", "x")]
    assert got[1]["formatted"].count("<|im_start|>user\n") == 1
    assert [t["text"] for t in got[4]["turns"]] == ["", "<b", "<|x"]
    long = sorted((r for r in rows if r[0] == 5), key=lambda r: r[1:])
    assert [tuple(t) for t in got[5]["turns"]] == [r[2:] for r in long] and got[5]["loss"] == "".join(r[3] for r in long if r[2] == "assistant")
    assert format_chats(turns.filter("false")).count() == 0


def test_wu_manber_matches_plain_search(monkeypatch, spark):
    rng = random.Random(4)
    word = lambda: rng.choice("abcd")
    bench = [(i, " ".join(word() for _ in range(rng.choice((1, 3, 5, 13, 14, 20))))) for i in range(1, 20)] + [(20, None), (21, "!!"), (None, "a"), (22, "Straße 中文 X9")]
    texts = [*ODD, "der straße, 中文 x9 end", *(" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(60))]
    cut = lambda t: "".join(c if c.isalnum() or not c.isascii() else " " for c in (t or "").encode().lower().decode()).split()
    want = {}
    for i, t in enumerate(texts):
        w = cut(t)
        hit, items = set(), set()
        for item, text in bench:
            b = cut(text)
            k = min(13, len(b))
            for at in range(len(b) - k + 1) if k and item is not None else ():
                for p in range(len(w) - k + 1):
                    if w[p : p + k] == b[at : at + k]:
                        hit |= set(range(p, p + k))
                        items.add(item)
        want[i] = (len(w), len(hit), sorted(items, key=str), bool(hit) and 20 * len(hit) >= len(w))
    table = spark.createDataFrame(bench, "item_id long, text string")
    for size in (1 << 20, 100):
        monkeypatch.setattr(dc, "PASS_BYTES", size)
        rows = dc.decontaminate(_docs(spark, texts), table).filter("doc_id is not null").collect()
        assert all((r["n_words"], r["n_hit"], r["items"], r["contaminated"]) == want[r["doc_id"]] for r in rows) and len(rows) == len(texts) + 1
    assert dc.decontaminate(_docs(spark, texts), table.filter("false")).filter("contaminated").count() == 0
    assert dc.decontaminate(_docs(spark, texts).filter("false"), table).count() == 0


def test_test_strings_are_compared_by_bytes(monkeypatch):
    """With every hash equal, all positions stop and one bucket holds all; only the bytes tell."""
    monkeypatch.setattr(tb, "range_hashes", lambda buf, starts, ends: np.zeros(len(starts), np.uint64))
    patterns = dc.build_patterns([1, 2, 3], ["a b c", "a b d", "a b c"])
    assert [len(p.firsts) for p in patterns] == [2]
    stop, found = patterns[0].find(dc.Words(*tb.utf8(pa.array(["x a b c", "A-B d", "a bc b"]))))
    items = [patterns[0].items[patterns[0].items_at[k] : patterns[0].items_at[k + 1]].tolist() for k in found]
    assert sorted(zip(stop.tolist(), items, strict=True)) == [(3, [1, 3]), (6, [2])]


def test_sentencepiece_matches_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/piece_bpe_32k.model")
    rng = random.Random(6)
    texts = [*ODD, *("a" * n for n in (40, 47, 48, 49, 300)), "=" * 1_000_000, " " * 30_000 + "x", "  lead", "   " * 20, "😀 a\x00b\n\n", "▁x ▁", *("".join(rng.choice(" abcdeéüß中\n\t  .,!") for _ in range(rng.randint(0, 80))) for _ in range(100))]
    docs = _docs(spark, texts)
    path = f"{TOKENIZERS}/piece_bpe_32k.model"
    encoded = codec.sentencepiece_encode(docs, path)
    rows = encoded.filter("doc_id is not null").collect()
    assert all(r["ids"] == library.encode(texts[r["doc_id"]] or "") and r["n_tokens"] == len(r["ids"]) for r in rows)
    back = codec.sentencepiece_decode(encoded, path).filter("doc_id is not null").collect()
    assert all(r["text"] == (texts[r["doc_id"]] or "").replace("▁", " ") for r in back)


def test_viterbi_gives_what_merges_give():
    """Random vocabularies, in which a piece may be made of others in many ways."""
    rng = random.Random(8)
    for _ in range(60):
        names = ["a", "b", "c"]
        for _ in range(rng.randint(3, 14)):
            names.append(rng.choice(names) + rng.choice(names))
        names = list(dict.fromkeys(names))
        rest = names[3:]
        listed = [("<unk>", 0.0, 2), *((p, -float(i), 1) for i, p in enumerate(rest)), *((p, -100.0 - i, 1) for i, p in enumerate("abc"))]
        pieces = codec.Pieces.build(codec.BPE, listed)
        texts = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 30))) for _ in range(100)]
        ids, first = codec.encode(pieces, *tb.utf8(pa.array(texts)))
        for i, t in enumerate(texts):
            done, _ = codec.merged(pieces.ranks, [c.encode() for c in t])
            assert [listed[j][0].encode() for j in ids[first[i] : first[i + 1]]] == done


def test_viterbi_matches_brute_force():
    rng = random.Random(7)
    listed = [("<unk>", 0.0, 2), *[(p, -rng.random() * 5, 1) for p in ("▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "ca", "▁ab", "aa")]]
    pieces = codec.Pieces.build(codec.UNIGRAM, listed)
    score = {p.replace("▁", " "): (s, i) for i, (p, s, t) in enumerate(listed) if t == 1}
    texts = [" " + "".join(rng.choice("abc d") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    ids, first = codec.encode(pieces, *tb.utf8(pa.array(texts)))
    lost = min(s for s, _ in score.values()) - 10

    def best(t):
        return max(((score.get(t[:k], (lost, 0))[0] + best(t[k:])[0], [score.get(t[:k], (lost, 0))[1], *best(t[k:])[1]]) for k in range(1, len(t) + 1) if t[:k] in score or k == 1), default=(0.0, []))

    worth = lambda own: sum(listed[i][1] if i else lost for i in own)  # noqa: E731  equal sums may be cut either way
    for i, t in enumerate(texts):
        own = ids[first[i] : first[i + 1]].tolist()
        assert abs(worth(own) - best(t)[0]) < 1e-9 and ("d" in t or "".join(listed[j][0] for j in own) == t.replace(" ", "▁"))


def test_line_dedup(spark):
    common, short = "This line is in many documents.", "short"
    texts = [*ODD, f"{common}\n{short}", f" {common.upper()} \nown line number one is here", f"{common}\n{common}", f"x\n{common}", short, short, short]
    got = {r["doc_id"]: r for r in line_dedup(_docs(spark, texts)).filter("doc_id is not null").collect()}
    at = len(ODD)
    assert [(got[i]["n_lines"], got[i]["n_dropped"], got[i]["kept_text"]) for i in range(at, at + 4)] == [(2, 1, short), (2, 1, "own line number one is here"), (2, 2, ""), (2, 0, f"x\n{common}")]
    assert all(got[i]["kept_text"] == (texts[i] or "") for i in [*range(at), at + 4, at + 5, at + 6])
    assert line_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_line_runs_hold_each_key_once(spark):
    rng = random.Random(9)
    runs, held = lines.LineRuns(_shared.Scratch(spark, "test")), {}
    for batch in range(6):
        rows = [(rng.randrange(40) + 30 * batch, k % 3, 10 * doc + batch) for doc in range(5) for k in range(30)]
        for h1, h2, doc in rows:
            held.setdefault((h1, h2), set()).add(doc)
        runs.add(spark.createDataFrame(rows, "h1 long, h2 long, doc_id long"))
    assert len(runs.runs()) == 3 and len(runs.updates) == 5
    stored = [(r["h1"], r["h2"]) for run in runs.runs() for r in run.collect()]
    assert len(stored) == len(set(stored)) == len(held)
    assert sum(u.count() for u in runs.updates) > 0
    assert sorted(map(tuple, runs.keys().collect())) == sorted((*k, len(v), max(v)) for k, v in held.items())
    plan = runs.runs()[0].join(runs.runs()[1].hint("merge"), ["h1", "h2"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    runs.drop()


def test_line_dedup_in_many_batches(spark, monkeypatch):
    rng = random.Random(10)
    texts = ["\n".join(f"this is line number {int(rng.paretovariate(0.7))} of some" for _ in range(6)) for _ in range(300)]
    want = {r["doc_id"]: r["kept_text"] for r in line_dedup(_docs(spark, texts)).filter("doc_id is not null").collect()}
    monkeypatch.setattr(lines, "BATCH_LINES", 200)
    assert {r["doc_id"]: r["kept_text"] for r in line_dedup(_docs(spark, texts)).filter("doc_id is not null").collect()} == want
    held = {}
    for doc, text in enumerate(texts):
        for x in text.split("\n"):
            held.setdefault(x, set()).add(doc)
    assert want == {doc: "\n".join(x for x in text.split("\n") if len(held[x]) < 3 or max(held[x]) == doc) for doc, text in enumerate(texts)}


def test_classifier_slopes_and_held_out(spark):
    rng = random.Random(8)
    good = [_sentences(rng, 200) for _ in range(200)]
    bad = [" ".join(f"{w}***" for w in _sentences(rng, 200).split()) for _ in range(200)]
    x, first = qc.encode_passages(*tb.utf8(pa.array(["", *good[:3], *bad[:3]])))
    model, label = qc.Model.start(x), np.array([1.0, 1, 1, 1, 0, 0, 0])
    loss = lambda: -np.mean(label * np.log(y := model.forward(x, first)["y"]) + (1 - label) * np.log(1 - y))
    slopes = model.slopes(model.forward(x, first), first, label)
    for k, w in model.weights.items():
        i = np.unravel_index(np.abs(slopes[k]).argmax(), w.shape)
        w[i] += 1e-5
        up = loss()
        w[i] -= 2e-5
        assert abs((up - loss()) / 2e-5 - slopes[k][i]) < 1e-4
        w[i] += 1e-5
    rows = [(i, t, int(i < 200)) for i, t in enumerate(good + bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    fitted = qc.fit_quality(qc.draw(docs.drop("label"), docs.filter("doc_id % 3 <> 0").select("doc_id", "label")))
    scored = qc.score_quality(docs, fitted).filter("doc_id % 3 = 0").collect()
    assert np.mean([(r["score"] >= 0.3) == (r["doc_id"] < 200) for r in scored]) >= 0.97
    assert {r["score"] for r in qc.score_quality(docs, qc.fit_quality(docs.filter("false"))).collect()} == {0.5}
    again = docs.union(docs.withColumn("text", F.lit("zzz")))
    drawn = qc.draw(again, docs.select("doc_id", "label").union(docs.select("doc_id", "label")), sample=50).collect()
    assert len(drawn) == 50 and "zzz" not in {r["text"] for r in drawn}
    far = spark.createDataFrame([(" ".join(map(str, range(64 * 1000))), 1), ("x", 0)], "text string, label int").mapInArrow(qc._features, "label int, x binary")
    assert sorted(len(r["x"]) // (4 * qc.N_FEATURES) for r in far.collect()) == [1, 1000]
    assert qc.score_quality(_docs(spark, ODD), fitted).filter("score between 0 and 1").count() == len(ODD) + 2


def test_classifier_in_tasks_is_that_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(qc, "STEPS", 4)
    monkeypatch.setattr(qc, "PARTS", 3)
    rows = spark.createDataFrame([(f"word {i} " * (i + 1), i % 2) for i in range(30)] + [(" ".join(map(str, range(9000))), 1), (None, 0), ("", 1), ("x", None)], "text string, label int")
    here, there = qc.fit_quality(rows), qc.fit_quality(rows, in_memory=0)
    assert np.allclose(here.mean, there.mean) and np.allclose(here.spread, there.spread)
    assert all(np.allclose(here.weights[k], there.weights[k], atol=1e-7) for k in here.weights)
    few = qc.fit_quality(rows.union(rows), sample=7)
    assert all(np.array_equal(few.weights[k], v) for k, v in qc.fit_quality(rows.union(rows).repartition(5), sample=7).weights.items())


def test_clashing_columns_and_ids_of_any_kind(spark):
    said = " ".join(f"word{i}" for i in range(20))
    docs = spark.createDataFrame([(1, said, "a", 5, b"x", [7]), (2, "else", "b", 6, None, None)], "doc_id long, text string, _gone string, _doc long, _hits binary, _items array<long>")
    tests = spark.createDataFrame([("b-2", said), ("a-1", said), (None, said), ("c", None)], "item_id string, text string")
    got = {r["doc_id"]: r for r in dc.decontaminate(docs, tests).collect()}
    assert got[1]["items"] == ["a-1", "b-2"] and got[1]["contaminated"] and got[2]["items"] == []
    assert (got[1]["_hits"], got[1]["_items"], got[1]["_gone"]) == (bytearray(b"x"), [7], "a")
    kept = {r["doc_id"]: r for r in line_dedup(docs).collect()}
    assert (kept[1]["_gone"], kept[1]["_doc"], kept[1]["kept_text"]) == ("a", 5, said) and line_dedup(docs.limit(0)).count() == 0


def test_string_ids_over_several_passes(spark, monkeypatch):
    said = [" ".join(f"w{i}x{j}" for j in range(15)) for i in range(6)]
    docs = spark.createDataFrame([(i, f"{said[i]} {said[(i + 1) % 6]}", "kept") for i in range(6)], "doc_id long, text string, _hits string")
    tests = spark.createDataFrame([(f"item{i}", t) for i, t in enumerate(said)], "item_id string, text string")
    once = {r["doc_id"]: tuple(r) for r in dc.decontaminate(docs, tests).collect()}
    monkeypatch.setattr(dc, "PASS_BYTES", 200)
    assert {r["doc_id"]: tuple(r) for r in dc.decontaminate(docs, tests).collect()} == once and all("kept" in r for r in once.values())


def _archive(plain=False):
    raws = [warc.page_record(str(i), f"http://x/{i}", b"payload %d " % i * 50, warc.digest(b"payload %d " % i * 50), None) for i in range(6)]
    return [r if plain else warc.member(r) for r in raws]


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("harm", ["flip", "cut", "junk"])
def test_salvage(plain, harm):
    parts = _archive(plain)
    middle = len(parts[2]) // 2
    bad = {"flip": parts[2][:middle] + bytes([parts[2][middle] ^ 255]) + parts[2][middle + 1 :], "cut": parts[2][:middle], "junk": parts[2] + b"\x1f\x8b\x08 junk WARC/1.1 \x1f\x8b" * 3}[harm]
    raw = b"".join([*parts[:2], bad, *parts[3:]])
    found = list(warc.salvage(io.BytesIO(raw)))
    ids = [x.fields["warc-record-id"] for x in found if isinstance(x, warc.Record)]
    assert [i for i in ids if i != "<urn:page:2>"] == [f"<urn:page:{i}>" for i in (0, 1, 3, 4, 5)]
    assert ("<urn:page:2>" in ids) == (harm == "junk")
    start = sum(map(len, parts[:2])) + (len(parts[2]) if harm == "junk" else 0)
    gaps = [x for x in found if isinstance(x, warc.Gap)]
    assert gaps[0].at == start and gaps[-1].until == len(raw) - sum(map(len, parts[3:])) and all(g.reason for g in gaps)
    whole = sorted((x.at, x.until) for x in found)
    assert whole[0][0] == 0 and whole[-1][1] == len(raw) and all(a[1] == b[0] for a, b in zip(whole, whole[1:], strict=False))


def test_salvage_of_empty_and_foreign_files():
    assert list(warc.salvage(io.BytesIO(b""))) == []
    assert [type(x) for x in warc.salvage(io.BytesIO(b"nothing here" * 100))] == [warc.Gap]
    both = b"".join(_archive(True))
    assert len(list(warc.salvage(io.BytesIO(gzip.compress(both))))) == 6


def _salvaged(raw):
    found = list(warc.salvage(io.BytesIO(raw)))
    assert found[-1].until == len(raw)
    return [int(x.fields["warc-record-id"][10:-1]) for x in found if isinstance(x, warc.Record)], [x for x in found if isinstance(x, warc.Gap)]


@pytest.mark.parametrize("level", [0, 6])
def test_salvage_of_a_damaged_member_of_several_records(level):
    rng = random.Random(2)
    payloads = [rng.randbytes(3000).hex().encode() for _ in range(60)]
    parts = [warc.page_record(str(i), f"http://x/{i}", p, warc.digest(p), None) for i, p in enumerate(payloads)]
    flipped = [p.replace(payloads[i][:9], b"?" * 9) if i in (20, 21) else p for i, p in enumerate(parts)]
    ids, gaps = _salvaged(gzip.compress(b"".join(flipped), level))
    assert ids == [i for i in range(60) if i not in (20, 21)] and len(gaps) == 1 and "block digest differs" in gaps[0].reason
    whole, other = gzip.compress(b"".join(parts), level), warc.member(warc.page_record("99", None, b"z", warc.digest(b"z"), None))
    cut = len(whole) * 2 // 3
    content = zlib.decompressobj(31).decompress(whole[:cut])
    complete = sum(len(b"".join(parts[: i + 1])) <= len(content) for i in range(60))
    assert 30 < complete < 50
    ids, gaps = _salvaged(whole[:cut])
    assert ids == list(range(complete)) and [g.reason for g in gaps] == ["member is cut off"]
    assert _salvaged(whole[:-8] + bytes(8) + other)[0] == [*range(60), 99]
    bad = bytearray(whole)
    bad[cut] ^= 255
    ids, gaps = _salvaged(bytes(bad) + other)
    assert set(range(complete - 1)) <= set(ids) and ids[-1] == 99 and len(ids) == len(set(ids)) and gaps
    bare = b"".join(p.replace(b"WARC-Block-Digest", b"X-Digest") for p in parts)
    assert len(_salvaged(gzip.compress(bare, level)[:cut])[0]) >= complete - 1
    ids, gaps = _salvaged(gzip.compress(bare, 6)[:-8] + bytes(8) + other)
    assert ids == [99] and len(gaps) == 1


def test_foreign_digests(spark, tmp_path):
    payload = b"foreign payload"
    sha1, sha256 = hashlib.sha1(payload), hashlib.sha256(payload)
    good = [
        f"sha1:{warc.digest(payload).lower()}", f"sha1:{sha1.hexdigest()}", f"SHA-256:{sha256.hexdigest().upper()}", f"sha256:{base64.b32encode(sha256.digest()).decode()}",
        f"sha512:{base64.b64encode(hashlib.sha512(payload).digest()).decode()}", f"md5:{hashlib.md5(payload).hexdigest()}", "blake3:00ff", "sha1:short",
    ]
    bad = [f"sha1:{warc.digest(b'x')}", f"sha256:{hashlib.sha256(b'x').hexdigest()}", f"md5:{hashlib.md5(b'x').hexdigest()}"]
    raws = [warc.page_record(str(i), None, payload, "here", None).replace(b"sha1:here", said.encode()) for i, said in enumerate(good + bad)]
    (tmp_path / "a.warc").write_bytes(b"".join(raws))
    got = warc.read_warc(spark.createDataFrame([(str(tmp_path / "a.warc"),)], "path string")).collect()
    assert [r["record_id"] for r in got if r["kind"] == "response"] == [f"<urn:page:{i}>" for i in range(len(good))]
    assert [r["reason"] for r in got if r["kind"] == "gap"] == ["payload digest differs"] * len(bad)
    block = warc.record("resource", {}, payload)
    for said, kind in ((good[1], warc.Record), (good[2], warc.Record), (good[6], warc.Record), (bad[1], warc.Gap)):
        raw = block.replace(f"sha1:{warc.digest(payload)}".encode(), said.encode())
        assert [type(x) for x in warc.salvage(io.BytesIO(raw))] == [kind]


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a/ü\n", "<p>é</p>", "z"), (2, None, "<p>é</p>", "z"), (3, "u", None, "z"), (4, "u", "", "z"), (None, "u", "<p>é</p>", "z"), (1, "http://a/ü\n", "<p>é</p>", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    files = warc.write_warc(pages, str(tmp_path / "w")).cache()
    got = warc.read_warc(files, str(tmp_path / "w")).filter("kind <> 'warcinfo'").collect()
    shown = sorted((r["record_id"], r["kind"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in got)
    d = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    page = "<p>é</p>".encode()
    assert shown == sorted(
        [("<urn:page:1>", "response", None, len(page), d(page))] * 2
        + [("<urn:page:2>", "revisit", "<urn:page:1>", len(page), d(page)), ("<urn:page:3>", "response", None, 0, d(b"")), ("<urn:page:4>", "revisit", "<urn:page:3>", 0, d(b"")), ("<urn:page:>", "response", None, len(page), d(page))],
        key=lambda r: r,
    )
    empty = warc.write_warc(pages.filter("false"), str(tmp_path / "e"))
    assert warc.read_warc(empty, str(tmp_path / "e")).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, stage(spark, docs, sf_dir).cache()
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
        assert docs.select("doc_id").exceptAll(before.select("doc_id")).count() == 0
        assert i == 4 or docs.filter("n_chars <> length(text)").count() == 0
    assert docs.count() > 0
