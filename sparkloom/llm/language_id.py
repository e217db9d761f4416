"""Language identification by spans.

Words are runs of letters. The script of a word, found by code point ranges, leaves the languages that are written
in it as candidates; each candidate has a log-likelihood of the word by hashed n-grams, and a Viterbi recursion over the words,
in which going over to another language costs PENALTY, labels spans. Counts of n-grams and of letters by script are
gathered from all training texts: in tasks, once for each distinct word of a slice, then summed by blocks of the table.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import _bytes as tb
from ._frames import passed
from ._shared import shipped

#: Sizes of n-grams, with a mark at either end of a word; hash buckets of them; buckets in a row of counts.
SIZES, BUCKETS, CHUNK = (2, 3, 4), 1 << 17, 1 << 12
SLICE = 1 << 22
#: What going over to another language costs, in nats; what an n-gram counts for that was never seen.
PENALTY, UNSEEN = 12.0, 0.5
#: A language is a candidate for the scripts that hold this share of its letters.
LEAST_SHARE = 0.01
#: Languages that a model may have.
MOST_LANGUAGES = 4096
#: Scripts and their main code point ranges (fixed values, after the Unicode block list).
SCRIPT_RANGES = [
    ("Latin", 0x0041, 0x024F), ("Latin", 0x1E00, 0x1EFF), ("Latin", 0x2C60, 0x2C7F), ("Latin", 0xA720, 0xA7FF), ("Latin", 0xFF21, 0xFF5A),
    ("Greek", 0x0370, 0x03FF), ("Greek", 0x1F00, 0x1FFF), ("Cyrillic", 0x0400, 0x052F), ("Cyrillic", 0x1C80, 0x1C8F),
    ("Cyrillic", 0x2DE0, 0x2DFF), ("Armenian", 0x0530, 0x058F), ("Hebrew", 0x0590, 0x05FF), ("Arabic", 0x0600, 0x06FF),
    ("Arabic", 0x0750, 0x077F), ("Arabic", 0x08A0, 0x08FF), ("Arabic", 0xFB50, 0xFDFF), ("Arabic", 0xFE70, 0xFEFF),
    ("Devanagari", 0x0900, 0x097F), ("Bengali", 0x0980, 0x09FF), ("Gurmukhi", 0x0A00, 0x0A7F), ("Gujarati", 0x0A80, 0x0AFF),
    ("Tamil", 0x0B80, 0x0BFF), ("Telugu", 0x0C00, 0x0C7F), ("Kannada", 0x0C80, 0x0CFF), ("Malayalam", 0x0D00, 0x0D7F),
    ("Sinhala", 0x0D80, 0x0DFF), ("Thai", 0x0E00, 0x0E7F), ("Lao", 0x0E80, 0x0EFF), ("Tibetan", 0x0F00, 0x0FFF),
    ("Myanmar", 0x1000, 0x109F), ("Georgian", 0x10A0, 0x10FF), ("Hangul", 0x1100, 0x11FF), ("Hangul", 0x3130, 0x318F),
    ("Hangul", 0xAC00, 0xD7AF), ("Ethiopic", 0x1200, 0x137F), ("Khmer", 0x1780, 0x17FF), ("Mongolian", 0x1800, 0x18AF),
    ("Kana", 0x3040, 0x30FF), ("Kana", 0x31F0, 0x31FF), ("Han", 0x3400, 0x4DBF), ("Han", 0x4E00, 0x9FFF), ("Han", 0xF900, 0xFAFF), ("Han", 0x20000, 0x323AF),
]
SCRIPTS = ["other", *dict.fromkeys(name for name, _, _ in SCRIPT_RANGES)]
SPANS = T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType())]))
MADE = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", SPANS)])
_COUNTS = T.StructType([T.StructField("lang", T.IntegerType()), T.StructField("chunk", T.IntegerType()), T.StructField("counts", T.ArrayType(T.LongType(), False))])
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


@functools.cache
def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """By code point: 1 for a letter, 2 for a mark that goes on a word, else 0; and the script."""
    kind = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        c = unicodedata.category(chr(i))[0]
        if c in "LM":
            kind[i] = 1 if c == "L" else 2
    script = np.zeros(0x110000, np.uint8)
    for name, lo, hi in SCRIPT_RANGES:
        script[lo : hi + 1] = SCRIPTS.index(name)
    return kind, script


def _points(buf: np.ndarray) -> np.ndarray:
    return np.frombuffer(buf.tobytes().decode().encode("utf-32-le"), np.uint32)


@dataclass
class Words:
    """The words of a slice of texts: which distinct word each is, the code points where it begins and ends in its text, its
    letters, and each text's first word; and the distinct words' n-grams: bucket and word of each, and the words' scripts."""

    which: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    letters: np.ndarray
    first: np.ndarray
    buckets: np.ndarray
    of: np.ndarray
    scripts: np.ndarray
    n_distinct: int


def split_words(buf: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of lower-cased texts in UTF-8."""
    kind, script = _kinds()
    points = _points(buf)
    starts = np.flatnonzero((buf & 0xC0) != 0x80)
    char_at = np.searchsorted(starts, offsets)
    kinds = kind[points]
    inside = kinds > 0
    before = np.zeros(len(points) + 1, bool)
    before[1:] = inside
    before[char_at] = False  # a word never goes over the end of a text
    after = np.zeros(len(points) + 1, bool)
    after[:-1] = inside
    after[char_at] = False
    begins = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    first = np.searchsorted(begins, char_at)
    letters = np.concatenate([[0], np.cumsum(kinds == 1)])
    sizes = np.diff(np.append(starts, len(buf)))[inside]
    at = np.concatenate([[0], np.cumsum(sizes)])
    members = np.repeat(inside, np.diff(np.append(starts, len(buf))))
    bounds = np.concatenate([[0], np.cumsum(ends - begins)])
    words = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(at[bounds].astype(np.int64)), pa.py_buffer(np.ascontiguousarray(buf[members])))
    coded = words.dictionary_encode()
    distinct, d_at = tb.utf8(coded.dictionary)
    n = len(d_at) - 1
    buckets, of, scripts = _grams(_points(distinct), np.searchsorted(np.flatnonzero((distinct & 0xC0) != 0x80), d_at), kind, script)
    text_of = np.repeat(char_at[:-1], np.diff(first))
    return Words(coded.indices.to_numpy().astype(np.int64), begins - text_of, ends - text_of, letters[ends] - letters[begins], first, buckets, of, scripts, n)


def _grams(points: np.ndarray, at: np.ndarray, kind: np.ndarray, script: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the words that begin at ``at``, the word of each, and the script of each word's first letter."""
    n = len(at) - 1
    line = np.zeros(len(points) + n + 1, np.uint64)  # words with a mark, 0, before, between and behind them
    place = np.arange(len(points)) + np.repeat(np.arange(1, n + 1), np.diff(at))
    line[place] = points
    mark = line == 0
    word = np.cumsum(mark) - 1
    buckets, of = [], []
    for size in SIZES:
        m = len(line) - size + 1
        if m <= 0:
            continue
        h = np.full(m, size, np.uint64)
        fits = np.ones(m, bool)
        for j in range(size):
            h = (h ^ line[j : j + m]) * _MIX[j % len(_MIX)]
            h ^= h >> np.uint64(29)
            if 0 < j < size - 1:
                fits &= ~mark[j : j + m]
        buckets.append((tb.splitmix(h[fits]) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64))
        of.append(word[:m][fits])
    scripts = script[points[at[:-1]]] if n else np.empty(0, np.uint8)
    return np.concatenate(buckets or [np.empty(0, np.int64)]), np.concatenate(of or [np.empty(0, np.int64)]), scripts


@dataclass
class LanguageModel:
    """Languages in order, log-likelihoods of buckets by language, and whether a script leaves a language as candidate."""

    langs: list[str]
    log: np.ndarray
    candidate: np.ndarray

    @classmethod
    def build(cls, langs: list[str], counts: np.ndarray) -> LanguageModel:
        """From counts by language: of the buckets, then of letters by script."""
        grams, letters = counts[:, :BUCKETS].astype(float), counts[:, BUCKETS : BUCKETS + len(SCRIPTS)]
        log = np.log((grams + UNSEEN) / (grams.sum(axis=1, keepdims=True) + UNSEEN * BUCKETS)) / len(SIZES)
        candidate = (letters >= LEAST_SHARE * letters.sum(axis=1, keepdims=True)) & (letters > 0)
        candidate[:, ~candidate.any(axis=0)] = True  # a script that no language is written in tells nothing
        return cls(langs, np.ascontiguousarray(log.T.astype(np.float32)), np.ascontiguousarray(candidate.T))

    def scores(self, words: Words) -> np.ndarray:
        """Log-likelihood of each distinct word by language; -inf where its script rules the language out."""
        out = np.empty((words.n_distinct, len(self.langs)))
        for j in range(len(self.langs)):
            out[:, j] = np.bincount(words.of, weights=self.log[words.buckets, j], minlength=words.n_distinct)
        out[~self.candidate[words.scripts]] = -np.inf
        return out


def label(scores: np.ndarray, which: np.ndarray, first: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The language of each word on the best path through its text. Texts advance together, the longest first; of equal
    paths the one that stays, and then the language that comes first."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    base, sizes = first[:-1][order], sizes[order]
    n, width = int((sizes > 0).sum()), scores.shape[1]
    out = np.zeros(len(which), np.int64)
    if not n:
        return out
    stay, come = np.ones((len(which), width), bool), np.zeros(len(which), np.int32)
    active = np.searchsorted(-sizes[:n], -np.arange(int(sizes[0])), side="left")  # texts with more words than t
    best = scores[which[base[:n]]].copy()
    end = np.empty(n, np.int64)
    for t in range(1, int(sizes[0])):
        k = int(active[t])
        end[k : int(active[t - 1])] = best[k : int(active[t - 1])].argmax(axis=1)
        at = base[:k] + t
        prior = best[:k]
        top = prior.argmax(axis=1)
        over = prior[np.arange(k), top] - penalty
        stays = prior >= over[:, None]
        stay[at], come[at] = stays, top
        best = np.where(stays, prior, over[:, None]) + scores[which[at]]
    k = int(active[-1])
    end[:k] = best[:k].argmax(axis=1)
    out[base[:n] + sizes[:n] - 1] = end
    for t in range(int(sizes[0]) - 1, 0, -1):
        at = base[: int(active[t])] + t
        out[at - 1] = np.where(stay[at, out[at]], out[at], come[at])
    return out


def _lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))


def _count(langs: list[str]):
    place = {x: i for i, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(langs), BUCKETS + CHUNK), np.int64)
        for batch in batches:
            lang = np.array([place.get(x, -1) for x in batch.column("lang").to_pylist()], np.int64)
            buf, offsets = tb.utf8(_lowered(batch.column("text")))
            for lo, hi, part, own in tb.slices(buf, offsets, SLICE):
                words = split_words(part, own)
                by = np.repeat(lang[lo:hi], np.diff(words.first))
                for j in np.unique(by[by >= 0]).tolist():
                    times = np.bincount(words.which[by == j], minlength=words.n_distinct)
                    used = times[words.of]
                    counts[j, :BUCKETS] += np.bincount(words.buckets, weights=used, minlength=BUCKETS).astype(np.int64)
                    counts[j, BUCKETS : BUCKETS + len(SCRIPTS)] += np.bincount(
                        words.scripts[words.which[by == j]], weights=words.letters[by == j], minlength=len(SCRIPTS)
                    ).astype(np.int64)
        yield _chunks({(j, c): counts[j, c * CHUNK : (c + 1) * CHUNK] for j in range(len(langs)) for c in range(counts.shape[1] // CHUNK)})

    return run


def _chunks(sums: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
    full = [(k, v) for k, v in sums.items() if v.any()]
    schema = pa.schema([("lang", pa.int32()), ("chunk", pa.int32()), ("counts", pa.list_(pa.int64()))])
    return pa.RecordBatch.from_arrays([pa.array([k[i] for k, _ in full], pa.int32()) for i in (0, 1)] + [pa.array([v for _, v in full], pa.list_(pa.int64()))], schema=schema)


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        values = batch.column("counts").flatten().to_numpy().reshape(-1, CHUNK)
        for k, v in zip(zip(batch.column("lang").to_pylist(), batch.column("chunk").to_pylist(), strict=True), values, strict=True):
            sums[k] = sums[k] + v if k in sums else v.copy()
    yield _chunks(sums)


def fit_languages(rows: DataFrame) -> LanguageModel:
    """From all ``rows`` (text, lang). Those without a lang teach nothing, null and empty texts hold no word, repeated rows count
    each time; without rows the model has no language. Equal tables give equal models, however they are partitioned.

    Each task sends the table of counts that it has gathered, in blocks; blocks are summed by key, and the sums, whose
    size is that of the table (languages times BUCKETS), go to the driver.
    """
    rows = rows.filter("lang is not null").select("text", "lang")
    langs = [r["lang"] for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()]
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    langs = sorted(langs)
    counts = np.zeros((len(langs), BUCKETS + CHUNK), np.int64)
    if langs:
        for r in rows.mapInArrow(_count(langs), _COUNTS).repartition("lang", "chunk").mapInArrow(_sum, _COUNTS).collect():
            counts[r["lang"], r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = r["counts"]
    return LanguageModel.build(langs, counts)


def _identify(model: LanguageModel, words: Words, n: int, with_spans: bool) -> list[pa.Array]:
    width = len(model.langs)
    text = np.repeat(np.arange(n), np.diff(words.first))
    total = np.bincount(text, weights=words.letters, minlength=n)
    if not width or not len(words.which):
        return [pa.array(["und"] * n), pa.array(np.zeros(n)), pa.array([[]] * n, _ARROW_SPANS)]
    scores = model.scores(words)
    lang = label(scores, words.which, words.first)
    held = np.bincount(text * width + lang, weights=words.letters, minlength=n * width).reshape(n, width)
    best = held.argmax(axis=1)
    # Of the words in spans of that language: how likely they are in it, and in the others.
    own = lang == best[text]
    known = np.isfinite(scores)
    flat = np.where(known, scores, np.where(known, scores, 0).min(axis=1, keepdims=True) - 1e3)[words.which[own]]
    likely = np.stack([np.bincount(text[own], weights=flat[:, j], minlength=n) for j in range(width)], axis=1)
    share = held[np.arange(n), best] / np.maximum(total, 1)
    odds = np.exp(np.minimum(likely - likely[np.arange(n), best][:, None], 50)).sum(axis=1)
    named = np.where(total > 0, np.array(model.langs, object)[best], "und")
    out = [pa.array(named.tolist(), pa.string()), pa.array(np.where(total > 0, share / odds, 0.0))]
    new = np.ones(len(lang), bool)
    new[1:] = (lang[1:] != lang[:-1]) | (text[1:] != text[:-1])
    heads = np.flatnonzero(new) if with_spans else np.empty(0, np.int64)
    last = np.append(heads[1:], len(lang))[: len(heads)] - 1
    spans = pa.StructArray.from_arrays(
        [pa.array(words.begins[heads].astype(np.int32)), pa.array(words.ends[last].astype(np.int32)), pa.array(model.langs, pa.string()).take(pa.array(lang[heads]))],
        fields=list(_ARROW_SPANS.value_type),
    )
    return [*out, pa.ListArray.from_arrays(pa.array(np.searchsorted(heads, words.first).astype(np.int32)), spans).cast(_ARROW_SPANS)]


_ARROW_SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))


def identify_languages(docs: DataFrame, model: LanguageModel, columns: list[str] | None = None, with_spans: bool = True) -> DataFrame:
    """``lang_pred``, ``score`` and ``spans`` (begin and end in code points, lang) for every row of ``docs`` (text, and what else is
    passed through); a passed column named like a made one is replaced.

    ``lang_pred`` is the language whose spans hold the most letters, of equal ones the first in order. ``score`` is their share of
    the letters, times how likely their words are in it against all languages. Null texts, texts without a letter, and
    all texts where the model knows no language are 'und', at 0 and without spans; ``with_spans=False`` leaves
    spans empty. Texts of any length are labelled whole. Rows are taken one by one: repeats and empty tables give what
    stands to reason.
    """
    kept, schema = passed(docs, columns, MADE)
    shared = shipped(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = tb.utf8(_lowered(batch.column("text")))
            for lo, hi, part, own in tb.slices(buf, offsets, SLICE):
                made = _identify(shared(), split_words(part, own), hi - lo, with_spans)
                rows = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([rows.column(c) for c in kept] + made, names=kept + MADE.names)

    return docs.select(*dict.fromkeys([*kept, "text"])).mapInArrow(run, schema)
