"""Quality rules, lines first: lines that fail a rule go, then documents that lost too much text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import _bytes as tb
from ._frames import passed

SYMBOLS = b"#*$%&|<>"
#: A document goes when its failed lines hold more than this share of its words' code points.
MOST_LOST_PERCENT = 30
#: Marks that end or part sentences, in Latin and other scripts; shouted ones; what parts the items of a menu.
STOPS = ".,;:!?" + "。！？；，：、．…।॥؟؛،۔։՞՜་།፡።፣、។៕၊။"
SHOUTS = "!?！？"
SEPARATORS = "|›»·•▸→"
#: Phrases of boilerplate lines, for lines of at most BOILERPLATE_WORDS words, with A-Z lower-cased.
BOILERPLATE_WORDS = 25
BOILERPLATE = (
    "all rights reserved", "accept cookies", "accept all cookies", "cookie policy", "cookie settings", "uses cookies", "privacy policy", "terms of use", "terms of service",
    "terms and conditions", "javascript is disabled", "enable javascript", "lorem ipsum", "skip to content", "skip to main content", "click here to subscribe", "sign up for our newsletter",
    "alle rechte vorbehalten", "cookies akzeptieren", "verwendet cookies", "datenschutzerklärung", "allgemeine geschäftsbedingungen", "zum inhalt springen", "newsletter abonnieren",
    "tous droits réservés", "accepter les cookies", "utilise des cookies", "politique de confidentialité", "mentions légales", "conditions générales", "aller au contenu",
    "todos los derechos reservados", "aceptar cookies", "utiliza cookies", "política de privacidad", "política de cookies", "aviso legal", "términos y condiciones", "ir al contenido",
)

MADE = T.StructType(
    [
        *(T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars", "n_failed_lines")),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("clean_text", T.StringType()),
    ]
)


def _is(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


_SYMBOL = _is(SYMBOLS)


def _count(buf: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Running count of a byte class."""
    out = np.zeros(len(buf) + 1, dtype=np.int64)
    np.cumsum(table[buf], out=out[1:])
    return out


class _Marks:
    """A set of characters, found by their UTF-8 bytes."""

    def __init__(self, chars: str):
        self.ascii = _is(bytes(ord(c) for c in chars if c.isascii()))
        self.lead = _is(bytes({c.encode()[0] for c in chars if not c.isascii()}))
        self.codes = np.array(sorted(int.from_bytes(c.encode().ljust(3, b"\0"), "big") for c in chars if not c.isascii()))

    def running(self, buf: np.ndarray) -> np.ndarray:
        """Running count before each byte, with the total at the end."""
        seen = self.ascii[buf]
        at = np.flatnonzero(self.lead[buf])
        if len(at):
            padded = np.append(buf, np.zeros(2, np.uint8)).astype(np.int64)
            third = np.where(buf[at] < 0xE0, 0, padded[at + 2])
            seen[at] = np.isin((padded[at] << 16) | (padded[at + 1] << 8) | third, self.codes)
        out = np.zeros(len(buf) + 1, dtype=np.int64)
        np.cumsum(seen, out=out[1:])
        return out


_STOP, _SHOUT, _SEPARATOR = _Marks(STOPS), _Marks(SHOUTS), _Marks(SEPARATORS)


def _equal_earlier(groups: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which (group, hash) pairs occur more than once."""
    keys = tb.splitmix(hashes + tb.splitmix(groups.astype(np.uint64) + np.uint64(1)))
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), dtype=bool)
    return twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys


def measure(buf: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Figures of each text, the lines' starts and ends, and which lines fail; a text has a line more than newlines."""
    n = len(offsets) - 1
    starts, ends, first = tb.spans(buf, offsets, tb.NOT_SPACE)
    sums, down = tb.prefix_sums(buf)
    points = tb.code_points(buf)
    words_before = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(points[ends] - points[starts], out=words_before[1:])

    windows = tb.chain(tb.ranged(sums, down, starts, ends), 3)
    text_of = np.repeat(np.arange(n), np.diff(first))
    whole = np.flatnonzero(text_of[:-2] == text_of[2:]) if len(text_of) > 2 else np.empty(0, np.int64)
    again = np.zeros(len(starts) + 2, dtype=bool)
    if len(whole):
        again[whole] = _equal_earlier(text_of[whole], windows[whole])
    covered = again[: len(starts)].copy()
    covered[1:] |= again[: max(len(starts) - 1, 0)]
    covered[2:] |= again[: max(len(starts) - 2, 0)]
    repeated = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(covered, out=repeated[1:])

    breaks = np.flatnonzero(buf == 10)
    line_starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    # A newline that ends a text begins an empty line of it, not of the next text: ends tell the two apart.
    line_ends = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
    line_text = np.repeat(np.arange(n), np.diff(np.searchsorted(breaks, offsets)) + 1)
    a, b = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    n_words = b - a
    chars = words_before[b] - words_before[a]
    within = lambda marks: (lambda c: c[line_ends] - c[line_starts])(marks.running(buf))
    slashes = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum((ends - starts == 1) & (buf[starts] == 47), out=slashes[1:])
    parts, shouts = within(_SEPARATOR) + slashes[b] - slashes[a], within(_SHOUT)
    symbols = _count(buf, _SYMBOL)
    failed = (n_words >= 10) & (within(_STOP) == 0)
    failed |= (n_words >= 3) & (shouts > n_words)
    failed |= 10 * (symbols[line_ends] - symbols[line_starts]) > chars
    failed |= (parts >= 3) & (4 * parts >= n_words)
    low = tb.LOWER[buf].tobytes()
    for phrase in BOILERPLATE:
        wanted, at = phrase.encode(), low.find(phrase.encode())
        while at >= 0:
            line = int(np.searchsorted(line_starts, at, side="right")) - 1
            if at + len(wanted) <= line_ends[line] and n_words[line] <= BOILERPLATE_WORDS:
                failed[line] = True
            at = low.find(wanted, at + 1)
    failed &= n_words > 0

    worded = np.flatnonzero(n_words > 0)
    hashes = tb.ranged(sums, down, line_starts[worded], line_ends[worded]) + (line_ends - line_starts)[worded].astype(np.uint64)
    keys = tb.splitmix(hashes + tb.splitmix(line_text[worded].astype(np.uint64) + np.uint64(1)))
    _, kinds_at = np.unique(keys, return_index=True)
    distinct = np.bincount(line_text[worded][kinds_at], minlength=n)
    by_line = lambda x: np.bincount(line_text, weights=x, minlength=n).astype(np.int64)
    figures = {
        "n_words": np.diff(first),
        "word_chars": words_before[first[1:]] - words_before[first[:-1]],
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": np.bincount(line_text[worded], minlength=n) - distinct,
        "n_repeat_words": repeated[first[1:]] - repeated[first[:-1]],
        "lost_chars": by_line(np.where(failed, chars, 0)),
        "n_failed_lines": by_line(failed),
    }
    return figures, line_starts, line_ends, failed


def _run(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = tb.utf8(batch.column("text"))
            for lo, hi, part, own in tb.slices(buf, offsets):
                figures, starts, ends, failed = measure(part, own)
                base = (figures["n_words"] < 50) | (100 * figures["n_repeat_words"] > 50 * figures["n_words"])
                kept = ~base & (100 * figures["lost_chars"] <= MOST_LOST_PERCENT * figures["word_chars"])
                raw, clean = part.tobytes(), []
                first = np.searchsorted(np.flatnonzero(part == 10), own) + np.arange(hi - lo + 1)
                for i, bad in enumerate(figures["n_failed_lines"].tolist()):
                    if bad:
                        lines = range(first[i], first[i + 1])
                        clean.append(b"\n".join(raw[starts[j] : ends[j]] for j in lines if not failed[j]).decode())
                    else:
                        clean.append(raw[own[i] : own[i + 1]].decode())
                made = [pa.array(figures[f.name]) if f.name in figures else None for f in MADE.fields[:-3]]
                made += [pa.array(base), pa.array(kept), pa.array(clean, pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(lo, hi - lo) for c in columns] + made, names=columns + MADE.names)

    return run


def quality_rules(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Figures, verdict and cleaned text of every row of ``docs`` (text, and what else is passed through).

    Words are ``[^\\x20\\x09-\\x0D]+``. A line with a word fails when it has ten words and none of STOPS, or
    more of SHOUTS than words (three words or more), or symbols ``[#*$%&|<>]`` over a tenth of its words' code
    points (all: punctuation), or three of SEPARATORS or lone slashes for at most four words each (navigation),
    or is short and holds a phrase of BOILERPLATE. ``clean_text`` is the text without failed lines. ``kept`` is false for
    base failures (under 50 words, or over half of the words in repeated 3-word windows) and for texts
    whose failed lines hold over MOST_LOST_PERCENT of the words' code points.

    A null or empty text has no word: it fails the base and its clean text is empty. Rows are judged one
    by one, so repeated rows and null ids are no matter; a table without rows gives none. A passed column named like a made one is replaced.
    """
    kept, schema = passed(docs, columns, MADE)
    return docs.select(*dict.fromkeys([*kept, "text"])).mapInArrow(_run(kept), schema)
