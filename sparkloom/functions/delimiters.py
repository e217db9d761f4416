"""Delimited stretches of whole batches at once.

Each delimiter in an Arrow buffer is a step up or down. Sums within a text, kept from falling below zero by the least sum so far,
give the depth behind each delimiter; a stretch goes from where it leaves zero to where it comes back. Texts are
put together from the pieces between stretches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _places(buf: np.ndarray, mark: bytes) -> np.ndarray:
    """Where a character stands in UTF-8."""
    found = np.flatnonzero(buf == mark[0])
    for i, byte in enumerate(mark[1:], 1):
        found = found[found + i < len(buf)]
        found = found[buf[found + i] == byte]
    return found


@dataclass(frozen=True)
class Strip:
    """Outermost balanced stretches from ``left`` to ``right`` replaced by ``by``, with their delimiters unless kept.

    A closing delimiter without an opening one stays. For an opening one that never closes, ``unclosed`` is
    ``keep`` (it stays) or ``reference``: what stands between the last stretch and it comes out twice. Nulls stay null.
    """

    left: str
    right: str
    by: str = ""
    keep: bool = False
    unclosed: str = "reference"

    def __call__(self, texts: pa.Array) -> pa.Array:
        texts = texts.cast(pa.large_string())
        n = len(texts)
        if not n or texts.buffers()[2] is None:
            return texts.cast(pa.string())
        left, right = self.left.encode(), self.right.encode()
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        base = int(offsets[0])
        data = texts.buffers()[2]
        buf, offsets = np.frombuffer(data, np.uint8)[base : int(offsets[-1])], offsets - base
        ups, downs = _places(buf, left), _places(buf, right)
        at = np.concatenate([ups, downs])
        order = np.argsort(at, kind="stable")
        at, step = at[order], np.repeat([1, -1], [len(ups), len(downs)])[order]
        text = np.searchsorted(offsets, at, side="right") - 1
        depth = self._depths(step, text)
        opens, closes = (step > 0) & (depth == 1), (step < 0) & (depth == 0) & self._was_open(depth, text)
        begin, stop = at[opens], at[closes] + len(right)
        of_open, of_close = text[opens], text[closes]
        # Openings and closings of stretches take turns; an opening without a closing is the last of its text.
        last_open = np.ones(len(begin), bool)
        last_open[:-1] = of_open[1:] != of_open[:-1]
        lost = last_open & (np.bincount(of_open, minlength=n) > np.bincount(of_close, minlength=n))[of_open] if len(begin) else last_open
        spans = dict.fromkeys(of_open.tolist())
        source, by = memoryview(buf), (left + self.by.encode() + right if self.keep else self.by.encode())
        out, sizes, done = [], np.diff(offsets).copy(), 0
        begins, stops, unmet = begin.tolist(), iter(stop.tolist()), lost.tolist()
        first = np.searchsorted(of_open, np.arange(n + 1)).tolist()
        for i in spans:
            lo, hi = int(offsets[i]), int(offsets[i + 1])
            out.append(source[done:lo])
            size, here = 0, lo
            for k in range(first[i], first[i + 1]):
                if unmet[k]:
                    if self.unclosed == "reference":
                        again = source[here : begins[k] + (len(left) if self.keep else 0)]
                        out.append(again)
                        size += len(again)
                    break
                out += [source[here : begins[k]], by]
                size += begins[k] - here + len(by)
                here = next(stops)
            out.append(source[here:hi])
            sizes[i] = size + hi - here
            done = hi
        out.append(source[done:])
        raw = b"".join(out)
        valid = texts.is_valid() if texts.null_count else None
        made = pa.LargeStringArray.from_buffers(n, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)), pa.py_buffer(raw))
        made = made if valid is None else pc.if_else(valid, made, pa.scalar(None, made.type))
        return made.cast(pa.string())

    @staticmethod
    def _depths(step: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Depth behind each delimiter; one that closes nothing leaves it at zero."""
        sums = np.cumsum(step)
        heads = np.flatnonzero(np.diff(text, prepend=-1))
        sums = sums - np.repeat(sums[heads] - step[heads], np.diff(np.append(heads, len(step))))
        # A slope from text to text keeps the least sum of one from reaching into the next.
        fall = (2 * len(step) + 2) * text
        return sums - (np.minimum.accumulate(np.minimum(sums, 0) - fall) + fall)

    @staticmethod
    def _was_open(depth: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Whether the delimiter before, in the same text, left a depth above zero."""
        out = np.zeros(len(depth), bool)
        out[1:] = (depth[:-1] > 0) & (text[1:] == text[:-1])
        return out
