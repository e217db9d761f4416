"""Quality by attention-based multiple-instance learning.

A text is a bag of passages. Every passage is encoded by one tanh layer over its surface and hashed word
features; a gated attention, learned from the labels of whole texts, weights the codes; the weighted
code is scored by a logistic unit. All weights are fitted together by Adam on a bounded sample of
labelled texts (SAMPLE, drawn by hash), each with every passage. Where their features are over IN_MEMORY bytes, tasks sum
moments and slopes over the texts that they hold, and the driver gets sums alone; scoring takes every passage of every text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _bytes as tb
from ._frames import passed
from ._shared import Scratch, shipped

#: Labelled texts that the model is fitted on, at most; bytes of their features that are fitted on the driver; else partitions.
SAMPLE, IN_MEMORY, PARTS = 2000, 64 << 20, 64
PASSAGE = 64
HASHED, CODE, GATE = 64, 24, 16
STEPS, RATE, DECAY = 200, 0.02, 1e-4
MADE = T.StructType([T.StructField("score", T.DoubleType())])


def _class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


_ABC = bytes(range(65, 91))
_CLASSES = [_class(x) for x in (_ABC, _ABC.lower(), b"0123456789", b".,;:", b"!?", b"#*$%&<>", b"|", b"\n", b"'\"()[]{}-/\\@_", bytes(range(128, 256)))]
N_FEATURES = len(_CLASSES) + 4 + HASHED


def encode_passages(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of each text, one after another, and where each text's begin.

    A text without words has one passage of zeros.
    """
    n = len(offsets) - 1
    low = tb.LOWER[buf]
    starts, ends, first = tb.spans(buf, offsets, tb.NOT_SPACE)
    n_words = np.diff(first)
    per = np.maximum(1, -(-n_words // PASSAGE))
    begin = np.concatenate([[0], np.cumsum(per)])
    text = np.repeat(np.arange(n), per)
    place = np.arange(begin[-1]) - np.repeat(begin[:-1], per)
    a = np.minimum(first[text] + place * PASSAGE, first[text + 1])
    b = np.minimum(a + PASSAGE, first[text + 1])
    some = b > a
    x = np.zeros((len(a), N_FEATURES), dtype=np.float32)
    if not some.any():
        return x, begin
    a, b = a[some], b[some]
    lo, hi = starts[a], ends[b - 1]
    size, count = (hi - lo).astype(np.float32), (b - a).astype(np.float32)
    own = np.zeros((len(a), N_FEATURES), dtype=np.float32)
    for j, table in enumerate(_CLASSES):
        seen = np.zeros(len(buf) + 1, dtype=np.int32)
        np.cumsum(table[buf], out=seen[1:])
        own[:, j] = (seen[hi] - seen[lo]) / size
    words = tb.range_hashes(low, starts, ends)
    passage = np.repeat(np.arange(len(a)), b - a)
    same = np.zeros(len(words), dtype=np.float32)
    same[1:] = words[1:] == words[:-1]
    same[a] = 0
    at = len(_CLASSES)
    own[:, at] = np.bincount(passage, weights=same, minlength=len(a)) / count
    own[:, at + 1] = size / count / 10
    own[:, at + 2] = count / PASSAGE
    order = np.lexsort((words, passage))
    fresh = np.ones(len(words), dtype=bool)
    fresh[1:] = (words[order][1:] != words[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    own[:, at + 3] = np.bincount(passage[order][fresh], minlength=len(a)) / count
    cells = np.bincount(passage * HASHED + (words >> np.uint64(58)).astype(np.int64), minlength=len(a) * HASHED)
    own[:, at + 4 :] = cells.reshape(-1, HASHED) / count[:, None]
    x[some] = own
    return x, begin


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]

    @classmethod
    def start(cls, x: np.ndarray) -> Model:
        return cls.around(x.mean(axis=0), x.std(axis=0))

    @classmethod
    def around(cls, mean: np.ndarray, spread: np.ndarray) -> Model:
        rng = np.random.default_rng(7)
        draw = lambda a, b: (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float64)
        weights = {"W": draw(N_FEATURES, CODE), "b": np.zeros(CODE), "V": draw(CODE, GATE), "U": draw(CODE, GATE), "w": np.zeros(GATE), "c": np.zeros(CODE), "d": np.zeros(1)}
        weights["w"] += rng.standard_normal(GATE) * 0.1
        weights["c"] += rng.standard_normal(CODE) * 0.1
        return cls(mean, spread + 1e-3, weights)

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p = self.weights
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        h = np.tanh(z @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        sizes = np.diff(first)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first[:-1]), sizes))
        a = e / np.repeat(np.add.reduceat(e, first[:-1]), sizes)
        m = np.add.reduceat(a[:, None] * h, first[:-1], axis=0)
        return {"z": z, "h": h, "t": t, "s": s, "a": a, "m": m, "y": 1 / (1 + np.exp(-(m @ p["c"] + p["d"][0])))}

    def slopes(self, f: dict[str, np.ndarray], first: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        p, sizes = self.weights, np.diff(first)
        dy = (f["y"] - label) / len(label)
        dm = np.repeat(dy[:, None] * p["c"], sizes, axis=0)
        dh = f["a"][:, None] * dm
        gain = (dm * f["h"]).sum(axis=1)
        de = f["a"] * (gain - np.repeat(np.add.reduceat(f["a"] * gain, first[:-1]), sizes))
        dt, ds = de[:, None] * p["w"] * f["s"] * (1 - f["t"] ** 2), de[:, None] * p["w"] * f["t"] * f["s"] * (1 - f["s"])
        dh = (dh + dt @ p["V"].T + ds @ p["U"].T) * (1 - f["h"] ** 2)
        return {"W": f["z"].T @ dh, "b": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ ds, "w": (f["t"] * f["s"]).T @ de, "c": f["m"].T @ dy, "d": np.array([dy.sum()])}

    def fit(self, slopes_of: Callable[[Model], dict[str, np.ndarray]]) -> Model:
        """Adam; ``slopes_of`` gives the slopes at a model's weights over all texts."""
        one = {k: np.zeros_like(v) for k, v in self.weights.items()}
        two = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, STEPS + 1):
            for k, g in slopes_of(self).items():
                g = g + DECAY * self.weights[k]
                one[k] = 0.9 * one[k] + 0.1 * g
                two[k] = 0.999 * two[k] + 0.001 * g * g
                self.weights[k] -= RATE * (one[k] / (1 - 0.9**step)) / (np.sqrt(two[k] / (1 - 0.999**step)) + 1e-8)
        return self


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of all passages of each text, one after another."""
    for batch in batches:
        buf, offsets = tb.utf8(batch.column("text"))
        for lo, hi, part, own in tb.slices(buf, offsets):
            x, first = encode_passages(part, own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").slice(lo, hi - lo), pa.array([x[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())], names=["label", "x"]
            )


def _bags(features: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    bags = [np.frombuffer(x, np.float32).reshape(-1, N_FEATURES) for x in features]
    return np.concatenate(bags).astype(np.float64), np.cumsum([0, *map(len, bags)])


def _summed(rows: DataFrame, of: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``of`` (features, first passages, labels) over all texts, a text at a time in tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x, label in zip(batch.column("x").to_pylist(), batch.column("label").to_pylist(), strict=True):
                own = of(*_bags([x]), np.array([label], float))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return np.sum([np.frombuffer(r[0]) for r in rows.mapInArrow(run, "sums binary").collect()], axis=0)


def _fit_in_tasks(rows: DataFrame, n: int) -> Model:
    moments = _summed(rows, lambda x, first, label: np.concatenate([[len(x)], x.sum(axis=0)]))
    mean = moments[1:] / moments[0]
    spread = np.sqrt(_summed(rows, lambda x, first, label: ((x - mean) ** 2).sum(axis=0)) / moments[0])
    model = Model.around(mean, spread)

    def slopes_of(now: Model) -> dict[str, np.ndarray]:
        def own(x: np.ndarray, first: np.ndarray, label: np.ndarray) -> np.ndarray:
            return np.concatenate([g.ravel() for g in now.slopes(now.forward(x, first), first, label).values()])

        flat = _summed(rows, own) / n  # a text at a time, slopes are those of that text alone
        ends = np.cumsum([w.size for w in now.weights.values()])
        return {k: part.reshape(w.shape) for (k, w), part in zip(now.weights.items(), np.split(flat, ends[:-1]), strict=True)}

    return model.fit(slopes_of)


def _score(shared, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model | None = shared()
        for batch in batches:
            buf, offsets = tb.utf8(batch.column("text"))
            for lo, hi, part, own in tb.slices(buf, offsets):
                if model is None:
                    y = np.full(hi - lo, 0.5)
                else:
                    y = model.forward(*encode_passages(part, own))["y"]
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(lo, hi - lo) for c in columns] + [pa.array(y)], names=[*columns, "score"])

    return run


def fit_quality(labelled: DataFrame, sample: int = SAMPLE, in_memory: int = IN_MEMORY) -> Model | None:
    """A model from ``sample`` rows of ``labelled`` (text, label 0 or 1), or None without any row.

    Of more rows those with the least hash of text and label count, and all that equal the last of them; ``draw`` draws by doc_id.
    Rows with a null label are left out. All passages of a text count, 312 bytes each; those of all texts go to the
    driver if they are ``in_memory`` bytes at most, and stay in tasks otherwise, which changes sums in their last digits.
    """
    rows = labelled.filter("label is not null").select("text", F.col("label").cast("int").alias("label"))
    drawn = F.xxhash64("text", "label")
    last = rows.select(drawn.alias("h")).orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    rows = rows.filter(drawn <= F.lit(last)).mapInArrow(_features, "label int, x binary")
    rows = Scratch(labelled.sparkSession, "quality").save(rows, "features")
    n, size = rows.agg(F.count("*"), F.sum(F.octet_length("x"))).first()
    if not n:
        return None
    if size > in_memory:
        return _fit_in_tasks(rows.repartition(PARTS), n)
    own = sorted(rows.collect(), key=lambda r: (bytes(r["x"]), r["label"]))
    x, first = _bags([r["x"] for r in own])
    label = np.array([r["label"] for r in own], float)
    return Model.start(x).fit(lambda now: now.slopes(now.forward(x, first), first, label))


def draw(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``sample`` of the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, label) marks, by the hash of doc_id.

    Of rows that share a doc_id the least label and the least text count, nulls first.
    """
    marked = labels.filter("label is not null and doc_id is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
    marked = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "label")).alias("row")).select("row.text", "row.label")


def score_quality(docs: DataFrame, model: Model | None, columns: list[str] | None = None) -> DataFrame:
    """``score`` from 0 to 1 for every row of ``docs`` (text, and what else is passed through).

    Null and empty texts are one passage of zeros. Without a model every score is 0.5. A passed column named score
    is replaced. Rows are taken one by one, with null or repeated ids as well; an empty table gives none.
    """
    kept, schema = passed(docs, columns, MADE)
    return docs.select(*dict.fromkeys([*kept, "text"])).mapInArrow(_score(shipped(docs.sparkSession, model), kept), schema)
