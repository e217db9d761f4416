"""A hidden Markov language model over words.

Words fall into classes by the hash of their endings; a state emits a class, and a class a word by its
smoothed corpus count, so every word, known or not, has a probability in every state:
P(word | state) = P(class | state) * (count + 1) / (class tokens + class words + 1). Baum-Welch trains the
states over all training texts: each task sums the expected counts of its texts, Spark adds them up
by cell, and the driver gets the sums of one model (STATES * CLASSES numbers). Word counts stay distributed.

The scaled forward recursion runs over blocks of LENGTH tokens in step. Every block's transfer matrix is
computed alone and the matrices are then chained, which is the exact recursion in another order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _bytes as tb
from ._shared import Scratch, shipped

STATES, CLASSES = 4, 1024
LENGTH = 64
ROUNDS = 5
#: Tokens that share a list of distinct words.
BATCH_TOKENS = 1_000_000
END = np.uint64(0x5DEECE66D)
_DOCS = "kind int, batch long, doc_id long, held_out boolean, n_tokens long, classes binary, bag binary, token long, place long, n long, class int"


def tokens(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and classes of every text's words and its end, and where each text's begin."""
    low = tb.LOWER[buf]
    starts, ends, first = tb.spans(low, offsets, tb.NOT_SPACE)
    sums, down = tb.prefix_sums(low)
    n, texts = len(starts), len(offsets) - 1
    place = np.arange(n) + np.repeat(np.arange(texts), np.diff(first))
    words = np.full(n + texts, END, dtype=np.uint64)
    classes = np.zeros(n + texts, dtype=np.uint16)
    words[place] = tb.ranged(sums, down, starts, ends)
    tails = tb.ranged(sums, down, np.maximum(starts, ends - 3), ends)
    classes[place] = (tails % np.uint64(CLASSES - 1)).astype(np.uint16) + 1
    return words, classes, first + np.arange(texts + 1)


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def first(cls, class_counts: np.ndarray) -> Model:
        """The classes' shares, moved apart by fixed noise, and states that last."""
        noise = np.random.default_rng(5).standard_normal((STATES, CLASSES))
        emit = (class_counts + 1) * np.exp(noise)
        move = np.full((STATES, STATES), 0.1 / max(STATES - 1, 1))
        np.fill_diagonal(move, 0.9)
        return cls(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=1, keepdims=True))

    @classmethod
    def of_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> Model:
        share = lambda x: x / x.sum(axis=-1, keepdims=True)
        return cls(share(start + 0.1), share(move + 0.1), share(emit + 0.1))

    def _blocks(self, classes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per block its place of the first token, size, and rank in its text. Texts have a token at least."""
        sizes = np.diff(first)
        per = -(-sizes // LENGTH)
        text = np.repeat(np.arange(len(sizes)), per)
        rank = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        at = first[text] + rank * LENGTH
        return at, np.minimum(first[text + 1] - at, LENGTH), rank

    def transfers(self, classes: np.ndarray, at: np.ndarray, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scaled transfer matrices of blocks, and the logs of their scales.

        The first token of a text takes start instead of move, for whichever state stands before it.
        """
        emit = np.ascontiguousarray(self.emit.T)
        before = np.where((rank == 0)[:, None, None], self.start[None, None, :], self.move[None])
        x = before * emit[classes[at]][:, None, :]
        logs = np.zeros(len(at))
        order = np.argsort(-size, kind="stable")
        x, at, size = x[order], at[order], size[order]
        live = np.searchsorted(-size, -np.arange(LENGTH + 1), side="left")
        for t in range(LENGTH):
            if t:
                k = live[t]
                if not k:
                    break
                y = (x[:k].reshape(-1, STATES) @ self.move).reshape(k, STATES, STATES)
                y *= emit[classes[at[:k] + t]][:, None, :]
                x[:k] = y
            if t % 8 == 7 or t == LENGTH - 1:
                scale = x.max(axis=(1, 2))
                x /= scale[:, None, None]
                logs += np.log(scale)
        scale = x.max(axis=(1, 2))
        x /= scale[:, None, None]
        logs += np.log(scale)
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return x[back], logs[back]

    def log_likelihoods(self, classes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Natural logs of the texts' class probabilities."""
        at, size, rank = self._blocks(classes, first)
        x, logs = self.transfers(classes, at, size, rank)
        _, total = self._ahead(x, logs, rank, len(first) - 1)
        return total

    def _ahead(self, x: np.ndarray, logs: np.ndarray, rank: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """State weights before each block, and the texts' log likelihoods."""
        heads = np.flatnonzero(rank == 0)
        per = np.diff(np.append(heads, len(rank)))
        weights = np.empty((len(rank), STATES))
        now = np.full((texts, STATES), 1 / STATES)
        total = np.zeros(texts)
        for r in range(int(per.max(initial=0))):
            rows = np.flatnonzero(per > r)
            blocks = heads[rows] + r
            weights[blocks] = now[rows]
            after = np.einsum("ns,nst->nt", now[rows], x[blocks])
            scale = after.sum(axis=1)
            now[rows] = after / scale[:, None]
            total[rows] += np.log(scale) + logs[blocks]
        return weights, total

    def expect(self, classes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected counts of starts, moves and emissions over texts, and their log likelihood."""
        at, size, rank = self._blocks(classes, first)
        x, logs = self.transfers(classes, at, size, rank)
        ahead, total = self._ahead(x, logs, rank, len(first) - 1)
        heads = np.flatnonzero(rank == 0)
        per = np.diff(np.append(heads, len(rank)))
        behind = np.ones((len(rank), STATES))
        now = np.ones((len(heads), STATES))
        for r in range(int(per.max(initial=0)) - 1, -1, -1):
            rows = np.flatnonzero(per > r)
            blocks = heads[rows] + r
            behind[blocks] = now[rows]
            before = np.einsum("nst,nt->ns", x[blocks], now[rows])
            now[rows] = before / before.sum(axis=1, keepdims=True)
        # Within blocks: forward weights are kept, the backward pass adds up the counts. Sorted by size, so
        # that the blocks that reach a token are the first ones.
        order = np.argsort(-size, kind="stable")
        at, size, rank, ahead, behind = at[order], size[order], rank[order], ahead[order], behind[order]
        live = np.searchsorted(-size, -np.arange(LENGTH + 1), side="left")
        emit = np.ascontiguousarray(self.emit.T)
        forward = np.empty((LENGTH, len(at), STATES))
        for t in range(LENGTH):
            k = live[t]
            if not k:
                break
            if t == 0:
                before = np.where((rank == 0)[:, None], self.start[None], ahead @ self.move)
            else:
                before = forward[t - 1, :k] @ self.move
            now = before * emit[classes[at[:k] + t]]
            forward[t, :k] = now / now.sum(axis=1, keepdims=True)
        starts, moves = np.zeros(STATES), np.zeros((STATES, STATES))
        places, shares = [], []
        beta = behind
        for t in range(LENGTH - 1, -1, -1):
            k = live[t]
            if not k:
                continue
            here = emit[classes[at[:k] + t]]
            post = forward[t, :k] * beta[:k]
            post /= post.sum(axis=1, keepdims=True)
            places.append(at[:k] + t)
            shares.append(post)
            out = here * beta[:k]
            came = forward[t - 1, :k] if t else ahead[:k]
            norm = np.einsum("ns,ns->n", came @ self.move, out)
            inner = np.ones(k, dtype=bool) if t else rank[:k] > 0
            moves += (came[inner] / norm[inner, None]).T @ out[inner] * self.move
            if t == 0:
                starts += post[~inner].sum(axis=0)
            back = out @ self.move.T
            beta = beta.copy() if t == LENGTH - 1 else beta
            beta[:k] = back / back.sum(axis=1, keepdims=True)
        place, share = np.concatenate(places), np.concatenate(shares)
        emits = np.stack([np.bincount(classes[place], weights=share[:, s], minlength=CLASSES) for s in range(STATES)])
        return starts, moves, emits, float(total.sum())


def _pack(places: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted places and their counts, split by bytes so that the files' compression finds the zeros."""
    steps = np.diff(places, prepend=0).astype("<u4")
    counts = counts.astype("<u4")
    return b"".join(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T).tobytes() for x in (steps, counts))


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(raw, np.uint8).reshape(2, 4, -1)
    steps, counts = (np.ascontiguousarray(p.T).view("<u4").ravel() for p in planes)
    return np.cumsum(steps.astype(np.int64)), counts.astype(np.int64)


def _table(names: dict[str, pa.Array], rows: int) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [x.split() for x in _DOCS.split(", ")]
    return pa.RecordBatch.from_arrays([names[n] if n in names else pa.nulls(rows, kinds[k]) for n, k in fields], names=[n for n, _ in fields])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of kind 0 for texts and of kind 1 for the distinct words of each batch of texts."""
    held: list[tuple] = []
    size, part = 0, 0

    def flush() -> Iterator[pa.RecordBatch]:
        batch = (TaskContext.get().partitionId() << 32) | part
        words = np.concatenate([x[2] for x in held])
        classes = np.concatenate([x[3] for x in held])
        kinds, at, which = np.unique(words, return_index=True, return_inverse=True)
        train = np.zeros(len(kinds), np.int64)
        base = 0
        for ids, out, own, own_classes, first in held:
            place = which[base : base + len(own)]
            base += len(own)
            learned = np.repeat(~out, np.diff(first))
            train += np.bincount(place[learned], minlength=len(kinds))
            bags, blobs = [], []
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                bags.append(_pack(*np.unique(place[a:b], return_counts=True)))
                blobs.append(own_classes[a:b].tobytes())
            n = len(ids)
            yield _table({"kind": pa.array(np.zeros(n, np.int32)), "batch": pa.array(np.full(n, batch)), "doc_id": ids, "held_out": pa.array(out), "n_tokens": pa.array(np.diff(first)), "classes": pa.array(blobs, pa.binary()), "bag": pa.array(bags, pa.binary())}, n)
        for lo in range(0, len(kinds), 50_000):
            hi = min(lo + 50_000, len(kinds))
            n = hi - lo
            yield _table({"kind": pa.array(np.ones(n, np.int32)), "batch": pa.array(np.full(n, batch)), "token": pa.array(kinds[lo:hi].view(np.int64)), "place": pa.array(np.arange(lo, hi)), "n": pa.array(train[lo:hi]), "class": pa.array(classes[at[lo:hi]].astype(np.int32))}, n)

    for rows in batches:
        buf, offsets = tb.utf8(rows.column("text"))
        out = rows.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        for lo, hi, bytes_, own in tb.slices(buf, offsets):
            words, classes, first = tokens(bytes_, own)
            held.append((rows.column("doc_id").slice(lo, hi - lo), out[lo:hi], words, classes, first))
            size += len(words)
            if size >= BATCH_TOKENS:
                yield from flush()
                held.clear()
                size, part = 0, part + 1
    if held:
        yield from flush()


def _sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    buf, offsets = tb.utf8(column)
    return np.frombuffer(np.ascontiguousarray(buf).data, np.uint16), offsets // 2


def _chunks(first: np.ndarray, most: int = 400_000) -> Iterator[tuple[int, int]]:
    lo = 0
    while lo < len(first) - 1:
        hi = max(lo + 1, int(np.searchsorted(first, first[lo] + most, side="right")) - 1)
        yield lo, hi
        lo = hi


def _expect(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared()
        sums = np.zeros(STATES + STATES * STATES + STATES * CLASSES + 1)
        for batch in batches:
            classes, first = _sequences(batch.column("classes"))
            for lo, hi in _chunks(first):
                start, move, emit, total = model.expect(classes[first[lo] : first[hi]], first[lo : hi + 1] - first[lo])
                sums += np.concatenate([start, move.ravel(), emit.ravel(), [total]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], names=["cell", "x"])

    return run


def train(sequences: DataFrame, class_counts: np.ndarray, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    """Baum-Welch over all rows of ``sequences`` (classes), and the log likelihood before each round."""
    spark = sequences.sparkSession
    model, seen = Model.first(class_counts), []
    for _ in range(rounds):
        shared = shipped(spark, model)
        sums = np.zeros(STATES + STATES * STATES + STATES * CLASSES + 1)
        for row in sequences.select("classes").mapInArrow(_expect(shared), "cell long, x double").groupBy("cell").agg(F.sum("x").alias("x")).collect():
            sums[row["cell"]] = row["x"]
        start, move, emit, total = np.split(sums, np.cumsum([STATES, STATES * STATES, STATES * CLASSES]))
        seen.append(float(total[0]))
        model = Model.of_counts(start, move.reshape(STATES, STATES), emit.reshape(STATES, CLASSES))
    return model, seen


def _forward(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared()
        for batch in batches:
            classes, first = _sequences(batch.column("classes"))
            logs = [model.log_likelihoods(classes[first[lo] : first[hi]], first[lo : hi + 1] - first[lo]) for lo, hi in _chunks(first)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("batch", "doc_id", "held_out", "n_tokens", "bag")), pa.array(np.concatenate(logs) if logs else np.empty(0))], names=["batch", "doc_id", "held_out", "n_tokens", "bag", "log_class"])

    return run


def _score(class_tokens: np.ndarray, class_words: np.ndarray):
    n, v = int(class_tokens.sum()), int(class_words.sum())
    below = np.log10(class_tokens + class_words + 1)

    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        places = words.column("place").to_numpy()
        counts = np.empty(len(places), np.int64)
        terms = np.empty(len(places))
        c = words.column("c").to_numpy()
        counts[places] = c
        terms[places] = np.log10(c + 1) - below[words.column("class").to_numpy()]
        known, base, score = [], [], []
        for bag, log_class in zip(docs.column("bag").to_pylist(), docs.column("log_class").to_pylist(), strict=True):
            at, k = _unpack(bag)
            own = counts[at]
            known.append(int(k[own > 0].sum()))
            base.append(float((k * (np.log10(own + 1) - np.log10(n + v + 1))).sum()))
            score.append(log_class / np.log(10) + float((k * terms[at]).sum()))
        return pa.table({"doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": docs.column("n_tokens"), "n_known": pa.array(known, pa.int64()), "train_tokens": pa.array([n] * len(known), pa.int64()), "base_score": pa.array(base, pa.float64()), "score": pa.array(score, pa.float64())})

    return run


def score_texts(docs: DataFrame, held_out: Column, rounds: int = ROUNDS) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text) by a model of the rows that ``held_out`` doesn't mark.

    Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased and one end; a null or empty text is its end alone.
    doc_id, held_out, n_tokens, n_known (tokens seen in training), train_tokens, base_score (log10 by smoothed
    token counts) and score (log10 by the model). Rows count one by one, repeated ones too; a null
    ``held_out`` counts as false, a row without doc_id is scored like others. Columns other than these two are ignored, whatever
    their names. Without a training row the model keeps its first, noisy state. Sums over tasks are added in any order, so scores
    may differ in their last digits from run to run.
    """
    scratch = Scratch(docs.sparkSession, "hmm")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    gathered = scratch.path("gathered")
    rows.mapInArrow(_gather, _DOCS).write.partitionBy("kind").parquet(gathered)
    spark = docs.sparkSession
    schema = ", ".join(x for x in _DOCS.split(", ") if not x.startswith("kind"))
    texts = spark.read.schema(schema).parquet(gathered).where("false") if rows.limit(1).isEmpty() else spark.read.schema(schema).parquet(f"{gathered}/kind=0")
    if rows.limit(1).isEmpty():
        return texts.select("doc_id", "held_out", "n_tokens", F.col("n_tokens").alias("n_known"), F.col("n_tokens").alias("train_tokens"), F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score"))
    words = spark.read.schema(schema).parquet(f"{gathered}/kind=1").select("batch", "place", "token", "n", F.col("class"))
    # A token has a row in a batch, so none holds more of the rows than one in the distinct tokens of a batch.
    counts = scratch.save(words.groupBy("token").agg(F.sum("n").alias("c"), F.min("class").alias("class")), "counts")
    class_tokens, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in counts.groupBy("class").agg(F.sum("c").alias("n"), F.sum(F.expr("int(c > 0)")).alias("v")).collect():
        class_tokens[row["class"]], class_words[row["class"]] = row["n"], row["v"]
    totals = scratch.save(words.select("batch", "place", "token", "class").join(counts.select("token", "c"), "token").drop("token"), "totals")
    scratch.drop(f"{gathered}/kind=1")
    scratch.drop(counts)
    model, _ = train(texts.filter("not held_out"), class_tokens, rounds)
    scored = texts.select("batch", "doc_id", "held_out", "n_tokens", "classes", "bag").mapInArrow(_forward(shipped(spark, model)), "batch long, doc_id long, held_out boolean, n_tokens long, bag binary, log_class double")
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return scored.groupBy("batch").cogroup(totals.select("batch", "place", "class", "c").groupBy("batch")).applyInArrow(_score(class_tokens, class_words), out)
