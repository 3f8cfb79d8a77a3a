"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is a position with two states, good and bad. Its features are its own statistics and those of the lines before and after.
Weights and transitions are trained by the exact gradient of the chain likelihood on a bounded labelled sample, each line taking its document's
label. A document's score is the mean of its lines' forward-backward marginals weighted by line length, put on a calibrated scale.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import fold, labelled_sample
from millrace.llm.textbatch import LETTER, SPACE, flat, slices, span_hasher, spans

FOLDS, HELD_OUT = 3, 1
PER_CLASS = 1500  # labelled documents of each class used for training, at most
SAMPLE_ROWS = 50  # training texts whose features are made at once
TRAIN_LINES = 40  # training chains are runs of so many lines; scoring uses whole documents
STEPS, RATE, DECAY = 150, 0.05, 1e-3
CLASSES = {
    "upper": np.isin(np.arange(256), np.arange(0x41, 0x5B)), "lower": np.isin(np.arange(256), np.arange(0x61, 0x7B)), "digit": np.isin(np.arange(256), np.arange(0x30, 0x3A)),
    "symbol": np.isin(np.arange(256), [ord(c) for c in "#*$%&<>=~^_\\@"]), "bar": np.arange(256) == ord("|"), "bang": np.isin(np.arange(256), [ord(c) for c in "!?"]),
    "stop": np.isin(np.arange(256), [ord(c) for c in ".,;:"]), "slash": np.isin(np.arange(256), [ord(c) for c in "/{}[]()"]), "letter": LETTER,
}
OWN = 18  # features of a line itself


@dataclass
class Lines:
    features: np.ndarray  # (lines, 3 * OWN): own, of the line before, of the line after
    weight: np.ndarray  # bytes
    bounds: np.ndarray  # first line of each row, and the number of lines


def lines_of(column: pa.Array) -> Lines:
    """Lines with a word, in order, with their features."""
    data, offsets = flat(column)
    starts, ends = spans(data != 0x0A, offsets)
    row = np.searchsorted(offsets, starts, side="right") - 1
    w_start, w_end = spans(~SPACE[data], offsets)
    first = np.searchsorted(w_start, starts)
    words = np.searchsorted(w_start, ends) - first
    has = words > 0
    starts, ends, row, first, words = starts[has], ends[has], row[has], first[has], words[has]
    size = (ends - starts).astype(float)
    of = {}
    for name, inside in CLASSES.items():
        total = np.r_[0, np.cumsum(inside[data], dtype=np.int64)]
        of[name] = (total[ends] - total[starts]).astype(float)
    hashed = span_hasher(data)
    code = hashed(w_start, w_end)

    def repeats(gap: int) -> np.ndarray:
        same = np.r_[np.zeros(min(gap, len(code)), bool), code[gap:] == code[:-gap]]
        total = np.r_[0, np.cumsum(same)]
        begin = np.minimum(first + gap, first + words)
        return (total[first + words] - total[begin]).astype(float)

    line_code = hashed(starts, ends)
    pair = np.lexsort((np.arange(len(row)), line_code, row))
    again = np.zeros(len(row), bool)
    if len(row):
        again[pair[1:]] = (row[pair[1:]] == row[pair[:-1]]) & (line_code[pair[1:]] == line_code[pair[:-1]])
    n = np.maximum(words, 1).astype(float)
    per_row = np.bincount(row, words, len(offsets) - 1)[row] if len(row) else n
    last, head = data[np.maximum(ends - 1, 0)], data[starts] if len(starts) else np.zeros(0, np.uint8)
    capped = lambda x: np.minimum(x, 3.0)
    own = np.stack([
        np.log1p(n), np.log1p(per_row), of["upper"] / np.maximum(of["upper"] + of["lower"], 1), of["digit"] / size, capped(of["symbol"] / n), capped(of["bar"] / n), capped(of["bang"] / n),
        capped(of["stop"] / n), capped(of["slash"] / n), 1 - of["letter"] / size, repeats(1) / n, repeats(2) / n, again.astype(float), np.isin(last, [0x2E, 0x21, 0x3F]).astype(float),
        CLASSES["upper"][head].astype(float), np.minimum(size / n / 10, 3.0), (n < 5).astype(float), np.ones(len(n)),
    ], axis=1) if len(n) else np.zeros((0, OWN))
    bounds = np.searchsorted(row, np.arange(len(offsets)))
    before, after = np.zeros_like(own), np.zeros_like(own)
    if len(own):
        joined = (row[1:] == row[:-1])[:, None]
        before[1:], after[:-1] = own[:-1] * joined, own[1:] * joined
    return Lines(np.concatenate([own, before, after], axis=1), size, bounds)


def marginals(unary: np.ndarray, step: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every line, and for every line but a document's last the joint probabilities with the next, (lines, 2, 2).

    Forward and backward messages of all documents at once, position by position; only those still running take part.
    """
    n, length = len(unary), np.diff(bounds)
    local = np.exp(np.stack([-0.5 * unary, 0.5 * unary], axis=1).clip(-30, 30))
    move = np.exp(np.clip(step, -20, 20))
    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    order = np.argsort(-length, kind="stable")
    alive = np.searchsorted(-length[order], -np.arange(1, length.max(initial=0) + 1), side="right")
    begin = bounds[:-1][order]
    for t, k in enumerate(alive):
        at = begin[:k] + t
        a = local[at] if t == 0 else (forward[at - 1] @ move) * local[at]
        forward[at] = a / a.sum(axis=1, keepdims=True)
    end = bounds[1:][order]
    for t, k in enumerate(alive):
        at = end[:k] - 1 - t
        b = np.ones((k, 2)) if t == 0 else (backward[at + 1] * local[at + 1]) @ move.T
        backward[at] = b / b.sum(axis=1, keepdims=True)
    both = forward * backward
    good = both[:, 1] / both.sum(axis=1)
    pair = forward[:, :, None] * move * np.r_[(local * backward)[1:], np.ones((min(n, 1), 2))][:, None, :]
    return good, pair / pair.sum(axis=(1, 2), keepdims=True)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    step: np.ndarray
    level: tuple[float, float]  # slope and offset of the calibrated scale

    def raw(self, lines: Lines) -> np.ndarray:
        """Length-weighted mean of the marginal log odds, bounded, per document; 0 for a document without lines."""
        good, _ = marginals((lines.features - self.mean) / self.scale @ self.weights, self.step, lines.bounds)
        row = np.repeat(np.arange(len(lines.bounds) - 1), np.diff(lines.bounds))
        share = np.bincount(row, lines.weight * good, len(lines.bounds) - 1) / np.maximum(np.bincount(row, lines.weight, len(lines.bounds) - 1), 1e-9)
        share = np.where(np.diff(lines.bounds) > 0, share, 0.5)
        return np.log((share + 1e-6) / (1 - share + 1e-6))

    def score(self, lines: Lines) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.level[0] * self.raw(lines) + self.level[1], -500, 500)))


def train(sample: list[tuple[str, int]], prior: float) -> Model:
    """Adam on the mean chain log-likelihood; then slope and offset by logistic regression, moved to the label share ``prior``."""
    flat_model = Model(np.zeros(3 * OWN), np.ones(3 * OWN), np.zeros(3 * OWN), np.zeros((2, 2)), (1.0, float(np.log(prior / (1 - prior)))))
    if len({y for _, y in sample}) < 2:
        return flat_model
    parts = [lines_of(pa.array([t for t, _ in sample[a:a + SAMPLE_ROWS]], pa.string())) for a in range(0, len(sample), SAMPLE_ROWS)]
    ahead = np.cumsum([0, *(p.bounds[-1] for p in parts)])
    whole = Lines(
        np.concatenate([p.features for p in parts]), np.concatenate([p.weight for p in parts]), np.r_[np.concatenate([p.bounds[:-1] + n for p, n in zip(parts, ahead, strict=False)]), ahead[-1]],
    )
    y = np.array([y for _, y in sample], float)
    row = np.repeat(np.arange(len(sample)), np.diff(whole.bounds))
    if not len(row):
        return flat_model
    place = np.arange(len(row)) - whole.bounds[row]
    chain = np.r_[True, (row[1:] != row[:-1]) | (place[1:] % TRAIN_LINES == 0)]
    bounds = np.r_[np.flatnonzero(chain), len(row)]
    label, joined = y[row], ~np.r_[chain[1:], True]
    mean, scale = whole.features.mean(axis=0), whole.features.std(axis=0)
    mean[scale < 1e-9] -= 1.0  # a constant feature becomes 1: own bias and edge marks
    scale = np.maximum(scale, 1e-3)
    x = np.where(whole.features.std(axis=0) < 1e-9, 1.0, (whole.features - mean) / scale)
    scale[whole.features.std(axis=0) < 1e-9] = 1.0
    # Each document weighs the same, each class half.
    importance = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))[row] / np.diff(whole.bounds)[row]
    weights, step = np.zeros(x.shape[1]), np.zeros((2, 2))
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(step), np.zeros_like(step)]
    seen = np.zeros((len(row), 2, 2))
    seen[np.arange(len(row)), label.astype(int), label.astype(int)] = 1
    for k in range(1, STEPS + 1):
        good, pair = marginals(x @ weights, step, bounds)
        g_w = x.T @ ((good - label) * importance) + DECAY * weights
        g_s = ((pair - seen) * (importance * joined)[:, None, None]).sum(axis=0) + DECAY * 10 * step
        for i, g in ((0, g_w), (2, g_s)):
            moments[i] = 0.9 * moments[i] + 0.1 * g
            moments[i + 1] = 0.999 * moments[i + 1] + 0.001 * g * g
        move = [RATE * (moments[i] / (1 - 0.9**k)) / (np.sqrt(moments[i + 1] / (1 - 0.999**k)) + 1e-8) for i in (0, 2)]
        weights, step = weights - move[0], step - move[1]
    model = Model(mean, scale, weights, step, (1.0, 0.0))
    raw = model.raw(whole)
    balance, slope, offset = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum())), 1.0, 0.0
    for _ in range(50):  # Newton steps, slightly damped
        p = 1 / (1 + np.exp(-np.clip(slope * raw + offset, -30, 30)))
        g = np.array([((p - y) * balance * raw).sum() + 1e-3 * (slope - 1), ((p - y) * balance).sum() + 1e-4 * offset])
        h = p * (1 - p) * balance
        hess = np.array([[(h * raw * raw).sum() + 1e-3, (h * raw).sum()], [(h * raw).sum(), h.sum() + 1e-4]])
        move = np.linalg.solve(hess, g)
        slope, offset = slope - np.clip(move[0], -1, 1), offset - np.clip(move[1], -1, 1)
    return Model(mean, scale, weights, step, (max(float(slope), 1e-3), float(offset + np.log(prior / (1 - prior)))))


def score_batches(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            score = model.score(lines_of(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return run


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1), predicted.

    Learned from at most PER_CLASS labelled documents of each class with crc32(doc_id) mod 3 other than 1. Null, empty and blank texts have no lines
    and get the score of even odds on the calibrated scale; so do all if no label of one class is known. Repeated rows are scored each. Other columns are ignored.
    """
    seen = labels.where(fold("doc_id", FOLDS) != HELD_OUT).agg(F.count_if(F.col("quality") == 1), F.count_if(F.col("quality") == 0)).first()
    model = train(labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT, PER_CLASS), (seen[0] + 1) / (seen[0] + seen[1] + 2))
    own = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"))
    return own.mapInArrow(score_batches(model), "doc_id bigint, held_out boolean, score double, predicted int")
