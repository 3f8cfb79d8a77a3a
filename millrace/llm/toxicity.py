"""Toxicity: bags of subword embeddings, averaged, into a linear softmax; embeddings and softmax are trained jointly in numpy.

A word's subwords are its 3- to 5-byte n-grams and itself, hashed into buckets; a word is the mean of its subwords, a text the mean of its words.
Misspellings share most n-grams with the words seen; every subword of the sample is learned, those of a single text too. Training takes a bounded labelled sample; scoring needs one number per bucket and class.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import fold, labelled_sample
from millrace.llm.textbatch import slices, span_hasher, split_letters

FOLDS, HELD_OUT = 5, 0
PER_CLASS = 1500  # labelled documents of each class used for training, at most
BUCKETS, WIDTH, GRAMS = 1 << 18, 8, (3, 4, 5)
STEPS, RATE, SCALE, DECAY = 120, 0.05, 120.0, 1e-4


def subwords(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Bucket and weight of every subword and the row it belongs to; the weights of a row add up to one."""
    words = split_letters(column)
    n, per_row = len(words.starts), np.diff(words.bounds)
    at = np.arange(len(words.data))
    word_at = np.repeat(np.arange(n), words.ends - words.starts)
    inside = at[np.repeat(words.starts - (np.cumsum(words.ends - words.starts) - (words.ends - words.starts)), words.ends - words.starts) + np.arange(len(word_at))] if n else at[:0]
    hashed = span_hasher(words.data)
    buckets, owners = [hashed(words.starts, words.ends)], [np.arange(n)]
    for g in GRAMS:
        fits = inside + g <= words.ends[word_at]
        buckets.append(hashed(inside[fits], inside[fits] + g) ^ np.uint64(g))
        owners.append(word_at[fits])
    bucket = (np.concatenate(buckets) & np.uint64(BUCKETS - 1)).astype(np.int64)
    owner = np.concatenate(owners)
    share = 1.0 / np.maximum(np.bincount(owner, minlength=n), 1)
    weight = share[owner] / per_row[words.row[owner]]
    return bucket, weight, words.row[owner], words.rows


def train(sample: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Class scores per bucket (BUCKETS, 2) and biases, by full-batch Adam on the weighted cross-entropy."""
    if len({y for _, y in sample}) < 2:
        share = np.mean([y for _, y in sample]) if sample else 0.0
        return np.zeros((BUCKETS, 2)), np.array([0.0, 4.0 if share == 1 else -4.0])
    keys, weights, rows, base = [], [], [], 0
    for a in range(0, len(sample), 100):
        bucket, weight, row, n = subwords(pa.array([t for t, _ in sample[a:a + 100]], pa.string()))
        key, place = np.unique(row * BUCKETS + bucket, return_inverse=True)
        keys.append((key % BUCKETS).astype(np.int32))
        rows.append((key // BUCKETS + base).astype(np.int32))
        weights.append((np.bincount(place, weight) * SCALE).astype(np.float32))
        base += n
    col, row, value = np.concatenate(keys), np.concatenate(rows), np.concatenate(weights)
    used = np.unique(col)
    number = np.zeros(BUCKETS, np.int32)
    number[used] = np.arange(len(used))
    col = number[col]
    y = np.array([y for _, y in sample])
    target = np.stack([1 - y, y], axis=1).astype(float)
    importance = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    rng = np.random.default_rng(9)
    params = [rng.normal(0, 0.1, (len(used), WIDTH)), rng.normal(0, 0.5, (WIDTH, 2)), np.zeros(2)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        emb, out, bias = params
        per_bucket = emb @ out
        logits = np.stack([np.bincount(row, value * per_bucket[col, k], len(y)) for k in (0, 1)], axis=1) + bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        error = (p - target) * importance[:, None]
        back = np.stack([np.bincount(col, value * error[row, k], len(used)) for k in (0, 1)], axis=1)
        grads = [back @ out.T + DECAY * emb, emb.T @ back + DECAY * out, error.sum(axis=0)]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            params[i] = params[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    table = np.zeros((BUCKETS, 2))
    table[used] = params[0] @ params[1] * SCALE
    return table, params[2]


def score_batches(table: np.ndarray, bias: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    gap, offset = (table[:, 1] - table[:, 0]).astype(np.float32), float(bias[1] - bias[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 19):
            bucket, weight, row, n = subwords(batch.column("text"))
            logit = np.bincount(row, weight * gap[bucket], n) + offset
            score = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return run


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1), predicted.

    Learned from at most PER_CLASS labelled documents of each class with crc32(doc_id) mod 5 other than 0. Null and empty texts, and texts
    without a letter or digit, get the softmax of the biases alone; if no label of one class is known, all texts do. Repeated rows are scored each. Other columns are ignored.
    """
    table, bias = train(labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT, PER_CLASS))
    # Training weighs both classes alike; the share of the class among all training labels sets the level of the scores.
    seen = labels.where(fold("doc_id", FOLDS) != HELD_OUT).agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    bias = bias + np.log([max(seen[1], 1), max(seen[0], 1)])
    own = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"))
    return own.mapInArrow(score_batches(table, bias), "doc_id bigint, held_out boolean, score double, predicted int")
