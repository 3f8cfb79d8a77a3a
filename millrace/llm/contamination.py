"""Benchmark items inside documents: containment search with MinHash over size classes, then exact shingle containment.

Items are grouped by size class k, 2**k to 2**(k+1)-1 shingles. For each class that the benchmark has, a document is read as overlapping
windows of 2**(k+2) shingles, one every 2**(k+1), so that an item's run of shingles lies whole in some window of a size near its own:
however long the document, the item makes up a fifth of the window or more. Item and window are candidates if they share any of 64 minima
(one row a band); a window that holds 0.8 of an item shares none with probability under 1e-5. Minima of a window are minima of its two
halves, those of a half are minima of the two halves in the class below, so all classes cost little more than one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import store
from millrace.llm.textbatch import list_column, mix, shingles, slices, split_letters

HASHES = 64
PERCENT = 80
FILTER_BITS = 22  # slots of the filter over the items' minima: 2**16 longs however large the benchmark is
BLOCK = 1 << 14
_RNG = np.random.default_rng(4)
FACTOR = (_RNG.integers(0, 2**32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
SHIFT = _RNG.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)[:, None]
SALT = mix(np.arange(1, HASHES + 1, dtype=np.uint64))[:, None]


def block_minima(values: np.ndarray, size: int) -> np.ndarray:
    """(HASHES, blocks): minima over runs of ``size`` shingles, the last run shorter."""
    low, out = values.astype(np.uint32), []
    step = max(BLOCK // size, 1) * size
    for a in range(0, len(low), step):
        part = low[a:a + step]
        out.append(np.minimum.reduceat(part * FACTOR + SHIFT, np.arange(0, len(part), size), axis=1))
    return np.concatenate(out, axis=1)


def keys_of(best: np.ndarray, size_class: int) -> np.ndarray:
    """One 64-bit key for each hash function, minimum and size class."""
    return mix(best.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + SALT + np.uint64(size_class))


def item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        values, bounds = shingles(split_letters(batch.column("text")))
        sets = [np.unique(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        keys = [keys_of(block_minima(s, len(s)), len(s).bit_length() - 1).ravel() if len(s) else np.zeros(0, np.uint64) for s in sets]
        joined = lambda parts: list_column(np.concatenate(parts), np.r_[0, np.cumsum([len(p) for p in parts])])
        size = np.array([len(s) for s in sets], np.int64)
        kind = np.array([max(len(s).bit_length() - 1, 0) for s in sets], np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(size), pa.array(kind), joined(keys), joined(sets)], ["item_id", "n_item", "size_class", "keys", "item"])


def window_batches(classes: list[int], seen: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Minima of all windows of every class that may be an item's, as (doc_id, key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values, bounds = shingles(split_letters(batch.column("text")))
            rows, keys = [], []
            for r, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                if a == b or not classes:
                    continue
                size = 2 << classes[0]
                half = block_minima(values[a:b], size)
                for k in classes:
                    while size < 2 << k:
                        half = np.minimum(half[:, ::2], np.c_[half[:, 1::2], half[:, -1:]] if half.shape[1] % 2 else half[:, 1::2])
                        size *= 2
                    window = np.minimum(half[:, :-1], half[:, 1:]) if half.shape[1] > 1 else half
                    key = np.unique(keys_of(window, k))
                    slot = key & np.uint64((1 << FILTER_BITS) - 1)
                    key = key[(seen[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)]
                    rows.append(np.full(len(key), r))
                    keys.append(key)
            at = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            found = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at.astype(np.int64))), pa.array(found.view(np.int64))], ["doc_id", "key"])

    return run


def set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        values, bounds = shingles(split_letters(batch.column("text")))
        sets = [np.unique(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), list_column(np.concatenate(sets), np.r_[0, np.cumsum([len(s) for s in sets])])], ["doc_id", "shingles"])


def contained_items(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (doc_id, item_id, n_item, n_shared, containment) where a document holds ``percent`` of an item's distinct 5-word shingles.

    An item with fewer than five words is one shingle, its whole sequence, found only in documents that are that sequence. Items and
    documents without words match nothing. Rows with a null id are left out, as a pair could not name them; repeated rows give one pair; of rows that share
    an id but not the text each is compared and the largest overlap is reported. Other columns are ignored.
    """
    own = items.where("item_id is not null").select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    made = store(own.mapInArrow(item_batches, "item_id bigint, n_item bigint, size_class bigint, keys array<bigint>, item array<bigint>").where("n_item > 0"), "items")
    classes = sorted(r[0] for r in made.select("size_class").distinct().collect())  # at most 63 values
    keyed = made.select("item_id", F.explode("keys").alias("key"))
    slot = F.col("key").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), slot.bitwiseAND(F.lit(63)).cast("int"))
    seen = np.zeros(1 << FILTER_BITS - 6, np.uint64)
    for at, bits in keyed.select(F.shiftright(slot, 6).alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).collect():  # at most 2**16 rows
        seen[at] = np.uint64(bits % 2**64)
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    windows = texts.mapInArrow(window_batches(classes, seen), "doc_id bigint, key bigint")
    pairs = store(windows.join(keyed, "key").select("doc_id", "item_id").distinct(), "candidates")
    sets = texts.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(set_batches, "doc_id bigint, shingles array<bigint>")
    full = pairs.join(sets, "doc_id").join(made.select("item_id", "n_item", "item"), "item_id")
    shared = F.size(F.array_intersect("item", "shingles")).cast("bigint")
    held = full.select("doc_id", "item_id", "n_item", shared.alias("n_shared")).where(F.col("n_shared") * 100 >= F.col("n_item") * percent)
    best = held.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("n_item", "n_shared"), F.col("n_shared") / F.col("n_item")).alias("x"))
    return best.select("doc_id", "item_id", "x.n_item", "x.n_shared", (F.col("x.n_shared") / F.col("x.n_item")).alias("containment"))
