"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter trigram is bound as the product of its letters' vectors, rotated by their place; a text
is the bundle (sum) of its trigrams, a language the bundle of its training texts. A text gets the language of highest cosine.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import fold
from millrace.llm.textbatch import mix, slices

WIDTH, FOLDS, HELD_OUT = 1024, 4, 2
MOST_LANGUAGES = 5000  # labels are a closed set; more is refused, as the profiles go to every task
BLOCK = 4096  # trigrams expanded at once
_DIMS = np.arange(WIDTH // 64, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """(letters, WIDTH) of +1 and -1, drawn from the code point alone."""
    bits = mix(mix(points.astype(np.uint64) + np.uint64(1))[:, None] + _DIMS)
    return np.unpackbits(bits.view(np.uint8), axis=1, bitorder="little").astype(np.int8) * 2 - 1


def bundles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(texts, WIDTH) bundles and the number of letters of each text. Anything but letters is one space; a text is framed by spaces; trigrams have a letter in the middle."""
    joined = "\x00".join((t or "").replace("\x00", " ") for t in texts).lower() + "\x00"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds, index = np.unique(points, return_inverse=True) if points.max() >= 1 << 16 else _by_table(points)
    letter = np.array([chr(k).isalpha() for k in kinds], bool)
    row_end = points == 0
    is_letter = letter[index]
    row = np.cumsum(row_end) - row_end
    count = np.bincount(row[is_letter], minlength=len(texts))
    kinds = np.where(letter, kinds, 32)
    # Drop all but the last of each run of other characters: it separates words, and the row end frames rows.
    keep = is_letter | np.r_[is_letter[1:], True] | row_end
    symbol, row = np.where(letter, np.arange(len(kinds)), -1)[index][keep], row[keep]
    used = len(kinds) + 1
    first = np.r_[-1, symbol[:-1]]  # the row end before a row is the space in front of it
    a, b, c = first[:-1], symbol[:-1], symbol[1:]
    same = (row[:-1] == row[1:]) & (b >= 0)
    a = np.where(np.r_[True, row[1:-1] != row[:-2]] if len(row) > 2 else np.ones(len(a), bool), -1, a)
    code = (((a + 1) * used + b + 1) * used + c + 1)[same]
    trigram, place = np.unique(code, return_inverse=True)
    of_row = row[:-1][same]
    vectors = np.r_[letter_vectors(np.array([32])), letter_vectors(kinds)]
    out = np.zeros((len(texts), WIDTH), np.float32)
    order = np.argsort(place, kind="stable") if len(trigram) > BLOCK else None
    for at in range(0, len(trigram), BLOCK):
        code = trigram[at:at + BLOCK]
        bound = np.roll(vectors, 2, axis=1)[code // used // used] * np.roll(vectors, 1, axis=1)[code // used % used] * vectors[code % used]
        if order is None:
            mine = slice(None)
        else:
            lo, hi = np.searchsorted(place, (at, at + BLOCK), sorter=order)
            mine = order[lo:hi]
        counts = np.bincount(of_row[mine] * len(code) + place[mine] - at, minlength=len(texts) * len(code)).reshape(len(texts), len(code))
        out += counts.astype(np.float32) @ bound.astype(np.float32)
    return out, count


def _by_table(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """np.unique with inverse for code points under 2**16, without sorting."""
    seen = np.zeros(1 << 16, bool)
    seen[points] = True
    kinds = np.flatnonzero(seen)
    number = np.zeros(1 << 16, np.int64)
    number[kinds] = np.arange(len(kinds))
    return kinds.astype(np.uint32), number[points]


def profile_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}

    def flush() -> pa.RecordBatch:
        names = list(sums)
        rows = [np.rint(sums[n]).astype(np.int64).tolist() for n in names]
        sums.clear()
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(rows, pa.list_(pa.int64()))], ["lang", "bundle"])

    for batch in slices(batches, most=1 << 18):
        made, _ = bundles(batch.column("text").to_pylist())
        langs = np.array(batch.column("lang").to_pylist(), object)
        for lang in dict.fromkeys(langs.tolist()):
            sums[lang] = sums.get(lang, 0.0) + made[langs == lang].sum(axis=0, dtype=np.float64)
        if len(sums) > 64:
            yield flush()
    if sums:
        yield flush()


def profiles(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their unit profiles, from all documents given; summed by (language, dimension) in Spark."""
    parts = docs.select(F.col("text").cast("string"), F.col("lang").cast("string")).where("lang is not null and text is not null").mapInArrow(profile_batches, "lang string, bundle array<bigint>")
    cells = parts.select("lang", F.posexplode("bundle").alias("dim", "value")).groupBy("lang", "dim").agg(F.sum("value").alias("value"))
    rows = cells.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dim", "value"))).alias("x")).select("lang", F.transform("x", lambda c: c["value"]).alias("x")).orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    made = np.array([r["x"] for r in rows], float).reshape(len(rows), WIDTH)
    return [r["lang"] for r in rows], made / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-9)


def predict_batches(langs: list[str], unit: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    unit = unit.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 18):
            made, letters = bundles(batch.column("text").to_pylist())
            known = (letters > 0) & bool(langs)
            cosine = made @ unit.T / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-9) if langs else np.zeros((len(made), 1))
            best = cosine.argmax(axis=1)
            names = [langs[b] if k else "und" for b, k in zip(best.tolist(), known.tolist(), strict=True)]
            score = np.where(known, np.clip(cosine.max(axis=1), 0, 1), 0.0).astype(float)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score (cosine, 0 to 1).

    Profiles come from rows with a language whose crc32(doc_id) mod 4 is not 2. A text that is null or has no letter, or any text if
    nothing could be learned, is "und" with score 0. Equal cosines go to the language first in order. Repeated rows are learned and predicted each;
    a null doc_id counts as the empty text in the fold. Other columns are ignored.
    """
    own = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.col("lang").cast("string"), (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"))
    langs, unit = profiles(own.where(~F.col("held_out")))
    return own.select("doc_id", "text", "held_out").mapInArrow(predict_batches(langs, unit), "doc_id bigint, held_out boolean, lang_pred string, score double")
