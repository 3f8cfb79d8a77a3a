"""Packing documents into sequences with lexical neighbours: a sharded BM25 inverted index picks what follows a seed.

Each text is tokenized once. Full sequences are cut off its front; the rest, less than a sequence, is a tail. Tails are range-partitioned by a
MinHash of their ids, then by doc_id, so that related tails lie together and a key shared by many is split; every run of SHARD tails is a
shard with its own inverted index, held by one task at a time. In a shard the seed is the remainder of the tail cut last, or the
first unused tail; the index ranks the others by BM25 and unused neighbours that fit are taken in that order, the best one left is cut to fill
the sequence exactly. What is left at the end of a shard is cut into power-of-two lengths, which need no padding.
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import store
from millrace.llm.textbatch import flat, mix, slices
from millrace.llm.tokenids import PartCache, once_a_worker

LENGTH, END_ID, SHARD = 2048, 1, 512
K1, B = 1.2, 0.75
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
TAIL = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, place bigint, ids binary"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Rank merging, which gives the ids of the vocabulary's JSON form at a third of the time; the JSON's added tokens are cut out first."""

    def __init__(self, vocabulary: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        form = vocabulary.removesuffix(".tiktoken") + ".json"
        added = []
        if os.path.exists(form):
            with open(form, encoding="utf-8") as f:
                added = json.load(f)["added_tokens"]
        odd = [t["content"] for t in added if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or any(c.isspace() for c in t["content"])]
        if odd:
            raise ValueError(f"added tokens that depend on the text around them: {odd}")
        self.added = [t["content"] for t in added]
        ids = {**ranks, **{t["content"].encode(): t["id"] for t in added}}
        self.token_bytes = np.zeros(max(ids.values()) + 1, np.int64)
        self.token_bytes[list(ids.values())] = [len(t) for t in ids]
        self._ranks = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={t["content"]: t["id"] for t in added})

    def encode_ordinary(self, text: str) -> list[int]:
        """The ids that the JSON form gives when it adds nothing at the ends: an added token in the text is one id."""
        if any(t in text for t in self.added):
            return self._ranks.encode(text, allowed_special="all")
        return self._ranks.encode_ordinary(text)


def encoder(vocabulary: str) -> Encoder:
    return once_a_worker(("rank encoder", vocabulary), lambda: Encoder(vocabulary))


def part_cache(vocabulary: str) -> PartCache:
    made = encoder(vocabulary)
    return once_a_worker(("rank parts", vocabulary), lambda: PartCache(lambda texts: [made.encode_ordinary(t) for t in texts], made.token_bytes))


def tokenize(column: pa.Array, vocabulary: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows, concatenated, and the row bounds: each different part of text is encoded once per Python worker while the cache holds it."""
    ids, bounds = part_cache(vocabulary).rows(*flat(column))
    return ids.astype(np.int64), bounds


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def cut_batches(vocabulary: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = mix(np.arange(1 << 17, dtype=np.uint64))
        for batch in slices(batches, most=4 << 20):
            ids, bounds = tokenize(batch.column("text"), vocabulary)
            out = []
            for r, doc in enumerate(batch.column("doc_id").to_pylist()):
                own = np.append(ids[bounds[r]:bounds[r + 1]], END_ID)
                for a in range(0, len(own), LENGTH):
                    piece = own[a:a + LENGTH]
                    whole = len(piece) == LENGTH
                    place = int(code[piece].min().view(np.int64)) if not whole else int(mix(np.array([((doc or 0) + a) % 2**64], np.uint64))[0].view(np.int64))
                    out.append((doc, a, len(piece), crc(piece) if whole else 0, len(own), place, None if whole else piece.astype("<u4" if own.max() > 65535 else "<u2").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], pa.binary() if i == 6 else pa.int64()) for i in range(7)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "place", "ids"],
            )

    return run


class Index:
    """Inverted index of one shard: postings by term with their BM25 weight."""

    def __init__(self, tails: list[np.ndarray]) -> None:
        found = [np.unique(t, return_counts=True) for t in tails]
        self.terms = [f[0] for f in found]
        term = np.concatenate(self.terms)
        tf = np.concatenate([f[1] for f in found]).astype(float)
        doc = np.repeat(np.arange(len(tails)), [len(t) for t in self.terms])
        length = np.array([len(t) for t in tails], float)
        order = np.argsort(term, kind="stable")
        self.vocabulary, start, df = np.unique(term[order], return_index=True, return_counts=True)
        idf = np.log1p((len(tails) - df + 0.5) / (df + 0.5))
        self.doc, tf, self.start, self.df = doc[order], tf[order], start, df
        self.weight = np.repeat(idf, df) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[self.doc] / length.mean()))
        self.n = len(tails)

    def ranked(self, seed: int) -> np.ndarray:
        """All documents of the shard, the closest to the seed first; ties in shard order."""
        at = np.searchsorted(self.vocabulary, self.terms[seed])
        size = self.df[at]
        place = np.repeat(self.start[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.argsort(-np.bincount(self.doc[place], self.weight[place], self.n), kind="stable")


def fill(tails: list[np.ndarray]) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of one shard as lists of (tail, first id, number of ids); together they use every id once."""
    index, size = Index(tails), [len(t) for t in tails]
    unused, carry, first = np.ones(len(tails), bool), None, 0
    while True:
        if carry is None:
            while first < len(tails) and not unused[first]:
                first += 1
            if first == len(tails):
                return
            seed, begin = first, 0
        else:
            seed, begin = carry
        unused[seed] = False
        sequence, left, carry = [(seed, begin, size[seed] - begin)], LENGTH - (size[seed] - begin), None
        order = index.ranked(seed)
        order = order[unused[order]]
        rest = []
        for c in order.tolist():
            if size[c] <= left:
                sequence.append((c, 0, size[c]))
                unused[c] = False
                left -= size[c]
                if not left:
                    break
            else:
                rest.append(c)
        if left and rest:
            sequence.append((rest[0], 0, left))
            carry = (rest[0], left)
            left = 0
        if not left:
            yield sequence
            continue
        yield from _powers(sequence, LENGTH - left)


def _powers(sequence: list[tuple[int, int, int]], total: int) -> Iterator[list[tuple[int, int, int]]]:
    """Cut a short sequence into sequences of power-of-two length, the longest first."""
    pieces = list(sequence)
    while total:
        room = 1 << total.bit_length() - 1
        total -= room
        out = []
        while room:
            doc, begin, n = pieces.pop(0)
            take = min(n, room)
            out.append((doc, begin, take))
            room -= take
            if take < n:
                pieces.insert(0, (doc, begin + take, n - take))
        yield out


def pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 36
    shard: list[tuple] = []

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(7)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    def close() -> list[tuple]:
        nonlocal number
        tails, rows = [t[3] for t in shard], []
        for sequence in fill(tails):
            offset = 0
            for t, begin, n in sequence:
                doc, start, tokens, ids = shard[t]
                rows.append((doc, start + begin, n, crc(ids[begin:begin + n]), tokens, number, offset))
                offset += n
            number += 1
        shard.clear()
        return rows

    for batch in batches:
        rows = []
        columns = [batch.column(i) for i in range(batch.num_columns)]
        doc, start, length, own, tokens = (c.to_pylist() for c in columns[:5])
        for r, raw in enumerate(columns[6].to_pylist()):
            if raw is None:
                rows.append((doc[r], start[r], length[r], own[r], tokens[r], number, 0))
                number += 1
            else:
                shard.append((doc[r], start[r], tokens[r], np.frombuffer(raw, "<u4" if len(raw) == 4 * length[r] else "<u2").astype(np.int64)))
                if len(shard) == SHARD:
                    rows += close()
        if rows:
            yield table(rows)
    if shard:
        yield table(close())


def pack(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every row of ``docs`` is a document, repeated rows and null ids included; null and empty texts are the end id alone. Sequences hold 2048 ids,
    or a power of two, so nothing is padded. An empty table gives no pieces. Other columns are ignored.
    """
    cut = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(cut_batches(vocabulary or default_vocabulary()), TAIL)
    kept = store(cut, "tails")
    placed = kept.repartitionByRange("place", "doc_id", "start").sortWithinPartitions("place", "doc_id", "start", "ids_crc32", "ids")
    return placed.mapInArrow(pack_batches, PIECES)
