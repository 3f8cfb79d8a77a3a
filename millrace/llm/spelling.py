"""Spelling variants of a vocabulary, found by search schemes over a bidirectional FM-index.

Words and their counts come from whole texts. Two words are near if one inserted, deleted or replaced code point turns one into the other. With one error at most, either the
first or the second half of a word stands unchanged in its near word. So two searches find all: match the first half exactly and extend to the right over the second with one
error; match the second half exactly and extend to the left over the first. Both run on an index of the delimited vocabulary, ``|word|word|…|``, that keeps the suffix-rank
intervals of a pattern in the text and of its reverse in the reversed text in step, so that it can be extended at either end.

The vocabulary is not indexed whole. Words that share a half exactly are brought together by that half, so every task indexes the few whole groups it holds, at most SHARD words at
once; a half that more words share is cut into sub-groups, each searched for all words of the half in blocks.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import store
from millrace.llm.textbatch import LOWER, flat, hash_spans, slices, spans

SHORTEST, LEAST_COUNT, RATIO = 7, 2, 10  # code points of a word, occurrences of a word, of its form
CORRUPTED = 31
SHARD = 1 << 17  # words indexed at once
QUERIES = 1 << 13  # words searched at once
CELLS = 1 << 20  # code points of words searched at once
LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3]] = True  # 0xC3 leads U+00C0 to U+00FF and nothing else
PAIRS = "word string, near string, near_n bigint"


def _taken(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte spans as a string column."""
    size = ends - starts
    done = np.cumsum(size)
    body = data[np.repeat(starts - (done - size), size) + np.arange(done[-1] if len(done) else 0)]
    return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(np.r_[0, done].astype(np.int64)), pa.py_buffer(body)]).cast(pa.string())


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of at least SHORTEST code points with their occurrences, one row per result and slice."""
    for batch in slices(batches):
        data, offsets = flat(batch.column("text"))
        inside = LETTER[data]
        inside[1:] |= data[:-1] == 0xC3
        starts, ends = spans(inside, offsets)
        points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
        long = points[ends] - points[starts] >= SHORTEST
        starts, ends = starts[long], ends[long]
        if not len(starts):
            continue
        lower = LOWER[data]
        code, row = hash_spans(lower, starts, ends), np.searchsorted(offsets, starts, side="right") - 1
        order = np.lexsort((code, row))
        edge = np.flatnonzero(np.r_[True, (np.diff(row[order]) != 0) | (np.diff(code[order]) != 0)])
        at, times = order[edge], np.diff(np.r_[edge, len(order)])  # each different run of each document
        ids = ["" if i is None else str(i) for i in batch.column("doc_id").to_pylist()]
        states = [zlib.crc32(f"{i}:".encode()) for i in ids]
        raw = lower.tobytes()
        hits = [zlib.crc32(raw[a:b], states[r]) for a, b, r in zip(starts[at].tolist(), ends[at].tolist(), row[at].tolist(), strict=True)]
        hits = np.array(hits, np.uint32)
        cut = hits % CORRUPTED == 0
        changed: Counter[str] = Counter()
        for k in np.flatnonzero(cut).tolist():
            run = raw[starts[at[k]]:ends[at[k]]].decode("utf-8")
            place = int(hits[k]) % len(run)
            if len(run) > SHORTEST:
                changed[run[:place] + run[place + 1:]] += int(times[k])
        plain = np.flatnonzero(~cut)
        _, first, inverse = np.unique(code[at[plain]], return_index=True, return_inverse=True)
        total = np.bincount(inverse, times[plain], len(first)).astype(np.int64)
        chosen = at[plain][first]
        yield pa.RecordBatch.from_arrays([_taken(lower, starts[chosen], ends[chosen]), pa.array(total)], ["word", "n"])
        yield pa.RecordBatch.from_arrays([pa.array(list(changed), pa.string()), pa.array(list(changed.values()), pa.int64())], ["word", "n"])


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n of all words of enough code points and occurrences."""
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    found = texts.mapInArrow(count_batches, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= LEAST_COUNT)


class Wavelet:
    """Wavelet matrix of a symbol array: ranks of many (symbol, interval) pairs at once."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.bits, self._planes, left = bits, [], symbols
        for level in range(bits - 1, -1, -1):
            bit = (left >> level & 1).astype(bool)
            words = np.packbits(np.r_[bit, np.zeros(-len(bit) % 64 + 64, bool)], bitorder="little").view(np.uint64)
            ones = np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)]
            zeros = len(bit) - int(bit.sum())
            self._planes.append((words, ones, zeros))
            left = np.concatenate([left[~bit], left[bit]])
        change = np.flatnonzero(np.r_[True, left[1:] != left[:-1]])
        self._first = np.zeros(1 << bits, np.int64)  # where each symbol begins in the last level
        self._first[left[change]] = change

    @staticmethod
    def _rank(plane: tuple, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        words, ones, _ = plane
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        return ones[word] + np.bitwise_count(words[word] & ((np.uint64(1) << rest) - np.uint64(1)))

    def narrow(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rank of the symbol at lo, its count in [lo, hi), and the count of smaller symbols there."""
        smaller = np.zeros(len(lo), np.int64)
        for level, plane in zip(range(self.bits - 1, -1, -1), self._planes, strict=True):
            one = (symbol >> level & 1).astype(bool)
            lo1, hi1 = self._rank(plane, lo), self._rank(plane, hi)
            lo0, hi0 = lo - lo1, hi - hi1
            smaller += np.where(one, hi0 - lo0, 0)
            lo, hi = np.where(one, plane[2] + lo1, lo0), np.where(one, plane[2] + hi1, hi0)
        return lo - self._first[symbol], hi - lo, smaller

    def children(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All (interval, symbol) with the symbol in the interval: number of the interval, symbol, rank at lo, count, count of smaller symbols."""
        owner, symbol, smaller = np.arange(len(lo)), np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        for plane in self._planes:
            lo1, hi1 = self._rank(plane, lo), self._rank(plane, hi)
            lo0, hi0 = lo - lo1, hi - hi1
            zero, one = np.flatnonzero(hi0 > lo0), np.flatnonzero(hi1 > lo1)
            smaller = np.concatenate([smaller[zero], smaller[one] + (hi0 - lo0)[one]])
            owner, symbol = np.concatenate([owner[zero], owner[one]]), np.concatenate([symbol[zero] << 1, symbol[one] << 1 | 1])
            lo, hi = np.concatenate([lo0[zero], plane[2] + lo1[one]]), np.concatenate([hi0[zero], plane[2] + hi1[one]])
        return owner, symbol, lo - self._first[symbol], hi - lo, smaller


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling the compared length; the last symbol must be the only smallest one."""
    rank, width, n = text.astype(np.int64), 1, len(text)
    while True:
        second = np.zeros(n, np.int64)
        second[:max(n - width, 0)] = rank[width:] + 1
        key = rank * (int(second.max()) + 1) + second
        order = np.argsort(key)
        new = np.r_[0, np.cumsum(np.diff(key[order]) != 0)]
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        width *= 2


END, MARK = 0, 1  # symbols: end of the text, delimiter; letters follow
RIGHT, LEFT = 0, 1


class BidirectionalIndex:
    """FM-index of ``|word|word|…|`` and of its reverse. A state is (begin in the suffix order, begin in the order of the reverse, number of occurrences)."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        joined = np.frombuffer(("|" + "|".join(words) + "|").encode("utf-32-le"), "<u4").astype(np.int64)
        alphabet = np.unique(joined[joined != ord("|")])
        self._alphabet = alphabet
        text = np.where(joined == ord("|"), MARK, np.searchsorted(alphabet, joined) + 2)
        bits = max(int(len(alphabet) + 1).bit_length(), 1)
        size = np.bincount(text, minlength=1 << bits)
        size[END] = 1
        self._before = np.cumsum(size) - size
        self._sides = {}
        for side, body in ((LEFT, text), (RIGHT, text[::-1])):
            whole = np.r_[body, END]
            order = suffix_array(whole)
            self._sides[side] = Wavelet(whole[order - 1], bits)
            if side == LEFT:
                self._suffix = order
        self.length = len(text) + 1
        self._owner = np.cumsum(text == MARK) - 1  # word that begins after each delimiter

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points; those outside the alphabet are -1."""
        at = np.minimum(np.searchsorted(self._alphabet, points), max(len(self._alphabet) - 1, 0))
        return np.where(self._alphabet[at] == points, at + 2, -1) if len(self._alphabet) else np.full(len(points), -1)

    def start(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, self.length)

    def extend(self, state: tuple, symbol: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each pattern with one symbol more at its side; unknown symbols occur nowhere."""
        own, other, size = state[side == RIGHT], state[side == LEFT], state[2]
        known = np.maximum(symbol, END)
        rank, count, smaller = self._sides[side].narrow(known, own, own + size)
        own, other, count = self._before[known] + rank, other + smaller, np.where(symbol < 0, 0, count)
        return (own, other, count) if side == LEFT else (other, own, count)

    def branch(self, state: tuple, side: int) -> tuple[np.ndarray, np.ndarray, tuple]:
        """All letters that extend each pattern at its side: number of the pattern, letter, new state."""
        own, other, size = state[side == RIGHT], state[side == LEFT], state[2]
        owner, symbol, rank, count, smaller = self._sides[side].children(own, own + size)
        own, other = self._before[symbol] + rank, other[owner] + smaller
        keep = symbol > MARK
        state = tuple(x[keep] for x in ((own, other, count) if side == LEFT else (other, own, count)))
        return owner[keep], symbol[keep], state

    def found(self, state: tuple) -> np.ndarray:
        """The word that each whole delimited pattern is."""
        return self._owner[self._suffix[state[0]]]


def _pick(state: tuple, at: np.ndarray) -> tuple:
    return tuple(x[at] for x in state)


def one_error(index: BidirectionalIndex, words: list[str], side: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, word of the index) of all words exactly one error away, the error on ``side`` of the middle, the other half unchanged.

    The unchanged half is matched from the middle outwards to its delimiter, then the pattern is extended over the other half to the delimiter there.
    """
    inner, outer = [], []
    for w in words:
        first, second = w[:len(w) // 2], w[len(w) // 2:]
        inner.append(first[::-1] if side == RIGHT else second)
        outer.append(second if side == RIGHT else first[::-1])
    exact, exact_n = _matrix(index, inner)
    rest, rest_n = _matrix(index, outer)
    n = len(words)
    state, live = index.start(n), np.arange(n)
    for k in range(int(exact_n.max())):
        go = k < exact_n[live]
        new = index.extend(_pick(state, live[go]), exact[live[go], k], 1 - side)
        for whole, part in zip(state, new, strict=True):
            whole[live[go]] = part
        live = live[state[2][live] > 0]
        if not len(live):
            break
    live = live[state[2][live] > 0]
    query, state = live, _pick(state, live)
    bad_query, bad_at, bad = np.zeros(0, np.int64), np.zeros(0, np.int64), tuple(np.zeros(0, np.int64) for _ in range(3))
    out = []
    k = 0
    while len(query) or len(bad_query):
        if len(bad_query):  # patterns with their error behind them go on exactly
            bad = index.extend(bad, rest[bad_query, bad_at], side)
            bad_at = bad_at + 1
            stay = bad[2] > 0
            done = stay & (bad_at == rest_n[bad_query])
            out.append((bad_query[done], index.found(_pick(bad, done))))
            stay &= ~done
            bad_query, bad_at, bad = bad_query[stay], bad_at[stay], _pick(bad, stay)
        if len(query):
            want, last = rest[query, k], k + 1 == rest_n[query]  # the last symbol is the delimiter
            owner, letter, child = index.branch(state, side)
            other = np.flatnonzero(letter != want[owner])
            replaced = other[~last[owner[other]]]
            dropped = np.flatnonzero(~last & (want != rest[query, np.minimum(k + 1, rest.shape[1] - 1)]))
            bad_query = np.concatenate([bad_query, query[owner[other]], query[owner[replaced]], query[dropped]])
            bad_at = np.concatenate([bad_at, np.full(len(other), k), np.full(len(replaced) + len(dropped), k + 1)])
            bad = tuple(np.concatenate([b, c[other], c[replaced], s[dropped]]) for b, c, s in zip(bad, child, state, strict=True))
            on = np.flatnonzero(~last)
            state = index.extend(_pick(state, on), want[on], side)
            query = query[on]
            left = state[2] > 0
            query, state = query[left], _pick(state, left)
            k += 1
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pair = np.unique(np.concatenate([q for q, _ in out]) * (len(index.words) + 1) + np.concatenate([w for _, w in out]))
    return pair // (len(index.words) + 1), pair % (len(index.words) + 1)


def _matrix(index: BidirectionalIndex, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the strings, each ended by the delimiter, one row a string, and their numbers."""
    size = np.array([len(s) for s in strings])
    flat_symbols = index.symbols(np.frombuffer("".join(strings).encode("utf-32-le"), "<u4").astype(np.int64))
    made = np.full((len(strings), int(size.max()) + 1), MARK, np.int64)
    done = np.cumsum(size)
    row = np.repeat(np.arange(len(strings)), size)
    made[row, np.arange(len(row)) - (done - size)[row]] = flat_symbols
    return made, size + 1


def search_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by side, half, sub-group and role, words to index before those to search. Whole groups are gathered to an index of about SHARD words; a sub-group has its own."""
    targets, queries, index, group, longest = {}, [], None, None, 0

    def run() -> pa.RecordBatch:
        nonlocal index, longest
        if index is None:
            index = BidirectionalIndex(list(targets))
        q, w = one_error(index, queries, group[0])
        rows = [(queries[a], index.words[b]) for a, b in zip(q.tolist(), w.tolist(), strict=True)]
        if group[0] == LEFT:  # a word that keeps the first half too is found on the other side
            rows = [(a, b) for a, b in rows if not b.startswith(a[:len(a) // 2])]
        queries.clear()
        longest = 0
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([targets[r[1]] for r in rows], pa.int64())], ["word", "near", "near_n"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("side", "half", "sub", "subs", "role", "word", "n")]
        for side, half, sub, subs, role, word, n in zip(*columns, strict=True):
            if (side, half, sub, subs) != group:
                if group is not None and (side != group[0] or subs > 1 or group[3] > 1 or len(targets) >= SHARD or index is not None):
                    if queries:
                        yield run()
                    targets, index = {}, None
                group = (side, half, sub, subs)
            if role == 0:
                targets[word] = n
                continue
            longest = max(longest, len(word))
            if queries and (len(queries) >= QUERIES or (len(queries) + 1) * longest > CELLS):
                yield run()
                longest = len(word)
            queries.append(word)
    if queries:
        yield run()


def near_pairs(vocab: DataFrame) -> DataFrame:
    """(word, near, near_n) of all pairs of words exactly one error apart, each in both directions, once."""
    first, second = (lambda n: F.expr(f"left(word, {n})")), (lambda n: F.expr(f"right(word, {n})"))
    half, up = "char_length(word) div 2", "(char_length(word) + 1) div 2"
    low, high = "(char_length(word) - 1) div 2", "(char_length(word) + 1) div 2"
    up_low, up_high = "char_length(word) div 2", "(char_length(word) + 2) div 2"
    keys = lambda side, texts: F.transform(F.array_distinct(F.array(*texts)), lambda t: F.struct(F.lit(side).alias("side"), t.alias("half")))
    targets = vocab.select("word", "n", F.inline(F.concat(keys(RIGHT, [first(low), first(half), first(high)]), keys(LEFT, [second(up_low), second(up), second(up_high)]))))
    queries = vocab.select("word", F.inline(F.concat(keys(RIGHT, [first(half)]), keys(LEFT, [second(up)]))))
    sizes = targets.groupBy("side", "half").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("subs"), F.count("*").alias("together")).where("together > 1").drop("together")
    held = targets.join(sizes, ["side", "half"]).select("side", "half", F.pmod(F.xxhash64("word"), F.col("subs")).cast("int").alias("sub"), "subs", F.lit(0).alias("role"), "word", "n")
    asked = queries.join(sizes, ["side", "half"]).select("side", "half", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub"), "subs", F.lit(1).alias("role"), "word", F.lit(0).cast("bigint").alias("n"))
    return held.unionByName(asked).repartition("side", "half", "sub").sortWithinPartitions("side", "half", "sub", "role", "word").mapInArrow(search_batches, PAIRS)


def variants(docs: DataFrame) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are runs of Latin letters of whole texts, A-Z lowered, of at least SHORTEST code points and LEAST_COUNT occurrences, one in CORRUPTED (document, run) having lost a code
    point. The form is the near word of largest n, ties by code-point order, if it occurs RATIO times as often; forms are followed to the root. Null and empty texts have no
    words, a null doc_id counts as the empty text in the hash; repeated rows count each; an empty table gives no rows; other columns are ignored.
    """
    vocab = store(vocabulary(docs), "vocabulary")
    near = near_pairs(vocab).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best"))
    judged = vocab.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.minus")).alias("near_n"))
    fits = F.col("near_n") >= RATIO * F.col("n")
    judged = store(judged.select("word", F.when(fits, F.col("near")).alias("form"), "n", "n_near", F.when(fits, F.col("near_n")).alias("form_n")), "forms")
    roots = judged.where("form is not null").select("word", F.col("form").alias("root"))
    longest = judged.agg(F.max(F.floor(F.log10("n")))).first()[0] or 0  # each link multiplies n by RATIO at least, so no chain has more
    reach = 1
    while reach < longest:  # each round doubles the links followed
        roots = roots.join(roots.select(F.col("word").alias("root"), F.col("root").alias("top")), "root", "left").select("word", F.coalesce("top", "root").alias("root"))
        reach *= 2
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
