"""Token ids of whole texts, each different part of text encoded once per Python worker.

Texts are cut before white space that follows other text; no pre-token of the vocabulary's pattern spans such a place, so parts tokenize alike alone and
in place. The ids of parts are kept, by a 64-bit hash of the part, for the slices and tasks to come: at most MOST parts, those unused longest go first.
"""

from __future__ import annotations

import os
import sys
import types
from collections.abc import Callable
from typing import Any

import numpy as np

from millrace.llm.textbatch import hash_spans

MOST = 1 << 19  # parts kept; about 40 bytes each
JOINED = 1 << 16  # bytes of parts encoded at once
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
EncodeTexts = Callable[[list[str]], list[list[int]]]
SHELF = "millrace_worker_values"


def once_a_worker(key: tuple, make: Callable[[], Any]) -> Any:
    """The value of ``make()``, made once per Python worker. Code travels to the executors by value, so its own globals last for one task
    only, and a memoised function would travel by name; what is kept lies in a module of its own instead."""
    shelf = vars(sys.modules.setdefault(SHELF, types.ModuleType(SHELF)))
    if key not in shelf:
        shelf[key] = make()
    return shelf[key]


def chunks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of parts that tokenize alike alone and in place. Places after a character that may be white space beyond ASCII are left alone."""
    cut = np.zeros(len(data), bool)
    if not len(data):
        return np.zeros(0, np.int64)
    blank = BLANK[data]
    cut[1:] = blank[1:] & ~blank[:-1]
    far = np.flatnonzero(cut)
    far = far[data[far - 1] >= 0x80]
    two = data[np.maximum(far - 2, 0)]
    cut[far[np.isin(two, (0x80, 0x81, 0x9A, 0xC2))]] = False
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(cut)


class PartCache:
    """Ids of parts by hash. ``token_bytes`` gives the length in bytes of what each id stands for."""

    def __init__(self, encode: EncodeTexts, token_bytes: np.ndarray, most: int = MOST) -> None:
        self._encode, self._bytes, self._most, self._tick = encode, token_bytes, most, 0
        self._keys, self._begin = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._size, self._used = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._pool = np.zeros(0, np.uint32)

    def rows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, concatenated, and the row bounds."""
        starts = chunks(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        ends = np.r_[starts[1:], len(data)]
        code, first, inverse = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        self._learn(code, data, starts[first], ends[first])
        at = np.searchsorted(self._keys, code)
        self._tick += 1
        self._used[at] = self._tick
        begin, size = self._begin[at][inverse], self._size[at][inverse]
        done = np.cumsum(size)
        ids = self._pool[np.repeat(begin - (done - size), size) + np.arange(done[-1])]
        self._forget()
        return ids, np.r_[0, done][np.searchsorted(starts, offsets)]

    def _learn(self, code: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        at = np.searchsorted(self._keys, code)
        known = np.zeros(len(code), bool)
        inside = at < len(self._keys)
        known[inside] = self._keys[at[inside]] == code[inside]
        new = np.flatnonzero(~known)
        if not len(new):
            return
        ids, size = self._encode_parts(data, starts[new], ends[new])
        begin = len(self._pool) + np.cumsum(size) - size
        self._pool = np.concatenate([self._pool, ids])
        place = at[new]
        self._keys, self._begin = np.insert(self._keys, place, code[new]), np.insert(self._begin, place, begin)
        self._size, self._used = np.insert(self._size, place, size), np.insert(self._used, place, 0)

    def _encode_parts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each part and their number. Parts that begin with a blank and end in plain text are encoded in long joined texts: ids are dealt out by their lengths."""
        joins = BLANK[data[starts]] & ~BLANK[data[ends - 1]] & (data[ends - 1] < 0x80)
        raw, size, made = data.tobytes(), np.zeros(len(starts), np.int64), [None] * len(starts)
        alone = np.flatnonzero(~joins).tolist()
        join = np.flatnonzero(joins)
        length = ends[join] - starts[join]
        group = (np.cumsum(length) - length) // JOINED
        runs = np.split(join, np.flatnonzero(np.diff(group)) + 1) if len(join) else []
        texts = [b"".join([raw[a:b] for a, b in zip(starts[r].tolist(), ends[r].tolist(), strict=True)]).decode("utf-8") for r in runs]
        for run, ids in zip(runs, self._encode(texts), strict=True):
            ids = np.array(ids, np.uint32)
            reach, want = np.cumsum(self._bytes[ids]), np.cumsum(ends[run] - starts[run])
            last = np.searchsorted(reach, want)
            if last[-1] >= len(reach) or not np.array_equal(reach[last], want):
                alone += run.tolist()
                continue
            size[run] = np.diff(np.r_[-1, last])
            for r, part in zip(run.tolist(), np.split(ids, last[:-1] + 1), strict=True):
                made[r] = part
        for r, ids in zip(alone, self._encode([raw[starts[r]:ends[r]].decode("utf-8") for r in alone]), strict=True):
            made[r], size[r] = np.array(ids, np.uint32), len(ids)
        return np.concatenate(made), size

    def _forget(self) -> None:
        if len(self._keys) <= self._most:
            return
        stay = np.flatnonzero(self._used > np.partition(self._used, len(self._used) // 2)[len(self._used) // 2])
        size = self._size[stay]
        begin = np.cumsum(size) - size
        self._pool = self._pool[np.repeat(self._begin[stay] - begin, size) + np.arange(size.sum())]
        self._keys, self._begin, self._size, self._used = self._keys[stay], begin, size, self._used[stay]


def json_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _json_cache(vocabulary: str) -> tuple[PartCache, int]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    n = tokenizer.get_vocab_size()
    lengths = np.array([len(tokenizer.id_to_token(i) or "") for i in range(n)], np.int64)  # one character a byte
    return PartCache(lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], lengths), n


def json_cache(vocabulary: str) -> tuple[PartCache, int]:
    """Parts encoded by the tokenizers library with a byte-level vocabulary in JSON form, and the size of the vocabulary."""
    return once_a_worker(("json parts", vocabulary), lambda: _json_cache(vocabulary))
