"""Token files, spelling variants and the filter audit against plain versions, on the smallest tables and on odd rows."""

import io
import itertools
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from compare import compare, duck
from conftest import SF
from pyspark.sql import functions as F
from test_operators import LOW, ODD, SCHEMA, WORD

from millrace.llm import audit, spelling, tokenfiles, tokenids
from millrace.llm.queries import QUERIES, SQL
from millrace.llm.tables import table

CLASHES = ["start", "ids", "n_tokens", "code", "word", "n", "form", "near", "half", "part", "mask", "digest", "good", "prefix", "least", "path", "place"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None if k % 3 == 0 else "en", "s", len(t or "")) for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("x") for n in CLASHES})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenids.json_vocabulary())
    return lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def check_tokens(got, rows, plain):
    """Rows in file order give back every id; ids of a doc_id stand together, null ids first."""
    got = sorted(got, key=lambda r: r["start"])
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in got) == Counter((i, packed(plain(t))) for i, t in rows)
    assert [r["doc_id"] for r in got] == sorted([i for i, _ in rows], key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] * 4 == len(r["ids"])
        at += r["n_tokens"]


def test_token_files(spark, plain):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    got = {r["doc_id"]: r for r in QUERIES["op11_tokens"](spark, SF).collect()}
    start = 0
    for i, t in sorted(rows):
        ids = plain(t)
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(packed(ids)))
        start += len(ids)
    assert len(got) == len(rows)


def test_token_files_odd(odd, none, plain):
    written = tokenfiles.write(odd)
    check_tokens(tokenfiles.read(written).collect(), ODD, plain)
    empty = tokenfiles.write(none)
    assert empty.count() == 0 and tokenfiles.read(empty).count() == 0 and tokenfiles.index(empty).count() == 0


def test_token_files_on_request(spark, plain, monkeypatch):
    """Asked for a few documents, readers open their files only and decompress their frames only."""
    rows = [(k, f"text number {k} " * (1 + k % 7)) for k in range(-50, 400)] + [(400, "long words " * 50000)]
    written = tokenfiles.write(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    index = tokenfiles.index(written)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in index.collect()) == [(i, len(plain(t))) for i, t in rows]
    want = {r["doc_id"]: (r["start"], bytes(r["ids"])) for r in tokenfiles.read(written).collect()}
    asked = index.where("doc_id in (-50, -3, 17, 18, 399, 400)")
    got = {r["doc_id"]: (r["start"], bytes(r["ids"])) for r in tokenfiles.fetch(asked.unionByName(asked)).collect()}
    assert got == {i: want[i] for i in (-50, -3, 17, 18, 399, 400)}
    reader = tokenfiles._opened(written.orderBy("part").first()["path"])
    opened = []
    whole = tokenfiles.Reader._frame
    monkeypatch.setattr(tokenfiles.Reader, "_frame", lambda self, number, raw: opened.append(number) or whole(self, number, raw))
    assert [p for p, _ in reader.documents(np.array([1, 3]))] == [1, 3] and opened == [1, 3]


def test_token_file_format(tmp_path):
    """The file is valid Zstandard as a whole, its table has the sizes, a long document has several frames and a damaged frame is found."""
    path = tmp_path / "x.zst"
    docs = [(5, np.arange(10, dtype=np.uint32)), (None, np.array([7], np.uint32)), (-9, np.arange(150000, dtype=np.uint32) % 50257)]
    writer = tokenfiles.Writer(pa.OSFile(str(path), "wb"), 2)
    for i, ids in docs:
        writer.add(i, ids)
    writer.close()
    raw = path.read_bytes()
    assert len(raw) == writer.n_bytes and struct.unpack("<IBI", raw[-9:]) == (1 + 1 + 3 + 1, 0x80, 0x8F92EAB1)
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert np.array_equal(np.frombuffer(whole, "<u2"), np.concatenate([x for _, x in docs]))
    reader = tokenfiles.Reader(pa.BufferReader(raw))
    assert reader.doc_ids == [5, None, -9] and all(np.array_equal(ids, docs[p][1]) for p, ids in reader.documents())
    assert [p for p, _ in reader.documents(np.array([2]))] == [2]
    for at in (12, len(raw) - 60, len(raw) - 3):
        broken = bytearray(raw)
        broken[at] ^= 0x41
        with pytest.raises((ValueError, zstandard.ZstdError, pa.ArrowInvalid, OSError)):
            list(tokenfiles.Reader(pa.BufferReader(bytes(broken))).documents())
    with pytest.raises(ValueError, match="seek table"):
        tokenfiles.Reader(pa.BufferReader(b"short"))


def test_part_cache_forgets_and_stays_right(plain):
    """A cache far smaller than the text gives the ids of whole texts."""
    cache, _ = tokenids.json_cache(tokenids.json_vocabulary())
    small = tokenids.PartCache(cache._encode, cache._bytes, most=20)
    rng = np.random.default_rng(4)
    for _ in range(30):
        texts = [" ".join(f"{'éa b'[rng.integers(4)]}{x}" for x in rng.integers(0, 60, rng.integers(0, 40))) + ["", " ", "　 x", "<|endoftext|>"][rng.integers(4)] for _ in range(5)]
        raw = [t.encode() for t in texts]
        ids, bounds = small.rows(np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(x) for x in raw])])
        assert [[*ids[a:b].tolist(), 0] for a, b in itertools.pairwise(bounds)] == [plain(t) for t in texts]
        assert len(small._keys) <= 20 + 200


def brute_words(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            at = h % len(run)
            n[run[:at] + run[at + 1:] if h % 31 == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def brute_near(words):
    """Pairs by enumeration of what is left when one code point is taken out, then a check of the distance."""
    words, by_cut, near = set(words), defaultdict(set), defaultdict(set)
    for w in words:
        for k in range(len(w)):
            by_cut[w[:k] + w[k + 1:]].add((w, k))
    for cut, holders in by_cut.items():
        for (a, j), (b, k) in itertools.combinations(holders, 2):
            if a != b and j == k:
                near[a].add(b)
                near[b].add(a)
        if cut in words:
            for w, _ in holders:
                near[cut].add(w)
                near[w].add(cut)
    return near


def brute_variants(rows):
    n = brute_words(rows)
    near = brute_near(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def variant_rows(df):
    return [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()]


@pytest.mark.parametrize("shard", [spelling.SHARD, 3])
def test_spelling(spark, monkeypatch, shard):
    """On the given table, and with halves that many words share cut into sub-groups."""
    monkeypatch.setattr(spelling, "SHARD", shard)
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    got = variant_rows(QUERIES["op12_spelling"](spark, SF))
    want = brute_variants(rows)
    assert set(got) == want and len(got) == len(want)
    assert sum(f is not None for _, f, *_ in want) > 5


def test_spelling_odd(spark, odd, none):
    got = variant_rows(spelling.variants(odd))
    assert set(got) == brute_variants(ODD) and len(got) == len(set(got))
    assert spelling.variants(none).count() == 0
    base = ["wonderful", "accommodate", "straße", "ÉCOLEÉCOLE", "aaaaaaaa", "÷×÷×÷×÷", "x" * 3000]
    rows = [(1, " ".join(base * 400))]
    for k, w in enumerate(base):  # every kind of one-error variant, variants of variants, ties
        edits = [w[:2] + w[3:], w[:4] + "q" + w[4:], "z" + w, w + "z", w[:-1], w[1:], w[:3] + "ü" + w[4:], w[:5] + "zz" + w[5:], w[1:] + "k"]
        rows += [(10 * k + 20 + j, f"{e} {e.upper()} 1{e}" * (1 + 9 * (j % 2))) for j, e in enumerate(edits)]
    got = variant_rows(spelling.variants(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert set(got) == brute_variants(rows) and len(got) == len(set(got))


def test_forms_are_followed_to_the_root(spark):
    """Chains of forms, each ten times rarer, longer than one doubling reaches."""
    words = ["abcdefgh"[:7] + "x" * k for k in range(1, 5)]
    rows = [(k, " ".join([w] * (n // 4))) for w, n in zip(words, (13500, 900, 60, 4), strict=True) for k in range(4)]
    want = brute_variants(rows)
    got = variant_rows(spelling.variants(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert set(got) == want and max(sum(1 for _ in iter_chain(w, {x: f for x, f, *_ in want})) for w in words) >= 4


def iter_chain(word, form):
    while word is not None:
        yield word
        word = form.get(word)


def test_bidirectional_index():
    """Intervals stay in step however a pattern is extended: counts, and words found, equal a plain search."""
    rng = np.random.default_rng(8)
    words = sorted({"".join(rng.choice(list("abcé"), rng.integers(2, 9))) for _ in range(60)})
    index, text = spelling.BidirectionalIndex(words), "|" + "|".join(words) + "|"
    for _ in range(200):
        at = int(rng.integers(0, len(text) - 1))
        lo = hi = at
        state = index.start(1)
        while 0 < lo and hi < len(text) and hi - lo < 7:
            side = spelling.LEFT if rng.random() < 0.5 else spelling.RIGHT
            lo, hi, new = (lo - 1, hi, text[lo - 1]) if side == spelling.LEFT else (lo, hi + 1, text[hi])
            symbol = np.array([spelling.MARK]) if new == "|" else index.symbols(np.array([ord(new)]))
            state = index.extend(state, symbol, side)
            pattern = text[lo:hi]
            assert state[2][0] == sum(text.startswith(pattern, k) for k in range(len(text)))
            if pattern[0] == "|" and pattern[-1] == "|" and len(pattern) > 1 and pattern.count("|") == 2:
                assert words[index.found(state)[0]] == pattern[1:-1]
            owner, letters, states = index.branch(state, spelling.RIGHT)
            for letter, count in zip(letters.tolist(), states[2].tolist(), strict=True):
                more = pattern + chr(index._alphabet[letter - 2])
                assert count == sum(text.startswith(more, k) for k in range(len(text)))
    assert index.symbols(np.array([ord("q")]))[0] == -1


def brute_audit(rows, good, toxic):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    docs = []
    for i, t, lang in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}
        docs.append((lang or "", {x for x, f in fails.items() if f}, i in good, i in toxic))
    out, share = {}, Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {p for p, *_ in docs}:
            left = [d for d in docs if d[0] == part]
            gone = []
            for step, letter in enumerate(order, 1):
                hit = [d for d in left if letter in d[1]]
                row = [len(left) - len(hit), len(hit), sum(letter in d[1] for d in gone), sum(d[1] == {letter} for d in docs if d[0] == part), sum(d[2] for d in hit), sum(d[3] for d in hit)]
                left, gone = [d for d in left if letter not in d[1]], gone + hit
                out[part, order, step] = row
                share[part, letter] += len(hit)
    return {(*k, *v, share[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit(spark):
    for sf in (SF, SF.replace("0.001", "0.01")):
        assert not compare(QUERIES["op13_interactions"](spark, sf), duck(sf), SQL["op13_interactions"])
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in table(spark, SF, "documents").collect()]
    labels = table(spark, SF, "labels").collect()
    got = [tuple(r) for r in QUERIES["op13_interactions"](spark, SF).collect()]
    assert set(got) == brute_audit(rows, {r["doc_id"] for r in labels if r["quality"] == 1}, {r["doc_id"] for r in labels if r["toxic"] == 1})
    assert len(got) == 600 * len({r[2] for r in rows})


def test_filter_audit_odd(spark, odd, none):
    labels = spark.createDataFrame([(6, 0, 1), (6, 1, None), (None, 1, 1), (7, None, 1), (99, 1, 1), (4, 1, 0), (4, 1, 0)], "doc_id bigint, quality int, toxic int").withColumn("good", F.lit("x"))
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in odd.collect()]
    got = [tuple(r) for r in audit.interactions(odd, labels).collect()]
    assert set(got) == brute_audit(rows, {6, 4}, {6, 7}) and len(got) == 1200
    assert audit.interactions(none, labels).count() == 0 and audit.interactions(odd, labels.where("false")).count() == 1200


def test_filter_audit_needs_few_rows_in_the_recursion(spark, odd, none):
    """More parts than the recursion may have rows for: it walks masks, not parts."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("A # a").alias("text"), F.col("id").cast("string").alias("lang"))
    got = audit.interactions(docs, none.selectExpr("doc_id", "1 as quality", "1 as toxic"))
    assert got.count() == 400 * 600 and got.agg(F.sum("removed")).first()[0] == 120 * 400
