"""Near-duplicate documents by b-bit MinHash.

A document is the set of its distinct word shingles, as 64-bit hashes. Equal sets collapse first. Bands of full minima give
candidates; of each minimum only the low four bits are kept, packed into longs, and the similarity is estimated from the
number of equal nibbles, corrected for chance collisions. Beside the signature a set keeps the parity of its members in each of 2,048 cells:
two sets differ in at least as many members as in cells, which rules most pairs below the threshold out for certain. What may still
reach it is confirmed on full sets.

No bucket is expanded into all its pairs: its members are compared with one leader, connected, compared with a second leader where
a bucket still holds several components, and only members of different components that are left meet pairwise, estimate included in
the join; of the buckets a pair shares, only that of its first common band yields it. Pairs inside a component cannot change the result,
so no link between different texts that matters is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.tables import store
from millrace.llm.textbatch import list_column, mix, shingles, slices, split_words

BANDS, ROWS, BITS = 30, 5, 4  # a pair at 0.85 misses all bands with probability 2e-8, one at 0.8 with 7e-6
HASHES = 512  # the bands use the first BANDS * ROWS
LONGS = -(-HASHES * BITS // 64)
CELLS = 2048
CELL_LONGS = CELLS // 64
SLACK = 0.08  # about five standard deviations of the estimate
BLOCK = 1024
_RNG = np.random.default_rng(81)
FACTOR = (_RNG.integers(0, 2**32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
SHIFT = _RNG.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)[:, None]
PLACES = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))
SKETCH = "doc_id bigint, n_shingles bigint, set_key bigint, set_key2 bigint, signature array<bigint>, parity array<bigint>, bands array<bigint>"
SETS = "node bigint, shingles array<bigint>"


def minima(values: np.ndarray) -> np.ndarray:
    """Minimum of each permutation over a set of hashes, in blocks of bounded size."""
    low = values.astype(np.uint32)
    best = np.full(HASHES, 2**32 - 1, np.uint32)
    for a in range(0, len(low), BLOCK):
        np.minimum(best, (low[a:a + BLOCK] * FACTOR + SHIFT).min(axis=1), out=best)
    return best


def pack(best: np.ndarray) -> np.ndarray:
    """The low bits of the minima, packed into 64-bit words."""
    bits = (best[:, None] >> np.arange(BITS, dtype=np.uint32) & np.uint32(1)).astype(np.uint8).ravel()
    return np.packbits(np.r_[bits, np.zeros(LONGS * 64 - len(bits), np.uint8)], bitorder="little").view(np.int64)


def parities(own: np.ndarray) -> np.ndarray:
    """Whether each cell holds an odd number of the set's hashes, packed into 64-bit words."""
    odd = np.bincount(mix(own ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(64 - CELLS.bit_length() + 1), minlength=CELLS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def band_keys(best: np.ndarray) -> np.ndarray:
    return mix((mix(best[:BANDS * ROWS].astype(np.uint64) + PLACES) * PLACES).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64))


def _lists(parts: list[np.ndarray]) -> pa.Array:
    return list_column(np.concatenate(parts), np.r_[0, np.cumsum([len(p) for p in parts])])


def sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        values, bounds = shingles(split_words(batch.column("text")))
        size, keys, keys2, signs, cells, bands = [], [], [], [], [], []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            own = np.unique(values[a:b])
            size.append(len(own))
            keys.append(mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
            keys2.append(mix(own + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64))
            best = minima(own) if len(own) else None
            signs.append(pack(best) if len(own) else np.zeros(0, np.int64))
            cells.append(parities(own) if len(own) else np.zeros(0, np.int64))
            bands.append(band_keys(best) if len(own) else np.zeros(0, np.uint64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.array(size, np.int64)), pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(np.array(keys2, np.uint64).view(np.int64)),
             _lists(signs), _lists(cells), _lists(bands)],
            ["doc_id", "n_shingles", "set_key", "set_key2", "signature", "parity", "bands"],
        )


def set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        values, bounds = shingles(split_words(batch.column("text")))
        yield pa.RecordBatch.from_arrays([batch.column("node"), _lists([np.unique(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)])], ["node", "shingles"])


def sketches(docs: DataFrame) -> DataFrame:
    """One row per document: set size, set identity, packed signature, parities, band keys."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(sketch_batches, SKETCH)


def full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The full sets of ``nodes``, made again from their texts; equal rows give one set."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("node"), F.col("text").cast("string")).join(nodes, "node", "left_semi")
    once = Window.partitionBy("node", F.xxhash64("text")).orderBy("text")
    return texts.withColumn("copy", F.row_number().over(once)).where("copy = 1").select("node", "text").mapInArrow(set_batches, SETS)


def estimate(left: str = "l_signature", right: str = "r_signature") -> Column:
    """Similarity from equal nibbles, less the share 2**-bits that agree by chance."""
    mask = F.lit(0x1111111111111111)
    different = F.lit(0)
    for k in range(LONGS):
        x = F.col(left)[k].bitwiseXOR(F.col(right)[k])
        for shift in (2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        different = different + F.bit_count(x.bitwiseAND(mask))
    equal = (F.lit(HASHES) - different) / F.lit(HASHES)
    chance = 2.0**-BITS
    return (equal - chance) / (1 - chance)


def components(links: DataFrame) -> DataFrame:
    """(node, component_id) of every node with a link (src, dst): alternating large-star and small-star steps on edges only."""
    edges = store(links.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u <> v").distinct(), "edges")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        edges = store(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
    tops = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component_id")).unionByName(tops.select(F.col("v").alias("node"), F.col("v").alias("component_id")))


def _stars(edges: DataFrame) -> bool:
    """Whether each larger end has one smaller end, which is itself no larger end of another edge."""
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("up")).unionByName(edges.select(F.col("v").alias("node"), F.lit(None).cast("bigint").alias("up")))
    per = ends.groupBy("node").agg(F.min("up").alias("lo"), F.max("up").alias("hi"), F.count_if(F.col("up").isNull()).alias("below"))
    return per.where("lo <> hi or (lo is not null and below > 0)").isEmpty()


def apart(left: str = "l_parity", right: str = "r_parity") -> Column:
    """Cells of different parity: never more than the members that two sets do not share."""
    count = F.lit(0)
    for k in range(CELL_LONGS):
        count = count + F.bit_count(F.col(left)[k].bitwiseXOR(F.col(right)[k]))
    return count


def _alike(percent: int) -> Column:
    """Sizes and parities that allow the threshold, and an estimate within the slack of it."""
    low, high = F.least("l_n", "r_n"), F.greatest("l_n", "r_n")
    allowed = apart() * (100 + percent) <= (low + high) * (100 - percent)  # of n + m members, d not shared: the similarity is (n + m - d) / (n + m + d)
    return (low * 100 >= high * percent) & allowed & (estimate() >= percent / 100 - SLACK)


def _side(nodes: DataFrame, side: str, *extra: str) -> DataFrame:
    names = {"node": side, "n_shingles": f"{side}_n", "signature": f"{side}_signature", "parity": f"{side}_parity", "shingles": f"{side}_shingles"}
    return nodes.select(*[F.col(c).alias(names.get(c, c)) for c in ("node", *extra)])


def likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (l, r) whose sketches allow the threshold."""
    both = pairs.join(_side(nodes, "l", "n_shingles", "signature", "parity"), "l").join(_side(nodes, "r", "n_shingles", "signature", "parity"), "r")
    return both.where(_alike(percent)).select("l", "r")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (l, r) whose full sets reach the threshold, as links (src, dst)."""
    full = pairs.join(_side(sets, "l", "shingles"), "l").join(_side(sets, "r", "shingles"), "r")
    common = F.size(F.array_intersect("l_shingles", "r_shingles"))
    union = F.size("l_shingles") + F.size("r_shingles") - common
    return full.where(common * 100 >= union * percent).select(F.col("l").alias("src"), F.col("r").alias("dst"))


def _grown(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components after new links: the stars found so far stand for all links before."""
    return components(comps.select(F.col("node").alias("src"), F.col("component_id").alias("dst")).unionByName(links))


def _mixed(banded: DataFrame, comps: DataFrame) -> DataFrame:
    """Band rows of buckets that still hold several components, each with its component."""
    rows = banded.join(comps, "node", "left").withColumn("comp", F.coalesce("component_id", "node")).drop("component_id")
    several = rows.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket")
    return rows.join(several, "bucket", "left_semi")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id (smallest linked doc_id, its own included), kept.

    Documents are linked if 100 * |A ∩ B| >= percent * |A ∪ B| over distinct 5-word shingles of the lower-cased (A-Z) text.
    Null, empty and word-free texts have no shingles and are linked with nothing. A null doc_id cannot be named: such a row keeps a null
    component and is kept. Repeated rows are copies of one node; rows sharing a doc_id but not the text count as one vertex of the graph.
    Other columns of ``docs`` are ignored, whatever their names.
    """
    made = store(sketches(docs), "sketches")
    slim = made.select("doc_id", "n_shingles", "set_key", "set_key2")
    key = ["n_shingles", "set_key", "set_key2"]
    reps = store(slim.where("n_shingles > 0 and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("node"), F.count("*").alias("copies")), "reps")
    nodes = store(
        made.withColumnRenamed("doc_id", "node").join(reps.select("node", *key), ["node", *key], "left_semi")
        .groupBy("node", *key).agg(*[F.first(c).alias(c) for c in ("signature", "parity", "bands")]), "nodes",
    )
    spread = nodes.select("node", F.posexplode("bands").alias("band", "value")).select("node", F.xxhash64("band", "value").alias("bucket"))
    first = spread.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("other")).where("leader <> other")
    banded = store(spread.join(first, "bucket").select("bucket", "node", "leader"), "banded")
    sets = store(full_sets(docs, banded.select("node").distinct()), "sets")  # of documents that share a bucket with another text
    met = banded.where("node <> leader").select(F.col("leader").alias("l"), F.col("node").alias("r")).distinct()
    comps = store(components(confirm(likely(met, nodes, percent), sets, percent)), "comps")

    mixed = _mixed(banded.select("bucket", "node"), comps)
    order = F.xxhash64("bucket", "node")  # a leader of its own for each bucket
    second = mixed.groupBy("bucket").agg(F.min_by("node", order).alias("leader"), F.min_by("comp", order).alias("leader_comp"))
    again = mixed.join(second, "bucket").where("comp <> leader_comp").select(F.least("node", "leader").alias("l"), F.greatest("node", "leader").alias("r")).distinct()
    comps = store(_grown(comps, confirm(likely(again, nodes, percent), sets, percent)), "comps")

    kept = {"node": "", "comp": "comp", "n_shingles": "n", "signature": "signature", "parity": "parity", "bands": "bands"}
    rest = store(_mixed(banded.select("bucket", "node"), comps).join(nodes.select("node", *list(kept)[2:]), "node"), "rest")
    one, two = (rest.select("bucket", *[F.col(c).alias(f"{s}_{n}" if n else s) for c, n in kept.items()]) for s in ("l", "r"))
    # A pair that shares several buckets is taken in the one of its first common band.
    band = F.array_position(F.zip_with("l_bands", "r_bands", lambda a, b: a == b), True)
    first_common = F.col("bucket") == F.xxhash64((band - 1).cast("int"), F.get("l_bands", (band - 1).cast("int")))
    left = one.join(two, "bucket").where((F.col("l") < F.col("r")) & (F.col("l_comp") != F.col("r_comp")) & _alike(percent) & first_common).select("l", "r").distinct()
    comps = store(_grown(comps, confirm(left, sets, percent)), "comps")

    linked = reps.join(comps, "node", "left").select(*key, F.coalesce("component_id", "node").alias("component"))
    return slim.join(linked, key, "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"),
    )
