"""Secrets in texts: fixed base patterns, and weak candidates reported only where complementary credential parts lie close together.

One pass over each text finds the base spans and the weak parts. Weak parts (account names, unlabelled random strings, endpoints) then meet
in an interval join: parts of one text are laid on cells of one scope's length, each side looks into its own and the neighbouring cells, and
semi-joins keep a part as soon as one partner lies within the scope, so no pairs are produced. A weak secret needs an access identifier,
a weak identifier needs a secret, an endpoint needs both.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from millrace.llm.tables import store

SCOPE = 200  # code points between the starts of parts that belong together
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "weak", "identifier", "endpoint")  # also the order of kinds that start together
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{%d,}" % (LEAST_ACCESS - 4))  # a run too short in all is too short from any later place as well
HEX = re.compile(r"[0-9a-f]{%d,}" % LEAST_HEX)
WEAK = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9a-z+/_-]*[A-Z])(?=[0-9A-Z+/_-]*[a-z])[A-Za-z0-9+/_-]{16,}={0,2}")
LABELLED = re.compile(r"""\b(?:pass|pwd|passphrase|auth|private_?key|secret_?key|credentials?)["']?\x20*[:=]\x20*["']?([^\s"']{6,})""", re.IGNORECASE | re.ASCII)
IDENTIFIER = re.compile(r"""\b(?:user(?:name|_?id)?|login|account(?:_?id)?|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([^\s"',;]{3,})""", re.IGNORECASE | re.ASCII)
ENDPOINT = re.compile(r"""\b(?:[a-z][a-z0-9+.]{1,12}://[^\s"'<>]+|(?:host|server|endpoint|url)["']?\x20*[:=]\x20*["']?[^\s"',;]{4,})""", re.IGNORECASE | re.ASCII)
SPAN = "array<struct<start:bigint,rank:int,stop:bigint>>"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("stop", pa.int64())]))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def weak_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Parts that say little alone; those inside a base span are left out."""
    found = [(m.start(), 3, m.end()) for m in WEAK.finditer(text)] + [(m.start(), 3, m.end()) for m in LABELLED.finditer(text)]
    if not found and not base:
        return []  # without any secret nothing can be linked
    found += [(m.start(), 4, m.end()) for m in IDENTIFIER.finditer(text)] + [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    outside, at, reach = [], 0, -1
    for span in sorted(set(found)):
        while at < len(base) and base[at][0] <= span[0]:
            reach = max(reach, base[at][2])  # the farthest end of the base spans that start no later
            at += 1
        if span[2] > reach:
            outside.append(span)
    return outside


def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base = [base_spans(t or "") for t in batch.column("text").to_pylist()]
        weak = [weak_spans(t or "", b) for t, b in zip(batch.column("text").to_pylist(), base, strict=True)]
        of = lambda rows: pa.array([[{"start": a, "rank": k, "stop": e} for a, k, e in row] for row in rows], _SPAN)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), of(base), of(weak)], ["doc_id", "row_key", "base", "weak"])


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The same for rows equal in id and text, whose findings are equal too."""
    return F.md5(F.concat_ws("\x00", F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("-")), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))))


def _near(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` with a row of ``right`` in the same text whose start is at most SCOPE away."""
    cells = right.select(F.col("row_key").alias("r_key"), F.col("start").alias("r_start"), F.explode(F.array(*[F.floor(F.col("start") / SCOPE) + d for d in (-1, 0, 1)])).alias("r_cell"))
    close = (F.col("row_key") == F.col("r_key")) & (F.floor(F.col("start") / SCOPE) == F.col("r_cell")) & (F.abs(F.col("start") - F.col("r_start")) <= SCOPE)
    return left.join(cells, close, "left_semi")


def scan(docs: DataFrame) -> DataFrame:
    """Findings per row: doc_id, row_key, base (spans), linked (weak spans with complementary parts nearby).

    Null and empty texts have no findings. Repeated rows get equal findings, rows with a null doc_id theirs. Other columns are ignored.
    """
    found = store(
        docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), row_key().alias("row_key"))
        .mapInArrow(scan_batches, f"doc_id bigint, row_key string, base {SPAN}, weak {SPAN}"), "secrets",
    )
    parts = store(found.where(F.size("weak") > 0).select("row_key", F.explode(F.concat("base", "weak")).alias("s")).select("row_key", "s.*").distinct(), "parts")
    secrets, identifiers = parts.where("rank in (0, 2, 3)"), parts.where("rank in (1, 4)")
    linked = (
        _near(parts.where("rank = 3"), identifiers).unionByName(_near(parts.where("rank = 4"), secrets))
        .unionByName(_near(_near(parts.where("rank = 5"), secrets), identifiers))
    )
    per_row = linked.groupBy("row_key").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "stop"))).alias("linked"))
    return found.join(per_row, "row_key", "left").select("doc_id", "row_key", "base", F.coalesce("linked", F.array().cast(SPAN)).alias("linked"))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined, in order of start and kind."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


@pandas_udf(StringType())
def _masked(text: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.Series:
    def one(t, begin, end):
        if t is None:
            return None
        out, at = [], 0
        for a, b in zip(begin, end, strict=True):
            if b <= at:
                continue
            if a >= at:
                out.append(t[at:a])
                out.append("[SECRET]")
            at = b
        return "".join(out) + t[at:]

    return pd.Series([one(*x) for x in zip(text, starts, stops, strict=True)], dtype=object)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span replaced by [SECRET] and n_chars, if there, following; other rows and columns unchanged."""
    spans = scan(docs).where(F.size("base") + F.size("linked") > 0).select("row_key", F.sort_array(F.concat("base", "linked")).alias("spans")).dropDuplicates(["row_key"])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key().alias("row_key"))  # whole rows apart: no name can clash
    joined = rows.join(spans, "row_key", "left").select("row", "spans")
    hit = F.when(F.col("spans").isNotNull(), F.col("row.text"))
    clean = joined.withColumn("masked", _masked(hit, F.transform("spans", lambda s: s["start"]), F.transform("spans", lambda s: s["stop"])))
    new = {"text": F.coalesce("masked", "row.text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("masked").isNotNull(), F.char_length("masked").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return clean.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
