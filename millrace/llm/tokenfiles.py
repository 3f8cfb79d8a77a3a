"""Token ids in seekable Zstandard files: one or more independent frames per document, a document index and a trailing seek table.

A file is a run of Zstandard frames, each compressed on its own. A document has its own frames (several if it is longer than FRAME_IDS), so a reader
decompresses only the documents asked for. A skippable frame with the document index follows (an Arrow stream: doc_id, first frame, number of ids), then
the seek table of the seekable Zstandard format: sizes and the low half of XXH64 of every frame. Any Zstandard tool that takes the file whole gets all ids.

Documents are range-partitioned and sorted by doc_id; each partition writes one file or more under a name of its own, and the manifest, written by Spark
when tasks commit, names the files that count. Attempts that are lost leave a file that no manifest names.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.tables import store
from millrace.llm.textbatch import flat, slices
from millrace.llm.tokenids import json_cache, json_vocabulary
from millrace.session import scratch_path

END_ID = 0
FRAME_IDS = 1 << 16
FILE_IDS, FILE_DOCS = 1 << 28, 1 << 20  # a file is closed when it holds as many
READ_BYTES = 4 << 20  # read at once
# Fixed values of the seekable Zstandard format.
INDEX_MAGIC, TABLE_MAGIC, FOOTER_MAGIC, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])
FOOTER = 9
MANIFEST = "path string, part bigint, piece bigint, n_docs bigint, n_ids bigint, n_bytes bigint"
ROWS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"
INDEX = "doc_id bigint, start bigint, n_tokens bigint, path string, place bigint"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as a URI or a plain path."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class Writer:
    """Writes one file."""

    def __init__(self, sink, width: int) -> None:
        self._sink, self._type, self._pack = sink, f"<u{width}", zstandard.ZstdCompressor(level=3)
        self._entries, self._ids, self._first, self._counts = bytearray(), [], [], []
        self.n_ids = self.n_bytes = 0

    @property
    def n_docs(self) -> int:
        return len(self._ids)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._ids.append(doc_id)
        self._first.append(len(self._entries) // ENTRY.itemsize)
        self._counts.append(len(ids))
        self.n_ids += len(ids)
        for a in range(0, len(ids), FRAME_IDS):
            plain = ids[a:a + FRAME_IDS].astype(self._type).tobytes()
            self._frame(self._pack.compress(plain), len(plain), checksum(plain))

    def _frame(self, packed: bytes, plain: int, check: int) -> None:
        self._sink.write(packed)
        self.n_bytes += len(packed)
        self._entries += struct.pack("<III", len(packed), plain, check)

    def close(self) -> None:
        index = pa.record_batch({"doc_id": pa.array(self._ids, pa.int64()), "first_frame": pa.array(self._first, pa.int64()), "n_ids": pa.array(self._counts, pa.int64())})
        index = index.replace_schema_metadata({"type": self._type})
        buffer = pa.BufferOutputStream()
        with pa.ipc.new_stream(buffer, index.schema) as stream:
            stream.write_batch(index)
        body = buffer.getvalue().to_pybytes()
        self._frame(struct.pack("<II", INDEX_MAGIC, len(body)) + body, 0, 0)
        table = bytes(self._entries) + struct.pack("<IBI", len(self._entries) // ENTRY.itemsize, CHECKSUMS, FOOTER_MAGIC)
        self._sink.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)
        self.n_bytes += 8 + len(table)
        self._sink.close()


class Reader:
    """Reads the index of a file at once and documents on demand."""

    def __init__(self, source) -> None:
        self._source, size = source, source.size()
        count, flags, magic = struct.unpack("<IBI", source.read_at(FOOTER, size - FOOTER)) if size > FOOTER else (0, 0, 0)
        if magic != FOOTER_MAGIC or flags != CHECKSUMS or not count:
            raise ValueError("no seek table at the end of the file")
        begin = size - FOOTER - count * ENTRY.itemsize
        self._entries = np.frombuffer(source.read_at(count * ENTRY.itemsize, begin), ENTRY)
        self._offsets = np.r_[0, np.cumsum(self._entries["packed"].astype(np.int64))]
        head = source.read_at(int(self._entries["packed"][-1]), int(self._offsets[-2]))
        if self._offsets[-1] + 8 != begin or struct.unpack("<I", head[:4]) != (INDEX_MAGIC,):
            raise ValueError("seek table and document index do not fit the file")
        index = pa.ipc.open_stream(head[8:]).read_all()
        self._type = index.schema.metadata[b"type"].decode()
        self.doc_ids = index.column("doc_id").to_pylist()
        self.n_ids = index.column("n_ids").to_numpy()
        self._frames = np.r_[index.column("first_frame").to_numpy(), count - 1]
        self._unpack = zstandard.ZstdDecompressor()

    def documents(self, places: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(place, ids) of the documents at ``places`` (ascending; all by default); only their frames are read and decompressed."""
        places = np.arange(len(self.doc_ids)) if places is None else places
        k = 0
        while k < len(places):
            end = k + 1  # documents side by side are read together
            while end < len(places) and places[end] == places[end - 1] + 1 and self._offsets[self._frames[places[end] + 1]] - self._offsets[self._frames[places[k]]] <= READ_BYTES:
                end += 1
            first, last = self._frames[places[k]], self._frames[places[end - 1] + 1]
            base = self._offsets[first]
            raw = self._source.read_at(int(self._offsets[last] - base), int(base))
            for place in places[k:end].tolist():
                plain = b"".join(self._frame(f, raw[self._offsets[f] - base:self._offsets[f + 1] - base]) for f in range(self._frames[place], self._frames[place + 1]))
                yield place, np.frombuffer(plain, self._type)
            k = end

    def _frame(self, number: int, packed: bytes) -> bytes:
        entry = self._entries[number]
        plain = self._unpack.decompress(packed, max_output_size=int(entry["plain"]))
        if len(plain) != entry["plain"] or checksum(plain) != entry["check"]:
            raise ValueError(f"frame {number} does not match its checksum")
        return plain


def write_batches(folder: str, vocabulary: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        cache, n = json_cache(vocabulary)
        part, piece, writer, name = TaskContext.get().partitionId(), 0, None, ""

        def close() -> pa.RecordBatch:
            writer.close()
            row = {"path": [f"{folder}/{name}"], "part": [part], "piece": [piece], "n_docs": [writer.n_docs], "n_ids": [writer.n_ids], "n_bytes": [writer.n_bytes]}
            return pa.RecordBatch.from_pydict(row)

        for batch in slices(batches):
            ids, bounds = cache.rows(*flat(batch.column("text")))
            for r, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                if writer is None:
                    name = f"part-{part:06d}-{piece:04d}-{uuid.uuid4().hex}.ids.zst"
                    writer = Writer(system.open_output_stream(f"{path}/{name}", compression=None), 2 if max(n - 1, end_id) < 1 << 16 else 4)
                writer.add(doc_id, np.append(ids[bounds[r]:bounds[r + 1]], np.uint32(end_id)))
                if writer.n_ids >= FILE_IDS or writer.n_docs >= FILE_DOCS:
                    yield close()
                    writer, piece = None, piece + 1
        if writer is not None:
            yield close()

    return run


def write(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the ids of all documents, ascending by doc_id, and return the manifest: path, part, piece, n_docs, n_ids, n_bytes; (part, piece) is the order.

    Every row is a document, repeated rows and null ids (first) included; rows of one doc_id follow each other by a hash of their text. Null and empty texts are the end
    id alone. An empty table writes no file. Other columns are ignored. ``folder`` must be one that all executors reach; by default it is a new one in the shared folder.
    """
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("code"))
    placed = rows.repartitionByRange("doc_id", "code").sortWithinPartitions("doc_id", "code").select("doc_id", "text")
    return store(placed.mapInArrow(write_batches(folder, vocabulary or json_vocabulary(), end_id), MANIFEST), "token-manifest")


def _based(manifest: DataFrame) -> DataFrame:
    """One row per file with the number of ids in the files before it, each in a partition of its own."""
    before = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base")).repartition(max(manifest.count(), 1))


def _opened(path: str) -> Reader:
    system, inner = open_folder(path)
    return Reader(system.open_input_file(inner))


def _rows(reader: Reader, base: int, places: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    before = base + np.cumsum(reader.n_ids) - reader.n_ids
    at, made, size = [], [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([reader.doc_ids[p] for p in at], pa.int64()), pa.array(before[at], pa.int64()), pa.array(reader.n_ids[at], pa.int64()), pa.array(made, pa.binary())], ["doc_id", "start", "n_tokens", "ids"],
        )

    for place, ids in reader.documents(places):
        at.append(place)
        made.append(ids.astype("<u4").tobytes())
        size += len(made[-1])
        if size >= READ_BYTES:
            yield batch()
            at, made, size = [], [], 0
    if at:
        yield batch()


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
            yield from _rows(_opened(path), base, None)


def _read_indexes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
            reader = _opened(path)
            n = len(reader.doc_ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(reader.doc_ids, pa.int64()), pa.array(base + np.cumsum(reader.n_ids) - reader.n_ids), pa.array(reader.n_ids), pa.array([path] * n, pa.string()), pa.array(np.arange(n))],
                ["doc_id", "start", "n_tokens", "path", "place"],
            )


def _read_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by path and place; each file is opened once per run of its rows."""
    path, reader = None, None
    for batch in batches:
        paths, places, starts = (batch.column(c).to_pylist() for c in ("path", "place", "start"))
        k = 0
        while k < len(paths):
            end = k
            while end < len(paths) and paths[end] == paths[k]:
                end += 1
            if paths[k] != path:
                path, reader = paths[k], _opened(paths[k])
            place = np.array(places[k:end])
            base = starts[k] - int(reader.n_ids[:place[0]].sum())
            yield from _rows(reader, base, place)
            k = end


def read(manifest: DataFrame) -> DataFrame:
    """All documents of the files: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit). A frame that does not match its checksum raises."""
    return _based(manifest).mapInArrow(_read_files, ROWS)


def index(manifest: DataFrame) -> DataFrame:
    """The document indexes of all files, no data frame read: doc_id, start, n_tokens, path, place."""
    return _based(manifest).mapInArrow(_read_indexes, INDEX)


def fetch(found: DataFrame) -> DataFrame:
    """The documents of some rows of ``index``, as ``read`` gives them; only their frames are read. A row asked for twice comes once."""
    asked = found.select("path", "place", "start").distinct()
    return asked.repartition("path").sortWithinPartitions("path", "place").mapInArrow(_read_places, ROWS)
