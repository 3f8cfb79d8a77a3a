"""Readers and writers for delimited, JSON, fixed-width and columnar files."""

from __future__ import annotations

import csv
import io
import uuid
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.shape import cast_all, conform, normal_name

AS_IS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}  # the CSV writer trims values otherwise


def read_csv(spark: SparkSession, path, schema=None, header: bool = True, sep: str = ",", quote: str = '"',
             escape: str = "\\", mode: str = "PERMISSIVE", multi_line: bool = False) -> DataFrame:
    """``multi_line`` reads line breaks inside quotes; such files are not split."""
    reader = spark.read.option("header", header).option("sep", sep).option("quote", quote).option("escape", escape)
    reader = reader.option("mode", mode).option("ignoreLeadingWhiteSpace", False).option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_json(spark: SparkSession, path, schema, on_bad: str = "drop") -> DataFrame:
    """One object a line. Malformed lines are dropped, kept in ``_corrupt_record``, or raise."""
    if on_bad == "keep":
        full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
        return spark.read.schema(full).option("mode", "PERMISSIVE").json(path)
    mode = {"drop": "DROPMALFORMED", "fail": "FAILFAST"}[on_bad]
    return spark.read.schema(schema).option("mode", mode).json(path)


def read_fixed(spark: SparkSession, path, layout: list[tuple[str, int, int, str]]) -> DataFrame:
    """Fixed-width lines; ``layout`` has (name, start from 1, width, type), blanks around a field are cut.

    Text that does not fit its type is null.
    """
    lines = spark.read.text(path)
    fields = [
        (F.trim(F.substring("value", start, width)) if t == "string"
         else F.nullif(F.trim(F.substring("value", start, width)), F.lit("")).try_cast(t)).alias(name)
        for name, start, width, t in layout
    ]
    return lines.select(*fields)


def write_fixed(df: DataFrame, path: str, layout: list[tuple[str, int, int, str]]) -> None:
    """Lines in the layout ``read_fixed`` reads; fields must follow each other without gaps. A value longer than its field is an error."""
    texts = [(F.coalesce(F.col(n).cast("string"), F.lit("")), n, w) for n, _, w, _ in layout]
    cells = [F.when(F.char_length(x) > w, F.raise_error(F.lit(f"{n} is longer than {w}"))).otherwise(F.rpad(x, w, " ")) for x, n, w in texts]
    df.select(F.concat(*cells).alias("value")).write.mode("overwrite").text(path)


def grep(df: DataFrame, text: str, col: str = "value") -> DataFrame:
    """Lines holding ``text`` as it stands (no pattern)."""
    return df.filter(F.col(col).contains(text))


def write_partitioned(df: DataFrame, path: str, cols: list[str], fmt: str = "orc", mode: str = "overwrite",
                      cluster: bool = True, **options) -> None:
    """Partitioned files. ``cluster`` brings rows of one partition value together first, so a value is written
    by few tasks; adaptive execution splits a value that is too large for one."""
    laid = df.hint("rebalance", *cols) if cluster and cols else df
    laid.write.format(fmt).mode(mode).options(**options).partitionBy(*cols).save(path)


def to_columnar(df: DataFrame, casts: dict[str, str], parts: list[str], path: str, fmt: str = "orc", strict: bool = False) -> None:
    write_partitioned(cast_all(df, casts, strict), path, parts, fmt)


def overwrite_partitions(df: DataFrame, path: str, cols: list[str], fmt: str = "orc") -> None:
    """Replace only the partitions present in ``df``."""
    laid = df.hint("rebalance", *cols)
    laid.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).save(path)


def write_report(df: DataFrame, cols: list[tuple[str, str]], path: str, sep: str = "\t") -> None:
    """Delimited text with a header; ``cols`` has (column, title) in order. White space around values stays."""
    df.select(*[F.col(c).alias(title) for c, title in cols]).write.mode("overwrite").csv(path, sep=sep, header=True, **AS_IS)


def export_csv(df: DataFrame, path: str, by: str | None = None, single: bool = False) -> None:
    """CSV with header: one folder per value of ``by``; or a folder of files; or, for a frame known to be small, one file.

    ``single`` brings the finished rows to one writing task; the work before it stays spread.
    """
    if by:
        write_partitioned(df.withColumn(f"{by}_part", F.col(by)), path, [f"{by}_part"], "csv", header=True, **AS_IS)
        return
    (df.repartition(1) if single else df).write.mode("overwrite").csv(path, header=True, **AS_IS)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def files_to_rows(files: DataFrame, names: list[str], sep: str = ",") -> DataFrame:
    """Rows of delimited files given as (file, content): the text columns ``names`` and ``file``.

    Each file is read by its own header inside the task that holds it; columns are found by normalised name, whatever their order, one that a file
    lacks is null there and others are left out. Empty cells are null; rows with more or fewer cells than the header are skipped, as are
    files without a header. Two columns of a file with one normalised name are an error. A text is decoded as it is read, so beside the
    bytes of the batch Python holds some thousand rows.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(2**31 - 1)
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                data = pa.BufferReader(content.as_buffer() if content.is_valid else b"")
                reader = csv.reader(io.TextIOWrapper(data, "utf-8", newline=""), delimiter=sep)
                header = [normal_name(h) for h in next(reader, [])]
                if len(set(header)) < len(header):
                    raise ValueError(f"column names collide in {file}: {header}")
                place = [header.index(n) if n in header else None for n in names]
                while header and (chunk := list(islice(reader, 10_000))):
                    whole = [r for r in chunk if len(r) == len(header)]
                    columns = [pa.array([None if p is None else r[p] or None for r in whole], pa.string()) for p in place]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([file] * len(whole), pa.string())], [*names, "file"])

    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, "file")])
    return files.select("file", "content").mapInArrow(rows, schema)


def ingest_files(spark: SparkSession, path, schema: T.StructType, sep: str = ",", source_col: str = "source_file") -> DataFrame:
    """Many delimited files with headers: columns matched by normalised name, typed, tagged with the file's path, exact duplicates dropped.

    One read whatever the number of files or headers; a file, at most 2 GB, is one record and is cut into rows where it is read. ``path`` is a file
    or folder or a list of them; rows that do not fit their header and unreadable files are skipped.
    """
    paths = [path] if isinstance(path, str) else list(path)
    text = spark.read.option("ignoreCorruptFiles", True).text(paths, wholetext=True)
    files = text.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("content"))
    typed = conform(files_to_rows(files, [normal_name(n) for n in schema.names], sep), T.StructType([*schema.fields, T.StructField("file", T.StringType())]))
    return typed.withColumnRenamed("file", source_col).dropDuplicates()


def compact(spark: SparkSession, path: str, out: str, target_mb: int = 128, fmt: str = "parquet", parts: list[str] = ()) -> None:
    """Rewrite a folder of many small files as few larger ones of about ``target_mb``, from the summed length of the files; session settings stay."""
    length = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).agg(F.sum("length")).first()[0] or 0
    count = max(1, -(-length // (target_mb << 20)))
    spark.read.format(fmt).load(path).hint("rebalance", int(count), *parts).write.format(fmt).mode("overwrite").partitionBy(*parts).save(out)


def newest_version(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """Number and folder of the version of ``root`` published last; (0, None) before the first."""
    try:
        log = spark.read.schema("version bigint, folder string").parquet(f"{root}/log")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, None
    last = log.orderBy(F.col("version").desc(), F.col("folder").desc()).first()
    return (last["version"], f"{root}/{last['folder']}") if last else (0, None)


def _name_version(spark: SparkSession, root: str, folder: str) -> int:
    version = newest_version(spark, root)[0] + 1
    row = spark.range(1, numPartitions=1).select(F.lit(version).cast("bigint").alias("version"), F.lit(folder).alias("folder"))
    row.write.mode("append").parquet(f"{root}/log")
    return version


def publish(df: DataFrame, root: str, fmt: str = "parquet", parts: list[str] = ()) -> int:
    """Write ``df`` as the next version of ``root`` and return its number.

    The rows go to a folder of their own; once they are all there, one row appended to the log names it. So a job that fails before that leaves
    the version before it in force, and a reader keeps the folder it was given. One writer at a time; folders of old versions stay until removed.
    """
    folder = f"versions/{uuid.uuid4().hex}"
    df.write.format(fmt).partitionBy(*parts).save(f"{root}/{folder}")
    return _name_version(df.sparkSession, root, folder)


def published(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """The rows of the version of ``root`` published last."""
    folder = newest_version(spark, root)[1]
    if folder is None:
        raise ValueError(f"nothing is published in {root}")
    return spark.read.format(fmt).load(folder)


def compact_published(spark: SparkSession, root: str, target_mb: int = 128, fmt: str = "parquet", parts: list[str] = ()) -> int:
    """Compact the version published last into a new one; readers of the old one go on undisturbed."""
    now = newest_version(spark, root)[1]
    if now is None:
        raise ValueError(f"nothing is published in {root}")
    folder = f"versions/{uuid.uuid4().hex}"
    compact(spark, now, f"{root}/{folder}", target_mb, fmt, parts)
    return _name_version(spark, root, folder)
