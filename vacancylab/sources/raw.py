"""Raw provider files and dimension files.

Plain and gzip CSV are read by Spark directly (gzip is not splittable, but
every file is one task).  Zip archives with one CSV member are landed once:
Spark's file source lists them (batch or stream; no content is read, so none is
a cell), each is opened as a stream inside one task and yields Arrow batches,
which are written to Parquet; then everything is columnar and splittable.
File lineage comes from ``_metadata``.
"""

from __future__ import annotations

import contextlib
import gzip
import re
import zipfile
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.ingest import ORDER

# Both readers take only the empty field as NULL; words such as NA or null are text.
CSV_OPTIONS = {"nullValue": "", "header": "true", "multiLine": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def list_raw_files(spark: SparkSession, directory: str, suffix: str = ".zip") -> DataFrame:
    """Files of a batch directory with a given suffix (path, length)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}")
            .load(directory).select("path", "length", "modificationTime"))


def read_raw_csv(spark: SparkSession, paths, schema: T.StructType = schemas.RAW_POSTINGS) -> DataFrame:
    """S2 (csv / csv.gz): raw provider rows with ``_file`` and ``_order``.

    Columns are matched by header name (all read as strings, then cast to
    ``schema``; absent ones become NULL), not by position."""
    from ..operators.ingest import conform_raw
    df = conform_raw(spark.read.options(**CSV_OPTIONS).csv(paths), schema)
    meta = F.col("_metadata")
    return (df.withColumn("_file", meta.getField("file_path"))
            .withColumn(ORDER, F.struct(meta.getField("file_path").alias("f"),
                                        meta.getField("file_block_start").alias("b"),
                                        F.monotonically_increasing_id().alias("s"))))


#: Schemes whose files every task opens alike; the others go by their own name.
LOCAL_SCHEMES = ("", "file")
SCHEME_ALIASES = {"s3a": "s3", "s3n": "s3"}


def open_path(path: str) -> BinaryIO:
    """Seekable binary stream of a file that Spark listed, inside a task.

    Local and mounted paths, ``hdfs``, ``s3`` (``s3a``) and whatever else pyarrow
    knows; another store needs an ``opener`` of the caller's."""
    from pyarrow import fs as pafs
    scheme, _, rest = path.partition(":") if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:/", path) else ("", "", path)
    if scheme in LOCAL_SCHEMES:
        return open("/" + rest.lstrip("/") if scheme else path, "rb")
    authority, _, inner = rest.removeprefix("//").partition("/")
    scheme = SCHEME_ALIASES.get(scheme, scheme)
    # the path is passed apart from the address: it may hold characters that an address would escape
    if scheme == "s3":
        return pafs.FileSystem.from_uri(f"s3://{authority}")[0].open_input_file(f"{authority}/{inner}")
    return pafs.FileSystem.from_uri(f"{scheme}://{authority}/")[0].open_input_file("/" + inner)


@contextlib.contextmanager
def raw_member(path: str, opener: Callable[[str], BinaryIO] = open_path) -> Iterator[BinaryIO]:
    """Uncompressed stream of a raw file: the single member of a zip, a gzip
    stream or the file itself; any other zip layout is an error.  Nothing is
    read ahead: an archive of any size takes a buffer's memory."""
    if not path.endswith((".zip", ".gz", ".csv")):
        raise ValueError(f"{path}: raw data must be .csv, .csv.gz or a zipped .csv")
    with contextlib.ExitStack() as stack:
        fh = stack.enter_context(opener(path))
        if path.endswith(".zip"):
            archive = stack.enter_context(zipfile.ZipFile(fh))
            members = archive.infolist()
            if len(members) != 1:
                raise ValueError(f"{path}: expected one member, found {len(members)}")
            fh = stack.enter_context(archive.open(members[0]))
        elif path.endswith(".gz"):
            fh = stack.enter_context(gzip.GzipFile(fileobj=fh))
        yield fh


def _file_reader(names: list[str], chunk_rows: int, opener: Callable[[str], BinaryIO]):
    """Paths in, string columns by header name with file and row number out, in Arrow batches."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for batch in batches for p in batch.column("path").to_pylist()):
            with raw_member(path, opener) as fh:
                seq = 0
                try:
                    chunks = pd.read_csv(fh, dtype=str, keep_default_na=False, na_values=[""], chunksize=chunk_rows)
                except pd.errors.EmptyDataError:  # a file without a header has no rows
                    continue
                for chunk in chunks:
                    n = len(chunk)
                    columns = [pa.array(chunk[c], pa.string(), from_pandas=True) if c in chunk.columns
                               else pa.nulls(n, pa.string()) for c in names]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array([path] * n, pa.string()), pa.array(range(seq, seq + n), pa.int64())],
                        names=[*names, "_file", "_seq"])
                    seq += n
    return parse


def parse_raw_files(files: DataFrame, schema: T.StructType = schemas.RAW_POSTINGS, chunk_rows: int = 5_000,
                    opener: Callable[[str], BinaryIO] = open_path) -> DataFrame:
    """Rows of the raw files that ``files`` (batch or streaming, column
    ``path``) names, by header name; values are cast to ``schema``; ``_file`` /
    ``_order`` kept.

    Only paths reach the tasks.  A task opens its file as a stream and yields
    ``chunk_rows`` rows at a time, so neither the 2 GB limit of a cell nor an
    executor's memory bounds an archive."""
    names = schema.fieldNames()
    strings = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_file"]]
                           + [T.StructField("_seq", T.LongType())])
    parsed = files.select("path").mapInArrow(_file_reader(names, chunk_rows, opener), strings)
    return parsed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields],
                         "_file", F.struct(F.col("_file").alias("f"), F.lit(0).cast("long").alias("b"),
                                           F.col("_seq").alias("s")).alias(ORDER))


def read_raw_zip(spark: SparkSession, directory_or_paths, schema: T.StructType = schemas.RAW_POSTINGS,
                 chunk_rows: int = 5_000, suffix: str = ".zip",
                 opener: Callable[[str], BinaryIO] = open_path) -> DataFrame:
    """S2 (zip with one CSV member; another member count is an error).  Each
    archive is one task's stream; land the result as Parquet once."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(directory_or_paths)
    return parse_raw_files(files, schema, chunk_rows, opener)


def read_dimension_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",",
                       encoding: str = "UTF-8", lowercase: tuple[str, ...] = ()) -> DataFrame:
    """Dimension CSVs (';' + latin-1 region grid with lower-cased names,
    ',' keyword lists, ';' employment / vacancy tables)."""
    reader = spark.read.option("header", "true").option("sep", sep).option("encoding", encoding)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    df = reader.csv(path)
    return df.withColumns({c: F.lower(F.col(c)) for c in lowercase}) if lowercase else df


def read_region_grid(spark: SparkSession, path: str) -> DataFrame:
    """The region grid file (names lower-cased)."""
    return read_dimension_csv(spark, path, schemas.REGIONS, sep=";", encoding="ISO-8859-1",
                              lowercase=("name_en", "name_de", "name_fr"))


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by: tuple[str, ...] = ()) -> None:
    """Overwrite (dimension replace) or append (new rows only; empty
    frames write nothing useful but are harmless)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header (one folder of part files)."""
    df.write.mode("overwrite").option("header", "true").csv(path)
