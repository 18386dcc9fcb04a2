"""Stored tables that are joined without moving texts.

Postings are kept as two tables: ``posting_texts`` (everything but the
duplicate flags, written once per batch) and ``posting_flags`` (uniq_id,
data_batch and the two flags, rewritten by D4 and I15).  Both and
``positions`` are catalog tables bucketed and sorted by ``uniq_id`` with the
same number of buckets and partitioned by ``data_batch``, so the joins on the
posting id (J1, J2, the flags) need no exchange of either side.  Flagging a
batch writes the narrow flags partition and never a text.

Choose at least as many buckets as ``spark.sql.shuffle.partitions`` (else
Spark prefers to shuffle for parallelism) and so many that a bucket of one
batch fits a task: 100 TB in a few hundred batches, about 300 GB each, makes
1,024 buckets of 300 MB.

The tables are external: any session declares them over the same folder
(``BucketedStore(spark, root, buckets)``), with or without a shared metastore.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import dedup
from ..session import land_table
from .catalog import path_exists
from .fixtures import JobTables

KEY, BATCH = "uniq_id", "data_batch"
FLAGS = T.StructType([T.StructField(KEY, T.StringType()), *[T.StructField(c, T.StringType()) for c in schemas.FLAG_COLUMNS],
                      T.StructField(BATCH, T.StringType())])


def _last(schema: T.StructType, column: str) -> T.StructType:
    """``schema`` with the partition column at its end, added if absent."""
    return T.StructType([f for f in schema.fields if f.name != column] + [T.StructField(column, T.StringType())])


TABLES = {
    "posting_texts": _last(T.StructType([f for f in schemas.POSTINGS.fields if f.name not in schemas.FLAG_COLUMNS]), BATCH),
    "posting_flags": FLAGS,
    "positions": _last(schemas.POSITIONS, BATCH),
}


class BucketedStore:
    """The three bucketed tables under ``root``, declared in database ``database``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int, database: str = "jobs"):
        self.spark, self.root, self.buckets, self.database = spark, root, buckets, database
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        for name, schema in TABLES.items():
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(name)} ({columns}) USING parquet PARTITIONED BY ({BATCH}) "
                      f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{root}/{name}'")
            if path_exists(spark, f"{root}/{name}"):
                spark.sql(f"ALTER TABLE {self.name(name)} RECOVER PARTITIONS")

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def _replace_batches(self, table: str, rows: DataFrame) -> None:
        """Write the batches that ``rows`` holds; other partitions stay.  Rows are
        dealt out like the buckets, so a bucket of a batch is one file."""
        key, before = "spark.sql.sources.partitionOverwriteMode", self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        dealt = rows.select(*TABLES[table].fieldNames()).repartition(self.buckets, KEY)
        self.spark.conf.set(key, "dynamic")
        try:
            dealt.write.insertInto(self.name(table), overwrite=True)
        finally:
            self.spark.conf.set(key, before)

    def write_postings(self, postings: DataFrame) -> None:
        """Whole batches of postings, flags included; columns that are absent are null."""
        for c in TABLES["posting_texts"].fieldNames():
            if c not in postings.columns:
                postings = postings.withColumn(c, F.lit(None).cast("string"))
        self._replace_batches("posting_texts", postings)
        self._replace_batches("posting_flags", postings)

    def write_positions(self, positions: DataFrame) -> None:
        """Positions of whole batches; the batch of a posting is its flags' one.
        Positions without a posting have no batch and are not stored (I12)."""
        batches = self.spark.table(self.name("posting_flags")).select(KEY, BATCH)
        rows = positions.drop(BATCH).join(batches, KEY)
        for f in TABLES["positions"].fields:
            if f.name not in rows.columns:
                rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
        self._replace_batches("positions", rows)

    def postings(self, data_batch: str | None = None) -> DataFrame:
        """Texts with their flags, joined bucket by bucket."""
        texts, flags = (self.spark.table(self.name(t)) for t in ("posting_texts", "posting_flags"))
        if data_batch is not None:
            texts, flags = (t.where(F.col(BATCH) == data_batch) for t in (texts, flags))
        joined = texts.join(flags.drop(BATCH), KEY)
        return joined.select(*[f for f in schemas.POSTINGS.fieldNames() if f in joined.columns])

    def tables(self, data_batch: str | None = None, **others: DataFrame) -> JobTables:
        """The database as the operators take it; tables that are not bucketed come as ``others``."""
        positions = self.spark.table(self.name("positions"))
        if data_batch is not None:
            positions = positions.where(F.col(BATCH) == data_batch)
        rest = {n: others.get(n) for n in ("employers", "regions", "ai_tags", "tech_tags")}
        return JobTables(postings=self.postings(data_batch), positions=positions.drop(BATCH), **rest)

    def flags(self, data_batch: str) -> DataFrame:
        return self.spark.table(self.name("posting_flags")).where(F.col(BATCH) == data_batch)

    def new_flags(self, data_batch: str) -> DataFrame:
        """D1 + D2 + D4 of a batch as rows of the flags table: digests of the
        texts are made in the scan and nothing else of them is kept."""
        db = self.tables(data_batch)
        texts = self.spark.table(self.name("posting_texts")).where(F.col(BATCH) == data_batch)
        return dedup.flag_rows(self.flags(data_batch), texts, db.positions, data_batch)

    def flag_duplicates(self, data_batch: str) -> None:
        """Write a batch's duplicate flags; texts are read, never written."""
        self._replace_batches("posting_flags", land_table(self.new_flags(data_batch), "flags"))

    def reset_flag(self, column: str, default_value: str, data_batch: str, restrict_to_countries=None,
                   exclude_countries=None) -> None:
        """I15 on the flags table alone."""
        rows = dedup.reset_flag(self.flags(data_batch), self.tables(data_batch).positions, column, default_value,
                                data_batch, restrict_to_countries, exclude_countries)
        self._replace_batches("posting_flags", land_table(rows, "flags"))
