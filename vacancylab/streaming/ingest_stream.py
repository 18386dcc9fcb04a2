"""Incremental ingest of raw provider files with Structured Streaming.

Each trigger lands the files that arrived since the last one; the file-source
checkpoint replaces the "which files are loaded yet" check (I11).  Whether an
id is stored depends on the whole batch (drop-all, I10), so rows wait in
pending tables, with a narrow table of occurrences per id as the keyed state.
``publish`` stores what occurs once, by the same functions as the batch job:
the result does not depend on how the files fell into triggers, and a replayed
trigger changes nothing.  No watermark is needed: a late copy is as good as any
until the batch is published; afterwards its id is stored and it adds nothing.
``Trigger.AvailableNow`` processes everything present and stops, which is the
shape of the original monthly batch job.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import jobs
from ..operators import ingest
from ..sources.catalog import file_system, path_exists
from ..sources.raw import parse_raw_files


def raw_stream(spark: SparkSession, raw_dir: str, suffix: str = ".csv",
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of raw rows (CSV, gzip or zipped CSV; header
    matched by name) with ``_file`` and the within-file order ``_order``."""
    binary = T.StructType([T.StructField("path", T.StringType()),
                           T.StructField("modificationTime", T.TimestampType()),
                           T.StructField("length", T.LongType()),
                           T.StructField("content", T.BinaryType())])
    reader = (spark.readStream.format("binaryFile").schema(binary).option("pathGlobFilter", f"*{suffix}"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_raw_files(reader.load(raw_dir))


def _pending(root: str, data_batch: str, table: str = "") -> str:
    return f"{root}/_pending/{data_batch}/{table}".rstrip("/")


def land_micro_batch(spark: SparkSession, batch: DataFrame, db_root: str, data_batch: str, load: str) -> None:
    """One trigger: structured rows and the occurrences of their ids go to the
    pending tables, in folders of this load.

    A replayed trigger has the same load and overwrites them.  ``occurrences``
    is the keyed state of the drop-all rule: one narrow row per id and load, so
    a copy that arrives in a later trigger retracts an earlier one without
    touching its row.  Rows are counted while they are written; the count per
    file (I16), written last, marks the load complete.
    """
    def part(table: str) -> str:
        return f"{_pending(db_root, data_batch, table)}/load={load}"

    def written(df: DataFrame, table: str) -> DataFrame:
        df.write.mode("overwrite").parquet(part(table))
        return spark.read.schema(df.schema).parquet(part(table))

    seen = Observation(f"raw-{load}")
    raw = ingest.rename_raw(ingest.conform_raw(batch)).observe(
        seen, F.count(F.lit(1)).alias("n_rows"), F.count("uniq_id").alias("n_ids"))
    raw = written(raw, "raw")
    ids = written(raw.where("uniq_id is not null").groupBy("uniq_id").agg(F.count(F.lit(1)).alias("n")), "occurrences")
    files = written(ingest.rows_per_file(raw).withColumnRenamed("file", "_file"), "files")
    told = (ids.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], files.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0])
    if told != (seen.get["n_ids"], seen.get["n_rows"]):
        file_system(spark, part("files"))[0].delete(file_system(spark, part("files"))[1], True)
        raise AssertionError(f"load {load}: read {seen.get}, stored {told}")


def complete_loads(spark: SparkSession, db_root: str, data_batch: str) -> list[str]:
    """Loads of a batch whose last folder is whole."""
    base = _pending(db_root, data_batch, "files")
    fs, path = file_system(spark, base)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(n.removeprefix("load=") for n in names
                  if n.startswith("load=") and path_exists(spark, f"{base}/{n}/_SUCCESS"))


def publish(spark: SparkSession, db_root: str, data_batch: str, regions: DataFrame | None = None) -> dict[str, int]:
    """Move a batch's pending rows into the tables, by the rules of the batch job.

    An id stays if it occurs once over all pending loads and is not stored yet
    (I5, I9, I10); employers keep their first row in file order (I8).  The rows
    are staged and checked before anything is appended (I12); then the ledger
    gets a row per load and file and the loads are removed.  Whatever step a
    kill interrupts, the next call finishes it.
    """
    sources = f"{db_root}/_publish/{data_batch}/sources"
    if not path_exists(spark, f"{sources}/_SUCCESS"):
        loads = complete_loads(spark, db_root, data_batch)
        if not loads:
            return {"positions": 0, "employers": 0, "postings": 0}
        def read(table: str) -> DataFrame:
            found = spark.read.option("basePath", _pending(db_root, data_batch, table)).parquet(
                *[f"{_pending(db_root, data_batch, table)}/load={load}" for load in loads])
            return found.withColumn("load", F.col("load").cast("string"))
        stored = jobs.open_tables(spark, db_root)
        repeated = read("occurrences").groupBy("uniq_id").agg(F.sum("n").alias("n")).where("n > 1").select(
            F.col("uniq_id").alias("duplicated_ids"))
        raw = read("raw").drop("load")
        new = ingest.new_rows(raw, repeated, data_batch, stored, regions)
        files = read("files").select("load", F.col("_file").alias("file"), "n_rows")
        jobs.stage_rows(spark, new, db_root, data_batch, files)
    done = spark.read.schema("load string, file string, n_rows long").parquet(sources)
    jobs.record_loads(spark, db_root, data_batch)
    loads = [r["load"] for r in done.select("load").distinct().collect()]  # as many as triggers since the last publication
    appended = jobs.append_stage(spark, db_root, data_batch)
    for load in loads:
        for table in ("files", "occurrences", "raw"):  # the mark goes first
            fs, path = file_system(spark, f"{_pending(db_root, data_batch, table)}/load={load}")
            fs.delete(path, True)
    jobs.drop_stage(spark, db_root, data_batch)
    return appended


class IngestRun:
    """A started ingest: the streaming query, and the publication after it ends."""

    def __init__(self, query, spark: SparkSession, db_root: str, data_batch: str, regions: DataFrame | None):
        self.query, self._publish = query, lambda: publish(spark, db_root, data_batch, regions)
        self.appended: dict[str, int] | None = None

    def awaitTermination(self, timeout: int | None = None) -> bool:
        """Wait for the query; once it has ended without an error, publish what it landed."""
        ended = self.query.awaitTermination(timeout)
        if timeout is None or ended:
            self.appended = self._publish()
        return timeout is None or bool(ended)

    def __getattr__(self, name: str):
        return getattr(self.query, name)


def start_ingest(spark: SparkSession, raw_dir: str, db_root: str, data_batch: str, checkpoint: str,
                 regions: DataFrame | None = None, available_now: bool = True, suffix: str = ".csv",
                 max_files_per_trigger: int | None = None) -> IngestRun:
    """Start the ingest stream.  With ``available_now`` it ends by itself and
    ``awaitTermination`` publishes; a continuous one lands files until it is
    stopped, and ``publish`` is called when the batch is to be stored."""
    jobs.batch_partition(data_batch)
    stream = raw_stream(spark, raw_dir, suffix, max_files_per_trigger)
    run = hashlib.md5(checkpoint.encode()).hexdigest()[:8]
    writer = (stream.writeStream
              .foreachBatch(lambda df, epoch: land_micro_batch(df.sparkSession, df, db_root, data_batch, f"{run}-{epoch:09d}"))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return IngestRun(writer.start(), spark, db_root, data_batch, regions)
