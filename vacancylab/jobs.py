"""Batch jobs over a stored database folder (the runnable counterparts of the
monthly update and augmentation scripts).

Tables live as Parquet folders under ``root``, any path that Hadoop's
FileSystem reads.  A job never overwrites a folder that it reads: a recomputed
table, or one batch of it, is written to ``_swap`` and moved in once the write
succeeded; the old version waits in ``_swap`` meanwhile.  A job that was killed
between the two moves left the old version there, and ``open_tables`` and the
next replacement put it back first.  Appends go through anti joins, so
re-running a job adds nothing twice.

Postings, positions and both tag tables are partitioned by ``data_batch``.
Deleting a batch drops these partitions: folders are moved, no row of another
batch is read or written.  New rows of a batch are staged, checked (as many
rows as keys, I12) and only then appended; a publication that was killed is
finished from its stage by the next job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .operators import dedup, ingest, keywords, regions, sampling, term_index
from .session import land_table
from .sources import raw as rawsrc
from .sources.catalog import file_system, path_exists
from .sources.fixtures import JobTables

BY_BATCH = ("postings", "positions", "ai_tags", "tech_tags")
TABLES = ("postings", "positions", "employers", "regions", "ai_tags", "tech_tags")


def _swap_path(root: str, name: str, version: str) -> str:
    return f"{root}/_swap/{name.replace('/', '+')}.{version}"


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, from_, to = (*file_system(spark, source), file_system(spark, target)[1])
    fs.mkdirs(to.getParent())
    if not fs.rename(from_, to):
        raise OSError(f"could not move {source} to {target}")


def restore(spark: SparkSession, root: str, name: str) -> None:
    """Put back the old version of a table that a killed job moved away."""
    old = _swap_path(root, name, "old")
    if not path_exists(spark, f"{root}/{name}") and path_exists(spark, old):
        _move(spark, old, f"{root}/{name}")


def replace_table(spark: SparkSession, df: DataFrame, root: str, name: str,
                  partition_by: tuple[str, ...] = ()) -> None:
    """Write ``df`` as the new version of table ``name``; a name such as
    ``postings/data_batch=b`` replaces this partition only."""
    target, new, old = f"{root}/{name}", _swap_path(root, name, "new"), _swap_path(root, name, "old")
    restore(spark, root, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(new)
    fs, old_path = file_system(spark, old)
    fs.delete(old_path, True)
    if path_exists(spark, target):
        _move(spark, target, old)
    _move(spark, new, target)
    fs.delete(old_path, True)


def append_rows(df: DataFrame, path: str, partition_by: tuple[str, ...] = (),
                expected: int | None = None) -> int:
    """Append and return the number of rows written (observed during the
    write, no second pass); with ``expected`` the count is checked (I12)."""
    obs = Observation("appended")
    observed = df.observe(obs, F.count(F.lit(1)).alias("n"))
    w = observed.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    n = int(obs.get.get("n", 0))
    if expected is not None and n != expected:
        raise AssertionError(f"appended {n} rows to {path}, expected {expected}")
    return n


def open_tables(spark: SparkSession, root: str, required: tuple[str, ...] = ()) -> JobTables:
    """Stored tables; empty frames with the table schema where none exists,
    but a missing table that is ``required`` is an error.  What a killed
    replacement moved away, a whole table or one batch, is put back first."""
    fs, swap = file_system(spark, f"{root}/_swap")
    if fs.exists(swap):
        for left in [s.getPath().getName() for s in fs.listStatus(swap)]:
            if left.endswith(".old"):
                restore(spark, root, left.removesuffix(".old").replace("+", "/"))

    def read(name: str):
        if path_exists(spark, f"{root}/{name}"):
            # a partition column that is not in the schema is left out
            stored = spark.read.schema(schemas.SCHEMAS[name]).parquet(f"{root}/{name}")
            return stored.select(*schemas.SCHEMAS[name].fieldNames())
        if name in required:
            raise FileNotFoundError(f"no table {name} in {root}")
        return spark.createDataFrame([], schemas.SCHEMAS[name])
    return JobTables(**{n: read(n) for n in TABLES})


def batch_partition(data_batch: str, table: str = "postings") -> str:
    """Folder of a batch inside a table that is partitioned by batch."""
    if not data_batch or not all(c.isalnum() or c in "_-." for c in data_batch):
        raise ValueError(f"batch label {data_batch!r} may hold letters, digits, '_', '-' and '.' only")
    return f"{table}/data_batch={data_batch}"


def _load_label() -> Column:
    """What tells a version of a raw file from another: its length and time."""
    return F.concat_ws("-", F.lit("file"), F.col("length"), F.unix_millis("modificationTime"))


def files_to_load(spark: SparkSession, raw_dir: str, root: str, data_batch: str, suffix: str = ".zip") -> DataFrame:
    """Raw files of a folder (path, load) that the ledger does not name, by
    path, length and modification time: a file that was replaced is new."""
    files = rawsrc.list_raw_files(spark, raw_dir, suffix).select("path", _load_label().alias("load"))
    if not path_exists(spark, f"{root}/_ledger"):
        return files
    known = spark.read.parquet(f"{root}/_ledger").where(F.col("data_batch") == data_batch)
    return files.join(known.select(F.col("file").alias("path"), "load"), ["path", "load"], "left_anti")


def update_batch(spark: SparkSession, raw_dir: str, root: str, data_batch: str,
                 suffix: str = ".zip", dup_policy: str = "drop_all", reread: bool = False) -> dict[str, int]:
    """Monthly update: read the raw files of the batch that are not loaded yet,
    attach region codes on ``inferred_state``, append new postings / positions /
    employers and name the files in the ledger.

    Files that the ledger names are not opened (``reread=True`` opens them all
    again).  Whether an id occurs more than once is decided over the files of
    one call and the stored ids.  The raw files are parsed once.  Each append
    must have as many rows as the keys it adds (I12): a region name with several
    codes would store an id twice, and stops the job before anything is written."""
    batch_partition(data_batch)
    finish_publication(spark, root, data_batch)
    if reread:
        files = rawsrc.list_raw_files(spark, raw_dir, suffix).select("path", _load_label().alias("load"))
    else:
        files = files_to_load(spark, raw_dir, root, data_batch, suffix)
    chosen = sorted(files.collect())  # names only: as many as files in one provider folder, which the reader plans by
    if not chosen:
        return {"positions": 0, "employers": 0, "postings": 0}
    paths = [r["path"] for r in chosen]
    raw = rawsrc.read_raw_zip(spark, paths, suffix=suffix) if suffix == ".zip" else rawsrc.read_raw_csv(spark, paths)
    raw = land_table(raw, "raw")
    stored = open_tables(spark, root)
    new = ingest.ingest_batch(raw, data_batch, stored, stored.regions, dup_policy)
    name = F.element_at(F.split("file", "/"), -1)  # Spark escapes the paths of rows, not those of listed files
    counts = (ingest.rows_per_file(raw).withColumn("file", F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))))
              if suffix != ".zip" else ingest.rows_per_file(raw))
    read = spark.createDataFrame([(r["load"], r["path"]) for r in chosen], "load string, file string")
    sources = (read.withColumn("__name", name).join(counts.select(name.alias("__name"), "n_rows"), "__name", "left")
               .select("load", "file", F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows")))
    stage_rows(spark, new, root, data_batch, sources)
    return finish_publication(spark, root, data_batch)


def record_loads(spark: SparkSession, root: str, data_batch: str) -> None:
    """Name the sources of a complete stage in the ledger, each once."""
    sources, ledger = f"{_stage_path(root, data_batch)}/sources", f"{root}/_ledger"
    if not path_exists(spark, f"{sources}/_SUCCESS"):
        return
    rows = spark.read.schema("load string, file string, n_rows long").parquet(sources).withColumn("data_batch", F.lit(data_batch))
    if path_exists(spark, ledger):
        rows = rows.join(spark.read.parquet(ledger).select("data_batch", "load", "file"), ["data_batch", "load", "file"], "left_anti")
    rows.select("data_batch", "load", "file", "n_rows").coalesce(1).write.mode("append").parquet(ledger)


def _stage_path(root: str, data_batch: str) -> str:
    return f"{root}/_publish/{data_batch}"


def stage_rows(spark: SparkSession, new: JobTables, root: str, data_batch: str, sources: DataFrame | None = None) -> None:
    """Write a batch's new rows beside the tables and check them; nothing is
    stored yet.  Each table must have as many rows as keys (I12), else the
    stage stays without its mark and the error names the table.  ``sources``
    (what the rows were made of) is written last: it marks the stage complete."""
    stage = _stage_path(root, data_batch)
    fs, path = file_system(spark, stage)
    fs.delete(path, True)
    rows = {"positions": new.positions, "employers": new.employers, "postings": new.postings}
    for name, df in rows.items():
        columns = [F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                   for f in schemas.SCHEMAS[name].fields]
        df.select(*columns).write.parquet(f"{stage}/{name}")
        key = schemas.BASE_TABLE_KEYS[name]
        staged = spark.read.schema(schemas.SCHEMAS[name]).parquet(f"{stage}/{name}")
        n, keys = staged.agg(F.count("*"), F.countDistinct(key)).first()
        if n != keys:
            raise AssertionError(f"{name} of {data_batch}: {n} rows for {keys} keys")
    if sources is None:
        sources = spark.createDataFrame([], "load string, file string, n_rows long")
    sources.coalesce(1).write.parquet(f"{stage}/sources")


def append_stage(spark: SparkSession, root: str, data_batch: str) -> dict[str, int]:
    """Append a complete stage to the tables; the number of rows appended per
    table (0 where the stage is not complete).  Rows that an earlier, killed attempt
    appended are skipped by their keys, so any number of attempts stores each
    row once."""
    stage = _stage_path(root, data_batch)
    appended = {"positions": 0, "employers": 0, "postings": 0}
    if path_exists(spark, f"{stage}/sources/_SUCCESS"):
        stored = open_tables(spark, root)
        for name in appended:
            key = schemas.BASE_TABLE_KEYS[name]
            staged = spark.read.schema(schemas.SCHEMAS[name]).parquet(f"{stage}/{name}")
            # a killed append left no row or all of them, but the keys decide
            df = land_table(staged.join(getattr(stored, name).select(key), key, "left_anti")
                            .select(*staged.columns), f"new-{name}")
            target = f"{root}/{name if name == 'employers' else batch_partition(data_batch, name)}"
            appended[name] = append_rows(df.drop("data_batch"), target, expected=df.count())
    return appended


def forget_loads(spark: SparkSession, root: str, data_batch: str) -> None:
    """Take a batch out of the ledger, so that its files count as new again."""
    restore(spark, root, "_ledger")
    if path_exists(spark, f"{root}/_ledger"):
        ledger = spark.read.parquet(f"{root}/_ledger")
        replace_table(spark, ledger.where(F.col("data_batch") != data_batch), root, "_ledger")


def drop_stage(spark: SparkSession, root: str, data_batch: str) -> None:
    fs, path = file_system(spark, _stage_path(root, data_batch))
    fs.delete(path, True)


def finish_publication(spark: SparkSession, root: str, data_batch: str) -> dict[str, int]:
    """Append a stage that is complete, name its files in the ledger and drop
    it; an incomplete one is dropped.  The ledger comes after the rows: a file
    that it names is stored."""
    appended = append_stage(spark, root, data_batch)
    record_loads(spark, root, data_batch)
    drop_stage(spark, root, data_batch)
    return appended


def _batches(spark: SparkSession, root: str, table: str) -> list[str]:
    """Batches that a table has a partition for (a listing, no data is read)."""
    fs, path = file_system(spark, f"{root}/{table}")
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(n.removeprefix("data_batch=") for n in names if n.startswith("data_batch="))


def assign_regions(spark: SparkSession, root: str, rules=regions.SWISS_RULES) -> None:
    """Region codes of all positions anew from their names (G1+G2), as after the
    initial load; codes that the update attached (G5) are replaced.  Batch by
    batch: a kill leaves whole batches, old or new."""
    t = open_tables(spark, root, required=("positions", "regions"))
    for batch in _batches(spark, root, "positions"):
        part = batch_partition(batch, "positions")
        mine = spark.read.schema(schemas.POSITIONS).parquet(f"{root}/{part}")
        replace_table(spark, regions.assign_regions(mine, t.regions, rules), root, part)


def augment(spark: SparkSession, root: str, data_batch: str, ai_keywords, tech_dictionary: DataFrame) -> None:
    """Augmentation of one batch: duplicate flags (D1+D2), AI tags (K5) and
    technology tags (K6).  Only the batch's partitions are written."""
    t = open_tables(spark, root, required=("postings", "positions"))
    mine = t.postings.where(F.col("data_batch") == data_batch)
    if not mine.isEmpty():
        replace_table(spark, dedup.clean_duplicates(mine, t.positions, data_batch).drop("data_batch"), root,
                      batch_partition(data_batch))
    t = open_tables(spark, root)
    for name, tags in (("ai_tags", keywords.tag_ai(t.postings, ai_keywords, data_batch, existing=t.ai_tags)),
                       ("tech_tags", keywords.tag_tech(t.postings, tech_dictionary, data_batch, existing=t.tech_tags))):
        append_rows(tags, f"{root}/{batch_partition(data_batch, name)}")


def load_region_grid(spark: SparkSession, csv_path: str, root: str) -> int:
    """Region dimension from its file (S4): names in lower case, the stored
    table replaced.  A row without an English name, or two for one (name,
    nuts_3), is an error and leaves the table as it was.  Returns the number of rows."""
    grid = land_table(rawsrc.read_region_grid(spark, csv_path), "regions")
    key = schemas.PRIMARY_KEYS["regions"]
    seen = grid.agg(F.count("*").alias("n"), F.count("name_en").alias("named"),
                    F.countDistinct(F.struct(*key)).alias("keys")).first()
    if not seen["n"] == seen["named"] == seen["keys"]:
        raise ValueError(f"{csv_path}: {seen['n']} rows, {seen['named']} with a name, {seen['keys']} keys {key}")
    replace_table(spark, grid, root, "regions")
    return seen["n"]


def create_development_db(spark: SparkSession, root: str, target: str, sample_share: float = 0.002,
                          n_per_country: int = 200, seed: int = 472023) -> dict[str, int]:
    """R4 as a job: a small database under ``target`` with the sampled postings,
    everything that belongs to them and the whole region dimension, laid out
    like the large one.  The ids are landed once, so all tables agree.  Returns
    the rows per table."""
    if target.rstrip("/") == root.rstrip("/"):
        raise ValueError("the subset needs a folder of its own")
    stored = open_tables(spark, root, required=("postings", "positions", "employers"))
    ids = land_table(sampling.development_sample_ids(stored.positions, sample_share, n_per_country, seed), "sample-ids")
    subset = sampling.referential_subset(stored, ids)
    batches = subset.postings.select("uniq_id", "data_batch")
    rows = {}
    for name in TABLES:
        df = getattr(subset, name)
        if name in BY_BATCH and "data_batch" not in df.columns:
            df = df.join(batches, "uniq_id")
        replace_table(spark, df, target, name, ("data_batch",) if name in BY_BATCH else ())
        rows[name] = getattr(open_tables(spark, target), name).count()
    return rows


def reset_flag(spark: SparkSession, root: str, column: str, default_value: str, data_batch: str,
               restrict_to_countries=None, exclude_countries=None) -> None:
    """I15 as a job: only the batch's partition of postings is written."""
    part = batch_partition(data_batch)
    t = open_tables(spark, root, required=("postings", "positions"))
    mine = t.postings.where(F.col("data_batch") == data_batch)
    if not mine.isEmpty():
        flags = dedup.reset_flag(mine, t.positions, column, default_value, data_batch, restrict_to_countries, exclude_countries)
        replace_table(spark, flags.drop("data_batch"), root, part)


def index_terms(spark: SparkSession, root: str, data_batch: str) -> None:
    """Term index of one batch (K4-K7 without texts): its partition is written anew."""
    t = open_tables(spark, root, required=("postings",))
    mine = t.postings.where(F.col("data_batch") == data_batch)
    rows = term_index.term_rows(term_index.segmented(mine)).drop("data_batch")
    replace_table(spark, term_index.sorted_index(rows), root,
                  batch_partition(data_batch, "term_index"))


def open_term_index(spark: SparkSession, root: str, data_batch: str | None = None) -> DataFrame:
    """Stored term index, of one batch or of all that have one."""
    part = "term_index" if data_batch is None else batch_partition(data_batch, "term_index")
    restore(spark, root, part)
    return spark.read.option("basePath", f"{root}/term_index").parquet(f"{root}/{part}")


def drop_partition(spark: SparkSession, root: str, table: str, data_batch: str) -> None:
    """Delete a batch of one table: its folder is moved out in one step, then
    removed.  A kill in between leaves a folder in ``_swap`` that no table
    reads and that the next call removes."""
    part = batch_partition(data_batch, table)
    gone = _swap_path(root, part, "gone")
    fs, gone_path = file_system(spark, gone)
    fs.delete(gone_path, True)
    restore(spark, root, part)
    if path_exists(spark, f"{root}/{part}"):
        _move(spark, f"{root}/{part}", gone)
        fs.delete(gone_path, True)


def clean_tables(spark: SparkSession, root: str, data_batch: str) -> None:
    """Delete a batch (I13) and what is left without a posting (I14): the
    batch's partitions of tags, positions and postings go, in this order, so
    that the batch stays known until the last; then employers that no position
    names any more.  Killed at any step, the next call does the rest."""
    open_tables(spark, root, required=("postings", "positions", "employers"))
    finish_publication(spark, root, data_batch)
    for name in ("term_index", *reversed(BY_BATCH)):
        drop_partition(spark, root, name, data_batch)
    forget_loads(spark, root, data_batch)
    t = open_tables(spark, root)
    replace_table(spark, ingest.remove_orphan_employers(t.employers, t.positions), root, "employers")
