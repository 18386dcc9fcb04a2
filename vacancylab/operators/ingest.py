"""Batch ingest and table maintenance.

Every step is a DataFrame -> DataFrame function; writers are thin.  A raw
batch is one wide DataFrame (all files of the batch), with the file name and
a within-file order key so "first row per key" keeps file order.

Skew: keys are deduplicated with grouped aggregates (partial aggregation
collapses a hot key map-side) instead of a window that would sort a hot key's
rows in one task.  Rows with texts are chosen by their places alone and
fetched afterwards, dealt by place, so no text enters an aggregate and a hot
key's texts meet in no task.  Stored keys are compared with anti joins;
nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import normalise
from .dedup import with_default_flags

ORDER = "_order"


# ------------------------------------------------------------------------ S3 / Q9
def rename_raw(df: DataFrame) -> DataFrame:
    """S3: provider column names -> stored names."""
    return df.withColumnsRenamed({k: v for k, v in schemas.RAW_RENAMES.items() if k in df.columns})


def normalise_remote(col: Column) -> Column:
    """Q9: map true / 1 / 1.0 to '1' and false / 0 / 0.0 to '0' (NULL stays)."""
    v = F.lower(F.trim(col.cast("string")))
    return (F.when(v.isin("true", "1", "1.0", "yes"), F.lit("1"))
            .when(v.isin("false", "0", "0.0", "no"), F.lit("0"))
            .otherwise(F.lit(None).cast("string")))


def with_file_order(df: DataFrame, file_col: str | None = None, seq_col: str | None = None) -> DataFrame:
    """Add ``_file`` and the order key ``_order`` (file, position in file).

    For files read by Spark: ``_metadata.file_path`` and the split start plus
    a per-partition increasing id (splits of one file are ordered by start).
    """
    if file_col and seq_col:
        return df.withColumn("_file", F.col(file_col)).withColumn(
            ORDER, F.struct(F.col(file_col).alias("f"), F.lit(0).cast("long").alias("b"),
                            F.col(seq_col).cast("long").alias("s")))
    meta = F.col("_metadata")
    return (df.withColumn("_file", meta.getField("file_path"))
            .withColumn(ORDER, F.struct(meta.getField("file_path").alias("f"),
                                        meta.getField("file_block_start").alias("b"),
                                        F.monotonically_increasing_id().alias("s"))))


def conform_raw(df: DataFrame, schema=schemas.RAW_POSTINGS) -> DataFrame:
    """Add raw columns a provider file lacks as typed NULLs (as a CSV read
    with the schema would), and cast present ones to the schema types."""
    out = df
    for f in schema.fields:
        if f.name in out.columns:
            out = out.withColumn(f.name, F.col(f.name).cast(f.dataType))
        else:
            out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
    return out


# ------------------------------------------------------------------------ I1 / I2
def structure(df: DataFrame, table: str, lowercase: Sequence[str] = schemas.LOWERCASE_COLUMNS) -> DataFrame:
    """I1 + I2: project onto the table's columns (key first, then the fixed
    column order; a missing column is an error) and normalise the listed text
    columns (string, strip, lower; NULL stays NULL).  Order columns are kept."""
    key = schemas.BASE_TABLE_KEYS[table]
    cols = [key] + [c for c in schemas.BASE_TABLE_COLUMNS[table] if c != key]
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"raw data lacks columns for table {table}: {missing}")
    extra = [c for c in ("_file", ORDER) if c in df.columns]
    exprs = []
    for c in cols:
        if c in lowercase:
            exprs.append(normalise(F.col(c)).alias(c))
        elif c == "remote_position":
            exprs.append(normalise_remote(F.col(c)).alias(c))
        else:
            exprs.append(F.col(c))
    return df.select(*exprs, *extra)


# ------------------------------------------------------------------------ I3
def first_per_key(df: DataFrame, key: str | Sequence[str], order: str = ORDER) -> DataFrame:
    """I3 for narrow rows: one row per non-NULL key, the first in ``order``.

    ``min_by`` is a partial aggregate, so a key repeated millions of times is
    reduced map-side before the shuffle (a window would sort it in one task).
    The whole row sits in the aggregate's buffer: use ``first_rows`` for rows
    with texts.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    nonnull = df
    for k in keys:
        nonnull = nonnull.filter(F.col(k).isNotNull())
    row = F.struct(*[F.col(c) for c in others])
    return (nonnull.groupBy(*keys).agg(F.min_by(row, F.col(order)).alias("__r"))
            .select(*keys, "__r.*").select(*df.columns))


def first_rows(df: DataFrame, key: str | Sequence[str], order: str = ORDER,
               existing: DataFrame | None = None) -> DataFrame:
    """I3 for rows with texts: one row per non-NULL key, the first in ``order``,
    and none whose key is in ``existing``.

    The winners are chosen on (key, order) alone; whole rows are then fetched
    by a semi join on both, which deals a hot key's rows over all tasks.  They
    cross at most one exchange.  ``order`` is a row's place (file, block,
    position): rows that share key and place all stay.  An empty frame gives
    an empty one.
    """
    keys = [key] if isinstance(key, str) else list(key)
    places = df.select(*keys, order).dropna(subset=keys)
    if existing is not None:
        places = places.join(existing.select(*keys), keys, "left_anti")
    winners = places.groupBy(*keys).agg(F.min(order).alias(order))
    return df.join(winners, [*keys, order], "left_semi")


# ------------------------------------------------------------------------ I4 / I5 / I6
def existing_keys(table: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """I4: stored keys (distinct), never collected."""
    keys = [key] if isinstance(key, str) else list(key)
    return table.select(*keys).distinct()


def unique_records(df: DataFrame, key: str | Sequence[str], existing: DataFrame,
                   order: str | None = ORDER, dedupe: bool = True) -> DataFrame:
    """Rows whose key is not stored yet, one per key, non-NULL key.
    ``dedupe=False`` when ``df`` is already one row per key (saves a shuffle)."""
    keys = [key] if isinstance(key, str) else list(key)
    if dedupe and order and order in df.columns:
        return first_rows(df, keys, order, existing)
    new = df.join(existing.select(*keys), keys, "left_anti")
    if not dedupe:
        return new.dropna(subset=keys)
    return new.dropna(subset=keys).dropDuplicates(keys)


# ------------------------------------------------------------------------ I7
def add_batch_defaults(postings: DataFrame, data_batch: str) -> DataFrame:
    """Batch label and both duplicate flags set to 'yes'."""
    return with_default_flags(postings.withColumn("data_batch", F.lit(data_batch)))


# ------------------------------------------------------------------------ I8
def new_employers(raw: DataFrame, stored_employers: DataFrame) -> DataFrame:
    """I8: employers of the whole batch not stored yet, first row per name.
    A name repeats in most of its rows and the rows are narrow, so they are
    reduced before the shuffle instead of fetched after it."""
    emp = first_per_key(structure(raw, "employers"), "company_name")
    return unique_records(emp, "company_name", stored_employers, dedupe=False)


# ------------------------------------------------------------------------ I9 / I10
def duplicated_ids(raw: DataFrame, one_row_per_repeat: bool = False) -> DataFrame:
    """Ids occurring more than once over all raw files of a batch.

    Default output: (duplicated_ids, n_occurrences).  ``one_row_per_repeat``
    emits count-1 rows per id, like the original list (an id repeated very
    often then yields many rows, spread over the tasks of its group only)."""
    counts = (raw.filter(F.col("uniq_id").isNotNull()).groupBy("uniq_id")
              .agg(F.count(F.lit(1)).alias("n_occurrences")).filter(F.col("n_occurrences") > 1))
    if one_row_per_repeat:
        return counts.select(F.col("uniq_id").alias("duplicated_ids"),
                             F.explode(F.sequence(F.lit(2), F.col("n_occurrences"))).alias("__k")).drop("__k")
    return counts.select(F.col("uniq_id").alias("duplicated_ids"), "n_occurrences")


def exclude_duplicated(df: DataFrame, dup_ids: DataFrame, policy: str = "drop_all",
                       order: str = ORDER) -> DataFrame:
    """``drop_all`` removes every copy of a duplicated id (stored
    behaviour); ``keep_first`` keeps the first copy in file order."""
    if policy == "drop_all":
        ids = dup_ids.select(F.col("duplicated_ids").alias("uniq_id")).distinct()
        return df.join(ids, "uniq_id", "left_anti")
    if policy == "keep_first":
        return first_rows(df, "uniq_id", order)
    raise ValueError("policy must be 'drop_all' or 'keep_first'")


# ------------------------------------------------------------------------ I11 / I16
def files_not_loaded(raw: DataFrame, stored_positions: DataFrame, sample_rows: int | None = None,
                     seed: int = 472023) -> DataFrame:
    """Files with at least one id not in the stored table, with the
    number of missing ids.  Default: every row is checked; ``sample_rows``
    checks only that many hash-chosen rows per file (``row_number() <= n``,
    planned with a map-side group limit)."""
    ids = raw.select("_file", "uniq_id").filter(F.col("uniq_id").isNotNull())
    if sample_rows:
        from pyspark.sql import Window
        w = Window.partitionBy("_file").orderBy(F.xxhash64("uniq_id", F.lit(seed)), "uniq_id")
        ids = ids.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= sample_rows).drop("__rn")
    stored = stored_positions.select("uniq_id").distinct().withColumn("__hit", F.lit(1))
    return (ids.join(stored, "uniq_id", "left").groupBy(F.col("_file").alias("files"))
            .agg(F.count(F.when(F.col("__hit").isNull(), 1)).alias("n_missing"))
            .filter(F.col("n_missing") > 0))


def rows_per_file(df: DataFrame) -> DataFrame:
    """I16: inserted rows per raw file."""
    return df.groupBy(F.col("_file").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------------------ I12
def integrity_report(df: DataFrame, table: str, key: str | Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct keys, and schema differences against the table."""
    keys = [key] if isinstance(key, str) else list(key or schemas.PRIMARY_KEYS[table])
    expected = set(schemas.SCHEMAS[table].fieldNames())
    actual = set(c for c in df.columns if not c.startswith("_"))
    unknown = sorted(actual - expected)
    missing = sorted(expected - actual)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_distinct(*[F.col(k) for k in keys]).alias("n_keys")).select(
        F.lit(table).alias("table"), "n_rows", "n_keys",
        (F.col("n_rows") == F.col("n_keys")).alias("keys_unique"),
        F.lit(",".join(unknown)).alias("unknown_columns"),
        F.lit(",".join(missing)).alias("missing_columns"))


# ------------------------------------------------------------------------ I13 / I14
def delete_batch(table: DataFrame, postings: DataFrame, data_batch: str | None) -> DataFrame:
    """The table without the rows of a batch (ids looked up in postings);
    no batch -> empty table."""
    if data_batch is None:
        return table.limit(0)
    if "data_batch" in table.columns:
        return table.filter(~F.col("data_batch").eqNullSafe(F.lit(data_batch)))
    ids = postings.filter(F.col("data_batch") == data_batch).select("uniq_id")
    return table.join(ids, "uniq_id", "left_anti")


def remove_orphan_employers(employers: DataFrame, positions: DataFrame) -> DataFrame:
    """Employers still referenced by a position (NULL-safe: a NULL
    employer in positions does not disable the clean-up)."""
    names = positions.filter(F.col("company_name").isNotNull()).select("company_name").distinct()
    return employers.join(names, "company_name", "left_semi")


def remove_orphan_tags(tags: DataFrame, postings: DataFrame) -> DataFrame:
    """Tags whose posting still exists."""
    return tags.join(postings.select("uniq_id"), "uniq_id", "left_semi")


# ------------------------------------------------------------------------ batch update
def ingest_batch(raw: DataFrame, data_batch: str, stored, regions: DataFrame | None = None,
                 dup_policy: str = "drop_all"):
    """The batch update (I1-I10 + G5): new rows for postings, positions and
    employers.  ``raw`` carries ``_file`` / ``_order``; ``stored`` is the
    current database (``JobTables``).  Returns a ``JobTables`` of new rows."""
    raw = rename_raw(raw)
    return new_rows(raw, duplicated_ids(raw), data_batch, stored, regions, dup_policy)


def new_rows(raw: DataFrame, dups: DataFrame, data_batch: str, stored, regions: DataFrame | None = None,
             dup_policy: str = "drop_all"):
    """The batch update with the repeated ids (``duplicated_ids``) given."""
    from ..sources.fixtures import JobTables
    from .regions import attach_region_codes
    # drop_all leaves at most one row per id, so only keep_first has a first row to choose
    post = unique_records(exclude_duplicated(structure(raw, "postings"), dups, dup_policy),
                          "uniq_id", stored.postings, dedupe=False)
    pos = unique_records(exclude_duplicated(structure(raw, "positions"), dups, dup_policy),
                         "uniq_id", stored.positions, dedupe=False)
    if regions is not None:
        pos = attach_region_codes(pos, regions)
    emp = new_employers(raw, stored.employers)
    return JobTables(postings=add_batch_defaults(post.drop("_file", ORDER), data_batch),
                     positions=pos.drop("_file", ORDER), employers=emp.drop("_file", ORDER),
                     regions=stored.regions, ai_tags=None, tech_tags=None)


def table_row_counts(db) -> DataFrame:
    """Rows per stored table, one small union of global counts."""
    out = None
    for name in ("postings", "positions", "employers", "regions", "ai_tags", "tech_tags"):
        t = getattr(db, name)
        if t is None:
            continue
        c = t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        out = c if out is None else out.unionByName(c)
    return out
