"""Exact-duplicate flagging (D1-D6) and flag resets.

Semantics: within one batch (and an optional geo scope), postings that have a
position row are grouped by ``levels`` (the text, or city + text); every
posting except the one with the smallest ``uniq_id`` of its group is flagged
``'no'``.  NULL values form their own group (SQL ``PARTITION BY``).

Plan at scale: instead of a window sorted over whole texts (one task per hot
text), the grouping key is a 32-byte SHA-256 of the level values.  The first
id per key comes from a partial (map-side combined) ``min`` aggregate - a hot
boilerplate text collapses before the shuffle - and the ids are compared
after an equi-join on the key, where AQE's skew-join handling splits a hot
key's partition on the big side.  Texts themselves are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import (apply_condition, batch_condition, geo_scope_condition)
from ..functions.text import group_key
from ..schemas import FLAG_COLUMNS

POSTING_COLUMNS = {"job_description", "job_title", "crawl_timestamp", "job_board",
                   "text_language", "url", "post_date", "html_job_description"}


def _scoped_rows(postings: DataFrame, positions: DataFrame, data_batch, levels: Sequence[str],
                 restrict_scope_by: str, restrict_to, exclude, digests: bool = False) -> DataFrame:
    """Postings of the batch(es) that have a position row in the geo scope,
    with the level columns (from whichever table holds them).  With
    ``digests`` those of postings are replaced by their SHA-256 before the
    join, so no text is in an exchange (NULL stays NULL)."""
    pos_cols = [c for c in levels if c not in POSTING_COLUMNS]
    post_cols = [c for c in levels if c in POSTING_COLUMNS]
    posn = apply_condition(positions, geo_scope_condition(restrict_scope_by, restrict_to, exclude))
    posn = posn.select("uniq_id", *pos_cols)
    chosen = apply_condition(postings, batch_condition(data_batch)).select(
        "uniq_id", "data_batch", *[F.sha2(F.col(c), 256).alias(c) if digests else F.col(c) for c in post_cols])
    return posn.join(chosen, "uniq_id", "inner")


def duplicate_ids_by_level(postings: DataFrame, positions: DataFrame, data_batch,
                           level_sets: dict[str, Sequence[str]],
                           restrict_scope_by: str = "inferred_country",
                           restrict_to: Sequence[str] | None = None,
                           exclude: Sequence[str] | None = None) -> DataFrame:
    """Ids to flag for several level sets at once: (uniq_id, level).

    One join of postings with positions, one hashing pass per level set, one
    ``min`` aggregate over (level, key) and one join back - texts are read
    and hashed once however many level sets are flagged.
    """
    names = list(level_sets)
    needed = sorted({c for lv in level_sets.values() for c in lv})
    rows = _scoped_rows(postings, positions, data_batch, needed, restrict_scope_by, restrict_to, exclude,
                        digests=True)
    keyed = rows.select("uniq_id", F.explode(F.array(*[
        F.struct(F.lit(n).alias("level"),
                 group_key([F.col("data_batch")] + [F.col(c) for c in level_sets[n]]).alias("gk"))
        for n in names])).alias("k")).select("uniq_id", "k.level", "k.gk")
    firsts = keyed.groupBy("level", "gk").agg(F.min("uniq_id").alias("first_id"))
    return (keyed.join(firsts, ["level", "gk"], "inner")
            .filter(F.col("uniq_id") != F.col("first_id"))
            .select("uniq_id", "level"))


def duplicate_ids(postings: DataFrame, positions: DataFrame, data_batch="all",
                  levels: Sequence[str] = ("job_description",),
                  restrict_scope_by: str = "inferred_country",
                  restrict_to: Sequence[str] | None = None,
                  exclude: Sequence[str] | None = None) -> DataFrame:
    """Ids to flag - all but the smallest ``uniq_id`` per group.

    ``data_batch`` may be one batch, a list or ``"all"``; batches never mix
    (each batch is deduplicated on its own, like one cleaner run per batch).
    """
    out = duplicate_ids_by_level(postings, positions, data_batch, {"l": list(levels)},
                                 restrict_scope_by, restrict_to, exclude)
    return out.select("uniq_id")


def duplicate_ids_window(postings: DataFrame, positions: DataFrame, data_batch="all",
                         levels: Sequence[str] = ("job_description",),
                         restrict_scope_by: str = "inferred_country",
                         restrict_to=None, exclude=None) -> DataFrame:
    """Reference formulation (``row_number() over (partition by levels order
    by uniq_id) > 1``) over digests of the levels; a group is ordered in one
    task, so this form only checks ``duplicate_ids`` in tests and queries."""
    from pyspark.sql import Window
    rows = _scoped_rows(postings, positions, data_batch, levels, restrict_scope_by, restrict_to, exclude, digests=True)
    w = Window.partitionBy("data_batch", *levels).orderBy("uniq_id")
    return rows.withColumn("rn", F.row_number().over(w)).filter("rn > 1").select("uniq_id")


def apply_flags(postings: DataFrame, flagged: DataFrame, update_value: str = "no") -> DataFrame:
    """Lower the flag columns named in ``flagged`` (uniq_id, level) for
    those ids; other rows keep their value.  ``postings`` is joined once."""
    marks = flagged.groupBy("uniq_id").agg(F.collect_set("level").alias("__lv"))
    out = postings.join(marks, "uniq_id", "left")
    for col in FLAG_COLUMNS:
        if col in postings.columns:
            hit = F.coalesce(F.array_contains(F.col("__lv"), F.lit(col)), F.lit(False))
            out = out.withColumn(col, F.when(hit, F.lit(update_value)).otherwise(F.col(col)))
    return out.select(*postings.columns)


LEVELS = {"unique_posting_text": ["job_description"],
          "unique_posting_textlocation": ["city", "job_description"]}


def flag_rows(flags: DataFrame, texts: DataFrame, positions: DataFrame, data_batch="all",
              restrict_scope_by: str = "inferred_country", restrict_to=None, exclude=None) -> DataFrame:
    """D4 on a narrow table: ``flags`` (uniq_id, data_batch and the flag
    columns) with the flags of D1 and D2 lowered.  ``texts`` holds the
    postings' texts, which leave the scan as digests only."""
    return apply_flags(flags, duplicate_ids_by_level(texts, positions, data_batch, LEVELS, restrict_scope_by,
                                                     restrict_to, exclude))


def clean_duplicates(postings: DataFrame, positions: DataFrame, data_batch="all",
                     restrict_scope_by: str = "inferred_country", restrict_to=None,
                     exclude=None) -> DataFrame:
    """D1 + D2 + D4: both duplicate flags for the batch(es); rows outside the
    batch or scope keep their flags (flags are only ever lowered)."""
    flagged = duplicate_ids_by_level(postings, positions, data_batch, LEVELS, restrict_scope_by, restrict_to, exclude)
    return apply_flags(postings, flagged)


def with_default_flags(postings: DataFrame, value: str = "yes") -> DataFrame:
    """I7 default: both flags set to ``value``."""
    return postings.withColumns({"unique_posting_text": F.lit(value),
                                 "unique_posting_textlocation": F.lit(value)})


def reset_flag(postings: DataFrame, positions: DataFrame, column: str, default_value: str,
               data_batch: str, restrict_to_countries=None, exclude_countries=None) -> DataFrame:
    """Set ``column`` to ``default_value`` for a batch, optionally only
    for / except some countries (a NULL country is in neither set)."""
    if restrict_to_countries and exclude_countries:
        raise ValueError("a reset either names countries or leaves some out, not both")
    cond = F.col("data_batch") == F.lit(data_batch)
    if restrict_to_countries or exclude_countries:
        if restrict_to_countries:
            sel = F.col("inferred_country").isin(list(restrict_to_countries))
        else:
            sel = ~F.col("inferred_country").isin(list(exclude_countries))
        ids = positions.filter(sel).select("uniq_id").distinct().withColumn("__in", F.lit(True))
        out = postings.join(ids, "uniq_id", "left")
        cond = cond & F.col("__in").isNotNull()
        return (out.withColumn(column, F.when(cond, F.lit(default_value)).otherwise(F.col(column)))
                .drop("__in").select(*postings.columns))
    return postings.withColumn(column, F.when(cond, F.lit(default_value)).otherwise(F.col(column)))


def flag_summary(postings: DataFrame, data_batch="all") -> DataFrame:
    """Per flag column and value, the number of postings."""
    scope = apply_condition(postings, batch_condition(data_batch))
    stacked = scope.select(F.explode(F.array(
        F.struct(F.lit("unique_posting_text").alias("flag"), F.col("unique_posting_text").alias("value")),
        F.struct(F.lit("unique_posting_textlocation").alias("flag"),
                 F.col("unique_posting_textlocation").alias("value")))).alias("s"))
    return stacked.groupBy("s.flag", "s.value").agg(F.count(F.lit(1)).alias("n_postings"))


def unique_share_by_country(postings: DataFrame, positions: DataFrame, data_batch,
                            flag: str = "unique_posting_text") -> DataFrame:
    """Per country of a batch: postings, unique postings and their share
    rounded half-up to 3 digits (NULL country is a group)."""
    chosen = apply_condition(postings, batch_condition(data_batch)).select("uniq_id", flag)
    rows = chosen.join(positions.select("uniq_id", "inferred_country"), "uniq_id", "inner")
    agg = rows.groupBy(F.col("inferred_country").alias("country")).agg(
        F.count(F.lit(1)).alias("n_postings"),
        F.count(F.when(F.col(flag) == "yes", 1)).alias("n_unique"))
    return agg.withColumn("share_unique",
                          F.floor(F.col("n_unique") * 1000.0 / F.col("n_postings") + 0.5) / 1000.0)
