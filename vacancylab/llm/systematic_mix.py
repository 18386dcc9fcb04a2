"""Mixing sources to target weights by systematic sampling (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._tables import materialize

#: Weights by the rank of the source, repeating.
WEIGHTS = (3, 1, 2)
#: The mix takes this share of all words; a source gives at most CAP times its words.
SHARE, CAP = 1.5, 2.0
SEED = "mix-1"
#: Rows of one (source, size) that one window task orders at a time.
ROWS_PER_GROUP = 100_000

SPACES = " \t\n\u000b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of maximal runs without ASCII white space; 0 for null."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(bare) > 0, F.size(F.split(bare, SPACE_RUN))).otherwise(0).cast("long")


def _hash32(value: Column) -> Column:
    return F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Target words of every source: (source, source_size, target).

    Sources rank by code point, null last, and weigh ``weights`` in turn.
    ``share`` of all words is dealt by weight; a target stops at ``cap`` times
    its source's words, and the excess is dealt again by weight until no
    target is above.  With sources in the order of cap per weight this has a
    closed form: the level is the first one that its own source can bear.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per.withColumn("rn", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          ((F.col("rn") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("w", weight).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    ranked = ranked.withColumn("ratio", F.col("most") / F.col("w"))
    order = Window.orderBy("ratio", "rn")
    spent = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    levels = ranked.withColumn("level", (F.lit(float(share)) * total - spent) / left)
    levels = levels.withColumn("pos", F.row_number().over(order))
    fits = F.when(F.col("level") <= F.col("ratio"), F.col("pos"))
    level = F.min_by("level", fits).over(Window.partitionBy())
    return levels.select("source", "source_size",
                         F.least("most", level * F.col("w")).alias("target"))


def systematic_copies(sizes: DataFrame, seed: str = SEED, rows_per_group: int = ROWS_PER_GROUP,
                      **shares) -> DataFrame:
    """How often the mix takes each row of ``sizes`` (doc_id, source, size).

    Every document of a source expects target / source_size copies.  Inside a
    source the documents stand in the order of (size, hash of doc_id, doc_id);
    the running sum of expected copies plus one random offset of the source
    gives a document one copy for each integer that it crosses.  As the order
    follows the size, the words taken come near the target, and no document
    is taken more often than ``ceil(target / source_size)`` times.

    The running sum is a rank: offsets of (source, size, slice of the hash)
    from pre-aggregated counts plus a row number inside it, so a source or a
    size that holds a third of all rows is split.  Returns the columns of
    ``sizes`` plus source_size, target, copies, taken.  A null source is a
    source, null doc_ids order as empty, repeated rows are separate
    documents, a source without words is taken 0 times; an empty table gives
    an empty result.
    """
    key = F.when(F.col("source").isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col("source")))
    rows = sizes.select("doc_id", "source", "size").withColumn("sk", key).withColumn(
        "h", _hash32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    targets = source_targets(sizes, **shares).withColumn("sk", key).withColumn(
        "each", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    ).withColumn("start", (_hash32(F.concat("sk", F.lit("|" + seed))) + 0.5) / float(2**32)).drop("source")

    slices = rows.groupBy("sk", "size").agg(
        F.ceil(F.count("*") / float(rows_per_group)).cast("long").alias("n_slices"))
    sliced = rows.join(slices, ["sk", "size"]).withColumn(
        "slice", F.shiftright(F.col("h") * F.col("n_slices"), 32))
    counts = sliced.groupBy("sk", "size", "slice").agg(F.count("*").alias("n"))
    running = Window.partitionBy("sk").orderBy("size", "slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0))).drop("n")
    inside = Window.partitionBy("sk", "size", "slice").orderBy("h", "doc_id")
    ranked = (sliced.withColumn("rn", F.row_number().over(inside))
              .join(offsets, ["sk", "size", "slice"])
              .withColumn("rank", F.col("before") + F.col("rn"))
              .join(targets, "sk"))
    crossed = (F.floor(F.col("rank") * F.col("each") + F.col("start"))
               - F.floor((F.col("rank") - 1) * F.col("each") + F.col("start")))
    return ranked.withColumn("copies", crossed.cast("long")).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def mix_documents(documents: DataFrame, **options) -> DataFrame:
    """``documents`` with every row repeated as often as the mix takes it.

    Rows are matched by (doc_id, source, size); where several rows share all
    three, their copies are dealt evenly among them.
    """
    key = ["doc_id", "source", "__size"]
    sized = documents.withColumn("__size", word_count(F.col("text")))
    narrow = materialize(sized.select("doc_id", "source", F.col("__size").alias("size")), "sizes")
    copies = systematic_copies(narrow, **options).groupBy("doc_id", "source", "size").agg(
        F.sum("copies").alias("__copies"), F.count("*").alias("__rows"))
    copies = materialize(copies.select(F.col("doc_id").alias("__d"), F.col("source").alias("__s"),
                                       F.col("size").alias("__z"), "__copies", "__rows"), "copies")
    # as many rows as documents, so never broadcast
    joined = sized.join(copies.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__d")) & F.col("source").eqNullSafe(F.col("__s"))
                        & (F.col("__size") == F.col("__z")))
    own = F.col("__copies")
    if not copies.where("__rows > 1").isEmpty():
        nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("text")))
        own = F.floor(F.col("__copies") / F.col("__rows")) + F.when(
            nth <= F.col("__copies") % F.col("__rows"), 1).otherwise(0)
    taken = joined.withColumn("__own", own.cast("int")).where("__own > 0")
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__own")))).select(*documents.columns)
