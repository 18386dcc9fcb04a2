"""Reproducible samples.

Random order is replaced by a seeded hash order, ``md5(key || seed)``, so a
sample is reproducible and the same in SQL.  Exact "first n by hash" is done
without funnelling n rows through one task: a histogram of 20-bit hash
prefixes (at most 2^20 small rows) locates the prefix bucket where the n-th
row falls; rows of lower buckets are taken by a plain filter, and only the
rows of that single bucket (about N / 2^20) are ordered and cut.

"First n per group" uses buckets that double with the hash, some to each
doubling: a few hundred small rows per group, and the bucket of the n-th row
holds a fixed share of n rows whatever the size of the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import null_safe_join

PREFIX_HEX = 5          # 20-bit buckets
MAX_BUCKETS = 16 ** PREFIX_HEX
STEPS = 8               # buckets to each doubling of the hash: the last one holds about n / 11 rows


def hash_order(key: Column, seed) -> Column:
    """Seeded pseudo-random order key (hex string), NULL keys hash as ''."""
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(str(seed))))


def hash_top_n(df: DataFrame, n: int | None, key: str, seed=472023, share: float | None = None) -> DataFrame:
    """Exactly the ``n`` rows with the smallest ``hash_order(key, seed)`` (ties
    by key), or ``int(rows * share)`` of them; no job runs while the plan is
    built."""
    h = hash_order(F.col(key), seed)
    bucket = F.conv(F.substring(h, 1, PREFIX_HEX), 16, 10).cast("long")
    hist = df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("in_bucket"))
    wanted = F.lit(n) if share is None else F.floor(F.sum("in_bucket").over(Window.partitionBy()) * F.lit(float(share)))
    # at most 2^20 rows, whatever the size of the table
    upto = hist.withColumn("upto", F.sum("in_bucket").over(Window.orderBy("b"))).withColumn("wanted", wanted)
    cut = upto.where("upto >= wanted").agg(
        F.min_by(F.struct("b", (F.col("wanted") - F.col("upto") + F.col("in_bucket")).alias("need")), "b").alias("cut"))
    last = F.coalesce(cut.select("cut.b").scalar(), F.lit(MAX_BUCKETS))
    below = df.where(bucket < last)
    nth = F.row_number().over(Window.partitionBy("__b").orderBy("__h", key))
    edge = (df.withColumn("__b", bucket).where(F.col("__b") == last).withColumn("__h", h).withColumn("__nth", nth)
            .where(F.col("__nth") <= F.coalesce(cut.select("cut.need").scalar(), F.lit(0))))
    return below.unionByName(edge.select(*df.columns))


def overall_random_sample(positions: DataFrame, sample_share: float = 0.002, seed=472023) -> DataFrame:
    """``int(rows * share)`` random positions: (uniq_id, company_name)."""
    return hash_top_n(positions.select("uniq_id", "company_name"), None, "uniq_id", seed, share=sample_share)


def log_bucket(place: Column) -> Column:
    """Bucket of a number from 0 on, ``STEPS`` to each doubling; larger numbers
    never fall into smaller buckets."""
    return F.floor(F.log2(place.cast("double") + 1) * STEPS).cast("int")


def group_cuts(df: DataFrame, n: int, group: list[str], bucket: Column) -> DataFrame:
    """(group columns, ``__cut``): the bucket in which the n-th row of a group
    falls; no row for a group of fewer rows.  Rows are counted per (group,
    bucket) before any shuffle, so a hot group is no hot task."""
    hist = df.groupBy(*group, bucket.alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    upto = F.sum("__n").over(Window.partitionBy(*group).orderBy("__b"))
    return (hist.withColumn("__upto", upto).where(F.col("__upto") >= n)
            .groupBy(*group).agg(F.min("__b").alias("__cut")))


def country_sample(positions: DataFrame, n_postings: int = 200, seed=472023) -> DataFrame:
    """At most ``n_postings`` random positions per inferred country
    (NULL country is a group).  A cut per country leaves about n rows of each,
    so that the exact ``row_number() <= n`` behind it orders n rows and one
    bucket, however many rows a country has.  Ties in hash go by id."""
    rows = positions.select("uniq_id", "company_name", "inferred_country")
    h = hash_order(F.col("uniq_id"), seed)
    # the first 52 bits: exact as double, in the order of the whole hash
    bucket = log_bucket(F.conv(F.substring(h, 1, 13), 16, 10))
    cuts = group_cuts(rows, n_postings, ["inferred_country"], bucket)
    near = (null_safe_join(rows.withColumn("__b", bucket), cuts, ["inferred_country"])
            .where(F.col("__cut").isNull() | (F.col("__b") <= F.col("__cut"))))
    w = Window.partitionBy("inferred_country").orderBy(h, "uniq_id")
    return (near.withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") <= n_postings).select("uniq_id", "company_name"))


def development_sample_ids(positions: DataFrame, sample_share: float = 0.002, n_per_country: int = 200,
                           seed=472023) -> DataFrame:
    """Union of R1 and R2; rows with NULL id or employer dropped; each id once."""
    both = overall_random_sample(positions, sample_share, seed).unionByName(
        country_sample(positions, n_per_country, seed))
    return both.dropna(subset=["uniq_id", "company_name"]).select("uniq_id").distinct()


def referential_subset(db, ids: DataFrame):
    """The four id-keyed tables restricted to ``ids``; employers restricted
    to the (non-NULL) names of the kept positions; regions whole."""
    from ..sources.fixtures import JobTables
    keep = lambda t: None if t is None else t.join(ids, "uniq_id", "left_semi")
    positions = keep(db.positions)
    names = positions.filter(F.col("company_name").isNotNull()).select("company_name").distinct()
    employers = db.employers.join(names, "company_name", "left_semi")
    return JobTables(postings=keep(db.postings), positions=positions, employers=employers,
                     regions=db.regions, ai_tags=keep(db.ai_tags), tech_tags=keep(db.tech_tags))


def period_posting_sample(postings_with_company: DataFrame, n: int, seed=472023) -> DataFrame:
    """At most ``n`` random postings of a period."""
    return hash_top_n(postings_with_company, n, "uniq_id", seed)
