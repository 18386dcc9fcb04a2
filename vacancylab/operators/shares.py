"""Distributions and shares over periods.

All period-aware operators take a list of *samples*: ``"full_sample"`` and/or
months ``'YYYY-MM'``.  Instead of one query per period (four scans for the
full sample plus three months), postings are counted once by month, and the
full sample is the sum of the months' counts: every posting crosses the joins
once, and only counts are dealt out to the samples.  Totals per sample come
from a window over the small aggregated result, never over postings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import month_of
from ._util import broadcast_if_small

FULL = "full_sample"


def _samples(samples) -> list[str]:
    if isinstance(samples, str):
        return [samples]
    return list(samples)


def posting_months(postings: DataFrame, samples, cleaned_duplicates: bool = True,
                   flag: str = "unique_posting_textlocation") -> DataFrame:
    """(uniq_id, month) of every posting that falls into a requested sample."""
    samples = _samples(samples)
    chosen = postings
    if cleaned_duplicates:
        chosen = chosen.filter(F.col(flag) == "yes")
    if FULL not in samples:
        chosen = chosen.filter(month_of().isin(samples))
    return chosen.select("uniq_id", month_of().alias("month"))


def counts_by_sample(monthly: DataFrame, samples, counts: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Counts by month (and ``group``) added up for each requested sample; a
    month that is NULL or not requested counts in the full sample only."""
    samples = _samples(samples)
    months = [s for s in samples if s != FULL]
    of = [F.lit(FULL)] if FULL in samples else []
    if months:
        of.append(F.when(F.col("month").isin(months), F.col("month")))
    dealt = monthly.select(*group, *counts, F.explode(F.array_compact(F.array(*of))).alias("sample"))
    return dealt.groupBy("sample", *group).agg(*[F.sum(c).alias(c) for c in counts])


def _region_dim(regions: DataFrame, nuts_level: int) -> DataFrame:
    """Code -> one name (the smallest) at a NUTS level; deduplicated so a code
    with several names cannot multiply counts."""
    col = f"nuts_{nuts_level}"
    dim = (regions.filter(F.col("nuts_level") == nuts_level)
           .groupBy(F.col(col).alias("region_code")).agg(F.min("name_en").alias("region")))
    return broadcast_if_small(dim)


def _share_within_sample(df: DataFrame, count_col: str, share_col: str) -> DataFrame:
    total = F.sum(count_col).over(Window.partitionBy("sample"))
    return df.withColumn(share_col, F.col(count_col) / total)


# ------------------------------------------------------------------------ A7
def geo_dist(db, samples=FULL, nuts_level: int = 2, cleaned_duplicates: bool = True) -> DataFrame:
    """Postings per region code and sample, any region name, and share of
    the sample total (the NULL region stays in the denominator)."""
    col = f"nuts_{nuts_level}"
    ids = posting_months(db.postings, samples, cleaned_duplicates)
    posn = db.positions.select("uniq_id", F.col(col).alias("region_code"))
    monthly = (posn.join(ids, "uniq_id", "inner")
               .groupBy("month", "region_code").agg(F.count(F.lit(1)).alias("total_postings")))
    counts = counts_by_sample(monthly, samples, ["total_postings"], ["region_code"])
    named = counts.join(_region_dim(db.regions, nuts_level), "region_code", "left")
    out = _share_within_sample(named, "total_postings", "postings_share")
    return out.select("sample", "region_code", "region", "total_postings", "postings_share")


# ------------------------------------------------------------------------ A8
def _tags(db, tech: str) -> DataFrame:
    if tech == "tech":
        return db.tech_tags.select("uniq_id")
    if tech == "ai":
        return db.ai_tags.select("uniq_id")
    raise ValueError(f"Invalid tech {tech!r}; use 'tech' or 'ai'.")


TECH_TABLE = {"tech": "tech_tags", "ai": "ai_tags"}


def tech_share(db, samples=FULL, tech: str = "tech", cleaned_duplicates: bool = True) -> DataFrame:
    """Distinct tagged postings / all postings of the sample."""
    ids = posting_months(db.postings, samples, cleaned_duplicates)
    tagged = _tags(db, tech).distinct().withColumn("__t", F.lit(1))
    monthly = ids.join(tagged, "uniq_id", "left").groupBy("month").agg(
        F.count(F.when(F.col("__t") == 1, 1)).alias("tech_postings"),
        F.count(F.lit(1)).alias("total_postings"))
    return (counts_by_sample(monthly, samples, ["tech_postings", "total_postings"])
        .withColumn("tech", F.lit(TECH_TABLE[tech]))
        .withColumn("share", F.col("tech_postings") / F.col("total_postings"))
        .select("sample", "tech", "tech_postings", "total_postings", "share"))


# ------------------------------------------------------------------------ A9
def spatial_tech(db, samples=FULL, tech: str = "tech", cleaned_duplicates: bool = True) -> DataFrame:
    """Tagged postings per NUTS-2 region and sample; rows with a NULL code
    or name are dropped before the share is taken."""
    ids = posting_months(db.postings, samples, cleaned_duplicates)
    posn = (db.positions.join(_tags(db, tech).distinct(), "uniq_id", "left_semi")
          .select("uniq_id", F.col("nuts_2").alias("region_code")))
    monthly = (posn.join(ids, "uniq_id", "inner")
               .groupBy("month", "region_code").agg(F.count(F.lit(1)).alias("n_postings")))
    counts = counts_by_sample(monthly, samples, ["n_postings"], ["region_code"])
    named = (counts.join(_region_dim(db.regions, 2), "region_code", "left")
             .dropna(subset=["region_code", "region"]))
    out = _share_within_sample(named, "n_postings", "share").withColumn("tech", F.lit(TECH_TABLE[tech]))
    return out.select("sample", "tech", "region_code", "region", "n_postings", "share")


# ------------------------------------------------------------------------ A10
def field_shares(db, samples=FULL, cleaned_duplicates: bool = True) -> DataFrame:
    """A10: distinct tagged postings per technology field / sum over fields.
    A posting has one month, so the months' distinct counts add up."""
    ids = posting_months(db.postings, samples, cleaned_duplicates)
    rows = db.tech_tags.select("uniq_id", F.col("bloom_field").alias("field")).join(ids, "uniq_id", "inner")
    monthly = rows.groupBy("month", "field").agg(F.countDistinct("uniq_id").alias("tech_postings"))
    counts = counts_by_sample(monthly, samples, ["tech_postings"], ["field"])
    return _share_within_sample(counts, "tech_postings", "share").select(
        "sample", "field", "tech_postings", "share")


# ------------------------------------------------------------------------ A11
def complete_panel(df: DataFrame, group: str, n_periods: int, period: str = "sample") -> DataFrame:
    """Keep groups present in all ``n_periods`` periods."""
    n = F.count(F.lit(1)).over(Window.partitionBy(group))
    return df.withColumn("__n", n).filter(F.col("__n") == n_periods).drop("__n")


# ------------------------------------------------------------------------ A12
def month_distribution(db, cleaned_duplicates: bool = True) -> DataFrame:
    """Postings per month, share of all, and the mean share over months."""
    chosen = db.postings
    if cleaned_duplicates:
        chosen = chosen.filter(F.col("unique_posting_textlocation") == "yes")
    counts = chosen.groupBy(month_of().alias("month")).agg(F.count(F.lit(1)).alias("n_postings"))
    w = Window.partitionBy()
    return (counts.withColumn("share", F.col("n_postings") / F.sum("n_postings").over(w))
            .withColumn("mean_share", F.avg("share").over(w)))


# ------------------------------------------------------------------------ A13
def period_panel(db, months: Sequence[str], measure: str = "nuts_2",
                 drop_regions: Sequence[str] = (), cleaned_duplicates: bool = True) -> DataFrame:
    """Full sample + the given months in one pass; incomplete groups are
    dropped.  ``measure``: 'nuts_2' / 'nuts_3' (A7), 'tech' / 'ai' (A9),
    'fields' (A10)."""
    samples = [FULL, *months]
    n = len(samples)
    if measure in ("nuts_2", "nuts_3"):
        df = geo_dist(db, samples, int(measure[-1]), cleaned_duplicates).dropna(subset=["region_code", "region"])
        group = "region"
    elif measure in ("tech", "ai"):
        df = spatial_tech(db, samples, measure, cleaned_duplicates)
        group = "region"
    elif measure == "fields":
        df = field_shares(db, samples, cleaned_duplicates)
        group = "field"
    else:
        raise ValueError(f"unknown measure {measure!r}")
    if drop_regions:
        df = df.filter(~F.col(group).isin(list(drop_regions)))
    return complete_panel(df, group, n)


def sample_totals(db, months: Sequence[str], cleaned_duplicates: bool = True) -> DataFrame:
    """A13 totals: postings per sample (full sample and each month), one pass."""
    samples = [FULL, *months]
    monthly = (posting_months(db.postings, samples, cleaned_duplicates)
               .groupBy("month").agg(F.count(F.lit(1)).alias("total_postings")))
    return counts_by_sample(monthly, samples, ["total_postings"])


# ------------------------------------------------------------------------ A14 / A15
def with_share(df: DataFrame, count_col: str, share_col: str) -> DataFrame:
    """Share of a count column over all rows (for external statistics)."""
    return df.withColumn(share_col, F.col(count_col) / F.sum(count_col).over(Window.partitionBy()))


def external_comparison(db, employment: DataFrame, vacancies: DataFrame,
                        cleaned_duplicates: bool = True) -> DataFrame:
    """NUTS-2 postings share vs employment share vs vacancy share, with
    ``abs_diff = postings - employed`` and ``rel_diff = abs_diff / employed``.
    ``employment`` has (nuts_2, employed_share); ``vacancies`` (nuts_2, vacancy_share)."""
    dist = (geo_dist(db, FULL, 2, cleaned_duplicates).dropna(subset=["region_code", "region"])
            .select(F.col("region_code").alias("nuts_2"), "region", "postings_share"))
    out = (employment.select("nuts_2", "employed_share")
           .join(vacancies.select("nuts_2", "vacancy_share"), "nuts_2", "inner")
           .join(dist, "nuts_2", "inner"))
    return (out.withColumn("abs_diff", F.col("postings_share") - F.col("employed_share"))
            .withColumn("rel_diff", F.col("abs_diff") / F.col("employed_share"))
            .select("nuts_2", "region", "postings_share", "employed_share", "vacancy_share",
                    "abs_diff", "rel_diff"))


def shares_long(df: DataFrame, ids: Sequence[str] = ("nuts_2", "region"),
                measures: Sequence[str] = ("postings", "employed", "vacancy")) -> DataFrame:
    """Wide shares -> long (measure, share)."""
    return df.unpivot(list(ids), [f"{m}_share" for m in measures], "measure", "share").withColumn(
        "measure", F.regexp_replace("measure", "_share$", ""))
