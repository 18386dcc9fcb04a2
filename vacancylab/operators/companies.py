"""Company-level AI-share study.

Firm patterns are an ordered table: the employer match (P8) and the
canonical-name rule (C6, first pattern in list order wins) are joins of the
distinct employer names with the patterns' rarest pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import apply_condition, batch_condition, name_exclusion_condition
from ..functions.text import truncate_prefixed
from ._util import null_safe_join

# Parent-company search patterns and canonical names, in order.
PHARMA_FIRMS = [
    ("johnson & johnson", "Johnson & Johnson"), ("roche", "Roche"), ("pfizer", "Pfizer"),
    ("novartis", "Novartis"), ("merck", "Merck & Co."), ("glaxo smith kline", "Glaxo Smith Kline"),
    ("glaxosmithkline", "Glaxo Smith Kline"), ("sanofi", "Sanofi"), ("abbvie", "AbbVie"),
    ("astra zeneca", "Astra Zeneca"), ("astrazeneca", "Astra Zeneca"),
    ("bristol myers", "Bristol Myers Squibb"), ("myers squibb", "Bristol Myers Squibb"),
    ("eli lilly", "Eli Lilly"), ("amgen", "Amgen"), ("gilead", "Gilead Sciences"),
    ("novo nordisk", "Novo Nordisk"), ("bayer", "Bayer"), ("takeda", "Takeda"),
    ("boehringer", "Boehringer Ingelheim"), ("teva", "Teva"), ("allergan", "Allergan"),
    ("daiichi sankyo", "Daiichi Sankyo"),
]
# Employer-name tokens excluded as false positives.
PHARMA_EXCLUSIONS = ["bayern", "bayerisch", "rochester", "johanniter", "falcon farms", "broadcasting"]


# ------------------------------------------------------------------------ C1
def firm_patterns(parents: DataFrame, subsidiaries: DataFrame | None = None) -> DataFrame:
    """(pattern_order, firm_name_pattern, firm_name); subsidiaries are
    appended after the parents and a repeated pattern keeps its first row."""
    p = parents.select("pattern_order", "firm_name_pattern", "firm_name")
    if subsidiaries is not None:
        last = p.agg(F.max("pattern_order")).first()[0]
        off = 0 if last is None else last + 1
        p = p.unionByName(subsidiaries.select((F.col("pattern_order") + off).alias("pattern_order"),
                                              "firm_name_pattern", "firm_name"))
    w = Window.partitionBy("firm_name_pattern").orderBy("pattern_order")
    return p.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


#: Length of the pieces by which patterns and names meet; shorter patterns are pieces themselves.
GRAM = 4


def _grams(text, length):
    """Distinct pieces of ``length`` characters; one empty piece for length 0."""
    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - length + 1))
    return F.array_distinct(F.transform(F.when(length <= F.length(text), F.when(length == 0, F.array(F.lit(1))).otherwise(places)),
                                        lambda i: F.substr(text, i, length)))


def matching_patterns(names: DataFrame, patterns: DataFrame, fold_case: bool = True) -> DataFrame:
    """P8 as data: (company_name, pattern_order, firm_name_pattern, firm_name) for
    every distinct name and pattern that the name contains, with or without
    regard to case.

    A pattern is posted under its rarest piece of four characters (by the number
    of names that hold it); names meet it by an equi-join on their pieces and
    are compared whole behind it.  Neither side passes the driver and no
    expression grows with the patterns.  Shorter patterns are pieces of their
    own length (an empty one is in every name); NULL names and patterns match nothing."""
    def folded(column: str):
        return F.lower(column) if fold_case else F.col(column)
    known = (names.where(F.col("company_name").isNotNull()).select("company_name").distinct()
             .withColumn("__name", folded("company_name")))
    wanted = (patterns.where(F.col("firm_name_pattern").isNotNull())
              .select("pattern_order", "firm_name_pattern", "firm_name", folded("firm_name_pattern").alias("__pattern")))
    lengths = wanted.select(F.least(F.lit(GRAM), F.length("__pattern")).alias("__length")).distinct()
    # five lengths at most, one where all patterns have four characters
    pieces = (known.select("company_name", "__name", F.explode(F.array(*map(F.lit, range(GRAM + 1)))).alias("__length"))
              .join(F.broadcast(lengths), "__length", "left_semi")
              .select("company_name", "__name", F.explode(_grams(F.col("__name"), F.col("__length"))).alias("__gram")))
    texts = wanted.select("__pattern").distinct()
    keys = texts.select("__pattern", F.explode(_grams(F.col("__pattern"), F.least(F.lit(GRAM), F.length("__pattern")))).alias("__gram"))
    held = (pieces.join(keys.select("__gram").distinct(), "__gram", "left_semi")
            .groupBy("__gram").agg(F.count(F.lit(1)).alias("__n")))
    # a piece that no name holds settles its pattern: it occurs nowhere
    rarest = (keys.join(held, "__gram", "left").groupBy("__pattern")
              .agg(F.min_by("__gram", F.struct(F.coalesce("__n", F.lit(0)).alias("n"), "__gram")).alias("__gram")))
    met = pieces.join(rarest, "__gram").where(F.col("__name").contains(F.col("__pattern")))
    return (met.join(wanted, "__pattern")
            .select("company_name", "pattern_order", "firm_name_pattern", "firm_name"))


def patterns_present(patterns: DataFrame, employers: DataFrame) -> DataFrame:
    """Patterns that occur in at least one employer name, in any case."""
    found = matching_patterns(employers, patterns).select("firm_name_pattern").distinct()
    return patterns.join(found, "firm_name_pattern", "left_semi").select(*patterns.columns)


def patterns_from_list(spark, firms: Sequence[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame([(i, p, f) for i, (p, f) in enumerate(firms)],
                                 "pattern_order int, firm_name_pattern string, firm_name string")


# ------------------------------------------------------------------------ C2 / C3
def _matched_postings(db, patterns: DataFrame, exclusions: Sequence[str], data_batch: str,
                      distinct_only: bool) -> DataFrame:
    kept = db.employers.where(name_exclusion_condition("company_name", exclusions))
    employers = matching_patterns(kept, patterns).select("company_name").distinct()
    posn = db.positions.select("company_name", "uniq_id", "nuts_2").join(employers, "company_name", "left_semi")
    chosen = apply_condition(db.postings, batch_condition(data_batch))
    if distinct_only:
        chosen = chosen.filter(F.col("unique_posting_text") == "yes")
    return posn.join(chosen.select("uniq_id"), "uniq_id", "inner")


def company_region_postings(db, patterns: DataFrame, exclusions: Sequence[str] = PHARMA_EXCLUSIONS,
                            data_batch: str = "all", distinct_only: bool = True) -> DataFrame:
    """Postings per (employer, nuts_2) for employers matching a pattern."""
    rows = _matched_postings(db, patterns, exclusions, data_batch, distinct_only)
    return rows.groupBy("company_name", "nuts_2").agg(F.count(F.lit(1)).alias("n_postings"))


def company_region_ai_postings(db, patterns: DataFrame, exclusions: Sequence[str] = PHARMA_EXCLUSIONS,
                               data_batch: str = "all", distinct_only: bool = True) -> DataFrame:
    """AI postings per (employer, nuts_2)."""
    rows = _matched_postings(db, patterns, exclusions, data_batch, distinct_only)
    rows = rows.join(db.ai_tags.select("uniq_id"), "uniq_id", "inner")
    return rows.groupBy("company_name", "nuts_2").agg(F.count(F.lit(1)).alias("n_ai_postings"))


def company_regions_of_batches(db, first: str, second: str) -> DataFrame:
    """Postings per (employer, nuts_2) of two batches side by side, a
    NULL-safe full outer join (NULL employers and regions are keys, too)."""
    def counted(batch: str, name: str) -> DataFrame:
        chosen = db.postings.filter((F.col("data_batch") == batch) & (F.col("unique_posting_textlocation") == "yes"))
        return (db.positions.select("uniq_id", "company_name", "nuts_2").join(chosen.select("uniq_id"), "uniq_id")
                .groupBy("company_name", "nuts_2").agg(F.count(F.lit(1)).alias(name)))
    return null_safe_join(counted(first, "n_first"), counted(second, "n_second"), ["company_name", "nuts_2"],
                          "full").fillna(0, ["n_first", "n_second"])


# ------------------------------------------------------------------------ C4 / C5
def matched_employer_count(counts: DataFrame) -> DataFrame:
    """C4: number of distinct matched employer names."""
    return counts.agg(F.countDistinct("company_name").alias("n_employers"))


def false_positive_review(total: DataFrame, min_postings: int = 50) -> DataFrame:
    """Employers with at least ``min_postings`` postings, descending."""
    return (total.groupBy("company_name").agg(F.sum("n_postings").cast("bigint").alias("n_postings"))
            .filter(F.col("n_postings") >= min_postings)
            .orderBy(F.col("n_postings").desc(), "company_name"))


# ------------------------------------------------------------------------ C6
def canonical_firm_names(names: DataFrame, patterns: DataFrame) -> DataFrame:
    """(company_name, firm_name) of the names that contain a pattern
    (case-sensitive): the firm of the first one in list order."""
    first = F.min_by("firm_name", F.struct("pattern_order", "firm_name_pattern", "firm_name"))
    return matching_patterns(names, patterns, fold_case=False).groupBy("company_name").agg(first.alias("firm_name"))


# ------------------------------------------------------------------------ C7 / C8
def company_ai_shares(db, patterns: DataFrame, exclusions: Sequence[str] = PHARMA_EXCLUSIONS,
                      data_batch: str = "all", distinct_only: bool = True,
                      uk_prefix: str = "UK", uk_length: int = 3) -> DataFrame:
    """Per canonical firm and region: n_postings, n_ai_postings (0 when
    none), ai_share (NULL when there are no AI postings: computed before the
    zero fill), region name and country from the OECD level-2 rows."""
    tags = db.ai_tags.groupBy("uniq_id").agg(F.count(F.lit(1)).alias("tags"))
    named = (_matched_postings(db, patterns, exclusions, data_batch, distinct_only)
             .join(tags, "uniq_id", "left").groupBy("company_name", "nuts_2")
             .agg(F.count(F.lit(1)).alias("n_postings"), F.sum("tags").alias("n_ai_postings")))
    # few rows by now: one per employer name and region
    firms = canonical_firm_names(db.employers, patterns)
    res = (named.join(firms, "company_name", "left")
           .groupBy(F.coalesce("firm_name", "company_name").alias("company_name"), "nuts_2")
           .agg(F.sum("n_postings").cast("bigint").alias("n_postings"), F.sum("n_ai_postings").cast("bigint").alias("n_ai_postings")))
    res = (res.withColumn("ai_share", F.col("n_ai_postings") / F.col("n_postings"))
           .withColumn("n_ai_postings", F.coalesce("n_ai_postings", F.lit(0).cast("bigint"))))
    res = res.withColumn("nuts_2", truncate_prefixed(F.col("nuts_2"), uk_prefix, uk_length))
    country = F.col("iso_2") if "iso_2" in db.regions.columns else F.lit(None).cast("string")
    names = (db.regions.filter(F.col("oecd_level") == 2)
             .select("name_en", F.coalesce("nuts_2", "oecd_tl2").alias("nuts_2"), country.alias("country")))
    return null_safe_join(res, names, ["nuts_2"], "left").select(
        "company_name", "nuts_2", "n_postings", "n_ai_postings", "ai_share", "name_en", "country")


# ------------------------------------------------------------------------ C9 / C10
def top_companies_by_ai_share(shares: DataFrame, k: int = 20, min_postings: int | None = None) -> DataFrame:
    """Firms by AI share over all regions; share > 0 and, for C10,
    ``n_postings > min_postings``; top k descending (ties by name)."""
    agg = shares.groupBy("company_name").agg(
        F.sum("n_ai_postings").cast("bigint").alias("n_ai_postings"),
        F.sum("n_postings").cast("bigint").alias("n_postings"))
    agg = agg.withColumn("ai_share", F.col("n_ai_postings") / F.col("n_postings"))
    cond = F.col("ai_share") > 0
    if min_postings is not None:
        cond = cond & (F.col("n_postings") > min_postings)
    return agg.filter(cond).orderBy(F.col("ai_share").desc(), "company_name").limit(k)
