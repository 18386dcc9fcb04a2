"""Regional assignment and region dimension helpers.

G1 matches ``state`` then ``inferred_state`` against the region names in
English, German and French; for each level (nuts_2, nuts_3) independently the
first non-NULL code wins.  A name that maps to several region rows uses the
largest non-NULL code (deterministic stand-in for an arbitrary pick).

The region grid is a dimension bounded by geography (thousands of rows), so
the name lookup is pivoted to one row per name and broadcast after a size
check: two map-side hash joins, no shuffle of ``positions``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import broadcast_if_small, null_safe_join

LANGS = ("en", "de", "fr")
LEVELS = ("nuts_2", "nuts_3")


# ------------------------------------------------------------------------ G1
def name_lookup(regions: DataFrame) -> DataFrame:
    """One row per region name with the largest code per (language, level):
    columns ``name, nuts_2_en, nuts_2_de, nuts_2_fr, nuts_3_en, ...``."""
    stacked = regions.select(F.explode(F.array(*[
        F.struct(F.col(f"name_{l}").alias("name"), F.lit(l).alias("lang"),
                 F.col("nuts_2").alias("nuts_2"), F.col("nuts_3").alias("nuts_3"))
        for l in LANGS])).alias("s")).select("s.*").filter(F.col("name").isNotNull())
    aggs = [F.max(F.when(F.col("lang") == l, F.col(lv))).alias(f"{lv}_{l}")
            for lv in LEVELS for l in LANGS]
    return stacked.groupBy("name").agg(*aggs)


def match_regions(positions: DataFrame, regions: DataFrame,
                  match_columns=("state", "inferred_state")) -> DataFrame:
    """G1: set ``nuts_2``/``nuts_3`` from exact name matches (overwrites)."""
    lookup = broadcast_if_small(name_lookup(regions))
    out = positions.drop(*[c for c in LEVELS if c in positions.columns])
    picks: dict[str, list[Column]] = {lv: [] for lv in LEVELS}
    for i, mc in enumerate(match_columns):
        lk = lookup.select(F.col("name").alias(f"__k{i}"),
                           *[F.col(f"{lv}_{l}").alias(f"__{lv}_{l}_{i}") for lv in LEVELS for l in LANGS])
        out = out.join(lk, out[mc] == lk[f"__k{i}"], "left").drop(f"__k{i}")
        for lv in LEVELS:
            picks[lv] += [F.col(f"__{lv}_{l}_{i}") for l in LANGS]
    tmp = [f"__{lv}_{l}_{i}" for i in range(len(match_columns)) for lv in LEVELS for l in LANGS]
    out = out.withColumns({lv: F.coalesce(*picks[lv]) for lv in LEVELS}).drop(*tmp)
    return out


# ------------------------------------------------------------------------ G2
@dataclass(frozen=True)
class RegionRule:
    """One refined rule: applies where ``nuts_2`` is still NULL and any
    condition holds.  ``nuts_3=None`` leaves ``nuts_3`` unchanged."""
    name: str
    nuts_2: str
    nuts_3: str | None
    conditions: tuple[tuple[str, str, str], ...] = field(default_factory=tuple)  # (column, 'like'|'eq', value)

    def condition(self) -> Column:
        cond = None
        for col, op, value in self.conditions:
            c = F.col(col).like(value) if op == "like" else (F.col(col) == F.lit(value))
            cond = c if cond is None else (cond | c)
        return cond


# Refined rules for Swiss regions, applied in this order.
# Equality with "%gallen%" is literal (not a pattern), as in the stored rules.
SWISS_RULES = (
    RegionRule("St. Gallen", "CH05", "CH055", (
        ("state", "like", "%gallen%"), ("inferred_state", "eq", "%gallen%"),
        ("state", "like", "% gall%"), ("state", "eq", "sg"), ("city", "eq", "buchs"),
        ("city", "eq", "wil"))),
    RegionRule("Geneva", "CH01", "CH013", (
        ("state", "like", "%geneve%"), ("inferred_state", "eq", "geneve"),
        ("state", "like", "% genf%"), ("state", "eq", "ge"))),
    RegionRule("Graubuenden", "CH05", "CH056", (("state", "eq", "gr"), ("city", "eq", "chur"))),
    RegionRule("Bern", "CH02", "CH021", (
        ("city", "eq", "biel"), ("city", "eq", "bienne"), ("city", "eq", "ittigen"))),
    RegionRule("Basel-Stadt", "CH03", "CH031", (
        ("state", "like", "%baselstadt%"), ("inferred_state", "eq", "bs"))),
    RegionRule("Basel-Landschaft", "CH03", "CH032", (
        ("state", "like", "%basellandschaft%"), ("inferred_state", "eq", "bl"))),
    RegionRule("Aargau", "CH03", "CH033", (("state", "eq", "argovia"), ("inferred_state", "eq", "ag"))),
    RegionRule("Basel", "CH03", None, (("state", "like", "%basel%"), ("inferred_state", "like", "%basel%"))),
    RegionRule("Freiburg", "CH02", "CH022", (("state", "like", "%freiburg"),)),
)


def apply_region_rules(positions: DataFrame, rules=SWISS_RULES) -> DataFrame:
    """Ordered rules; the first rule matching a row whose ``nuts_2`` is
    still NULL sets ``nuts_2`` and (unless the rule has none) ``nuts_3``."""
    if not rules:
        return positions
    unset = F.col("nuts_2").isNull()
    n2 = None
    n3 = None
    for r in rules:
        cond = unset & r.condition()
        n2 = (F.when(cond, F.lit(r.nuts_2)) if n2 is None else n2.when(cond, F.lit(r.nuts_2)))
        v3 = F.lit(r.nuts_3) if r.nuts_3 is not None else F.col("nuts_3")
        n3 = (F.when(cond, v3) if n3 is None else n3.when(cond, v3))
    return positions.withColumns({"nuts_2": n2.otherwise(F.col("nuts_2")),
                                  "nuts_3": n3.otherwise(F.col("nuts_3"))})


def assign_regions(positions: DataFrame, regions: DataFrame, rules=SWISS_RULES) -> DataFrame:
    """G1 then G2."""
    return apply_region_rules(match_regions(positions, regions), rules)


# ------------------------------------------------------------------------ G3
def coverage_summary(positions: DataFrame) -> DataFrame:
    """Postings with both codes, all postings, share."""
    both = F.col("nuts_2").isNotNull() & F.col("nuts_3").isNotNull()
    return positions.agg(F.count(F.when(both, 1)).alias("n_matched"),
                         F.count(F.lit(1)).alias("n_total")).withColumn(
        "share", F.col("n_matched") / F.col("n_total"))


# ------------------------------------------------------------------------ G4
def update_lookup(regions: DataFrame) -> DataFrame:
    """Name -> (nuts_2, nuts_3) for ingest.  NUTS rows of level 2/3, plus
    OECD rows (level 2/3, no NUTS codes) with the OECD codes as codes.  A name
    occurring more than once keeps only its fully non-NULL rows."""
    nuts = (regions.filter(F.col("nuts_level").isin(2, 3))
            .select(F.col("name_en").alias("inferred_state"), "nuts_2", "nuts_3"))
    oecd = (regions.filter(F.col("nuts_2").isNull() & F.col("nuts_3").isNull()
                           & F.col("oecd_level").isin(2, 3))
            .select(F.col("name_en").alias("inferred_state"),
                    F.col("oecd_tl2").alias("nuts_2"), F.col("oecd_tl3").alias("nuts_3")))
    both = nuts.unionByName(oecd)
    n = F.count(F.lit(1)).over(Window.partitionBy("inferred_state"))
    complete = (F.col("inferred_state").isNotNull() & F.col("nuts_2").isNotNull()
                & F.col("nuts_3").isNotNull())
    return both.withColumn("__n", n).filter((F.col("__n") == 1) | complete).drop("__n")


# ------------------------------------------------------------------------ G5
def attach_region_codes(positions: DataFrame, regions: DataFrame) -> DataFrame:
    """Left-join the G4 lookup on ``inferred_state`` (a name with several
    complete rows fans out, as a left merge does)."""
    lookup = broadcast_if_small(update_lookup(regions))
    base = positions.drop(*[c for c in LEVELS if c in positions.columns])
    return base.join(lookup, "inferred_state", "left")


# ------------------------------------------------------------------------ G6-G8
def region_names(regions: DataFrame) -> DataFrame:
    """OECD level-2 names: (region, region_code)."""
    return (regions.filter(F.col("oecd_level") == 2)
            .select(F.col("name_en").alias("region"), F.col("oecd_tl2").alias("region_code")))


def region_column(regional_level: int = 2) -> str:
    """The positions column that holds codes of a territorial level."""
    levels = {2: "nuts_2", 3: "nuts_3"}
    if regional_level not in levels:
        raise ValueError(f"no region codes of level {regional_level}; levels: {sorted(levels)}")
    return levels[regional_level]


def add_region_names(df: DataFrame, regions: DataFrame, sort_by: str | None = None) -> DataFrame:
    """Attach region names by ``region_code`` (NULL matches NULL) and sort
    by ``sort_by`` descending (ties by code for determinism)."""
    names = broadcast_if_small(region_names(regions))
    out = null_safe_join(df, names, ["region_code"], "left")
    if sort_by:
        out = out.orderBy(F.col(sort_by).desc(), F.col("region_code").asc_nulls_first())
    return out
