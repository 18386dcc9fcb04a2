"""The test database derived from the generated tables.

``fixture_views`` builds the FIXTURES.md views from the Parquet tables of one
scale-factor directory; ``fixture_db`` turns them into the six stored tables
by running this library's own operators (duplicate flags, regional
assignment, keyword tags), exactly as a batch update would.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, keywords, regions
from ..operators.regions import RegionRule
from ..plans import fixture_sql
from .catalog import path_exists


@dataclass
class JobTables:
    """The stored database as DataFrames (lazy)."""
    postings: DataFrame
    positions: DataFrame
    employers: DataFrame
    regions: DataFrame
    ai_tags: DataFrame
    tech_tags: DataFrame
    tech_dict: DataFrame | None = None
    ai_dict: DataFrame | None = None
    external_shares: DataFrame | None = None

    def register(self, prefix: str = "") -> None:
        """Expose the tables as temp views for ad-hoc SQL."""
        for name in ("postings", "positions", "employers", "regions", "ai_tags", "tech_tags"):
            getattr(self, name).createOrReplaceTempView(prefix + name)


# Refined rules re-parametrised on the generated nation names; same shapes as
# the Swiss rules: LIKE on state, literal equality with a pattern, city
# equality, and one rule that sets only nuts_2.
FIXTURE_RULES = (
    RegionRule("R3", "X03", "X031", (("state", "like", "%nation_3"),
                                     ("inferred_state", "eq", "%nation_13%"), ("city", "eq", "city7"))),
    RegionRule("R4", "X04", "X041", (("state", "like", "%nation_4%"), ("inferred_state", "eq", "nation_8"))),
    RegionRule("R9", "X09", None, (("state", "like", "fr_%"), ("inferred_state", "like", "%nation_1%"))),
    RegionRule("R19", "X19", "X191", (("city", "eq", "city9"), ("state", "eq", "nation_19"))),
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def fixture_views(spark: SparkSession, sf_dir: str, views: dict[str, str] = fixture_sql.SPARK_VIEWS) -> dict[str, DataFrame]:
    def ref(t: str) -> str:
        return "parquet.`" + table_path(sf_dir, t) + "`"
    return {name: spark.sql(fixture_sql.view_sql(name, ref, views)) for name in views}


def fixture_db(spark: SparkSession, sf_dir: str, flags: bool = True, geo: bool = True,
               tags: bool = True, views: dict[str, str] = fixture_sql.SPARK_VIEWS) -> JobTables:
    """Stored tables derived from ``sf_dir``: flags for every batch (each batch
    on its own), region codes by name match plus the fixture rules, AI and
    technology tags over all batches."""
    v = fixture_views(spark, sf_dir, views)
    postings = dedup.with_default_flags(v["v_postings"])
    positions = v["v_positions"].withColumns({"nuts_2": F.lit(None).cast("string"),
                                              "nuts_3": F.lit(None).cast("string")})
    if geo:
        positions = regions.assign_regions(positions, v["v_regions"], FIXTURE_RULES)
    if flags:
        postings = dedup.clean_duplicates(postings, positions, data_batch="all")
    ai_tags = keywords.tag_ai(postings, v["v_ai_dict"], data_batch="all") if tags else None
    tech_tags = keywords.tag_tech(postings, v["v_tech_dict"], data_batch="all") if tags else None
    return JobTables(postings=postings, positions=positions, employers=v["v_employers"],
                     regions=v["v_regions"], ai_tags=ai_tags, tech_tags=tech_tags,
                     tech_dict=v["v_tech_dict"], ai_dict=v["v_ai_dict"],
                     external_shares=v["v_external_shares"])


def build_database(spark: SparkSession, sf_dir: str, root: str, timer=None) -> JobTables:
    """Materialise the test database in job order, each step reading
    the table the previous step wrote (as the batch jobs do): dimensions,
    positions with region codes, postings with duplicate flags, then tags.
    ``timer(name, fn)`` may wrap each step (for the benchmark)."""
    run = timer or (lambda name, fn: fn())
    v = fixture_views(spark, sf_dir)
    path = lambda n: os.path.join(root, n)

    def dims():
        for n, df in (("employers", v["v_employers"]), ("regions", v["v_regions"]),
                      ("tech_dict", v["v_tech_dict"]), ("ai_dict", v["v_ai_dict"]),
                      ("external_shares", v["v_external_shares"])):
            df.write.mode("overwrite").parquet(path(n))
    run("s5_dimensions", dims)
    regions_s = spark.read.parquet(path("regions"))
    positions = v["v_positions"].withColumns({"nuts_2": F.lit(None).cast("string"),
                                              "nuts_3": F.lit(None).cast("string")})
    run("g1_g2_assign_regions", lambda: regions.assign_regions(positions, regions_s, FIXTURE_RULES)
        .write.mode("overwrite").parquet(path("positions")))
    positions_s = spark.read.parquet(path("positions"))
    run("d1_d2_duplicate_flags", lambda: dedup.clean_duplicates(
        dedup.with_default_flags(v["v_postings"]), positions_s, data_batch="all")
        .write.mode("overwrite").partitionBy("data_batch").parquet(path("postings")))
    postings_s = spark.read.parquet(path("postings"))
    run("k5_ai_tagging", lambda: keywords.tag_ai(postings_s, spark.read.parquet(path("ai_dict")), "all")
        .write.mode("overwrite").parquet(path("ai_tags")))
    run("k6_tech_tagging", lambda: keywords.tag_tech(postings_s, spark.read.parquet(path("tech_dict")), "all")
        .write.mode("overwrite").parquet(path("tech_tags")))
    return stored_db(spark, root)


def stored_db(spark: SparkSession, root: str) -> JobTables:
    """Open a database written by ``write_db`` (Parquet per table)."""
    r = lambda n: spark.read.parquet(os.path.join(root, n))
    extra = {}
    for n in ("tech_dict", "ai_dict", "external_shares"):
        if path_exists(spark, f"{root}/{n}"):
            extra[n] = r(n)
    return JobTables(postings=r("postings"), positions=r("positions"), employers=r("employers"),
                     regions=r("regions"), ai_tags=r("ai_tags"), tech_tags=r("tech_tags"), **extra)


def write_db(db: JobTables, root: str, mode: str = "overwrite") -> None:
    """Persist the tables: postings partitioned by batch; dimensions as is."""
    db.postings.write.mode(mode).partitionBy("data_batch").parquet(os.path.join(root, "postings"))
    for n in ("positions", "employers", "regions", "ai_tags", "tech_tags",
              "tech_dict", "ai_dict", "external_shares"):
        df = getattr(db, n)
        if df is not None:
            df.write.mode(mode).parquet(os.path.join(root, n))
