"""The views over suppliers join them by key, whatever a query filters on."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from vacancylab.plans import fixture_sql
from vacancylab.sources.fixtures import fixture_views


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("supplier_join"))
    documents = [(i, None if i % 13 == 0 else f"text {i}", "en", f"src{i % 3}", 7 * i % 90) for i in range(120)] + [
        (8, "twice", "de", "src0", 8), (9, "no length", "de", None, None), (None, "no id", "fr", "src1", 5)]
    rows = {
        "documents": (documents, "doc_id long, text string, lang string, source string, n_chars long"),
        "orders": ([(i, "1996-01-02") for i in range(130)], "o_orderkey long, o_orderdate string"),
        # a key that comes twice, and suppliers without name, nation or key
        "supplier": ([(i, f"Supplier#{i:09d}", i % 4, 1.0 * i) for i in range(20)] + [
            (3, "Supplier#other", 1, 0.5), (20, None, 2, 1.5), (21, "Supplier#nowhere", None, 2.5), (None, "none", 1, 1.0)],
            "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "nation": ([(i, f"NATION_{i}", i % 2) for i in range(4)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string"),
        "customer": ([(1, 1, 1.0)], "c_custkey long, c_nationkey int, c_acctbal double"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.mark.parametrize("view", ["v_positions", "v_raw"])
def test_keyed_view_has_the_rows_of_the_sql(spark, tables, view):
    plain = spark.sql(fixture_sql.view_sql(view, lambda t: f"parquet.`{tables}/{t}.parquet`"))
    keyed = fixture_views(spark, tables)[view]
    assert keyed.dtypes == plain.dtypes
    found, wanted = (sorted(map(repr, df.collect())) for df in (keyed, plain))
    assert found == wanted and found


@pytest.mark.parametrize("view", ["v_positions", "v_raw"])
def test_a_filter_on_the_name_leaves_an_equi_join(spark, tables, view):
    chosen = fixture_views(spark, tables)[view].where(F.col("company_name").ilike("%supplier#%1%"))
    plan = chosen._jdf.queryExecution().optimizedPlan().toString()
    with_names = [line for line in plan.splitlines() if "Join" in line and "s_name" in line]
    equal = re.compile(r"(supplier_key|s_suppkey)#\d+L? = (supplier_key|s_suppkey)#\d+L?")
    assert with_names and all(equal.search(line) for line in with_names)


#: Queries that filter on the employer's name or keep the named employers' rows only.
QUERIES = [
    "i8_new_employers",
    "c2_company_region_postings",
    "c3_company_region_ai_postings",
    "c6_c8_company_ai_shares",
    "c5_false_positive_review",
    "c4_matched_employer_count",
    "e2_employer_postings",
    "c9_top_companies_by_ai_share",
    "e2_employer_postings_window",
    "e3_within_employer_duplicates",
    "e3_within_employer_duplicates_min1",
    "e3_within_employer_duplicates_min7",
    "e5_token_windows",
    "e3_within_employer_duplicates_period",
    "r4_subset_employers",
    "e2_sampled_employer_postings",
    "x3_company_in_city",
    "r4_subset_tech_tags",
]


def joins_of_pairs(df):
    """Joins without equal keys of which neither side is a single row, subqueries included."""
    equal_keys = df.sparkSession._jvm.org.apache.spark.sql.catalyst.planning.ExtractEquiJoinKeys
    plan = df._jdf.queryExecution().optimizedPlan()
    many = lambda side: side.maxRows().isEmpty() or side.maxRows().get() > 1
    listed = lambda nodes: [nodes.apply(i) for i in range(nodes.size())]
    todo, found = [plan, *listed(plan.subqueriesAll())], []
    while todo:
        node = todo.pop()
        todo += listed(node.children())
        if node.nodeName() == "Join" and many(node.left()) and many(node.right()) and equal_keys.unapply(node).isEmpty():
            found.append(node.simpleString(100))
    return found


@pytest.mark.parametrize("name", QUERIES)
def test_query_compares_no_document_with_every_supplier(spark, tables, name):
    assert joins_of_pairs(entry.queries()[name](spark, tables)) == []
