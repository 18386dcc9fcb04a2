"""Derived test views over the generated tables (FIXTURES.md section 2).

The same SQL text builds the Spark temp views and serves as CTE prefix of the
DuckDB oracle, so both engines start from identical rows; only the views over
suppliers name the join's key first for Spark (``SPARK_VIEWS``).  ``{documents}``
and friends are table placeholders: plain view names for DuckDB, ``parquet.`path```
for Spark.  Order matters (later views never reference earlier ones, but the
oracle prefix keeps this order).
"""

from __future__ import annotations

RAW_TABLES = ("documents", "orders", "supplier", "nation", "region", "customer")

V_POSTINGS = """
SELECT md5(cast(d.doc_id AS string)) AS uniq_id,
       substr(cast(o.o_orderdate AS string), 1, 10) AS crawl_timestamp,
       CASE WHEN d.doc_id % 97 = 0 THEN NULL ELSE d.text END AS job_description,
       d.source AS job_board, d.lang AS text_language,
       CASE WHEN d.doc_id % 3 = 0 THEN 'src_2022_01' ELSE 'src_2023_01' END AS data_batch
FROM {documents} d JOIN {orders} o ON o.o_orderkey = d.doc_id
"""

V_POSITIONS = """
SELECT md5(cast(d.doc_id AS string)) AS uniq_id,
       CASE WHEN d.doc_id % 23 = 0 THEN NULL ELSE lower(s.s_name) END AS company_name,
       CASE WHEN d.doc_id % 4 = 0 THEN NULL ELSE concat('city', cast(d.n_chars % 50 AS string)) END AS city,
       CASE WHEN d.doc_id % 4 = 0 THEN lower(n.n_name)
            WHEN d.doc_id % 4 = 1 THEN concat('de_', lower(n.n_name))
            WHEN d.doc_id % 4 = 2 THEN concat('fr_', lower(n.n_name)) END AS state,
       CASE WHEN d.doc_id % 5 = 0 THEN NULL ELSE lower(n.n_name) END AS inferred_state,
       CASE WHEN d.doc_id % 31 = 0 THEN NULL ELSE lower(r.r_name) END AS inferred_country,
       CASE WHEN d.doc_id % 7 = 0 THEN '1' ELSE '0' END AS remote_position
FROM {documents} d
CROSS JOIN (SELECT count(*) AS n_s FROM {supplier}) c
JOIN {supplier} s ON s.s_suppkey = (CASE WHEN d.doc_id % 2 = 0 THEN d.n_chars ELSE d.doc_id END) % c.n_s
JOIN {nation} n ON n.n_nationkey = s.s_nationkey
JOIN {region} r ON r.r_regionkey = n.n_regionkey
"""

V_EMPLOYERS = """
SELECT lower(s_name) AS company_name, s_acctbal AS inferred_company_type_score FROM {supplier}
"""

V_REGIONS = """
SELECT lower(n_name) AS name_en, concat('de_', lower(n_name)) AS name_de, concat('fr_', lower(n_name)) AS name_fr,
       CASE WHEN n_regionkey < 3 THEN 2 END AS nuts_level, 2 AS oecd_level,
       CASE WHEN n_regionkey < 3 THEN concat('N', lpad(cast(n_nationkey AS string), 2, '0')) END AS nuts_2,
       cast(NULL AS string) AS nuts_3,
       concat('N', lpad(cast(n_nationkey AS string), 2, '0')) AS oecd_tl2, cast(NULL AS string) AS oecd_tl3
FROM {nation}
UNION ALL
SELECT lower(n_name), concat('de_', lower(n_name)), concat('fr_', lower(n_name)), 3, 3,
       concat('N', lpad(cast(n_nationkey AS string), 2, '0')),
       concat('N', lpad(cast(n_nationkey AS string), 2, '0'), '1'),
       concat('N', lpad(cast(n_nationkey AS string), 2, '0')),
       concat('N', lpad(cast(n_nationkey AS string), 2, '0'), '1')
FROM {nation} WHERE n_nationkey % 5 = 0
"""

V_TECH_DICT = """
SELECT * FROM (VALUES ('Alpha', 1, 'licen'), ('Alpha', 1, 'Licen'), ('Beta', 2, 'UND '), ('Beta', 2, 'schen'),
                      ('Gamma', 3, 'of the'), ('Delta', 4, ' oled'), ('Epsilon', 5, 'tionha')) AS t(bloom_field, bloom_code, keyword_en)
"""

V_AI_DICT = """
SELECT * FROM (VALUES ('TionHa'), ('licen'), ('Machine Learning')) AS t(keyword_en)
"""

V_EXTERNAL_SHARES = """
SELECT concat('N', lpad(cast(n.n_nationkey AS string), 2, '0')) AS nuts_2,
       count(*) AS employed_people, sum(CASE WHEN c.c_acctbal > 5000 THEN 1.0E0 ELSE 0.0E0 END) AS vacancies
FROM {customer} c JOIN {nation} n ON n.n_nationkey = c.c_nationkey GROUP BY 1
"""

# A raw provider batch over the same documents: ids repeat inside a file
# (docs b and b+20 share a file) and across files (b+21), names are padded
# and upper-case, employers new to the store appear, and the remote flag
# comes in several spellings.
V_RAW = """
SELECT md5(cast(CASE WHEN d.doc_id % 50 = 7 THEN d.doc_id - 20
                     WHEN d.doc_id % 50 = 8 THEN d.doc_id - 21 ELSE d.doc_id END AS string)) AS uniq_id,
       d.source AS file, d.doc_id AS row_seq,
       substr(cast(o.o_orderdate AS string), 1, 10) AS crawl_timestamp,
       d.text AS job_description, upper(d.source) AS job_board, d.lang AS inferred_iso3_lang_code,
       CASE WHEN d.doc_id % 23 = 0 THEN NULL
            WHEN d.doc_id % 11 = 0 THEN concat(' New ', s.s_name)
            ELSE concat(' ', s.s_name, ' ') END AS company_name,
       CASE WHEN d.doc_id % 4 = 0 THEN NULL ELSE concat('City', cast(d.n_chars % 50 AS string), '  ') END AS city,
       n.n_name AS state, n.n_name AS inferred_state, r.r_name AS inferred_country,
       CASE d.doc_id % 5 WHEN 0 THEN 'true' WHEN 1 THEN '1' WHEN 2 THEN '1.0' WHEN 3 THEN '0' END AS is_remote,
       s.s_acctbal AS inferred_company_type_score
FROM {documents} d
JOIN {orders} o ON o.o_orderkey = d.doc_id
CROSS JOIN (SELECT count(*) AS n_s FROM {supplier}) c
JOIN {supplier} s ON s.s_suppkey = d.doc_id % c.n_s
JOIN {nation} n ON n.n_nationkey = s.s_nationkey
JOIN {region} r ON r.r_regionkey = n.n_regionkey
"""

VIEWS = {
    "v_postings": V_POSTINGS,
    "v_positions": V_POSITIONS,
    "v_employers": V_EMPLOYERS,
    "v_regions": V_REGIONS,
    "v_tech_dict": V_TECH_DICT,
    "v_ai_dict": V_AI_DICT,
    "v_external_shares": V_EXTERNAL_SHARES,
    "v_raw": V_RAW,
}


def _keyed(view: str, key: str) -> str:
    """The view with the documents' supplier key as a column of a subquery.

    The key needs the number of suppliers.  Where a query filters on the
    employer's name, a condition on documents and suppliers alone, Spark's join
    order takes these two first, and with the key still out of reach it compares
    every document with every supplier.  A key that documents bring along leaves
    an equi-join whatever is filtered behind it."""
    count = "CROSS JOIN (SELECT count(*) AS n_s FROM {supplier}) c\n"
    assert view.count(count) == 1 and view.count("FROM {documents} d\n") == 1 and view.count(key) == 1
    keyed = f"(SELECT d.*, {key} AS supplier_key FROM {{documents}} d\n{count}) d\n"
    return (view.replace(count, "").replace(key, "d.supplier_key").replace("FROM {documents} d\n", f"FROM {keyed}"))


SPARK_VIEWS = VIEWS | {
    "v_positions": _keyed(V_POSITIONS, "(CASE WHEN d.doc_id % 2 = 0 THEN d.n_chars ELSE d.doc_id END) % c.n_s"),
    "v_raw": _keyed(V_RAW, "d.doc_id % c.n_s"),
}


def _by_id(view: str) -> str:
    """The view with documents and orders joined on the posting's id, the key of every later join, so that an
    exchange by that key serves all of them and a text is in one only.  That the keys behind equal ids are equal
    is asked beside it, not as a second key of the exchange."""
    documents = "(SELECT *, md5(cast(doc_id AS string)) AS uniq_id FROM {documents}) d"
    orders = "(SELECT *, md5(cast(o_orderkey AS string)) AS uniq_id FROM {orders}) o"
    joined = f"FROM {documents} JOIN {orders}\n  ON o.uniq_id = d.uniq_id AND NOT (o.o_orderkey < d.doc_id OR o.o_orderkey > d.doc_id)"
    plain = "FROM {documents} d JOIN {orders} o ON o.o_orderkey = d.doc_id"
    assert view.count(plain) == 1 and view.count("md5(cast(d.doc_id AS string)) AS uniq_id") == 1
    return view.replace("md5(cast(d.doc_id AS string)) AS uniq_id", "d.uniq_id").replace(plain, joined)


#: For queries that carry whole texts through several joins.
TEXT_VIEWS = SPARK_VIEWS | {"v_postings": _by_id(V_POSTINGS)}


def view_sql(name: str, table_ref, views: dict[str, str] = VIEWS) -> str:
    """SQL of one view with table placeholders resolved by ``table_ref(name)``."""
    return views[name].format(**{t: table_ref(t) for t in RAW_TABLES})


def duckdb_prefix() -> list[tuple[str, str]]:
    """(name, sql) pairs of the views for a DuckDB ``WITH`` clause."""
    return [(n, view_sql(n, lambda t: t).strip()) for n in VIEWS]


# Batch of the fixture database that plays the "current" provider batch.
CURRENT_BATCH = "src_2023_01"
ALL_BATCHES = ("src_2022_01", "src_2023_01")
