"""Table schemas, keys and base-table properties.

The stored database is six tables.  Column names are the public API; the
table names are neutral (``postings`` = job postings, ``positions`` =
position characteristics, ``employers`` = institutions, ``ai_tags``,
``tech_tags``, ``regions`` = the region grid).
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
D = T.DoubleType()
I = T.IntegerType()


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


POSTINGS = _struct(
    ("uniq_id", S), ("crawl_timestamp", S), ("url", S), ("post_date", S),
    ("job_title", S), ("job_description", S), ("html_job_description", S),
    ("job_board", S), ("text_language", S), ("data_batch", S),
    ("unique_posting_text", S), ("unique_posting_textlocation", S),
)

POSITIONS = _struct(
    ("uniq_id", S), ("company_name", S), ("category", S),
    ("inferred_department_name", S), ("inferred_department_score", D),
    ("city", S), ("inferred_city", S), ("state", S), ("inferred_state", S),
    ("country", S), ("inferred_country", S), ("job_type", S),
    ("inferred_job_title", S), ("remote_position", S),
    ("nuts_2", S), ("nuts_3", S),
)

EMPLOYERS = _struct(
    ("company_name", S), ("contact_email", S), ("contact_phone_number", S),
    ("inferred_company_type", S), ("inferred_company_type_score", D),
)

AI_TAGS = _struct(("uniq_id", S))

TECH_TAGS = _struct(("uniq_id", S), ("bloom_field", S), ("bloom_code", I))

REGIONS = _struct(
    ("name_en", S), ("name_de", S), ("name_fr", S), ("regio_abbrev", S),
    ("nuts_level", I), ("oecd_level", I), ("iso_2", S), ("iso_3", S),
    ("nuts_0", S), ("nuts_1", S), ("nuts_2", S), ("nuts_3", S),
    ("oecd_tl1", S), ("oecd_tl2", S), ("oecd_tl3", S), ("self_classified", S),
)

# Raw provider file: one wide row per posting (before the renames of S3).
RAW_POSTINGS = _struct(
    ("uniq_id", S), ("crawl_timestamp", S), ("url", S), ("post_date", S),
    ("job_title", S), ("job_description", S), ("html_job_description", S),
    ("job_board", S), ("inferred_iso3_lang_code", S),
    ("company_name", S), ("category", S), ("inferred_department_name", S),
    ("inferred_department_score", D), ("city", S), ("inferred_city", S),
    ("state", S), ("inferred_state", S), ("country", S), ("inferred_country", S),
    ("job_type", S), ("inferred_job_title", S), ("is_remote", S),
    ("contact_phone_number", S), ("contact_email", S),
    ("inferred_company_type", S), ("inferred_company_type_score", D),
)

SCHEMAS = {
    "postings": POSTINGS, "positions": POSITIONS, "employers": EMPLOYERS,
    "ai_tags": AI_TAGS, "tech_tags": TECH_TAGS, "regions": REGIONS,
}

PRIMARY_KEYS = {
    "postings": ["uniq_id"], "positions": ["uniq_id"], "employers": ["company_name"],
    "ai_tags": ["uniq_id"], "tech_tags": ["uniq_id", "bloom_code"],
    "regions": ["name_en", "nuts_3"],
}

# Renames applied to a raw provider file (S3).
RAW_RENAMES = {"inferred_iso3_lang_code": "text_language", "is_remote": "remote_position"}

# Which raw columns feed which base table (fixed values of the data model).
BASE_TABLE_COLUMNS = {
    "postings": ["crawl_timestamp", "url", "post_date", "job_title", "job_description",
                 "html_job_description", "job_board", "text_language"],
    "positions": ["company_name", "category", "inferred_department_name",
                  "inferred_department_score", "city", "inferred_city", "state",
                  "inferred_state", "country", "inferred_country", "job_type",
                  "inferred_job_title", "remote_position"],
    "employers": ["contact_phone_number", "contact_email", "inferred_company_type",
                  "inferred_company_type_score"],
}
BASE_TABLE_KEYS = {"postings": "uniq_id", "positions": "uniq_id", "employers": "company_name"}

# Columns stored lower-cased and stripped (fixed values of the data model).
LOWERCASE_COLUMNS = [
    "job_title", "job_board", "company_name", "category", "inferred_department_name",
    "city", "inferred_city", "state", "inferred_state", "country", "inferred_country",
    "job_type", "inferred_job_title", "inferred_company_type",
]

# Defaults of the two duplicate flags on insert.
FLAG_COLUMNS = ("unique_posting_text", "unique_posting_textlocation")
