"""SQL twins of the stored test database, for the DuckDB correctness oracle.

``prefix()`` returns a ``WITH`` clause that rebuilds, in plain SQL, what
``sources.fixtures.fixture_db`` builds with the library's DataFrame
operators: duplicate flags with ``row_number``, region codes with
``coalesce`` of per-language lookups and a ``CASE`` chain, tags with
``LIKE`` joins over the dictionaries.  A query twin is ``sql(body, ctes)``.
"""

from __future__ import annotations

from ..operators.regions import RegionRule
from ..sources.fixtures import FIXTURE_RULES
from . import fixture_sql


def _q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def rule_condition_sql(rule: RegionRule) -> str:
    parts = []
    for col, op, value in rule.conditions:
        parts.append(f"{col} LIKE {_q(value)}" if op == "like" else f"{col} = {_q(value)}")
    return "(" + " OR ".join(parts) + ")"


def _rules_sql(rules) -> tuple[str, str]:
    n2 = ["CASE"]
    n3 = ["CASE"]
    for r in rules:
        c = f"nuts_2 IS NULL AND {rule_condition_sql(r)}"
        n2.append(f" WHEN {c} THEN {_q(r.nuts_2)}")
        n3.append(f" WHEN {c} THEN {_q(r.nuts_3) if r.nuts_3 is not None else 'nuts_3'}")
    n2.append(" ELSE nuts_2 END")
    n3.append(" ELSE nuts_3 END")
    return "".join(n2), "".join(n3)


def _lookup_sql() -> str:
    cols = ", ".join(f"max(CASE WHEN lang = '{l}' THEN {lv} END) AS {lv}_{l}"
                     for lv in ("nuts_2", "nuts_3") for l in ("en", "de", "fr"))
    stacked = " UNION ALL ".join(
        f"SELECT name_{l} AS name, '{l}' AS lang, nuts_2, nuts_3 FROM v_regions" for l in ("en", "de", "fr"))
    return f"SELECT name, {cols} FROM ({stacked}) s WHERE name IS NOT NULL GROUP BY name"


def stored_ctes(rules=FIXTURE_RULES) -> list[tuple[str, str]]:
    n2_case, n3_case = _rules_sql(rules)
    co = lambda lv: ", ".join([f"s.{lv}_{l}" for l in ("en", "de", "fr")]
                              + [f"i.{lv}_{l}" for l in ("en", "de", "fr")])
    like = "lower(p.job_description) LIKE ('% ' || lower(d.keyword_en) || '%')"
    return [
        ("region_lookup", _lookup_sql()),
        ("positions_g1", f"""SELECT p.*, coalesce({co('nuts_2')}) AS nuts_2, coalesce({co('nuts_3')}) AS nuts_3
            FROM v_positions p LEFT JOIN region_lookup s ON p.state = s.name
            LEFT JOIN region_lookup i ON p.inferred_state = i.name"""),
        ("positions", f"""SELECT uniq_id, company_name, city, state, inferred_state, inferred_country,
            remote_position, {n2_case} AS nuts_2, {n3_case} AS nuts_3 FROM positions_g1"""),
        ("dup_base", """SELECT p.uniq_id, p.data_batch, p.job_description, c.city
            FROM v_postings p JOIN positions c ON c.uniq_id = p.uniq_id"""),
        ("dup_text", """SELECT uniq_id FROM (SELECT uniq_id, row_number() OVER (
            PARTITION BY data_batch, job_description ORDER BY uniq_id) AS rn FROM dup_base) t WHERE rn > 1"""),
        ("dup_loc", """SELECT uniq_id FROM (SELECT uniq_id, row_number() OVER (
            PARTITION BY data_batch, city, job_description ORDER BY uniq_id) AS rn FROM dup_base) t WHERE rn > 1"""),
        ("postings", """SELECT p.uniq_id, p.crawl_timestamp, p.job_description, p.job_board, p.text_language,
            p.data_batch,
            CASE WHEN p.uniq_id IN (SELECT uniq_id FROM dup_text) THEN 'no' ELSE 'yes' END AS unique_posting_text,
            CASE WHEN p.uniq_id IN (SELECT uniq_id FROM dup_loc) THEN 'no' ELSE 'yes' END
              AS unique_posting_textlocation
            FROM v_postings p"""),
        ("employers", "SELECT * FROM v_employers"),
        ("regions", "SELECT * FROM v_regions"),
        ("ai_tags", f"""SELECT p.uniq_id FROM postings p
            WHERE EXISTS (SELECT 1 FROM v_ai_dict d WHERE {like})"""),
        ("tech_tags", f"""SELECT DISTINCT p.uniq_id, d.bloom_field, d.bloom_code
            FROM postings p JOIN v_tech_dict d ON {like}"""),
    ]


def sql(body: str, ctes: list[tuple[str, str]] | None = None, computed_once: tuple[str, ...] = ()) -> str:
    """Full DuckDB statement: fixture views + stored tables + extra CTEs + body.
    CTEs ``computed_once`` are materialised; naming some allows recursive ones."""
    all_ctes = fixture_sql.duckdb_prefix() + stored_ctes() + list(ctes or [])
    head = ",\n".join(f"{name} AS {'MATERIALIZED ' * (name in computed_once)}(\n{text}\n)" for name, text in all_ctes)
    return f"WITH {'RECURSIVE ' * bool(computed_once)}{head}\n{body}"


# Region-name twin of G6/G8 (NULL = NULL match).
REGION_NAMES = ("region_names", "SELECT name_en AS region, oecd_tl2 AS region_code FROM regions WHERE oecd_level = 2")


def with_names(inner_cte: str) -> str:
    """Body that adds region names to CTE ``inner_cte`` (has ``region_code``)."""
    return (f"SELECT a.*, n.region FROM {inner_cte} a LEFT JOIN region_names n "
            f"ON a.region_code IS NOT DISTINCT FROM n.region_code")
