"""Queries of the subpackage: each operator over its whole table, with its SQL twin where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (crf_langid, divergence_rules, html_region, lanczos_whitening, license_index, merkle_manifest,
               pattern_packing, pivot_index, secrets_battery, signature_join, suffix_dedup, systematic_mix, token_attribution)
from ._tables import materialize, read_table


def op1_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_battery.secret_spans(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


def op2_suffix_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op3_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op4_best_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_region.extract_pages(read_table(spark, sf_dir, "pages"))


def op5_offset_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_attribution.section_tokens(read_table(spark, sf_dir, "documents"))


def op6_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    distances = [F.round(c, 6).alias(c) for c in ("char_distance", "word_distance")]
    verdicts = divergence_rules.quality_verdicts(read_table(spark, sf_dir, "documents"))
    return verdicts.select(*verdicts.columns[:-2], *distances)


def op7_pivot_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op8_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_join.near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    sizes = materialize(documents.select(
        "doc_id", "source", systematic_mix.word_count(F.col("text")).alias("size")), "sizes")
    return systematic_mix.systematic_copies(sizes).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op10_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf_langid.predict_languages(read_table(spark, sf_dir, "documents"))


def op11_rare_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_index.scan_licences(read_table(spark, sf_dir, "documents")).drop("matches")


def op12_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lanczos_whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op13_recursive_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.prove(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_randomness_battery, op2_suffix_sort_dedup, op3_pattern_packing, op4_best_region, op5_offset_attribution,
    op6_distribution_divergence, op7_pivot_permutation, op8_signature_join, op9_systematic_mix, op10_crf_language,
    op11_rare_token_index, op12_lanczos_whitening, op13_recursive_climb)}


def _op6_sql() -> str:
    words = ", ".join(f"({i}, '{w}')" for i, w in enumerate(divergence_rules.COMMON_WORDS))
    classes = ", ".join(f"({i}, '{p}')" for i, (_, p) in enumerate(divergence_rules.CHAR_CLASSES))
    n_classes, n_words = len(divergence_rules.CHAR_CLASSES), len(divergence_rules.COMMON_WORDS)
    m = divergence_rules
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
    w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
    grams AS (SELECT r, i, array_to_string(ws[i : i + 4], ' ') AS gram
              FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
    twice AS (SELECT g.r, g.i FROM grams g SEMI JOIN
              (SELECT r, gram FROM grams GROUP BY ALL HAVING count(*) > 1) x ON g.r = x.r AND g.gram = x.gram),
    covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(5) AS o(k) GROUP BY r),
    lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
    dup_lines AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines
                  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
    base AS (SELECT d.r, doc_id, lang, len(ws) AS n_words, length(t) AS n_chars,
               length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
               length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
               coalesce(l.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
             FROM d JOIN w USING (r) LEFT JOIN dup_lines l USING (r) LEFT JOIN covered c USING (r)),
    classes(bin, pattern) AS (VALUES {classes}),
    char_bins AS (SELECT r, bin, length(regexp_replace(t, pattern, '', 'g')) AS n FROM d, classes),
    commons(bin, word) AS (VALUES {words}),
    found AS (SELECT r, bin, count(*) AS n FROM (SELECT r, unnest(ws) AS word FROM w) JOIN commons USING (word)
              GROUP BY ALL),
    bins AS (SELECT 'c' AS kind, r, bin, n FROM char_bins
             UNION ALL SELECT 'c', r, {n_classes}, greatest(n_chars - s, 0)
               FROM base JOIN (SELECT r, sum(n) AS s FROM char_bins GROUP BY r) USING (r)
             UNION ALL SELECT 'w', r, bin, n FROM found
             UNION ALL SELECT 'w', r, {n_words}, n_words - coalesce(s, 0)
               FROM base LEFT JOIN (SELECT r, sum(n) AS s FROM found GROUP BY r) USING (r)),
    sums AS (SELECT lang, kind, bin, sum(n) AS n FROM bins JOIN d USING (r) GROUP BY ALL),
    refs AS (SELECT lang AS ref, kind, bin, n FROM sums WHERE lang IN
               (SELECT lang FROM sums WHERE kind = 'w' GROUP BY lang HAVING sum(n) >= {m.MIN_REFERENCE_WORDS})
             UNION ALL SELECT NULL, kind, bin, sum(n) FROM sums GROUP BY kind, bin),
    named AS (SELECT r, CASE WHEN lang IN (SELECT ref FROM refs WHERE ref IS NOT NULL) THEN lang END AS ref FROM d),
    q AS (SELECT ref, kind, bin, n / sum(n) OVER (PARTITION BY ref, kind) AS q FROM refs),
    total AS (SELECT r, kind, sum(n) AS n FROM bins GROUP BY r, kind HAVING sum(n) > 0),
    pq AS (SELECT named.r, q.kind, coalesce(bins.n, 0) / total.n AS p, q.q
           FROM named JOIN q ON named.ref IS NOT DISTINCT FROM q.ref
           JOIN total ON total.r = named.r AND total.kind = q.kind
           LEFT JOIN bins ON bins.r = named.r AND bins.kind = q.kind AND bins.bin = q.bin),
    js AS (SELECT r, kind, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
                  + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS js FROM pq GROUP BY r, kind),
    both_ AS (SELECT base.*, c.js AS cd, x.js AS wd,
                n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
              FROM base LEFT JOIN js c ON c.r = base.r AND c.kind = 'c' LEFT JOIN js x ON x.r = base.r AND x.kind = 'w')
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND NOT (n_chars >= {m.MIN_CHARS} AND coalesce(cd, 0) > {m.MAX_CHAR_DISTANCE})
        AND NOT (n_words >= {m.MIN_WORDS} AND coalesce(wd, 0) > {m.MAX_WORD_DISTANCE} + {m.WORD_NOISE} / sqrt(n_words)) AS kept,
      round(cd, 6) AS char_distance, round(wd, 6) AS word_distance
    FROM both_"""


OP9_SQL = r"""
    WITH s AS (SELECT doc_id, source,
                 CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size
               FROM documents),
    per AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
    ranked AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w,
                 row_number() OVER (ORDER BY source NULLS LAST) AS rn FROM per),
    levels AS (SELECT *, 2.0::DOUBLE * source_size AS most, (2.0::DOUBLE * source_size) / w AS ratio FROM ranked),
    leveled AS (SELECT *, row_number() OVER o AS pos,
                  (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER
                     (ORDER BY ratio, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(w) OVER (ORDER BY ratio, rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
                FROM levels WINDOW o AS (ORDER BY ratio, rn)),
    targets AS (SELECT source, source_size, least(most, w * (SELECT arg_min(level, pos) FROM leveled
                  WHERE level <= ratio)) AS target FROM leveled),
    keyed AS (SELECT *, CASE WHEN source IS NULL THEN 'null' ELSE '=' || source END AS sk,
                CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS each_ FROM targets),
    started AS (SELECT *, (('0x' || substr(md5(sk || '|mix-1'), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS u
                FROM keyed),
    places AS (SELECT s.doc_id, s.size, s.source, t.source_size, t.target, t.each_, t.u, row_number() OVER (
                 PARTITION BY t.sk ORDER BY s.size,
                 ('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, '')), 1, 8))::BIGINT, s.doc_id NULLS FIRST) AS rank
               FROM s JOIN started t ON s.source IS NOT DISTINCT FROM t.source),
    dealt AS (SELECT *, (floor(rank::DOUBLE * each_::DOUBLE + u) - floor((rank - 1)::DOUBLE * each_::DOUBLE + u))::BIGINT
                AS copies FROM places)
    SELECT doc_id, size::BIGINT AS size, source_size, target, copies * size::BIGINT AS taken, source, copies FROM dealt"""

#: Trees are keyed by source ('s' || source, 'n' for null); the subroots form the tree 'top'.
OP13_SQL = r"""
    WITH RECURSIVE bytes AS (
      SELECT row_number() OVER () AS r, * FROM documents),
    crc AS (
      SELECT r, doc_id, 0 AS i, 4294967295::BIGINT AS c FROM bytes WHERE doc_id IS NOT NULL
      UNION ALL
      SELECT r, doc_id, i + 1, list_reduce([xor(c, ascii(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
               lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)
      FROM crc WHERE i < length(doc_id::VARCHAR)),
    chosen AS (SELECT r FROM crc WHERE i = length(doc_id::VARCHAR) AND xor(c, 4294967295::BIGINT) % 5 = 0),
    fields AS (
      SELECT b.r, doc_id, source, text, CASE WHEN c.r IS NULL THEN text
               ELSE translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS other,
             coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
               || coalesce(strlen(lang) || ':' || lang, '-')
               || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
      FROM bytes b LEFT JOIN chosen c ON c.r = b.r),
    leaves AS (
      SELECT r, doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS tree,
             sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
             sha256(head || coalesce(strlen(other) || ':' || other, '-')) AS tampered FROM fields),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
             count(*) OVER (PARTITION BY tree) AS n FROM leaves),
    nodes AS (
      SELECT tree, 0 AS level, place, leaf AS digest, n FROM placed
      UNION ALL
      SELECT tree, level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 15) // 16
      FROM nodes WHERE n > 1 GROUP BY tree, level, place // 16),
    subroots AS (SELECT tree, digest, level, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n
                 FROM nodes WHERE n = 1),
    tops AS (
      SELECT 0 AS level, place, digest, n FROM subroots
      UNION ALL
      SELECT level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 15) // 16
      FROM tops WHERE n > 1 GROUP BY level, place // 16),
    joined AS (
      SELECT tree, level, place, digest, n FROM nodes UNION ALL SELECT 'top', level, place, digest, n FROM tops),
    siblings AS (
      SELECT a.tree, a.level, a.place, coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS lefts,
             coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS rights
      FROM joined a JOIN joined b ON a.tree = b.tree AND a.level = b.level AND a.place // 16 = b.place // 16
      WHERE a.n > 1 GROUP BY ALL),
    climb AS (
      SELECT p.r, p.tree, 0 AS level, p.place, p.tampered AS folded, '' AS proof, s.place AS top_place
      FROM placed p JOIN subroots s USING (tree)
      UNION ALL
      SELECT c.r, CASE WHEN s.tree IS NULL THEN 'top' ELSE c.tree END, CASE WHEN s.tree IS NULL THEN 0 ELSE c.level + 1 END,
             CASE WHEN s.tree IS NULL THEN c.top_place ELSE c.place // 16 END,
             CASE WHEN s.tree IS NULL THEN c.folded ELSE sha256(s.lefts || c.folded || s.rights) END,
             c.proof || coalesce(s.lefts || s.rights, ''), c.top_place
      FROM climb c LEFT JOIN siblings s USING (tree, level, place)
      WHERE c.tree <> 'top' OR s.tree IS NOT NULL),
    ends AS (SELECT r, arg_max(folded, level) AS folded, arg_max(proof, level) AS proof FROM climb WHERE tree = 'top' GROUP BY r)
    SELECT placed.doc_id, placed.leaf, s.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
           folded = t.digest AS verified
    FROM placed JOIN ends USING (r) JOIN subroots s USING (tree) JOIN tops t ON t.n = 1"""

ORACLES: dict[str, str] = {"op6_distribution_divergence": _op6_sql(), "op9_systematic_mix": OP9_SQL,
                           "op13_recursive_climb": OP13_SQL}
