"""Row predicates as Spark Columns.

Every builder returns a ``Column`` so Catalyst can push it into the Parquet
scan (batch, flag and month predicates become ``PushedFilters`` /
partition filters when the table is partitioned by ``data_batch``).
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def _as_list(value) -> list:
    if isinstance(value, str):
        return [value]
    return list(value)


def batch_condition(data_batch="all", column: str = "data_batch") -> Column | None:
    """``"all"`` -> no filter; a string -> equality; a list -> IN (``[]`` = no filter)."""
    if data_batch is None or (isinstance(data_batch, str) and data_batch == "all"):
        return None
    batches = _as_list(data_batch)
    if not batches:
        return None
    if len(batches) == 1:
        return F.col(column) == F.lit(batches[0])
    return F.col(column).isin(batches)


FLAG_BY_LEVEL = {"overall": "unique_posting_text", "location": "unique_posting_textlocation"}


def unique_condition(unique_postings_only: bool = True, level: str = "overall") -> Column | None:
    """Keep postings flagged unique at ``level`` ('overall' or 'location').

    'location' uses the (city, text) flag, which is what the level name means.
    """
    if level not in FLAG_BY_LEVEL:
        raise ValueError("level must be either 'overall' or 'location'")
    if not unique_postings_only:
        return None
    return F.col(FLAG_BY_LEVEL[level]) == F.lit("yes")


def country_condition(countries="all", column: str = "inferred_country") -> Column | None:
    """Condition on ``positions.inferred_country`` (apply it to positions)."""
    if countries is None or (isinstance(countries, str) and countries == "all"):
        return None
    values = _as_list(countries)
    if not values:
        return None
    return F.col(column).isin(values)


def combine_conditions(conditions: Iterable[Column | None]) -> Column | None:
    """AND of the non-empty conditions (``None`` when there are none)."""
    conds = [c for c in conditions if c is not None]
    if not conds:
        return None
    return functools.reduce(operator.and_, conds)


def apply_condition(df: DataFrame, condition: Column | None) -> DataFrame:
    return df if condition is None else df.filter(condition)


def month_of(column: str = "crawl_timestamp") -> Column:
    """Month label 'YYYY-MM' = first seven characters of the timestamp string."""
    return F.substring(F.col(column), 1, 7)


def month_condition(months="full_sample", column: str = "crawl_timestamp") -> Column | None:
    """P5: ``"full_sample"`` -> no filter; one month string or a list of months."""
    if isinstance(months, str):
        if months == "full_sample":
            return None
        months = [months]
    if not isinstance(months, (list, tuple)):
        raise TypeError("months must be 'full_sample', a month string or a list of strings")
    if len(months) == 1:
        return month_of(column) == F.lit(months[0])
    return month_of(column).isin(list(months))


def geo_scope_condition(column: str, restrict_to: Sequence[str] | None = None,
                        exclude: Sequence[str] | None = None) -> Column | None:
    """IN / NOT IN on a geo column; NULL values are outside both scopes."""
    if restrict_to and exclude:
        raise ValueError("a scope either names units or leaves some out, not both")
    if restrict_to:
        return F.col(column).isin(list(restrict_to))
    if exclude:
        return ~F.col(column).isin(list(exclude)) & F.col(column).isNotNull()
    return None


def keyword_condition(text: Column, keywords: Sequence[str], boundary: str = "space",
                      engine: str = "jvm") -> Column:
    """OR over keywords of ``lower(text)`` containing ``' ' + lower(keyword)``
    (LIKE folds case, so a capital in a keyword is no condition).

    ``boundary='space'`` is the stored semantics (a keyword needs a leading
    space; the suffix is open so stems match).  ``boundary='word'`` also
    accepts text start and any non-word character before the keyword.
    Keywords are matched literally (no LIKE wildcards).  ``engine``:
    'jvm' (one ``contains`` per keyword, inside generated code: for lists of tens) or
    'automaton' (one Aho-Corasick pass in Python workers: for hundreds).
    """
    if not keywords:
        return F.lit(False)
    lowered = F.lower(text)
    keywords = sorted({k.lower() for k in keywords})
    if boundary == "space":
        from .matching import any_contains
        return any_contains(lowered, [" " + k for k in keywords], engine)
    if boundary == "word":
        import re
        pattern = "(^|\\W)(" + "|".join(re.escape(k) for k in keywords) + ")"
        return lowered.rlike(pattern)
    raise ValueError("boundary must be 'space' or 'word'")


def name_pattern_condition(column: str, include: Sequence[str],
                           exclude: Sequence[str] = ()) -> Column:
    """Name contains any include pattern and none of the exclusions.

    Plain substring semantics of ``LIKE '%p%'`` (patterns hold no wildcards),
    without regard to case; a NULL name fails both parts.
    """
    col = F.lower(F.col(column))
    inc = functools.reduce(operator.or_, [col.contains(F.lit(p.lower())) for p in include])
    if exclude:
        exc = functools.reduce(operator.and_, [~col.contains(F.lit(p.lower())) for p in exclude])
        return inc & exc
    return inc


def name_exclusion_condition(column: str, exclude: Sequence[str]) -> Column:
    """P8's second part alone: the name holds none of the words, in any case."""
    name = F.lower(F.col(column))
    return functools.reduce(operator.and_, [~name.contains(F.lit(w.lower())) for w in exclude], name.isNotNull())


def remote_condition(column: str = "remote_position") -> Column:
    """Remote postings (column normalised to '1' at ingest)."""
    return F.col(column) == F.lit("1")


def ilike_condition(column: str, pattern: str) -> Column:
    """P10: case-insensitive LIKE (``city LIKE 'basel'``)."""
    return F.col(column).ilike(pattern)


def is_not_null_safe(column: str, value: str) -> Column:
    """``column IS NOT 'value'`` - NULL rows stay."""
    return ~F.col(column).eqNullSafe(F.lit(value))
