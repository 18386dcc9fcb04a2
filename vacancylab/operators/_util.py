"""Small helpers shared by the operators: bounded driver reads, checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Dimension tables (region grid, dictionaries, firm patterns) are bounded by
# geography / vocabulary, not by the number of postings.  These bounds are the
# proof: beyond them the operators fall back to shuffle joins or refuse.
MAX_BROADCAST_ROWS = 2_000_000
MAX_DICTIONARY_ROWS = 50_000


def collect_bounded(df: DataFrame, max_rows: int, what: str) -> list:
    """Collect a small dimension to the driver, refusing anything over ``max_rows``."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what} has more than {max_rows} rows; refusing to collect it")
    return rows


MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_size(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan in bytes (no job runs).
    Estimates are upper-bound style: file sizes scaled by projected width."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size if isinstance(size, int) else size.toString())
    except Exception:  # noqa: BLE001 - connect / unknown plans: treat as large
        return MAX_BROADCAST_BYTES + 1


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only when the plan's size estimate is within
    ``max_bytes``; beyond it no hint is given and the planner / AQE pick a
    shuffle join (or a runtime broadcast from measured sizes)."""
    return F.broadcast(df) if estimated_size(df) <= max_bytes else df


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` with NULL = NULL matching (pandas merge / dplyr semantics).

    The result has each key once: the left one, and where a right or full join
    has no left row the right one.  Null-safe equality is an equi-join to
    Spark, so both sides are hashed on the keys, never compared pair by pair.
    """
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(renamed, cond, how)
    if how in ("right", "right_outer", "full", "outer", "full_outer"):
        out = out.withColumns({k: F.coalesce(F.col(k), F.col(f"__r_{k}")) for k in keys})
    return out.drop(*[f"__r_{k}" for k in keys])


def share(numerator: Column, denominator: Column) -> Column:
    return numerator.cast("double") / denominator.cast("double")
