"""Scalar text helpers (F1-F11) kept as JVM-side Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes Unicode whitespace; Spark's trim() only spaces.
_EDGE_WHITESPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(col: Column) -> Column:
    """strip leading/trailing whitespace (Unicode aware)."""
    return F.regexp_replace(col, _EDGE_WHITESPACE, "")


def normalise(col: Column) -> Column:
    """Cast to string -> strip -> lower; NULL stays NULL."""
    return F.lower(strip(col.cast("string")))


def group_key(cols: Sequence[Column]) -> Column:
    """Collision-safe, NULL-aware binary key for grouping by long texts.

    Each part is encoded as ``'-'`` (NULL) or ``length:value`` so the
    concatenation is unambiguous, then hashed with SHA-256 to 32 bytes.  The
    shuffle then carries 32 bytes instead of whole job descriptions, and a
    NULL value forms its own group, exactly like SQL ``PARTITION BY``.
    """
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))
             for c in cols]
    return F.unhex(F.sha2(F.concat_ws("|", *parts), 256))


def month_label(col: Column) -> Column:
    """'YYYY-MM' of an ISO timestamp string."""
    return F.substring(col, 1, 7)


def truncate_prefixed(col: Column, prefix: str, length: int) -> Column:
    """Codes starting with ``prefix`` are cut to ``length`` characters."""
    return F.when(col.startswith(prefix), F.substring(col, 1, length)).otherwise(col)
