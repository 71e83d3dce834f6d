"""The changelog contract (S3).

A changelog is a DataFrame with ``_key``, ``op``, ``seq`` and a ``doc`` struct.
``seq`` is the arrival order: an integer that is unique per key. Every change has
arrived somewhere, so a missing number is an error, as a missing key is: a change
without a place in the order would be lost or would undo a later one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsink.functions.names import quote

# The four row kinds.
INSERT = "+I"
UPDATE_BEFORE = "-U"
UPDATE_AFTER = "+U"
DELETE = "-D"
ACCEPTED = (INSERT, UPDATE_AFTER, DELETE)


INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def require(changes: DataFrame, *columns: str) -> DataFrame:
    """Fail on rows that lack one of ``columns``; a projection, no pass of its own."""
    checked = {
        c: F.coalesce(F.col(quote(c)), F.raise_error(F.lit(f"null in column {c} of a change"))) for c in columns
    }
    return changes.withColumns(checked) if checked else changes


def require_order(changes: DataFrame, *columns: str) -> DataFrame:
    """Like ``require``, for numbers that order changes."""
    for c in columns:
        if not isinstance(changes.schema[c].dataType, INTEGRAL):
            raise TypeError(f"column {c!r} must be an integer")
    return require(changes, *columns)


def normalize_changelog(changes: DataFrame, op: str = "op") -> DataFrame:
    """Keep inserts, updates and deletes; drop update-before rows; fail on any other kind.

    Fails, too, on changes without ``seq`` or, where the column is given, ``bulk_id``.
    """
    kind = F.col(op)
    keep = (
        F.when(kind.isin(*ACCEPTED), True)
        .when(kind == UPDATE_BEFORE, False)
        .otherwise(
            F.raise_error(F.concat(F.lit("unknown row kind: "), F.coalesce(kind, F.lit("null")))).cast("boolean")
        )
    )
    given = [c for c in ("seq", "bulk_id") if c in changes.columns]
    return require_order(changes.where(keep), *given)
