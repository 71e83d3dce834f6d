"""Collapsing a bulk to one net action per key.

Input rows are ``(_key, bulk_id, seq, op, doc)``. Within one bulk a key with a
single change keeps the kind of that change; a key with several changes keeps
only the last one, and an insert or update in last place becomes an upsert.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsink.operators.changelog import DELETE, INSERT, UPDATE_AFTER, require_order

# Net actions.
NET_DELETE = "D"
NET_INSERT = "I"
NET_REPLACE = "R"
NET_UPSERT = "U"

NET_ACTION = f"""
case when op = '{DELETE}' then '{NET_DELETE}'
     when n > 1 and op in ('{INSERT}', '{UPDATE_AFTER}') then '{NET_UPSERT}'
     when op = '{INSERT}' then '{NET_INSERT}'
     when op = '{UPDATE_AFTER}' then '{NET_REPLACE}' end"""


def bulk_sizes(changes: DataFrame, flush_size: int, by: Sequence[str] = ("bulk_id",)) -> DataFrame:
    """Changes per bulk and whether the bulk is full."""
    return changes.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        (F.count(F.lit(1)) >= flush_size).alias("is_full"),
    )


def bulk_groups(changes: DataFrame, by: Sequence[str] = ("_key", "bulk_id")) -> DataFrame:
    """One row per key of a bulk: number of changes, last row kind, last document.

    ``max_by`` keeps one row per group on the map side, so a key with millions
    of changes in a bulk costs one row per map task in the shuffle.
    """
    changes = require_order(changes, "seq", *[c for c in by if c == "bulk_id"])
    grouped = changes.groupBy(*by).agg(F.expr("count(1) as n"), F.expr("max_by(struct(op, doc), seq) as _last"))
    return grouped.selectExpr(*by, "n", "_last.op as op", "_last.doc as doc")


def bulk_singles(groups: DataFrame) -> DataFrame:
    """Keys changed exactly once in their bulk (C4)."""
    return groups.where("n = 1")


def bulk_groups_ending(groups: DataFrame, op: str) -> DataFrame:
    """Keys changed several times whose last change is of kind ``op``."""
    return groups.where((F.col("n") > 1) & (F.col("op") == op))


def net_actions(groups: DataFrame) -> DataFrame:
    """Groups with their net action; keys without one are dropped (C11)."""
    return groups.where(f"{NET_ACTION} is not null").selectExpr("*", f"{NET_ACTION} as action")


def bulk_dropped(groups: DataFrame) -> DataFrame:
    """Groups without a net action: they end in update-before or an unknown kind."""
    return groups.where(f"{NET_ACTION} is null")


def bulk_inserts(groups: DataFrame) -> DataFrame:
    """Documents to insert."""
    return groups.where(f"n = 1 and op = '{INSERT}'")


def bulk_updates(groups: DataFrame) -> DataFrame:
    """Documents to replace."""
    return groups.where(f"n = 1 and op = '{UPDATE_AFTER}'")


def bulk_deletes(groups: DataFrame) -> DataFrame:
    """Keys to delete, whether the delete came alone or last."""
    return groups.where(f"op = '{DELETE}'").drop("doc")


def bulk_upserts(groups: DataFrame) -> DataFrame:
    """Documents to upsert."""
    return groups.where(f"n > 1 and op in ('{INSERT}', '{UPDATE_AFTER}')")
