"""What becomes of each change: applied, or refused without a trace.

An insert is refused when the key is present, a replace when it is absent, and a
delete of an absent key misses. Whether a key is present depends on what came
before, but only up to the first insert, upsert or delete of a run; from then on
the outcome is the same whatever the run started from. So a run is summed up by
counts that are certain and by counts that are *open*: inserts that a present
key refuses, replaces and deletes that an absent key does. Sums of adjoining runs
combine, so that a key is summed up in segments first, like its effects, and only
one row per key meets the collection, of which only the keys are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsink.functions.names import quote
from docsink.operators.bulks import NET_DELETE, NET_INSERT, NET_REPLACE, NET_UPSERT, bulk_groups, net_actions
from docsink.operators.changelog import ACCEPTED, UPDATE_BEFORE
from docsink.operators.effects import SEGMENT_BULKS

ACTIONS = {"inserts": NET_INSERT, "replaces": NET_REPLACE, "upserts": NET_UPSERT, "deletes": NET_DELETE}
REFUSED = ("inserts_refused", "replaces_refused", "deletes_missed")
OUTCOME_COLUMNS = (*ACTIONS, *REFUSED)
_OPEN = ("open_inserts", "open_replaces", "open_deletes")


def fold_outcomes(changes: DataFrame, *, segment_bulks: int = SEGMENT_BULKS) -> DataFrame:
    """One row per key of a changelog with bulk ids: counts, and the state it leaves (null: as it was)."""
    placed = changes.selectExpr(
        "_key", f"bulk_id div {segment_bulks} as _segment", "bulk_id", "seq", "op", "0 as doc"
    )
    net = net_actions(bulk_groups(placed, by=("_key", "_segment", "bulk_id")))
    state = f"case when action in ('{NET_INSERT}', '{NET_UPSERT}') then true when action = '{NET_DELETE}' then false end"
    before = "over (partition by _key, _segment order by bulk_id rows between unbounded preceding and 1 preceding)"
    rows = net.selectExpr(
        "_key", "_segment", "bulk_id", "action", f"{state} as state", f"last_value({state}) ignore nulls {before} as prior"
    )

    def counted(condition: str, name: str) -> str:
        return f"count_if({condition}) as {name}"

    segments = rows.groupBy("_key", "_segment").agg(
        *[F.expr(counted(f"action = '{action}'", name)) for name, action in ACTIONS.items()],
        F.expr(counted(f"action = '{NET_INSERT}' and prior", "inserts_refused")),
        F.expr(counted(f"action = '{NET_REPLACE}' and not prior", "replaces_refused")),
        F.expr(counted(f"action = '{NET_DELETE}' and not prior", "deletes_missed")),
        F.expr(counted(f"action = '{NET_INSERT}' and prior is null", "open_inserts")),
        F.expr(counted(f"action = '{NET_REPLACE}' and prior is null", "open_replaces")),
        F.expr(counted(f"action = '{NET_DELETE}' and prior is null", "open_deletes")),
        F.expr("max_by(state, if(state is null, null, bulk_id)) as state"),
    )
    earlier = "over (partition by _key order by _segment rows between unbounded preceding and 1 preceding)"
    known = segments.selectExpr("*", f"last_value(state) ignore nulls {earlier} as prior")
    settled = known.selectExpr(
        "_key",
        "_segment",
        "state",
        *ACTIONS,
        "inserts_refused + if(prior, open_inserts, 0) as inserts_refused",
        "replaces_refused + if(not prior, open_replaces, 0) as replaces_refused",
        "deletes_missed + if(not prior, open_deletes, 0) as deletes_missed",
        *[f"if(prior is null, {name}, 0) as {name}" for name in _OPEN],
    )
    return settled.groupBy("_key").agg(
        *[F.expr(f"sum({name}) as {name}") for name in (*OUTCOME_COLUMNS, *_OPEN)],
        F.expr("max_by(state, if(state is null, null, _segment)) as state"),
    )


def resolve_outcomes(outcomes: DataFrame, keys: DataFrame | None) -> DataFrame:
    """Counts per key, given the keys of the collection before; ``present`` says whether the key is there afterwards."""
    if keys is None:
        known = outcomes.withColumn("was", F.lit(False))
    else:
        there = keys.select("_key", F.lit(True).alias("was"))
        known = outcomes.join(there, "_key", "left").withColumn("was", F.coalesce("was", F.lit(False)))
    return known.selectExpr(
        "_key",
        *ACTIONS,
        "inserts_refused + if(was, open_inserts, 0) as inserts_refused",
        "replaces_refused + if(was, 0, open_replaces) as replaces_refused",
        "deletes_missed + if(was, 0, open_deletes) as deletes_missed",
        "coalesce(state, was) as present",
    )


def reason_to_reject(key: str, columns: list[str]) -> Column:
    """Why a row cannot be a change at all; null for one that can."""
    kinds = [*ACCEPTED, UPDATE_BEFORE]
    reason = F.when(F.col(quote(key)).isNull(), "no key")
    reason = reason.when(F.col("op").isNull() | ~F.col("op").isin(*kinds), "unknown kind")
    for column in ("seq", "bulk_id"):
        if column in columns:
            reason = reason.when(F.col(column).isNull(), f"no {column}")
    return reason
