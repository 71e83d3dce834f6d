"""Effects: what a run of net actions does to a key, whatever it held before.

Net actions depend on each other (an insert only counts when the key is absent,
a replace only when it is present), which looks like a row-by-row fold. But any
run of consecutive actions on a key can be summed up in one row, its *effect*:

``reset``     the run starts over (it holds a delete): the past is irrelevant
``present``   starting from nothing, the key exists afterwards
``add``       starting from nothing, the document that results; null if that is ``put``
``put``       starting from an existing document, what is written over it; null if nothing
``replaced``  starting from an existing document, attributes not in ``put`` are lost

Effects of adjoining runs combine into the effect of the joined run, so a key
can be folded in segments of bulks first and over its segments afterwards. A
key that holds a third of all changes is spread over as many tasks as it has
segments; the task that joins the segments sees one row for each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsink.functions.merging import lift_fields, merge_fields, mergeable
from docsink.functions.names import literal
from docsink.operators.bulks import (
    NET_DELETE,
    NET_INSERT,
    NET_REPLACE,
    NET_UPSERT,
    bulk_groups,
    net_actions,
)
from docsink.operators.changelog import ACCEPTED, DELETE, require_order

EFFECT_COLUMNS = ("reset", "present", "add", "put", "replaced")

# Bulks per segment. With bulks of 1000 changes a segment holds at most 256,000
# changes of one key.
SEGMENT_BULKS = 256

# Where documents are merged, folding copies the grown document at every step.
MERGING_BULKS = 32


def merging_fields(doc: T.StructType) -> list[T.StructField]:
    """Attributes that an upsert merges key by key (A5)."""
    return [f for f in doc.fields if mergeable(f.dataType)]


def effects_of_actions(net: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Each net action as an effect, ``(_key, <carry...>, <effect columns>)``."""
    doc_type = net.schema["doc"].dataType
    if merging_fields(doc_type):
        # Merged over nothing and over an existing document, an upsert differs.
        added = f"action in ('{NET_INSERT}', '{NET_UPSERT}')"
        add = lift_fields("doc", doc_type, cut="true")
        put = lift_fields("doc", doc_type, cut=f"action = '{NET_REPLACE}'")
    else:
        # One copy of the document is enough: an upsert leaves ``add`` to ``put``.
        added, add, put = f"action = '{NET_INSERT}'", "doc", "doc"
    return net.selectExpr(
        "_key",
        *carry,
        f"action = '{NET_DELETE}' as reset",
        f"action in ('{NET_INSERT}', '{NET_UPSERT}') as present",
        f"if({added}, {add}, null) as add",
        f"if(action in ('{NET_REPLACE}', '{NET_UPSERT}'), {put}, null) as put",
        f"action = '{NET_REPLACE}' as replaced",
    )


def effects_of_last_writes(changes: DataFrame) -> DataFrame:
    """Last write wins as effects: the last change of a key decides alone.

    Rows of other kinds than insert, update and delete say nothing here.
    """
    doc_type = changes.schema["doc"].dataType
    kinds = ", ".join(literal(op) for op in ACCEPTED)
    said = require_order(changes.where(f"op in ({kinds})"), "seq")
    last = said.groupBy("_key").agg(F.expr("max_by(struct(op, doc), seq) as _last"))
    doc = lift_fields("_last.doc", doc_type, cut="true") if merging_fields(doc_type) else "_last.doc"
    return last.selectExpr(
        "_key",
        "true as reset",
        f"_last.op <> '{DELETE}' as present",
        f"if(_last.op <> '{DELETE}', {doc}, null) as add",
        f"if(false, {doc}, null) as put",
        "false as replaced",
    )


def fold_effects(effects: DataFrame, keys: Sequence[str], order: str, doc_type: T.StructType) -> DataFrame:
    """Combine the effects of each group, in ``order``, into one."""
    if merging_fields(doc_type):
        return _fold_merging(effects, keys, order, doc_type)
    return _fold_plain(effects, keys, order)


def fold_bulks(
    changes: DataFrame,
    *,
    segment_bulks: int = SEGMENT_BULKS,
    bounded_bulks: bool = False,
    levels: int | None = None,
) -> DataFrame:
    """Changelog with bulk ids to one effect per key.

    ``bounded_bulks`` says that every bulk is known to be small (``roll_bulks``
    guarantees it). Then the changes are placed by (key, segment) right away,
    and collapsing the bulks and folding the segments both happen in that one
    placement: two shuffles in all. Otherwise the changes of a key in a bulk are
    combined on the map side first, which costs a third shuffle of what is left.

    ``levels`` says how often segments are folded in groups of ``segment_bulks``
    before a key's rows meet in one task: that task sees one row per
    ``segment_bulks ** (levels + 1)`` bulks. Every level is one more shuffle of
    folded rows; without a number it is 1 where documents are merged, else 0.
    """
    doc_type = changes.schema["doc"].dataType
    merging = bool(merging_fields(doc_type))
    if merging:
        segment_bulks = min(segment_bulks, MERGING_BULKS)
    if levels is None:
        levels = int(merging)
    changes = require_order(changes, "seq", "bulk_id")
    by = ("_key", "_segment", "bulk_id")
    placed = changes.selectExpr("_key", f"bulk_id div {segment_bulks} as _segment", "bulk_id", "seq", "op", "doc")
    if bounded_bulks:
        placed = placed.repartition("_key", "_segment")
    net = net_actions(bulk_groups(placed, by=by))
    effects = effects_of_actions(net, ("_segment", "bulk_id"))
    folded = fold_effects(effects, ("_key", "_segment"), "bulk_id", doc_type)
    for _ in range(levels):
        grouped = folded.selectExpr("*", f"_segment div {segment_bulks} as _group")
        folded = fold_effects(grouped, ("_key", "_group"), "_segment", doc_type)
        folded = folded.withColumnRenamed("_group", "_segment")
    return fold_effects(folded, ("_key",), "_segment", doc_type)


def _fold_plain(effects: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last birth and the last write of a group decide.

    A birth is a row that makes the key exist when it did not; only one can come
    after the last reset. All functions share one window, hence one pass over
    rows that are already placed and sorted, and one row of the group carries
    the result: the birth, or the last row if the key does not exist afterwards.
    """
    window = f"partition by {', '.join(keys)} order by {order}"
    group = f"over ({window} rows between unbounded preceding and unbounded following)"
    before = f"over ({window} rows between unbounded preceding and 1 preceding)"
    state = "if(reset or present, present, null)"
    wrote = f"if(put is not null, {order}, null)"
    rows = effects.selectExpr(
        *keys,
        order,
        "add",
        f"present and (reset or not coalesce(last_value({state}) ignore nulls {before}, false)) as _birth",
        f"max(if(reset, {order}, null)) {group} as _cut",
        f"coalesce(last_value({state}) ignore nulls {group}, false) as present",
        f"max({order}) {group} as _end",
        f"max({wrote}) {group} as _wrote",
        f"max_by(put, {wrote}) {group} as _put",
        f"bool_or(replaced) {group} as replaced",
    )
    # A later write hides the birth document; a row that does both (an upsert)
    # leaves ``add`` empty, unless its ``add`` came after its ``put``.
    hidden = f"coalesce(_wrote > {order} or (_wrote = {order} and add is null), false)"
    return rows.where(
        f"if(present, _birth and coalesce({order} >= _cut, true), {order} = _end)"
    ).selectExpr(
        *keys,
        "_cut is not null as reset",
        "present",
        f"case when not present then null when not {hidden} then add when _cut is not null then _put end as add",
        "if(_cut is not null, null, _put) as put",
        "replaced",
    )


def _fold_merging(effects: DataFrame, keys: Sequence[str], order: str, doc_type: T.StructType) -> DataFrame:
    """Ordered fold, for documents whose maps are merged.

    The collected list is short: one row per bulk of a segment, per segment of a
    group or per batch of a log, and only from the last delete on.
    """
    # Nothing before the last reset matters.
    live = effects.selectExpr(
        "*", f"max(if(reset, {order}, null)) over (partition by {', '.join(keys)}) as _cut"
    ).where(f"_cut is null or {order} >= _cut")
    by_order = f"(l, r) -> case when l.{order} < r.{order} then -1 when l.{order} > r.{order} then 1 else 0 end"
    listed = live.groupBy(*keys).agg(
        F.expr(f"array_sort(collect_list(struct({order}, {', '.join(EFFECT_COLUMNS)})), {by_order}) as _run")
    )
    first = ", ".join(f"_run[0].{c} as {c}" for c in EFFECT_COLUMNS)
    combined = _combined("x", "y", doc_type)
    folded = listed.selectExpr(
        *keys, f"reduce(slice(_run, 2, size(_run)), struct({first}), (x, y) -> {combined}) as _effect"
    )
    return folded.selectExpr(*keys, "_effect.*")


def _combined(x: str, y: str, doc_type: T.StructType) -> str:
    """Effect of run ``x`` followed by run ``y``, which holds no reset (see ``_fold_merging``)."""
    over_add = merge_fields(f"{x}.add", f"{y}.put", doc_type)
    over_put = merge_fields(f"{x}.put", f"{y}.put", doc_type)
    return f"""struct(
        {x}.reset as reset,
        {x}.present or {y}.present as present,
        case when not {x}.present then {y}.add when {y}.put is null then {x}.add else {over_add} end as add,
        case when {x}.reset or {y}.put is null then {x}.put
             when {x}.put is null then {y}.put else {over_put} end as put,
        {x}.replaced or {y}.replaced as replaced)"""
