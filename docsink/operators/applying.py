"""Applying changes to a collection.

A collection is a DataFrame with ``_key`` and one column per attribute. A
document with an attribute the collection lacks adds a column; attributes only
the collection has survive an upsert and are lost in a replace, and so do fields
of a nested object. A wider number widens the attribute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsink.functions.merging import lift, lower, merge, mergeable
from docsink.functions.names import quote
from docsink.functions.widening import common_type, fit, patched, same_type
from docsink.operators.bulks import bulk_groups, net_actions
from docsink.operators.effects import (
    EFFECT_COLUMNS,
    SEGMENT_BULKS,
    effects_of_actions,
    effects_of_last_writes,
    fold_bulks,
)


def apply_deletes(base: DataFrame, keys: DataFrame) -> DataFrame:
    """Remove documents by key; unknown keys are ignored (A1).

    Equal keys are combined before they are shuffled.
    """
    return base.join(keys.select("_key").distinct(), "_key", "left_anti")


def apply_inserts(base: DataFrame, docs: DataFrame) -> DataFrame:
    """Add documents whose key is new; existing ones stay as they are (A2)."""
    return base.unionByName(
        docs.join(base.select("_key"), "_key", "left_anti").select("_key", "doc.*"), allowMissingColumns=True
    )


def apply_replaces(base: DataFrame, docs: DataFrame) -> DataFrame:
    """Replace whole documents; unknown keys are ignored (A3)."""
    return apply_effects(base, _effects(docs, "R"), docs.schema["doc"].dataType)


def apply_upserts(base: DataFrame, docs: DataFrame) -> DataFrame:
    """Add new documents, patch existing ones, merging maps key by key (A4, A5)."""
    return apply_effects(base, _effects(docs, "U"), docs.schema["doc"].dataType)


def apply_one_bulk(base: DataFrame | None, bulk: DataFrame) -> DataFrame:
    """All changes of ``bulk`` as a single bulk."""
    net = net_actions(bulk_groups(bulk, by=("_key",)))
    return apply_effects(base, effects_of_actions(net), bulk.schema["doc"].dataType)


def apply_bulks(
    base: DataFrame | None,
    changes: DataFrame,
    *,
    segment_bulks: int = SEGMENT_BULKS,
    bounded_bulks: bool = False,
) -> DataFrame:
    """All bulks of ``changes`` in order of ``bulk_id``."""
    effects = fold_bulks(changes, segment_bulks=segment_bulks, bounded_bulks=bounded_bulks)
    return apply_effects(base, effects, changes.schema["doc"].dataType)


def apply_last_writes(base: DataFrame | None, changes: DataFrame) -> DataFrame:
    """Only the last change of each key, whatever came before."""
    return apply_effects(base, effects_of_last_writes(changes), changes.schema["doc"].dataType)


def apply_effects(
    base: DataFrame | None, effects: DataFrame, doc_type: T.StructType, *, small_effects: bool = False
) -> DataFrame:
    """Apply one effect per key to the collection.

    Both sides hold a key at most once, so the join has no skew, and folded
    effects arrive already placed by key: only ``base`` moves. With
    ``small_effects`` (for callers that checked the size of ``effects``) the
    effects are broadcast and ``base`` stays where it is.
    """
    attributes = [f for f in doc_type.fields if f.name != "_key"]
    if base is None:
        return _new_documents(effects, attributes)

    left, stored = _stored(base, [attributes])
    if not small_effects:
        return _after(left.join(effects, F.expr(f"{_base('_key')} = _key"), "full_outer"), stored, attributes)

    matched = left.join(F.broadcast(effects), F.expr(f"{_base('_key')} = _key"), "left")
    kept = _after(matched, stored, attributes, key=_base("_key"))
    found = base.select("_key").join(F.broadcast(effects.select("_key")), "_key", "left_semi")
    new = _new_documents(effects.join(found, "_key", "left_anti"), attributes, stored)
    return kept.unionByName(new, allowMissingColumns=True)


def apply_effect_runs(
    base: DataFrame,
    runs: Sequence[tuple[DataFrame, T.StructType]],
    *,
    small_effects: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Apply several effects per key, one for each run of a document type, in order.

    An attribute that a document does not have is not the same as one that is
    null, so effects of different document types are not folded; but they are
    gathered by key first, and ``base`` is joined once, however many there are.
    ``buckets`` is the number of buckets by ``_key`` that ``base`` lies in.
    """
    if len(runs) == 1:
        return apply_effects(base, *runs[0], small_effects=small_effects)
    gathered = None
    for i, (effects, _) in enumerate(runs):
        part = effects.select("_key", F.struct(*EFFECT_COLUMNS).alias(_run(i)))
        gathered = part if gathered is None else gathered.unionByName(part, allowMissingColumns=True)
    names = [_run(i) for i in range(len(runs))]
    wide = gathered.groupBy("_key").agg(*[F.first(quote(n), ignorenulls=True).alias(n) for n in names])
    if buckets is not None and not small_effects:
        wide = wide.repartition(buckets, "_key")

    types = [[f for f in doc_type.fields if f.name != "_key"] for _, doc_type in runs]
    left, stored = _stored(base, types)
    on = F.expr(f"{_base('_key')} = _key")
    if not small_effects:
        return _in_order(left.join(wide, on, "full_outer"), stored, types)
    kept = _in_order(left.join(F.broadcast(wide), on, "left"), stored, types)
    found = base.select("_key").join(F.broadcast(wide.select("_key")), "_key", "left_semi")
    absent = [f"cast(null as {t.simpleString()}) as {_base(n)}" for n, t in {"_key": T.StringType(), **stored}.items()]
    new = wide.join(found, "_key", "left_anti").selectExpr(*absent, "*")
    return kept.unionByName(_in_order(new, stored, types), allowMissingColumns=True)


def _in_order(joined: DataFrame, stored: dict[str, T.DataType], types: list[list[T.StructField]]) -> DataFrame:
    """Runs one after another over rows that hold a stored document, a struct per run, or both."""
    stored = dict(stored)
    rows = joined.withColumn("key:", F.expr(f"coalesce(_key, {_base('_key')})"))
    for i, attributes in enumerate(types):
        rest = [quote(_run(j)) for j in range(i + 1, len(types))]
        run = quote(_run(i))
        rows = rows.selectExpr(
            "`key:`", *[_base(n) for n in ("_key", *stored)], f"if({run} is null, null, `key:`) as _key", f"{run}.*", *rest
        )
        rows = _step(rows, stored, attributes, ["`key:`", *rest])
        for field in attributes:
            stored.setdefault(field.name, field.dataType)
        rows = rows.selectExpr(
            "`key:`",
            f"if(`exists:`, `key:`, null) as {_base('_key')}",
            *[f"if(`exists:`, {quote(n)}, null) as {_base(n)}" for n in stored],
            *rest,
        )
    return rows.where(f"{_base('_key')} is not null").selectExpr(
        f"{_base('_key')} as _key", *[f"{_base(n)} as {quote(n)}" for n in stored]
    )


def _stored(base: DataFrame, runs: list[list[T.StructField]]) -> tuple[DataFrame, dict[str, T.DataType]]:
    """The collection with its columns set apart and as wide as the changes need, and their types."""
    stored = {f.name: f.dataType for f in base.schema.fields if f.name != "_key"}
    wide: dict[str, T.DataType] = {}
    for attributes in runs:
        _check_names([*stored, *wide, *[f.name for f in attributes]])
        for field in attributes:
            known = wide.get(field.name, stored.get(field.name))
            wide[field.name] = field.dataType if known is None else _wide(field, known)
    fitted = [f"{fit(quote(n), t, wide.get(n, t))} as {_base(n)}" for n, t in stored.items()]
    new = [n for n in wide if n not in stored and len(runs) > 1]
    fitted += [f"cast(null as {wide[n].simpleString()}) as {_base(n)}" for n in new]
    types = {n: wide.get(n, stored.get(n)) for n in [*stored, *new]}
    return base.selectExpr(f"`_key` as {_base('_key')}", *fitted), types


def _after(
    joined: DataFrame, stored: dict[str, T.DataType], attributes: list[T.StructField], key: str | None = None
) -> DataFrame:
    """Documents after the effects, from rows with both the stored and the effect columns.

    Where every row has a stored document, its ``key`` alone lets conditions on keys reach the scan.
    """
    rows = joined.withColumn("key:", F.expr(key or f"coalesce(_key, {_base('_key')})"))
    names = [f.name for f in attributes]
    return _step(rows, stored, attributes, ["`key:`"]).where("`exists:`").selectExpr(
        "`key:` as _key", *[quote(n) for n in [*names, *[n for n in stored if n not in names]]]
    )


def _step(
    joined: DataFrame, stored: dict[str, T.DataType], attributes: list[T.StructField], carry: list[str]
) -> DataFrame:
    """All attributes after one effect, whether the document ``exists:``, and the columns in ``carry``."""
    survives = f"({_base('_key')} is not null and not coalesce(reset, false))"

    merging = [f for f in attributes if mergeable(f.dataType) and f.name in stored]
    if merging:
        lifted = {f.name: lift(_base(f.name), f.dataType, cut="true") for f in merging}
        joined = joined.selectExpr(
            "*", *[f"{merge(lifted[f.name], f'put.{quote(f.name)}', f.dataType)} as {_merged(f.name)}" for f in merging]
        )

    def attribute(field: T.StructField) -> str:
        name = field.name
        old = _base(name) if name in stored else "null"
        if name in stored and not same_type(stored[name], field.dataType):
            keep = f"{survives} and not coalesce(replaced, false)"
            new = patched(old, f"put.{quote(name)}", field.dataType, stored[name], keep)
        else:
            new = lower(_merged(name) if field in merging else f"put.{quote(name)}", field.dataType)
        fresh = _fresh(field, stored.get(name))
        return f"case when not {survives} then {fresh} when put is null then {old} else {new} end as {quote(name)}"

    only_in_base = [n for n in stored if n not in {f.name for f in attributes}]
    return joined.selectExpr(
        *carry,
        f"{survives} or coalesce(present, false) as `exists:`",
        *[attribute(f) for f in attributes],
        *[f"if({survives} and not coalesce(replaced, false), {_base(n)}, null) as {quote(n)}" for n in only_in_base],
    )


def _new_documents(
    effects: DataFrame, attributes: list[T.StructField], stored: dict[str, T.DataType] | None = None
) -> DataFrame:
    fresh = [f"{_fresh(f, (stored or {}).get(f.name))} as {quote(f.name)}" for f in attributes]
    return effects.where("present").selectExpr("_key", *fresh)


def _fresh(field: T.StructField, wide: T.DataType | None) -> str:
    """Attribute of the document that results when the key did not exist."""
    value = f"coalesce(add, put).{quote(field.name)}"
    if wide is None or same_type(wide, field.dataType):
        return lower(value, field.dataType)
    return fit(value, field.dataType, wide)


def _wide(field: T.StructField, stored: T.DataType) -> T.DataType:
    """Type of an attribute after the changes."""
    wide = common_type(stored, field.dataType)
    # Maps are merged entry by entry and carry marks for it, so their type is fixed.
    if wide is None or (mergeable(field.dataType) and not same_type(stored, field.dataType)):
        raise TypeError(
            f"attribute {field.name!r} is {stored.simpleString()} in the collection "
            f"and {field.dataType.simpleString()} in the changes"
        )
    return wide


def _check_names(names: list[str]) -> None:
    """Documents tell upper from lower case, columns do not: refuse what could be mixed up."""
    seen: dict[str, str] = {}
    for name in names:
        other = seen.setdefault(name.lower(), name)
        if other != name:
            raise ValueError(f"attributes {other!r} and {name!r} differ only in case")


def _base(name: str) -> str:
    return quote(f"base:{name}")


def _run(number: int) -> str:
    return f"run:{number}"


def _merged(name: str) -> str:
    return quote(f"merged:{name}")


def _effects(docs: DataFrame, action: str) -> DataFrame:
    return effects_of_actions(docs.select("_key", "doc", F.lit(action).alias("action")))
