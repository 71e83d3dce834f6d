"""Deep merge of nested documents for upserts (A5), in a form that composes.

An upsert merges nested objects key by key, while arrays and plain values are
replaced. Merging alone is not associative once a null stands between two maps
(``{a}, null, {b}`` leaves ``{b}``), so every mergeable value carries a ``cut``
flag: "whatever was here before is gone". With it, patches can be combined in
segments and the order of combining does not matter.

``lift`` adds the flags, ``merge`` combines two lifted values in order and
``lower`` removes the flags again. All three take and return SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import types as T

from docsink.functions.names import literal, quote


def mergeable(dtype: T.DataType) -> bool:
    """True when an upsert merges this type instead of replacing it.

    A struct without maps has the same fields on both sides, so merging it
    and replacing it are the same thing.
    """
    if isinstance(dtype, T.StructType):
        return any(mergeable(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.MapType)


def lift(value: str, dtype: T.DataType, cut: str, depth: int = 0) -> str:
    if not mergeable(dtype):
        return value
    inner = value
    if isinstance(dtype, T.StructType):
        fields = [(f, lift(f"{value}.{quote(f.name)}", f.dataType, cut, depth)) for f in dtype.fields]
        inner = f"if({value} is null, null, {_struct(fields)})"
    elif mergeable(dtype.valueType):
        v = f"v{depth}"
        inner = f"transform_values({value}, (k{depth}, {v}) -> {lift(v, dtype.valueType, cut, depth + 1)})"
    return f"named_struct('v', {inner}, 'cut', ({cut}) or {value} is null)"


def lower(value: str, dtype: T.DataType, depth: int = 0) -> str:
    if not mergeable(dtype):
        return value
    inner = f"{value}.v"
    if isinstance(dtype, T.StructType):
        fields = [(f, lower(f"{inner}.{quote(f.name)}", f.dataType, depth)) for f in dtype.fields]
        return f"if({inner} is null, null, {_struct(fields)})"
    if mergeable(dtype.valueType):
        v = f"v{depth}"
        return f"transform_values({inner}, (k{depth}, {v}) -> {lower(v, dtype.valueType, depth + 1)})"
    return inner


def merge(old: str, new: str, dtype: T.DataType, depth: int = 0) -> str:
    """``new`` applied after ``old``; both lifted."""
    if not mergeable(dtype):
        return new
    if isinstance(dtype, T.StructType):
        merged = merge_fields(f"{old}.v", f"{new}.v", dtype, depth)
    else:
        merged = _merge_maps(f"{old}.v", f"{new}.v", dtype.valueType, depth)
    return (
        f"(case when {new}.cut then {new} "
        f"when {old}.v is null then named_struct('v', {new}.v, 'cut', true) "
        f"else named_struct('v', {merged}, 'cut', {old}.cut) end)"
    )


def merge_fields(old: str, new: str, dtype: T.StructType, depth: int = 0) -> str:
    """All fields of ``new`` applied after those of ``old``."""
    fields = []
    for f in dtype.fields:
        name = quote(f.name)
        fields.append((f, merge(f"{old}.{name}", f"{new}.{name}", f.dataType, depth)))
    return _struct(fields)


def lift_fields(value: str, dtype: T.StructType, cut: str) -> str:
    """A document with all its fields lifted."""
    return _struct([(f, lift(f"{value}.{quote(f.name)}", f.dataType, cut)) for f in dtype.fields])


def _merge_maps(old: str, new: str, value_type: T.DataType, depth: int) -> str:
    k, a, b = f"k{depth}", f"a{depth}", f"b{depth}"
    # An explicit null in the new document counts as a value.
    picked = f"if(map_contains_key({new}, {k}), {b}, {a})"
    if mergeable(value_type):
        both = f"map_contains_key({old}, {k}) and map_contains_key({new}, {k})"
        picked = f"if({both}, {merge(a, b, value_type, depth + 1)}, {picked})"
    return f"map_zip_with({old}, {new}, ({k}, {a}, {b}) -> {picked})"


def _struct(fields: list[tuple[T.StructField, str]]) -> str:
    return "named_struct(" + ", ".join(f"{literal(f.name)}, {value}" for f, value in fields) + ")"
