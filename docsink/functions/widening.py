"""Attributes whose type differs between a collection and the changes (A5).

A collection has no schema of its own, so integers may grow wider, floats
become doubles and nested objects gain or lose fields. What has no common form
is refused when the plan is built. Functions take and return SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import types as T

from docsink.functions.names import literal, quote

_INTEGERS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_FLOATS = [T.FloatType, T.DoubleType]


def same_type(left: T.DataType, right: T.DataType) -> bool:
    return left.simpleString() == right.simpleString()


def common_type(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """The narrowest type that holds both, None if there is none."""
    if same_type(left, right):
        return left
    for ladder in (_INTEGERS, _FLOATS):
        steps = [next((i for i, kind in enumerate(ladder) if isinstance(t, kind)), None) for t in (left, right)]
        if None not in steps:
            return ladder[max(steps)]()
    if isinstance(left, T.ArrayType) and isinstance(right, T.ArrayType):
        element = common_type(left.elementType, right.elementType)
        return element and T.ArrayType(element)
    if isinstance(left, T.StructType) and isinstance(right, T.StructType):
        return _common_struct(left, right)
    return None


def _common_struct(left: T.StructType, right: T.StructType) -> T.StructType | None:
    fields = []
    for name in dict.fromkeys([*left.names, *right.names]):
        found = [side[name].dataType for side in (left, right) if name in side.names]
        dtype = found[0] if len(found) == 1 else common_type(*found)
        if dtype is None:
            return None
        fields.append(T.StructField(name, dtype))
    return T.StructType(fields)


def fit(value: str, dtype: T.DataType, wide: T.DataType) -> str:
    """``value`` in the wider type; fields it lacks are null."""
    if same_type(dtype, wide):
        return value
    if isinstance(wide, T.StructType):
        fields = [
            f"{literal(f.name)}, "
            + (fit(f"{value}.{quote(f.name)}", dtype[f.name].dataType, f.dataType) if f.name in dtype.names else _null(f.dataType))
            for f in wide.fields
        ]
        return f"if({value} is null, null, named_struct({', '.join(fields)}))"
    if isinstance(wide, T.ArrayType):
        return f"transform({value}, x -> {fit('x', dtype.elementType, wide.elementType)})"
    return f"cast({value} as {wide.simpleString()})"


def patched(old: str, new: str, dtype: T.DataType, wide: T.DataType, keep: str) -> str:
    """``new`` over ``old``: fields that ``new`` does not have stay while ``keep`` holds."""
    if not isinstance(wide, T.StructType):
        return fit(new, dtype, wide)
    fields = []
    for f in wide.fields:
        before = f"{old}.{quote(f.name)}"
        if f.name in dtype.names:
            after = patched(before, f"{new}.{quote(f.name)}", dtype[f.name].dataType, f.dataType, keep)
        else:
            after = f"if({keep}, {before}, null)"
        fields.append(f"{literal(f.name)}, {after}")
    return f"if({new} is null, null, named_struct({', '.join(fields)}))"


def _null(dtype: T.DataType) -> str:
    return f"cast(null as {dtype.simpleString()})"
