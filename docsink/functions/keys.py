"""Document key choice (K1-K5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsink.functions.names import quote

_NO_KEY = (T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.NullType)


def document_key(
    schema: T.StructType, key: str | Sequence[str] | None, policy: str = "single"
) -> tuple[str, T.DataType, Column]:
    """Name, type and column of the attribute that becomes ``_key``.

    A composite key is refused, because only its first column would tell
    documents apart; ``policy="first"`` asks for exactly that.
    """
    names = [key] if isinstance(key, str) else list(key or ())
    if not names:
        raise ValueError("a primary key is required")
    if policy not in ("single", "first"):
        raise ValueError(f"unknown key policy {policy!r}")
    if len(names) > 1 and policy != "first":
        raise ValueError(
            f"composite key {names}: only the first column would be used; pass key_policy='first' to accept that"
        )
    name = names[0]
    if name not in schema.fieldNames():
        raise ValueError(f"key column {name!r} is not in {schema.fieldNames()}")
    dtype = schema[name].dataType
    if isinstance(dtype, _NO_KEY):
        raise TypeError(f"column {name!r} of type {dtype.simpleString()} cannot be a document key")
    return name, dtype, F.col(quote(name))
