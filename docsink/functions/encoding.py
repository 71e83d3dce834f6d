"""Row to document encoding, one native expression per field.

``encode_documents`` walks the schema once and builds a single ``select``; the
work itself is ordinary Catalyst expressions, so scans keep their column
pruning and the projection stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsink.functions.keys import document_key
from docsink.functions.names import quote

# The text form of timestamps and the JSON wrapper names.
TIMESTAMP_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
BINARY_FIELD = "$binary"
BINARY_SUBTYPE = "00"
DECIMAL_FIELD = "$numberDecimal"
DOUBLE_FIELD = "$numberDouble"
MAX_DECIMAL_DIGITS = 34

_SAME = (T.BooleanType, T.IntegerType, T.LongType, T.DoubleType)
_STRINGS = (T.StringType, T.CharType, T.VarcharType)


def encode_column(col: Column, dtype: T.DataType, path: str) -> Column:
    """Encode one value; nulls stay null.

    Raises ``TypeError`` naming ``path`` for a type documents cannot hold.
    """
    if isinstance(dtype, _SAME) or isinstance(dtype, _STRINGS):
        return col
    if isinstance(dtype, T.NullType):
        # Parquet stores no untyped nulls.
        return col.cast("string")
    if isinstance(dtype, (T.ByteType, T.ShortType)):
        return col.cast("int")
    if isinstance(dtype, T.YearMonthIntervalType):
        return _months(col)
    if isinstance(dtype, T.DayTimeIntervalType):
        return _milliseconds(col)
    if isinstance(dtype, T.FloatType):
        return col.cast("double")
    if isinstance(dtype, T.BinaryType):
        return _binary(col)
    if isinstance(dtype, T.DateType):
        return F.unix_date(col)
    if isinstance(dtype, T.TimestampType):
        return F.date_format(col, TIMESTAMP_PATTERN)
    if isinstance(dtype, T.TimestampNTZType):
        return _wall_clock(col)
    if isinstance(dtype, T.DecimalType):
        return _decimal(col, dtype, path)
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: encode_column(x, dtype.elementType, f"{path}[]"))
    if isinstance(dtype, T.MapType):
        if not isinstance(dtype.keyType, _STRINGS):
            raise TypeError(
                f"cannot encode field {path}. Map keys must be strings, got {dtype.simpleString()}"
            )
        return F.transform_values(col, lambda _, v: encode_column(v, dtype.valueType, f"{path}{{}}"))
    if isinstance(dtype, T.StructType):
        fields = [
            encode_column(col.getField(f.name), f.dataType, f"{path}.{f.name}").alias(f.name)
            for f in dtype.fields
        ]
        return F.when(col.isNotNull(), F.struct(*fields))
    raise TypeError(f"cannot encode field {path}. Unsupported type {dtype.simpleString()}")


def encode_fields(schema: T.StructType, skip: Sequence[str] = ()) -> list[Column]:
    """Encoded columns for every field of ``schema`` not in ``skip``."""
    return [
        encode_column(F.col(quote(f.name)), f.dataType, f.name).alias(f.name)
        for f in schema.fields
        if f.name not in skip
    ]


def encode_documents(
    df: DataFrame,
    key: str | Sequence[str],
    *,
    key_policy: str = "single",
    carry: Sequence[str] = ("op", "seq"),
) -> DataFrame:
    """Rows to ``(_key, <carry...>, doc)`` with ``doc`` the encoded struct.

    ``carry`` names the bookkeeping columns (row kind, sequence, bulk id, ...)
    that travel beside the document; the ones missing from ``df`` are ignored.
    A user column called ``_key`` is replaced by the derived key.
    """
    kept = [c for c in carry if c in df.columns]
    key_name, key_type, key_expr = document_key(df.schema, key, key_policy)
    if key_name in kept:
        raise ValueError(f"key column {key_name!r} cannot be a bookkeeping column")
    encoded = encode_column(key_expr, key_type, key_name)
    text = _decimal_text(key_expr) if isinstance(key_type, T.DecimalType) else encoded.cast("string")
    not_null = F.coalesce(text, F.raise_error(F.lit(f"null document key in column {key_name}")))
    fields = encode_fields(df.schema, skip=[*kept, "_key"])
    doc = F.struct(*fields) if fields else F.struct(not_null.alias("_key"))
    return df.select(not_null.alias("_key"), *[F.col(quote(c)) for c in kept], doc.alias("doc"))


def decode_json_documents(text: Column, schema: T.StructType | str) -> Column:
    """Documents that arrive as JSON text, parsed with a fixed schema."""
    return F.from_json(text, schema)


def entries_to_map(entries: Column) -> Column:
    """Map from ``array<struct<k, v>>``: null keys dropped, last duplicate wins."""

    def last_per_key(sorted_entries: Column) -> Column:
        size = F.size(sorted_entries)
        return F.filter(
            sorted_entries,
            lambda e, i: (i == size - 1)
            | (F.get(sorted_entries, i + 1)["k"] != e["k"]),
        )

    def by_key_then_position(left: Column, right: Column) -> Column:
        return (
            F.when(left["k"] < right["k"], -1)
            .when(left["k"] > right["k"], 1)
            .when(left["i"] < right["i"], -1)
            .otherwise(1)
        )

    indexed = F.transform(
        F.filter(entries, lambda e: e["k"].isNotNull()),
        lambda e, i: F.struct(e["k"].alias("k"), i.alias("i"), e["v"].alias("v")),
    )
    # The one-element array binds the sorted entries to a lambda variable, so
    # they are computed once and not again for every element looked at.
    bound = F.array(F.array_sort(indexed, by_key_then_position))
    kept = F.get(F.transform(bound, last_per_key), 0)
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["k"], e["v"])))


def multiset_by(df: DataFrame, keys: Sequence[str], element: str, name: str) -> DataFrame:
    """One MULTISET attribute per key: element text to occurrence count.

    Elements are counted first (combined map-side), so a key that holds most
    rows still ships one row per distinct element and map task.
    """
    counted = (
        df.where(F.col(element).isNotNull())
        .groupBy(*keys, F.col(element).cast("string").alias("_el"))
        .agg(F.count(F.lit(1)).cast("int").alias("_n"))
    )
    return counted.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_el", "_n"))).alias(name)
    )


def document_json(doc: Column, dtype: T.DataType) -> Column:
    """JSON text of an encoded document; nulls kept, NaN and infinities wrapped."""
    return F.to_json(_json_ready(doc, dtype), {"ignoreNullFields": "false"})


def _wall_clock(col: Column) -> Column:
    """Text of a local timestamp; formatting it would go through the session time zone."""
    text = col.cast("string")
    fraction = F.when(F.contains(text, F.lit(".")), F.substring_index(text, ".", -1)).otherwise("")
    seconds = F.replace(F.substring_index(text, ".", 1), F.lit(" "), F.lit("T"))
    return F.concat(seconds, F.lit("."), F.rpad(F.substring(fraction, 1, 3), 3, "0"), F.lit("Z"))


def _months(col: Column) -> Column:
    # A YEAR-only interval would cast to years.
    return col.cast(T.YearMonthIntervalType(0, 1)).cast(T.YearMonthIntervalType(1, 1)).cast("int")


def _milliseconds(col: Column) -> Column:
    # A plain cast to long would give whole seconds.
    seconds = col.cast(T.DayTimeIntervalType(3, 3)).cast("decimal(20,6)")
    return (seconds * F.lit(1000)).cast("bigint")


def _binary(col: Column) -> Column:
    body = F.struct(F.base64(col).alias("base64"), F.lit(BINARY_SUBTYPE).alias("subType"))
    return F.when(col.isNotNull(), F.struct(body.alias(BINARY_FIELD)))


def _decimal_text(col: Column) -> Column:
    return col.cast("string")


def _decimal(col: Column, dtype: T.DecimalType, path: str) -> Column:
    text = _decimal_text(col)
    if dtype.scale > 6:
        text = _scientific_when_tiny(text, dtype.scale)
    if dtype.precision > MAX_DECIMAL_DIGITS:
        # Digits past the 34th are only allowed to be zeros.
        digits = F.rtrim(F.ltrim(F.regexp_replace(_decimal_text(col), "[-.]", ""), F.lit("0")), F.lit("0"))
        text = F.when(
            F.length(digits) > MAX_DECIMAL_DIGITS,
            F.raise_error(F.lit(f"cannot encode field {path}. More than 34 significant digits")),
        ).otherwise(text)
    return F.when(col.isNotNull(), F.struct(text.alias(DECIMAL_FIELD)))


def _scientific_when_tiny(text: Column, scale: int) -> Column:
    """Decimals whose leading digit is past the sixth place print with an exponent."""
    digits = F.ltrim(F.regexp_replace(text, "[-.]", ""), F.lit("0"))
    digits = F.when(digits == "", "0").otherwise(digits)
    exponent = F.length(digits) - 1 - scale
    mantissa = F.when(F.length(digits) == 1, digits).otherwise(
        F.concat(F.substring(digits, 1, 1), F.lit("."), F.substring(digits, 2, 38))
    )
    sign = F.when(text.startswith("-"), "-").otherwise("")
    return F.when(exponent < -6, F.concat(sign, mantissa, F.lit("E"), exponent.cast("string"))).otherwise(text)


def _has_double(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_has_double(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _has_double(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _has_double(dtype.valueType)
    return isinstance(dtype, T.DoubleType)


def _json_ready(col: Column, dtype: T.DataType) -> Column:
    """Doubles as variants, so that a wrapper object can stand in for a number."""
    if not _has_double(dtype):
        return col
    if isinstance(dtype, T.StructType):
        fields = [_json_ready(col.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: _json_ready(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(col, lambda _, v: _json_ready(v, dtype.valueType))

    def wrapped(name: str) -> Column:
        return F.parse_json(F.lit(f'{{"{DOUBLE_FIELD}":"{name}"}}'))

    return (
        F.when(F.isnan(col), wrapped("NaN"))
        .when(col == F.lit(float("inf")), wrapped("Infinity"))
        .when(col == F.lit(float("-inf")), wrapped("-Infinity"))
        .otherwise(col.cast(T.VariantType()))
    )
