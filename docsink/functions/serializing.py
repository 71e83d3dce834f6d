"""A Python function as serializer, one row at a time.

The function takes a row as a dictionary and returns a ``Change``, or None for a
row that is no change. It runs on Arrow batches, so rows travel in columns both
ways and only the function itself is Python per row. Use it where built-in
functions cannot do the work; ``encode_documents`` needs no Python at all.

Rows that the function raises on, or whose document does not fit the declared
type, do not have to fail the job: they come back with an ``error`` and the row
itself as JSON.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


@dataclass(frozen=True)
class Change:
    """What a serializer makes of a row: the document, and its key as text."""

    key: str
    document: dict
    op: str = "+I"


Serializer = Callable[[dict], Change | None]


def serialize_rows(rows: DataFrame, serializer: Serializer, document: T.StructType | str, *, carry: str = "seq") -> DataFrame:
    """Rows to ``(_key, op, <carry>, doc, error, row)``; either ``doc`` or ``error`` and ``row`` are given.

    ``document`` is the type of the documents; ``carry`` is the column with the
    place in the order, which is passed on unchanged.
    """
    doc_type = T.StructType.fromDDL(document) if isinstance(document, str) else document
    carried = rows.schema[carry].dataType
    arrow_type = to_arrow_type(doc_type)

    def fits(doc: dict) -> pa.Array:
        unknown = sorted(set(doc) - set(doc_type.names))
        if unknown:
            raise ValueError(f"attributes without a type: {', '.join(unknown)}")
        return pa.array([doc], arrow_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ops, places, docs, errors, failed = [], [], [], [], [], []
            for row in batch.to_pylist():
                place = row[carry]
                try:
                    change = serializer(dict(row))
                    if change is None:
                        continue
                    fits(change.document)
                    found = (change.key, change.op, change.document, None, None)
                except Exception as error:  # noqa: BLE001  whatever the function raises is reported with its row
                    found = (None, None, None, f"{type(error).__name__}: {error}", json.dumps(row, default=str))
                for column, value in zip((keys, ops, docs, errors, failed), found, strict=True):
                    column.append(value)
                places.append(place)
            yield pa.record_batch(
                {
                    "_key": pa.array(keys, pa.string()),
                    "op": pa.array(ops, pa.string()),
                    carry: pa.array(places, to_arrow_type(carried)),
                    "doc": pa.array(docs, arrow_type),
                    "error": pa.array(errors, pa.string()),
                    "row": pa.array(failed, pa.string()),
                }
            )

    schema = T.StructType(
        [
            T.StructField("_key", T.StringType()),
            T.StructField("op", T.StringType()),
            T.StructField(carry, carried),
            T.StructField("doc", doc_type),
            T.StructField("error", T.StringType()),
            T.StructField("row", T.StringType()),
        ]
    )
    return rows.mapInArrow(run, schema)


def row_encoder(serializer: Serializer, document: T.StructType | str) -> Callable[[DataFrame], DataFrame]:
    """An encoder for ``DocumentSink`` that fails the job on the first row the serializer cannot take."""

    def encode(rows: DataFrame) -> DataFrame:
        found = serialize_rows(rows, serializer, document)
        message = F.concat(F.lit("row cannot be serialized: "), F.col("error"), F.lit(" in "), F.col("row"))
        # The kind is looked at first.
        kind = F.when(F.col("error").isNull(), F.col("op")).otherwise(F.raise_error(message))
        return found.select("_key", kind.alias("op"), "seq", "doc")

    return encode
