"""Changelogs to keyed document collections, on PySpark."""

from docsink.functions.encoding import (
    decode_json_documents,
    document_json,
    encode_documents,
    entries_to_map,
    multiset_by,
)
from docsink.functions.serializing import Change, row_encoder, serialize_rows
from docsink.operators.applying import (
    apply_bulks,
    apply_deletes,
    apply_effects,
    apply_inserts,
    apply_last_writes,
    apply_one_bulk,
    apply_replaces,
    apply_upserts,
)
from docsink.operators.bulks import (
    bulk_deletes,
    bulk_dropped,
    bulk_groups,
    bulk_groups_ending,
    bulk_inserts,
    bulk_singles,
    bulk_sizes,
    bulk_updates,
    bulk_upserts,
    net_actions,
)
from docsink.operators.changelog import normalize_changelog
from docsink.operators.effects import fold_bulks, fold_effects
from docsink.operators.outcomes import fold_outcomes, resolve_outcomes
from docsink.operators.rolling import hash_writer, roll_bulks, roll_by_interval
from docsink.options import SinkOptions
from docsink.sources.collection import Collection
from docsink.sources.inbox import register_format
from docsink.streaming.sink import DocumentSink

__all__ = [
    "Change",
    "Collection",
    "DocumentSink",
    "SinkOptions",
    "apply_bulks",
    "apply_deletes",
    "apply_effects",
    "apply_inserts",
    "apply_last_writes",
    "apply_one_bulk",
    "apply_replaces",
    "apply_upserts",
    "bulk_deletes",
    "bulk_dropped",
    "bulk_groups",
    "bulk_groups_ending",
    "bulk_inserts",
    "bulk_singles",
    "bulk_sizes",
    "bulk_updates",
    "bulk_upserts",
    "decode_json_documents",
    "document_json",
    "encode_documents",
    "entries_to_map",
    "fold_bulks",
    "fold_effects",
    "fold_outcomes",
    "hash_writer",
    "multiset_by",
    "net_actions",
    "normalize_changelog",
    "register_format",
    "resolve_outcomes",
    "roll_bulks",
    "roll_by_interval",
    "row_encoder",
    "serialize_rows",
]
