"""Exact dedup by two-pass Bloom filtering (operator 1).

First pass: only 64-bit hashes move. Each task removes its own repeats and
sends the rest, packed, to the task that owns their filter blocks; a hash that
hits the filter of hashes seen so far, or was repeated within a task, goes into
a second, small filter of possibly repeated hashes. Second pass: each row looks
itself up in the second filter, which is broadcast. Rows it does not contain
are unique for certain and pass straight through; only the others are shuffled
and compared by SHA-256.

The second filter never exceeds ``max_filter_bytes``. Past about two rows per
byte of it, more unique rows look repeated and are shuffled too; the result
stays exact.

Defined results: a null text counts as empty; texts are compared as they are.
Of equal texts the row with the largest ``doc_id`` stays, a null ``doc_id``
counting as the smallest. Of rows that also share ``doc_id``, one stays. An
empty table gives an empty result; further columns are carried as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsink.llm.common import join_groups, mix64, text_of, written

HASHES_PER_BLOCK = 256
AGAIN_BITS = 1024  # of a block of the second filter
PROBES = 4
MAX_FILTER_BYTES = 256 << 20
PART_BYTES = 8 << 20  # of the first filter in one part
FLUSH_ROWS = 1 << 20


def _packed(n_blocks: int, per_part: int):
    """Map task: its distinct hashes, and which of them it saw twice, packed by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy())
            rows += len(held[-1])
            if rows >= FLUSH_ROWS:
                yield flush(held)
                held, rows = [], 0
        if rows:
            yield flush(held)

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        parts = np.mod(values, n_blocks) // per_part
        order = np.argsort(parts, kind="stable")
        values, counts, parts = values[order], counts[order], parts[order]
        which, starts = np.unique(parts, return_index=True)
        ends = [*starts[1:], len(values)]
        return pa.record_batch(
            {
                "part": pa.array(which, pa.int64()),
                "hashes": [values[a:b].tobytes() for a, b in zip(starts, ends, strict=True)],
                "twice": [np.packbits(counts[a:b] > 1).tobytes() for a, b in zip(starts, ends, strict=True)],
            }
        )

    return run


def _probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit numbers inside a block of the first filter, ``PROBES`` per hash."""
    one, two = mix64(hashes.view(np.uint64)), mix64(~hashes.view(np.uint64)) | np.uint64(1)
    with np.errstate(over="ignore"):
        at = [(one + np.uint64(i) * two) & np.uint64(bits - 1) for i in range(PROBES)]
    return np.stack(at).astype(np.int64)


def _repeated(n_blocks: int, per_part: int, bits: int):
    """Owner of the filter blocks: hashes that were seen before, as blocks of the second filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                part = row["part"]
                if part not in filters:
                    filters[part] = (
                        np.zeros(per_part * bits // 8, np.uint8),
                        np.zeros((per_part, AGAIN_BITS // 64), np.uint64),
                    )
                seen, again = filters[part]
                values = np.frombuffer(row["hashes"], np.int64)
                twice = np.unpackbits(np.frombuffer(row["twice"], np.uint8), count=len(values)).astype(bool)
                block = np.mod(values, n_blocks) - part * per_part
                at = block * bits + _probes(values, bits)
                byte, bit = at >> 3, (1 << (at & 7)).astype(np.uint8)
                hit = twice | ((seen[byte] & bit) != 0).all(axis=0)
                np.bitwise_or.at(seen, byte.ravel(), bit.ravel())
                for i in range(PROBES):
                    place = (values[hit].view(np.uint64) >> np.uint64(4 + 10 * i)) & np.uint64(AGAIN_BITS - 1)
                    word = (place >> np.uint64(6)).astype(np.int64)
                    np.bitwise_or.at(again, (block[hit], word), np.uint64(1) << (place & np.uint64(63)))
        for part, (_, again) in filters.items():
            full = np.flatnonzero(again.any(axis=1))
            yield pa.record_batch(
                {
                    "_block": pa.array(part * per_part + full, pa.int64()),
                    "_bits": pa.array(list(again[full].view(np.int64)), pa.list_(pa.int64())),
                }
            )

    return run


def repeated_filter(hashes: DataFrame, n_blocks: int, rows: int) -> DataFrame:
    """First pass over ``_h``: the second filter as ``(_block, _bits)``."""
    bits = 4096
    while bits * n_blocks < 16 * rows:
        bits *= 2
    per_part = max(1, PART_BYTES * 8 // bits)
    parts = -(-n_blocks // per_part)
    packed = hashes.mapInArrow(_packed(n_blocks, per_part), "part long, hashes binary, twice binary")
    owned = packed.repartition(parts, "part")
    return owned.mapInArrow(_repeated(n_blocks, per_part, bits), "_block long, _bits array<long>")


def _marked(rows: DataFrame, total: int, max_filter_bytes: int) -> DataFrame:
    """``rows`` with ``_text`` become rows with ``_sha`` and ``_maybe``: possibly repeated."""
    # An odd number of blocks, so that block and bits inside it are independent.
    n_blocks = max(1, min(-(-total // HASHES_PER_BLOCK), max_filter_bytes * 8 // AGAIN_BITS)) | 1
    hashed = rows.withColumn("_h", F.xxhash64("_text"))
    blocks = repeated_filter(hashed.select("_h"), n_blocks, total)
    looked_up = hashed.withColumn("_block", F.pmod("_h", F.lit(n_blocks))).join(F.broadcast(blocks), "_block", "left")
    maybe = F.col("_bits").isNotNull()
    for i in range(PROBES):
        place = F.shiftrightunsigned("_h", 4 + 10 * i).bitwiseAND(F.lit(AGAIN_BITS - 1)).cast("int")
        word = F.element_at("_bits", (F.shiftright(place, 6) + 1).cast("int"))
        maybe = maybe & (F.getbit(word, place.bitwiseAND(F.lit(63))) == 1)
    return looked_up.withColumn("_maybe", F.coalesce(maybe, F.lit(False))).withColumn("_sha", F.sha2("_text", 256))


def exact_dedup(docs: DataFrame, text: str = "text", *, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    rows = docs.select(F.struct("*").alias("_row"), text_of(text).alias("_text"), F.xxhash64("*").alias("_tie"))
    marked = _marked(rows, docs.count(), max_filter_bytes)
    unique = marked.where(~F.col("_maybe")).select("_row.*")
    # Combined on the map side, so of a large group each task sends one row.
    best = F.max_by("_row", F.struct("_row.doc_id", "_tie")).alias("_row")
    repeated = marked.where("_maybe").groupBy("_sha").agg(best).select("_row.*")
    return unique.unionAll(repeated)


def exact_dedup_report(
    docs: DataFrame, text: str = "text", *, max_filter_bytes: int = MAX_FILTER_BYTES
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    total = docs.count()
    rows = docs.select("doc_id", text_of(text).alias("_text"))
    marked = written(_marked(rows, total, max_filter_bytes).select("doc_id", "_sha", "_maybe"), "exact")
    unique = marked.where(~F.col("_maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "_sha"
    )
    repeated = marked.where("_maybe").groupBy("_sha", "doc_id").agg(F.count("*").alias("_n"))
    groups = repeated.groupBy("_sha").agg(
        F.max("doc_id").alias("keep_id"), F.sum("_n").alias("group_size")
    )
    # Rows that share text and doc_id were counted; they come back as that many rows.
    flagged = (
        join_groups(repeated, groups, ["_sha"], "group_size", total)
        .withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), "_n")))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_i") == 1)).alias("kept"),
            "_sha",
        )
    )
    return unique.unionByName(flagged).withColumnRenamed("_sha", "text_sha256")
