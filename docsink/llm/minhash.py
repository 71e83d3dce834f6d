"""Near-duplicate detection with DartMinHash signatures (operator 7).

A document is the multiset of its five-word shingles (words are split at white
space), so a shingle's weight is its number of occurrences and similarity is
the weighted Jaccard similarity. Weights are whole numbers: the region of an
element with weight ``w`` is ``w`` unit cells, one per occurrence. Darts fall
on every cell as a Poisson process over ranks whose randomness is hashed from
the cell, so equal cells get equal darts in every document. Ranks are cut into
doubling intervals and a document looks only as far as about ``k ln k + 2k``
darts lie, whatever its length; each dart names one of ``k`` coordinates, and
the earliest dart per coordinate is the signature.

Signatures are banded. Every document of a bucket is compared with the bucket's
smallest document. Buckets whose documents end up in more than one class are cut
into blocks of bounded size; documents of a block are compared inside a task,
then, where blocks still differ in class, blocks with one another. Documents of
one class need no further link, so a task returns no more links than it has
classes, and a bucket of one class costs one comparison per document. No link
that shares a bucket is lost. Links are verified on all shingles, by 32-bit
hashes of them: two shingles of a pair count as equal by mistake once in some
four billion comparisons. Copies of a text are compared once.

Defined results: a null text counts as empty; equal texts always share a class,
other texts without words are alone. A text of fewer than five words is one
shingle. Rows without ``doc_id`` are told apart by their text. Rows that repeat
a ``doc_id`` are versions of one document and share a class. A class is named by
its smallest ``doc_id``, and that document stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsink.llm.common import join_groups, mix64, text_of, written
from docsink.llm.components import connected_components

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 25
ROWS = 5
FIRST = -7  # ranks below 2**FIRST are the first interval
CHUNK_DOCS = 512
CHUNK_SHINGLES = 400_000
BLOCK_CELLS = 400_000  # of a block of a bucket; a longer document is a block of its own
DOC_WEIGHT = 800  # cells a document counts for besides its own, so that blocks of short ones stay small
LANE_ROWS = 50_000
CLASS_LANES = 16
COLUMNS = 4096  # of the tables compared at once
MAX_WORDS = 500_000  # remembered word hashes of a Python worker

_GOLDEN = 0x9E3779B97F4A7C15


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) >= MAX_WORDS:
            self.clear()
        self[word] = value
        return value


_HASHES = _WordHashes()


def shingle_elements(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Unit cells of all texts as 64-bit numbers, and how many each text has."""
    lengths, words = [], []
    for text in texts:
        found = text.split()
        lengths.append(len(found))
        words.extend(found)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    lengths = np.array(lengths)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    counts = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
    doc = np.repeat(np.arange(len(texts)), counts)
    first = np.concatenate([[0], np.cumsum(counts)])
    at = starts[doc] + np.arange(len(doc)) - first[doc]
    cells = np.zeros(len(doc), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            inside = at + j < starts[doc + 1]
            step = mix64(np.array([j + 1], np.uint64))[0] | np.uint64(1)
            cells[inside] += (hashes[at[inside] + j] + np.uint64(1)) * step
        cells = mix64(cells)
        # The second, third ... occurrence of a shingle in a text is another cell.
        order = np.lexsort((cells, doc))
        sorted_cells, sorted_doc = cells[order], doc[order]
        new = np.ones(len(order), bool)
        new[1:] = (sorted_cells[1:] != sorted_cells[:-1]) | (sorted_doc[1:] != sorted_doc[:-1])
        place = np.arange(len(order))
        occurrence = place - np.maximum.accumulate(np.where(new, place, 0))
        again = occurrence > 0
        sorted_cells[again] = mix64(sorted_cells[again] + occurrence[again].astype(np.uint64) * np.uint64(_GOLDEN))
    return sorted_cells, counts


def _interval(m: int) -> tuple[float, float]:
    return (0.0 if m == 0 else 2.0 ** (FIRST + m - 1)), 2.0 ** (FIRST + m)


def _poisson_table(mean: float) -> np.ndarray:
    """Distribution function of a Poisson variable, up to where it is 1."""
    k = np.arange(int(mean + 12 * mean**0.5 + 24))
    logs = k * np.log(mean) - mean - np.concatenate([[0.0], np.cumsum(np.log(np.maximum(k[1:], 1)))])
    return np.minimum(np.cumsum(np.exp(logs)), 1.0)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def dart_signatures(cells: np.ndarray, counts: np.ndarray, k: int = BANDS * ROWS) -> np.ndarray:
    """Earliest rank per coordinate, as order-preserving integers; one row per document with cells."""
    n = len(counts)
    needed = (k * np.log(k) + 2 * k) / np.maximum(counts, 1)
    last = np.maximum(np.ceil(np.log2(needed)) - FIRST, 0).astype(int)
    doc = np.repeat(np.arange(n), counts)
    none = np.uint64(2**44 - 1)
    best = np.full((n, k), none, np.uint64)
    done, m = counts == 0, 0
    while not done.all():
        active = (~done)[doc]
        which, of = cells[active], doc[active]
        low, high = _interval(m)
        with np.errstate(over="ignore"):
            seed = mix64(which + np.uint64((m + 1) * _GOLDEN & (2**64 - 1)))
            darts = np.searchsorted(_poisson_table(high - low), _unit(seed), side="right")
            hit = np.flatnonzero(darts)
            times = darts[hit]
            owner = np.repeat(of[hit], times)
            number = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            name = mix64(np.repeat(seed[hit], times) + (number + 1).astype(np.uint64) * np.uint64(_GOLDEN))
            rank = low + (high - low) * _unit(name)
            coordinate = mix64(name + np.uint64(1)) % np.uint64(k)
        # Positive floats are ordered like their bits: one sort finds the earliest darts.
        place = owner.astype(np.uint64) * np.uint64(k) + coordinate
        packed = np.sort((place << np.uint64(44)) | (rank.view(np.uint64) >> np.uint64(20)))
        place = packed >> np.uint64(44)
        first = np.ones(len(packed), bool)
        first[1:] = place[1:] != place[:-1]
        at = place[first].astype(np.int64)
        flat = best.ravel()
        flat[at] = np.minimum(flat[at], packed[first] & none)
        done |= (m >= last) & (best != none).all(axis=1)
        m += 1
    return best


def _bands(signatures: np.ndarray) -> np.ndarray:
    n = len(signatures)
    keys = np.zeros((n, BANDS), np.uint64)
    parts = signatures.reshape(n, BANDS, ROWS)
    with np.errstate(over="ignore"):
        keys += np.arange(1, BANDS + 1, dtype=np.uint64)
        for i in range(ROWS):
            keys = mix64(keys * np.uint64(_GOLDEN) + parts[:, :, i])
    return keys.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, len(batch), CHUNK_DOCS):
            piece = batch.slice(start, CHUNK_DOCS)
            texts = piece.column(2).to_pylist()
            begin = 0
            while begin < len(texts):
                # As many texts as stay within a bounded number of characters, one at least.
                end, size = begin, 0
                while end < len(texts) and (end == begin or size + len(texts[end]) <= 6 * CHUNK_SHINGLES):
                    size += len(texts[end])
                    end += 1
                cells, counts = shingle_elements(texts[begin:end])
                bands = _bands(dart_signatures(cells, counts))
                full = counts > 0
                offsets = np.concatenate([[0], np.cumsum(np.where(full, BANDS, 0))]).astype(np.int32)
                stops = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                small = (cells >> np.uint64(32)).astype(np.uint32).view(np.int32)
                yield pa.record_batch(
                    {
                        "id": piece.column(0).slice(begin, end - begin),
                        "copy": piece.column(1).slice(begin, end - begin),
                        "n": pa.array(counts, pa.int64()),
                        "bands": pa.ListArray.from_arrays(offsets, pa.array(bands[full].ravel())),
                        "cells": pa.ListArray.from_arrays(stops, pa.array(small)),
                    }
                )
                begin = end


def _id(docs: DataFrame, text: Column) -> Column:
    """``doc_id``, or a number made from the text for a row that has none."""
    made = F.xxhash64(text).bitwiseAND(F.lit((1 << 61) - 1)).bitwiseOR(F.lit(1 << 62))
    return F.coalesce(docs["doc_id"].cast("long"), made)


def _verified(pairs: DataFrame, cells: DataFrame) -> DataFrame:
    """Pairs ``(lo, hi)`` whose weighted Jaccard similarity reaches the bound."""
    one = cells.select(F.col("id").alias("lo"), F.col("cells").alias("x"))
    two = cells.select(F.col("id").alias("hi"), F.col("cells").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    found = pairs.join(one, "lo").join(two, "hi")
    return found.where(both >= SIMILARITY * (F.size("x") + F.size("y") - both)).select("lo", "hi")


def _similar_sizes() -> Column:
    """Sets of such sizes can reach the similarity at all."""
    return F.least("n", "m") >= SIMILARITY * F.greatest("n", "m")


def _shared(rows: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Numbers of common cells of every row and every other."""
    common, place = np.unique(np.concatenate(rows + others), return_inverse=True)
    owner = np.repeat(np.arange(len(rows) + len(others)), [len(r) for r in rows + others])
    frequent = np.bincount(place, minlength=len(common)) > 1
    number = np.cumsum(frequent) - 1
    keep = frequent[place]
    place, owner = number[place[keep]], owner[keep]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    shared = np.zeros((len(rows), len(others)), np.float32)
    for first in range(0, int(frequent.sum()), COLUMNS):
        a, b = np.searchsorted(place, [first, first + COLUMNS])
        table = np.zeros((len(rows) + len(others), COLUMNS), np.float32)
        table[owner[a:b], place[a:b] - first] = 1
        shared += table[: len(rows)] @ table[len(rows) :].T
    return shared


def _spanning(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which of the links between classes join what earlier links do not join already."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above.setdefault(x, x) != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    kept = []
    for i, (x, y) in enumerate(zip(one.tolist(), two.tolist(), strict=True)):
        x, y = top(x), top(y)
        if x != y:
            above[max(x, y)] = min(x, y)
            kept.append(i)
    return np.array(kept, np.int64)


def _compare_blocks(group: pd.DataFrame) -> pd.DataFrame:
    """Links that join the classes of documents of two blocks, or of one; fewer than there are classes."""
    one = group[group["side"] == 0]
    two = group[group["side"] == 1]
    two = two if len(two) else one
    rows, columns = one["cells"].tolist(), two["cells"].tolist()
    shared = _shared(rows, columns)
    sizes = np.array([len(r) for r in rows])[:, None] + np.array([len(r) for r in columns])[None, :]
    linked = shared >= SIMILARITY * (sizes - shared) * (1 - 1e-9)
    root, other = one["root"].to_numpy(), two["root"].to_numpy()
    linked &= root[:, None] != other[None, :]
    i, j = np.nonzero(linked)
    pairs = np.unique(np.stack([np.minimum(root[i], other[j]), np.maximum(root[i], other[j])], axis=1), axis=0)
    kept = _spanning(pairs[:, 0], pairs[:, 1])
    return pd.DataFrame({"lo": pairs[kept, 0], "hi": pairs[kept, 1]})


def _blocks(placed: DataFrame) -> DataFrame:
    """``placed`` with the number of a block of bounded size inside each band, classes side by side.

    Rows lie in lanes by hashes of their class and of themselves; only sums of
    lanes are added up over a band, and rows are summed inside their lane.
    """
    lanes = max(1, -(-placed.count() // LANE_ROWS))
    lane = F.pmod(F.xxhash64("root"), F.lit(CLASS_LANES)) * lanes + F.pmod(F.xxhash64("id"), F.lit(lanes))
    rows = placed.withColumns({"_lane": lane, "_weight": F.col("n") + DOC_WEIGHT})
    sums = rows.groupBy("band", "_lane").agg(F.sum("_weight").alias("_sum"))
    earlier = Window.partitionBy("band").orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("band", "_lane", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    within = Window.partitionBy("band", "_lane").orderBy("root", "id")
    upto = F.col("_start") + F.sum("_weight").over(within)
    block = F.call_function("div", upto, F.lit(BLOCK_CELLS)).alias("block")
    return rows.join(starts, ["band", "_lane"]).select("band", "id", "n", "root", block)


def _met(placed: DataFrame, meetings: DataFrame, cells: DataFrame) -> DataFrame:
    """Links between classes found where blocks ``i`` and ``j`` of a band meet."""
    left = placed.join(meetings.withColumn("block", F.col("i")), ["band", "block"]).withColumn("side", F.lit(0))
    right = meetings.where("i < j").withColumn("block", F.col("j"))
    right = placed.join(right, ["band", "block"]).withColumn("side", F.lit(1))
    rows = left.unionByName(right).select("band", "i", "j", "side", "id", "root").join(cells, "id")
    return rows.groupBy("band", "i", "j").applyInPandas(_compare_blocks, "lo long, hi long").distinct()


def _with_roots(placed: DataFrame, links: DataFrame) -> DataFrame:
    """``placed`` after its classes were joined by ``links``."""
    joined = connected_components(links).select(F.col("node").alias("root"), F.col("root").alias("_root"))
    return placed.join(joined, "root", "left").withColumn("root", F.coalesce("_root", "root")).drop("_root")


def _links_across(placed: DataFrame, cells: DataFrame) -> DataFrame:
    """Links between classes that share a bucket: ``placed`` is ``band, id, n, root``."""
    placed = written(_blocks(placed), "blocks")
    blocks = placed.groupBy("band", "block").agg(F.min("root").alias("a"), F.max("root").alias("b"))
    alone = blocks.where("a < b").select("band", F.col("block").alias("i"), F.col("block").alias("j"))
    inside = written(_met(placed, alone, cells), "inside")

    placed = written(_with_roots(placed, inside), "blocks")
    blocks = placed.groupBy("band", "block").agg(F.min("root").alias("first"), F.max("root").alias("last"))
    other = blocks.select("band", F.col("block").alias("j"), F.col("first").alias("first2"), F.col("last").alias("last2"))
    same = (F.col("first") == F.col("last")) & (F.col("first") == F.col("first2")) & (F.col("last") == F.col("last2"))
    meetings = blocks.withColumnRenamed("block", "i").join(other, "band").where((F.col("i") < F.col("j")) & ~same)
    between = written(_met(placed, meetings.select("band", "i", "j"), cells), "between")
    return inside.unionAll(between)


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """``(id, class_id, class_size)`` for every row; ``id`` is ``doc_id`` where there is one."""
    rows = docs.select(_id(docs, text_of()).alias("id"), F.md5(text_of()).alias("copy"), text_of().alias("text"))
    signed = written(
        rows.mapInArrow(_sign, "id long, copy string, n long, bands array<long>, cells array<int>"), "darts"
    )
    total = signed.count()
    copies = signed.groupBy("copy").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
    nodes = signed.join(copies.select(F.col("node").alias("id")), "id", "left_semi")
    bands = nodes.select("id", "n", F.explode("bands").alias("band"))
    first = bands.groupBy("band").agg(F.min(F.struct("id", "n")).alias("first"), F.count("*").alias("docs"))
    shared = first.where("docs > 1").select("band", F.col("first.id").alias("leader"), F.col("first.n").alias("m"))
    buckets = written(bands.join(shared, "band"), "buckets")

    to_leader = buckets.where((F.col("id") != F.col("leader")) & _similar_sizes())
    to_leader = to_leader.select(F.col("leader").alias("lo"), F.col("id").alias("hi")).distinct()
    cells = nodes.select("id", "cells")
    links = written(_verified(to_leader, cells), "links")
    roots = connected_components(links)

    # Buckets that still hold more than one class.
    placed = buckets.join(roots.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.select("band", "id", "n", F.coalesce("root", "id").alias("root"))
    mixed = placed.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("band")
    placed = placed.join(mixed, "band", "left_semi")
    links = links.unionAll(_links_across(placed, cells))
    # Copies of one text are linked to their first document; repeated ids are one node anyway.
    roots = connected_components(links)

    members = join_groups(signed.select("id", "copy"), copies, ["copy"], "copies", total)
    named = members.select("id", "node").join(roots, "node", "left").select("id", F.coalesce("root", "node").alias("class_id"))
    sizes = named.groupBy("class_id").agg(F.count("*").alias("class_size"))
    return join_groups(named, sizes, ["class_id"], "class_size", total).select("id", "class_id", "class_size")


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, class_id, class_size, kept``."""
    found = near_duplicate_classes(docs)
    made = F.col("id") >= F.lit(1 << 62)
    return found.select(
        F.when(~made, F.col("id")).alias("doc_id"),
        "class_id",
        "class_size",
        (F.col("id") == F.col("class_id")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each class stays, with the columns of ``docs``."""
    gone = near_duplicate_classes(docs).where("id <> class_id").select(F.col("id").alias("_id")).distinct()
    rows = docs.select(F.struct("*").alias("_row"), _id(docs, text_of()).alias("_id"))
    return rows.join(gone, "_id", "left_anti").select("_row.*")
