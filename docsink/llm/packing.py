"""Packing into length buckets that waste least (operator 6).

A batch is padded to the longest document its bucket allows. The lengths of all
documents are counted in a histogram; dynamic programming over it chooses the
``buckets`` upper bounds with the least padding in all. Inside a bucket the
documents are numbered and cut into batches of as many as ``token_budget``
padded tokens allow, one at least.

The histogram holds every distinct length, so the bounds have the least padding
there is. It is counted in Spark and comes to the driver, one row per distinct
length. The best start of a bucket never falls as its bound grows, so each bucket
is found by divide and conquer, in about ``n log n`` steps for ``n`` lengths.

Numbering does not send a bucket to one task: documents lie in lanes chosen by
hash, only row counts of lanes are summed up over a bucket, and rows are
numbered inside their lane.

Defined results: a length is the number of words (runs without white space)
plus one for the end, so null and empty texts have length 1. Documents longer
than the budget form batches of their own; none is cut or dropped. Repeated rows
are packed like different ones. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsink.llm.common import text_of, written

BUCKETS = 12
TOKEN_BUDGET = 65_536
LANE_ROWS = 50_000
_FAR = np.int64(1 << 62)  # no padding is as much


def word_length(text: str = "text") -> Column:
    return (F.regexp_count(text_of(text), F.lit(r"\S+")) + 1).cast("long")


def best_bounds(longest: np.ndarray, count: np.ndarray, total: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding.

    ``longest`` (ascending), ``count`` and ``total`` are the greatest length, the
    number and the summed lengths of the bins.
    """
    bins = len(longest)
    if not bins:
        return []
    rows = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
    sums = np.concatenate([[0], np.cumsum(total, dtype=np.int64)])
    # least[j]: padding of the first j bins with the buckets used so far.
    least = np.full(bins + 1, _FAR)
    least[0] = 0
    choices = []
    for _ in range(min(buckets, bins)):
        new, choice = least.copy(), np.full(bins + 1, -1)
        # Ranges of bounds, and of the starts their buckets may have.
        todo = [(1, bins, 0, bins - 1)]
        while todo:
            first, last, low, high = todo.pop()
            if first > last:
                continue
            j = (first + last) // 2
            starts = slice(low, min(high, j - 1) + 1)
            padding = least[starts] + longest[j - 1] * (rows[j] - rows[starts]) - (sums[j] - sums[starts])
            i = low + int(padding.argmin())
            if padding[i - low] < new[j]:
                new[j], choice[j] = padding[i - low], i
            todo += [(first, j - 1, low, i), (j + 1, last, i, high)]
        least = new
        choices.append(choice)
    bounds, j = [], bins
    for choice in reversed(choices):
        if j and choice[j] >= 0:
            bounds.append(int(longest[j - 1]))
            j = int(choice[j])
    return bounds[::-1]


def length_bounds(lengths: DataFrame, buckets: int) -> list[int]:
    """Best bounds among bins of eight significant bits; ``pack`` uses ``exact_bounds``."""
    shift = F.greatest(F.length(F.bin("length")) - 8, F.lit(0))
    bins = (
        lengths.select("length", shift.cast("int").alias("shift"))
        .groupBy("shift", F.expr("shiftright(length, shift)").alias("top"))
        .agg(F.max("length").alias("longest"), F.count("*").alias("count"), F.sum("length").alias("total"))
        .orderBy("longest")
        .collect()
    )
    columns = [np.array([row[c] for row in bins], np.int64) for c in ("longest", "count", "total")]
    return best_bounds(*columns, buckets)


def exact_bounds(lengths: DataFrame, buckets: int) -> list[int]:
    """Bounds with the least padding for all rows of ``length``."""
    counts = lengths.groupBy("length").agg(F.count("*").alias("count"), F.sum("length").alias("total"))
    bins = counts.select(F.col("length").alias("longest"), "count", "total").orderBy("longest").collect()
    columns = [np.array([row[c] for row in bins], np.int64) for c in ("longest", "count", "total")]
    return best_bounds(*columns, buckets)


def pack(
    docs: DataFrame,
    *,
    length: Column | None = None,
    buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET,
) -> DataFrame:
    """One row per document: ``doc_id, length, bucket, bucket_length, batch, slot``."""
    length = word_length() if length is None else length
    rows = written(docs.select("doc_id", length.alias("length"), F.xxhash64("doc_id", text_of()).alias("_key")), "lengths")
    bounds = exact_bounds(rows, buckets) or [1]
    lanes = max(1, -(-rows.count() // LANE_ROWS))
    above = [(F.col("length") > bound).cast("int") for bound in bounds[:-1]]
    bucket = sum(above, F.lit(0))
    placed = rows.withColumn("bucket", bucket).withColumn("_lane", F.pmod("_key", F.lit(lanes)))
    sizes = placed.groupBy("bucket", "_lane").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("bucket").orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("bucket", "_lane", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("bucket", "_lane").orderBy("_key", "doc_id", "length")
    place = F.col("_start") + F.row_number().over(within) - 1
    bound = F.element_at(F.array(*[F.lit(b) for b in bounds]), F.col("bucket") + 1).cast("long")
    fits = F.greatest(F.call_function("div", F.lit(token_budget), F.col("bucket_length")), F.lit(1))
    return (
        placed.join(starts, ["bucket", "_lane"])
        .withColumn("_place", place)
        .withColumn("bucket_length", bound)
        .select(
            "doc_id",
            "length",
            "bucket",
            "bucket_length",
            F.call_function("div", F.col("_place"), fits).alias("batch"),
            F.pmod("_place", fits).alias("slot"),
        )
    )
