"""Periodic runs of words by internal pattern matching (operator 11).

A run is a stretch of words with smallest period ``q`` that is at least
``max(MIN_WORDS, EXPONENT * q)`` words long and cannot be extended without
losing the period. Sorting by prefix doubling gives the suffix array of many
texts at once (words of different texts are different symbols) and, on the way,
a name for every stretch of ``2**k`` words.

Candidates come from dyadic blocks, the ``2**k`` words from a multiple of
``2**k`` on. A run with ``2**k <= q < 2**(k+1)`` holds such a block at ``a``
whose copy at ``a + q`` lies in the run too, so the block's occurrences that
start in ``[a + 2**k, a + 2**(k+1))`` are looked up: they are the numbers of the
block's interval of the suffix array in that range, found one after another by
range successor in a wavelet tree. As the window is shorter than two blocks, its
occurrences form one progression:

* one or two occurrences are the candidates themselves;
* three or more, ``p`` apart, mean that the block has period ``p``. The stretch
  of period ``p`` around the block ends inside the run on one side at least
  (else the run had a smaller period), and its copy ends ``q`` later. So only
  the distances between the two stretches' starts and between their ends remain.

Periods below eight take one look-up: a block of eight words lies in every run
together with its copy, which is its next occurrence. Every candidate is
extended both ways as far as the period holds, using the names of the stretches
of ``2**k`` words. Of candidates that cover the same words the smallest period
is the run's.

Memory of a task is ``n log n`` words of a piece of about ``PIECE_BYTES`` bytes
of text; a longer text is a piece of its own.

Defined results: a null or empty text has no words and no runs; rows that repeat
``doc_id`` or lack it are looked at one by one; an empty table gives an empty
result; further columns are not read. Of equally strong runs the one that starts
first counts, then the one with the smaller period.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsink.llm.common import mix64, text_of
from docsink.llm.words import pieces, split_words

MIN_WORDS = 24
EXPONENT = 3
FIRST_LEVEL = 3  # blocks of eight words; EXPONENT * 8 <= MIN_WORDS
PIECE_BYTES = 2 << 20

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class _Suffixes:
    """Suffix array, names of all stretches of ``2**k`` symbols, and blocks that occur again."""

    def __init__(self, symbols: np.ndarray) -> None:
        n = len(symbols)
        self.n = n
        order = np.argsort(symbols, kind="stable")
        self.array = order
        rank = np.empty(n, np.int64)
        slots = np.arange(n)
        members, keys = order, symbols[order]
        self.names: list[np.ndarray] = []
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.slots = np.zeros(0, np.int64)
        level = 0
        while True:
            new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
            begin = np.flatnonzero(new)
            size = np.diff(np.append(begin, len(keys)))
            group = np.cumsum(new) - 1
            lo = slots[begin][group] if len(keys) else slots
            rank[members] = lo
            self.names.append(rank.astype(np.int32) if n < 2**31 else rank.copy())
            again = size[group] > 1 if len(keys) else np.zeros(0, bool)
            slots, members = slots[again], members[again]
            if level == FIRST_LEVEL:
                self.slots = slots
            if not len(slots):
                break
            if level >= FIRST_LEVEL:
                aligned = members % (1 << level) == 0
                lo = lo[again][aligned]
                self.blocks[level] = (members[aligned], lo, lo + size[group][again][aligned])
            # Sort what is not told apart yet by the names of the next stretch.
            following = members + (1 << level)
            second = np.where(following < n, rank[np.minimum(following, n - 1)], -1)
            keys = rank[members] * (n + 1) + second + 1
            sort = np.argsort(keys, kind="stable")
            members, keys = members[sort], keys[sort]
            self.array[slots] = members
            level += 1

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from ``i`` and ``j`` (greater) on are equal."""
        i, j = i.copy(), j.copy()
        begin = i.copy()
        for k in range(len(self.names) - 1, -1, -1):
            name, width = self.names[k], 1 << k
            # A last stretch that is cut off has a name of its own.
            equal = (j + width <= self.n) & (name[np.minimum(i, self.n - 1)] == name[np.minimum(j, self.n - 1)])
            i[equal] += width
            j[equal] += width
        return i - begin

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols before ``i`` and ``j`` (greater) are equal."""
        i, j = i.copy(), j.copy()
        begin = i.copy()
        for k in range(len(self.names) - 1, -1, -1):
            name, width = self.names[k], 1 << k
            equal = (i >= width) & (name[np.maximum(i - width, 0)] == name[np.maximum(j - width, 0)])
            i[equal] -= width
            j[equal] -= width
        return begin - i


class _WaveletTree:
    """Numbers, answering which is the smallest one from a bound on in a range of places."""

    def __init__(self, numbers: np.ndarray) -> None:
        self.bits = int(numbers.max()).bit_length() if len(numbers) else 0
        self.levels = []
        for bit in range(self.bits - 1, -1, -1):
            one = (numbers >> bit) & 1 == 1
            zeros = np.concatenate([[0], np.cumsum(~one)])
            self.levels.append((bit, zeros))
            numbers = np.concatenate([numbers[~one], numbers[one]])

    def _below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many numbers at places ``lo <= i < hi`` are smaller than ``bound``."""
        too_large = bound >= 1 << self.bits
        count = np.where(too_large, hi - lo, 0)
        for bit, zeros in self.levels:
            a, b = zeros[lo], zeros[hi]
            one = (bound >> bit) & 1 == 1
            count += np.where(one & ~too_large, b - a, 0)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        return count

    def successor(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The smallest number from ``bound`` on at places ``lo <= i < hi``, or -1."""
        place = self._below(lo, hi, bound)
        found = place < hi - lo
        lo, hi, place = lo[found], hi[found], place[found]
        value = np.zeros(len(place), np.int64)
        for bit, zeros in self.levels:
            a, b = zeros[lo], zeros[hi]
            one = place >= b - a
            value |= one.astype(np.int64) << bit
            place = np.where(one, place - (b - a), place)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        result = np.full(len(found), -1, np.int64)
        result[found] = value
        return result


def _candidates(text: _Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances: what starts there may be periodic with that distance."""
    tree = _WaveletTree(text.array[text.slots])
    positions, distances = [], []

    def add(at: np.ndarray, distance: np.ndarray, low: int, high: int) -> None:
        keep = (distance >= low) & (distance <= high) & (at + distance < text.n)
        positions.append(at[keep])
        distances.append(distance[keep])

    for level, (at, lo, hi) in text.blocks.items():
        width = 1 << level
        lo, hi = np.searchsorted(text.slots, lo), np.searchsorted(text.slots, hi)
        if level == FIRST_LEVEL:
            following = tree.successor(lo, hi, at + 1)
            add(at, following - at, 1, width)

        def occurrence(of: np.ndarray, after: np.ndarray, width: int = width, at=at, lo=lo, hi=hi) -> np.ndarray:
            found = tree.successor(lo[of], hi[of], after)
            return np.where(found < at[of] + 2 * width, found, -1)

        every = np.arange(len(at))
        one = occurrence(every, at + width)
        every, one = every[one >= 0], one[one >= 0]
        two = occurrence(every, one + 1)
        three = np.full(len(every), -1)
        three[two >= 0] = occurrence(every[two >= 0], two[two >= 0] + 1)
        few = three < 0
        add(at[every[few]], (one - at[every])[few], width, 2 * width - 1)
        few &= two >= 0
        add(at[every[few]], (two - at[every])[few], width, 2 * width - 1)

        a, one, period = at[every[three >= 0]], one[three >= 0], (two - one)[three >= 0]
        starts = (one - text.backward(one, one + period)) - (a - text.backward(a, a + period))
        ends = (one + text.forward(one, one + period)) - (a + text.forward(a, a + period))
        add(a, starts, width, 2 * width - 1)
        add(a, ends, width, 2 * width - 1)
    if not positions:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(positions), np.concatenate(distances)


def find_runs(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, end, period`` of all runs, by start and period."""
    text = _Suffixes(symbols)
    at, period = _candidates(text)
    start = at - text.backward(at, at + period)
    end = at + period + text.forward(at, at + period)
    keep = end - start >= np.maximum(MIN_WORDS, EXPONENT * period)
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[first], end[first], period[first]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _strongest(runs: list[dict]) -> dict | None:
    if not runs:
        return None
    return min(runs, key=lambda r: (-Fraction(r["length"], r["period"]), r["start"], r["period"]))


def _look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece, texts in pieces(batch, 1, PIECE_BYTES):
            words = split_words(texts)
            # A word of another text is another symbol.
            with np.errstate(over="ignore"):
                symbols = mix64(words.numbers() + words.doc.astype(np.uint64) * _GOLDEN)
            start, end, period = find_runs(symbols)
            # The first period of a run stays.
            change = np.zeros(len(symbols) + 1, np.int64)
            np.add.at(change, start + period, 1)
            np.add.at(change, end, -1)
            kept = np.cumsum(change[:-1]) == 0
            first = words.first
            runs: list[list[dict]] = [[] for _ in texts]
            for d, s, e, q in zip(words.doc[start].tolist(), start.tolist(), end.tolist(), period.tolist(), strict=True):
                runs[d].append({"start": s - int(first[d]), "length": e - s, "period": q})
            yield pa.record_batch(
                {
                    "doc_id": piece.column(0),
                    "n_words": pa.array(np.diff(first), pa.int64()),
                    "runs": pa.array(runs, pa.list_(_RUN)),
                    "strongest": pa.array([_strongest(r) for r in runs], _RUN),
                    "collapsed": pa.array(words.joined(kept), pa.large_binary()).cast(pa.binary()),
                }
            )


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, runs, strongest, collapsed``.

    ``runs`` are in order of start and period, counted in words from 0;
    ``collapsed`` is the text without words that a run repeats.
    """
    run = "struct<start: long, length: long, period: long>"
    rows = docs.select("doc_id", text_of(text).cast("binary").alias("_text"))
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(
        _look, f"doc_id {doc_id}, n_words long, runs array<{run}>, strongest {run}, collapsed binary"
    )
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def planted(docs: DataFrame) -> Column:
    """The text of ``documents`` with a periodic end where ``crc32(doc_id)`` ends in 0.

    From word ``a`` on, the text repeats the ``p`` words from there. Rows
    without ``doc_id`` stay as they are.
    """
    words = F.expr(r"filter(split(coalesce(text, ''), '[ \\x09-\\x0D]+'), w -> w <> '')")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.call_function("div", h, F.lit(10)).cast("long")
    made = F.transform(
        F.array(F.struct(words.alias("w"), g.alias("g"))),
        lambda x: F.struct(
            x["w"].alias("w"),
            F.size(x["w"]).cast("long").alias("n"),
            F.pmod(x["g"], F.greatest(F.size(x["w"]), F.lit(1))).alias("a"),
            F.pmod(x["g"], F.lit(8)).alias("r"),
        ),
    )
    made = F.transform(
        made,
        lambda x: F.struct(
            x["w"].alias("w"),
            x["a"].cast("int").alias("a"),
            (F.lit(1) + F.call_function("div", x["n"] - x["a"], x["r"] + 3)).cast("int").alias("p"),
        ),
    )
    rewritten = F.transform(
        made,
        lambda x: F.array_join(
            F.transform(
                x["w"], lambda w, i: F.when(i < x["a"], w).otherwise(F.get(x["w"], x["a"] + (i - x["a"]) % x["p"]))
            ),
            " ",
        ),
    )
    return F.when(F.pmod(h, F.lit(10)) == 0, F.get(rewritten, F.lit(0))).otherwise(F.col("text"))


def run_report(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: number of runs, the strongest one, and digests of all runs and of the collapsed text."""
    found = periodic_runs(docs, text)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.call_function("div", best["length"] * 1000, best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
