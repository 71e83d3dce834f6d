"""Cutting a changelog into bulks by size, by time, or both.

A writer is an independent lane of changes; all changes of a key belong to one
writer, so bulks of different writers never need an order between them.

Numbering rows per writer with one window would send a busy writer to a single
task. Instead a writer's rows are split into chunks of the sequence; only the
row *counts* of the chunks are summed up per writer, and rows are numbered
inside their chunk. As ``seq`` is unique per writer, a chunk of given width never holds
more rows than it is wide; chunks between sampled cut points hold about the same
number of rows each, whatever the numbers are.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsink.functions.names import quote
from docsink.operators.changelog import INTEGRAL, require

SEQ_CHUNK = 1 << 20  # width for dense numbers
CUT_POINTS = 4096  # between chunks, where no width is given
_ACCURACY = 10 * CUT_POINTS

# Rows of open bulks are numbered from here on, before all others.
OPEN_SEQ = -(1 << 62)


def hash_writer(writers: int, key: str = "_key") -> Column:
    """Writer lane by key hash."""
    if writers < 1:
        raise ValueError("writers must be at least 1")
    return F.pmod(F.xxhash64(F.col(key)), F.lit(writers)).cast("int")


def roll_by_interval(changes: DataFrame, interval_ms: int, ts: str = "ts") -> DataFrame:
    """Add ``bulk_id`` from the arrival time alone; a projection, no shuffle."""
    return require(changes, ts).withColumn("bulk_id", _tick(changes, interval_ms, ts))


def roll_bulks(
    changes: DataFrame,
    flush_size: int,
    *,
    seq: str = "seq",
    writer: str = "writer",
    interval_ms: int | None = None,
    ts: str = "ts",
    seq_chunk: int | None = None,
) -> DataFrame:
    """Add ``bulk_id``: 0, 1, ... per writer, at most ``flush_size`` changes each.

    With ``interval_ms`` a timer tick also closes the open bulk; ``ts`` must
    then not go backwards along ``seq``. ``seq_chunk`` is the chunk width in
    units of ``seq``, for dense numbers; without it chunks lie between up to
    ``CUT_POINTS`` cut points, quantiles taken by one more pass over ``seq``.
    Then a writer has at most as many chunks to sum up, and a chunk holds about
    as small a share of all rows, whatever the spread of ``seq``.
    """
    if flush_size < 1:
        raise ValueError("flush size must be greater than 0")
    if seq_chunk is not None and seq_chunk < 1:
        raise ValueError("seq_chunk must be at least 1")
    if not isinstance(changes.schema[seq].dataType, INTEGRAL):
        raise TypeError(f"sequence column {seq!r} must be an integer")

    tick = F.lit(0).cast("bigint") if interval_ms is None else _tick(changes, interval_ms, ts)
    present = require(changes, seq, writer, *([] if interval_ms is None else [ts]))
    lanes = present.withColumns({"_lane": F.col(writer), "_tick": tick})
    if seq_chunk is None:
        lanes = _between_cut_points(lanes, changes, seq)
    else:
        lanes = lanes.withColumn("_chunk", _div(F.col(quote(seq)), F.lit(seq_chunk)))
    return _numbered(lanes, flush_size, seq).selectExpr(
        *[quote(c) for c in changes.columns], f"_first + (_before + _rn) div {flush_size} as bulk_id"
    )


def continue_bulks(
    changes: DataFrame,
    opened: DataFrame | None,
    flush_size: int,
    *,
    interval_ms: int | None = None,
    ts: str = "ts",
    last_tick: int | None = None,
    seq_chunk: int | None = None,
) -> DataFrame:
    """``roll_bulks`` for the next slice of a changelog, with ``tick`` besides ``bulk_id``.

    ``opened`` are the rows that earlier slices left in open bulks; they come
    first, whatever their ``seq``, so that slices may be cut anywhere. A time
    before ``last_tick`` counts as that tick, as its bulk was closed then.
    """
    if opened is not None:
        # At most ``flush_size`` rows of a writer.
        place = F.row_number().over(Window.partitionBy("writer").orderBy("seq"))
        changes = changes.unionByName(opened.withColumn("seq", F.lit(OPEN_SEQ) + place))
    tick = F.lit(0).cast("bigint")
    if interval_ms is not None:
        changes = require(changes, ts)
        tick = _tick(changes, interval_ms, ts)
        if last_tick is not None:
            tick = F.greatest(tick, F.lit(last_tick))
    lanes = require(changes, "seq", "writer").withColumns({"_lane": F.col("writer"), "_tick": tick})
    if seq_chunk is None:
        lanes = _between_cut_points(lanes, changes, "seq")
    else:
        lanes = lanes.withColumn("_chunk", _div(F.col("seq"), F.lit(seq_chunk)))
    return _numbered(lanes, flush_size, "seq").selectExpr(
        *[quote(c) for c in changes.columns],
        "_tick as tick",
        f"_first + (_before + _rn) div {flush_size} as bulk_id",
    )


def last_bulks(rolled: DataFrame) -> DataFrame:
    """Of each writer the last bulk, ``writer, bulk_id, n, tick``; only this one may still be open."""
    sizes = rolled.groupBy("writer", "bulk_id").agg(F.expr("count(1) as n"), F.max("tick").alias("tick"))
    last = sizes.groupBy("writer").agg(F.max(F.struct("bulk_id", "n", "tick")).alias("last"))
    return last.select("writer", "last.*")


def tick_of(clock_ms: int, interval_ms: int) -> int:
    """Number of timer ticks up to a time in milliseconds since the epoch."""
    return clock_ms // interval_ms


def _numbered(lanes: DataFrame, flush_size: int, seq: str) -> DataFrame:
    """Rows with their place ``_rn`` in their chunk, and the rows and bulks of their lane before it."""
    place = ("_lane", "_tick", "_chunk")
    counts = lanes.groupBy(*place).agg(F.expr("count(1) as _rows"))
    # ``_before``: rows of the tick in earlier chunks. ``_first``: bulks of the
    # lane in earlier ticks. A chunk opens the bulks that start in it; over a
    # tick they add up to ceil(rows of the tick / flush_size).
    starts = (
        counts.selectExpr("*", "sum(_rows) over (partition by _lane, _tick order by _chunk) as _upto")
        .selectExpr(
            *place,
            "_upto - _rows as _before",
            f"(_upto + {flush_size - 1}) div {flush_size} as _ended",
            f"(_upto - _rows + {flush_size - 1}) div {flush_size} as _begun",
        )
        .selectExpr(
            *place, "_before", "sum(_ended - _begun) over (partition by _lane order by _tick, _chunk) - _ended as _first"
        )
    )
    numbered = lanes.selectExpr(
        "*", f"row_number() over (partition by _lane, _tick, _chunk order by {quote(seq)}) - 1 as _rn"
    )
    return numbered.join(starts, list(place))


def _between_cut_points(lanes: DataFrame, changes: DataFrame, seq: str) -> DataFrame:
    """``_chunk``: how many sampled cut points a number has passed.

    Numbers are compared as doubles. Neighbours that a double cannot tell apart
    fall into one chunk, and the order of chunks is that of the numbers.
    """
    # One literal instead of thousands, which take seconds to plan.
    shares = "cast(split('" + " ".join(str(i / CUT_POINTS) for i in range(1, CUT_POINTS)) + "', ' ') as array<double>)"
    quantiles = changes.selectExpr(f"percentile_approx({quote(seq)}, {shares}, {_ACCURACY})").first()[0]
    cuts = sorted({float(c) for c in quantiles or []})
    if not cuts:
        return lanes.withColumn("_chunk", F.lit(0))
    splits = [-float("inf"), *cuts, float("inf")]
    passed = Bucketizer(splits=splits, inputCol="_number", outputCol="_chunk", handleInvalid="keep")
    numbers = lanes.withColumn("_number", F.col(quote(seq)).cast("double"))
    return passed.transform(numbers).withColumn("_chunk", F.col("_chunk").cast("int")).drop("_number")


def _tick(changes: DataFrame, interval_ms: int, ts: str) -> Column:
    """Number of timer ticks up to the arrival time ``ts``, counted from the epoch."""
    if interval_ms <= 0:
        raise ValueError("interval must be greater than 0")
    time = F.col(quote(ts))
    if isinstance(changes.schema[ts].dataType, T.TimestampNTZType):
        # A wall clock: subtracting keeps the session time zone out of it.
        since = time - F.expr("timestamp_ntz'1970-01-01 00:00:00'")
        micros = (since.cast(T.DayTimeIntervalType(3, 3)).cast("decimal(20,6)") * 1_000_000).cast("bigint")
    else:
        micros = F.unix_micros(time.cast("timestamp"))
    width = F.lit(interval_ms * 1000)
    return _div(micros - F.pmod(micros, width), width)


def _div(dividend: Column, divisor: Column) -> Column:
    """Integer division; going through doubles would lose large sequence numbers."""
    return F.call_function("div", dividend, divisor)
