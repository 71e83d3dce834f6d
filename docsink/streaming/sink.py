"""Changelog sink: one object for batch and streaming jobs.

In a stream a bulk may be longer than a micro-batch. What a micro-batch leaves in
bulks that are not full is kept beside the collection and named in the same
manifest as the effects of its full bulks, so that both are committed at once:
after a restart, wherever it happens, numbering goes on where it stood, and the
result does not depend on how the stream was cut. The rows kept are fewer than
``flush_size`` per writer. A timer tick closes open bulks, too: ticks come from
an arrival column or from the clock of the micro-batch. So that the clock also
runs while no change arrives, a heartbeat joins the stream.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from urllib import parse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docsink.functions.encoding import encode_documents
from docsink.functions.names import quote
from docsink.operators.changelog import normalize_changelog
from docsink.operators.effects import SEGMENT_BULKS, effects_of_last_writes, fold_bulks
from docsink.operators.outcomes import fold_outcomes, reason_to_reject, resolve_outcomes
from docsink.operators.rolling import continue_bulks, hash_writer, last_bulks, roll_bulks, tick_of
from docsink.options import SinkOptions
from docsink.sources import inbox
from docsink.sources.collection import Collection

Encoder = Callable[[DataFrame], DataFrame]

_CHANGE_COLUMNS = ("op", "seq", "bulk_id")

# Up to here, the changes of one key in one segment go to one task uncombined.
MAX_SEGMENT_CHANGES = 1 << 20

_INSERT = "insert:"  # in front of the names of handed-in jobs
_BEAT = "beat:"  # column of the heartbeat


class DocumentSink:
    """Writes a changelog to ``<root>/<database>/<collection>``.

    Input rows have a row kind ``op``, an arrival number ``seq`` and the
    document's columns; rows that bring their own ``bulk_id`` keep it, others
    are cut by ``flush_size``. ``encoder`` replaces the default row encoding:
    any DataFrame function that returns ``_key, op, seq, doc``.
    """

    def __init__(
        self, spark: SparkSession, root: str, options: SinkOptions, encoder: Encoder | None = None
    ) -> None:
        self.options = options
        self.encoder = encoder or self._encode
        path = f"{root.rstrip('/')}/{options.database}/{options.collection}"
        self.collection = Collection(
            spark,
            path,
            options.buckets,
            keep_versions=options.keep_versions,
            keep_seconds=options.keep_seconds,
        )

    def effects(self, rows: DataFrame) -> tuple[DataFrame, T.StructType]:
        """One effect per key for a finite set of rows."""
        changes = normalize_changelog(self.encoder(rows))
        doc_type = changes.schema["doc"].dataType
        if self.options.mode == "lww":
            return effects_of_last_writes(changes), doc_type
        return self._folded(self._cut(changes), "bulk_id" not in changes.columns), doc_type

    def _cut(self, changes: DataFrame) -> DataFrame:
        """Changes with bulk ids: their own, or by size."""
        if "bulk_id" in changes.columns:
            return changes
        lanes = changes.withColumn("writer", hash_writer(self.options.writers))
        return roll_bulks(lanes, self.options.flush_size, seq_chunk=self.options.seq_chunk)

    def _folded(self, changes: DataFrame, by_size: bool) -> DataFrame:
        # A segment of bulks holds at most this many changes of one key.
        bounded = by_size and self.options.flush_size * SEGMENT_BULKS <= MAX_SEGMENT_CHANGES
        return fold_bulks(changes, bounded_bulks=bounded)

    def _outcomes(self, changes: DataFrame) -> Callable[[], DataFrame] | None:
        """What will become of changes with bulk ids in the collection as it is then, if that is to be reported."""
        if not self.options.report:
            return None
        folded = fold_outcomes(changes)

        def resolved() -> DataFrame:
            keys = self.collection.read().select("_key") if self.collection.exists() else None
            return resolve_outcomes(folded, keys)

        return resolved

    def _sound(self, rows: DataFrame, source: str | None, batch_id: int | None) -> DataFrame:
        """Rows that can be changes; the others are put aside, if the options say so."""
        if self.options.reject == "fail":
            return rows
        key = self.options.key if isinstance(self.options.key, str) else self.options.key[0]
        reasoned = rows.withColumn("reason:", reason_to_reject(key, rows.columns))
        reason = F.col("`reason:`")
        # The same batch delivered again is put aside in the same place.
        name = uuid.uuid4().hex if batch_id is None else f"{parse.quote(source or '', safe='')}-{batch_id}"
        bad = reasoned.where(reason.isNotNull())
        text = F.to_json(F.struct(*[F.col(quote(c)) for c in rows.columns]), {"ignoreNullFields": "false"})
        bad.select(reason.alias("reason"), text.alias("change")).write.mode("overwrite").parquet(
            f"{self.collection.path}/rejected/batch={name}"
        )
        return reasoned.where(reason.isNull()).drop("reason:")

    def rejected(self) -> DataFrame:
        """Rows that were put aside: ``reason``, the row as JSON in ``change``, and its ``batch``."""
        if not self.collection.exists():
            raise FileNotFoundError(f"no collection at {self.collection.path}")
        spark, path = self.collection.spark, f"{self.collection.path}/rejected"
        return spark.read.schema("reason string, change string, batch string").parquet(path)

    def write(self, rows: DataFrame, source: str | None = None, batch_id: int | None = None) -> bool:
        """Apply a finite changelog; False if this batch of this source was applied before."""
        if source is not None and batch_id is not None and self.collection.applied(source, batch_id):
            return False
        rows = self._sound(rows, source, batch_id)
        effects, doc_type = self.effects(rows)
        outcomes = self._outcomes(self._cut(normalize_changelog(self.encoder(rows)))) if self.options.report else None
        applied = self.collection.append(effects, doc_type, source=source, batch_id=batch_id, outcomes=outcomes)
        self.collection.tidy(self.options.max_log, self.options.compact_ratio)
        return applied

    def create_table(self, table: str, columns: T.StructType | str) -> None:
        """A table for ``INSERT INTO``; ``columns`` are the document's, with ``op``, ``seq`` and ``bulk_id`` if wanted."""
        columns = T.StructType.fromDDL(columns) if isinstance(columns, str) else columns
        inbox.create_table(self.collection.spark, table, columns, self.collection.path)

    def settle(self) -> int:
        """Apply what was handed in by ``INSERT INTO`` or ``format("docsink")``, in order; returns how many jobs."""
        commits = inbox.waiting(self.collection.path)
        for commit in commits:
            self.write(inbox.changes_of(self.collection.spark, commit), source=f"{_INSERT}{commit.name}", batch_id=0)
            inbox.remove(commit, self.collection.path)
        self.collection.forget([f"{_INSERT}{commit.name}" for commit in commits])
        return len(commits)

    def take(
        self, rows: DataFrame, source: str | None = None, batch_id: int | None = None, clock_ms: int | None = None
    ) -> bool:
        """Apply the next slice of a longer changelog: the last bulk of a writer stays open until it is full.

        ``clock_ms`` is the time of the slice in milliseconds since the epoch,
        for closing bulks by time. False if this batch of this source was applied before.
        """
        if source is not None and batch_id is not None and self.collection.applied(source, batch_id):
            return False
        if not self.options.carries_bulks or "bulk_id" in rows.columns:
            return self.write(rows, source, batch_id)
        changes = normalize_changelog(self.encoder(self._sound(rows, source, batch_id)))
        if "bulk_id" in changes.columns:
            return self.write(rows, source, batch_id)
        doc_type = changes.schema["doc"].dataType
        interval = self._interval(clock_ms)
        if interval is not None and self.options.arrival is None:
            changes = changes.withColumn("ts", F.timestamp_millis(F.lit(clock_ms)))
        elif interval is not None:
            changes = changes.withColumnRenamed(self.options.arrival, "ts")
        held = ["_key", "op", "seq", "doc", *(["ts"] if interval is not None else [])]
        changes = changes.select(*held).withColumn("seq", F.col("seq").cast("long"))

        opened, last_tick = self.collection.opened(source)
        if opened is not None and opened.schema.simpleString() != changes.schema.simpleString():
            # Documents of another type, or another way of cutting: close what is open.
            self.flush(source)
            opened = None
        changes, opened = (
            None if part is None else part.withColumn("writer", hash_writer(self.options.writers))
            for part in (changes, opened)
        )
        size = self.options.flush_size
        rolled = continue_bulks(
            changes, opened, size, interval_ms=interval, last_tick=last_tick, seq_chunk=self.options.seq_chunk
        )
        last = last_bulks(rolled).collect()  # one row per writer
        ticks = [*[bulk.tick for bulk in last], last_tick, None if interval is None or clock_ms is None else tick_of(clock_ms, interval)]
        tick = max((t for t in ticks if t is not None), default=0)
        still_open = [(b.writer, b.bulk_id) for b in last if b.n < size and b.tick == tick]
        closed, rest = rolled, None
        if still_open:
            listed = F.broadcast(rolled.sparkSession.createDataFrame(still_open, "writer int, bulk_id long"))
            closed = rolled.join(listed, ["writer", "bulk_id"], "left_anti")
            rest = rolled.join(listed, ["writer", "bulk_id"], "left_semi").select(*held)
        effects = fold_bulks(closed, bounded_bulks=size * SEGMENT_BULKS <= MAX_SEGMENT_CHANGES)
        applied = self.collection.append(
            effects, doc_type, source=source, batch_id=batch_id, opened=(rest, tick), outcomes=self._outcomes(closed)
        )
        self.collection.tidy(self.options.max_log, self.options.compact_ratio)
        return applied

    def flush(self, source: str | None = None) -> None:
        """Close the open bulks of a source, or of all sources."""
        for name in self.collection.sources_with_open_bulks() if source is None else [source]:
            opened, tick = self.collection.opened(name)
            if opened is None:
                continue
            # One bulk per writer; a key has one writer.
            bulk = opened.withColumn("bulk_id", F.lit(0).cast("long"))
            doc_type, outcomes = bulk.schema["doc"].dataType, self._outcomes(bulk)
            self.collection.append(fold_bulks(bulk), doc_type, source=name, opened=(None, tick), outcomes=outcomes)
        self.collection.tidy(self.options.max_log, self.options.compact_ratio)

    def start(
        self, stream: DataFrame, checkpoint: str, *, available_now: bool = False, source: str | None = None
    ) -> StreamingQuery:
        """Run as a streaming query; every micro-batch is one version of the collection.

        Rows without ``bulk_id`` are cut into bulks that go on over micro-batches
        (``take``), unless the options flush on checkpoints. ``flush`` closes the
        last ones when the stream has ended.

        Batch numbers belong to a checkpoint. Spark keeps the query's id in it,
        so this id names the source in the replay guard: it is the same after a
        restart and new for a new checkpoint, whose batches are all applied.
        ``source`` is only a label in front of it.
        """
        self.collection.create()
        interval = self.options.flush_interval_ms
        if self.options.carries_bulks and interval > 0 and not available_now and "bulk_id" not in stream.columns:
            stream = _with_heartbeat(stream, interval)

        def apply_batch(rows: DataFrame, batch_id: int) -> None:
            query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            clock = None
            if _BEAT in rows.columns:
                clock = rows.agg(F.max(F.unix_millis(F.col(f"`{_BEAT}`")))).first()[0]
                rows = rows.where(F.col(f"`{_BEAT}`").isNull()).drop(_BEAT)
            # Numbering and applying read the batch several times.
            rows.persist()
            try:
                self.take(rows, source=f"{source}/{query}" if source else query, batch_id=batch_id, clock_ms=clock)
            finally:
                rows.unpersist()

        writer = stream.writeStream.foreachBatch(apply_batch).option("checkpointLocation", checkpoint)
        if available_now:
            writer = writer.trigger(availableNow=True)
        elif self.options.trigger:
            writer = writer.trigger(**self.options.trigger)
        return writer.start()

    def read(
        self, *, keys: Sequence[str] | None = None, low: str | None = None, high: str | None = None
    ) -> DataFrame:
        """Documents: all, those of some ``keys``, or those from ``low`` to ``high``."""
        return self.collection.read(keys=keys, low=low, high=high)

    def _interval(self, clock_ms: int | None) -> int | None:
        """Milliseconds between ticks, if there is an interval and a clock to measure it by."""
        timed = self.options.flush_interval_ms > 0 and (self.options.arrival is not None or clock_ms is not None)
        return self.options.flush_interval_ms if timed else None

    def _encode(self, rows: DataFrame) -> DataFrame:
        carry = (*_CHANGE_COLUMNS, *([self.options.arrival] if self.options.arrival else []))
        return encode_documents(rows, self.options.key, key_policy=self.options.key_policy, carry=carry)


def _with_heartbeat(stream: DataFrame, interval_ms: int) -> DataFrame:
    """The stream and, in a column of its own, the time: about one row per interval, at least one a second."""
    spark = stream.sparkSession
    beats = spark.readStream.format("rate").option("rowsPerSecond", max(1, -(-1000 // interval_ms))).load()
    return stream.unionByName(beats.select(F.col("timestamp").alias(_BEAT)), allowMissingColumns=True)
