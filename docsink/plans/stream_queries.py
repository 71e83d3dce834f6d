"""Streaming queries."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsink.options import SinkOptions
from docsink.plans.catalog import query
from docsink.plans.tables import (
    APPLY_SQL,
    BULK,
    CHANGES_SQL,
    EMPTY_BASE_SQL,
    GROUPS_SQL,
    NET_SQL,
    bulk_of,
    event_kind,
    table,
    work_dir,
)
from docsink.sources.inbox import register_format
from docsink.streaming.sink import DocumentSink

SLICES = 4

# Row kinds are normalised before bulks are collapsed, and the collection starts empty.
_ORACLE = f"""
with {CHANGES_SQL.replace("ch as", "raw as")},
ch as (select * from raw where op <> '-U'),
{GROUPS_SQL}, {NET_SQL}, {EMPTY_BASE_SQL}, {APPLY_SQL}
select _key, cast(_key as bigint) as user_id, value, event_type from result"""


def _slices(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """The whole changelog as consecutive slices that do not split a bulk."""
    rows = table(spark, sf_dir, "events").select(
        "user_id",
        "value",
        "event_type",
        F.col("event_id").alias("seq"),
        bulk_of(F.col("event_id")).alias("bulk_id"),
        event_kind().alias("op"),
    )
    last = rows.agg(F.max("seq")).first()[0] or 0
    width = (last // BULK // SLICES + 1) * BULK
    for i in range(SLICES):
        yield rows.where((F.col("seq") >= i * width) & (F.col("seq") < (i + 1) * width))


def _sink(spark: SparkSession, root: str) -> DocumentSink:
    return DocumentSink(spark, root, SinkOptions("shop", "users", key="user_id", max_log=3))


@query("stream_apply_changelog", _ORACLE)
def stream_apply_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices arrive in a folder two at a time; each run of the stream takes up the new ones, a micro-batch each."""
    root = work_dir(spark, "stream")
    sink = _sink(spark, root)
    arriving = f"{root}/arriving"
    seen = files = 0
    for number, part in enumerate(_slices(spark, sf_dir)):
        # The second slice of a run has at most the files of the first, so each slice is one micro-batch.
        (part.coalesce(files) if number % 2 else part).write.mode("append").parquet(arriving)
        written = len(spark.read.schema(part.schema).parquet(arriving).inputFiles())
        seen, files = written, files if number % 2 else written - seen
        if number % 2:
            stream = spark.readStream.schema(part.schema).option("maxFilesPerTrigger", files).parquet(arriving)
            run = sink.start(stream, f"{root}/checkpoint", available_now=True)
            run.awaitTermination()
    return sink.read()


@query("stream_replay_idempotent", _ORACLE)
def stream_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch is delivered twice, and all of them once more at the end."""
    sink = _sink(spark, work_dir(spark, "replay"))
    for _ in range(2):
        for batch_id, part in enumerate(_slices(spark, sf_dir)):
            sink.write(part, source="slices", batch_id=batch_id)
            sink.write(part, source="slices", batch_id=batch_id)
    return sink.read()


HALF_DAY = 12 * 3600


def _uncut(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """The changelog without bulk ids, in slices of unequal length that split bulks."""
    rows = table(spark, sf_dir, "events").select(
        "user_id", "value", "event_type", F.col("event_id").alias("seq"), F.col("ts").alias("arrived"), event_kind().alias("op")
    )
    last = (rows.agg(F.max("seq")).first()[0] or 0) + 1
    cuts = [0, last // 7, last // 3 + 1, last // 2 + 13, last]
    for first, end in zip(cuts, cuts[1:], strict=False):
        yield rows.where((F.col("seq") >= first) & (F.col("seq") < end))


def _stream_uncut(spark: SparkSession, sf_dir: str, options: SinkOptions) -> DataFrame:
    """A run of the stream for each slice, so every open bulk goes on after a restart; then the last ones are closed."""
    root = work_dir(spark, "open-bulks")
    sink = DocumentSink(spark, root, options)
    arriving = f"{root}/arriving"
    for part in _uncut(spark, sf_dir):
        part.write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(part.schema).parquet(arriving)
        sink.start(stream, f"{root}/checkpoint", available_now=True).awaitTermination()
    sink.flush()
    return sink.read()


def _uncut_oracle(bulk_id: str) -> str:
    return f"""
with {CHANGES_SQL.replace("bulk_id, value", "epoch(ts) as arrived, value").replace(f"event_id // {BULK} as ", "")},
accepted as (select * from ch where op <> '-U'),
ticked as (select *, cast(floor(arrived / {HALF_DAY}) as bigint) as tick from accepted),
cut as (
  select *, (row_number() over (partition by tick order by seq) - 1) // {BULK} as in_tick,
         (row_number() over (order by seq) - 1) // {BULK} as in_all
  from ticked),
bulks as (select *, {bulk_id} as bulk_id from cut),
{GROUPS_SQL.replace("from ch", "from bulks")}, {NET_SQL}, {EMPTY_BASE_SQL}, {APPLY_SQL}
select _key, cast(_key as bigint) as user_id, value, event_type from result"""


@query("stream_roll_bulks", _uncut_oracle("in_all"))
def stream_roll_bulks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulks by size that go on over micro-batches and restarts."""
    options = SinkOptions(
        "shop", "users", key="user_id", flush_size=BULK, flush_interval_ms=0, arrival="arrived", max_log=3
    )
    return _stream_uncut(spark, sf_dir, options)


@query("stream_roll_bulks_or_interval", _uncut_oracle("dense_rank() over (order by tick, in_tick)"))
def stream_roll_bulks_or_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulks by size or by the time of arrival that go on over micro-batches and restarts."""
    options = SinkOptions(
        "shop", "users", key="user_id", flush_size=BULK, flush_interval_ms=HALF_DAY * 1000, arrival="arrived", max_log=3
    )
    return _stream_uncut(spark, sf_dir, options)


@query("insert_into_collection", _ORACLE)
def insert_into_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog, handed in by ``INSERT INTO`` of a table and by the registered format."""
    sink = _sink(spark, work_dir(spark, "insert"))
    name = f"users_{uuid.uuid4().hex}"
    first, second, *rest = _slices(spark, sf_dir)
    sink.create_table(name, first.schema)
    try:
        for part in (first, second):
            spark.sql(f"insert into {name} select * from {{part}}", part=part)
    finally:
        spark.sql(f"drop table {name}")
    register_format(spark)
    for part in rest:
        part.write.format("docsink").mode("append").option("path", sink.collection.path).save()
    sink.settle()
    return sink.read()
