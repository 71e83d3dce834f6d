"""Changes handed in by INSERT INTO and by the registered format."""

import os

import pyarrow as pa
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsink import DocumentSink, SinkOptions, register_format
from docsink.sources import inbox
from tests.test_sink import by_hand, changelog, held, rows


@pytest.fixture
def sink(spark, tmp_path):
    return DocumentSink(spark, str(tmp_path), SinkOptions("db", "docs", key="id", flush_size=13))


@pytest.fixture
def table(spark, sink):
    sink.create_table("handed_in", "id int, seq bigint, op string, v double")
    yield "handed_in"
    spark.sql("drop table handed_in")


def files(sink):
    folder = f"{sink.collection.path}/inbox"
    return sorted(f for _, _, names in os.walk(folder) for f in names if not f.endswith(".crc")) if os.path.isdir(folder) else []


def test_insert_into_equals_write(spark, sink, table):
    data = changelog(150)
    for first in (0, 50, 100):
        spark.sql(f"insert into {table} select * from {{part}}", part=rows(spark, data[first : first + 50]).repartition(3))
    assert not sink.collection.exists()
    assert sink.settle() == 3
    assert held(sink.read()) == by_hand([data[0:50], data[50:100], data[100:150]], 13)
    assert sink.settle() == 0 and files(sink) == [] and sink.collection.manifest().batches == {}


def test_values_are_inserts_in_their_order(spark, sink):
    sink.create_table("plain", "id int, v double")
    try:
        spark.sql("insert into plain values (1, 1.0), (2, 2.0), (1, 3.0)")
        spark.sql("insert into plain (v, id) values (9.0, 2)")
        spark.sql("insert into plain select id, id * 1.5 from range(10, 40)")
    finally:
        spark.sql("drop table plain")
    assert sink.settle() == 3
    got = held(sink.read())
    # A key inserted twice in one bulk is an upsert; a lone insert of a known key is refused.
    assert got["1"] == (1, 3.0) and got["2"] == (2, 2.0) and len(got) == 32


def test_format_takes_the_same_changes(spark, sink):
    register_format(spark)
    data = changelog(60, seed=3)
    path = sink.collection.path
    rows(spark, data).repartition(4).write.format("docsink").mode("append").option("path", path).save()
    sink.settle()
    assert held(sink.read()) == by_hand([data], 13)
    with pytest.raises(Exception, match="append them"):
        rows(spark, data).write.format("docsink").mode("overwrite").option("path", path).save()
    with pytest.raises(Exception, match="option path"):
        rows(spark, data).write.format("docsink").mode("append").save()
    with pytest.raises(Exception, match="DocumentSink"):
        spark.read.format("docsink").schema("id int").option("path", path).load().collect()


def test_a_failed_job_leaves_nothing(spark, sink, table):
    bad = rows(spark, changelog(40)).repartition(4).withColumn(
        "v", F.when(F.col("seq") == 33, F.raise_error(F.lit("boom")).cast("double")).otherwise(F.col("v"))
    )
    with pytest.raises(Exception, match="boom|aborted|failed"):
        spark.sql(f"insert into {table} select * from {{bad}}", bad=bad)
    assert sink.settle() == 0 and files(sink) == []


@pytest.mark.parametrize("aborted_after", [0, 1, 2])
def test_a_task_that_outlives_its_job_leaves_nothing(tmp_path, monkeypatch, aborted_after):
    class Context:
        @staticmethod
        def get():
            return Context

        @staticmethod
        def partitionId():
            return 0

    monkeypatch.setattr(inbox, "TaskContext", Context)
    writer = inbox.InboxWriter(f"{tmp_path}/users", T.StructType().add("id", T.IntegerType()))

    def batches():
        for i in range(3):
            if i == aborted_after:
                writer.abort([])
            if i < 2:
                yield pa.record_batch({"id": pa.array([i], pa.int32())})

    with pytest.raises((RuntimeError, OSError)):
        writer.write(batches())
    assert [f for _, _, names in os.walk(tmp_path) for f in names] == []
    assert os.listdir(f"{tmp_path}/users/inbox") == []


def test_only_listed_files_count(spark, sink, table, tmp_path):
    """What an attempt wrote that lost against another is no part of the commit."""
    spark.sql(f"insert into {table} select 1, 0L, '+I', 1.0D")
    commit = inbox.waiting(sink.collection.path)[0]
    spark.sql("select 2 as id, 0L as seq, '+I' as op, 2D as v, 0L as `row:`").write.parquet(f"{tmp_path}/other")
    stray = next(f for f in os.listdir(f"{tmp_path}/other") if f.endswith(".parquet"))
    os.link(f"{tmp_path}/other/{stray}", f"{commit.folder}/part-00001-stray.parquet")
    sink.settle()
    assert held(sink.read()) == {"1": (1, 1.0)}


def test_settling_again_after_a_crash_applies_once(spark, sink, table, monkeypatch):
    spark.sql(f"insert into {table} select 1, 0L, '+I', 1.0D")
    spark.sql(f"insert into {table} select 1, 1L, '-D', 1.0D")
    spark.sql(f"insert into {table} select 1, 2L, '+I', 5.0D")

    def crash(commit, path):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(inbox, "remove", crash)
        with pytest.raises(OSError, match="lost"):
            sink.settle()
    assert held(sink.read()) == {"1": (1, 1.0)}
    version = sink.collection.manifest().version
    assert sink.settle() == 3
    assert held(sink.read()) == {"1": (1, 5.0)}
    assert sink.collection.manifest().version == version + 3  # two batches, and forgetting the names


def test_types_survive(spark, sink):
    values = """
        1 as id, cast(1.25 as decimal(9,3)) as d, timestamp'2024-01-02 03:04:05.678' as t, date'2024-02-03' as day,
        array(1, null) as a, map('k', struct(1 as x)) as m, cast('ab' as binary) as b, timestamp_ntz'2024-01-02 00:00:00' as n"""
    frame = spark.sql(f"select {values}")
    sink.create_table("typed", frame.schema)
    try:
        spark.sql(f"insert into typed select {values}")
    finally:
        spark.sql("drop table typed")
    sink.settle()
    other = DocumentSink(spark, sink.collection.path + "-other", sink.options)
    other.write(frame.withColumns({"op": F.lit("+I"), "seq": F.lit(0).cast("long")}))
    assert sink.read().collect() == other.read().collect()
    with pytest.raises(Exception, match="cannot be handed in"):
        register_format(spark)
        spark.sql("select 1 as id, interval '1' day as i").write.format("docsink").mode("append").option(
            "path", sink.collection.path
        ).save()


def test_tasks_without_rows_write_no_file(spark, sink, table):
    spark.sql(f"insert into {table} select * from {{none}}", none=rows(spark, []))
    assert sink.settle() == 0 and files(sink) == []
    assert TaskContext.get() is None
