"""Bulks that go on over micro-batches: any cut of a changelog gives the same collection."""

import random
import time

import pytest
from pyspark.sql import functions as F

from docsink import DocumentSink, SinkOptions
from docsink.operators.rolling import CUT_POINTS, _between_cut_points, hash_writer, last_bulks, roll_bulks
from tests import model
from tests.test_sink import by_hand, changelog, held, rows

START = 1_700_000_000_000  # milliseconds, a multiple of a second


def sink_at(spark, path, **more):
    more = {"flush_interval_ms": 0, "flush_size": 13, "max_log": 4, **more}
    return DocumentSink(spark, str(path), SinkOptions("db", "docs", key="id", **more))


@pytest.mark.parametrize("cuts", [[200], [1, 2, 200], [13, 26, 27, 199, 200]])
def test_any_cut_gives_the_batch_result(spark, tmp_path, cuts):
    data = changelog(200, seed=len(cuts))
    sink = sink_at(spark, tmp_path)
    first = 0
    for n, end in enumerate(cuts):
        assert sink.take(rows(spark, data[first:end]), "s", n)
        assert not sink.take(rows(spark, data[first:end]), "s", n)
        # What has been applied are the full bulks, no more.
        full = end // 13 * 13
        sink.collection.create()
        if full:
            assert held(sink.read()) == by_hand([data[:full]], 13)
        first = end
    sink.flush()
    assert held(sink.read()) == by_hand([data], 13)
    sink.flush()
    assert held(sink.read()) == by_hand([data], 13)
    assert not sink.take(rows(spark, data[:5]), "s", 0)


def test_two_inserts_in_one_bulk_are_an_upsert(spark, tmp_path):
    """However the two arrive."""
    for path, slices in (("one", [[(1, 0, "+I", 1.0), (1, 1, "+I", 2.0)]]), ("two", [[(1, 0, "+I", 1.0)], [(1, 1, "+I", 2.0)]])):
        sink = sink_at(spark, tmp_path / path, flush_size=1000)
        for n, data in enumerate(slices):
            sink.take(rows(spark, data), "s", n)
        sink.flush()
        assert held(sink.read()) == {"1": (1, 2.0)}


def test_slices_may_repeat_and_reset_their_numbers(spark, tmp_path):
    """A later slice comes after an earlier one, whatever its ``seq``."""
    data = changelog(90, seed=4)
    sink = sink_at(spark, tmp_path)
    for n in range(3):
        part = [(k, s - 30 * n, op, v) for k, s, op, v in data[30 * n : 30 * n + 30]]
        sink.take(rows(spark, part), "s", n)
    sink.flush()
    assert held(sink.read()) == by_hand([data], 13)


@pytest.mark.parametrize("seq_chunk", [None, 1 << 20])
def test_several_writers_and_sources(spark, tmp_path, seq_chunk):
    data = changelog(240, seed=8)
    sink = sink_at(spark, tmp_path, writers=3, seq_chunk=seq_chunk)
    lanes = {
        str(r.id): r.w
        for r in spark.range(40).selectExpr("cast(id as string) as _key", "id").withColumn("w", hash_writer(3)).collect()
    }
    for n in range(3):
        sink.take(rows(spark, data[80 * n : 80 * n + 80]), "s", n)
        # Another source has bulks of its own, for other keys.
        sink.take(rows(spark, [(100 + k, s, op, v) for k, s, op, v in data[80 * n : 80 * n + 80]]), "t", n)
    assert sorted(sink.collection.sources_with_open_bulks()) == ["s", "t"]
    sink.flush()
    collection = {}
    for w in range(3):
        lane = [c for c in data if lanes[str(c[0])] == w]
        bulks = [(str(k), i // 13, s, op, {"id": k, "v": v}) for i, (k, s, op, v) in enumerate(lane)]
        collection |= model.apply_bulks({}, bulks)
    got = held(sink.read())
    assert {k: v for k, v in got.items() if int(k) < 100} == {k: (d["id"], d["v"]) for k, d in collection.items()}


def timed(spark, data):
    return spark.createDataFrame(data, "id int, seq long, op string, v double, ms long").select(
        "id", "seq", "op", "v", F.timestamp_millis("ms").alias("arrived")
    )


def by_hand_timed(data, size, interval):
    """Cut by size and by the ticks of the arrival times."""
    bulk, filled, tick, bulks = -1, size, None, []
    for k, s, op, v, ms in data:
        if filled == size or ms // interval != tick:
            bulk, filled, tick = bulk + 1, 0, ms // interval
        filled += 1
        bulks.append((str(k), bulk, s, op, {"id": k, "v": v}))
    return {k: (d["id"], d["v"]) for k, d in model.apply_bulks({}, bulks).items()}


@pytest.mark.parametrize("cuts", [[200], [3, 50, 51, 120, 200]])
def test_arrival_times_cut_bulks(spark, tmp_path, cuts):
    rng, now, data = random.Random(6), START, []
    for change in changelog(200, seed=6):
        now += rng.choice([0, 1, 90, 700])
        data.append((*change, now))
    sink = sink_at(spark, tmp_path, flush_interval_ms=1000, arrival="arrived")
    first = 0
    for n, end in enumerate(cuts):
        sink.take(timed(spark, data[first:end]), "s", n)
        first = end
    sink.flush()
    assert held(sink.read()) == by_hand_timed(data, 13, 1000)


def test_the_clock_closes_a_bulk(spark, tmp_path):
    sink = sink_at(spark, tmp_path, flush_interval_ms=1000)
    nothing = rows(spark, [])
    sink.take(rows(spark, [(1, 0, "+I", 1.0)]), "s", 0, clock_ms=START)
    assert held_or_empty(sink) == {}
    sink.take(nothing, "s", 1, clock_ms=START + 999)
    assert held_or_empty(sink) == {}
    sink.take(nothing, "s", 2, clock_ms=START + 1000)
    assert held(sink.read()) == {"1": (1, 1.0)}
    # The bulk was closed, so the next insert of the key is one of its own, and refused.
    sink.take(rows(spark, [(1, 1, "+I", 2.0)]), "s", 3, clock_ms=START + 1001)
    sink.take(nothing, "s", 4, clock_ms=START + 2000)
    assert held(sink.read()) == {"1": (1, 1.0)}


def held_or_empty(sink):
    documents = sink.read()
    return held(documents) if "v" in documents.columns else {}


def test_documents_of_another_type_close_the_open_bulk(spark, tmp_path):
    sink = sink_at(spark, tmp_path)
    sink.take(spark.sql("select 1 as id, 0L as seq, '+I' as op, 1 as v"), "s", 0)
    sink.take(spark.sql("select 2 as id, 1L as seq, '+I' as op, cast(2 as bigint) as v"), "s", 1)
    assert held(sink.read()) == {"1": (1, 1.0)}
    sink.flush()
    assert held(sink.read()) == {"1": (1, 1), "2": (2, 2)}


def test_flushing_on_checkpoints_leaves_nothing_open(spark, tmp_path):
    sink = sink_at(spark, tmp_path, flush_on_checkpoint=True)
    sink.take(rows(spark, [(1, 0, "+I", 1.0)]), "s", 0)
    assert held(sink.read()) == {"1": (1, 1.0)} and not sink.collection.sources_with_open_bulks()


def test_open_bulks_survive_vacuum(spark, tmp_path):
    sink = sink_at(spark, tmp_path, flush_size=1000)
    for n in range(4):
        sink.take(rows(spark, [(n, n, "+I", float(n))]), "s", n)
    sink.collection.vacuum(keep=1)
    sink.flush()
    assert len(held(sink.read())) == 4


def test_restarted_stream_goes_on_with_an_open_bulk(spark, tmp_path):
    schema = "id int, seq long, op string, v double"
    data = changelog(100, seed=2)
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    for first, end in ((0, 31), (31, 64), (64, 100)):
        rows(spark, data[first:end]).coalesce(1).write.mode("append").parquet(source)
        sink = sink_at(spark, tmp_path / "root")
        sink.start(spark.readStream.schema(schema).parquet(source), checkpoint, available_now=True).awaitTermination()
        assert held(sink.read()) == by_hand([data[: end // 13 * 13]], 13)
    sink.flush()
    assert held(sink.read()) == by_hand([data], 13)


def test_a_quiet_stream_closes_bulks_by_its_timer(spark, tmp_path):
    """No change follows, and the bulk is applied all the same."""
    schema = "id int, seq long, op string, v double"
    source = str(tmp_path / "in")
    rows(spark, [(1, 0, "+I", 1.0)]).write.parquet(source)
    sink = sink_at(spark, tmp_path / "root", flush_size=1000, flush_interval_ms=2000)
    query = sink.start(spark.readStream.schema(schema).parquet(source), str(tmp_path / "checkpoint"))
    try:
        until = time.time() + 60
        while time.time() < until and query.isActive and held_or_empty(sink) == {}:
            time.sleep(0.5)
        assert query.exception() is None
        assert held_or_empty(sink) == {"1": (1, 1.0)}
    finally:
        query.stop()


def test_chunks_hold_equal_shares_whatever_the_numbers(spark):
    """Nanoseconds in bursts, and numbers far outside."""
    rng = random.Random(1)
    seqs = {1_700_000_000_000_000_000 + rng.randrange(10**6) * 10**9 + rng.randrange(5000) for _ in range(20_000)}
    seqs |= {-(1 << 62) + i for i in range(50)} | {(1 << 62) + i * 10**12 for i in range(50)}
    frame = spark.createDataFrame([(0, s) for s in seqs], "writer int, seq long")
    chunks = _between_cut_points(frame, frame, "seq").groupBy("_chunk").agg(
        F.count("*").alias("n"), F.min("seq").alias("a"), F.max("seq").alias("b")
    )
    found = sorted(map(tuple, chunks.collect()))
    assert 1000 < len(found) <= CUT_POINTS and max(n for _, n, _, _ in found) <= 100
    assert all(one[3] < two[2] for one, two in zip(found, found[1:], strict=False))
    got = [r["bulk_id"] for r in roll_bulks(frame, 7).orderBy("seq").collect()]
    assert got == [i // 7 for i in range(len(seqs))]


def test_last_bulk_of_each_writer(spark):
    rolled = spark.sql("select id % 3 as writer, id div 30 as bulk_id, 0L as tick from range(100)")
    assert sorted(map(tuple, last_bulks(rolled).collect())) == [(0, 3, 4, 0), (1, 3, 3, 0), (2, 3, 3, 0)]
