"""Slices of the streaming query keep Spark's own number of files."""

import os

import pytest

from docsink.plans import stream_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test data")
@pytest.mark.parametrize("spread", [True, False])
def test_slices_are_written_by_several_tasks(spark, tmp_path, monkeypatch, spread):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    parts = events.repartition(3) if spread else events.repartitionByRange(3, "event_id")
    parts.write.parquet(f"{tmp_path}/data/events.parquet")
    want = sorted(map(tuple, stream_queries.stream_replay_idempotent(spark, SF_DIR).collect()), key=str)
    monkeypatch.setattr(stream_queries, "work_dir", lambda spark, purpose: f"{tmp_path}/{purpose}")
    got = stream_queries.stream_apply_changelog(spark, f"{tmp_path}/data")
    assert sorted(map(tuple, got.collect()), key=str) == want
    files = [name for name in os.listdir(f"{tmp_path}/stream/arriving") if name.startswith("part-")]
    assert len(files) > stream_queries.SLICES if spread else len(files) >= stream_queries.SLICES
    assert len([n for n in os.listdir(f"{tmp_path}/stream/checkpoint/offsets") if n.isdigit()]) == stream_queries.SLICES
