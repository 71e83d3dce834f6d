import itertools

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docsink.llm.packing import best_bounds, exact_bounds, length_bounds, pack
from tests.llm.conftest import prose


def padding(lengths, bounds):
    return sum(min(b for b in bounds if b >= n) - n for n in lengths)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=30), st.integers(1, 4))
def test_bounds_waste_least(lengths, buckets):
    values, counts = np.unique(lengths, return_counts=True)
    bounds = best_bounds(values, counts, values * counts, buckets)
    assert len(bounds) <= buckets and bounds[-1] == max(lengths)
    tries = (
        {*c, max(lengths)} for k in range(buckets) for c in itertools.combinations(values.tolist(), k)
    )
    assert padding(lengths, bounds) == min(padding(lengths, t) for t in tries)


def test_histogram_keeps_true_maxima(spark):
    lengths = [1, 255, 256, 257, 511, 512, 100_003, 100_004, 7_000_001]
    frame = spark.createDataFrame([(n,) for n in lengths], "length long")
    assert length_bounds(frame, 99) == [1, 255, 257, 511, 512, 100_004, 7_000_001]


def test_every_document_is_in_one_batch_within_budget(documents):
    rows = [(i, prose(i, 1 + i * 7 % 90)) for i in range(400)]
    rows += [(900, None), (901, ""), (902, "w " * 5000), (903, "w"), (903, "w"), (None, "w")]
    got = pack(documents(rows, bucket="x", batch="y"), buckets=4, token_budget=300).collect()
    assert len(got) == len(rows)
    batches = {}
    for r in got:
        assert r.length <= r.bucket_length
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for (_, _), members in batches.items():
        assert sorted(r.slot for r in members) == list(range(len(members)))
        assert len(members) == 1 or len(members) * members[0].bucket_length <= 300
    for bucket in {r.bucket for r in got}:
        numbers = sorted(b for k, b in batches if k == bucket)
        assert numbers == list(range(len(numbers)))
        fits = max(300 // next(r.bucket_length for r in got if r.bucket == bucket), 1)
        assert all(len(batches[bucket, b]) == fits for b in numbers[:-1])
    assert {r.length for r in got if r.doc_id in (900, 901)} == {1}


def test_lanes_do_not_change_the_contract(documents, monkeypatch):
    monkeypatch.setattr("docsink.llm.packing.LANE_ROWS", 10)
    got = pack(documents([(i, prose(i, 5)) for i in range(100)]), token_budget=60)
    assert got.agg(F.count_distinct("bucket", "batch", "slot")).first()[0] == 100


def test_empty_table(documents):
    assert pack(documents([])).collect() == []


def test_long_lengths_are_told_apart(spark, documents):
    lengths = [1, 255, 256, 257, 511, 512, 100_003, 100_004, 7_000_001]
    assert exact_bounds(spark.createDataFrame([(n,) for n in lengths], "length long"), 99) == lengths
    got = pack(documents([(i, prose(i, 599 + i)) for i in range(4)]), buckets=4).collect()
    assert all(r.bucket_length == r.length for r in got) and len({r.length for r in got}) == 4


def test_many_lengths_take_the_same_padding_as_brute_force():
    rng = np.random.default_rng(0)
    values = np.sort(rng.choice(5000, 300, replace=False) + 1)
    counts = rng.integers(1, 1000, 300)
    lengths = np.repeat(values, counts)
    least = np.append(0.0, np.full(300, np.inf))
    rows, sums = np.append(0, np.cumsum(counts)), np.append(0, np.cumsum(values * counts))
    for _ in range(5):
        least = np.array([0.0] + [
            min(least[i] + values[j - 1] * (rows[j] - rows[i]) - sums[j] + sums[i] for i in range(j)) for j in range(1, 301)
        ])
    bounds = np.array(best_bounds(values, counts, values * counts, 5))
    assert int((bounds[np.searchsorted(bounds, lengths)] - lengths).sum()) == least[-1]
