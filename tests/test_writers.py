"""Several jobs that write to one collection: whoever is slower goes on top, and nothing is lost."""

import pytest

from docsink import Collection, DocumentSink, SinkOptions
from docsink.operators.effects import fold_bulks
from tests.test_sink import by_hand, changelog, held, rows


def batch(spark, values, op="+I", doc="struct(v)"):
    frame = spark.createDataFrame(list(enumerate(values)), "seq long, v long")
    changes = frame.selectExpr("cast(v % 100 as string) as _key", f"'{op}' as op", "seq", "0L as bulk_id", f"{doc} as doc")
    return fold_bulks(changes), changes.schema["doc"].dataType


def interrupted(collection, other):
    """Let ``other`` run just before the next commit of ``collection``."""
    commit = collection._commit

    def late(manifest):
        collection._commit = commit
        other()
        commit(manifest)

    collection._commit = late


@pytest.fixture
def two(spark, tmp_path):
    one, other = (Collection(spark, str(tmp_path / "c"), broadcast_limit=limit) for limit in (None, 0))
    one.create()
    return one, other


def found(collection):
    return {r["_key"]: r["v"] for r in collection.read().collect()}


def test_the_slower_of_two_batches_follows(spark, two):
    one, other = two
    interrupted(one, lambda: other.append(*batch(spark, [1, 2, 3], "+I"), source="b", batch_id=0))
    assert one.append(*batch(spark, [101, 104], "+I"), source="a", batch_id=0)
    # The other batch came first, so its insert of key 1 stands.
    assert found(one) == found(other) == {"1": 1, "2": 2, "3": 3, "4": 104}
    manifest = one.manifest()
    assert [e.version for e in manifest.log] == [1, 2] and manifest.batches == {"a": 0, "b": 0}


def test_three_rounds_of_being_late(spark, two):
    one, other = two

    def again(n):
        other.append(*batch(spark, [n]))
        if n < 3:
            interrupted(one, lambda: again(n + 1))

    interrupted(one, lambda: again(1))
    one.append(*batch(spark, [9]))
    assert found(one) == {"1": 1, "2": 2, "3": 3, "9": 9}
    assert [e.version for e in one.manifest().log] == [1, 2, 3, 4]


def test_a_batch_that_another_job_delivers_meanwhile_counts_once(spark, two):
    one, other = two
    interrupted(one, lambda: other.append(*batch(spark, [1], "+I"), source="s", batch_id=3))
    assert not one.append(*batch(spark, [1], "+I"), source="s", batch_id=3)
    assert len(one.manifest().log) == 1


@pytest.mark.parametrize("slow", ["compact", "fold_log"])
def test_a_batch_during_housekeeping(spark, two, slow):
    one, other = two
    for values in ([1, 2], [3], [104]):
        one.append(*batch(spark, values))
    interrupted(one, lambda: other.append(*batch(spark, [2, 204], "-D")))
    one.compact() if slow == "compact" else one.fold_log(2)
    other.append(*batch(spark, [302], "+I"))
    assert found(one) == {"1": 1, "2": 302, "3": 3}
    one.compact()
    assert found(one) == {"1": 1, "2": 302, "3": 3}
    one.vacuum(keep=1)
    assert found(one) == {"1": 1, "2": 302, "3": 3}


def test_housekeeping_of_two_jobs(spark, two):
    one, other = two
    for values in ([1, 2], [3], [104]):
        one.append(*batch(spark, values))
    interrupted(one, other.compact)
    one.compact()
    base = one.manifest().base_version
    assert base == other.manifest().base_version and one.manifest().log == []
    assert found(one) == {"1": 1, "2": 2, "3": 3, "4": 104}
    for values in ([5], [6], [7]):
        one.append(*batch(spark, values))
    interrupted(one, other.compact)
    one.fold_log(2)
    assert one.manifest().log == [] and found(one)["7"] == 7


def test_only_one_job_creates_a_version(spark, two):
    one, other = two
    one._files.write(f"{one.path}/_versions/x.txt", "one")
    with pytest.raises(FileExistsError):
        other._files.write(f"{one.path}/_versions/x.txt", "two")
    assert one._files.read(f"{one.path}/_versions/x.txt") == "one"
    assert [n for n in one._files.names(f"{one.path}/_versions") if "tmp" in n] == []


def test_outcomes_are_counted_for_the_version_they_are_part_of(spark, tmp_path):
    options = SinkOptions("db", "docs", key="id", flush_size=13, report=True)
    one, other = (DocumentSink(spark, str(tmp_path), options) for _ in range(2))
    one.write(rows(spark, [(7, 0, "+I", 1.0)]))
    interrupted(one.collection, lambda: other.write(rows(spark, [(1, 0, "+I", 1.0)])))
    one.write(rows(spark, [(1, 0, "+I", 2.0), (2, 1, "+I", 2.0)]))
    assert held(one.read()) == {"7": (7, 1.0), "1": (1, 1.0), "2": (2, 2.0)}
    assert one.collection.manifest().outcomes["inserts_refused"] == 1
    assert [(r["_key"], r["commit"]) for r in one.collection.refused().collect()] == [("1", 3)]


def test_two_sinks_taking_turns(spark, tmp_path):
    sinks = [DocumentSink(spark, str(tmp_path), SinkOptions("db", "docs", key="id", flush_size=13, max_log=2)) for _ in range(2)]
    data = changelog(160, seed=12)
    batches = [data[i : i + 40] for i in range(0, 160, 40)]
    for n, part in enumerate(batches):
        sinks[n % 2].write(rows(spark, part), source=f"s{n % 2}", batch_id=n)
    assert held(sinks[0].read()) == by_hand(batches, 13)
