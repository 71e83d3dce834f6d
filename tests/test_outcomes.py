"""What becomes of each change, against a plain model, and rows that are put aside."""

import json
from itertools import product

import pytest
from pyspark.sql import functions as F

from docsink import DocumentSink, SinkOptions, fold_outcomes, resolve_outcomes
from docsink.operators.outcomes import ACTIONS, OUTCOME_COLUMNS
from tests import model
from tests.test_sink import by_hand, changelog, held, rows

# One change, or two that make an upsert, per action.
CHANGES = {"I": ["+I"], "R": ["+U"], "D": ["-D"], "U": ["+I", "+U"], "-": ["+U", "-U"]}


def plain(actions, present):
    counts = dict.fromkeys(OUTCOME_COLUMNS, 0)
    names = {action: name for name, action in ACTIONS.items()}
    for action in actions:
        if action == "-":
            continue
        counts[names[action]] += 1
        refused = {"I": present, "R": not present, "D": not present}.get(action, False)
        if refused:
            counts[{"I": "inserts_refused", "R": "replaces_refused", "D": "deletes_missed"}[action]] += 1
        present = {"I": True, "U": True, "D": False, "R": present}[action]
    return (*counts.values(), present)


@pytest.mark.parametrize("segment_bulks", [256, 2, 1])
def test_all_sequences_up_to_length_five(spark, segment_bulks):
    sequences = [s for n in range(1, 6) for s in product("IRDU", repeat=n)] + [("-", "R", "-", "I"), ("D", "-", "I")]
    data = []
    for there in (0, 1):
        for number, actions in enumerate(sequences):
            seq = 0
            for bulk, action in enumerate(actions):
                for op in CHANGES[action]:
                    data.append((f"{there}-{number}", bulk, seq, op))
                    seq += 1
    changes = spark.createDataFrame(data, "_key string, bulk_id long, seq long, op string").withColumn("doc", F.lit(1))
    keys = spark.createDataFrame([(f"1-{i}",) for i in range(len(sequences))] + [("other",)], "_key string")
    got = resolve_outcomes(fold_outcomes(changes, segment_bulks=segment_bulks), keys).collect()
    assert {r["_key"]: tuple(r)[1:] for r in got} == {
        f"{there}-{number}": plain(actions, bool(there)) for there in (0, 1) for number, actions in enumerate(sequences)
    }


def plain_totals(batches, size):
    """Totals of batches, cut by size, into an empty collection."""
    present, totals = {}, dict.fromkeys(OUTCOME_COLUMNS, 0)
    for data in batches:
        groups = {}
        for i, (k, _, op, _) in enumerate(data):
            groups.setdefault((k, i // size), []).append((op, None))
        for (k, _), group in sorted(groups.items()):
            action = model.net_action(group)[0]
            *counts, present[k] = plain([action or "-"], present.get(k, False))
            for name, count in zip(OUTCOME_COLUMNS, counts, strict=True):
                totals[name] += count
    return totals


def reporting(spark, path, **more):
    return DocumentSink(spark, str(path), SinkOptions("db", "docs", key="id", report=True, **{"flush_interval_ms": 0, "flush_size": 13, **more}))


def test_totals_of_batches(spark, tmp_path):
    sink = reporting(spark, tmp_path)
    data = changelog(120, seed=9)
    batches = [data[:60], data[60:]]
    for n, batch in enumerate(batches):
        sink.write(rows(spark, batch), source="s", batch_id=n)
        assert not sink.write(rows(spark, batch), source="s", batch_id=n)
    totals = plain_totals(batches, 13)
    assert sink.collection.manifest().outcomes == totals
    refused = sink.collection.refused().collect()
    for name in ("inserts_refused", "replaces_refused", "deletes_missed"):
        assert sum(r[name] for r in refused) == totals[name] > 0
    assert {r["commit"] for r in refused} <= {1, 2}
    assert held(sink.read()) == by_hand(batches, 13)


def test_totals_of_open_bulks(spark, tmp_path):
    sink = reporting(spark, tmp_path)
    data = changelog(100, seed=9)
    for n, (first, end) in enumerate(((0, 20), (20, 71), (71, 100))):
        sink.take(rows(spark, data[first:end]), "s", n)
    sink.flush()
    assert sink.collection.manifest().outcomes == plain_totals([data], 13)


def test_nothing_is_reported_unasked(spark, tmp_path):
    sink = DocumentSink(spark, str(tmp_path), SinkOptions("db", "docs", key="id"))
    sink.write(rows(spark, changelog(20)))
    assert sink.collection.manifest().outcomes == {} and sink.collection.refused().collect() == []
    with pytest.raises(ValueError, match="bulks"):
        SinkOptions("db", "docs", key="id", report=True, mode="lww")
    with pytest.raises(ValueError, match="reject"):
        SinkOptions("db", "docs", key="id", reject="drop")


def test_rows_that_are_no_changes_are_put_aside(spark, tmp_path):
    good = changelog(30, seed=1)
    bad = [(None, 100, "+I", 1.0), (7, 101, "??", 1.0), (8, 102, None, 1.0), (9, None, "+U", None)]
    failing = DocumentSink(spark, str(tmp_path / "a"), SinkOptions("db", "docs", key="id", flush_size=13))
    with pytest.raises(Exception, match="null document key|unknown row kind|null in column"):
        failing.write(rows(spark, [*good, *bad]))
    sink = DocumentSink(spark, str(tmp_path / "b"), SinkOptions("db", "docs", key="id", flush_size=13, reject="aside"))
    for _ in range(2):
        sink.write(rows(spark, [*good, *bad]), source="a/b", batch_id=0)
    assert held(sink.read()) == by_hand([good], 13)
    found = {(r["reason"], json.loads(r["change"])["seq"]) for r in sink.rejected().collect()}
    assert found == {("no key", 100), ("unknown kind", 101), ("unknown kind", 102), ("no seq", None)}
    assert sink.rejected().count() == 4
