"""Options, collections and the sink, batch and streaming."""

import os
import random

import pytest
from pyspark.sql import functions as F

from docsink import Collection, DocumentSink, SinkOptions
from docsink.operators.applying import apply_bulks
from docsink.plans.tables import work_dir
from tests import model


def options(**more):
    return SinkOptions("db", "docs", key="id", **more)


def test_option_defaults_differ_between_the_two_forms():
    table = SinkOptions.from_table({"database": "d", "collection": "c", "host": "h", "port": 1}, key="id")
    assert (table.flush_size, table.flush_interval_ms, table.max_in_flight_flushes) == (1000, 3000, 5)
    assert not table.flush_on_checkpoint and not table.transaction_enable
    loose = SinkOptions.from_properties("d", "c", "id", {})
    assert (loose.flush_size, loose.flush_interval_ms) == (100, 1000)


def test_option_values_are_parsed():
    given = {
        "database": "d",
        "collection": "c",
        "sink.flush.size": "5",
        "sink.flush.interval": "250",
        "sink.flush.on-checkpoint": "true",
        "sink.transaction.enable": True,
        "sink.max.in-flight.flushes": 2,
    }
    got = SinkOptions.from_table(given, key="id")
    assert got.flush_size == 5 and got.flush_interval_ms == 250 and got.max_in_flight_flushes == 2
    assert got.flush_on_checkpoint and got.transaction_enable
    assert got.trigger == {}
    assert got.source_limits("kafka") == {"maxOffsetsPerTrigger": "10"}
    assert got.source_limits("parquet") == {"maxFilesPerTrigger": "2"}
    assert options(flush_interval_ms=250).trigger == {"processingTime": "250 milliseconds"}
    assert options(flush_interval_ms=0).trigger == {}


@pytest.mark.parametrize(
    "given,message",
    [
        ({"collection": "c"}, "database"),
        ({"database": "d"}, "collection"),
        ({"database": "d", "collection": "c", "sink.flush.size": 0}, "sink.flush.size"),
        ({"database": "d", "collection": "c", "sink.transaction.enable": True}, "sink.flush.on-checkpoint"),
        ({"database": "d", "collection": "c", "sink.flush.sice": 1}, "unsupported options: sink.flush.sice"),
        ({"database": "d", "collection": "c", "sink.transaction.enable": "yes"}, "boolean"),
    ],
)
def test_rejected_table_options(given, message):
    with pytest.raises(ValueError, match=message):
        SinkOptions.from_table(given, key="id")


@pytest.mark.parametrize("more", [{"mode": "other"}, {"writers": 0}, {"max_log": 0}, {"flush_size": -1}])
def test_rejected_options(more):
    with pytest.raises(ValueError):
        options(**more)
    with pytest.raises(ValueError):
        SinkOptions("db", "docs", key=[])


def changelog(n, seed=0):
    rng = random.Random(seed)
    return [(rng.randrange(40), s, rng.choice(["+I", "+U", "+U", "-D"]), s * 1.5) for s in range(n)]


def rows(spark, data):
    return spark.createDataFrame(data, "id int, seq long, op string, v double")


def by_hand(batches, size, start=None):
    collection = dict(start or {})
    for data in batches:
        bulks = [(str(k), i // size, s, op, {"id": k, "v": v}) for i, (k, s, op, v) in enumerate(data)]
        collection = model.apply_bulks(collection, bulks)
    return {k: (d["id"], d["v"]) for k, d in collection.items()}


def held(df):
    return {r["_key"]: (r["id"], r["v"]) for r in df.collect()}


@pytest.mark.parametrize("max_log,ratio", [(1, 0), (2, 1e9), (20, 0.25)])
def test_batches_in_order(spark, tmp_path, max_log, ratio):
    sink = DocumentSink(spark, str(tmp_path), options(flush_size=13, max_log=max_log, compact_ratio=ratio))
    sink.collection.create(spark.sql("select '-1' as _key, -1 as id, 0D as v"))
    start = {"-1": {"id": -1, "v": 0.0}}
    data = changelog(360)
    batches = [data[i : i + 120] for i in range(0, 360, 120)]
    for n, batch in enumerate(batches):
        assert sink.write(rows(spark, batch), source="s", batch_id=n)
        assert held(sink.read()) == by_hand(batches[: n + 1], 13, start)
    if ratio == 1e9:
        assert sink.collection.manifest().base_version == 1 and len(sink.collection.manifest().log) == 1
    assert not sink.write(rows(spark, batches[0]), source="s", batch_id=0)
    assert not sink.write(rows(spark, batches[-1]), source="s", batch_id=len(batches) - 1)
    assert held(sink.read()) == by_hand(batches, 13, start)
    assert sink.write(rows(spark, batches[0]), source="another", batch_id=0)
    assert held(sink.read()) == by_hand([*batches, batches[0]], 13, start)


def test_log_is_folded_in_tiers(spark, tmp_path):
    """With a huge base no batch rewrites it, and the log stays short."""
    sink = DocumentSink(spark, str(tmp_path), options(flush_size=10, max_log=4, compact_ratio=1e9))
    sink.collection.create(spark.sql("select '-1' as _key, -1 as id, 0D as v"))
    data = changelog(180)
    batches = [data[i : i + 30] for i in range(0, 180, 30)]
    for batch in batches:
        sink.write(rows(spark, batch))
        assert len(sink.collection.manifest().log) < 4
    assert sink.collection.manifest().base_version == 1
    assert held(sink.read()) == by_hand(batches, 10, {"-1": {"id": -1, "v": 0.0}})


def test_log_of_several_document_types(spark, tmp_path):
    sink = DocumentSink(spark, str(tmp_path), options(max_log=3, compact_ratio=1e9))
    sink.collection.create(spark.sql("select '9' as _key, 9 as id"))
    for n in range(3):
        sink.write(spark.sql(f"select 1 as id, {n}L as seq, '+I' as op, {n} as a"))
        sink.write(spark.sql(f"select 2 as id, {n}L as seq, '+I' as op, 'x' as b"))
    with pytest.raises(ValueError, match="different document types"):
        sink.collection.fold_log(2)
    got = {r["_key"]: (r["a"], r["b"]) for r in sink.read().collect()}
    assert got == {"9": (None, None), "1": (0, None), "2": (None, "x")}
    sink.collection.tidy(2, 1e9)
    assert len(sink.collection.manifest().log) == 6
    sink.collection.tidy(1, 1e9)
    assert sink.collection.manifest().log == []
    assert {r["_key"]: (r["a"], r["b"]) for r in sink.read().collect()} == got


def test_base_is_joined_once_whatever_the_log_holds(spark, tmp_path):
    sink = DocumentSink(spark, str(tmp_path), options(max_log=50))
    sink.collection.create(spark.sql("select cast(id as string) as _key, cast(id as int) as id, 'b' as b from range(9)"))
    sink.collection.broadcast_limit = 0
    want = {str(k): {"id": k, "b": "b"} for k in range(9)}
    for n in range(6):
        name, value = ("a", n) if n % 2 else ("b", f"'{n}'")
        sink.write(spark.sql(f"select cast(id as int) as id, 0L as seq, '+U' as op, {value} as {name} from range({n}, 9)"))
        # A single update replaces the document.
        want |= {str(k): {"id": k, name: n if n % 2 else str(n)} for k in range(n, 9)}
    plan = sink.read()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1 and "Broadcast" not in plan
    got = {r["_key"]: r.asDict() for r in sink.read().collect()}
    assert {k: {c: v for c, v in d.items() if v is not None and c != "_key"} for k, d in got.items()} == want
    sink.collection.broadcast_limit = None
    assert {r["_key"]: r.asDict() for r in sink.read().collect()} == got


def test_reading_without_broadcast_gives_the_same(spark, tmp_path):
    sink = DocumentSink(spark, str(tmp_path), options(flush_size=13))
    data = changelog(300)
    sink.write(rows(spark, data[:100]))
    sink.collection.compact()
    sink.write(rows(spark, data[100:200]))
    sink.write(rows(spark, data[200:]))
    want = by_hand([data[:100], data[100:200], data[200:]], 13)
    assert held(sink.read()) == want
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in sink.read()._jdf.queryExecution().executedPlan().toString()
        assert held(sink.read()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_well_compressing_log_is_not_broadcast(spark, tmp_path):
    """What counts is memory, not the size of the files."""
    sink = DocumentSink(spark, str(tmp_path), options(mode="lww"))
    text = F.rpad(F.lit("x"), 12_000, "y")
    sink.write(spark.range(2000).select("id", F.col("id").alias("seq"), F.lit("+I").alias("op"), text.alias("v")))
    (entry,) = sink.collection.manifest().log
    assert entry.rows == 2000 and entry.size < 200_000 < 20_000_000 < entry.memory
    sink.collection.compact()
    sink.write(spark.range(2000).select("id", F.col("id").alias("seq"), F.lit("+U").alias("op"), text.alias("v")))
    assert "Broadcast" not in sink.read()._jdf.queryExecution().executedPlan().toString()
    sink.write(spark.sql("select 1L as id, 0L as seq, '+U' as op, 'small' as v"))
    assert sink.read().where("v = 'small'").count() == 1


def test_last_write_mode(spark, tmp_path):
    sink = DocumentSink(spark, str(tmp_path), options(mode="lww"))
    sink.write(rows(spark, [(1, 0, "+I", 1.0), (1, 1, "+U", 2.0), (2, 2, "+I", 3.0)]))
    sink.write(rows(spark, [(1, 3, "-D", 0.0), (3, 4, "+U", 5.0), (2, 5, "+I", 6.0)]))
    assert held(sink.read()) == {"2": (2, 6.0), "3": (3, 5.0)}


def test_update_before_rows_are_ignored(spark, tmp_path):
    sink = DocumentSink(spark, str(tmp_path), options())
    sink.write(rows(spark, [(1, 0, "+I", 1.0), (1, 1, "-U", 1.0), (1, 2, "+U", 2.0), (1, 3, "-U", 2.0)]))
    assert held(sink.read()) == {"1": (1, 2.0)}


def test_failed_batch_leaves_no_trace(spark, tmp_path):
    sink = DocumentSink(spark, str(tmp_path), options())
    sink.write(rows(spark, [(1, 0, "+I", 1.0)]), source="s", batch_id=0)
    with pytest.raises(Exception, match="unknown row kind"):
        sink.write(rows(spark, [(2, 1, "+I", 1.0), (3, 2, "??", 1.0)]), source="s", batch_id=1)
    assert held(sink.read()) == {"1": (1, 1.0)}
    assert sink.write(rows(spark, [(2, 1, "+I", 1.0)]), source="s", batch_id=1)
    assert held(sink.read()) == {"1": (1, 1.0), "2": (2, 1.0)}


def test_new_attributes_and_surviving_ones(spark, tmp_path):
    sink = DocumentSink(spark, str(tmp_path), options())
    sink.write(spark.sql("select 1 as id, 0L as seq, '+I' as op, 'old' as name, 1 as n"))
    # Two changes of one key in a bulk: an upsert, which leaves ``name`` alone.
    sink.write(spark.sql("select 1 as id, 1L as seq, '+U' as op, 2 as n union all select 1, 2L, '+U', 3"))
    assert sink.read().first().asDict() == {"_key": "1", "id": 1, "n": 3, "name": "old"}
    # A single update: a replace, which drops it.
    sink.write(spark.sql("select 1 as id, 3L as seq, '+U' as op, 4 as n, true as flag"))
    assert sink.read().first().asDict() == {"_key": "1", "id": 1, "n": 4, "flag": True, "name": None}
    before = sink.read().collect()
    sink.collection.compact()
    assert sink.read().collect() == before


def test_documents_with_maps_through_the_log(spark, tmp_path):
    sink = DocumentSink(spark, str(tmp_path), options())
    sink.write(spark.sql("select 1 as id, 0L as seq, '+I' as op, map('a', 1, 'b', 2) as m"))
    twice = "select 1 as id, 1L as seq, '+U' as op, map('b', 0) as m union all select 1, 2L, '+U', map('c', 3)"
    sink.write(spark.sql(twice))
    assert sink.read().first()["m"] == {"a": 1, "b": 2, "c": 3}
    sink.write(spark.sql("select 1 as id, 3L as seq, '+U' as op, map('z', 9) as m"))
    assert sink.read().first()["m"] == {"z": 9}


def test_bucketed_base_is_never_shuffled(spark, tmp_path):
    sink = DocumentSink(spark, str(tmp_path), options(flush_size=13, buckets=6, max_log=3, compact_ratio=1e9))
    start = {str(-k): {"id": -k, "v": 0.5} for k in range(1, 200)}
    sink.collection.create(
        spark.createDataFrame([(k, d["id"], d["v"]) for k, d in start.items()], "_key string, id int, v double")
    )
    data = changelog(360)
    batches = [data[i : i + 120] for i in range(0, 360, 120)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n, batch in enumerate(batches):
            sink.write(rows(spark, batch))
            plan = sink.read()._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange ") == 1 and "Bucketed: true" in plan
            assert held(sink.read()) == by_hand(batches[: n + 1], 13, start)
        sink.collection.compact()
        assert held(sink.read()) == by_hand(batches, 13, start)
        base = tmp_path / "db" / "docs" / "base" / f"version={sink.collection.manifest().base_version}"
        assert len([f for f in os.listdir(base) if f.startswith("part-")]) == 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    sink.write(rows(spark, batches[0]))
    assert held(sink.read()) == by_hand([*batches, batches[0]], 13, start)
    sink.collection.compact()
    assert held(sink.read()) == by_hand([*batches, batches[0]], 13, start)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("docsink_")]


def test_buckets_keep_odd_names(spark, tmp_path):
    collection = Collection(spark, str(tmp_path / "it's"), buckets=2)
    docs = spark.sql("select 'x' as _key, named_struct('$binary', 'b', 'a.b', map('k', 1)) as `s.t`, 1.50BD as `q``q`")
    collection.create(docs)
    assert collection.read().collect() == docs.collect()
    with pytest.raises(ValueError):
        Collection(spark, "x", buckets=0)


def test_collection_life(spark, tmp_path):
    collection = Collection(spark, str(tmp_path / "c"))
    assert not collection.exists()
    with pytest.raises(FileNotFoundError):
        collection.read()
    collection.create()
    assert collection.exists() and collection.read().count() == 0 and collection.read().columns == ["_key"]
    collection.create(spark.sql("select 'x' as _key"))
    assert collection.read().count() == 0

    other = Collection(spark, str(tmp_path / "d"))
    other.create(spark.sql("select 'x' as _key, 1 as v"))
    assert [r.asDict() for r in other.read().collect()] == [{"_key": "x", "v": 1}]


def test_vacuum_keeps_what_is_in_use(spark, tmp_path):
    sink = DocumentSink(spark, str(tmp_path), options(max_log=2))
    data = changelog(200)
    for n in range(5):
        sink.write(rows(spark, data[n * 40 : n * 40 + 40]))
    want = held(sink.read())
    sink.collection.vacuum(keep=1)
    assert held(sink.read()) == want
    root = tmp_path / "db" / "docs"
    assert len([f for f in os.listdir(root / "_versions") if f.endswith(".json") and not f.startswith(".")]) == 1
    assert len(os.listdir(root / "base")) == 1 and len(os.listdir(root / "log")) == 1
    with pytest.raises(ValueError):
        sink.collection.vacuum(keep=0)


def test_old_versions_go_away(spark, tmp_path):
    for seconds, left in ((0, 3), (3600, 5)):
        sink = DocumentSink(
            spark, str(tmp_path / str(seconds)), options(mode="lww", max_log=100, keep_versions=3, keep_seconds=seconds)
        )
        for n in range(5):
            sink.write(spark.sql(f"select {n} as id, 0L as seq, '+I' as op, 0D as v"))
        assert len(sink.collection._version_numbers()) == left
        assert sink.read().count() == 5


def test_own_encoder(spark, tmp_path):
    def encoder(lines):
        parsed = F.from_json("value", "id string, n int, gone boolean")
        return lines.select(
            parsed["id"].alias("_key"),
            F.when(parsed["gone"], "-D").otherwise("+U").alias("op"),
            F.col("seq"),
            F.struct(parsed["n"].alias("n")).alias("doc"),
        )

    sink = DocumentSink(spark, str(tmp_path), options(mode="lww"), encoder=encoder)
    text = ['{"id":"a","n":1}', '{"id":"b","n":2}', '{"id":"a","n":3}', '{"id":"b","gone":true}']
    sink.write(spark.createDataFrame(list(enumerate(text)), "seq long, value string"))
    assert [r.asDict() for r in sink.read().collect()] == [{"_key": "a", "n": 3}]


def test_encoder_in_python_runs_on_arrow_batches(spark, tmp_path):
    def parse(batches):
        for rows in batches:
            parts = rows["line"].str.split(";", expand=True)
            yield rows[["seq"]].assign(_key=parts[0], op=parts[1], n=parts[2].astype("int32"))

    def encoder(lines):
        parsed = lines.mapInPandas(parse, "seq long, _key string, op string, n int")
        return parsed.select("_key", "op", "seq", F.struct("n").alias("doc"))

    sink = DocumentSink(spark, str(tmp_path), options(), encoder=encoder)
    sink.write(spark.createDataFrame([(0, "a;+I;1"), (1, "b;+I;2"), (2, "a;+U;3")], "seq long, line string"))
    assert {r["_key"]: r["n"] for r in sink.read().collect()} == {"a": 3, "b": 2}


def test_stream_equals_batch(spark, tmp_path):
    data = [(k, s, op, v, s // 25) for k, s, op, v in changelog(400, seed=5)]
    schema = "id int, seq long, op string, v double, bulk_id long"
    sink = DocumentSink(spark, str(tmp_path / "root"), options(max_log=3))
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    for n in range(2):
        spark.createDataFrame(data[n * 200 : n * 200 + 200], schema).write.mode("append").parquet(source)
        query = sink.start(spark.readStream.schema(schema).parquet(source), checkpoint, available_now=True)
        query.awaitTermination()
    everything = spark.createDataFrame(data, schema)
    changes = everything.select(
        F.col("id").cast("string").alias("_key"), "bulk_id", "seq", "op", F.struct("id", "v").alias("doc")
    )
    want = held(apply_bulks(None, changes))
    assert held(sink.read()) == want
    # A new checkpoint starts again at batch 0: what it delivers is applied, new data above all.
    spark.createDataFrame([(99, 1000, "+I", 1.0, 40)], schema).write.mode("append").parquet(source)
    query = sink.start(
        spark.readStream.schema(schema).parquet(source), str(tmp_path / "other"), available_now=True, source=checkpoint
    )
    query.awaitTermination()
    got = held(sink.read())
    assert got.pop("99") == (99, 1.0)
    assert got == held(apply_bulks(apply_bulks(None, changes), changes))


# Where the last write wins, bulks say nothing.
@pytest.mark.parametrize("mode,column", [("bulk", "seq"), ("bulk", "bulk_id"), ("lww", "seq")])
def test_changes_without_a_place_are_refused(spark, tmp_path, mode, column):
    """A change that is nowhere in the order must not be lost or undo another."""
    sink = DocumentSink(spark, str(tmp_path), options(mode=mode))
    good = spark.sql("select 1 as id, 0L as seq, 0L as bulk_id, '+I' as op, 1D as v")
    sink.write(good)
    with pytest.raises(Exception, match=f"null in column {column}"):
        sink.write(good.withColumn(column, F.lit(None).cast("long")))
    with pytest.raises(TypeError, match="integer"):
        sink.write(good.withColumn(column, F.lit("1")))
    assert held(sink.read()) == {"1": (1, 1.0)}


def test_failing_stream_reports_and_recovers(spark, tmp_path):
    schema = "id int, seq long, op string, v double"
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    rows(spark, changelog(50)).write.parquet(source)
    sink = DocumentSink(spark, str(tmp_path / "root"), options(flush_size=10))

    def broken(df):
        op = F.raise_error(F.lit("boom")).cast("string").alias("op")
        return df.select(F.col("id").cast("string").alias("_key"), op, "seq", F.struct("id").alias("doc"))

    failing = DocumentSink(spark, str(tmp_path / "root"), options(flush_size=10), encoder=broken)
    query = failing.start(spark.readStream.schema(schema).parquet(source), checkpoint, available_now=True)
    with pytest.raises(Exception, match="boom"):
        query.awaitTermination()
    query = sink.start(spark.readStream.schema(schema).parquet(source), checkpoint, available_now=True)
    query.awaitTermination()
    assert held(sink.read()) == by_hand([changelog(50)], 10)


class _Session:
    """Just enough of a session to ask for its folders."""

    def __init__(self, master, shared=None, checkpoint=None):
        self.conf = {"spark.checkpoint.dir": shared}
        self.sparkContext = type("Context", (), {"master": master, "getCheckpointDir": lambda _: checkpoint})()


def test_work_dir_is_the_folder_the_session_names():
    assert work_dir(_Session("yarn", shared="hdfs://c/tmp/"), "x").startswith("hdfs://c/tmp/docsink/x-")
    assert work_dir(_Session("yarn", checkpoint="s3://b/c"), "x").startswith("s3://b/c/docsink/x-")
    assert os.path.isdir(work_dir(_Session("local[2]"), "x"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(_Session("yarn"), "x")
