import random

import pytest
from pyspark.sql import functions as F

from docsink.operators import bulks
from docsink.operators.changelog import normalize_changelog
from docsink.operators.effects import effects_of_last_writes, fold_bulks
from docsink.operators.rolling import hash_writer, roll_bulks, roll_by_interval


def rolled_by_hand(rows, size, interval=None):
    """rows: (writer, seq, ts in ms); returns {(writer, seq): bulk}."""
    out = {}
    for writer in {r[0] for r in rows}:
        bulk, filled, tick = -1, size, None
        for _, seq, ts in sorted(r for r in rows if r[0] == writer):
            now = None if interval is None else ts // interval
            if filled == size or now != tick:
                bulk, filled, tick = bulk + 1, 0, now
            filled += 1
            out[(writer, seq)] = bulk
    return out


def changes(skewed):
    rng = random.Random(3)
    seqs = rng.sample(range(-2000, 30000), 3000)
    # The busy writer takes a third of all rows or more.
    return [(0 if skewed and s % 3 else rng.randrange(5), s, 1000 * (s + 5000)) for s in seqs]


@pytest.mark.parametrize("chunk", [1, 37, 1 << 20, None])
@pytest.mark.parametrize("skewed", [False, True])
def test_size(spark, chunk, skewed):
    rows = changes(skewed)
    df = spark.createDataFrame(rows, "writer int, seq long, ms long")
    got = {(r["writer"], r["seq"]): r["bulk_id"] for r in roll_bulks(df, 50, seq_chunk=chunk).collect()}
    assert got == rolled_by_hand(rows, 50)


@pytest.mark.parametrize("chunk", [11, 1000])
def test_size_or_interval(spark, chunk):
    rows = changes(True)
    df = spark.createDataFrame(rows, "writer int, seq long, ms long").withColumn("ts", F.timestamp_millis("ms"))
    rolled = roll_bulks(df, 20, interval_ms=60_000, seq_chunk=chunk)
    got = {(r["writer"], r["seq"]): r["bulk_id"] for r in rolled.collect()}
    assert got == rolled_by_hand(rows, 20, 60_000)


def test_interval_before_the_epoch(spark):
    df = spark.sql("select timestamp'1969-12-31 23:59:59.999' as ts union all select timestamp'1970-01-01 00:00:00'")
    assert sorted(r["bulk_id"] for r in roll_by_interval(df, 1000).collect()) == [-1, 0]


def test_wall_clock_arrival_ignores_the_session_zone(spark):
    df = spark.sql("select timestamp_ntz'1970-01-02 00:00:00.000001' as ts")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert roll_by_interval(df, 3_600_000).first()["bulk_id"] == 24
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_large_sequence_numbers_stay_exact(spark):
    start = (1 << 62) + 1
    df = spark.range(start, start + 100).withColumnRenamed("id", "seq").withColumn("writer", F.lit(0))
    got = [r["bulk_id"] for r in roll_bulks(df, 10, seq_chunk=7).orderBy("seq").collect()]
    assert got == [i // 10 for i in range(100)]


def test_sparse_sequence_numbers(spark):
    step = (1 << 63) // 50
    df = spark.range(-50, 50).select((F.col("id") * step).alias("seq"), F.lit(0).alias("writer"))
    got = [r["bulk_id"] for r in roll_bulks(df, 10, seq_chunk=None).orderBy("seq").collect()]
    assert got == [i // 10 for i in range(100)]


def test_no_bulk_exceeds_the_size(spark):
    df = spark.range(10_000).select(F.col("id").alias("seq"), (F.col("id") % 97).cast("string").alias("_key"))
    rolled = roll_bulks(df.withColumn("writer", hash_writer(4)), 100, seq_chunk=64)
    sizes = bulks.bulk_sizes(rolled, 100, by=("writer", "bulk_id"))
    assert sizes.where("n > 100").isEmpty()
    assert sizes.where("not is_full").count() <= 4
    assert rolled.groupBy("_key").agg(F.countDistinct("writer").alias("w")).where("w > 1").isEmpty()


def test_rows_are_numbered_per_chunk_not_per_writer(spark):
    df = spark.range(10_000).select(F.col("id").alias("seq"), F.lit(0).alias("writer"))
    rolled = roll_bulks(df, 100, seq_chunk=256)
    windows = [
        line
        for line in rolled._jdf.queryExecution().optimizedPlan().toString().splitlines()
        if "row_number()" in line and "Window" in line
    ]
    assert windows and all("_chunk" in w.split("windowspecdefinition")[1] for w in windows)


@pytest.mark.parametrize("size,chunk", [(0, 1), (1, 0)])
def test_rejected_parameters(spark, size, chunk):
    df = spark.sql("select 1L as seq, 0 as writer")
    with pytest.raises(ValueError):
        roll_bulks(df, size, seq_chunk=chunk)


def test_sequence_must_be_an_integer(spark):
    with pytest.raises(TypeError, match="seq"):
        roll_bulks(spark.sql("select 1.5 as seq, 0 as writer"), 10)
    with pytest.raises(ValueError):
        roll_by_interval(spark.sql("select current_timestamp() as ts"), 0)
    with pytest.raises(ValueError):
        hash_writer(0)


def test_unknown_row_kind_fails(spark):
    good = spark.createDataFrame([("+I",), ("-U",), ("+U",), ("-D",)], "op string")
    assert sorted(r["op"] for r in normalize_changelog(good).collect()) == ["+I", "+U", "-D"]
    for bad in ("insert", None):
        df = spark.createDataFrame([("+I",), (bad,)], "op string")
        with pytest.raises(Exception, match="unknown row kind"):
            normalize_changelog(df).collect()


@pytest.mark.parametrize("column", ["writer", "seq", "ts"])
def test_rows_without_a_place_are_refused(spark, column):
    df = spark.sql("select 0 as writer, 1L as seq, timestamp'1970-01-01 00:00:00' as ts")
    empty = df.withColumn(column, F.lit(None).cast(df.schema[column].dataType))
    with pytest.raises(Exception, match=f"null in column {column}"):
        roll_bulks(df.unionAll(empty), 5, interval_ms=1000).collect()
    if column == "ts":
        with pytest.raises(Exception, match="null in column ts"):
            roll_by_interval(df.unionAll(empty), 1000).collect()
    if column == "seq":
        changes = empty.selectExpr("'k' as _key", "seq", "0L as bulk_id", "'+U' as op", "struct(1 as v) as doc")
        for operator in (bulks.bulk_groups, fold_bulks, effects_of_last_writes, normalize_changelog):
            with pytest.raises(Exception, match="null in column seq"):
                operator(changes).collect()
