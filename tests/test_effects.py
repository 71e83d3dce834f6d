"""Folding and applying against the plain model."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from docsink.operators import applying
from docsink.operators.bulks import bulk_groups, net_actions
from docsink.operators.effects import effects_of_actions, fold_bulks
from tests import model

KINDS = {"D": ["-D"], "I": ["+I"], "R": ["+U"], "U": ["-D", "+U"], "-": ["-U"]}


def every_sequence(length):
    """Every sequence of net actions up to ``length``, on a present and on an absent key."""
    base, changes = {}, []
    for n in range(1, length + 1):
        for actions in itertools.product("DIRU", repeat=n):
            for present in (0, 1):
                key = f"{''.join(actions)}{present}"
                if present:
                    base[key] = {"v": -1, "extra": "kept"}
                for bulk, action in enumerate(actions):
                    for i, op in enumerate(KINDS[action]):
                        changes.append((key, bulk, bulk * 10 + i, op, {"v": bulk * 10 + i}))
    base["untouched"] = {"v": -2, "extra": "kept"}
    return base, changes


def frames(spark, base, changes):
    rows = [(k, b, s, op, doc["v"]) for k, b, s, op, doc in changes]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "_key string, bulk_id long, seq long, op string, v int")
    df = df.select("_key", "bulk_id", "seq", "op", F.struct("v").alias("doc"))
    held = [(k, d["v"], d["extra"]) for k, d in base.items()]
    return spark.createDataFrame(held, "_key string, v int, extra string"), df


def plain(df):
    return {r["_key"]: (r["v"], r["extra"]) for r in df.collect()}


def expected(base, changes):
    return {k: (d["v"], d.get("extra")) for k, d in model.apply_bulks(base, changes).items()}


@pytest.mark.parametrize("segment_bulks,bounded", [(1, True), (2, True), (3, False), (256, True)])
def test_every_action_sequence(spark, segment_bulks, bounded):
    base, changes = every_sequence(5)
    stored, df = frames(spark, base, changes)
    got = plain(applying.apply_bulks(stored, df, segment_bulks=segment_bulks, bounded_bulks=bounded))
    assert got == expected(base, changes)


def test_new_collection(spark):
    _, changes = every_sequence(4)
    _, df = frames(spark, {"x": {"v": 1, "extra": "y"}}, changes)
    got = {r["_key"]: r["v"] for r in applying.apply_bulks(None, df, segment_bulks=2).collect()}
    assert got == {k: d["v"] for k, d in model.apply_bulks({}, changes).items()}


def test_broadcast_effects_give_the_same(spark):
    base, changes = every_sequence(4)
    stored, df = frames(spark, base, changes)
    effects, doc_type = fold_bulks(df), df.schema["doc"].dataType
    small = applying.apply_effects(stored, effects, doc_type, small_effects=True)
    assert plain(small) == expected(base, changes)
    assert small.columns == ["_key", "v", "extra"]


def test_random_changelog_with_dropped_kinds(spark):
    rng = random.Random(7)
    base = {str(k): {"v": -k, "extra": f"e{k}"} for k in range(0, 60, 2)}
    ops = ["+I", "+U", "-D", "-U", None]
    changes = [(str(rng.randrange(60)), s // 40, s, rng.choice(ops), {"v": s}) for s in range(2500)]
    stored, df = frames(spark, base, changes)
    assert plain(applying.apply_bulks(stored, df, segment_bulks=7)) == expected(base, changes)


def test_hot_key_holds_a_third_of_all_changes(spark):
    rng = random.Random(9)
    changes = []
    for s in range(6000):
        key = "hot" if s % 3 == 0 else str(rng.randrange(500))
        changes.append((key, s // 10, s, rng.choice(["+I", "+U", "+U", "-D"]), {"v": s}))
    base = {"hot": {"v": -1, "extra": "e"}}
    stored, df = frames(spark, base, changes)
    assert plain(applying.apply_bulks(stored, df, segment_bulks=16)) == expected(base, changes)


def test_actions_partition_the_groups(spark):
    base, changes = every_sequence(4)
    _, df = frames(spark, base, changes)
    groups = bulk_groups(df)
    counts = {r["action"]: r["count"] for r in net_actions(groups).groupBy("action").count().collect()}
    assert set(counts) == set("DIRU")
    assert sum(counts.values()) == groups.count()


@pytest.mark.parametrize("size", [1, 100, 10000])
def test_well_formed_changelog_is_last_write_wins(spark, size):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    events.createOrReplaceTempView("events")
    changes = spark.sql(
        f"""
        with ev as (select *, lag(event_type) over (partition by user_id order by event_id) as pt from events)
        select cast(user_id as string) as _key, event_id as seq, event_id div {size} as bulk_id,
               case when event_type = 'error' then '-D' when pt is null or pt = 'error' then '+I' else '+U' end as op,
               struct(value) as doc
        from ev where not (event_type = 'error' and (pt is null or pt = 'error'))"""
    )
    exact = applying.apply_bulks(None, changes, bounded_bulks=size < 1000)
    last = applying.apply_last_writes(None, changes)
    assert exact.count() == 120
    assert exact.exceptAll(last).isEmpty() and last.exceptAll(exact).isEmpty()


def test_last_write_ignores_other_kinds(spark):
    rows = [("a", 0, "+I", 1), ("a", 1, "-U", 2), ("a", 2, None, 3), ("b", 0, "-U", 4)]
    df = spark.createDataFrame(rows, "_key string, seq long, op string, v int")
    df = df.select("_key", "seq", "op", F.struct("v").alias("doc"))
    base = spark.createDataFrame([("b", 9)], "_key string, v int")
    got = {r["_key"]: r["v"] for r in applying.apply_last_writes(base, df).collect()}
    assert got == {"a": 1, "b": 9}


DEEP = "doc struct<n:int, tags:map<string,int>, deep:map<string,map<string,int>>, s:struct<a:int, m:map<string,int>>>"


def random_doc(rng):
    def entries(make):
        return {rng.choice("abc"): make() for _ in range(rng.randrange(3))}

    def maybe(make):
        return None if rng.random() < 0.25 else make()

    number = lambda: maybe(lambda: rng.randrange(1000))
    return {
        "n": number(),
        "tags": maybe(lambda: entries(number)),
        "deep": maybe(lambda: entries(lambda: maybe(lambda: entries(number)))),
        "s": maybe(lambda: {"a": number(), "m": maybe(lambda: entries(number))}),
    }


@pytest.mark.parametrize("segment_bulks", [1, 2, 3])
def test_nested_objects_are_merged(spark, segment_bulks):
    rng = random.Random(segment_bulks)
    base = {str(k): {**random_doc(rng), "extra": k} for k in range(0, 300, 2)}
    changes = []
    for key in range(300):
        seq = 0
        for bulk in range(rng.randrange(1, 9)):
            for op in KINDS[rng.choice("DIRUUUU-")]:
                changes.append((str(key), bulk, seq, op, random_doc(rng)))
                seq += 1
    df = spark.createDataFrame(changes, f"_key string, bulk_id long, seq long, op string, {DEEP}")
    stored = spark.createDataFrame(
        [(k, d, d["extra"]) for k, d in base.items()], f"_key string, {DEEP}, extra int"
    ).select("_key", "doc.*", "extra")
    result = applying.apply_bulks(stored, df, segment_bulks=segment_bulks, bounded_bulks=segment_bulks == 3)
    got = {}
    for row in result.collect():
        values = row.asDict(recursive=True)
        got[values.pop("_key")] = values
    want = {k: {**d, "extra": d.get("extra")} for k, d in model.apply_bulks(base, changes).items()}
    assert got == want


def test_single_upsert_merges_maps(spark):
    base = spark.createDataFrame([("a", {"x": 1, "y": 2})], "_key string, m map<string,int>")
    docs = spark.createDataFrame(
        [("a", ({"y": None, "z": 3},)), ("b", ({"q": 1},))], "_key string, doc struct<m:map<string,int>>"
    )
    got = {r["_key"]: r["m"] for r in applying.apply_upserts(base, docs).collect()}
    assert got == {"a": {"x": 1, "y": None, "z": 3}, "b": {"q": 1}}
    got = {r["_key"]: r["m"] for r in applying.apply_replaces(base, docs).collect()}
    assert got == {"a": {"y": None, "z": 3}}


def test_attribute_types_must_agree(spark):
    base = spark.createDataFrame([("a", "text")], "_key string, v string")
    docs = spark.createDataFrame([("a", (1,))], "_key string, doc struct<v:int>")
    with pytest.raises(TypeError, match="attribute 'v'"):
        applying.apply_upserts(base, docs)


def test_odd_attribute_names(spark):
    base = spark.createDataFrame([("a", 1, 2)], ["_key", "a.b", "base`only"])
    docs = spark.createDataFrame([("a", 5), ("b", 6)], ["_key", "v"]).select(
        "_key", F.struct(F.col("v").alias("a.b"), F.col("v").alias("put")).alias("doc")
    )
    rows = {r["_key"]: r.asDict() for r in applying.apply_upserts(base, docs).collect()}
    assert rows["a"] == {"_key": "a", "a.b": 5, "put": 5, "base`only": 2}
    assert rows["b"] == {"_key": "b", "a.b": 6, "put": 6, "base`only": None}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_shuffles_changes_twice_and_base_once(spark):
    base, changes = every_sequence(3)
    stored, df = frames(spark, base, changes)
    plan = plan_of(applying.apply_bulks(stored, df, bounded_bulks=True))
    assert plan.count("Exchange ") == 3
    assert plan.count("Sort [") == 3
    assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan


def test_base_is_not_shuffled_when_effects_are_small(spark, tmp_path):
    base, changes = every_sequence(2)
    stored, df = frames(spark, base, changes)
    stored.write.parquet(str(tmp_path / "base"))
    effects_of_actions(net_actions(bulk_groups(df, by=("_key",)))).write.parquet(str(tmp_path / "effects"))
    effects = spark.read.parquet(str(tmp_path / "effects"))
    kept = applying.apply_effects(
        spark.read.parquet(str(tmp_path / "base")), effects, df.schema["doc"].dataType, small_effects=True
    )
    assert "Exchange hashpartitioning" not in plan_of(kept)


def test_attributes_widen(spark):
    base = spark.sql("select '1' as _key, 1 as n, float(0.5) as x, array(1) as a union all select '2', 2, float(1), null")
    docs = spark.sql("select '1' as _key, struct(5000000000L as n, 0.25D as x, array(7L) as a) as doc")
    got = {r["_key"]: (r["n"], r["x"], r["a"]) for r in applying.apply_upserts(base, docs).collect()}
    assert got == {"1": (5_000_000_000, 0.25, [7]), "2": (2, 1.0, None)}
    back = applying.apply_upserts(applying.apply_upserts(base, docs), spark.sql("select '1' as _key, struct(3 as n) as doc"))
    assert {r["_key"]: r["n"] for r in back.collect()} == {"1": 3, "2": 2}


def test_nested_objects_with_other_fields(spark):
    base = spark.sql("select * from values ('1', named_struct('a', 1, 'b', named_struct('x', 1))), ('2', null) as t(_key, o)")
    docs = "select * from values ('1', {0}), ('2', {0}), ('3', {0}) as t(_key, o)"
    docs = spark.sql(docs.format("named_struct('b', named_struct('y', 2L), 'c', true)")).selectExpr("_key", "struct(o) as doc")

    def held(df):
        return {r["_key"]: r["o"] and r["o"].asDict(recursive=True) for r in df.collect()}

    fresh = {"a": None, "b": {"x": None, "y": 2}, "c": True}
    merged = {"a": 1, "b": {"x": 1, "y": 2}, "c": True}
    assert held(applying.apply_upserts(base, docs)) == {"1": merged, "2": fresh, "3": fresh}
    assert held(applying.apply_replaces(base, docs)) == {"1": fresh, "2": fresh}
    small = applying.apply_effects(
        base, applying._effects(docs, "U"), docs.schema["doc"].dataType, small_effects=True
    )
    assert held(small) == {"1": merged, "2": fresh, "3": fresh}


def test_real_conflicts_are_refused(spark):
    base = spark.sql("select '1' as _key, 1 as n, map('a', 1) as m")
    for doc in ("struct('x' as n)", "struct(struct(1 as a) as n)", "struct(map('a', 1L) as m)"):
        with pytest.raises(TypeError, match="in the collection"):
            applying.apply_upserts(base, spark.sql(f"select '1' as _key, {doc} as doc"))
    with pytest.raises(ValueError, match="differ only in case"):
        applying.apply_upserts(base, spark.sql("select '1' as _key, struct(1 as N) as doc"))
